"""Jobs on topics as deployments have them: several partitions and topics, config
ops without an op, poison timestamps, retries, tables that are not there yet."""

import json
import os

from pyspark.sql import functions as F

from rillflow.operators import comments as cmt
from rillflow.operators import config as cfg
from rillflow.operators import logs
from rillflow.operators.position import positioned
from rillflow.streaming.comment_job import CommentBatchWriter
from rillflow.streaming.dim_job import (
    ConfigBatchWriter, ConfigState, DimBatchWriter, SnapshotStore, compact_snapshot,
)

T0 = 1_700_000_000_000
P1 = 1 << 40  # offsets of partition 1 as a topic gives them


def _topic(spark, rows):
    return spark.createDataFrame([(s, json.dumps(v) if isinstance(v, dict) else v)
                                  for s, v in rows], "seq bigint, value string")


def _cfg(op, ts, cols="id,name", sink="dim_c", key="id", src="customer"):
    image = {"source_table": src, "sink_table": sink, "sink_columns": cols, "sink_family": "info",
             "sink_row_key": key}
    out = {"ts_ms": ts, "before" if op == "d" else "after": image}
    return {**out, "op": op} if op else out


def _chg(ts, i, name, kind="update"):
    return {"database": "shop", "table": "customer", "type": kind, "ts": ts,
            "data": {"id": i, "name": name, "x": "y"}}


def _ops(spark, path, rows):
    """The next micro-batch of the config feed."""
    newest = ConfigState(path).version(spark)
    ConfigBatchWriter(path)(_topic(spark, rows), 0 if newest is None else newest + 1)


def _cells(spark, log, ops):
    return {(r["row_key"], r["column"]): r["value"]
            for r in compact_snapshot(spark, log, ops).collect()}


def test_event_time_orders_partitions_and_topics(spark, scratch):
    ops, log, bad = (os.path.join(scratch, d) for d in ("ops", "log", "bad"))
    # the config op lies in partition 1 of its topic, the changes in both of theirs;
    # the newer change has the smaller seq
    _ops(spark, ops, [(P1 + 5, _cfg("c", T0))])
    for as_of in (False, True):
        writer = DimBatchWriter(ops, log + str(as_of), bad + str(as_of), "shop", as_of=as_of)
        writer(_topic(spark, [(3, _chg(T0 + 20, 1, "new")), (P1 + 1, _chg(T0 + 10, 1, "old")),
                              (4, _chg(T0 - 10, 2, "too early"))]), 0)
        got = _cells(spark, log + str(as_of), ops)
        # per batch the change that arrives after the config is routed; per record it is early
        late = {} if as_of else {("2", "name"): "too early", ("2", "id"): "2"}
        assert got == {("1", "name"): "new", ("1", "id"): "1"} | late


def test_reset_by_event_time(spark, scratch):
    ops, log, bad = (os.path.join(scratch, d) for d in ("ops", "log", "bad"))
    _ops(spark, ops, [(P1, _cfg("c", T0)), (0, _cfg("u", T0 + 50))])
    writer = DimBatchWriter(ops, log, bad, "shop", as_of=True)
    writer(_topic(spark, [(P1, _chg(T0 + 10, 1, "gone")), (0, _chg(T0 + 60, 2, "kept"))]), 0)
    assert _cells(spark, log, ops) == {("2", "name"): "kept", ("2", "id"): "2"}


def test_position_is_exact_and_total(spark):
    rows = [(5, T0), (P1, T0), (0, T0 + 1), (7, None), (8, -1), (9, 10**18)]
    got = positioned(spark.createDataFrame(rows, "seq bigint, ts bigint").withColumn(
        "id", F.col("seq")), "ts").orderBy("seq").select("id").collect()
    # without a usable time: by id alone, before all others
    assert [r["id"] for r in got] == [7, 8, 9, 5, P1, 0]


def test_envelope_without_op_counts(spark):
    ops = cfg.config_ops(cfg.decode_config(_topic(spark, [
        (1, _cfg("c", T0)), (2, _cfg(None, T0, cols="id"))])))
    latest = cfg.latest_config(ops).collect()
    assert [(r["sink_columns"], r["op"]) for r in latest] == [("id", None)]
    iv = cfg.config_intervals(ops).orderBy("valid_from").collect()
    assert [(r["valid_from"], r["valid_to"]) for r in iv] == [(1, 2), (2, None)]


def test_poison_logs_are_quarantined(spark):
    def log(ts=T0, **more):
        return {"common": {"mid": "m", "is_new": "1"}, "page": {"p": 1}, "ts": ts, **more}
    raw = _topic(spark, [(1, log()), (2, log(ts=1_700_000_000_000_000)),
                         (3, log(ts=1_700_000_000_000_000_000)), (4, log(err="boom")),
                         (5, log(err={"c": 1})), (6, log(ts=-10**17)), (7, log(ts=-10**12))])
    assert {r["seq"] for r in logs.dirty_logs(raw).collect()} == {2, 3, 4, 6}
    fixed = logs.repair_new_visitors(logs.clean_logs(raw), "UTC").collect()
    assert {r["seq"] for r in fixed} == {1, 5, 7}
    assert spark.range(1).select(logs.ts_to_date(F.lit(10**18).cast("bigint"), "UTC")) \
        .first()[0] is None


def test_retry_with_another_config_leaves_nothing_behind(spark, scratch):
    ops, log, bad = (os.path.join(scratch, d) for d in ("ops", "log", "bad"))
    writer = DimBatchWriter(ops, log, bad, "shop")
    batch = _topic(spark, [(1, _chg(T0 + 10, 1, "a")), (2, _chg(T0 + 20, 2, "b"))])
    _ops(spark, ops, [(1, _cfg("c", T0))])
    writer(batch, 7)
    assert (spark.read.parquet(log).count(), spark.read.parquet(bad).count()) == (2, 0)
    _ops(spark, ops, [(2, _cfg("r", T0 + 1, key="missing"))])
    writer(batch, 7)  # the retry works with the version that the first attempt pinned
    assert (spark.read.parquet(log).count(), spark.read.parquet(bad).count()) == (2, 0)
    writer(batch, 8)  # a new batch routes to a key that the changes lack
    assert (spark.read.parquet(log).count(), spark.read.parquet(bad).count()) == (2, 2)


def _reset_between(spark, scratch, change_ts, name):
    """Changes, a reset of their table, later changes; batch by batch, in any clock."""
    ops, log, bad = (os.path.join(scratch, name + d) for d in ("ops", "log", "bad"))
    writer = DimBatchWriter(ops, log, bad, "shop")
    _ops(spark, ops, [(1, _cfg("c", T0))])
    writer(_topic(spark, [(1, _chg(change_ts(10), 1, "gone"))]), 0)
    _ops(spark, ops, [(2, _cfg("u", T0 + 50))])
    writer(_topic(spark, [(2, _chg(change_ts(60), 2, "kept")), (3, _chg(change_ts(60), 2, "last"))]), 1)
    return _cells(spark, log, ops)


def test_generations_need_no_common_clock(spark, scratch):
    want = {("2", "name"): "last", ("2", "id"): "2"}
    for name, ts in (("ms", lambda d: T0 + d), ("s", lambda d: (T0 + d) // 1000),
                     ("none", lambda d: None), ("ahead", lambda d: T0 + 10**9 + d)):
        assert _reset_between(spark, scratch, ts, name) == want


def test_generations_of_a_dropped_and_recreated_table(spark, scratch):
    ops, log, bad = (os.path.join(scratch, d) for d in ("ops", "log", "bad"))
    writer = DimBatchWriter(ops, log, bad, "shop")
    _ops(spark, ops, [(1, _cfg("c", T0))])
    writer(_topic(spark, [(1, _chg(T0, 1, "a"))]), 0)
    _ops(spark, ops, [(2, _cfg("c", T0 + 1)), (3, _cfg("r", T0 + 2))])  # it is there: no reset
    assert _cells(spark, log, ops) == {("1", "name"): "a", ("1", "id"): "1"}
    _ops(spark, ops, [(4, _cfg("d", T0 + 3))])
    assert _cells(spark, log, ops) == {}
    writer(_topic(spark, [(2, _chg(T0, 2, "lost"))]), 1)  # no config, no table
    _ops(spark, ops, [(5, _cfg("r", T0 + 4))])
    assert _cells(spark, log, ops) == {}
    writer(_topic(spark, [(3, _chg(T0, 3, "b"))]), 2)
    assert _cells(spark, log, ops) == {("3", "name"): "b", ("3", "id"): "3"}


def test_as_of_without_a_usable_time_is_quarantined(spark, scratch):
    ops, log, bad = (os.path.join(scratch, d) for d in ("ops", "log", "bad"))
    _ops(spark, ops, [(1, _cfg("c", T0))])
    rows = [(1, _chg((T0 + 10) // 1000 + 1, 1, "s")), (2, _chg(None, 2, "none")),
            (3, _chg(T0 + 10, 3, "ms")), (4, {**_chg(T0 + 10, 4, "k"), "data": {"name": "k"}})]
    DimBatchWriter(ops, log, bad, "shop", as_of=True)(_topic(spark, rows), 0)
    assert [r["row_key"] for r in spark.read.parquet(log).collect()] == ["3"]
    got = spark.read.parquet(bad).orderBy("reason", "seq").collect()
    assert [r["reason"] for r in got] == ["row key", "time", "time"]
    seconds = DimBatchWriter(ops, log + "s", bad + "s", "shop", as_of=True, unit="s")
    seconds(_topic(spark, rows), 0)
    assert [r["row_key"] for r in spark.read.parquet(log + "s").collect()] == ["1"]


def test_config_state_folds_like_the_history(spark, scratch):
    ops = os.path.join(scratch, "ops")
    feed = [(1, _cfg("c", T0)), (2, _cfg("u", T0 + 5, cols="id")), (3, _cfg("c", T0, src="b", sink="dim_b")),
            (4, _cfg("d", T0 + 9, src="b", sink="dim_b")), (5, _cfg(None, T0 + 9, sink="dim_c2")),
            (6, _cfg("r", T0 + 11, src="b", sink="dim_b")), (7, _cfg("d", T0 + 12)),
            (8, _cfg("c", None, src="e", sink="dim_c"))]
    for row in feed:
        _ops(spark, ops, [row])
    state = ConfigState(ops)
    v = state.version(spark)
    history = state.ops(spark, v)
    latest = cfg.latest_config(cfg.config_ops(history)).drop("op")
    kept = state.latest.read(spark, v).where("op is null or op <> 'd'").drop("op")
    assert sorted(map(tuple, kept.select(latest.columns).collect())) == \
        sorted(map(tuple, latest.collect()))
    life = {r["sink_table"]: (r["live"], r["reset_seq"]) for r in cfg.table_lifecycle(
        history.where("source_table <> 'e'")).collect()}
    tables = {r["sink_table"]: (r["live"], r["generation"])
              for r in state.tables.read(spark, v).collect()}
    assert tables.pop("dim_c")[0] and not life.pop("dim_c")[0]  # created again, without a time
    assert tables == life and len(tables) == 2
    ConfigBatchWriter(ops)(_topic(spark, feed[-1:]), v)  # a retried batch
    assert {r["sink_table"]: r["live"] for r in state.tables.read(spark, v).collect()}["dim_c"]


def test_old_config_versions_go(spark, scratch):
    ops = os.path.join(scratch, "ops")
    writer = ConfigBatchWriter(ops, keep=2)
    for i in range(5):
        writer(_topic(spark, [(i, _cfg("u", T0 + i, cols=f"id,c{i}"))]), i)
    state = ConfigState(ops)
    assert state.tables.versions(spark) == state.latest.versions(spark) == [3, 4]
    assert [r["sink_columns"] for r in state.latest.read(spark, 4).collect()] == ["id,c4"]


def test_snapshot_store_merges_touched_buckets_only(spark, scratch):
    ops, log, bad, snap = (os.path.join(scratch, d) for d in ("ops", "log", "bad", "snap"))
    writer = DimBatchWriter(ops, log, bad, "shop")
    store = SnapshotStore(snap, buckets=16)
    _ops(spark, ops, [(1, _cfg("c", T0))])

    def whole():
        return sorted(map(tuple, compact_snapshot(spark, log, ops).collect()))

    def kept():
        return sorted(map(tuple, store.cells(spark, ops).collect()))

    writer(_topic(spark, [(i, _chg(T0 + i, i, f"n{i}")) for i in range(200)]), 0)
    assert len(store.compact(spark, log, ops)) == 16 and kept() == whole() != []
    first, _ = store.table.files(spark)
    # an update, a delete and a row that comes back: three rows, three buckets at most
    writer(_topic(spark, [(300, _chg(T0, 5, "again")), (301, _chg(T0, 6, None, "delete")),
                          (302, _chg(T0, 7, None, "delete")), (303, _chg(T0 + 1, 7, "back"))]), 1)
    touched = store.compact(spark, log, ops)
    assert 1 <= len(touched) <= 3 and kept() == whole()
    second, _ = store.table.files(spark)
    assert {b for b in second if second[b] != first[b]} == set(touched)
    read = store.table.read(spark, touched).inputFiles()
    assert len(read) <= len(touched) < len(store.table.read(spark).inputFiles())
    assert store.compact(spark, log, ops) == []  # nothing new
    # a reset hides the table at once, before any compaction
    _ops(spark, ops, [(2, _cfg("u", T0 + 2))])
    assert kept() == whole() == []
    writer(_topic(spark, [(400, _chg(T0, 9, "new life"))]), 2)
    assert len(store.compact(spark, log, ops)) == 1
    assert kept() == whole() == [("dim_c", "9", "id", "9"), ("dim_c", "9", "name", "new life")]


def test_changes_before_the_first_config(spark, scratch):
    ops, log, bad = (os.path.join(scratch, d) for d in ("ops", "log", "bad"))
    DimBatchWriter(ops, log, bad, "shop")(_topic(spark, [(1, _chg(T0, 1, "a"))]), 0)
    assert spark.read.parquet(log).count() == 0
    preload = spark.createDataFrame([("customer", "dim_c", "id,name", "info", "id")],
                                    ", ".join(f"{f} string" for f in cfg.FIELDS))
    DimBatchWriter(ops, log, bad, "shop", preload=preload)(
        _topic(spark, [(1, _chg(T0, 1, "a"))]), 1)
    assert spark.read.parquet(log).count() == 1


def test_dimension_snapshot_as_dictionary(spark, scratch):
    ops, log, bad, snap, out = (os.path.join(scratch, d) for d in
                                ("ops", "log", "bad", "snap", "out"))
    _ops(spark, ops, [(1, _cfg("c", T0, cols="id,dic_name", sink="dim_dic", src="base_dic"))])
    change = {"database": "shop", "table": "base_dic", "type": "insert", "ts": T0 + 5,
              "data": {"id": "1201", "dic_name": "good"}}
    DimBatchWriter(ops, log, bad, "shop")(_topic(spark, [(1, change)]), 0)
    compact_snapshot(spark, log, ops).write.parquet(snap)

    def load(s):
        return cmt.dictionary_from_snapshot(s.read.parquet(snap), "dim_dic")

    writer = CommentBatchWriter(load, out, "shop", refresh_seconds=3600)
    comment = {"database": "shop", "table": "comment_info", "type": "insert", "ts": T0,
               "data": {"id": "9", "appraise": "1201", "comment_txt": "hm"}}
    writer(_topic(spark, [(1, comment), (2, {**comment, "type": "update"}), (3, "[1]")]), 0)
    load(spark).limit(0).write.mode("overwrite").parquet(snap)  # rewritten while it is kept
    writer(_topic(spark, [(4, comment)]), 1)
    got = spark.read.parquet(out).collect()
    assert [(r["id"], r["appraise_name"]) for r in got] == [("9", "good")] * 2


def test_repair_state_is_hash_aggregated(spark):
    """No log is sorted before the first exchange of the device state."""
    from rillflow.plans import queries as Q
    from tests.conftest import SF
    plan = Q.REGISTRY["visitor_fix"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_min_by" in plan
    state = plan[plan.index("HashAggregate(keys=[mid"):]
    assert "Sort [" not in state
