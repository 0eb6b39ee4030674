"""Edge rows of FIXTURES.md section 4."""

import json

import pytest

from pyspark.sql import functions as F

from rillflow.functions import dates
from rillflow.operators import changes as chg
from rillflow.operators import config as cfg
from rillflow.operators import dims, logs

GOOD = {"common": {"mid": "m1", "is_new": "1"}, "page": {"page_id": "p"}, "ts": 1700000000000}


def _raw(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "seq long, value string")


def _seqs(df):
    return sorted(r["seq"] for r in df.select("seq").collect())


def test_unparseable_messages_are_quarantined(spark):
    raw = _raw(spark, ["x", '{"a":1', "[1]", "null", "", None, json.dumps(GOOD)])
    assert _seqs(logs.dirty_logs(raw)) == [0, 1, 2, 3, 4, 5]
    assert _seqs(logs.clean_logs(raw)) == [6]


def test_page_presence(spark):
    base = {k: v for k, v in GOOD.items() if k != "page"}
    vals = [json.dumps(base), json.dumps({**base, "page": None}),
            json.dumps({**base, "page": [1]}), json.dumps({**base, "page": "text"}),
            json.dumps({**base, "page": {}})]
    raw = _raw(spark, vals)
    assert _seqs(logs.clean_logs(raw)) == [4]
    # wrong types are key-type failures, a missing or null key is not
    assert _seqs(logs.dirty_logs(raw)) == [2, 3]


def test_ts_as_text(spark):
    raw = _raw(spark, [json.dumps({**GOOD, "ts": "1700"}), json.dumps({**GOOD, "ts": "x"})])
    clean = logs.clean_logs(raw).collect()
    assert [(r["seq"], r["ts"]) for r in clean] == [(0, 1700)]
    assert _seqs(logs.dirty_logs(raw)) == [1]


def test_duplicate_keys_last_wins(spark):
    raw = _raw(spark, ['{"common":{"mid":"a","mid":"b","is_new":"1"},"page":{},'
                       '"ts":1,"ts":2}'])
    r = logs.clean_logs(raw).collect()[0]
    assert (r["mid"], r["ts"]) == ("b", 2)


def _split(spark, rec):
    raw = _raw(spark, [json.dumps(rec)])
    out = logs.split_log(logs.repair_new_visitors(logs.clean_logs(raw), "UTC")).collect()
    return [(r["channel"], json.loads(r["value"])) for r in out]


def test_display_not_an_array_and_null_elements(spark):
    out = _split(spark, {**GOOD, "displays": "oops"})
    assert [c for c, _ in out] == ["page"]
    out = _split(spark, {**GOOD, "displays": [None, {"item": "a", "ts": 5}, 3]})
    disp = [v for c, v in out if c == "display"]
    assert len(disp) == 1
    assert disp[0]["ts"] == GOOD["ts"] and disp[0]["page"] == GOOD["page"]
    assert disp[0]["common"]["mid"] == "m1"
    raw = _raw(spark, [json.dumps({**GOOD, "displays": [None, {"item": "a"}, 3]})])
    assert logs.dropped_elements(logs.clean_logs(raw)).collect()[0]["dropped"] == 2


def test_start_wins_over_page(spark):
    rec = {**GOOD, "start": {"entry": "e"}, "displays": [{"item": "a"}],
           "err": {"error_code": 1}}
    out = _split(spark, rec)
    chans = sorted(c for c, _ in out)
    assert chans == ["err", "start"]
    start = [v for c, v in out if c == "start"][0]
    assert "err" not in start and "displays" in start
    assert [v for c, v in out if c == "err"][0] == {"error_code": 1}


def test_page_row_drops_err_displays_actions_and_nulls(spark):
    rec = {**GOOD, "displays": [], "actions": [{"a": 1}], "err": {"e": 1}, "x": None}
    out = _split(spark, rec)
    page = [v for c, v in out if c == "page"][0]
    assert sorted(page) == ["common", "page", "ts"]
    assert sorted(c for c, _ in out) == ["action", "err", "page"]


def test_change_with_null_type_is_a_put(spark):
    vals = [json.dumps({"database": "shop", "table": "t", "type": None, "data": {"id": 1}}),
            json.dumps({"database": "shop", "table": "t", "type": "bootstrap-start",
                        "data": {"id": 1}}),
            json.dumps({"database": "shop", "table": "t", "type": "insert", "data": {}}),
            json.dumps({"database": "other", "table": "t", "type": "insert",
                        "data": {"id": 1}}),
            "not json"]
    clean = chg.clean_changes(chg.parse_changes(_raw(spark, vals)), "shop")
    assert _seqs(clean) == [0]


def _route(spark, sink_columns, row_key="id"):
    changes = chg.parse_changes(_raw(spark, [json.dumps(
        {"database": "shop", "table": "t", "type": "insert", "data": {"id": 1, "name": "n"}})]))
    ops = spark.createDataFrame(
        [(-1, "r", "t", "dim_t", sink_columns, "info", row_key)],
        "seq long, op string, " + ", ".join(f"{f} string" for f in cfg.FIELDS))
    return dims.with_row_key(dims.prune_columns(dims.route_changes(changes, cfg.config_ops(ops))))


def test_row_key_pruned_away_is_quarantined(spark):
    keyed = _route(spark, "name")
    assert keyed.collect()[0]["row_key"] is None
    assert dims.bad_row_keys(keyed).count() == 1
    assert dims.dim_snapshot(keyed).count() == 0


def test_sink_columns_are_not_trimmed(spark):
    keyed = _route(spark, "id, name")
    assert sorted(keyed.collect()[0]["data"]) == ["id"]


def test_date_functions(spark):
    df = spark.createDataFrame([("2023-11-15 06:13:20", "2023-11-15", 1700000000123)],
                               "dt string, d string, ts long")
    r = df.select(dates.datetime_to_ts("dt").alias("a"), dates.date_to_ts("d").alias("b"),
                  dates.datetime_to_ts(F.lit("bad")).alias("c"),
                  dates.ts_to_datetime("ts", "Asia/Shanghai").alias("e"),
                  dates.ts_to_date("ts", "UTC").alias("f"),
                  dates.ts_to_date_partition("ts", "UTC").alias("g"),
                  dates.prev_day("ts", "UTC").alias("h")).collect()[0]
    assert r["a"] == 1700000000000 and r["b"] == 1699977600000 and r["c"] is None
    assert r["e"] == "2023-11-15 06:13:20"
    assert (r["f"], r["g"], r["h"]) == ("2023-11-14", "20231114", "2023-11-13")


def test_config_table_from_files_renamed_to_camel(spark, scratch):
    import os
    path = os.path.join(scratch, "cfg")
    spark.createDataFrame([("a", "dim_a", "id", "info", "id")],
                          ", ".join(f"{f} string" for f in cfg.FIELDS)).write.parquet(path)
    df = cfg.read_config_table(spark, path=path)
    assert df.columns == ["sourceTable", "sinkTable", "sinkColumns", "sinkFamily", "sinkRowKey"]
    assert cfg.to_camel("a_a") == "aA" and cfg.to_camel("a_aaaa_aa") == "aAaaaAa"


def _ops(spark, rows):
    raw = spark.createDataFrame(
        [(seq, json.dumps({"op": op, "before": cfgd if op == "d" else None,
                           "after": None if op == "d" else cfgd}))
         for seq, op, cfgd in rows], "seq long, value string")
    return cfg.decode_config(raw)


def _c(fam, sink="dim_t", src="t"):
    return {"source_table": src, "sink_table": sink, "sink_columns": "id",
            "sink_family": fam, "sink_row_key": "id"}


def test_table_needs_a_family(spark):
    lc = {r["sink_table"]: (r["live"], r["reset_seq"]) for r in cfg.table_lifecycle(_ops(spark, [
        (1, "c", _c("info", "a")), (2, "u", _c("", "a")),        # u drops, create fails
        (3, "c", _c(None, "b")),                                   # never created
        (4, "c", _c("info", "c")), (5, "r", _c(",", "c")),        # no-op on existing
        (6, "c", _c("x,,y", "d")), (7, "c", _c("x,y,", "d")),     # 7 creates
    ])).collect()}
    assert lc["a"][0] is False
    assert "b" not in lc or lc["b"][0] is False
    assert lc["c"] == (True, 4)
    assert lc["d"] == (True, 7)
    ops = cfg.config_ops(_ops(spark, [(1, "c", _c("info")), (2, "u", _c(None)),
                                      (3, "u", _c(","))]))
    # the op whose creation raises never reaches routing; the empty list does
    assert sorted(r["seq"] for r in ops.collect()) == [1, 3]


def test_resets_switchable_off(spark):
    keyed = spark.createDataFrame([(5, "dim_t", "k", 2)], "seq long, sink_table string, "
                                  "row_key string, generation long")
    lc = spark.createDataFrame([("dim_t", True, 9)], "sink_table string, live boolean, reset_seq long")
    assert dims.apply_lifecycle(keyed, lc).count() == 0
    assert dims.apply_lifecycle(keyed, lc, resets=False).count() == 1


def test_tables_are_released(spark):
    from rillflow import session
    kept, session._WRITTEN[:] = list(session._WRITTEN), []
    df = session.materialize(spark.range(3), "some")
    other = session.written(spark.range(2), "other")
    assert df.count() == 3 and spark.read.parquet(other).count() == 2
    assert session.release_tables(spark) == 2 and session.release_tables(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(other).count()
    session._WRITTEN[:] = kept


def test_size_for_input(spark):
    from rillflow.session import size_for_input
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        s = size_for_input(spark, 100 << 40)  # 100 TB
        assert int(s["spark.sql.shuffle.partitions"]) == 409600
        assert int(size_for_input(spark, 1 << 30)["spark.sql.shuffle.partitions"]) == 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold")
