"""Batch forms of the stateful operators equal a record-at-a-time simulation
of the reference's rules (property tests)."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillflow.operators import carry
from rillflow.operators import changes as chg
from rillflow.operators import config as cfg
from rillflow.operators import dims, logs
from rillflow.operators.carry import asof_join, next_in_group, previous_in_group, ranges

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 UTC


def _date(ms):
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).strftime("%Y-%m-%d")


def simulate_visitors(rows):
    """STA-1 state machine over rows in (ts, seq) order."""
    state, out = {}, {}
    for seq, mid, flag, ts in sorted(rows, key=lambda r: (r[3], r[0])):
        d, s = _date(ts), state.get(mid)
        if flag == "1":
            if s is not None and s != d:
                out[seq] = "0"
            else:
                out[seq] = "1"
                state.setdefault(mid, d)
        elif flag == "0":
            if s is None:
                state[mid] = _date(ts - DAY)
            out[seq] = "0"
        else:
            out[seq] = flag
    return out


visitor_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from(["0", "1", "x"]),
              st.integers(0, 4 * DAY)),
    min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.too_slow,
                                                                  HealthCheck.function_scoped_fixture])
@given(visitor_rows)
def test_visitor_repair_equals_state_machine(spark, rows):
    rows = [(i, mid, flag, T0 + off) for i, (mid, flag, off) in enumerate(rows)]
    raw = spark.createDataFrame(
        [(seq, json.dumps({"common": {"mid": mid, "is_new": flag}, "page": {}, "ts": ts}))
         for seq, mid, flag, ts in rows], "seq long, value string")
    got = {r["seq"]: r["fixed_is_new"] for r in
           logs.repair_new_visitors(logs.clean_logs(raw), "UTC").collect()}
    assert got == simulate_visitors(rows)


def _java_split(text):
    """String.split(",") as the reference's runtime does it."""
    if text == "":
        return [""]
    parts = text.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def simulate_dims(events, preload):
    """Config ops and changes applied one by one in seq order (JOI-1, JOI-2,
    SNK-2, SNK-3, STA-2, STA-4), including table creation by family list: no
    family -> nothing created; a missing or empty family name -> the creation
    raises and the op never reaches routing (a drop before it still happened)."""
    config = {c["source_table"]: c for c in preload}
    tables = {}

    def create(c):
        fams = _java_split(c["sink_family"]) if c["sink_family"] is not None else None
        if fams is None or "" in fams:
            raise ValueError("bad family")
        if fams:
            tables.setdefault(c["sink_table"], {})

    for ev in sorted(events, key=lambda e: e["seq"]):
        if ev["kind"] == "cfg":
            c, op = ev["cfg"], ev["op"]
            try:
                if op == "d":
                    tables.pop(c["sink_table"], None)
                elif op in ("c", "r"):
                    create(c)
                else:
                    tables.pop(c["sink_table"], None)
                    create(c)
            except ValueError:
                continue
            if op == "d":
                config.pop(c["source_table"], None)
            else:
                config[c["source_table"]] = c
            continue
        c = config.get(ev["table"])
        if c is None:
            continue
        cols = c["sink_columns"].split(",")
        data = {k: v for k, v in ev["data"].items() if k in cols}
        rk = data.get(c["sink_row_key"])
        if rk is None or c["sink_table"] not in tables:
            continue
        table = tables[c["sink_table"]]
        if ev["type"] == "delete":
            table.pop(rk, None)
        else:
            row = table.setdefault(rk, {})
            row.update({k: v for k, v in data.items() if v is not None})
    return {(t, rk, k, v) for t, rows in tables.items() for rk, row in rows.items()
            for k, v in row.items()}


def _cfg(src, cols, family="info"):
    return {"source_table": src, "sink_table": "dim_" + src, "sink_columns": cols,
            "sink_family": family, "sink_row_key": "id"}


dim_events = st.lists(st.one_of(
    st.tuples(st.just("cfg"), st.sampled_from(["c", "r", "u", "d"]),
              st.sampled_from(["t1", "t2"]), st.sampled_from(["id,a", "id,a,b", "a,b"]),
              st.sampled_from(["info", "info", "info", "", None, ",", "a,,b", "a,"])),
    st.tuples(st.just("chg"), st.sampled_from(["insert", "update", "delete", None]),
              st.sampled_from(["t1", "t2", "t3"]),
              st.tuples(st.sampled_from(["1", "2", "3"]), st.sampled_from(["x", "y", None]),
                        st.sampled_from(["p", None])))),
    min_size=1, max_size=50)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.too_slow,
                                                                  HealthCheck.function_scoped_fixture])
@given(dim_events, st.booleans())
def test_dim_snapshot_equals_sequential_simulation(spark, evs, with_preload):
    events, change_rows, config_rows = [], [], []
    for i, ev in enumerate(evs):
        seq = i + 1
        if ev[0] == "cfg":
            _, op, src, cols, family = ev
            c = _cfg(src, cols, family)
            events.append({"kind": "cfg", "seq": seq, "op": op, "cfg": c})
            env = {"op": op, "before": c if op == "d" else None, "after": None if op == "d" else c}
            config_rows.append((seq, json.dumps(env)))
        else:
            _, typ, table, (rid, a, b) = ev
            data = {"id": rid, "a": a, "b": b}
            events.append({"kind": "chg", "seq": seq, "table": table, "type": typ,
                           "data": data})
            change_rows.append((seq, json.dumps({"database": "shop", "table": table,
                                                 "type": typ, "data": data})))
    preload = [_cfg("t1", "id,a,b")] if with_preload else []
    expected = simulate_dims(events, preload)

    schema = "seq long, value string"
    decoded = cfg.decode_config(spark.createDataFrame(config_rows, schema))
    pre = (spark.createDataFrame([tuple(c[f] for f in cfg.FIELDS) for c in preload],
                                 ", ".join(f"{f} string" for f in cfg.FIELDS))
           if preload else None)
    ops = cfg.config_ops(decoded, cfg.camel_columns(pre) if pre is not None else None)
    changes = chg.clean_changes(chg.parse_changes(spark.createDataFrame(change_rows, schema)),
                                "shop")
    # both plans of the as-of joins: broadcast lists, and ranges with carry
    for limit in (None, 0):
        keyed = dims.with_row_key(dims.prune_columns(dims.route_changes(changes, ops, limit)))
        stamped = dims.with_generation(keyed, cfg.generations(decoded, limit or 10**6), limit)
        snap = dims.dim_snapshot(dims.apply_lifecycle(stamped, cfg.table_lifecycle(decoded)))
        got = {tuple(r) for r in snap.collect()}
        assert got == expected


def _last_version(facts, versions):
    out = []
    for k, pos in facts:
        earlier = [v for v in versions if v[0] == k and v[1] < pos] if k is not None else []
        if earlier:
            last = max(earlier, key=lambda v: v[1])
            if last[2] is not None:
                out.append((k, pos, last[2]))
    return sorted(out)


@pytest.mark.parametrize("limit", [None, 0])
def test_asof_join_with_clumps_and_hot_keys(spark, limit):
    """A key with most facts, another with most versions, at clumped positions."""
    import random
    rnd = random.Random(4)
    versions = [("hot", p, None if p % 7 == 0 else f"h{p}") for p in
                list(range(1000, 1300)) + [10**9, 10**9 + 1, 2 * 10**9]]
    versions += [("one", 5, "o"), ("gone", 1, "g"), ("gone", 2, None), (None, 1, "null")]
    facts = [("hot", rnd.choice([999, 1000, 1001, 1150, 1299, 1300, 10**9, 10**9 + 1, 3 * 10**9]))
             for _ in range(300)] + [("one", p) for p in range(0, 2000, 3)]
    facts += [("gone", 1), ("gone", 2), ("gone", 9), (None, 5), ("none", 5), ("hot", None)]
    f = spark.createDataFrame(facts, "k string, pos long").repartition(3)
    v = spark.createDataFrame(versions, "key string, at long, tag string").repartition(3)
    got = asof_join(f, v, "k", "key", "pos", "at", ["tag"],
                    in_force=F.col("tag").isNotNull(), limit=limit)
    want = _last_version([x for x in facts if x[1] is not None], versions)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 700


@pytest.mark.parametrize("kind", ["long", "decimal(38,0)"])
def test_asof_join_in_pieces(spark, kind):
    """Lists cut into pieces, and copied for crowds of facts, at positions from the least long
    (or a decimal) on; versions that come twice; facts on both sides of each cut."""
    far = 1 << 80 if kind != "long" else 10**12
    ats = [cfg.MIN_SEQ, *range(0, 300, 3), *range(far, far + 300, 3)]
    versions = [(k, p, None if p % 7 == 0 else f"{k}{p}") for k in ("a", "b") for p in ats]
    versions += [("one", 5, "o"), ("unmet", 5, "u")]
    facts = [(k, p + d) for k, p in (("a", p) for p in ats[1:]) for d in (0, 1, 3)]
    facts += [("one", p) for p in range(300)] + [("b", far + 10**6), ("b", cfg.MIN_SEQ)]
    as_pos = lambda rows: [(r[0], Decimal(r[1]), *r[2:]) if kind != "long" else r
                           for r in rows]
    f = spark.createDataFrame(as_pos(facts), f"k string, pos {kind}").repartition(3)
    v = spark.createDataFrame(as_pos(versions) * 2, f"key string, at {kind}, tag string")
    got = asof_join(f, v, "k", "key", "pos", "at", ["tag"], in_force=F.col("tag").isNotNull(),
                    limit=0, list_rows=20, list_facts=25)
    assert sorted((r["k"], int(r["pos"]), r["tag"]) for r in got.collect()) \
        == _last_version(facts, versions)


def test_asof_join_moves_only_versions_that_facts_meet(spark, monkeypatch):
    """Versions of other keys are neither written nor merged with the facts."""
    wrote = []
    real = carry.materialize
    monkeypatch.setattr(carry, "materialize", lambda df, name: wrote.append(
        (name, real(df, name))) or wrote[-1][1])
    f = spark.range(100).select(F.lit("k").alias("k"), F.col("id").alias("pos"))
    v = spark.range(5000).select(F.concat(F.lit("v"), "id").alias("key"),
                                 F.col("id").alias("at"), F.lit("x").alias("tag"))
    v = v.unionByName(spark.range(10).select(F.lit("k").alias("key"), F.col("id").alias("at"),
                                             F.lit("y").alias("tag")))
    got = asof_join(f, v, "k", "key", "pos", "at", ["tag"], limit=100)
    assert got.count() == 99
    assert sum(df.count() for _, df in wrote) <= 100 + 10


def test_asof_ranges_stay_even_for_one_key(spark):
    """A single key at clumped positions still spreads over all ranges."""
    rows = spark.range(20_000).select(F.lit("k").alias("k"), F.when(
        F.col("id") < 19_000, F.col("id")).otherwise(F.col("id") * 10**12).alias("p"))
    n = [r["count"] for r in ranges(rows, "k", "p").groupBy("_range").count().collect()]
    assert len(n) == 4 and max(n) < 10_000


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.too_slow,
                                                                 HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["h", "h", "h", "x", "y"]),
                          st.integers(-50, 500)), min_size=1, max_size=80, unique_by=lambda t: t))
def test_neighbours_in_group_equal_lead_and_lag(spark, rows):
    from pyspark.sql import Window
    rows = rows + [("h", cfg.MIN_SEQ)]
    df = spark.createDataFrame(rows, "k string, s long")
    w = Window.partitionBy("k").orderBy("s")
    exp = sorted(df.select("k", "s", F.lead("s").over(w), F.lag("s").over(w)).collect(), key=repr)
    for most in (3, 10**6):
        got = next_in_group(df, "k", "s", "nxt", most)
        got = previous_in_group(got, "k", "s", "s", "prv", most)
        assert sorted(got.select("k", "s", "nxt", "prv").collect(), key=repr) == exp
