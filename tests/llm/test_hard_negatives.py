"""op12: hard negatives against every pair, scored one by one."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillflow.llm import blocks, hard_negatives as H
from rillflow.llm.queries import REGISTRY
from tests.llm.fixtures import SF, with_clashes, write

NAN, INF = float("nan"), float("inf")
WHOLE = "vec_id long, label int, embedding array<bigint>"


def plain(rows, k=5, m=5, low=80, by=100):
    ok = [(i, vid, lab, v) for i, (vid, lab, v) in enumerate(rows)
          if vid is not None and lab is not None and v and None not in v]
    out = []
    for i, aid, lab, a in ok:
        if aid % by:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), vid, j, other)
                        for j, vid, other, v in ok if j != i and len(v) == len(a))
        for p, pid, _, _ in [s for s in scored if s[3] == lab][:k]:
            window = [s for s in scored if s[3] != lab and low * -p <= -100 * s[0] <= 100 * -p]
            out += [(aid, pid, r, nid, -p, -s) for r, (s, nid, _, _) in enumerate(window[:m], 1)]
    return sorted(out)


def columns(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id",
                                       "positive_score", "negative_score").collect()))


def odd_rows():
    rng = np.random.default_rng(11)
    rows = []
    for i in range(700):  # clusters that share directions, so that windows are full
        base = rng.integers(0, 40, size=6) if i % 3 else np.array([30, 20, 25, 5, 9, 12])
        rows.append((i, int(rng.integers(0, 3)) if i % 4 else 1,
                     [int(x) for x in base + rng.integers(-3, 4, size=6)]))
    rows += [(700, 1, rows[100][2]), (700, 1, rows[100][2]), (700, 2, rows[100][2]),
             (800, None, [1] * 6), (900, 1, None), (1000, 1, [1, None, 1, 1, 1, 1]),
             (None, 1, [9] * 6), (1100, 1, [0] * 6), (1200, 2, [-30] * 6), (1300, 7, [40] * 6),
             (1400, 1, [5, 6]), (1401, 2, [5, 5]), (1402, 1, [6, 5]), (1500, 1, []), (-100, 0, [33] * 6)]
    return rows


def test_equals_all_pairs_for_any_grid(spark, monkeypatch):
    rows = odd_rows()
    df = with_clashes(spark.createDataFrame(rows, WHOLE)).repartition(6)
    want = plain(rows)
    assert len(want) > 150 and len({w[0] for w in want}) > 6
    for block, share, side, tile in ((4096, 4096, 256, 4096), (3, 50, 2, 7), (1, 700, 3, 100)):
        monkeypatch.setattr(blocks, "LEAST_ROWS", share)
        monkeypatch.setattr(H, "_SIDE", side)
        monkeypatch.setattr(H._Combiner.__init__, "__defaults__", (tile,))
        assert columns(H.mine(df, F.col("vec_id") % 100 == 0, block=block)) == want


def test_scores_beyond_doubles_and_beyond_63_bits(spark):
    big = (1 << 27) + 1
    rows = [(0, 1, [big, 1, big]), (1, 1, [big, 3, big]), (2, 2, [big, 2, big]), (3, 2, [big, 3, big])]
    got = H.mine(spark.createDataFrame(rows, WHOLE), F.col("vec_id") == 0)
    assert columns(got) == plain(rows, by=100) and len(columns(got)) == 2
    with pytest.raises(ValueError):
        H.mine(spark.createDataFrame([(0, 1, [1 << 40])], WHOLE), F.col("vec_id") == 0)


def test_empty_tables_and_lone_labels(spark):
    assert H.mine(spark.createDataFrame([], WHOLE), F.col("vec_id") % 100 == 0).collect() == []
    lone = spark.createDataFrame([(0, 1, [3, 4]), (1, 2, [3, 4])], WHOLE)
    assert H.mine(lone, F.col("vec_id") % 100 == 0).collect() == []


def test_query_with_odd_rows(spark, scratch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet")
            .select("vec_id", "label", "embedding").collect()]
    rows += [(500, None, [1.0] * 64), (600, 1, None), (700, 1, [NAN] + [1.0] * 63),
             (800, 1, [INF] + [1.0] * 63), (900, 1, [None] + [1.0] * 63), (None, 1, [1.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    write(with_clashes(df), scratch, "embeddings")
    whole = [(v, lab if lab is None or v is None or v % 7 else (lab + 1) % 10,
              e and None not in e and all(map(math.isfinite, e)) and [math.floor(256 * x) for x in e]
              or None) for v, lab, e in rows]
    got = columns(REGISTRY["op12_hard_negatives"](spark, scratch))
    assert got == plain(whole) and got
