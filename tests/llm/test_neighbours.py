"""op13: nearest neighbours against all pairs in double precision."""

import math

import numpy as np

from rillflow.llm import blocks, neighbours as N
from rillflow.llm.queries import REGISTRY
from pyspark.sql import functions as F
from tests.llm.fixtures import SF, with_clashes

NAN, INF = float("nan"), float("inf")
SCHEMA = "vec_id long, embedding array<float>"


def f32(v):
    return [float(np.float32(x)) for x in v]


def plain(rows, k=5, by=50):
    ok = [(i, vid, [float(x) for x in v]) for i, (vid, v) in enumerate(rows)
          if vid is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]

    def size(v):
        total = 0.0
        for x in v:
            total += x * x
        return math.sqrt(total)

    sizes = {i: size(v) for i, _, v in ok}
    out = []
    for i, qid, q in ok:
        if qid % by:
            continue
        found = []
        for j, vid, v in ok:
            if j != i and len(v) == len(q):
                dot = 0.0
                for a, b in zip(q, v):
                    dot += a * b
                found.append((-(dot / (sizes[i] * sizes[j])), vid))
        out += [(qid, r, vid, -s) for r, (s, vid) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def awkward():
    rng = np.random.default_rng(3)
    rows = [(i, f32(rng.normal(size=12))) for i in range(400)]
    hub = rows[50][1]
    rows += [(1000 + i, hub) for i in range(60)] + [(0, rows[3][1]), (0, rows[3][1])]
    rows += [(2000 + i, f32(np.asarray(hub) + rng.normal(size=12) * 1e-4)) for i in range(40)]
    rows += [(3000, None), (3050, []), (3100, [0.0] * 12), (3150, [NAN] + [1.0] * 11),
             (3200, [None] + [1.0] * 11), (3250, [INF] + [1.0] * 11), (None, hub), (3300, [1.0, 2.0]),
             (3301, [-1.0, 2.0]), (3350, [0.5]), (3400, f32([4 * x for x in hub])),
             (-50, f32([-x for x in hub]))]
    return rows


def test_equals_all_pairs_in_small_and_large_tiles(spark, monkeypatch):
    rows = awkward()
    df = with_clashes(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    want = plain(rows)
    assert len({w[0] for w in want}) > 12 and any(w[3] == 1.0 for w in want)
    for side, tile, block, share in ((512, 4096, 4096, 4096), (3, 7, 4, 40), (2, 3, 1, 1000)):
        monkeypatch.setattr(N, "_SIDE", side)
        monkeypatch.setattr(N, "_TILE", tile)
        monkeypatch.setattr(blocks, "LEAST_ROWS", share)
        got = N.nearest(df, F.col("vec_id") % 50 == 0, block=block)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == want


def test_huge_and_tiny_components(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e-200, 2e-200]), (2, [-1e300, 0.0]), (3, [1e-320, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, round(r.score, 9)) for r in
           N.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(1, round(3 / math.sqrt(10), 9)), (3, round(0.5 ** 0.5, 9)),
                   (2, -round(0.5 ** 0.5, 9))]


def test_empty_and_single(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert N.nearest(none, F.col("vec_id") % 50 == 0).collect() == []
    one = spark.createDataFrame([(0, [1.0, 2.0])], SCHEMA)
    assert N.nearest(one, F.col("vec_id") % 50 == 0).collect() == []


def test_error_bound_holds():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 48))
    x[:20] *= 10.0 ** rng.integers(-4, 4, size=(20, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, e = N.quantised(x)
    off = np.abs((q @ q.T) * s[:, None] * s[None, :] - x @ x.T)
    assert (off <= e[:, None] + e[None, :] + e[:, None] * e[None, :] + N._SLACK).all()


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    got = REGISTRY["op13_nearest_neighbours"](spark, SF).collect()
    assert sorted(map(tuple, got)) == plain(rows)
