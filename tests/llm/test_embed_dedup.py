"""op7: links and components against all pairs in double precision."""

import numpy as np

from rillflow.llm import embed_dedup as E
from rillflow.llm.queries import REGISTRY
from tests.llm.fixtures import SF, with_clashes

NAN, INF = float("nan"), float("inf")


def brute(rows, threshold):
    ok = [i for i, (vid, v) in enumerate(rows) if vid is not None and v and None not in v
          and np.isfinite(v).all() and any(v)]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    links = [0] * len(rows)
    for x, i in enumerate(ok):
        for j in ok[x + 1:]:
            a, b = (np.asarray(rows[k][1], np.float64) for k in (i, j))
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    low = {}
    for i, (vid, _) in enumerate(rows):
        r = find(i)
        low[r] = vid if r not in low else min(low[r], vid)
    return sorted(((vid, links[i], low[find(i)], vid is not None and vid == low[find(i)])
                   for i, (vid, _) in enumerate(rows)), key=repr)


def test_clusters_tiles_and_odd_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows, vid = [], 0
    for _ in range(12):  # chains and clusters around the threshold
        c = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 9))):
            v = c + rng.normal(size=16) * rng.choice([0.0, 0.12, 0.25])
            rows.append((vid * 7 % 101, [float(np.float32(x)) for x in v]))
            vid += 1
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [NAN] + [1.0] * 15),
             (504, [INF] + [1.0] * 15), (505, [None] + [1.0] * 15), (None, rows[0][1]),
             (506, rows[0][1]), (507, [3 * x for x in rows[0][1]]), (508, rows[0][1]),
             (508, rows[0][1]), (508, rows[40][1]), (509, [1.0, 0.0]), (510, [1.0, 1e-3]),
             (511, [1e30] * 16), (512, [1e-30] * 16), (513, [-1e-30] * 16)]
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    want = brute(rows, 0.95)
    monkeypatch.setattr(E, "_SUB", 5)
    for tile in (7, 8192):
        got = E.near_duplicates(df, tile=tile).collect()
        assert sorted(map(tuple, got), key=repr) == want
    assert sum(w[1] for w in want) > 30
    assert E.near_duplicates(df.limit(0)).collect() == []


def test_error_bound_holds():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 48))
    x[:20] *= 10.0 ** rng.integers(-4, 4, size=(20, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, e = E.quantise(x)
    off = np.abs((q @ q.T) * s[:, None] * s[None, :] - x @ x.T)
    assert (off <= e[:, None] + e[None, :] + e[:, None] * e[None, :] + 1e-9).all()


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet")
            .select("vec_id", "embedding").collect()]
    got = REGISTRY["op7_embedding_dedup"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 0.95)
