"""op9: components against all pairs of sets."""

import random

import numpy as np
import pytest

from rillflow.llm import ngram_join as J
from rillflow.llm.components import components, unite
from rillflow.llm.queries import REGISTRY
from tests.llm.fixtures import awkward_docs, docs_frame, with_clashes, write


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))) if w else frozenset()


def brute(rows):
    """(doc_id, n, component_id) over all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))),
                  key=repr)


def families(seed, n=40):
    """Texts with copies, near copies at all distances and shared passages."""
    rng = random.Random(seed)
    passage = " ".join(f"shared{k}" for k in range(30))
    rows, i = [], 0
    for _ in range(n):
        words = [f"v{rng.randrange(400)}" for _ in range(rng.choice([3, 4, 5, 20, 60, 150]))]
        for _ in range(rng.randrange(1, 7)):
            out = list(words)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
            text = " ".join(out) + (" " + passage if rng.random() < 0.4 else "")
            rows.append((i * 37 % 1009, text.upper() if rng.random() < 0.2 else text))
            i += 1
    return rows


@pytest.mark.parametrize("seed, small", [(1, False), (2, True)])
def test_families(spark, monkeypatch, seed, small):
    rows = families(seed) + [(None, "v1 v2 v3 v4"), (None, None), (2000, ""), (2001, " \t"),
                             (2002, "V1 v2 v3 v4"), (2002, "other text here now"), (2003, "one")]
    if small:  # many buckets and packs, groups cut into chunks
        monkeypatch.setattr(J, "BUCKET_TOKENS", 500)
        monkeypatch.setattr(J, "PACK_TOKENS", 700)
        monkeypatch.setattr(J, "GROUP", 4)
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string")).repartition(3)
    got = J.with_components(df).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)
    assert len({g["component_id"] for g in got}) < len(got) - 15


@pytest.mark.parametrize("group", [2_000, 4])
def test_links_are_counted(spark, monkeypatch, group):
    monkeypatch.setattr(J, "GROUP", group)
    many = " ".join(f"c{k}" for k in range(60))  # a group of mutually linked texts
    rows = families(5, 15) + [(3000 + i, f"{many} end{i}") for i in range(12)]
    rows += [(None, "v1 v2 v3 v4"), (4000, None), (4001, "one"), (4002, "ONE")]
    sets = [shingles(t) for _, t in rows]
    want = sorted(((d, sum(i != j and bool(a and b) and 100 * len(a & b) >= 85 * len(a | b)
                           for j, b in enumerate(sets)))
                   for i, ((d, _), a) in enumerate(zip(rows, sets))), key=repr)
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = J.with_links(df)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert sorted(((r["doc_id"], r["n_links"]) for r in got.collect()), key=repr) == want
    assert dict(want)[3000] == 11


def test_query_on_documents(spark, scratch):
    rows = awkward_docs()
    sf = write(docs_frame(spark), scratch + "/d", "documents")
    got = REGISTRY["op9_ngram_join"](spark, sf)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert sorted(map(tuple, got.drop("n_links").collect()), key=repr) == \
        brute([r[:2] for r in rows])


def test_one_of_each(spark):
    rows = families(3, 15) + [(None, "v1 v2 v3 v4"), (5000, None), (5000, ""), (5001, "a b c d e"),
                              (5001, "a b c d e"), (5001, "q r s t u"), (None, "q r s t u")]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = J.one_of_each(df)
    assert got.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    n_empty = sum(not shingles(t) for _, t in rows)
    with_sets = [(i, t) for i, t in kept if shingles(t)]
    # one of each component, and no two of those that stay are linked
    brute_rows = [(k, t) for k, (_, t) in enumerate(rows)]
    assert len(with_sets) == len({c for _, n, c in brute(brute_rows) if n})
    assert len(kept) == len(with_sets) + n_empty and set(kept) <= set(rows)
    assert (5001, "q r s t u") in kept and (None, "q r s t u") not in kept
    assert J.one_of_each(df.limit(0)).collect() == []
    assert J.with_components(df.limit(0)).collect() == []


def test_search_alone():
    rng = random.Random(7)
    for _ in range(20):
        base = [rng.sample(range(300), rng.randrange(5, 60)) for _ in range(6)]
        sets = []
        for b in base:
            for _ in range(4):
                s = set(b)
                for _ in range(rng.randrange(0, 6)):
                    s.discard(rng.choice(b))
                    s.add(rng.randrange(300, 900))
                sets.append(np.array(sorted(s), dtype=np.int64))
        sets.sort(key=len)
        label = J.search(np.array([len(s) for s in sets]), sets)
        want = np.arange(len(sets))
        for i, a in enumerate(sets):
            for j in range(i):
                o = len(np.intersect1d(a, sets[j]))
                if 100 * o >= 85 * (len(a) + len(sets[j]) - o):
                    want = unite(want, np.array([i]), np.array([j]))
        assert (label == want).all()


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(30)]
    links += [(7, 7), (1, 0), (200, 201), (200, 201), (41 + 5, 46)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    root = {x: x for e in links for x in e}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        p, q = sorted((find(a), find(b)))
        root[q] = p
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
