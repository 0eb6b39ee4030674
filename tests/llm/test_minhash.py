"""op4: estimates against exact Jaccard, neighbours, equal fingerprints."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from rillflow.llm import minhash
from rillflow.llm.common import with_next
from rillflow.llm.queries import REGISTRY
from tests.llm.fixtures import docs_frame, table, with_clashes, write


def shingles(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_against_exact(spark, scratch):
    rows = [(r["doc_id"], r["text"], "en", "s") for r in table("documents")]
    rows += [(9001, None, None, None), (9002, "", "en", "s"), (9003, "one", "en", "s"),
             (9004, " ".join(f"w{i}" for i in range(50_000)), "en", "s")]
    sf = write(with_clashes(docs_frame(spark, rows)), scratch + "/d", "documents")
    got = {r["doc_id"]: r for r in REGISTRY["op4_minhash"](spark, sf).collect()}
    assert len(got) == len(rows)
    rows = sorted(((i, t or "") for i, t, *_ in rows), reverse=True)
    off = []
    for k, (i, text) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == minhash.fingerprint(text)
        off += [r["near_edited"] - jaccard(text, edited), r["near_next"] - jaccard(text, nxt)]
    assert np.abs(off).max() < 0.15 and abs(np.mean(off)) < 0.01


def test_estimate_is_unbiased_also_for_sparse_bins():
    rng = np.random.default_rng(3)
    for size in (20, 120, 2000):  # far fewer shingles than bins, fewer, more
        off = []
        for _ in range(40):
            words = [str(x) for x in rng.integers(0, 10**9, size)]
            cut = size // 4
            other = words[:size - cut] + [str(x) for x in rng.integers(0, 10**9, cut)]
            a, b = " ".join(words), " ".join(other)
            off.append(minhash.likeness(minhash.fingerprint(a), minhash.fingerprint(b))
                       - jaccard(a, b))
        assert abs(np.mean(off)) < 0.04, (size, np.mean(off))


def test_odd_texts():
    empty, one = minhash.fingerprint(""), minhash.fingerprint("word")
    assert empty == minhash.fingerprint(" \n") == "" and len(one) == minhash.BINS * 2
    assert minhash.likeness(empty, empty) == 1.0 and minhash.likeness(empty, one) == 0.0
    assert minhash.likeness(one, one) == 1.0
    assert minhash.likeness(one, minhash.fingerprint("other")) < 0.1


def test_next_row_over_ranges_ties_and_nulls(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    ids = [5, 5, 7, 1, None, 2, 9, 9, None, 4, 3, 8]
    rows = [(i, f"t{k}") for k, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "id long, text string")
    of = dict(df.select("text", F.xxhash64("text")).collect())
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), of[r[1]]))
    for n in ("1", "4", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got = {r["text"]: r["nxt"] for r in with_next(df, "id", "text", "nxt").collect()}
        assert got == {t: want[(k + 1) % len(want)][1] for k, (_, t) in enumerate(want)}
        alone = df.where("text = 't2'")
        assert [r["nxt"] for r in with_next(alone, "id", "text", "nxt").collect()] == ["t2"]
        assert with_next(df.limit(0), "id", "text", "nxt").collect() == []
    spark.conf.set("spark.sql.shuffle.partitions", old)
