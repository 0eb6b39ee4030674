"""The pipeline: each stage's decisions take effect, and nothing else."""

import random

import pyarrow.parquet as pq

import corpus_pipeline as P
from rillflow.llm import bpe
from tests.conftest import SF
from tests.llm.fixtures import awkward_docs, docs_frame, table, with_clashes, write


def test_stages_on_awkward_documents(spark, scratch):
    rows = awkward_docs()
    docs = with_clashes(docs_frame(spark))
    cols = docs.columns
    one = P.language(spark, docs, "").cache()
    assert one.columns == cols
    gone = {9001, 9002, 9003, 9006}
    assert one.count() == len(rows) - 4 and not gone & {r["doc_id"] for r in one.collect()}
    assert one.where("lang is null").count() == 0
    two = P.near_duplicates(spark, one, "").cache()
    assert two.columns == cols
    assert sum(r["doc_id"] == 9005 for r in two.collect()) == 2  # the equal rows are one now
    three = P.mask_secrets(spark, two, "").cache()
    assert three.columns == cols and three.count() == two.count()
    text = {r["doc_id"]: (r["text"], r["n_chars"]) for r in three.collect()}
    assert text[None][0] == "a text without an id, [SECRET]"
    assert text[-3][0] == "[SECRET] secret=token:abcdefgh"
    assert text[9008][0] == "[SECRET]' TOKEN=x"
    assert all(n == len(t) for t, n in text.values())
    four = P.mixture(spark, three, "").cache()
    assert four.columns == cols and four.count() > 0
    ids = {r["doc_id"] for r in three.collect()}
    assert {r["doc_id"] for r in four.collect()} <= ids
    five = P.token_ids(spark, four, "").collect()
    assert len(five) == four.count() and all(r["decodes"] for r in five)
    own = bpe.codec(*(P.public_tokenizers.path("byte_bpe_50k.tiktoken"), P.public_tokenizers.PATTERN))
    for r in five[:20]:
        assert own.decode(r["ids"]).decode() == text[r["doc_id"]][0] or r["doc_id"] == 9005


def test_run_and_empty(spark, scratch):
    sf = write(docs_frame(spark, awkward_docs()[-40:]), scratch + "/d", "documents")
    out = P.run(spark, sf)
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decodes"]
    assert out.count() > 20
    empty = write(docs_frame(spark).limit(0), scratch + "/e", "documents")
    assert P.run(spark, empty).collect() == []


def test_near_duplicates_of_five_words(spark):
    def shingles(text):
        w = text.lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}

    def like(a, b):
        return len(a & b) / len(a | b)

    words = [f"w{k}" for k in range(60)]
    texts = []
    for i, spots in enumerate(([], [30], [10, 40], [59], [58, 59], [56], [53], [0, 59])):
        mine = list(words)
        for s in spots:
            mine[s] = f"own{i}x{s}"
        texts.append(" ".join(mine))
    texts += [" ".join(f"z{k}" for k in range(n)) for n in (40, 33, 32, 24)]
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    sets = [shingles(t) for t in texts]
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if like(a, b) >= 0.8:
                    root[i] = root[j] = min(root[i], root[j])
    kept = {r["doc_id"] for r in P.near_duplicates(spark, docs_frame(spark, rows), "").collect()}
    assert kept == set(root)
    four = {r["doc_id"] for r in P.ngram_join.one_of_each(docs_frame(spark, rows)).collect()}
    assert kept < four  # op9's limits would leave some


def test_language_rejects_texts_with_letters(spark):
    rng = random.Random(3)
    many = pq.read_table(SF.replace("sf0.001", "sf0.01") + "/documents.parquet").to_pylist()
    clean = [(r["doc_id"], r["text"], r["lang"], "s") for r in many]
    odd = ["Это предложение написано на русском языке и не должно остаться в корпусе",
           "这是一个中文句子,不应该留在语料库中", "ωραία μέρα για μια βόλτα στη θάλασσα",
           " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9)))
                    for _ in range(2000))]
    rows = clean + [(10_000 + i, t, None, "s") for i, t in enumerate(odd)]
    rows += [(20_000 + i, t, None, "s") for i, (_, t, _, _) in enumerate(clean[:30])]
    docs = docs_frame(spark, rows)
    kept = {r["doc_id"]: r["lang"] for r in P.language(spark, docs, "").collect()}
    assert not {i for i in kept if 10_000 <= i < 20_000}
    assert {i for i, *_ in clean} <= set(kept)
    assert all(kept[20_000 + i] == clean[i][2] for i in range(30))
    # with one language alone, likeness decides
    one = docs_frame(spark, [r for r in clean if r[2] == "en"] + rows[len(clean):len(clean) + 3])
    assert all(r["lang"] == "en" and r["doc_id"] < 10_000
               for r in P.language(spark, one, "").collect())


def test_language_keeps_held_out_documents():
    rows = [(r["text"], r["lang"]) for r in table("documents") if r["text"] and r["lang"]]
    model = P.langid.train([P.langid.vector(t) for t, _ in rows[::2]], [x for _, x in rows[::2]])
    for text, _ in rows[1::2]:
        _, _, margin, like = model.judge(text)
        assert margin >= P.LEAST_MARGIN and like >= P.LEAST_LIKE
