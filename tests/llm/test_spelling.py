"""op11: variants against all pairs of words, compared letter by letter."""

import re
import zlib
from collections import Counter

import pytest

from rillflow.llm import spelling as S
from rillflow.llm.queries import REGISTRY
from tests.llm.fixtures import awkward_docs, docs_frame, with_clashes, write

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def plain_variants(n):
    words = sorted(n)
    near = {w: [] for w in words}
    for i, a in enumerate(words):
        for b in words[i + 1:]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def rows(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_query_on_odd_documents(spark, scratch):
    typos = [(7000 + i, "antidisestablish " * 30 + w, "en", "s") for i, w in enumerate(
        ["antidisestablis", "Xantidisestablish", "antidisestablishé", "antidïsestablish",
         "antidisestablis", "Xantidisestablish", "antidisestablishé", "antidïsestablish",
         "ntidisestablis ntidisestablis", "ÉCOLEGRANDE Écolegrande"])]
    docs = [d for d in awkward_docs() if d[0] is None or d[0] % 3 or d[0] > 8000] + typos
    write(with_clashes(docs_frame(spark, docs)), scratch, "documents")
    got = rows(REGISTRY["op11_spelling_variants"](spark, scratch))
    assert got == plain_variants(plain_words([(d[0], d[1]) for d in docs]))
    assert sum(g[1] is not None for g in got) > 3


@pytest.mark.parametrize("seed", range(3))
def test_dense_words(spark, seed):
    """Few letters, repeated grams, edits at every place, runs of one letter."""
    import random
    rnd = random.Random(seed)
    words = {"a" * k: 1 for k in range(5, 14)} | {"ab" * k: 3 for k in range(3, 8)}
    while len(words) < 500:
        base = "".join(rnd.choice("abé") for _ in range(rnd.randint(7, 12)))
        for _ in range(4):
            k = rnd.randrange(len(base) + 1)
            made = base[:k] + rnd.choice(["", "a", "b", "中"]) + base[k + rnd.randint(0, 1):]
            if len(made) >= 5:
                words[made] = rnd.choice([1, 2, 5, 10, 30, 100, 1000])
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(S.variants(df)) == plain_variants(words)


def test_roots_follow_chains_of_forms(spark):
    chain = ["abcdefghij", "abcdefghiz", "abcdefghyz", "abcdefgxyz", "abcdefwxyz", "abcdevwxyz"]
    words = {w: 10 ** k for k, w in enumerate(chain)} | {"abcdevwxyzz": 5, "lonelyword": 7}
    got = rows(S.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain_variants(words)
    assert {g[2] for g in got if g[0] in chain} == {chain[-1]}


def test_pivots_are_the_cheapest_disjoint_choice():
    assert S.pivots([(0, 5), (1, 1), (2, 5)]) == [0, 2]
    assert S.pivots([(0, 1), (3, 9), (7, 2)]) == [0, 7]
    assert S.pivots([(4, 1), (5, 1), (6, 1)]) == [4, 6]


def test_short_words_are_refused_and_empty_tables_give_none(spark):
    with pytest.raises(ValueError):
        S.variants(spark.createDataFrame([("abc", 2)], "word string, n long"))
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.variants(S.words_of(none)).collect() == []
    assert S.words_of(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")) \
        .collect() == []
