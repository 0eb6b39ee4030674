"""Spelling variants of words: pairs at an edit distance of one by pivotal grams.

1. ``words_of``: runs of letters of every text, lower-cased; counted with map-side
   combining, so a word that fills a third of the corpus is absorbed before the shuffle.
2. ``signed``: the bigrams of a word are put in one global order, rare ones first. The
   first three occurrences are its prefix; two of them that share no character are
   its pivots, chosen by dynamic programming for the smallest total frequency.
3. One edit breaks at most one of two disjoint bigrams. So of two near words the one whose
   prefix ends earlier in the order has a pivot that the other word still holds, and
   holds within its own prefix. Pivots are therefore looked up among the prefixes
   of other words only. The position limit is used to the full: if the edit lies behind the
   left pivot, that stands at the same distance from the left end, with equal
   text up to it; else the right pivot does so from the right end. On the other side
   of the pivot one edit leaves one half of the text (cut by the other word's length) equal,
   too. The key of the look-up is the other word's length, the gram's place, the text
   of the pivot's side and one half of the rest (``_index_keys``, ``_probe_keys``).
4. Pairs that share a key are verified inside the join, so it returns near words only.

A bigram that ends a prefix may occur again behind it; of two near words the surviving
one's number among its likes differs by two at most (one edit makes two new bigrams at
most), so the first five occurrences of the last gram are indexed (``_TIES``).

The counts of the bigrams are the only thing on the driver: characters are counted
modulo 256, which bounds the table by 65,536 rows for any alphabet (for the letters
looked for here every bigram has a count of its own).

Edge cases: a null text has no words; a null id counts as an empty one in ``h``; rows
with an equal id, and repeated rows, count as often as they are there; words are compared by code points; ties
of the largest n go to the smallest word; an empty table gives no words; other columns are
ignored. Words shorter than ``LEAST_LENGTH`` have too few bigrams and are refused
(``ValueError``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.common import ascii_lower
from rillflow.session import materialize

#: fixed values of the contract
LETTERS = "A-Za-zÀ-ÿ"
LENGTH, OCCURRENCES, TYPO, RATIO = 7, 2, 31, 10

#: length of a gram, edits
Q, TAU = 2, 1
#: a word needs Q * TAU + 1 bigrams
LEAST_LENGTH = Q * TAU + Q
_TIES = 2 * Q * TAU + 1
_CLASSES = 256


def mistyped(run: Column, doc_id: Column, typo: int = TYPO) -> Column:
    """``run`` without one code point if ``typo`` divides the checksum of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
                .cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % typo == 0, F.concat(F.substring(run, F.lit(1), at),
                                          F.substring(run, at + 2, F.length(run)))).otherwise(run)


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             length: int = LENGTH, occurrences: int = OCCURRENCES, typo: int = TYPO) -> DataFrame:
    """(word, n): words of at least ``length`` code points that occur ``occurrences`` times
    or more. A shorter run cannot give such a word, so only runs of that length are cut
    out; a maximal run is matched whole."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit(f"[{LETTERS}]{{{length},}}"), F.lit(0))
    run = docs.select(F.col(id_col).alias("id"), F.explode(runs).alias("run")) \
        .select("id", ascii_lower(F.col("run")).alias("run"))
    return (run.select(mistyped(F.col("run"), F.col("id"), typo).alias("word"))
            .where(F.length("word") >= length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= occurrences))


def _code(c: Column) -> Column:
    """Code point of a character (one UTF-32 unit), modulo ``_CLASSES``."""
    return F.conv(F.hex(F.encode(c, "UTF-32")), 16, 10).cast("int") % _CLASSES


def gram_ranks(words: DataFrame) -> dict[int, int]:
    """Rank of each class of bigrams, rare ones first; at most 65,536."""
    chars = words.select(F.split("word", "").alias("c"))
    pairs = chars.select(F.explode(F.arrays_zip(
        F.slice("c", 1, F.size("c") - 1).alias("a"), F.slice("c", 2, F.size("c") - 1).alias("b")))
        .alias("p")).groupBy("p.a", "p.b").count()
    by_class = pairs.groupBy((_code(F.col("a")) * _CLASSES + _code(F.col("b"))).alias("class")) \
        .agg(F.sum("count").alias("n"))
    found = sorted((r["n"], r["class"]) for r in by_class.collect())
    return {c: rank for rank, (_, c) in enumerate(found)}


def pivots(prefix: list[tuple[int, int]], wanted: int = TAU + 1, q: int = Q) -> list[int]:
    """Positions of ``wanted`` occurrences of (position, cost), no two of which overlap, with
    the smallest total cost. ``best[k]`` is the best choice of k among those seen so far."""
    seen: list[tuple[int, list[tuple[int, list[int]] | None]]] = []
    for pos, cost in sorted(prefix):
        before = next((row for p, row in reversed(seen) if p + q <= pos), None) \
            or [(0, [])] + [None] * wanted
        best = list(seen[-1][1]) if seen else [(0, [])] + [None] * wanted
        for k in range(wanted):
            if before[k] is not None:
                more = (before[k][0] + cost, before[k][1] + [pos])
                if best[k + 1] is None or more < best[k + 1]:
                    best[k + 1] = more
        seen.append((pos, best))
    return seen[-1][1][wanted][1]


def signature(word: str, ranks: dict[int, int]) -> tuple[int, list[int], list[int]]:
    """(last gram of the prefix in the global order, pivots, indexed positions). A gram
    is told by the rank of its class, then its two code points, in one number."""
    codes = [ord(c) for c in word]
    grams = [((ranks[a % _CLASSES * _CLASSES + b % _CLASSES] << 42) | a << 21 | b, i)
             for i, (a, b) in enumerate(zip(codes, codes[1:]))]
    first = sorted(grams)[:Q * TAU + 1]
    last = first[-1][0]
    index = [i for g, i in first if g < last]
    index += [i for g, i in grams if g == last][:_TIES]
    return last, pivots([(i, g >> 42) for g, i in first]), index


def signed(words: DataFrame) -> DataFrame:
    """(word, n, last, pivots, prefix) of each word, positions from 0."""
    ranks = words.sparkSession.sparkContext.broadcast(gram_ranks(words))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            made = [signature(w, ranks.value) for w in rows["word"]]
            yield rows.assign(last=[m[0] for m in made], pivots=[m[1] for m in made],
                              prefix=[m[2] for m in made])

    return words.select("word", "n").mapInPandas(
        run, "word string, n bigint, last bigint, pivots array<int>, prefix array<int>")


def _part(word: Column, start: Column, end: Column) -> Column:
    return F.substring(word, start + 1, end - start)


def _index_keys(w: Column, p: Column) -> Column:
    """Keys of a word that holds a gram of its prefix at ``p``: with its left side
    and a half of the rest, with its right side and a half of the rest."""
    n, end, zero = F.length(w), p + Q, F.lit(0)
    cut = end + F.floor((n - end) / 2).cast("int")
    before = F.floor(p / 2).cast("int")
    return F.array(
        F.xxhash64(F.lit(0), n, p, _part(w, zero, cut)),
        F.xxhash64(F.lit(1), n, p, _part(w, zero, end), _part(w, cut, n)),
        F.xxhash64(F.lit(2), n, n - p, _part(w, before, n)),
        F.xxhash64(F.lit(3), n, n - p, _part(w, zero, before), _part(w, p, n)))


def _probe_keys(w: Column, left: Column, right: Column) -> Column:
    """Keys under which words of one edit less, as many and one more code points are
    indexed if they hold the left pivot with its left side, or the right one with its right."""
    n, zero, end = F.length(w), F.lit(0), left + Q
    found = []
    for step in range(-TAU, TAU + 1):
        other = n + step
        half = F.floor((other - end) / 2).cast("int")  # of what follows the left pivot
        tail = other - end - half
        place = other - (n - right)  # of the right pivot in the other word
        before = F.floor(place / 2).cast("int")
        found += [
            F.when(other >= end, F.xxhash64(F.lit(0), other, left, _part(w, zero, end + half))),
            F.when(other >= end, F.xxhash64(F.lit(1), other, left, _part(w, zero, end),
                                            _part(w, n - tail, n))),
            F.when(place >= 0, F.xxhash64(F.lit(2), other, n - right,
                                          _part(w, n - other + before, n))),
            F.when(place >= 0, F.xxhash64(F.lit(3), other, n - right, _part(w, zero, before),
                                          _part(w, right, n)))]
    return F.filter(F.array(*found), lambda k: k.isNotNull())


def probes(rows: DataFrame) -> DataFrame:
    return rows.select("word", "n", "last", F.explode(_probe_keys(
        F.col("word"), F.element_at("pivots", 1), F.element_at("pivots", 2))).alias("key"))


def indexed(rows: DataFrame) -> DataFrame:
    return rows.select("word", "n", "last", F.explode("prefix").alias("p")).select(
        "word", "n", "last", F.explode(_index_keys(F.col("word"), F.col("p"))).alias("key"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every pair of near words, both ways, once or more
    often. ``words`` are distinct."""
    short = words.where(F.length("word") < LEAST_LENGTH).limit(1).collect()
    if short:
        raise ValueError(f"words need at least {LEAST_LENGTH} code points: {short[0]['word']!r}")
    rows = materialize(signed(words), "signed-words")
    s, r = probes(rows).alias("s"), indexed(rows).alias("r")
    near = ((F.col("s.key") == F.col("r.key")) & (F.col("s.last") <= F.col("r.last"))
            & (F.levenshtein("s.word", "r.word", TAU) == TAU))
    found = s.join(r, near).select(
        F.col("s.word").alias("word"), F.col("s.n").alias("n"),
        F.col("r.word").alias("other"), F.col("r.n").alias("other_n"))
    return found.select(F.explode(F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"),
                 F.col("word").alias("other"), F.col("n").alias("other_n")))).alias("p")) \
        .select("p.*")


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each chain of forms. n grows with each
    step, so there are no circles; each round doubles the length that is followed."""
    state = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = materialize(state.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"),
            F.col("next").isNotNull().alias("moved")), "forms")
        state = after.select("word", "root")
        if after.where("moved").isEmpty():
            return state


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``words`` (word, n; distinct words): form, root, n, n_near,
    form_n. A word's form is its near word of the largest n, if that is at least
    ``ratio`` times its own."""
    words = materialize(words.select("word", "n"), "words")
    pairs = near_words(words).repartition("word").dropDuplicates(["word", "other"])
    near = materialize(pairs.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
        .alias("best"), F.first("n").alias("n")).select(
            "word", "n_near", *[F.when(-F.col("best.less") >= ratio * F.col("n"), c).alias(k)
                                for k, c in (("form", F.col("best.form")),
                                             ("form_n", -F.col("best.less")))]), "near-words")
    roots = last_forms(near.where(F.col("form").isNotNull()))
    return words.join(near, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")
