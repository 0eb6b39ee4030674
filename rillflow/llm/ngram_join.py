"""N-gram Jaccard self-join by T-occurrence search (DivideSkip).

Every text becomes the set of its word n-grams (64-bit hashes); equal sets are one
class (``members``), so copies cost one. Linked classes, those with
``100 * |x & y| >= percent * |x | y|``, are found without listing pairs of a group:

1. ``packed``: the texts are hashed and written once as packs of about ``PACK_TOKENS``
   tokens: the rows' ids, their classes, and the classes' words, compressed. Whatever follows
   works on packs, so a task holds one pack and knows its classes by their places.
   ``shared_tokens``: a token that one class alone holds cannot count towards any
   overlap. Each pack sends its distinct tokens, and nothing else, to buckets of about
   ``BUCKET_TOKENS``; a class in several packs speaks in its first one only, and a token that several
   classes of a pack hold is sent as known to be shared, so one that a third of all rows
   hold stays small. What comes back is one bit per token and pack. A class of which less than
   PERCENT of the tokens are shared has no link and goes (exactly, not by guess).
2. ``survivors``: the same with the exact frequencies among the remaining classes;
   each keeps its prefix: its ``n - ceil(PERCENT n) + 1`` rarest tokens, of which linked
   classes share one.
3. ``search_groups``: classes joined by prefix tokens, directly or over others, form
   a candidate group (star edges, then ``components``). Small groups share a
   search task; a group above ``GROUP`` classes is cut into chunks, and each pair of
   chunks is a task, so no task grows with the group.
4. ``search``: within a task, classes by ascending size, each one a query against those
   before it: an overlap of T = ceil(PERCENT n) tokens is required; the L longest
   inverted lists are put aside, the short ones counted for classes with
   T - L occurrences, and the long ones binary-probed for those. Every pair is verified, in
   one task only; returned are each class's number of links, weighed by the linked classes'
   rows, and the connections as forest edges, so no pair list grows. For ``one_of_each``,
   which needs components only, a class already connected with the query is skipped.

Edge cases: a null or empty text, or one without words, has an empty set and links
with nothing; a text of fewer words than an n-gram is one n-gram; repeated rows and
equal ids are rows of their own in one class; a null id never is a component's id
(a component of such rows alone has none); an empty table gives an empty result; other
columns are ignored. Texts are hashed whole. Two different n-grams with one 64-bit hash
count as equal.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rillflow.llm.common import batch_rows, fresh, release_memory
from rillflow.llm.components import components, unite
from rillflow.operators.joins import sized_broadcast
from rillflow.session import materialize

NGRAM = 4
PERCENT = 85
#: tokens that a bucket aims at; tokens, and rows, of a pack
BUCKET_TOKENS, PACK_TOKENS = 1_000_000, 500_000
#: classes on a side of a search task
GROUP = 2_000
#: texts in an Arrow batch
BATCH = 256

_U = np.uint64
_MUL = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def tokens(text: str | bytes | None, n: int = NGRAM) -> np.ndarray:
    """The sorted n-gram hashes of a text (or its bytes): A-Z lower-cased, words between
    ASCII white space."""
    words = (text if isinstance(text, bytes) else (text or "").encode()).lower().split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=_U, count=len(words))
    k = min(n, len(words))
    if not k:
        return h
    out = np.full(len(words) - k + 1, k, dtype=_U)
    for i in range(k):
        out = (out ^ h[i:len(words) - k + 1 + i]) * _U(_MUL[i % 4])
        out ^= out >> _U(29)
    return np.unique(out)


def class_of(t: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(t.tobytes()) if len(t) else None


def needed(n: int, percent: int) -> int:
    return -(-percent * n // 100)


# ------------------------------------------------------------------------ packs
def _words(text: str | None) -> bytes:
    """A text's words as its n-grams see them, one space between."""
    return b" ".join((text or "").encode().lower().split())


def _packs(ngram: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0

        def start():
            return {"ids": [], "keys": [], "of": [], "cls": [], "n": [], "length": []}, {}, [], 0

        def row():
            return pa.RecordBatch.from_pylist([{
                "pack": task << 32 | made, **now, "words": zlib.compress(b"".join(words), 1)}],
                schema=schema)

        now, place, words, held = start()
        for batch in batches:
            for doc, text, key in zip(*(c.to_pylist() for c in batch.columns)):
                t = tokens(text, ngram)
                c = class_of(t)
                if c is not None and c not in place:
                    place[c] = len(place)
                    words.append(_words(text))
                    for name, value in (("cls", c), ("n", len(t)), ("length", len(words[-1]))):
                        now[name].append(value)
                    held += len(t)
                for name, value in (("ids", doc), ("keys", key), ("of", place.get(c, -1))):
                    now[name].append(value)
                if held >= PACK_TOKENS or len(now["ids"]) >= PACK_TOKENS:
                    yield row()
                    made += 1
                    now, place, words, held = start()
        if now["ids"]:
            yield row()
        release_memory()
    return run


def packed(docs: DataFrame, id_col: str, text_col: str, ngram: int = NGRAM) -> DataFrame:
    """The rows of ``docs`` in packs: ``ids``, ``keys`` (a hash of the whole text) and ``of`` (the
    place of a row's class in the pack, -1 without words) of the rows; ``cls``, ``n``, and the
    ``length`` of the compressed ``words`` of the classes."""
    batch_rows(docs.sparkSession, BATCH)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("key"))
    ids = T.ArrayType(rows.schema["id"].dataType)
    schema = T.StructType([T.StructField("pack", T.LongType()), T.StructField("ids", ids)] + [
        T.StructField(c, T.ArrayType(k)) for c, k in (
            ("keys", T.LongType()), ("of", T.IntegerType()), ("cls", T.BinaryType()),
            ("n", T.IntegerType()), ("length", T.IntegerType()))]
        + [T.StructField("words", T.BinaryType())])
    return materialize(rows.mapInArrow(_packs(ngram, to_arrow_schema(schema)), schema),
                       "ngram-packs")


def members(packs: DataFrame) -> DataFrame:
    """(id, key, n, cls) of every row; n is 0 and cls null without words."""
    of = F.transform(F.arrays_zip("ids", "keys", "of"), lambda m: F.struct(
        m["ids"].alias("id"), m["keys"].alias("key"),
        F.coalesce(F.get("n", m["of"]), F.lit(0)).cast("bigint").alias("n"),
        F.get("cls", m["of"]).alias("cls")))
    return packs.select(F.inline(of))


def repeated(packs: DataFrame) -> DataFrame:
    """(pack, again): the places of the classes that an earlier pack holds, too."""
    each = packs.select("pack", F.posexplode("cls").alias("at", "cls"))
    first = each.groupBy("cls").agg(F.min("pack").alias("first"), F.count(F.lit(1)).alias("k")) \
        .where("k > 1").select("cls", "first")
    return each.join(first, "cls").where("pack > first").groupBy("pack").agg(
        F.collect_list("at").alias("again"))


# ---------------------------------------------------------------- shared tokens
_PLACED = "bucket bigint, pack bigint, alone int, token binary"
_PLACED_ARROW = pa.schema([("bucket", pa.int64()), ("pack", pa.int64()), ("alone", pa.int32()),
                           ("token", pa.binary())])
_BITS = "pack bigint, bucket bigint, bits binary"


def _sets(row: dict, ngram: int) -> tuple[list[int], list[np.ndarray]]:
    """The places of a pack's classes, without those that are repeated, and their tokens."""
    again, begin, places, sets = set(row["again"] or ()), 0, [], []
    words = zlib.decompress(row["words"])
    for at, length in enumerate(row["length"]):
        if at not in again:
            places.append(at)
            sets.append(tokens(words[begin:begin + length], ngram))
        begin += length
    return places, sets


def _dealt(sets: list[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct tokens by bucket, those of one class first; whether several classes hold
    each; and where the buckets begin."""
    token, runs = np.unique(np.concatenate(sets), return_counts=True)
    bucket = token % _U(buckets)
    order = np.lexsort((runs > 1, bucket))
    return token[order], runs[order] > 1, np.searchsorted(
        bucket[order], np.arange(buckets + 1, dtype=_U))


def _place_tokens(buckets: int, ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, sets = _sets(row, ngram)
                if not sets:
                    continue
                token, several, edges = _dealt(sets, buckets)
                alone = np.concatenate(([0], np.cumsum(~several)))
                full = np.flatnonzero(np.diff(edges))
                yield pa.RecordBatch.from_arrays([
                    pa.array(full, pa.int64()), pa.array(np.full(len(full), row["pack"])),
                    pa.array((alone[edges[full + 1]] - alone[edges[full]]).astype(np.int32)),
                    pa.array([token[edges[b]:edges[b + 1]].tobytes() for b in full],
                             pa.binary())], schema=_PLACED_ARROW)
        release_memory()
    return run


def _find_shared(table: pa.Table) -> pa.Table:
    """Of each pack's tokens that one of its classes holds: whether another pack has them."""
    parts = [np.frombuffer(x.as_buffer(), dtype=_U) for x in table.column("token")]
    alone = table.column("alone").to_numpy()
    token = np.concatenate(parts)
    size = np.array([len(x) for x in parts])
    begin = np.concatenate(([0], np.cumsum(size)))
    known = np.arange(len(token)) - np.repeat(begin[:-1], size) >= np.repeat(alone, size)
    _, which, runs = np.unique(token, return_inverse=True, return_counts=True)
    shared = runs > 1  # a pack names a token once
    shared[which[known]] = True
    bits = [np.packbits(shared[which[b:b + n]]).tobytes() for b, n in zip(begin, alone)]
    del token, parts, known, which, runs, shared
    release_memory()
    return pa.table([table.column("pack"), table.column("bucket"), pa.array(bits, pa.binary())],
                    names=["pack", "bucket", "bits"])


_ENOUGH = pa.schema([("cls", pa.binary()), ("n", pa.int32()), ("tokens", pa.list_(pa.int64()))])


def _enough_shared(buckets: int, percent: int, ngram: int):
    """Classes with at least ``percent`` of their tokens shared, with those, sorted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                places, sets = _sets(row, ngram)
                if not sets:
                    continue
                token, shared, edges = _dealt(sets, buckets)
                for answer in row["answers"]:
                    b = slice(edges[answer["bucket"]], edges[answer["bucket"] + 1])
                    alone = np.flatnonzero(~shared[b]) + b.start
                    shared[alone] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8),
                                                  count=len(alone)).astype(bool)
                known = np.sort(token[shared])
                found = []
                for at, t in zip(places, sets):
                    place = np.minimum(np.searchsorted(known, t), max(0, len(known) - 1))
                    mine = t[known[place] == t] if len(known) else t[:0]
                    if len(mine) * 100 >= percent * len(t):
                        found.append((row["cls"][at], len(t), mine.view(np.int64)))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*found), _ENOUGH)],
                        schema=_ENOUGH)
        release_memory()
    return run


def shared_tokens(packs: DataFrame, total: int, percent: int = PERCENT,
                  ngram: int = NGRAM) -> DataFrame:
    """(cls, n, tokens): the classes of which at least ``percent`` of the tokens are
    shared, with those tokens. ``total`` is the number of tokens to place."""
    spark = packs.sparkSession
    batch_rows(spark, 1)  # a pack at a time
    buckets = max(1, -(-total // BUCKET_TOKENS))
    again = materialize(repeated(packs), "ngram-repeated")
    texts = packs.join(sized_broadcast(again), "pack", "left") \
        .select("pack", "cls", "length", "words", "again")
    bits = texts.mapInArrow(_place_tokens(buckets, ngram), _PLACED) \
        .groupBy("bucket").applyInArrow(_find_shared, _BITS)
    answers = materialize(bits, "ngram-bits").groupBy("pack").agg(
        F.collect_list(F.struct("bucket", "bits")).alias("answers"))
    enough = texts.join(answers, "pack").mapInArrow(
        _enough_shared(buckets, percent, ngram), "cls binary, n int, tokens array<bigint>")
    return materialize(enough, "ngram-shared")


# -------------------------------------------------------------------- candidates
def survivors(shared: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(cls, n, tokens, prefix): tokens still held by several classes, the rarest
    first, and the prefix in which linked classes meet."""
    each = shared.select("cls", "n", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    n, size = F.col("n"), F.size("tokens")
    least = F.ceil(n * percent / F.lit(100)).cast("int")
    per = each.join(often, "token").groupBy("cls", "n").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("df", "token"))), lambda x: x["token"])
        .alias("tokens")).where(size >= least)
    # its n - size tokens that no other class holds come before them all
    return materialize(per.withColumn("prefix", F.slice(
        "tokens", F.lit(1), (n - least + 1) - (n - size))), "ngram-survivors")


def search_groups(found: DataFrame, copies: DataFrame | None = None) -> DataFrame:
    """``found`` dealt to search tasks: one row per class and task, with ``task``, the class's
    ``chunk``, its ``copies`` and ``own``: whether the pairs within the chunk are this task's."""
    postings = found.select("cls", F.explode("prefix").alias("token"))
    low = postings.groupBy("token").agg(F.min("cls").alias("low"), F.count(F.lit(1)).alias("k")) \
        .where("k > 1").select("token", "low")
    groups = materialize(components(
        postings.join(low, "token").select(F.col("cls").alias("a"), F.col("low").alias("b"))),
        "ngram-groups")
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shared_tasks = max(1, -(-total // GROUP))
    chunks = F.ceil(F.col("size") / GROUP).cast("int")
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct(
        F.xxhash64("root", F.least(c, F.col("chunk")), F.greatest(c, F.col("chunk"))).alias("task"),
        (c == F.col("chunk")).alias("own")))
    # copies join the places, which are small, not the tokens
    groups = groups.withColumn("copies", F.lit(1).cast("bigint")) if copies is None \
        else groups.join(copies, F.col("node") == F.col("cls")).drop("cls")
    placed = groups.join(sizes, "root").withColumn("chunks", chunks).withColumn("chunk", own) \
        .select(F.col("node").alias("cls"), "copies", "chunk", F.inline(F.when(
            F.col("chunks") == 1,
            F.array(F.struct(F.pmod(F.xxhash64("root"), F.lit(shared_tasks)).alias("task"),
                             F.lit(True).alias("own")))).otherwise(pairs)))
    return found.select("cls", "n", "tokens").join(placed, "cls")


def search(n: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Labels of the classes (sizes ascending): the first class connected with each."""
    return search_links(n, sets, percent, every=False)[0]


def search_links(n: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT,
                 copies: np.ndarray | None = None, chunk: np.ndarray | None = None,
                 within: np.ndarray | None = None, every: bool = True) \
        -> tuple[np.ndarray, np.ndarray]:
    """Labels as in ``search`` and each class's links: the sum of the linked classes'
    ``copies`` (1 each by default). Pairs within a ``chunk`` are left out unless ``within``. If
    not ``every``, classes connected already are skipped, and the links are too few."""
    label, links = np.arange(len(n)), np.zeros(len(n), dtype=np.int64)
    copies = np.ones(len(n), dtype=np.int64) if copies is None else copies
    whole = chunk is None or bool(np.all(within))
    sizes = np.array([len(s) for s in sets])
    token = np.concatenate(sets) if len(sets) else np.zeros(0, np.int64)
    rec = np.repeat(np.arange(len(n)), sizes)
    order = np.argsort(token, kind="stable")  # lists of ascending classes
    lists = rec[order]
    new = np.concatenate(([True], token[order][1:] != token[order][:-1]))
    start = np.empty(len(token), dtype=np.int64)
    at = np.arange(len(token))
    start[order] = np.maximum.accumulate(np.where(new, at, 0))
    own = np.empty(len(token), dtype=np.int64)
    own[order] = at  # the class's own place in the list: before it come the smaller ones
    begin = np.concatenate(([0], np.cumsum(sizes)))
    for r in range(1, len(n)):
        a, b = start[begin[r]:begin[r + 1]], own[begin[r]:begin[r + 1]]
        length = b - a
        a, b, length = a[length > 0], b[length > 0], length[length > 0]
        least = needed(int(n[r]), percent)
        if len(a) < least:
            continue
        by_length = np.argsort(length, kind="stable")
        longest = int(length[by_length[-1]])
        aside = min(least - 1, int(least / (0.0085 * math.log2(longest + 1) + 1)))
        short, long = by_length[:len(a) - aside], by_length[len(a) - aside:]
        smallest = np.searchsorted(n, -(-percent * int(n[r]) // 100))
        seen = np.bincount(np.concatenate([lists[a[k]:b[k]] for k in short]), minlength=r)
        fine = seen >= least - aside
        fine[:smallest] = False
        if not whole and not within[r]:
            fine &= chunk[:r] != chunk[r]
        if not every:
            fine &= label[:r] != label[r]
        near = np.flatnonzero(fine)
        if not len(near):
            continue
        overlap = seen[near]
        for k in long:
            part = lists[a[k]:b[k]]
            place = np.minimum(np.searchsorted(part, near), len(part) - 1)
            overlap = overlap + (part[place] == near)
        linked = near[overlap * 100 >= percent * (n[near] + n[r] - overlap)]
        if len(linked):
            links[linked] += copies[r]
            links[r] += copies[linked].sum()
            linked = linked[label[linked] != label[r]]
        if len(linked):
            label = unite(label, linked, np.full(len(linked), r))
    return label, links


_LINKS = "a binary, b binary, links bigint"


def _search_task(percent: int, every: bool):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pandas().drop_duplicates("cls")
        rows = rows.sort_values(["n", "cls"], ignore_index=True)
        label, links = search_links(
            rows["n"].to_numpy(np.int64), list(rows["tokens"]), percent,
            rows["copies"].to_numpy(np.int64), rows["chunk"].to_numpy(), rows["own"].to_numpy(bool),
            every)
        cls = rows["cls"].to_numpy()
        linked = np.flatnonzero(links > 0)  # with its label, itself at the root
        return pa.table([pa.array(cls[linked], pa.binary()), pa.array(cls[label[linked]], pa.binary()),
                         pa.array(links[linked], pa.int64())], names=["a", "b", "links"])
    return run


def class_links(packs: DataFrame, total: int, percent: int = PERCENT, ngram: int = NGRAM,
                copies: DataFrame | None = None) -> DataFrame:
    """(a, b, links): forest edges between linked classes, and a's links found beside each.
    ``copies`` (cls, copies): the rows of each class; without it links are not counted in
    full."""
    found = survivors(shared_tokens(packs, total, percent, ngram), percent)
    return search_groups(found, copies).select("task", "cls", "n", "tokens", "copies", "chunk", "own") \
        .groupBy("task").applyInArrow(_search_task(percent, copies is not None), _LINKS)


def with_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, ngram: int = NGRAM) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable by links)."""
    return with_links(docs, id_col, text_col, percent, ngram).drop("n_links")


def with_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               percent: int = PERCENT, ngram: int = NGRAM) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable by links) and n_links (the
    other rows that it is linked with, copies among them)."""
    packs = packed(docs, id_col, text_col, ngram)
    rows = members(packs).drop("key")
    total = rows.agg(F.sum("n")).first()[0] or 0
    copies = rows.where("cls is not null").groupBy("cls").agg(
        F.count(F.lit(1)).alias("copies"))
    found = materialize(class_links(packs, total, percent, ngram, copies), "ngram-links")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    roots = copies.join(components(found), F.col("cls") == F.col("node"), "left") \
        .join(links, F.col("cls") == F.col("a"), "left").select(
            "cls", F.coalesce("root", "cls").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    placed = rows.where("cls is not null").join(
        roots.where("links > 0"), "cls", "left").select(
            "id", "n", F.coalesce("root", "cls").alias("root"),
            F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))
    low = placed.groupBy("root").agg(F.min("id").alias("low"))
    return placed.join(low, "root").select("id", "n", "low", "links").unionByName(
        rows.where("cls is null").select("id", "n", F.col("id").alias("low"),
                                         F.lit(0).cast("bigint").alias("links"))) \
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                F.col("low").alias("component_id"), F.col("links").alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                percent: int = PERCENT, ngram: int = NGRAM) -> DataFrame:
    """``docs`` with one row of each component: the smallest id's (a null id after all
    others; of equal ids the smallest class, then the smallest hash of the text; of equal rows
    any). Rows with an empty set all stay. What is shuffled besides the search are ids, classes
    and hashes; the rows themselves meet the list of those to drop, a table whose size picks
    the join."""
    k, drop_id, drop_key = fresh(docs, "_k", "_drop_id", "_drop_key")
    packs = packed(docs, id_col, text_col, ngram)
    rows = members(packs).where("cls is not null").groupBy("id", "key", "n", "cls").agg(
        F.count(F.lit(1)).alias("k"))
    total = rows.agg(F.sum("n")).first()[0] or 0
    roots = components(class_links(packs, total, percent, ngram))
    placed = rows.join(roots, F.col("cls") == F.col("node"), "left").select(
        "id", "key", "cls", F.coalesce("root", "cls").alias("root"))
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "cls", "key")
    first = placed.groupBy("root").agg(F.min(rank).alias("first"))
    dropped = materialize(placed.join(first, "root").where(~rank.eqNullSafe(F.col("first")))
                          .select(F.col("id").alias(drop_id), F.col("key").alias(drop_key)),
                          "ngram-dropped")
    keyed = docs.withColumn(k, F.xxhash64(text_col))

    def without(some: DataFrame, chosen: DataFrame, how: str) -> DataFrame:
        # the chosen are ids: hashed if they are not broadcast, so that no text is sorted
        return some.join(sized_broadcast(chosen), F.col(id_col).eqNullSafe(F.col(drop_id))
                         & (F.col(k) == F.col(drop_key)), how)

    kept = without(keyed, dropped, "left_anti")
    again = rows.where("k > 1").select(F.col("id").alias(drop_id), F.col("key").alias(drop_key))
    if not again.isEmpty():  # equal ids of equal texts: one row of them
        once = without(kept, again, "left_semi").dropDuplicates([id_col, k])
        kept = without(kept, again, "left_anti").unionByName(once)
    return kept.drop(k)
