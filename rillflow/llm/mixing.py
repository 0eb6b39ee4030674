"""Mixing sources to target weights (DataFrame functions only).

1. ``sized``: words and a hash per document; ``sources``: size, count, weight and
   target of each source. Targets share ``share`` times all words by weight; none
   exceeds ``most`` times its source's size, and the excess is reshared by weight
   among the others until none is above (one small aggregate per round).
2. ``quotas``: every source is cut into blocks of documents by hash (at most
   ``MAX_BLOCKS``, so the plan stays small however large the source is). A source takes
   all its blocks as often as its target holds whole passes, then its blocks in a
   permuted order up to the rest. Of the last block it takes documents in the order of their
   hashes, passing over those that exceed what is left, and in the end the smallest other one
   if the total comes nearer to the target with it than without (``cuts``).
3. ``split``: the splitting tree. The block quotas of all sources are partitioned
   among at most ``NODES`` nodes: each splits a multivariate hypergeometric share
   of its quotas to its left half, the rest to its right half. It needs one
   number per source (the quotas) on the driver, no document or block.
4. ``draws`` gives each source's permuted blocks to the nodes in disjoint runs. A node of several
   output shards deals a source's run to them in pieces of its blocks, cut by hash and
   permuted, the same number to each (``shard_of``): no row is moved or collected for it, and
   the blocks may be much larger than a shard. ``mix`` repeats and cuts the documents
   accordingly and shuffles each shard locally by a hash.

Everything depends on hashes and the seed alone, so reruns agree.

Edge cases: a null text has size 0 and is taken with 0 words; a null source is a
source of its own, after all others; a null id is hashed like any other; repeated
rows are documents of their own, drawn together; an empty table gives an empty
result; extra columns are kept by ``mix`` whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillflow.llm.common import WHITE, fresh
from rillflow.session import materialize

WEIGHTS = (5, 2, 1)
#: blocks of a source: one for each DOCS_PER_BLOCK documents, at most MAX_BLOCKS
DOCS_PER_BLOCK, MAX_BLOCKS = 64, 4096
#: words that an output shard aims at; leaves of the splitting tree at most
SHARD_WORDS, NODES = 8_000_000, 256
#: pieces of a block for each shard of a node; a prime that permutes them
PIECES, STRIDE = 16, 1_000_003
#: times that the documents of a last block are gone through
CUT_ROUNDS = 3
#: runs of positions that a shard is written in
RUNS = 8

#: a draw: pass, number in its node's run, length of that run, node, and of a last block the
#: documents that it takes: hashes from lo to hi, of at most ``most`` words
_CUT = "array<struct<lo:bigint,hi:bigint,most:bigint>>"


def words(text: Column) -> Column:
    """Number of runs of characters that are not white space; null: 0."""
    one_each = F.regexp_replace(text, f"[^{WHITE}]+", "x")
    return F.coalesce(F.length(F.translate(one_each, " \t\n\x0b\x0c\r", "")), F.lit(0)) \
        .cast("bigint")


def doc_hash(*cols: str) -> Column:
    return F.xxhash64(*cols)


def sources(docs: DataFrame, share: float = 1.5, most: int = 2,
            weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per source of ``docs`` (source, size, ...): rank, source_size, blocks, target.
    The weights repeat over the sources in code-point order, null last."""
    per = docs.groupBy("source").agg(F.sum("size").alias("source_size"),
                                     F.count(F.lit(1)).alias("n_docs"))
    # one row per source: a single window over them
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("rank", rank).withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights)))))
    per = materialize(per, "mix-sources")
    cap = F.col("source_size") * float(most)
    level, before = 0.0, -1.0
    total = (per.agg(F.sum("source_size")).first()[0] or 0) * share
    while level != before:  # the level only rises, so the capped sources only grow
        before, capped = level, F.col("weight") * level > cap
        held, open_ = per.agg(F.coalesce(F.sum(F.when(capped, cap)), F.lit(0.0)),
                              F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0))).first()
        level = (total - held) / open_ if open_ else before
    return per.select(
        "source", "rank", "source_size",
        F.least(F.ceil(F.col("n_docs") / DOCS_PER_BLOCK), F.lit(MAX_BLOCKS)).cast("int")
        .alias("blocks"),
        F.least(cap, F.col("weight") * level).alias("target"))


def in_blocks(docs: DataFrame, srcs: DataFrame) -> DataFrame:
    """``docs`` plus their source's columns and their block."""
    s = srcs.withColumnRenamed("source", "_source")
    return docs.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source") \
        .withColumn("block", F.pmod("hash", "blocks").cast("int"))


def quotas(placed: DataFrame, seed: int) -> DataFrame:
    """Per (rank, block): ``passes`` whole draws, and ``cut`` if a last draw takes some of its
    documents only (null: no such draw)."""
    per = placed.groupBy("rank", "block").agg(
        F.sum("size").alias("words"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"))
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    rest = F.col("target") - whole * F.col("source_size")
    # at most MAX_BLOCKS rows a window
    order = Window.partitionBy("rank").orderBy(F.xxhash64(F.lit(seed), "rank", "block"), "block")
    upto = F.sum("words").over(order)
    per = materialize(per.select(
        "rank", "block", F.row_number().over(order).alias("nth"), whole.alias("whole"),
        ((upto <= rest) & (rest > 0)).alias("drawn"),
        F.when((upto > rest) & (upto - F.col("words") < rest), rest - (upto - F.col("words")))
        .alias("left_over")), "mix-blocks")
    last = per.where("left_over > 0").select("rank", "block", F.col("left_over").alias("left"))
    return materialize(per.join(cuts(placed, last), ["rank", "block"], "left").select(
        "rank", "block", "nth", (F.col("whole") + F.col("drawn").cast("int")).alias("passes"),
        "cut"), "mix-quotas")


def cuts(placed: DataFrame, last: DataFrame) -> DataFrame:
    """Per (rank, block) of ``last``, of which ``left`` words are to be taken: ``cut``, the
    documents to take as ranges of hashes with a largest size."""
    at = ["rank", "block"]
    # rows with one hash are taken together
    docs = materialize(placed.join(last.select(*at), at).where("size > 0").groupBy(
        *at, "hash").agg(F.sum("size").alias("words"), F.max("size").alias("size")), "mix-last")
    now = last.select(*at, "left", F.lit(None).cast("bigint").alias("after"),
                      F.array().cast(_CUT).alias("cut"))
    by_hash = Window.partitionBy(*at).orderBy("hash")
    for _ in range(CUT_ROUNDS):
        fit = docs.join(now, at).where((F.col("after").isNull() | (F.col("hash") > F.col("after")))
                                       & (F.col("size") <= F.col("left")))
        taken = fit.withColumn("upto", F.sum("words").over(by_hash)) \
            .where("upto <= left").groupBy(*at).agg(
                F.max("upto").alias("took"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        one = F.struct("lo", "hi", F.floor("left").cast("bigint").alias("most"))
        now = materialize(now.join(taken, at, "left").select(
            *at, (F.col("left") - F.coalesce("took", F.lit(0))).alias("left"),
            F.coalesce("hi", "after").alias("after"),
            F.when(F.col("took").isNotNull(), F.array_append("cut", one)).otherwise(F.col("cut"))
            .alias("cut")), "mix-cuts")
    other = docs.join(now, at).where(~_within("cut", "hash", F.col("size"))).groupBy(*at).agg(
        F.min_by(F.struct("words", "hash", "size"), F.struct("words", "hash")).alias("o"))
    nearer = F.col("o.words") < 2 * F.col("left")
    return now.join(other, at, "left").select(*at, F.when(nearer, F.array_append(
        "cut", F.struct(F.col("o.hash").alias("lo"), F.col("o.hash").alias("hi"),
                        F.col("o.size").alias("most")))).otherwise(F.col("cut")).alias("cut"))


def _within(cut, hash_col: str, size: Column) -> Column:
    """Whether a cut takes a document."""
    return F.exists(cut, lambda r: F.col(hash_col).between(r["lo"], r["hi"])
                    & (size <= r["most"]))


def split(counts: list[int], shards: int, seed: int) -> list[tuple[int, int, int, int]]:
    """(source, shard, first, end): the run of each source's quota that each shard
    gets, by the splitting tree."""
    rng = np.random.Generator(np.random.PCG64(seed))
    runs, first = [], [0] * len(counts)

    def deal(quota: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo == 1:
            for s in np.flatnonzero(quota):
                n = int(quota[s])
                runs.append((int(s), lo, first[s], first[s] + n))
                first[s] += n
            return
        mid = (lo + hi) // 2
        n = int(quota.sum())
        left = rng.multivariate_hypergeometric(
            quota, n * (mid - lo) // (hi - lo), method="marginals") if n else quota
        deal(left, lo, mid)
        deal(quota - left, mid, hi)

    deal(np.asarray(counts, dtype=np.int64), 0, shards)
    return runs


def draws(plan: DataFrame, total_words: float, seed: int) -> DataFrame:
    """Per (rank, block): ``draws``, an array of (pass, node, nth, of, width, cut): the nodes
    that its draws go to, each one's number in its source's run of ``of`` draws there, and the
    node's shards."""
    spark = plan.sparkSession
    one = plan.select("rank", "block", F.explode(F.concat(
        F.transform(F.when(F.col("passes") > 0, F.sequence(F.lit(1), "passes"))
                    .otherwise(F.array().cast("array<int>")),
                    lambda p: F.struct(p.alias("pass"), F.lit(None).cast(_CUT).alias("cut"))),
        F.when(F.size("cut") > 0, F.array(F.struct(
            (F.col("passes") + 1).cast("int").alias("pass"), "cut")))
        .otherwise(F.array().cast(f"array<struct<pass:int,cut:{_CUT}>>")))).alias("d")) \
        .select("rank", "block", "d.pass", "d.cut")
    # each pass in its own permuted order; at most a few times MAX_BLOCKS rows a window
    nth = F.row_number().over(Window.partitionBy("rank").orderBy(
        F.xxhash64(F.lit(seed + 1), "rank", "pass", "block"), "block", "pass")) - 1
    one = one.withColumn("at", nth)
    counts = {r["rank"]: r["n"] for r in one.groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
              .collect()}
    width = max(1, math.ceil(total_words / SHARD_WORDS / NODES))  # shards of a node
    nodes = max(1, math.ceil(total_words / SHARD_WORDS / width))
    runs = split([counts.get(r, 0) for r in range(max(counts, default=-1) + 1)], nodes, seed)
    dealt = spark.createDataFrame(runs, "rank int, node int, first int, end int") \
        .select("rank", "node", "first", (F.col("end") - F.col("first")).alias("of"),
                F.explode(F.sequence("first", F.col("end") - 1)).alias("at"))
    return one.join(dealt, ["rank", "at"]).groupBy("rank", "block").agg(F.array_sort(
        F.collect_list(F.struct("pass", "node", (F.col("at") - F.col("first")).alias("nth"), "of",
                                F.lit(width).alias("width"), "cut"))).alias("draws"))


def shard_of(draw: Column, hash_col: str, seed: int) -> Column:
    """The output shard of a document's draw. A node's run of a source's draws is cut into
    pieces, ``PIECES`` a block for each shard, numbered through; a stride coprime to their number
    permutes them, and each shard gets as many."""
    pieces = draw["width"].cast("bigint") * PIECES
    n = pieces * draw["of"]
    number = draw["nth"] * pieces + F.pmod(F.xxhash64(F.lit(seed + 3), hash_col), pieces)
    return (draw["node"] * draw["width"] + F.floor(
        (number * STRIDE % n) * draw["width"] / n)).cast("int")


def plan_mix(sized: DataFrame, seed: int = 0, **how) -> tuple[DataFrame, DataFrame]:
    """(sources, draws per block) for documents with source, size and hash."""
    srcs = materialize(sources(sized, **how), "mix-targets")
    total = srcs.agg(F.sum("target")).first()[0] or 0.0
    plan = quotas(in_blocks(sized, srcs), seed)
    return srcs, materialize(draws(plan, total, seed), "mix-draws")


def drawn(sized: DataFrame, srcs: DataFrame, blocks: DataFrame,
          size: Column | None = None) -> DataFrame:
    """``sized`` plus source_size, target and ``draws`` of each time that the document is
    taken. ``size`` is read only of documents in a last block."""
    placed = in_blocks(sized, srcs).join(blocks, ["rank", "block"], "left")
    size = F.col("size") if size is None else size
    taken = F.filter("draws", lambda d: F.when(d["cut"].isNull(), True).otherwise(
        _within(d["cut"], "hash", size)))
    return placed.withColumn("draws", F.coalesce(taken, F.array().cast(
        blocks.schema["draws"].dataType)))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source") -> DataFrame:
    """(id, source, size, hash) of each document, as a table of its own: the text is
    read once."""
    return materialize(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        words(F.col(text_col)).alias("size"), doc_hash(id_col, text_col).alias("hash")),
        "mix-sizes")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", seed: int = 0, **how) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as it is taken, plus
    ``shard`` and ``position``; a shard's rows lie in ``RUNS`` runs of positions, each
    together and in shuffled order."""
    srcs, blocks = plan_mix(measure(docs, id_col, text_col, source_col), seed, **how)
    shard, at = fresh(docs, "shard", "position")
    row = docs.select(F.struct("*").alias("row"), F.col(source_col).alias("source"),
                      doc_hash(id_col, text_col).alias("hash"))
    out = drawn(row, srcs, blocks, words(F.col("row")[text_col])).select(
        "row", "hash", F.explode("draws").alias("d"))
    order = F.xxhash64(F.lit(seed + 2), "hash", "d.pass")
    return out.select("row.*", shard_of(F.col("d"), "hash", seed).alias(shard), order.alias(at)) \
        .repartition(F.col(shard), F.floor(F.col(at) / (2.0 ** 64 / RUNS))) \
        .sortWithinPartitions(shard, at)
