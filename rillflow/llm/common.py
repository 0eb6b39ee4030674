"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: white space of the word contracts: \x20 and \x09-\x0D, as in Python's bytes.split()
WHITE = "\\x20\\x09-\\x0D"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased; every other character is left alone."""
    return F.translate(c, _UPPER, _UPPER.lower())


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that ``df`` does not have (case-insensitively), one per base."""
    taken, out = {c.lower() for c in df.columns}, []
    for base in bases:
        name = base
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def batch_rows(spark: SparkSession, rows: int) -> None:
    """Rows per Arrow batch, so that a batch of long texts stays small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def release_memory() -> None:
    """Gives freed memory back to the system: Spark keeps its Python workers for later stages,
    and an idle one should hold as little as a new one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


@F.pandas_udf(T.BinaryType())
def packed(texts: pd.Series) -> pd.Series:
    """Texts compressed one by one: less to shuffle than a block codec leaves."""
    return pd.Series([None if t is None else zlib.compress(t.encode(), 1) for t in texts],
                     dtype=object)


@F.pandas_udf(T.StringType())
def unpacked(data: pd.Series) -> pd.Series:
    return pd.Series([None if d is None else zlib.decompress(d).decode() for d in data],
                     dtype=object)


def with_next(docs: DataFrame, id_col: str, text_col: str, out: str) -> DataFrame:
    """``docs`` (id, text) plus ``out``: the text of the next row by descending id (null
    ids last, equal ids by a hash of the text); after the last row comes the first. The
    texts are shuffled once, packed.

    The ids are cut at their quantiles into one range for each shuffle partition;
    within a range a window finds the next row. The first row of each range is
    copied to the range before it. On the driver: two numbers per range.
    """
    spark, i = docs.sparkSession, F.col(id_col)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx(i, [k / n for k in range(1, n)] or [0.5], 10_000)) \
        .first()[0] or []
    cuts = sorted(set(cuts)) if n > 1 else []
    part = F.when(i.isNull(), F.lit(0)).otherwise(
        F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<bigint>"), lambda c: c < i)) + 1)
    placed = docs.select(id_col, F.col(text_col), F.xxhash64(text_col).alias("_hash"),
                         part.alias("_part"))
    tops = {r["_part"]: r["top"] for r in placed.groupBy("_part").agg(
        F.max(id_col).alias("top")).collect()}
    order = sorted(tops, reverse=True)
    goes = {p: order[k - 1] for k, p in enumerate(order)}  # the first one's goes to the last

    def by_part(values: dict, kind: str) -> Column:
        return F.get(F.array(*[F.lit(values.get(p)) for p in range(len(cuts) + 2)])
                     .cast(f"array<{kind}>"), F.col("_part"))

    copies = F.concat(
        F.array(F.struct(F.col("_part").alias("part"), F.lit(0).alias("copy"))),
        F.when(i.eqNullSafe(by_part(tops, "bigint")), F.array(F.struct(
            by_part(goes, "int").alias("part"), F.lit(1).alias("copy"))))
        .otherwise(F.array().cast("array<struct<part:int,copy:int>>")))
    rows = placed.select(id_col, packed(text_col).alias("_text"), "_hash",
                         F.explode(copies).alias("_at")) \
        .select(id_col, "_text", "_hash", F.col("_at.part").alias("_part"),
                F.col("_at.copy").alias("_copy"))
    nxt = F.lead("_text").over(Window.partitionBy("_part").orderBy(
        "_copy", i.desc_nulls_last(), "_hash"))
    return rows.withColumn("_next", nxt).where("_copy = 0").select(
        id_col, unpacked("_text").alias(text_col), unpacked("_next").alias(out))
