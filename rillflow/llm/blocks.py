"""A stated set of query rows against all rows, in a grid of bounded blocks.

The grid has a cell for each (part, block of queries, share of the rows); queries and rows
meet only if their ``part`` is the same. A cell holds about ``block`` queries in memory
and streams its rows past them, so a task's memory does not depend on the rows; the rows are
dealt to shares by a running number, so neither equal rows nor a part with a third of
all rows end up in one cell. Shares get larger with the input (``MOST_ROWS`` at most), which
keeps the copies of the queries few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillflow.operators.joins import sized_broadcast

#: queries of a cell, about
BLOCK = 4096
#: rows of a cell: from, to
LEAST_ROWS, MOST_ROWS = 4096, 1 << 20

State = object


def usable(v: Column) -> Column:
    """Neither null nor empty, without null or non-finite components."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine, F.lit(False))


def grid(queries: DataFrame, rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``queries`` and ``rows`` (both: ``part``, ``rid`` bigint, then columns of their
    own) dealt to cells: the columns of both, ``cell`` and ``kind`` (0: a query, 1: a row),
    sorted by these within partitions."""
    spark = queries.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    asked = queries.groupBy("part").agg(F.count(F.lit(1)).alias("q"))
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).join(asked, "part") \
        .select("part", "n", F.ceil(F.col("q") / block).alias("blocks"))
    work = sizes.agg(F.sum(F.col("n") * F.col("blocks"))).first()[0] or 0
    share = min(MOST_ROWS, max(LEAST_ROWS, -(-work // tasks)))
    plan = sized_broadcast(sizes.select(
        "part", "blocks", F.ceil(F.col("n") / share).alias("shares")))

    def numbers(n):
        return F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))

    q = queries.join(plan, "part").withColumn("_block", F.pmod(F.xxhash64("rid"), "blocks")) \
        .withColumn("_share", numbers(F.col("shares"))).withColumn("kind", F.lit(0))
    r = rows.join(plan, "part").withColumn("_share", F.pmod("rid", "shares")) \
        .withColumn("_block", numbers(F.col("blocks"))).withColumn("kind", F.lit(1))
    both = q.unionByName(r, allowMissingColumns=True).drop("blocks", "shares")
    cell = F.concat_ws("/", *[F.col(c).cast("string") for c in ("part", "_block", "_share")])
    return both.withColumn("cell", cell).drop("part", "_block", "_share") \
        .repartition(tasks, "cell").sortWithinPartitions("cell", "kind")


def vectors(column: pa.Array, dtype) -> np.ndarray:
    """A list column without nulls, of one length, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False) \
        .reshape(len(column), -1)


def each_cell(begin: Callable[[pa.Table], State], add: Callable[[State, pa.Table], None],
              end: Callable[[State], Iterator[pa.RecordBatch]]):
    """For ``mapInArrow`` over a ``grid``: ``begin`` takes the queries of a cell, ``add`` a
    batch of its rows, ``end`` gives its results."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, state = None, [], None
        for batch in batches:
            names = np.asarray(batch.column("cell").to_pylist(), dtype=object)
            kinds = batch.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero((names[1:] != names[:-1])
                                         | (kinds[1:] != kinds[:-1])) + 1), len(names)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if names[a] != cell:
                    if state is not None:
                        yield from end(state)
                    cell, waiting, state = names[a], [], None
                piece = pa.Table.from_batches([batch.slice(a, b - a)])
                if kinds[a] == 0:
                    waiting.append(piece)
                    continue
                if state is None and not waiting:
                    continue  # a block that no query was dealt to
                if state is None:
                    state, waiting = begin(pa.concat_tables(waiting)), []
                add(state, piece)
        if state is not None:
            yield from end(state)
    return run


def schema_of(df: DataFrame, **columns: str) -> T.StructType:
    """Result columns, those named like ``=col`` with that column's type in ``df``."""
    return T.StructType([T.StructField(
        name, df.schema[kind[1:]].dataType if kind[0] == "=" else T._parse_datatype_string(kind))
        for name, kind in columns.items()])
