"""Nearest neighbours by cosine: a block matrix join with int8 tile products.

1. Queries and candidates meet in the cells of a grid (``blocks.grid``): a block of queries
   against a share of the candidates, which are streamed past it in tiles.
2. In a tile the unit vectors are quantised to int8 with a scale each. The product of the
   integers, times the scales, differs from the cosine by at most ``e_u + e_v + e_u e_v``,
   ``e`` being the known length of a vector's quantisation error.
3. A pair survives if its upper bound reaches both the query's k-th best score so far
   and the k-th largest lower bound of the tile. Only survivors are recomputed, in double
   precision on the original vectors, and go into the query's heap.
4. The heaps of a query's cells are merged by rank; each holds k entries at most.

No pair is missed: the bounds hold for every pair, so the result is exact (recall 1).

The score is the sum of products divided by the product of both lengths, each sum taken
component by component in double precision; vectors whose sums leave its range
are scaled by a power of two first, which changes no digit.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take
no part; nor do rows with a null id; vectors of different lengths never meet; rows with an
equal id are rows of their own (a repeated query is answered as often as it is there); equal
scores are ordered by id, then by the place in the table; fewer candidates than k are all
returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rillflow.llm import blocks
from rillflow.session import materialize

#: neighbours of a query
NEAREST = 5
#: queries and candidates on the sides of a tile
_SIDE, _TILE = 512, 4096
#: above the rounding of a float32 product and of its two scalings
_SLACK = 1e-6


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two, such that their largest components lie between 1 and 2."""
    _, exponent = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x, 1 - exponent[:, None])


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.cumsum(x * x, axis=1)[:, -1])


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers from -127 to 127 (as float32, in which their products are exact up to
    1,000 dimensions; else as float64), scales, and lengths of the errors."""
    scale = np.abs(unit).max(axis=1) / 127
    whole = np.rint(unit / scale[:, None])
    error = np.linalg.norm(unit - whole * scale[:, None], axis=1)
    return whole.astype(np.float32 if unit.shape[1] <= 1000 else np.float64), scale, error


class _Block:
    """The queries of a cell and their best candidates so far."""

    def __init__(self, queries: pa.Table, k: int):
        self.rid = queries.column("rid").to_numpy()
        self.id = queries.column("id").to_pylist()
        self.x, self.size, self.code = _prepared(queries)
        self.k = k
        #: heaps of (score, order of the id reversed): the worst entry first
        self.heaps: list[list[tuple]] = [[] for _ in self.id]
        self.floor = np.full(len(self.id), -2.0)

    def add(self, rows: pa.Table) -> None:
        for start in range(0, rows.num_rows, _TILE):
            part = rows.slice(start, _TILE).combine_chunks()
            rid, vid = part.column("rid").to_numpy(), part.column("id").to_pylist()
            x, size, code = _prepared(part)
            for a in range(0, len(self.id), _SIDE):
                self._tile(slice(a, a + _SIDE), rid, vid, x, size, code)

    def _tile(self, at: slice, rid, vid, x, size, code) -> None:
        (q, q_scale, q_error), (c, c_scale, c_error) = (
            tuple(v[at] for v in self.code), code)
        near = (q @ c.T).astype(np.float64)
        near *= q_scale[:, None]
        near *= c_scale[None, :]
        room = q_error[:, None] + c_error[None, :] + q_error[:, None] * c_error[None, :] + _SLACK
        own = self.rid[at][:, None] == rid[None, :]
        near[own] = -4.0
        if near.shape[1] >= self.k:
            low = np.partition(near - room, -self.k, axis=1)[:, -self.k]
            floor = np.maximum(self.floor[at], low)
        else:
            floor = self.floor[at]
        i, j = np.nonzero((near + room >= floor[:, None]) & ~own)
        for s in range(0, len(i), 1 << 16):
            u, v = i[s:s + (1 << 16)] + at.start, j[s:s + (1 << 16)]
            dots = np.cumsum(self.x[u] * x[v], axis=1)[:, -1]
            for n, m, score in zip(u.tolist(), v.tolist(), (dots / (self.size[u] * size[v]))
                                   .tolist()):
                entry = (score, _Down((vid[m], int(rid[m]))))
                heap = self.heaps[n]
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
                if len(heap) == self.k:
                    self.floor[n] = heap[0][0]

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        out = [(self.rid[n], self.id[n], e[1].value[0], e[1].value[1], e[0])
               for n, heap in enumerate(self.heaps) for e in heap]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


class _Down:
    """Turns the order of a value around."""
    __slots__ = ("value",)

    def __init__(self, value):
        self.value = value

    def __lt__(self, other):
        return other.value < self.value

    def __eq__(self, other):
        return other.value == self.value


def _prepared(rows: pa.Table):
    x = scaled(blocks.vectors(rows.column("v").combine_chunks(), np.float64))
    size = lengths(x)
    return x, size, quantised(x / size[:, None])


def nearest(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding",
            k: int = NEAREST, block: int = blocks.BLOCK) -> DataFrame:
    """(query_id, rank, <id_col>, score): the ``k`` nearest rows of each row that
    ``is_query`` (a condition on the columns of ``rows``) names, nearest first."""
    v = F.col(vec_col)
    taken = rows.where(F.col(id_col).isNotNull() & blocks.usable(v)
                       & F.exists(v, lambda x: x != 0)) \
        .select(F.monotonically_increasing_id().alias("rid"),
                F.size(v).cast("bigint").alias("part"), F.col(id_col).alias("id"),
                v.alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    taken = materialize(taken, "vectors")
    every = taken.drop("asks")
    dealt = blocks.grid(taken.where("asks").drop("asks"), every, block) \
        .select("cell", "kind", "rid", "id", "v")
    schema = blocks.schema_of(every, query="=rid", query_id="=id", id="=id", rid="=rid",
                              score="double")
    arrow = to_arrow_schema(schema)
    found = dealt.mapInArrow(blocks.each_cell(
        lambda queries: _Block(queries, k), lambda state, piece: state.add(piece),
        lambda state: state.rows(arrow)), schema)
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id", "rid")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
