"""Near-duplicate vectors: int8 tile products with rigorous error bounds.

1. Equal vectors are one node with a count (``distinct_vectors``), so thousands of
   copies cost one.
2. The nodes are dealt to cells, each around its nearest pivot (``PIVOTS`` sampled
   vectors at most; the sample decides the layout only, never the result). A vector
   must be compared with a cell only if its angle to the pivot is at most the
   cell's radius plus the threshold's angle: an exact bound, by which most tiles fall away
   where the vectors cluster. Cells and their visitors are cut into tiles of about
   ``TILE`` vectors a side, so a task's memory is bounded however large a cell is.
3. In a tile the unit vectors are quantised to int8 with a scale each; the products
   of the integers, taken as float32 (exact: below 2^24), differ from the cosine by
   at most ``e_u + e_v + e_u e_v`` with the vectors' known quantisation errors. Only
   pairs possibly above the threshold are recomputed in double precision.
4. A tile returns one row per linked vector: its number of links and its root
   in the tile's forest, never the pairs. Counts are summed, forests joined by
   ``components``.

Edge cases: a null, empty or zero vector, or one with a null or non-finite
component, links with nothing; so does a row with a null id (its component is null and
it is not kept); vectors of different lengths never link; rows with an equal id are
vectors of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.llm.components import components, unite
from rillflow.session import materialize

THRESHOLD = 0.95
#: vectors on a side of a tile
TILE = 8192
#: pivots at most
PIVOTS = 1024
_SUB = 1024
_SLACK = 1e-9


def usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine
                      & F.exists(v, lambda x: x != 0), F.lit(False))


def node_of(v: Column) -> Column:
    """128 bits of two hashes: equal vectors, and only they, have the same node."""
    return F.concat(F.hex(F.xxhash64(v)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), v)))


def unit(rows: pd.Series) -> np.ndarray:
    x = np.stack([np.asarray(r, dtype=np.float64) for r in rows])
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values (as float32, for the matrix product), scales and error norms of
    unit vectors."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None])
    error = np.linalg.norm(x - q * scale[:, None], axis=1)
    return q.astype(np.float32), scale, error


def tile_links(x: np.ndarray, first: range, second: range, threshold: float,
               links) -> None:
    """Calls ``links(i, j)`` with arrays of linked pairs between two ranges of rows;
    each pair once if the ranges are the same. Integer products are exact in float32
    up to 1,000 dimensions; beyond, in float64."""
    q, scale, error = quantise(x)
    if x.shape[1] > 1000:
        q = q.astype(np.float64)
    same = first == second
    for a in range(first.start, first.stop, _SUB):
        ra = slice(a, min(a + _SUB, first.stop))
        for b in range(a if same else second.start, second.stop, _SUB):
            rb = slice(b, min(b + _SUB, second.stop))
            near = (q[ra] @ q[rb].T) * scale[ra, None]
            near *= scale[None, rb]
            near += error[ra, None] + error[None, rb] + error[ra, None] * error[None, rb]
            i, j = np.nonzero(near >= threshold - _SLACK)
            i, j = i + ra.start, j + rb.start
            if same and a == b:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 1 << 16):
                u, v = i[k:k + (1 << 16)], j[k:k + (1 << 16)]
                sure = np.einsum("ij,ij->i", x[u], x[v]) >= threshold
                if sure.any():
                    links(u[sure], v[sure])


def _tile(threshold: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["home", "node"], ascending=[False, True], ignore_index=True)
        x, n = unit(rows["v"]), int(rows["home"].sum())
        copies = rows["copies"].to_numpy(np.int64)
        count, state = np.zeros(len(rows), np.int64), [np.arange(len(rows))]

        def links(i, j):
            np.add.at(count, i, copies[j])
            np.add.at(count, j, copies[i])
            state[0] = unite(state[0], i, j)

        if rows["vchunk"].iloc[0] == 0:  # the home vectors meet each other in one tile
            tile_links(x, range(n), range(n), threshold, links)
        tile_links(x, range(n), range(n, len(rows)), threshold, links)
        at = np.flatnonzero(count)
        node = rows["node"].to_numpy()
        return pd.DataFrame({"node": node[at], "n": count[at], "root": node[state[0][at]]})
    return run


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(node, copies, v) of the usable rows with an id."""
    return rows.where("usable").groupBy("node").agg(F.count(F.lit(1)).alias("copies"),
                                                    F.first("v").alias("v"))


def linked(nodes: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(node, n, root) per tile and linked node, over all pairs of ``nodes``
    (node, copies, v)."""
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy(F.size("v").alias("dim")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    found = [_linked_of(nodes.where(F.size("v") == dim), n, threshold, tile)
             for dim, n in sizes.items()]
    if not found:
        return nodes.select("node", F.col("copies").alias("n"), F.col("node").alias("root")) \
            .limit(0)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _linked_of(nodes: DataFrame, total: int, threshold: float, tile: int) -> DataFrame:
    reach = math.acos(threshold) + 1e-6
    n_pivots = max(1, min(PIVOTS, total // tile))
    pivots = unit(pd.Series([r["v"] for r in nodes.orderBy(F.xxhash64("node")).limit(n_pivots)
                             .select("v").collect()]))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                angle = np.arccos(np.clip(unit(rows["v"]) @ pivots.T, -1, 1))
                rows = rows.assign(cell=angle.argmin(axis=1).astype(np.int32),
                                   angles=list(angle.astype(np.float64)))
                yield rows[["node", "copies", "v", "cell", "angles"]]

    kind = nodes.schema["v"].dataType.simpleString()
    placed = materialize(nodes.select("node", "copies", "v").mapInPandas(
        place, f"node string, copies bigint, v {kind}, cell int, angles array<double>"), "cells")
    cells = {r["cell"]: r for r in placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.element_at("angles", F.col("cell") + 1)).alias("radius")).collect()}
    chunks = [-(-cells[c]["n"] // tile) if c in cells else 0 for c in range(n_pivots)]
    limit = [cells[c]["radius"] + reach + 1e-6 if c in cells else -1.0 for c in range(n_pivots)]
    vchunks = max(1, -(-total // tile))
    chunk_of = F.array(*map(F.lit, chunks))
    h = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 40))
    own = F.pmod(h, F.get(chunk_of, F.col("cell"))).cast("int")
    vchunk = F.pmod(F.floor(h / 65536), F.lit(vchunks)).cast("int")
    placed = placed.withColumn("chunk", own).withColumn("vc", vchunk)

    def at(cell, chunk, vc, home: int):
        return F.struct(cell.cast("int").alias("cell"), chunk.cast("int").alias("chunk"),
                        vc.cast("int").alias("vchunk"), F.lit(home).alias("home"))

    homes = F.transform(F.sequence(F.lit(0), F.lit(vchunks - 1)),
                        lambda k: at(F.col("cell"), F.col("chunk"), k, 1))
    visited = F.filter(F.sequence(F.lit(0), F.lit(n_pivots - 1)), lambda c: (c < F.col("cell")) & (
        F.get("angles", c) <= F.get(F.array(*map(F.lit, limit)), c)))
    none = F.array().cast("array<int>")

    def upto(k):
        return F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(none)

    visits = F.concat(
        F.flatten(F.transform(visited, lambda c: F.transform(
            upto(F.get(chunk_of, c)), lambda k: at(c, k, F.col("vc"), 0)))),
        F.transform(upto(F.col("chunk")), lambda k: at(F.col("cell"), k, F.col("vc"), 0)))
    dealt = placed.select("node", "copies", "v", F.explode(F.concat(homes, visits)).alias("t")) \
        .select("node", "copies", "v", "t.*")
    return dealt.groupBy("cell", "chunk", "vchunk").applyInPandas(
        _tile(threshold), "node string, n bigint, root string")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per vector: id, n_links (other vectors with a cosine of at least the
    threshold), component_id (smallest id reachable by links), kept."""
    v = F.col(vec_col)
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v"))
    rows = rows.withColumn("usable", usable(F.col("v")) & F.col("id").isNotNull()) \
        .withColumn("node", F.when(F.col("usable"), node_of(F.col("v"))))
    nodes = materialize(distinct_vectors(rows), "vectors")
    found = materialize(linked(nodes, threshold, tile), "tile-links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    per_node = nodes.select("node", "copies").join(counts, "node", "left") \
        .join(roots, "node", "left").select(
            "node", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "node").alias("root"))
    members = rows.select("id", "node").join(per_node, "node", "left")
    low = members.groupBy("root").agg(F.min("id").alias("low"))  # null root: no links
    out = members.join(low, "root", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("low")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False)))
