"""Hard negatives for anchors: slot-decomposed selection.

A positive with score p asks for the best rows of other labels whose scores lie in its
window, from ``low`` percent of p up to p. The windows of an anchor's positives overlap;
their upper limits p1 > p2 > ... cut the scores into disjoint slots: (p2, p1], (p3, p2],
..., and from the last limit down to the lowest lower limit. Each negative lies in one slot.

1. Positives: anchors and rows of the same label meet in a grid (``blocks.grid``); every
   cell keeps the best ``positives`` rows per anchor, the rest is a merge by rank.
2. Negatives: anchors with their limits and all rows meet in a second grid. Every cell is
   a combiner: it keeps the best ``negatives`` rows per anchor and slot while the rows
   stream past, so what is shuffled does not grow with the number of rows in a window.
3. The lists of a slot are merged by rank. From the last slot up, each slot's list in
   front of the best of those below gives the suffix lists: suffix i holds the best rows with
   scores up to p_i. A window is its suffix list down to its lower limit, so one merge
   answers all of them.

Scores are exact: vectors are whole numbers, and their products are taken in a type that holds
every sum (float64 below 2^53, else int64). A table whose largest component could push a
score beyond 63 bits is refused (``ValueError``).

Edge cases: rows with a null id, label or vector, or with a null component, take no part;
vectors of different lengths never meet; rows with an equal id are rows of their own, also as
anchors; equal scores are ordered by id, then by the place in the table; positives of equal
scores share a slot and get the same negatives; a negative p has an empty window; an
anchor without positives, and a positive without negatives, give no row; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rillflow.llm import blocks
from rillflow.session import materialize

#: positives of an anchor, negatives of a positive, lower limit in percent of its score
POSITIVES, NEGATIVES, LOW = 5, 5, 80
#: anchors and rows on the sides of a tile
_SIDE, _TILE = 256, 4096


def _best(anchor: np.ndarray, slot: np.ndarray, score: np.ndarray, order: tuple,
          k: int) -> np.ndarray:
    """Places of the best k entries per anchor and slot; ``order`` breaks ties."""
    at = np.lexsort((*reversed(order), -score, slot, anchor))
    a, s = anchor[at], slot[at]
    first = np.r_[True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])] if len(at) else np.zeros(0, bool)
    starts = np.flatnonzero(first)
    rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
    return at[rank < k]


class _Combiner:
    """The best rows per anchor and slot of a cell. ``limits`` are the slots' upper
    limits, descending, padded with the smallest number; ``floor`` the lowest score asked for."""

    def __init__(self, anchors: pa.Table, k: int, kind, same_label: bool, tile: int = _TILE):
        self.k, self.kind, self.same_label, self.tile = k, kind, same_label, tile
        self.rid = anchors.column("rid").to_numpy()
        self.label = anchors.column("label").to_pylist()
        self.x = blocks.vectors(anchors.column("v").combine_chunks(), kind)
        least = np.iinfo(np.int64).min
        if same_label:  # one slot for all scores
            self.limits = np.full((len(self.rid), 1), np.iinfo(np.int64).max)
            self.floor = np.full(len(self.rid), least)
        else:
            lists = anchors.column("limits").to_pylist()
            self.limits = np.full((len(lists), max(map(len, lists))), least)
            for i, one in enumerate(lists):
                self.limits[i, :len(one)] = one
            self.floor = np.asarray(anchors.column("floor").to_pylist(), np.int64)
        #: the k-th best score so far, of each anchor and slot
        self.worst = np.full(self.limits.shape, least)
        self.kept = pd.DataFrame({"anchor": np.zeros(0, np.int64), "slot": np.zeros(0, np.int64),
                                  "score": np.zeros(0, np.int64), "id": np.zeros(0, object),
                                  "rid": np.zeros(0, np.int64)})

    def add(self, rows: pa.Table) -> None:
        for start in range(0, rows.num_rows, self.tile):
            part = rows.slice(start, self.tile).combine_chunks()
            rid, ids = part.column("rid").to_numpy(), part.column("id").to_numpy()
            x = blocks.vectors(part.column("v").combine_chunks(), self.kind)
            codes, _ = pd.factorize(np.asarray(self.label + part.column("label").to_pylist(),
                                               dtype=object))
            ours, theirs = codes[:len(self.label)], codes[len(self.label):]
            found = [self._tile(slice(a, a + _SIDE), rid, ids, x, ours, theirs)
                     for a in range(0, len(self.rid), _SIDE)]
            self._keep(pd.concat([self.kept, *found], ignore_index=True))

    def _tile(self, at: slice, rid, ids, x, ours, theirs) -> pd.DataFrame:
        score = self.x[at] @ x.T
        same = ours[at][:, None] == theirs[None, :]
        wanted = same & (self.rid[at][:, None] != rid[None, :]) if self.same_label else ~same
        wanted &= (score >= self.floor[at][:, None]) & (score <= self.limits[at][:, :1])
        i, j = np.nonzero(wanted)
        value, i = score[i, j].astype(np.int64), i + at.start
        slot = (self.limits[i] >= value[:, None]).sum(axis=1) - 1
        good = value >= self.worst[i, slot]
        i, j, slot, value = i[good], j[good], slot[good], value[good]
        best = _best(i, slot, value, (ids[j], rid[j]), self.k)
        return pd.DataFrame({"anchor": i[best], "slot": slot[best], "score": value[best],
                             "id": ids[j[best]], "rid": rid[j[best]]})

    def _keep(self, rows: pd.DataFrame) -> None:
        anchor, slot, score = (rows[c].to_numpy(np.int64) for c in ("anchor", "slot", "score"))
        best = _best(anchor, slot, score, (rows["id"].to_numpy(), rows["rid"].to_numpy()), self.k)
        self.kept = rows.iloc[best].reset_index(drop=True)
        a, s, v = anchor[best], slot[best], score[best]
        for rank_end in np.flatnonzero(np.r_[(a[1:] != a[:-1]) | (s[1:] != s[:-1]), True]
                                       if len(a) else np.zeros(0, bool)):
            begin = rank_end - self.k + 1
            if begin >= 0 and a[begin] == a[rank_end] and s[begin] == s[rank_end]:
                self.worst[a[rank_end], s[rank_end]] = v[rank_end]

    def rows(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        if len(self.kept):
            k = self.kept
            columns = (self.rid[k["anchor"]], k["slot"], k["score"], k["id"], k["rid"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _combined(anchors: DataFrame, rows: DataFrame, k: int, kind, same_label: bool,
              block: int) -> DataFrame:
    """(anchor, slot, score, id, rid): the best k rows per anchor and slot of each cell."""
    dealt = blocks.grid(anchors, rows, block)
    schema = blocks.schema_of(rows, anchor="bigint", slot="bigint", score="bigint", id="=id",
                              rid="bigint")
    arrow = to_arrow_schema(schema)
    return dealt.mapInArrow(blocks.each_cell(
        lambda queries: _Combiner(queries, k, kind, same_label),
        lambda state, piece: state.add(piece), lambda state: state.rows(arrow)), schema)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best k per anchor and slot over all cells, with their rank."""
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "rid")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _suffixes(slots: Column, k: int) -> Column:
    """For lists of the slots in descending order of their limits: the best k of each slot
    and all below it."""
    none = F.slice(slots, 1, 0)

    def on(done: Column, one: Column) -> Column:
        below = F.coalesce(F.get(done, F.lit(0)), F.slice(F.flatten(slots), 1, 0))
        return F.concat(F.array(F.slice(F.concat(one, below), 1, k)), done)
    return F.aggregate(F.reverse(slots), none, on)


def mine(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
         vec_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, block: int = blocks.BLOCK) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for the
    first ``positives`` rows of an anchor's label, the first ``negatives`` rows of other
    labels with ``low * positive_score <= 100 * negative_score <= 100 * positive_score``.
    ``vec_col`` holds whole numbers; ``is_anchor`` is a condition on the columns of ``rows``."""
    v = F.col(vec_col)
    taken = materialize(
        rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & blocks.usable(v))
        .select(F.monotonically_increasing_id().alias("rid"),
                F.size(v).cast("bigint").alias("dim"), F.col(id_col).alias("id"),
                F.col(label_col).cast("string").alias("label"), v.cast("array<bigint>").alias("v"),
                F.coalesce(is_anchor, F.lit(False)).alias("asks")), "labelled-vectors")
    top = taken.agg(F.max(F.greatest(F.array_max("v"), -F.array_min("v"))).alias("most"),
                    F.max("dim").alias("dim")).first()
    largest = (top["most"] or 0) ** 2 * (top["dim"] or 0) * max(low, 100)
    if largest >= 1 << 63:
        raise ValueError(f"a component of {top['most']} can push scores beyond 63 bits")
    kind = np.float64 if largest < 1 << 53 else np.int64
    every, anchors = taken.drop("asks"), taken.where("asks").drop("asks")

    def same(df):  # anchors and rows of one label and length
        return df.withColumn("part", F.concat_ws(":", "dim", "label")).drop("dim")

    near = _merged(_combined(same(anchors), same(every), positives, kind, True, block), positives)
    near = materialize(near.select("anchor", "score", "id", "rid", "rank"), "positives")
    windows = near.where("score >= 0").groupBy("anchor").agg(
        F.reverse(F.array_sort(F.collect_set("score"))).alias("limits"))
    windows = windows.withColumn("floor", F.ceil(
        F.array_min("limits") * low / F.lit(100).cast("decimal(3,0)")).cast("bigint"))
    asked = anchors.join(windows, anchors["rid"] == windows["anchor"]) \
        .drop("anchor").withColumn("part", F.col("dim")).drop("dim")
    far = _merged(_combined(asked, every.withColumn("part", F.col("dim")).drop("dim"), negatives,
                            kind, False, block), negatives)
    entry = F.struct((-F.col("score")).alias("less"), "id", "rid")
    lists = far.groupBy("anchor").agg(F.array_sort(F.collect_list(
        F.struct("slot", entry.alias("e")))).alias("found"))
    slots = F.transform(F.sequence(F.lit(0), F.size("limits") - 1), lambda s: F.transform(
        F.filter("found", lambda f: f["slot"] == s), lambda f: f["e"]))
    suffixes = windows.join(lists, "anchor").select("anchor", "limits", _suffixes(slots, negatives)
                                                    .alias("suffixes"))
    ids = anchors.select(F.col("rid").alias("anchor"), F.col("id").alias("anchor_id"))
    pairs = near.join(suffixes, "anchor").join(ids, "anchor")
    own = F.get("suffixes", F.array_position("limits", F.col("score")).cast("int") - 1)
    window = F.filter(own, lambda e: -e["less"] * 100 >= F.col("score") * low)
    return pairs.select("anchor_id", F.col("id").alias("positive_id"),
                        F.col("score").alias("positive_score"), F.posexplode(window)
                        .alias("at", "e")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"),
        F.col("e.id").alias("negative_id"), "positive_score",
        (-F.col("e.less")).alias("negative_score"))
