"""Dimension job: routing by config (JOI-1, STA-3), config-driven column
pruning (PRJ-4), row keys (PRJ-5) and the cell-level snapshot (SNK-2, STA-4).

Batch form: every change meets the config in force at its position (an as-of
join to the config ops), so config edits in the middle of the stream apply
exactly where they happened, and the generation of its sink table in force there. A
snapshot keeps the changes of live generations by an equi-join. It is one
partial aggregation per cell and a window over a row's aggregated cells (at most one
per column).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillflow.functions.jsonvar import keep_keys
from rillflow.operators.config import FIELDS
from rillflow.operators.carry import asof_join
from rillflow.operators.joins import sized_broadcast

ROUTE_COLS = (*FIELDS[1:], "op")


def route_changes(changes: DataFrame, ops: DataFrame, limit: int | None = None) -> DataFrame:
    """JOI-1 (batch): each change meets the last op of its table before it; a change before the
    first op, or after a d, is dropped."""
    return asof_join(changes, ops, "table", "source_table", "seq", "seq", list(ROUTE_COLS),
                     in_force=~F.col("op").eqNullSafe("d"), limit=limit)


def route_latest(changes: DataFrame, latest: DataFrame, limit: int | None = None) -> DataFrame:
    """JOI-1 (per micro-batch): equi join to the latest config per source table."""
    cfg = sized_broadcast(latest.select("source_table", *ROUTE_COLS), limit)
    return changes.join(cfg, changes["table"] == cfg["source_table"]).drop("source_table")


def prune_columns(routed: DataFrame) -> DataFrame:
    """PRJ-4: keep only ``data`` keys listed in ``sink_columns`` (comma split,
    no trimming, exact match)."""
    return routed.withColumn("data", keep_keys(F.col("data"), F.split("sink_columns", ",")))


def with_row_key(routed: DataFrame) -> DataFrame:
    """PRJ-5: the value of the column the config names as row key."""
    return routed.withColumn("row_key", F.try_element_at("data", F.col("sink_row_key")))


def bad_row_keys(keyed: DataFrame) -> DataFrame:
    """D16: changes whose row key is missing (e.g. pruned away): quarantined."""
    return keyed.where(F.col("row_key").isNull())


def with_generation(routed: DataFrame, generations: DataFrame,
                    limit: int | None = None) -> DataFrame:
    """SNK-3 (batch): the ``generation`` of the sink table at each change's position. A
    change to a table that does not exist there is lost, like a put to it."""
    opened = generations.select(F.col("sink_table").alias("_table"), "seq", "generation")
    return asof_join(routed, opened, "sink_table", "_table", "seq", "seq", ["generation"],
                     in_force=F.col("generation").isNotNull(), limit=limit)


def with_current_generation(routed: DataFrame, lifecycle: DataFrame,
                            limit: int | None = None) -> DataFrame:
    """SNK-3 (per micro-batch): the generation that is live when the batch is routed, null
    for a table that does not exist."""
    live = lifecycle.where("live").select("sink_table", F.col("reset_seq").alias("generation"))
    return routed.join(sized_broadcast(live, limit), "sink_table", "left")


def apply_lifecycle(keyed: DataFrame, lifecycle: DataFrame, limit: int | None = None,
                    resets: bool = True) -> DataFrame:
    """SNK-3: keep changes that belong to the live generation of their sink table.

    ``resets=False`` switches the drop-and-recreate data loss off (D11): every
    change to a live table is kept."""
    live = lifecycle.where("live").select("sink_table", F.col("reset_seq").alias("_live"))
    out = keyed.join(sized_broadcast(live, limit), "sink_table")
    if resets:
        out = out.where(F.col("generation") == F.col("_live"))
    return out.drop("_live")


ENTRY = "struct<column:string,value:string>"


def cell_entries(keyed: DataFrame, *more: str) -> DataFrame:
    """Every change as entries ``(sink_table, row_key, column, value, seq)`` and the
    columns ``more``: one for each non-null cell of a put; a delete is one entry
    with a null column. Changes without a row key have none."""
    is_delete = F.coalesce(F.col("type") == "delete", F.lit(False))
    puts = F.transform(F.map_entries(F.map_filter("data", lambda k, v: v.isNotNull())),
                       lambda e: F.struct(e["key"].alias("column"), e["value"].alias("value")))
    marker = F.array(F.lit(None).cast(ENTRY))
    entries = F.when(is_delete, marker).otherwise(puts.cast(f"array<{ENTRY}>"))
    return keyed.where(F.col("row_key").isNotNull()) \
        .select("sink_table", "row_key", "seq", *more, F.explode(entries).alias("e")) \
        .select("sink_table", "row_key", F.col("e.column").alias("column"),
                F.col("e.value").alias("value"), "seq", *more)


def last_cells(entries: DataFrame, *more: str) -> DataFrame:
    """STA-4: the cells that entries leave, with the ``seq`` that wrote each: the
    last value of each column that no later delete of the row cleared. Cells are
    entries themselves, so results can be merged with later entries.

    A partial aggregation per cell keeps the greatest (seq, value) and absorbs hot rows
    before the shuffle; the window that finds a row's last delete runs over its aggregated
    cells, one per column."""
    row = ["sink_table", "row_key", *more]
    cells = entries.groupBy(*row, "column").agg(
        F.max(F.struct("seq", "value")).alias("_last"))
    cells = cells.select(*row, "column", F.col("_last.value").alias("value"),
                         F.col("_last.seq").alias("seq"))
    cleared = F.max(F.when(F.col("column").isNull(), F.col("seq"))).over(
        Window.partitionBy(*row))
    return cells.withColumn("_cleared", cleared) \
        .where(F.col("column").isNotNull()
               & (F.col("_cleared").isNull() | (F.col("seq") > F.col("_cleared")))) \
        .drop("_cleared")


def dim_snapshot(keyed: DataFrame) -> DataFrame:
    """STA-4: the table contents after applying every change in ``seq`` order.

    A put writes each non-null cell (so an update to null keeps the old value);
    a delete clears the whole row; a later put starts afresh."""
    return last_cells(cell_entries(keyed)).select("sink_table", "row_key", "column", "value")
