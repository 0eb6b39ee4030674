"""Database change records: the JSON topic as a typed table (SRC-2) and the
dimension job's cleaning (FIL-2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillflow.functions.jsonvar import get_long, get_str, rows_where

CHANGE_FIELDS = ("database", "table", "type", "ts", "data", "old")
MAP = "map<string,string>"


def parse_changes(raw: DataFrame, value: str = "value", proc_time: bool = False,
                  only: Callable[[Column, Column, Column], Column] | None = None,
                  old: bool = True) -> DataFrame:
    """SRC-2: JSON change records -> ``database, table, type, ts, data, old``.

    Messages that are not a JSON object are skipped; a field of the wrong type
    becomes null (the source table ignores parse errors). ``data``/``old`` are
    ``map<string,string>``: numbers and nested values become text, JSON null
    stays null. ``proc_time`` adds the processing-time column (PRJ-3).

    ``only(database, table, type)`` keeps matching records; the maps are built
    for those alone, inside the generator that filters. ``old=False`` leaves
    the old image out.
    """
    v = F.col("_v")
    database, table, kind = (get_str(v, f"$.{k}") for k in ("database", "table", "type"))
    wanted = v.isNotNull() & F.col(value).rlike(r"^\s*\{")
    if only is not None:
        wanted = wanted & F.coalesce(only(database, table, kind), F.lit(False))
    parsed = raw.withColumn("_v", F.try_parse_json(value))
    fields = [F.col(c) for c in raw.columns if c != value] + [
        database.alias("database"), table.alias("table"), kind.alias("type"),
        get_long(v, "$.ts").alias("ts"), F.try_variant_get("_v", "$.data", MAP).alias("data")]
    if old:
        fields.append(F.try_variant_get("_v", "$.old", MAP).alias("old"))
    out = rows_where(parsed, wanted, F.struct(*fields))
    if proc_time:
        out = out.withColumn("proc_time", F.current_timestamp())
    return out


def clean_changes(changes: DataFrame, database: str) -> DataFrame:
    """FIL-2: the shop database, not the bootstrap-start marker (a null type
    passes), and a non-empty ``data``."""
    return changes.where(
        (F.col("database") == database)
        & ~F.coalesce(F.col("type") == "bootstrap-start", F.lit(False))
        & (F.size("data") > 0))
