"""Join strategies with a checked size.

``sized_broadcast`` broadcasts a side only when its measured size (rows and
value bytes) is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Per-row overhead added to the measured bytes of a broadcast side (row header,
# fixed-width fields, hash-table entry).
ROW_OVERHEAD = 64


def broadcast_threshold(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (0 when disabled)."""
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = raw.strip().lower()
    mult = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
            "g": 1 << 30, "gb": 1 << 30}
    num = raw.rstrip("bkmg")
    unit = raw[len(num):] or "b"
    try:
        threshold = int(float(num) * mult.get(unit, 1))
    except ValueError:
        threshold = 10 << 20
    return max(threshold, 0)


def broadcast_row_limit(df: DataFrame) -> int:
    """Most rows a broadcast side may have (threshold / per-row overhead)."""
    return broadcast_threshold(df) // ROW_OVERHEAD


def row_bytes(dtype: T.DataType, col: Column) -> Column:
    """Bytes of a value: strings and binaries by length, structs, arrays and
    maps by their parts, everything else 8."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(col), F.lit(0))
    if isinstance(dtype, T.StructType):
        parts = [row_bytes(f.dataType, col[f.name]) for f in dtype.fields]
        return sum(parts[1:], parts[0]) if parts else F.lit(0)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(col)), F.lit(0))
    return F.lit(8)


def side_bytes(df: DataFrame) -> Column:
    """Per-row measured size of ``df``'s rows."""
    return row_bytes(df.schema, F.struct(*[F.col(c) for c in df.columns])) + F.lit(ROW_OVERHEAD)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    """Measure the side (a small derived table): its row count and the summed
    size of its values, read over at most ``limit + 1`` rows, against the
    broadcast threshold."""
    threshold = broadcast_threshold(df)
    limit = broadcast_row_limit(df) if limit is None else limit
    if limit <= 0 or threshold <= 0:
        return False
    head = df.limit(limit + 1)
    st = head.agg(F.count(F.lit(1)).alias("n"), F.sum(side_bytes(head)).alias("b")).first()
    return st["n"] <= limit and (st["b"] or 0) <= threshold


def sized_broadcast(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its measured size fits; otherwise a shuffled hash
    join with ``df`` as the build side, so that Catalyst cannot broadcast it on
    a file-size estimate either (AQE still splits skewed partitions)."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df.hint("shuffle_hash")
