"""Epoch-millisecond and date-text conversions (FUN-9..14).

Formatting uses the session time zone (Spark's counterpart of a JVM's system
zone) unless ``zone`` is given, in which case the result does not depend on
the session. Parsing uses a fixed offset, +08:00 by default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's formats and offset.
DATE_FMT = "yyyy-MM-dd"
DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"
PARTITION_FMT = "yyyyMMdd"
PARSE_OFFSET = "+08:00"
DAY_MS = 24 * 60 * 60 * 1000
# 0001-01-02 to 9999-12-30 UTC: formats in every zone, also a day earlier or later
MIN_TS, MAX_TS = -62135510400000, 253402127999999


def in_range(ts_ms: Column | str) -> Column:
    """Whether epoch ms can be formatted; a timestamp in micro- or nanoseconds,
    a common producer error, cannot. Null for null."""
    return _c(ts_ms).between(MIN_TS, MAX_TS)



def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wall_clock(ts_ms: Column | str, zone: str | None = None) -> Column:
    """Epoch ms as a timestamp to format: in the session zone when ``zone`` is
    None, else as a zone-independent wall clock in ``zone``. Null outside the
    range of ``in_range`` (converting would stop the job)."""
    ts_ms = F.when(in_range(ts_ms), _c(ts_ms))
    if zone is None:
        return F.timestamp_millis(ts_ms)
    utc_wall = _epoch_ntz() + ts_ms * F.expr("INTERVAL '0.001' SECOND")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)


def ts_to_date(ts_ms: Column | str, zone: str | None = None) -> Column:
    """FUN-10: epoch ms -> 'yyyy-MM-dd'."""
    return F.date_format(wall_clock(ts_ms, zone), DATE_FMT)


def ts_to_day(ts_ms: Column | str, zone: str | None = None) -> Column:
    """The date of FUN-10 as days since 1970-01-01."""
    return F.unix_date(wall_clock(ts_ms, zone).cast("date"))


def ts_to_datetime(ts_ms: Column | str, zone: str | None = None) -> Column:
    """FUN-11: epoch ms -> 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(wall_clock(ts_ms, zone), DATETIME_FMT)


def ts_to_date_partition(ts_ms: Column | str, zone: str | None = None) -> Column:
    """FUN-12: epoch ms -> 'yyyyMMdd'."""
    return F.date_format(wall_clock(ts_ms, zone), PARTITION_FMT)


def datetime_to_ts(text: Column | str, offset: str = PARSE_OFFSET) -> Column:
    """FUN-9: 'yyyy-MM-dd HH:mm:ss' at a fixed offset -> epoch ms; null on
    any other shape."""
    parsed = F.try_to_timestamp(F.concat(_c(text), F.lit(offset)),
                                F.lit(DATETIME_FMT + "XXX"))
    return F.unix_millis(parsed)


def date_to_ts(text: Column | str, offset: str = PARSE_OFFSET) -> Column:
    """FUN-13: 'yyyy-MM-dd' -> epoch ms of its midnight at a fixed offset."""
    return datetime_to_ts(F.concat(_c(text), F.lit(" 00:00:00")), offset)


def prev_day(ts_ms: Column | str, zone: str | None = None) -> Column:
    """FUN-14: date of ts minus 24 hours (not the calendar day before)."""
    return ts_to_date(_c(ts_ms) - F.lit(DAY_MS), zone)


def ntz_to_millis(ts_ntz: Column | str) -> Column:
    """Epoch ms of a timestamp_ntz read as UTC, independent of the session zone."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), _c(ts_ntz))
