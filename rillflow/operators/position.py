"""One order for messages of several partitions: event time, then the message's id.

``seq`` of a topic identifies a message (partition and offset) and orders one
partition. It says nothing about another partition, so jobs that order the messages of a
topic replace it by a position: event time in ms first, then the id. A decimal holds
both exactly.

Times come in the unit that the topic's producer writes (``UNITS``). One that is missing or
outside of ``EARLIEST`` to ``LATEST``, as a value in another unit is, is not usable
(``usable_millis``). Such a message has position 0 and its id; a job that compares the
clocks of two topics must set it aside instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SHIFT = 1 << 64
#: microseconds in a unit
UNITS = {"s": 1_000_000, "ms": 1_000, "us": 1}
#: 2000-01-01 and 2100-01-01 in ms
EARLIEST, LATEST = 946_684_800_000, 4_102_444_800_000


def usable_millis(time: Column, unit: str = "ms") -> Column:
    """``time`` in ms, null if it cannot be one of the years 2000 to 2099."""
    micros = UNITS[unit]
    ms = time.cast("decimal(20,0)") * F.lit(micros // 1000) if micros >= 1000 \
        else F.floor(time.cast("decimal(20,0)") / (1000 // micros))
    return F.when((ms >= EARLIEST) & (ms < LATEST), ms.cast("bigint"))


def positioned(df: DataFrame, time: str, seq: str = "seq", unit: str = "ms") -> DataFrame:
    """``df`` with ``seq`` replaced by its position, ``decimal(38,0)``: later than
    every preloaded config (which sits at the smallest long)."""
    at = F.coalesce(usable_millis(F.col(time), unit), F.lit(0)).cast("decimal(18,0)")
    shift = F.lit(str(_SHIFT)).cast("decimal(20,0)")
    at = at * shift + F.col(seq).cast("decimal(20,0)")
    return df.withColumn(seq, at.cast("decimal(38,0)"))
