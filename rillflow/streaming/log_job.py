"""The behaviour-log job on a stream: clean -> repair (state) -> split -> one sink for
the five channels and the rejected messages.

``tagged_stream`` parses each message once, on the stream; its counts of messages, rejected ones and
dropped elements (D19) are in the query's progress. ``LogBatchWriter`` takes a micro-batch of
parsed records through the repair and the split by JVM operators alone:

* The first day of each device (STA-1) is a table in buckets of the device (``DeviceDays``),
  written at most once per device. A batch reads the buckets that its devices fall
  into, and adds the devices that are new.
* In a batch the state of a device is its stored day, else the first candidate of the batch by
  (ts, seq); a "1" of another day becomes "0". Hot devices are absorbed by partial
  aggregation; no task holds a device's records together.
* A retried batch finds the days of its first attempt, which give the same result; its
  output folder is replaced.

``log_stream`` is the form with one date per device in Spark's state store
(``visitor_state``), for states that are too large to be read in buckets.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.constants import CHANNEL_TOPICS
from rillflow.functions.jsonvar import parse_object
from rillflow.operators import logs
from rillflow.operators.joins import sized_broadcast
from rillflow.streaming.versions import BucketedTable
from rillflow.streaming.visitor_state import repair_stream

#: name of the counts in the query's progress
METRICS = "log_job"
#: files of a bucket of device days, at most, before they are merged
MOST_FILES = 16


def log_stream(raw: DataFrame, zone: str = "UTC") -> DataFrame:
    """``(seq, value)`` stream -> ``(seq, channel, value)`` stream."""
    clean = logs.clean_logs(raw, keep_text=True)
    fixed = repair_stream(clean, zone).withColumn(logs.LOG, parse_object("value"))
    return logs.split_log(logs.set_fixed_flag(fixed))


def tagged_stream(raw: DataFrame) -> DataFrame:
    """``(seq, value)`` stream -> parsed records and rejected messages, counted."""
    return logs.tagged_logs(raw).observe(
        METRICS, F.count(F.lit(1)).alias("messages"),
        F.coalesce(F.sum(F.col("_dirty").cast("bigint")), F.lit(0)).alias("dirty"),
        F.coalesce(F.sum(F.when(~F.col("_dirty"), F.col("dropped"))), F.lit(0))
        .alias("dropped_elements"))


class DeviceDays:
    """(mid, first_day) of the devices seen so far, in buckets of ``mid``."""

    def __init__(self, path: str, buckets: int = 256):
        self.table = BucketedTable(path, "mid string, first_day int", ["mid"], buckets)

    def merged(self, days: DataFrame) -> DataFrame:
        """The state of the devices of ``days`` (mid, first_day): the stored day, else theirs.
        ``new`` marks devices that have none yet."""
        spark = days.sparkSession
        stored = self.table.read(spark, self.table.buckets_of(days)) \
            .withColumnRenamed("first_day", "_stored")
        # the devices of a batch are the small side: what the buckets hold is not shuffled
        known = stored.join(sized_broadcast(days.select("mid")), "mid", "left_semi")
        return days.join(known, "mid", "left").select(
            "mid", F.coalesce("_stored", "first_day").alias("first_day"),
            F.col("_stored").isNull().alias("new"))

    def add(self, state: DataFrame, batch_id: int) -> None:
        """Stores the new devices of ``state``; buckets of many files are written as one."""
        spark = state.sparkSession
        fresh = state.where("new").select("mid", "first_day")
        found, _ = self.table.files(spark)
        full = [b for b, versions in found.items() if len(versions) >= MOST_FILES]
        if full:
            fresh = fresh.unionByName(self.table.read(spark, full))
        self.table.commit(fresh, batch_id, full)


class LogBatchWriter:
    """``foreachBatch`` handler of a ``tagged_stream``: writes ``(topic, seq, n, value)``."""

    def __init__(self, state_path: str, out_path: str | None, zone: str = "UTC",
                 topics: dict[str, str] = CHANNEL_TOPICS, dirty_topic: str = logs.DIRTY,
                 bootstrap_servers: str | None = None, buckets: int = 256,
                 file_format: str = "json"):
        self.days = DeviceDays(state_path, buckets)
        self.out_path, self.zone = out_path, zone
        self.topics = {**topics, logs.DIRTY: dirty_topic}
        self.bootstrap_servers, self.file_format = bootstrap_servers, file_format

    def channels(self, batch: DataFrame, state: DataFrame) -> DataFrame:
        fixed = logs.apply_visitor_fix(batch, state.select("mid", "first_day"), self.zone)
        rows = logs.split_log(fixed, (*logs.CHANNELS, logs.DIRTY), numbered=True)
        topic = F.coalesce(*[F.when(F.col("channel") == c, F.lit(t))
                             for c, t in self.topics.items()])
        return rows.select(topic.alias("topic"), "seq", "n", "value")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)  # parsed once, used twice
        days = logs.first_visit_days(batch.where(~F.col("_dirty")), self.zone) \
            .persist(StorageLevel.DISK_ONLY)
        state = self.days.merged(days).persist(StorageLevel.DISK_ONLY)
        out = self.channels(batch, state)
        if self.bootstrap_servers:
            out.select("topic", F.concat_ws(":", "seq", "n").alias("key"), "value") \
                .write.format("kafka") \
                .option("kafka.bootstrap.servers", self.bootstrap_servers).save()
        else:
            out.write.mode("overwrite").format(self.file_format).partitionBy("topic") \
                .save(f"{self.out_path}/batch_id={batch_id}")
        self.days.add(state, batch_id)
        for df in (state, days, batch):
            df.unpersist()
