"""Stream sources and sinks with the topic contract ``(seq, value)``.

SRC-1: a topic as a text stream. With ``bootstrap_servers`` the Kafka source is
used (its jar must be on the classpath); otherwise a directory of files holding
``seq bigint, value string`` rows stands in for the topic. SNK-1: channel rows
to topics, as Kafka records (at-least-once: the ``seq`` id lets a consumer drop
duplicates) or as a file sink partitioned by channel (exactly-once through the
sink's commit log). SNK-4: console.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

TOPIC_SCHEMA = "seq bigint, value string"


def read_topic(spark: SparkSession, topic: str | None = None, *,
               bootstrap_servers: str | None = None, path: str | None = None,
               starting: str = "latest", group_id: str | None = None,
               file_format: str = "parquet", max_per_trigger: int | None = None,
               options: dict | None = None) -> DataFrame:
    """A topic as a stream of ``(seq, value)``; ``value`` is UTF-8 text (null
    for a null message).

    Kafka: ``starting`` is the offset to begin from when no checkpoint exists
    (the reference always starts at the latest offset); ``group_id`` names the
    consumer group; ``seq`` combines the partition and the offset. Files: every file in ``path`` is read once, in
    arrival order, ``max_per_trigger`` files per micro-batch.
    """
    if bootstrap_servers:
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap_servers)
                  .option("subscribe", topic).option("startingOffsets", starting))
        if group_id:
            reader = reader.option("kafka.group.id", group_id)
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        df = reader.load()
        seq = F.shiftleft(F.col("partition").cast("long"), 40) + F.col("offset")
        return df.select(seq.alias("seq"), F.col("value").cast("string").alias("value"))
    reader = spark.readStream.schema(TOPIC_SCHEMA).format(file_format)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


#: how long a channel's reader remembers the ids of rows
REPLAY = "1 hour"


def read_channel(spark: SparkSession, topic: str, *, bootstrap_servers: str | None = None,
                 path: str | None = None, within: str = REPLAY, starting: str = "earliest",
                 max_per_trigger: int | None = None) -> DataFrame:
    """A channel topic as ``(seq, n, value, time)``, each row once (SNK-1, STR-1).

    The sink is at least once: a batch that is written again repeats its rows, by the same
    (seq, n). Rows of an id that came within ``within`` before are dropped; the
    watermark on the time of writing (record time, or file time) bounds the ids that are
    remembered."""
    if bootstrap_servers:
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", bootstrap_servers)
                  .option("subscribe", topic).option("startingOffsets", starting))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        key = F.split(F.col("key").cast("string"), ":")
        rows = reader.load().select(
            F.get(key, F.lit(0)).cast("bigint").alias("seq"),
            F.get(key, F.lit(1)).cast("int").alias("n"),
            F.col("value").cast("string").alias("value"), F.col("timestamp").alias("time"))
    else:
        reader = spark.readStream.schema("seq bigint, n int, value string").format("json")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        rows = reader.load(f"{path}/batch_id=*/topic={topic}").select(
            "seq", "n", "value", F.col("_metadata.file_modification_time").alias("time"))
    return rows.withWatermark("time", within).dropDuplicatesWithinWatermark(["seq", "n"])


def write_topic_files(df: DataFrame, batch_path: str, parts: int | None = None) -> None:
    """Append a batch ``(seq, value)`` DataFrame as files of a file-backed topic."""
    out = df.select("seq", "value")
    if parts:
        out = out.repartition(parts)
    out.write.mode("append").parquet(batch_path)


def channel_writer(channels: DataFrame, *, topics: dict[str, str],
                   bootstrap_servers: str | None = None, path: str | None = None,
                   file_format: str = "json") -> DataStreamWriter:
    """SNK-1: one sink for all channels; each row goes to its channel's topic."""
    topic = F.coalesce(*[F.when(F.col("channel") == c, F.lit(t)) for c, t in topics.items()])
    if bootstrap_servers:
        out = channels.select(topic.alias("topic"), F.col("seq").cast("string").alias("key"),
                              "value")
        return (out.writeStream.format("kafka")
                .option("kafka.bootstrap.servers", bootstrap_servers))
    out = channels.select(topic.alias("topic"), "seq", "value")
    return (out.writeStream.format(file_format).option("path", path)
            .partitionBy("topic"))


def console_writer(df: DataFrame, label: str | None = None,
                   truncate: bool = False) -> DataStreamWriter:
    """SNK-4: print a stream, optionally tagged with a label column."""
    if label is not None:
        df = df.select(F.lit(label).alias("label"), "*")
    return df.writeStream.format("console").option("truncate", str(truncate).lower())
