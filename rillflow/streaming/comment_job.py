"""The comments job on a stream: ``foreachBatch`` that looks the batch's new comments up
in the dictionary (JOI-3) and writes them to the comment topic (D6): a Kafka topic
(at least once), or a folder in which a retry replaces the batch's part.

The dictionary (SRC-5) is re-read every ``refresh_seconds`` (STR-4), each time as a new
immutable version; a batch records the version it works with, so neither a rewrite of the
dictionary in mid-batch nor a later refresh changes a retry. Old versions are removed.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.constants import TOPIC_COMMENT_INFO
from rillflow.operators import comments as cmt
from rillflow.streaming.versions import VersionedTable, pinned

#: versions of the dictionary that are kept
KEPT = 3


class CommentBatchWriter:
    """``foreachBatch`` handler. ``load_dictionary(spark)`` returns the
    dictionary table; it is re-read every batch, or every ``refresh_seconds``. Its versions lie
    in ``versions_path``, by default beside the output."""

    def __init__(self, load_dictionary: Callable[[SparkSession], DataFrame], out_path: str,
                 database: str, refresh_seconds: float = 0.0,
                 bootstrap_servers: str | None = None, topic: str = TOPIC_COMMENT_INFO,
                 versions_path: str | None = None, keep: int = KEPT):
        self.bootstrap_servers = bootstrap_servers
        self.topic = topic
        self.load_dictionary = load_dictionary
        self.out_path = out_path
        self.database = database
        self.refresh_seconds = refresh_seconds
        self.versions_path = (versions_path or f"{out_path}_dictionary").rstrip("/")
        self.versions = VersionedTable(self.versions_path)
        self.keep = keep
        self._version = None
        self._loaded_at = 0.0

    def version(self, spark: SparkSession) -> int:
        """The version in use, a new one if it is due."""
        now = time.monotonic()
        if self._version is None or now - self._loaded_at >= self.refresh_seconds:
            newest = self.versions.newest(spark)
            self._version = 0 if newest is None else newest + 1
            self.versions.write(self.load_dictionary(spark), self._version)
            self.versions.retain(spark, self.keep)
            self._loaded_at = now
        return self._version

    def dictionary(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return self.versions.read(spark, pinned(
            spark, f"{self.versions_path}/pins", batch_id, lambda: self.version(spark)))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = cmt.comment_project(cmt.new_comments(batch, self.database, proc_time=True))
        out = cmt.lookup_dictionary(rows, self.dictionary(spark, batch_id))
        if self.bootstrap_servers:
            (out.select(F.lit(self.topic).alias("topic"), F.col("id").alias("key"),
                        F.to_json(F.struct("*")).alias("value"))
             .write.format("kafka").option("kafka.bootstrap.servers", self.bootstrap_servers)
             .save())
        else:
            out.write.mode("overwrite").parquet(f"{self.out_path}/batch_id={batch_id}")
