"""The dimension job on streams.

Config side, ``ConfigBatchWriter``: every micro-batch of the config feed appends its
ops to the op history and folds them into the config state (STA-2, STA-3), a new version of
two small tables: the last op of each source table, and each sink table's live generation
(SNK-3). What a batch costs does not depend on how old the feed is.

Change side, ``DimBatchWriter``: a micro-batch pins the newest version of the config state,
records it under its ``batch_id`` and routes by it (JOI-1), so a retry routes like the first
attempt whatever came in between. Each routed change is stamped with the generation of its sink
table that is live then, and appended to the change log, in a ``batch_id`` folder that a
retry replaces (SNK-2). Changes without a row key go to a quarantine.

No clocks are compared: batches follow arrival, and within a batch ``seq`` is a position
(``operators.position``: event time, then partition and offset). With ``as_of=True`` each
change instead meets the config and the generation in force at its own position, per
record, from the op history; this needs one clock in both topics, so changes without a
usable time go to the quarantine.

``SnapshotStore`` keeps the dimension tables (STA-4) in buckets of rows. A compaction merges
the cells of new batches into the buckets they touch and commits a manifest of the
live files; the other buckets' files stay. ``compact_snapshot`` computes the same from
the whole change log.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators import changes as chg
from rillflow.operators import config as cfg
from rillflow.operators import dims
from rillflow.operators.joins import sized_broadcast
from rillflow.operators.position import positioned, usable_millis
from rillflow.streaming.versions import (
    BucketedTable, VersionedTable, pinned, read_if_there,
)

POSITION = "decimal(38,0)"
OPS_SCHEMA = f"seq {POSITION}, op string, " + ", ".join(f"{f} string" for f in cfg.FIELDS)
LATEST_SCHEMA = ", ".join(f"{f} string" for f in cfg.FIELDS) + ", op string"
TABLES_SCHEMA = f"sink_table string, live boolean, generation {POSITION}"
LOG_SCHEMA = (f"seq {POSITION}, ts bigint, `table` string, type string, data map<string,string>, "
              f"sink_table string, row_key string, op string, generation {POSITION}")
#: versions of the config state and of the manifest that are kept at least
KEPT = 100


def config_ops_stream(raw: DataFrame, unit: str = "ms") -> DataFrame:
    """Decoded config ops ``(seq, op, source_table, ...)`` from the envelope stream."""
    return positioned(cfg.decode_config(raw, event_time=True), "ts_ms", unit=unit).drop("ts_ms")


class ConfigState:
    """The op history and the versioned config state under one folder."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.latest = VersionedTable(f"{self.path}/latest", LATEST_SCHEMA)
        self.tables = VersionedTable(f"{self.path}/tables", TABLES_SCHEMA)

    def version(self, spark: SparkSession, upto: int | None = None) -> int | None:
        """The newest version: both tables are there once the second is committed."""
        return self.tables.newest(spark, upto)

    def ops(self, spark: SparkSession, version: int | None) -> DataFrame:
        """The op history up to a version; a feed that has not begun has none."""
        found = read_if_there(spark, f"{self.path}/ops", OPS_SCHEMA + ", batch_id bigint")
        if found is None or version is None:
            return spark.createDataFrame([], OPS_SCHEMA)
        return found.where(F.col("batch_id") <= version).drop("batch_id")

    def fold(self, ops: DataFrame, version: int) -> None:
        """The state after the ops of a batch, as ``version``; from the newest one before."""
        spark = ops.sparkSession
        before = self.version(spark, version - 1)
        old = self.latest.read(spark, before)
        applied = cfg.config_ops(ops)
        now = applied.groupBy("source_table").agg(F.max_by(F.struct(
            *cfg.FIELDS[1:], "op"), "seq").alias("_c")).select("source_table", "_c.*")
        # deleted source tables stay, as op d: a preloaded config must not come back
        kept = old.join(sized_broadcast(now.select("source_table")), "source_table", "left_anti")
        self.latest.write(now.unionByName(kept), version)
        tables = self.tables.read(spark, before)
        first = F.lit(-1).cast(POSITION)  # positions are not negative
        begun = tables.select(
            first.alias("seq"), F.when(F.col("live"), "c").otherwise("d").alias("op"),
            "sink_table", F.lit("f").alias("sink_family"))
        life = cfg.table_lifecycle(begun.unionByName(
            ops.select("seq", "op", "sink_table", "sink_family")))
        held = tables.select("sink_table", F.col("generation").alias("_held"))
        self.tables.write(life.join(held, "sink_table", "left").select(
            "sink_table", "live", F.when(F.col("reset_seq") == first, F.col("_held"))
            .otherwise(F.col("reset_seq")).alias("generation")), version)


class ConfigBatchWriter:
    """``foreachBatch`` handler of the config feed. Versions that no change batch of the last
    ``keep`` can have pinned are removed."""

    def __init__(self, path: str, unit: str = "ms", keep: int = KEPT):
        self.state, self.unit, self.keep = ConfigState(path), unit, keep

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        where = f"{self.state.path}/ops/batch_id={batch_id}"
        config_ops_stream(batch, self.unit).write.mode("overwrite").parquet(where)
        self.state.fold(spark.read.schema(OPS_SCHEMA).parquet(where), batch_id)
        for table in (self.state.tables, self.state.latest):
            table.retain(spark, self.keep)


class DimBatchWriter:
    """``foreachBatch`` handler routing one micro-batch of changes."""

    def __init__(self, ops_path: str, changelog_path: str, quarantine_path: str,
                 database: str, preload: DataFrame | None = None, as_of: bool = False,
                 unit: str = "ms"):
        """``as_of``: each change meets the config in force at its own position
        (per-record semantics); otherwise every change of the batch meets the latest
        config. ``unit``: of the changes' ``ts``."""
        self.state = ConfigState(ops_path)
        self.changelog_path = changelog_path
        self.quarantine_path = quarantine_path
        self.database = database
        self.preload = preload
        self.as_of = as_of
        self.unit = unit

    def latest(self, spark: SparkSession, version: int | None) -> DataFrame:
        """JOI-2: the state's config, then the preloaded one of source tables without any op."""
        state = self.state.latest.read(spark, version)
        live = state.where(~F.col("op").eqNullSafe("d"))
        if self.preload is None:
            return live
        p = self.preload.toDF(*[cfg.to_snake(c) for c in self.preload.columns])
        new = p.select(*cfg.FIELDS, F.lit("r").alias("op")).join(
            sized_broadcast(state.select("source_table")), "source_table", "left_anti")
        return live.unionByName(new.select(*cfg.FIELDS, "op"))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        version = pinned(spark, f"{self.changelog_path}_pins", batch_id,
                         lambda: self.state.version(spark))
        changes = chg.clean_changes(chg.parse_changes(
            batch, only=lambda db, table, kind: db == self.database, old=False), self.database)
        changes = changes.withColumn("_time", usable_millis(F.col("ts"), self.unit))
        changes = positioned(changes, "ts", unit=self.unit)
        if self.as_of:
            ops = self.state.ops(spark, version)
            timed = changes.where(F.col("_time").isNotNull())
            routed = dims.route_changes(timed, cfg.config_ops(ops, self.preload))
        else:
            routed = dims.route_latest(changes, self.latest(spark, version))
        keyed = dims.with_row_key(dims.prune_columns(routed))
        if self.as_of:
            there = dims.with_generation(keyed.where(F.col("row_key").isNotNull()),
                                         cfg.generations(ops))
            keyed = there.unionByName(dims.bad_row_keys(keyed), allowMissingColumns=True)
        else:
            tables = self.state.tables.read(spark, version) \
                .withColumnRenamed("generation", "reset_seq")
            keyed = dims.with_current_generation(keyed, tables)
        cols = ["seq", "ts", "table", "type", "data", "sink_table", "row_key", "op",
                F.col("generation").cast(POSITION).alias("generation")]
        keyed = keyed.select(*cols).persist(StorageLevel.DISK_ONLY)
        bad = dims.bad_row_keys(keyed).withColumn("reason", F.lit("row key"))
        if self.as_of:
            bad = bad.unionByName(
                changes.where(F.col("_time").isNull()).select(*cols[:5])
                .withColumn("reason", F.lit("time")), allowMissingColumns=True)
        # the batch's own folder is replaced as a whole: after a retry nothing of the
        # first attempt is left
        for rows, path in ((keyed.where(F.col("row_key").isNotNull()), self.changelog_path),
                           (bad, self.quarantine_path)):
            rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        keyed.unpersist()


def change_log(spark: SparkSession, path: str, after: int | None = None,
               upto: int | None = None) -> DataFrame:
    """The change log's rows, those of some batches if asked, ordered by arrival: ``seq``
    becomes (batch_id, position)."""
    log = spark.read.schema(LOG_SCHEMA + ", batch_id bigint").parquet(path)
    if after is not None:
        log = log.where(F.col("batch_id") > after)
    if upto is not None:
        log = log.where(F.col("batch_id") <= upto)
    return log.withColumn("seq", F.struct("batch_id", "seq"))


def _live(spark: SparkSession, ops_path: str) -> DataFrame:
    state = ConfigState(ops_path)
    return state.tables.read(spark, state.version(spark)) \
        .withColumnRenamed("generation", "reset_seq")


def compact_snapshot(spark: SparkSession, changelog_path: str, ops_path: str) -> DataFrame:
    """Dimension contents from the whole change log: the changes of live generations."""
    return dims.dim_snapshot(dims.apply_lifecycle(change_log(spark, changelog_path),
                                                  _live(spark, ops_path)))


CELL_SCHEMA = (f"sink_table string, row_key string, `column` string, value string, "
               f"seq struct<batch_id:bigint,seq:{POSITION}>, generation {POSITION}")


class SnapshotStore:
    """The dimension tables as buckets of rows, compacted batch by batch.

    A compaction reads the new batches of the change log and the buckets they touch, and writes
    those anew. A table that was dropped or reset is hidden at once (its generation is
    not live) and its cells go when their bucket is next merged."""

    def __init__(self, path: str, buckets: int = 256, keep: int = 2):
        self.table = BucketedTable(path, CELL_SCHEMA, ["sink_table", "row_key"], buckets, keep)

    def compact(self, spark: SparkSession, changelog_path: str, ops_path: str) -> list[int]:
        """Merges the batches that are not in yet; returns the buckets it touched."""
        _, upto = self.table.files(spark)
        newest = change_log(spark, changelog_path, upto).agg(F.max("seq.batch_id")).first()[0]
        if newest is None:
            return []
        live = _live(spark, ops_path)
        fresh = dims.cell_entries(dims.apply_lifecycle(
            change_log(spark, changelog_path, upto, newest), live), "generation")
        touched = self.table.buckets_of(fresh)
        old = dims.apply_lifecycle(self.table.read(spark, touched), live)
        self.table.commit(dims.last_cells(fresh.unionByName(old), "generation"), newest, touched)
        return touched

    def cells(self, spark: SparkSession, ops_path: str) -> DataFrame:
        """The tables' contents as of the last compaction, dropped and reset tables left out."""
        return dims.apply_lifecycle(self.table.read(spark), _live(spark, ops_path)) \
            .select("sink_table", "row_key", "column", "value")
