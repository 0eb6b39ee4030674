"""Session helpers: the few settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Duplicate JSON keys: the last one wins, at every depth (the reference's parser
# behaves the same way). Without it, try_parse_json yields null for such rows.
JSON_SETTINGS = {"spark.sql.variant.allowDuplicateKeys": "true"}


def ensure_json_settings(spark: SparkSession) -> None:
    for key, value in JSON_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)


def build_session(master: str = "local[*]", app: str = "rillflow",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in {**JSON_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_json_settings(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster sets it to shared storage. Only a local-mode session without it
    (tests) gets a fresh scratch folder; on a cluster a machine-local folder
    would not survive the loss of an executor, so it is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        path = tempfile.mkdtemp(prefix="rillflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    try:
        spark.sparkContext.setCheckpointDir(path)
    except Exception:  # a Connect session has no SparkContext; streams need only the path
        pass
    return path


#: folders that this process has written with ``written``
_WRITTEN: list[str] = []


def written(df, name: str) -> str:
    """Write ``df`` as a parquet table of its own under the shared checkpoint folder; the
    path."""
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return path


def materialize(df, name: str):
    """``written`` and read back: later uses (size checks, stats, joins) read the files
    instead of recomputing the lineage, and the data survives executor loss."""
    return df.sparkSession.read.parquet(written(df, name))


def release_tables(spark: SparkSession) -> int:
    """Remove the tables that this process has written with ``materialize``, once the results
    that read them are stored; how many went."""
    n = len(_WRITTEN)
    while _WRITTEN:
        remove(spark, _WRITTEN.pop())
    return n


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of the library's own from shared storage, if it is there."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def size_for_input(spark: SparkSession, input_bytes: int,
                   partition_bytes: int = 256 << 20) -> dict:
    """Shuffle and scan sizing for a batch over ``input_bytes`` of input.

    The biggest shuffle (the log job's exchange by device) moves about the
    input's volume, so it gets ``input_bytes / partition_bytes`` partitions
    (at least 200); AQE then coalesces small ones and splits skewed ones
    around the same advisory size, and turns a sort-merge join into a shuffled
    hash join when every measured build partition is below it (the repair's
    per-device state), so the big side is not sorted. Scans split at the same
    size. Returns the settings it applied.
    """
    settings = {
        "spark.sql.shuffle.partitions": str(max(200, -(-input_bytes // partition_bytes))),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a join whose measured build-side partitions are all small becomes a
        # shuffled hash join: the log side of the repair join is not sorted
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    return settings
