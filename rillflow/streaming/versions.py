"""Tables in immutable versions: written aside, then committed, never rewritten.

A version's rows lie in ``<path>/data/version=<v>`` and count from the moment its commit
(``<path>/commits/version=<v>``) is there; the commit is written last. A reader takes one version by
number and keeps it while it works, so writers never pull files from under it. A version
that is written again (a retry) replaces itself. ``retain`` removes old versions.

``BucketedTable`` keeps rows in buckets of a key's hash, so that a micro-batch reads and
writes the buckets it touches and leaves the files of the others alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.session import remove


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The table at ``path``; None if nothing was ever written there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


class VersionedTable:
    def __init__(self, path: str, schema: str | None = None):
        """``schema``: of the rows; None for that of the files."""
        self.path, self.schema = path.rstrip("/"), schema

    def write(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/data/version={version}")
        rows.sparkSession.range(1).write.mode("overwrite").parquet(
            f"{self.path}/commits/version={version}")

    def versions(self, spark: SparkSession) -> list[int]:
        """The committed versions that are kept, ascending."""
        found = read_if_there(spark, f"{self.path}/commits", "id bigint, version bigint")
        return [] if found is None else sorted(
            r["version"] for r in found.select("version").distinct().collect())

    def newest(self, spark: SparkSession, upto: int | None = None) -> int | None:
        found = [v for v in self.versions(spark) if upto is None or v <= upto]
        return found[-1] if found else None

    def read(self, spark: SparkSession, version: int | None) -> DataFrame:
        """A version's rows; no rows for None (nothing was committed yet)."""
        if version is None:
            return spark.createDataFrame([], self.schema)
        reader = spark.read if self.schema is None else spark.read.schema(self.schema)
        return reader.parquet(f"{self.path}/data/version={version}")

    def retain(self, spark: SparkSession, keep: int, pinned: Iterable[int] = ()) -> list[int]:
        """Remove all versions but the newest ``keep`` and the ``pinned`` ones; the commit goes
        first, so that no reader finds a version without its rows. Returns what went."""
        versions, pinned = self.versions(spark), set(pinned)
        old = [v for v in versions[:max(0, len(versions) - keep)] if v not in pinned]
        for v in old:
            remove(spark, f"{self.path}/commits/version={v}")
            remove(spark, f"{self.path}/data/version={v}")
        return old


def pinned(spark: SparkSession, path: str, batch_id: int, choose) -> int | None:
    """The version that a micro-batch works with: ``choose()`` on its first attempt, which
    is recorded under ``path`` before anything else; the recorded one on a retry."""
    mine = f"{path}/batch_id={batch_id}"
    found = read_if_there(spark, mine, "version bigint")
    rows = [] if found is None else found.collect()
    if rows:
        return rows[0]["version"]
    version = choose()
    spark.range(1).select(F.lit(version).cast("bigint").alias("version")) \
        .write.mode("overwrite").parquet(mine)
    return version


MANIFEST_SCHEMA = "bucket int, version bigint, upto bigint"


class BucketedTable:
    """Rows in buckets; a bucket's rows lie in the files of one or more versions,
    ``data/version=<v>/bucket=<b>``. The manifest, a versioned table itself, names them, and the
    last micro-batch that is in."""

    def __init__(self, path: str, schema: str, key: list[str], buckets: int, keep: int = 2):
        self.path, self.schema, self.key = path.rstrip("/"), schema, key
        self.buckets, self.keep = buckets, keep
        self.manifest = VersionedTable(f"{self.path}/manifest", MANIFEST_SCHEMA)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows: at most ``buckets`` numbers on the driver."""
        return sorted(r["b"] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def files(self, spark: SparkSession) -> tuple[dict[int, list[int]], int | None]:
        """(versions of each bucket, the last micro-batch that is in)."""
        rows = self.manifest.read(spark, self.manifest.newest(spark)).collect()
        found: dict[int, list[int]] = {}
        for r in rows:
            if r["version"] is not None:
                found.setdefault(r["bucket"], []).append(r["version"])
        return found, max((r["upto"] for r in rows), default=None)

    def read(self, spark: SparkSession, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of some buckets (default: of all)."""
        found, _ = self.files(spark)
        paths = [f"{self.path}/data/version={v}/bucket={b}"
                 for b in (found if buckets is None else buckets) for v in found.get(b, ())]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def commit(self, rows: DataFrame, upto: int, replace: Iterable[int] = ()) -> None:
        """Adds ``rows`` as files of a new version; the files that the buckets ``replace`` had
        before are no longer named. Old manifests go, and the versions that only they name."""
        spark = rows.sparkSession
        found, _ = self.files(spark)
        newest = self.manifest.newest(spark)
        version = 0 if newest is None else newest + 1
        where = f"{self.path}/data/version={version}"
        rows.withColumn("bucket", self.bucket()).repartition("bucket") \
            .write.mode("overwrite").partitionBy("bucket").parquet(where)
        filled = [r["bucket"] for r in spark.read.schema(self.schema + ", bucket int")
                  .parquet(where).select("bucket").distinct().collect()]
        replaced = set(replace)
        names = [(b, v, upto) for b, vs in found.items() if b not in replaced for v in vs]
        names += [(b, version, upto) for b in filled]
        self.manifest.write(spark.createDataFrame(names or [(0, None, upto)], MANIFEST_SCHEMA),
                            version)
        self._retain(spark)

    def _retain(self, spark: SparkSession) -> None:
        versions = self.manifest.versions(spark)

        def named(some):
            return {r["version"] for v in some
                    for r in self.manifest.read(spark, v).collect()} - {None}
        gone = named(versions[:-self.keep]) - named(versions[-self.keep:])
        self.manifest.retain(spark, self.keep)
        for v in gone:
            remove(spark, f"{self.path}/data/version={v}")
