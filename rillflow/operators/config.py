"""Config feed of the dimension job: decode (PRJ-8, FUN-3), preload and rename
(SRC-4, PRJ-6), latest-per-key and validity intervals (STA-2, JOI-2) and the
sink-table lifecycle (SNK-3).

Configs from the feed and from the preloaded table become one stream of ops on
a shared position axis (``seq``): the preload is op ``r`` at the axis minimum.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions.jsonvar import get_long, get_str, keep_where
from rillflow.operators.carry import WINDOW_ROWS, next_in_group, previous_in_group
from rillflow.operators.joins import sized_broadcast

FIELDS = ("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
STRUCT = "struct<" + ",".join(f"{f}:string" for f in FIELDS) + ">"
MIN_SEQ = -(1 << 63)


def to_camel(name: str) -> str:
    """lower_underscore -> lowerCamel (PRJ-6)."""
    head, *rest = name.lower().split("_")
    return head + "".join(w[:1].upper() + w[1:] for w in rest)


def to_snake(name: str) -> str:
    return re.sub(r"(?<!^)([A-Z])", r"_\1", name).lower()


def camel_columns(df: DataFrame) -> DataFrame:
    """PRJ-6: rename every column to lowerCamel; metadata only."""
    return df.toDF(*[to_camel(c) for c in df.columns])


def read_config_table(spark: SparkSession, path: str | None = None, url: str | None = None,
                      table: str | None = None, properties: dict | None = None,
                      partition_column: str | None = None, lower_bound=None,
                      upper_bound=None, num_partitions: int | None = None,
                      camel: bool = True) -> DataFrame:
    """SRC-4: every row and column of the config table, by JDBC or from files,
    optionally renamed to lowerCamel."""
    if url is not None:
        kw = dict(properties=properties or {})
        if partition_column:
            kw.update(column=partition_column, lowerBound=lower_bound,
                      upperBound=upper_bound, numPartitions=num_partitions)
        df = spark.read.jdbc(url, table, **kw)
    else:
        df = spark.read.parquet(path)
    return camel_columns(df) if camel else df


def decode_config(raw: DataFrame, value: str = "value", event_time: bool = False) -> DataFrame:
    """PRJ-8: envelope -> ``seq, op`` + the config fields: ``before`` for op d,
    ``after`` for every other op (also for one without an op). Rows without a
    decodable image are dropped. ``event_time`` also keeps ``ts_ms``."""
    cols = [c for c in raw.columns if c != value]
    parsed = raw.select(*cols, F.try_parse_json(value).alias("_v"))
    v = F.col("_v")
    op = get_str(v, "$.op")
    image = F.when(op == "d", F.try_variant_get(v, "$.before", STRUCT)) \
        .otherwise(F.try_variant_get(v, "$.after", STRUCT))
    time = [get_long(v, "$.ts_ms").alias("ts_ms")] if event_time else []
    decoded = parsed.select(*cols, *time, op.alias("op"), image.alias("_cfg"))
    decoded = decoded.select(*cols, *(["ts_ms"] if time else []), "op", *[F.col("_cfg")[f].alias(f) for f in FIELDS],
                             F.col("_cfg").isNotNull().alias("_ok"))
    return keep_where(decoded, "_ok")


def _families() -> Column:
    """Family names of ``sink_family``: comma split, trailing empty names
    dropped (like the reference's string split)."""
    return F.split(F.regexp_replace(F.col("sink_family"), ",+$", ""), ",")


def family_creates() -> Column:
    """Table creation succeeds: at least one family and no empty name."""
    fams = _families()
    return (F.col("sink_family").isNotNull() & (F.col("sink_family") != "")
            & (F.size(F.filter(fams, lambda f: f == "")) == 0)
            & (F.regexp_replace(F.col("sink_family"), ",", "") != ""))


def family_fails() -> Column:
    """Creation raises (missing family or an empty family name): the op is
    then lost for routing too. A list with no family at all (only commas) does
    not raise: nothing is created but the op still applies."""
    no_family = F.regexp_replace(F.col("sink_family"), ",", "") == ""
    return F.col("sink_family").isNull() | (~no_family & ~family_creates()) \
        | (F.col("sink_family") == "")


def config_ops(decoded: DataFrame, preload: DataFrame | None = None) -> DataFrame:
    """JOI-2: the feed plus the preloaded table (op r, before every feed op).
    ``preload`` may use snake_case or lowerCamel column names."""
    ops = decoded.select("seq", "op", *FIELDS) \
        .where(F.col("op").eqNullSafe("d") | ~family_fails())
    if preload is not None:
        p = preload.toDF(*[to_snake(c) for c in preload.columns])
        ops = p.select(F.lit(MIN_SEQ).alias("seq"), F.lit("r").alias("op"), *FIELDS) \
            .unionByName(ops)
    return ops


def latest_config(ops: DataFrame) -> DataFrame:
    """STA-2: the config in force per source table after every op; a delete
    removes the key. One row per source table (a small table)."""
    last = F.max_by(F.struct("op", *FIELDS[1:]), "seq")
    return (ops.groupBy("source_table").agg(last.alias("_c"))
            .where(~F.col("_c.op").eqNullSafe("d"))
            .select("source_table", *[F.col(f"_c.{f}").alias(f) for f in FIELDS[1:]],
                    F.col("_c.op").alias("op")))


def config_intervals(ops: DataFrame) -> DataFrame:
    """STA-2 as validity intervals: each non-delete op is in force from its
    ``seq`` (exclusive) until the next op of its source table. The "next op"
    is found without a window over a whole source table (``next_in_group``)."""
    return (next_in_group(ops, "source_table", "seq", "valid_to")
            .where(~F.col("op").eqNullSafe("d"))
            .withColumnRenamed("seq", "valid_from"))


def _life_ops(decoded: DataFrame) -> DataFrame:
    """The ops as they act on sink tables. One whose table creation does not happen: c/r do
    nothing, any other op has already dropped the table, so it acts as d."""
    creates = family_creates()
    eff = (F.when(F.col("op") == "d", F.lit("d"))
           .when(F.col("op").isin("c", "r"), F.when(creates, F.col("op")))
           .otherwise(F.when(creates, F.coalesce(F.col("op"), F.lit("u"))).otherwise(F.lit("d"))))
    return decoded.withColumn("op", eff).where(F.col("op").isNotNull())


def generations(decoded: DataFrame, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """SNK-3 over time: ``sink_table, seq, generation``, one row for each op that opens a
    generation of its sink table (an u or other op, or a c/r when there is no table) or
    ends one (d). A generation is numbered by the ``seq`` of the op that opened it, and is null after a d:
    a change belongs to the generation in force when it is routed, and the table holds the
    changes of its live generation only, whatever clocks both topics keep."""
    ops = previous_in_group(_life_ops(decoded).select("sink_table", "seq", "op"), "sink_table",
                            "seq", "op", "_before", window_rows)
    absent = F.col("_before").isNull() | (F.col("_before") == "d")
    opens = ~F.col("op").isin("c", "r", "d") | (F.col("op").isin("c", "r") & absent)
    return ops.where(opens | (F.col("op") == "d")) \
        .select("sink_table", "seq", F.when(opens, F.col("seq")).alias("generation"))


def table_lifecycle(decoded: DataFrame, latest: DataFrame | None = None) -> DataFrame:
    """SNK-3: per sink table named by the feed, whether it exists at the end
    (its last op is not d) and ``reset_seq``, where its current life began
    (null for a dropped table): the number of its live generation.

    c/r create the table unless it exists (then they do nothing); d drops it;
    u, and any other op, drops and re-creates it empty. A put to a table that
    does not exist fails, so only changes after ``reset_seq`` survive. The
    current life begins at the later of the first op after the last d and the
    last u (or other op): partial aggregations only, no window per table.

    With ``latest`` (from ``latest_config``), also ``orphan``: the table exists
    but no source table routes to it any more (a renamed sink, D13).
    """
    decoded = _life_ops(decoded)
    op = F.col("op")
    resets = ~op.isin("c", "r", "d")
    last = (decoded.groupBy("sink_table")
            .agg(F.max("seq").alias("_last"),
                 F.max(F.when(op == "d", F.col("seq"))).alias("_last_d"),
                 F.max(F.when(resets, F.col("seq"))).alias("_last_reset")))
    # the first op after the last drop (or the first op at all) creates the table
    after_d = (decoded.join(sized_broadcast(last.select("sink_table", "_last_d")),
                            "sink_table")
               .where(F.col("_last_d").isNull() | (F.col("seq") > F.col("_last_d")))
               .groupBy("sink_table").agg(F.min("seq").alias("_created")))
    live = F.coalesce(F.col("_last") != F.col("_last_d"), F.lit(True))
    out = (last.join(after_d, "sink_table", "left")
           .select("sink_table", live.alias("live"),
                   F.when(live, F.greatest("_created", "_last_reset")).alias("reset_seq")))
    if latest is None:
        return out
    routed = latest.select("sink_table").distinct().withColumn("_routed", F.lit(True))
    return (out.join(routed, "sink_table", "left")
            .withColumn("orphan", F.col("live") & F.col("_routed").isNull())
            .drop("_routed"))
