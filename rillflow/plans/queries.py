"""

Each takes ``(spark, sf_dir)``, reads the whole test tables, derives the
topics with Spark (``rillflow.sources.fixtures``) and runs the operator.
Outputs are plain fields (never JSON text) so that an independent SQL oracle
can compute them from the base tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions import dates, jsonvar
from rillflow.operators import changes as chg
from rillflow.operators import comments as cmt
from rillflow.operators import config as cfg
from rillflow.operators import dims, logs
from rillflow.operators.joins import fits_broadcast
from rillflow.session import ensure_json_settings, materialize, written
from rillflow.sources import fixtures as fx

# Every date in a query result is rendered in this zone, whatever the session's.
ZONE = "UTC"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_json_settings(spark)
    return fx.read_table(spark, sf_dir, name)


# ------------------------------------------------------------------------ logs
def log_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.log_raw(_read(spark, sf_dir, "events"))


def repaired_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = log_topic(spark, sf_dir)
    return logs.repair_new_visitors(logs.clean_logs(raw), ZONE,
                                    slim=logs.clean_logs(raw, keep_log=False))


@register("log_clean")
def log_clean(spark, sf_dir):
    return logs.clean_logs(log_topic(spark, sf_dir)).select("seq", "mid", "is_new", "ts")


@register("log_dirty")
def log_dirty(spark, sf_dir):
    return logs.dirty_logs(log_topic(spark, sf_dir)).select("seq")


@register("event_time")
def event_time(spark, sf_dir):
    df = logs.with_event_time(logs.clean_logs(log_topic(spark, sf_dir)))
    as_utc = F.convert_timezone(F.current_timezone(), F.lit(ZONE),
                                F.col("event_time").cast("timestamp_ntz"))
    return df.select("seq", "ts",
                     F.date_format(as_utc, "yyyy-MM-dd HH:mm:ss.SSS").alias("event_time"))


@register("date_functions")
def date_functions(spark, sf_dir):
    ev = _read(spark, sf_dir, "events")
    ms = dates.ntz_to_millis("ts")
    df = ev.select("event_id", ms.alias("ms"))
    df = df.select("event_id",
                   dates.ts_to_date("ms", ZONE).alias("dt"),
                   dates.ts_to_datetime("ms", ZONE).alias("dtime"),
                   dates.ts_to_date_partition("ms", ZONE).alias("dpart"))
    return df.select("*", dates.datetime_to_ts("dtime").alias("dtime_ts"),
                     dates.date_to_ts("dt").alias("date_ts"))


@register("visitor_fix")
def visitor_fix(spark, sf_dir):
    return repaired_logs(spark, sf_dir).select("seq", "mid", "is_new", "fixed_is_new")


def _channel(spark, sf_dir, channel: str) -> DataFrame:
    out = logs.log_channels(log_topic(spark, sf_dir), ZONE, [channel])
    return out.withColumn("v", jsonvar.parse_object("value"))


def _keys() -> F.Column:
    return F.array_join(F.array_sort(F.map_keys("v")), ",").alias("keys")


def _common_fields():
    v = F.col("v")
    return [jsonvar.get_str(v["common"], "$.mid").alias("mid"),
            jsonvar.get_str(v["common"], "$.is_new").alias("is_new"),
            jsonvar.get_long(v["ts"]).alias("ts")]


@register("split_err")
def split_err(spark, sf_dir):
    df = _channel(spark, sf_dir, "err")
    return df.select("seq", jsonvar.get_long(F.col("v")["error_code"]).alias("error_code"),
                     _keys())


@register("split_start")
def split_start(spark, sf_dir):
    df = _channel(spark, sf_dir, "start")
    return df.select("seq", *_common_fields(),
                     jsonvar.get_str(F.col("v")["start"], "$.entry").alias("entry"), _keys())


@register("split_page")
def split_page(spark, sf_dir):
    df = _channel(spark, sf_dir, "page")
    return df.select("seq", *_common_fields(),
                     jsonvar.get_str(F.col("v")["page"], "$.page_id").alias("page_id"), _keys())


@register("split_display")
def split_display(spark, sf_dir):
    df = _channel(spark, sf_dir, "display")
    v = F.col("v")
    return df.select("seq", *_common_fields(),
                     jsonvar.get_str(v["page"], "$.page_id").alias("page_id"),
                     jsonvar.get_str(v["item"]).alias("item"),
                     jsonvar.get_long(v["pos"]).alias("pos"), _keys())


@register("split_action")
def split_action(spark, sf_dir):
    df = _channel(spark, sf_dir, "action")
    v = F.col("v")
    return df.select("seq", *_common_fields(),
                     jsonvar.get_str(v["page"], "$.page_id").alias("page_id"),
                     jsonvar.get_str(v["action_id"]).alias("action_id"),
                     jsonvar.get_str(v["item"]).alias("item"), _keys())


@register("split_router")
def split_router(spark, sf_dir):
    out = logs.split_log(repaired_logs(spark, sf_dir))
    return out.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))


@register("log_outputs")
def log_outputs(spark, sf_dir):
    """The six outputs in one pass, rejected messages among them, as row ids."""
    return logs.log_outputs(log_topic(spark, sf_dir), ZONE).select("seq", "n", "channel")


# --------------------------------------------------------------------- changes

def change_topic(spark, sf_dir) -> DataFrame:
    r = lambda t: _read(spark, sf_dir, t)
    return fx.change_raw(r("customer"), r("supplier"), r("part"), r("orders"), r("region"))


def clean_change_rows(spark, sf_dir) -> DataFrame:
    return chg.clean_changes(chg.parse_changes(
        change_topic(spark, sf_dir), only=lambda db, table, kind: db == fx.SHOP_DB, old=False),
        fx.SHOP_DB)


@register("change_table")
def change_table(spark, sf_dir):
    return chg.parse_changes(change_topic(spark, sf_dir)) \
        .select("seq", "database", "table", "type", "ts")


@register("change_clean")
def change_clean(spark, sf_dir):
    return clean_change_rows(spark, sf_dir).select("seq", "table", "type")


# ---------------------------------------------------------------------- config
def decoded_config(spark, sf_dir) -> DataFrame:
    return cfg.decode_config(fx.config_raw(spark, _read(spark, sf_dir, "orders")))


def preload_config(spark, sf_dir) -> DataFrame:
    """The config table from files, by the reader of the dimension job (SRC-4)."""
    return cfg.read_config_table(spark, written(
        fx.config_table(spark, _read(spark, sf_dir, "orders")), "config-table"))


def all_config_ops(spark, sf_dir) -> DataFrame:
    """Feed + preload, written once to the shared checkpoint folder: the size
    checks, stats jobs and joins below all read it."""
    ops = cfg.config_ops(decoded_config(spark, sf_dir), preload_config(spark, sf_dir))
    return materialize(ops, "config_ops")


def feed_ops(ops: DataFrame) -> DataFrame:
    """The decoded feed within ``all_config_ops`` (the preload sits at MIN_SEQ)."""
    return ops.where(F.col("seq") > F.lit(cfg.MIN_SEQ))


@register("config_decode")
def config_decode(spark, sf_dir):
    return cfg.camel_columns(decoded_config(spark, sf_dir))


@register("config_preload")
def config_preload(spark, sf_dir):
    return preload_config(spark, sf_dir)


@register("config_latest")
def config_latest(spark, sf_dir):
    return cfg.latest_config(all_config_ops(spark, sf_dir))


@register("config_intervals")
def config_intervals(spark, sf_dir):
    return cfg.config_intervals(all_config_ops(spark, sf_dir)) \
        .select("source_table", "sink_table", "valid_from", "valid_to")


@register("table_lifecycle")
def table_lifecycle(spark, sf_dir):
    ops = all_config_ops(spark, sf_dir)
    return cfg.table_lifecycle(feed_ops(ops), cfg.latest_config(ops))


def routed_changes(spark, sf_dir, ops: DataFrame | None = None) -> DataFrame:
    ops = all_config_ops(spark, sf_dir) if ops is None else ops
    return dims.route_changes(clean_change_rows(spark, sf_dir), ops)


@register("config_route")
def config_route(spark, sf_dir):
    return routed_changes(spark, sf_dir).select("seq", "table", "sink_table")


@register("config_route_latest")
def config_route_latest(spark, sf_dir):
    """The per-micro-batch form of routing (STA-3): an equi-join to the latest
    config per source table, as a batch over the whole change topic."""
    latest = cfg.latest_config(all_config_ops(spark, sf_dir))
    return dims.route_latest(clean_change_rows(spark, sf_dir), latest) \
        .select("seq", "table", "sink_table")


@register("column_prune")
def column_prune(spark, sf_dir):
    df = dims.prune_columns(routed_changes(spark, sf_dir))
    return df.select("seq", F.array_join(F.array_sort(F.map_keys("data")), ",").alias("keys"))


def keyed_changes(spark, sf_dir, ops: DataFrame | None = None) -> DataFrame:
    return dims.with_row_key(dims.prune_columns(routed_changes(spark, sf_dir, ops)))


@register("row_key")
def row_key(spark, sf_dir):
    return keyed_changes(spark, sf_dir).select("seq", "sink_table", "row_key")


@register("row_key_quarantine")
def row_key_quarantine(spark, sf_dir):
    """Routed changes without a row key (D16)."""
    return dims.bad_row_keys(keyed_changes(spark, sf_dir)) \
        .select("seq", "table", "sink_table", "sink_row_key")


@register("table_generations")
def table_generations(spark, sf_dir):
    return cfg.generations(feed_ops(all_config_ops(spark, sf_dir)))


def stamped_changes(spark, sf_dir, ops: DataFrame) -> DataFrame:
    return dims.with_generation(keyed_changes(spark, sf_dir, ops),
                                materialize(cfg.generations(feed_ops(ops)), "generations"))


@register("change_generation")
def change_generation(spark, sf_dir):
    """Each change that meets an existing table, with the table's generation there."""
    return stamped_changes(spark, sf_dir, all_config_ops(spark, sf_dir)) \
        .select("seq", "sink_table", "generation")


@register("dim_snapshot")
def dim_snapshot(spark, sf_dir):
    ops = all_config_ops(spark, sf_dir)
    lifecycle = materialize(cfg.table_lifecycle(feed_ops(ops)), "lifecycle")
    return dims.dim_snapshot(dims.apply_lifecycle(stamped_changes(spark, sf_dir, ops), lifecycle))


@register("dic_from_snapshot")
def dic_from_snapshot(spark, sf_dir):
    """The dimension job's output as the comments job's dictionary (SRC-5)."""
    dic = cmt.dictionary_from_snapshot(dim_snapshot(spark, sf_dir), "dim_customer", "name")
    return dic.select("rowkey", F.col("info.dic_name").alias("dic_name"))


# -------------------------------------------------------------------- comments
def comment_topic(spark, sf_dir) -> DataFrame:
    return fx.comment_raw(_read(spark, sf_dir, "documents"))


def db_topic(spark, sf_dir) -> DataFrame:
    """All database changes on one topic: dimension tables and comments."""
    return change_topic(spark, sf_dir).unionByName(comment_topic(spark, sf_dir))


def dictionary(spark, sf_dir) -> DataFrame:
    return fx.dictionary(_read(spark, sf_dir, "region"))


@register("comment_filter")
def comment_filter(spark, sf_dir):
    return cmt.comment_project(cmt.new_comments(db_topic(spark, sf_dir), fx.SHOP_DB))


@register("comment_project")
def comment_project(spark, sf_dir):
    return cmt.comment_project(chg.parse_changes(comment_topic(spark, sf_dir)))


@register("dic_lookup")
def dic_lookup(spark, sf_dir):
    rows = cmt.comment_project(cmt.new_comments(db_topic(spark, sf_dir), fx.SHOP_DB))
    return cmt.lookup_dictionary(rows, dictionary(spark, sf_dir)) \
        .select("id", "appraise", "appraise_name")


@register("comment_info")
def comment_info(spark, sf_dir):
    # the view's predicate is applied where the records are parsed
    cmt.new_comments(db_topic(spark, sf_dir), fx.SHOP_DB, proc_time=True) \
        .createOrReplaceTempView("topic_db")
    dic = cmt.dictionary_table(dictionary(spark, sf_dir))
    dic.createOrReplaceTempView("base_dic")
    return cmt.comment_info_sql(spark, "topic_db", "base_dic", fx.SHOP_DB,
                                broadcast_dic=fits_broadcast(dic))
