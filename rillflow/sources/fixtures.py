"""Test topics derived from the test tables (see FIXTURES.md section 3).

Each builder turns a base table into the JSON messages the jobs consume, one
scan per base table, so the topics grow with the tables. Rows that must be
malformed, incomplete or odd are chosen by fixed modulo rules on the table keys:
every row of every table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.functions.dates import ntz_to_millis

SHOP_DB = "shop"
COMMENT_TS_BASE = 1_700_000_000_000
CHANGE_TS_BASE = 1_700_000_000_000
CONFIG_CHURN_BASE = -1_000_000_000   # config churn sits before every change
# Changes lie in stages of the shared position axis, at even numbers: stage * STAGE + 2 * key;
# config ops between them at odd ones. Apart up to five thousand million keys.
STAGE = 10_000_000_000
COMMENT_SEQ_BASE = 10 * STAGE        # offset of comment rows on the shared topic
CREATE_TIME = "2024-01-01 00:00:00"

# Fixed config rows of FIXTURES.md 3.3, in feed order (cseq -6 .. -1).
CONFIG_ROWS = [
    ("r", None, ("customer", "dim_customer", "id,name,segment", "info", "id")),
    ("r", None, ("part", "dim_part", "id,name", "info", "id")),
    ("c", None, ("supplier", "dim_supplier", "id,name,nation", "info", "id")),
    ("u", ("supplier", "dim_supplier", "id,name,nation", "info", "id"),
     ("supplier", "dim_supplier", "id,name", "info", "id")),
    ("d", ("part", "dim_part", "id,name", "info", "id"), None),
    ("text", None, None),
]
# Config rows amid the changes: (seq, op, image). A reset of dim_supplier; dim_part (dropped
# above) created, reset by an envelope without an op to a row key that parts lack, and
# given its key again.
CONFIG_BETWEEN = [
    (4 * STAGE + 11, "u", ("supplier", "dim_supplier", "id,name,nation", "info", "id")),
    (5 * STAGE + 41, "r", ("part", "dim_part", "id,name", "info", "id")),
    (5 * STAGE + 121, None, ("part", "dim_part", "id,name", "info", "code")),
    (5 * STAGE + 161, "c", ("part", "dim_part", "id,name", "info", "id")),
]
# One order in so many brings an op on its own source table right behind its change.
ORDER_OP_EVERY = 50
CONFIG_FIELDS = ["source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"]
CONFIG_STRUCT = "struct<" + ",".join(f"{c}:string" for c in CONFIG_FIELDS) + ">"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """A topic has many partitions; a base table stored as one row group scans
    as one task. Spread such an input round-robin over the session's
    parallelism so the per-message work runs in parallel; inputs that already
    have enough splits (any large table) are left alone, with no shuffle."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD API (Spark Connect): leave the input as it is
        return df
    return df if have >= want else df.repartition(want)


def _json(struct: Column, keep_nulls: bool = False) -> Column:
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(struct, opts)


# --------------------------------------------------------------------------- logs
def log_raw(events: DataFrame) -> DataFrame:
    """``(seq, value)`` behaviour logs from ``events`` (FIXTURES.md 3.1)."""
    eid, etype = F.col("event_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    is_new = (F.when(eid % 5 == 0, "0").when(eid % 41 == 0, "x").otherwise("1"))
    mid = F.when(eid % 71 != 0, F.concat(F.lit("mid_"), F.col("user_id")))
    common = F.when(eid % 83 != 0, F.struct(mid.alias("mid"), is_new.alias("is_new")))
    start = F.when(etype == "signup", F.struct(F.concat(F.lit("e"), k % 3).alias("entry")))
    has_page = etype.isin("view", "click", "purchase") | ((etype == "error") & (eid % 97 != 0))
    page = F.when(has_page, F.struct(F.concat(F.lit("p"), k % 10).alias("page_id")))
    err = F.when(etype == "error", F.struct(k.alias("error_code")))
    n_disp = k % 4
    displays = F.when(
        etype.isin("view", "click") & (n_disp != 3),
        F.transform(F.array_repeat(F.lit(0), n_disp),
                    lambda _, i: F.struct(F.concat(F.lit("sku_"), k + i).alias("item"),
                                          i.alias("pos"))))
    actions = F.when(etype.isin("click", "purchase"),
                     F.array(F.struct(etype.alias("action_id"),
                                      F.concat(F.lit("sku_"), k).alias("item"))))
    ts = F.when(eid % 79 != 0, ntz_to_millis("ts"))
    record = F.struct(common.alias("common"), start.alias("start"), page.alias("page"),
                      err.alias("err"), displays.alias("displays"),
                      actions.alias("actions"), ts.alias("ts"))
    value = F.when(eid % 89 == 0, F.concat(F.lit('{"broken":'), k)).otherwise(_json(record))
    return spread(events).select(eid.alias("seq"), value.alias("value"))


# ------------------------------------------------------------------------ changes
def _change(db, table, ctype, seq, data, old=None) -> Column:
    msg = F.struct(F.lit(db).alias("database") if isinstance(db, str) else db.alias("database"),
                   F.lit(table).alias("table"),
                   (F.lit(ctype) if isinstance(ctype, str) else ctype).alias("type"),
                   (F.lit(CHANGE_TS_BASE) + seq).alias("ts"),
                   data.alias("data"),
                   (old if old is not None else F.lit(None).cast("map<string,string>")).alias("old"))
    return F.struct(seq.alias("seq"), _json(msg, keep_nulls=True).alias("value"))


def _explode_changes(df: DataFrame, changes: list[Column]) -> DataFrame:
    arr = F.filter(F.array(*changes), lambda x: x.isNotNull())
    return df.select(F.inline(arr))


def _at(stage: int, key: Column) -> Column:
    return F.lit(stage * STAGE) + key.cast("bigint") * 2


def change_raw(customer: DataFrame, supplier: DataFrame, part: DataFrame,
               orders: DataFrame, region: DataFrame) -> DataFrame:
    """``(seq, value)`` database change records (FIXTURES.md 3.2)."""
    ck = F.col("c_custkey")
    base = F.struct(ck.alias("id"), F.col("c_name").alias("name"),
                    F.col("c_mktsegment").alias("segment"),
                    F.col("c_nationkey").alias("nation"))
    upd = F.struct(ck.alias("id"), F.concat(F.col("c_name"), F.lit("_v2")).alias("name"),
                   F.when(ck % 10 != 0, F.lower("c_mktsegment")).alias("segment"),
                   F.col("c_nationkey").alias("nation"))
    reborn = F.struct(ck.alias("id"), F.lit("reborn").alias("name"))
    cust = _explode_changes(spread(customer), [
        _change(SHOP_DB, "customer", "bootstrap-insert", _at(0, ck), base),
        F.when(ck % 5 == 0, _change(SHOP_DB, "customer", "update", _at(1, ck), upd,
                                    F.create_map(F.lit("name"), F.col("c_name")))),
        F.when(ck % 11 == 0, _change(SHOP_DB, "customer", "delete", _at(2, ck), base)),
        F.when(ck % 22 == 0, _change(SHOP_DB, "customer", "insert", _at(3, ck), reborn)),
    ])
    sk = F.col("s_suppkey")
    supp = spread(supplier).select(F.inline(F.array(_change(
        SHOP_DB, "supplier", F.when(sk % 7 != 0, F.lit("insert")), _at(4, sk),
        F.struct(sk.alias("id"), F.col("s_name").alias("name"),
                 F.col("s_nationkey").alias("nation"))))))
    pk = F.col("p_partkey")
    prt = spread(part).select(F.inline(F.array(_change(
        SHOP_DB, "part", "insert", _at(5, pk),
        F.struct(pk.alias("id"), F.col("p_name").alias("name"))))))
    ok = F.col("o_orderkey")
    ords = spread(orders).select(F.inline(F.array(_change(
        SHOP_DB, "order_info", "insert", _at(6, ok),
        F.struct(ok.alias("id"), F.col("o_orderstatus").alias("status"),
                 F.col("o_orderpriority").alias("priority"))))))
    rk = F.col("r_regionkey").cast("bigint")
    other = region.select(F.inline(F.array(_change(
        "other", "customer", "insert", _at(9, rk) + 2,
        F.struct(rk.alias("id"), F.col("r_name").alias("name"))))))
    # the single bootstrap-start marker rides on region key 0
    marker = region.where(F.col("r_regionkey") == 0).select(F.inline(F.array(_change(
        SHOP_DB, "customer", "bootstrap-start", F.lit(9 * STAGE).cast("bigint"),
        F.create_map().cast("map<string,string>")))))
    return cust.unionByName(supp).unionByName(prt).unionByName(ords) \
        .unionByName(other).unionByName(marker)


# ------------------------------------------------------------------------- config
def _cfg_struct(src, sink, cols, family, rowkey) -> Column:
    vals = [src, sink, cols, family, rowkey]
    return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(n)
                      for v, n in zip(vals, CONFIG_FIELDS)])


def _envelope(op: Column, before: Column, after: Column, ts_ms: Column) -> Column:
    return _json(F.struct(op.alias("op"), before.alias("before"), after.alias("after"),
                          ts_ms.alias("ts_ms")))


def config_fixed(spark: SparkSession) -> DataFrame:
    """The fixed config feed rows (FIXTURES.md 3.3): cseq -6 .. -1, and those amid the
    changes."""
    rows = []
    none = F.lit(None).cast(CONFIG_STRUCT)
    for i, (op, before, after) in enumerate(CONFIG_ROWS):
        cseq = i - len(CONFIG_ROWS)
        if op == "text":
            rows.append(F.struct(F.lit(cseq).cast("bigint").alias("seq"),
                                 F.lit("not json").alias("value")))
            continue
        b = _cfg_struct(*before) if before else none
        a = _cfg_struct(*after) if after else none
        rows.append(F.struct(F.lit(cseq).cast("bigint").alias("seq"),
                             _envelope(F.lit(op), b, a, F.lit(CHANGE_TS_BASE + cseq))
                             .alias("value")))
    for seq, op, image in CONFIG_BETWEEN:
        rows.append(F.struct(F.lit(seq).cast("bigint").alias("seq"), _envelope(
            F.lit(op).cast("string"), none, _cfg_struct(*image), F.lit(CHANGE_TS_BASE + seq))
            .alias("value")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def config_amid_orders(orders: DataFrame) -> DataFrame:
    """Ops on the source table ``order_info`` between its changes, one in ``ORDER_OP_EVERY``:
    create, reset, drop, create another sink, and an envelope without an op whose columns
    lack the row key, in turn. One source table with a version for every few changes."""
    ok = F.col("o_orderkey")
    turn = F.floor(ok / ORDER_OP_EVERY) % 5
    op = F.element_at(F.array(*[F.lit(x).cast("string") for x in ("c", "u", "d", "r", None)]),
                      (turn + 1).cast("int"))
    sink = F.when(turn == 3, "dim_order_alt").otherwise("dim_order")
    cols = (F.when(turn == 1, "id,status,priority").when(turn == 4, "status")
            .otherwise("id,status"))
    image = _cfg_struct("order_info", sink, cols, "info", "id")
    none = F.lit(None).cast(CONFIG_STRUCT)
    gone = op.eqNullSafe("d")
    seq = _at(6, ok) + 1
    value = _envelope(op, F.when(gone, image).otherwise(none),
                      F.when(gone, none).otherwise(image), F.lit(CHANGE_TS_BASE) + seq)
    return orders.where(ok % ORDER_OP_EVERY == 0).select(seq.alias("seq"), value.alias("value"))


def config_churn(orders: DataFrame) -> DataFrame:
    """Config feed rows derived from ``orders``: one op per order on 61 source
    tables, before every change, so the config jobs grow with the data."""
    ok = F.col("o_orderkey")
    key = ok % 61
    src = F.concat(F.lit("ods_order_"), key)
    sink = F.concat(F.lit("dim_ods_"), key)
    cols = (F.when(F.col("o_orderpriority").startswith("1"), "id,name")
            .when(F.col("o_orderpriority").startswith("2"), "id,name,segment")
            .otherwise("id"))
    status = F.col("o_orderstatus")
    op = (F.when(status == "P", "d").when(status == "F", "u")
          .when(ok % 2 == 0, "c").otherwise("r"))
    new_sink = F.when((status == "F") & (ok % 7 == 0), F.concat(sink, F.lit("_v2"))).otherwise(sink)
    cfg_old = _cfg_struct(src, sink, cols, "info", "id")
    cfg_new = _cfg_struct(src, new_sink, cols, "info", "id")
    none = F.lit(None).cast(CONFIG_STRUCT)
    before = F.when(op.isin("d", "u"), cfg_old).otherwise(none)
    after = F.when(op != "d", cfg_new).otherwise(none)
    seq = F.lit(CONFIG_CHURN_BASE) + ok
    value = F.when(ok % 101 == 0, F.lit('{"op":"c","after":{'))\
        .otherwise(_envelope(op, before, after, F.lit(CHANGE_TS_BASE) + seq))
    return spread(orders).select(seq.alias("seq"), value.alias("value"))


def config_raw(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """``(seq, value)`` config change envelopes: derived churn, fixed rows, and ops
    between the changes of orders."""
    return config_churn(orders).unionByName(config_fixed(spark)) \
        .unionByName(config_amid_orders(spread(orders)))


def config_table(spark: SparkSession, orders: DataFrame) -> DataFrame:
    """Snapshot of the config table (snake_case columns), as read at start-up:
    fixed rows 1-3 plus one row per order."""
    fixed = [after for op, _, after in CONFIG_ROWS[:3]]
    head = spark.createDataFrame(fixed, ", ".join(f"{c} string" for c in CONFIG_FIELDS))
    ok = F.col("o_orderkey")
    derived = spread(orders).select(
        F.concat(F.lit("ods_order_"), ok).alias("source_table"),
        F.concat(F.lit("dim_ods_"), ok % 61).alias("sink_table"),
        F.lit("id,name").alias("sink_columns"), F.lit("info").alias("sink_family"),
        F.lit("id").alias("sink_row_key"))
    return head.unionByName(derived)


# ----------------------------------------------------------------------- comments
def comment_raw(documents: DataFrame) -> DataFrame:
    """``(seq, value)`` comment change records from ``documents`` (FIXTURES.md 3.4);
    the comment text is the whole document text."""
    d = F.col("doc_id")
    data = F.struct(d.alias("id"), (d % 100).alias("user_id"), F.col("source").alias("sku_id"),
                    F.concat(F.lit("120"), d % 7).alias("appraise"),
                    F.col("text").alias("comment_txt"),
                    F.lit(CREATE_TIME).alias("create_time"))
    msg = F.struct(F.when(d % 13 == 0, "other").otherwise(SHOP_DB).alias("database"),
                   F.lit("comment_info").alias("table"),
                   F.when(d % 10 == 0, "update").otherwise("insert").alias("type"),
                   (F.lit(COMMENT_TS_BASE) + d).alias("ts"), data.alias("data"))
    return spread(documents).select((F.lit(COMMENT_SEQ_BASE) + d).alias("seq"),
                                    _json(msg).alias("value"))


def dictionary(region: DataFrame) -> DataFrame:
    """Dictionary dimension ``(rowkey, info<dic_name>)`` from ``region``."""
    return region.select(F.concat(F.lit("120"), F.col("r_regionkey")).alias("rowkey"),
                         F.struct(F.col("r_name").alias("dic_name")).alias("info"))
