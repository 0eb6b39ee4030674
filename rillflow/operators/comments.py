"""Comments job: new comment rows (FIL-3, PRJ-1) enriched by a lookup join to
the dictionary dimension (SRC-5, JOI-3, PRJ-2, PRJ-7).

Two equivalent forms: DataFrame operators, and the SQL text over temporary
views (API-3), which Catalyst plans the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillflow.operators.changes import parse_changes
from rillflow.operators.joins import sized_broadcast

COMMENT_KEYS = ("id", "user_id", "sku_id", "appraise", "comment_txt")
RESULT_COLS = ("id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts")


def is_new_comment(database: str):
    """FIL-3 on the three columns: an insert into ``comment_info`` of the shop database."""
    return lambda db, table, kind: ((db == database) & (table == "comment_info")
                                    & (kind == "insert"))


def comment_filter(changes: DataFrame, database: str) -> DataFrame:
    """FIL-3: inserts into ``comment_info`` of the shop database."""
    return changes.where(is_new_comment(database)(F.col("database"), F.col("table"),
                                                  F.col("type")))


def new_comments(raw: DataFrame, database: str, proc_time: bool = False) -> DataFrame:
    """SRC-2 and FIL-3 in one: the new comments of a change topic. The maps are built
    for them alone."""
    return parse_changes(raw, proc_time=proc_time, only=is_new_comment(database), old=False)


def comment_project(changes: DataFrame) -> DataFrame:
    """PRJ-1: six ``data`` keys as columns (a missing key gives null), plus
    ``ts`` and ``proc_time`` when present."""
    extra = [c for c in ("proc_time",) if c in changes.columns]
    return changes.select(*[F.col("data")[k].alias(k) for k in COMMENT_KEYS],
                          F.col("data")["create_time"].alias("comment_time"), "ts", *extra)


def dictionary_from_snapshot(cells: DataFrame, sink_table: str,
                             column: str = "dic_name") -> DataFrame:
    """SRC-5: the dictionary is a dimension table: ``(rowkey, info<dic_name>)`` from
    the cells of a snapshot (``dims.dim_snapshot``)."""
    own = (F.col("sink_table") == sink_table) & (F.col("column") == column)
    return cells.where(own).select(F.col("row_key").alias("rowkey"),
                                   F.struct(F.col("value").alias("dic_name")).alias("info"))


def dictionary_table(dic: DataFrame) -> DataFrame:
    """SRC-5: ``rowkey string, info struct<dic_name string>``."""
    return dic.select(F.col("rowkey").cast("string"),
                      F.struct(F.col("info.dic_name").cast("string").alias("dic_name"))
                      .alias("info"))


def lookup_dictionary(comments: DataFrame, dic: DataFrame, limit: int | None = None) -> DataFrame:
    """JOI-3 + PRJ-2 + PRJ-7: inner join on ``appraise = rowkey``; unmatched
    comments are dropped. The dictionary is broadcast when its size allows."""
    d = sized_broadcast(dictionary_table(dic), limit)
    joined = comments.join(d, comments["appraise"] == d["rowkey"])
    return joined.select("id", "user_id", "sku_id", "appraise",
                         F.col("info.dic_name").alias("appraise_name"), "comment_txt", "ts")


COMMENT_SQL = """
SELECT data['id'] AS id, data['user_id'] AS user_id, data['sku_id'] AS sku_id,
       data['appraise'] AS appraise, data['comment_txt'] AS comment_txt,
       data['create_time'] AS comment_time, ts, proc_time
FROM {topic}
WHERE `database` = '{database}' AND `table` = 'comment_info' AND `type` = 'insert'
"""

RESULT_SQL = """
SELECT /*+ BROADCAST(dic) */ ci.id, ci.user_id, ci.sku_id, ci.appraise,
       dic.info.dic_name AS appraise_name, ci.comment_txt, ci.ts
FROM comment_info ci JOIN {dic} dic ON ci.appraise = dic.rowkey
"""


def comment_info_sql(spark: SparkSession, topic_view: str, dic_view: str, database: str,
                     broadcast_dic: bool = True) -> DataFrame:
    """API-3: the job as SQL over temporary views: the filtered projection is
    registered as ``comment_info`` and joined to the dictionary view."""
    spark.sql(COMMENT_SQL.format(topic=topic_view, database=database)) \
        .createOrReplaceTempView("comment_info")
    sql = RESULT_SQL.format(dic=dic_view)
    if not broadcast_dic:
        sql = sql.replace("/*+ BROADCAST(dic) */ ", "")
    return spark.sql(sql)
