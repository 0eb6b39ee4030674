"""Independent DuckDB SQL for every registered query.

Each statement computes the expected rows straight from the base tables by the
rules of FIXTURES.md (never from the JSON the Spark side reads), so the two
sides share the specification and nothing else.
"""

from __future__ import annotations

# Behaviour logs as fields, by the rules of FIXTURES.md 3.1; ms truncates to
# the millisecond like Spark's unix_millis.
_LOGS = """
ev AS (
  SELECT event_id AS seq, event_type AS et, user_id,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k,
         epoch_us(ts) // 1000 AS ms
  FROM events
),
lg AS (
  SELECT seq, et, k, ms,
         'mid_' || CAST(user_id AS VARCHAR) AS mid,
         CASE WHEN seq % 5 = 0 THEN '0' WHEN seq % 41 = 0 THEN 'x' ELSE '1' END AS is_new,
         strftime(epoch_ms(ms), '%Y-%m-%d') AS d,
         strftime(epoch_ms(ms - 86400000), '%Y-%m-%d') AS d_prev,
         seq % 89 = 0 AS dirty,
         seq % 89 <> 0 AND seq % 83 <> 0 AND seq % 71 <> 0 AND seq % 79 <> 0
           AND (et IN ('view', 'click', 'purchase', 'signup')
                OR (et = 'error' AND seq % 97 <> 0)) AS clean
  FROM ev
),
fx AS (
  SELECT *,
         CASE WHEN is_new = '1' AND first_value(
                CASE is_new WHEN '1' THEN d WHEN '0' THEN d_prev END IGNORE NULLS)
              OVER (PARTITION BY mid ORDER BY ms, seq
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <> d
              THEN '0' ELSE is_new END AS fixed_is_new
  FROM lg WHERE clean
)
"""

ORACLES: dict[str, str] = {}

ORACLES["log_clean"] = f"""
WITH {_LOGS}
SELECT seq, mid, is_new, ms AS ts FROM lg WHERE clean
"""

ORACLES["log_dirty"] = f"""
WITH {_LOGS}
SELECT seq FROM lg WHERE dirty
"""

ORACLES["event_time"] = f"""
WITH {_LOGS}
SELECT seq, ms AS ts, strftime(epoch_ms(ms), '%Y-%m-%d %H:%M:%S.%g') AS event_time
FROM lg WHERE clean
"""

ORACLES["date_functions"] = """
SELECT event_id,
       strftime(ts, '%Y-%m-%d') AS dt,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS dtime,
       strftime(ts, '%Y%m%d') AS dpart,
       epoch_ms(date_trunc('second', ts)) - 28800000 AS dtime_ts,
       epoch_ms(date_trunc('day', ts)) - 28800000 AS date_ts
FROM events
"""

ORACLES["visitor_fix"] = f"""
WITH {_LOGS}
SELECT seq, mid, is_new, fixed_is_new FROM fx
"""

ORACLES["split_err"] = f"""
WITH {_LOGS}
SELECT seq, k AS error_code, 'error_code' AS keys FROM fx WHERE et = 'error'
"""

ORACLES["split_start"] = f"""
WITH {_LOGS}
SELECT seq, mid, fixed_is_new AS is_new, ms AS ts, 'e' || CAST(k % 3 AS VARCHAR) AS entry,
       'common,start,ts' AS keys
FROM fx WHERE et = 'signup'
"""

ORACLES["split_page"] = f"""
WITH {_LOGS}
SELECT seq, mid, fixed_is_new AS is_new, ms AS ts, 'p' || CAST(k % 10 AS VARCHAR) AS page_id,
       'common,page,ts' AS keys
FROM fx WHERE et IN ('view', 'click', 'purchase', 'error')
"""

ORACLES["split_display"] = f"""
WITH {_LOGS},
d AS (SELECT *, unnest(range(k % 4)) AS pos FROM fx
      WHERE et IN ('view', 'click') AND k % 4 <> 3)
SELECT seq, mid, fixed_is_new AS is_new, ms AS ts, 'p' || CAST(k % 10 AS VARCHAR) AS page_id,
       'sku_' || CAST(k + pos AS VARCHAR) AS item, CAST(pos AS BIGINT) AS pos,
       'common,item,page,pos,ts' AS keys
FROM d
"""

ORACLES["split_action"] = f"""
WITH {_LOGS}
SELECT seq, mid, fixed_is_new AS is_new, ms AS ts, 'p' || CAST(k % 10 AS VARCHAR) AS page_id,
       et AS action_id, 'sku_' || CAST(k AS VARCHAR) AS item,
       'action_id,common,item,page,ts' AS keys
FROM fx WHERE et IN ('click', 'purchase')
"""

ORACLES["split_router"] = f"""
WITH {_LOGS},
counts AS (
  SELECT 'err' AS channel, count(*) FILTER (WHERE et = 'error') AS n FROM fx
  UNION ALL SELECT 'start', count(*) FILTER (WHERE et = 'signup') FROM fx
  UNION ALL SELECT 'page', count(*) FILTER (WHERE et <> 'signup') FROM fx
  UNION ALL SELECT 'display', coalesce(sum(k % 4) FILTER (
      WHERE et IN ('view', 'click') AND k % 4 <> 3), 0) FROM fx
  UNION ALL SELECT 'action', count(*) FILTER (WHERE et IN ('click', 'purchase')) FROM fx
)
SELECT channel, CAST(n AS BIGINT) AS n FROM counts WHERE n > 0
"""

# the rows of a record in the order err, start, page, display, action
ORACLES["log_outputs"] = f"""
WITH {_LOGS},
parts AS (
  SELECT seq, 1 AS part, 0 AS i, 'err' AS channel FROM lg WHERE clean AND et = 'error'
  UNION ALL SELECT seq, 2, 0, 'start' FROM lg WHERE clean AND et = 'signup'
  UNION ALL SELECT seq, 4, unnest(range(k % 4)), 'display' FROM lg
    WHERE clean AND et IN ('view', 'click') AND k % 4 <> 3
  UNION ALL SELECT seq, 5, 0, 'action' FROM lg WHERE clean AND et IN ('click', 'purchase')
  UNION ALL SELECT seq, 3, 0, 'page' FROM lg WHERE clean AND et <> 'signup'
  UNION ALL SELECT seq, 6, 0, 'dirty' FROM lg WHERE dirty
)
SELECT seq, CAST(row_number() OVER (PARTITION BY seq ORDER BY part, i) - 1 AS INTEGER) AS n, channel
FROM parts
"""

# Database changes as fields, by FIXTURES.md 3.2; ``keys`` lists the data keys.
_CHANGES = """
chg AS (
  SELECT 2 * c_custkey AS seq, 'shop' AS database, 'customer' AS tbl, 'bootstrap-insert' AS type,
         CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment,
         CAST(c_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS status,
         CAST(NULL AS VARCHAR) AS priority, 'id,name,segment,nation' AS keys
  FROM customer
  UNION ALL
  SELECT 10000000000 + 2 * c_custkey, 'shop', 'customer', 'update', CAST(c_custkey AS VARCHAR),
         c_name || '_v2', CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE lower(c_mktsegment) END,
         CAST(c_nationkey AS VARCHAR), NULL, NULL, 'id,name,segment,nation'
  FROM customer WHERE c_custkey % 5 = 0
  UNION ALL
  SELECT 20000000000 + 2 * c_custkey, 'shop', 'customer', 'delete', CAST(c_custkey AS VARCHAR),
         c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR), NULL, NULL, 'id,name,segment,nation'
  FROM customer WHERE c_custkey % 11 = 0
  UNION ALL
  SELECT 30000000000 + 2 * c_custkey, 'shop', 'customer', 'insert', CAST(c_custkey AS VARCHAR),
         'reborn', NULL, NULL, NULL, NULL, 'id,name'
  FROM customer WHERE c_custkey % 22 = 0
  UNION ALL
  SELECT 40000000000 + 2 * s_suppkey, 'shop', 'supplier',
         CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'insert' END, CAST(s_suppkey AS VARCHAR),
         s_name, NULL, CAST(s_nationkey AS VARCHAR), NULL, NULL, 'id,name,nation'
  FROM supplier
  UNION ALL
  SELECT 50000000000 + 2 * p_partkey, 'shop', 'part', 'insert', CAST(p_partkey AS VARCHAR), p_name,
         NULL, NULL, NULL, NULL, 'id,name'
  FROM part
  UNION ALL
  SELECT 60000000000 + 2 * o_orderkey, 'shop', 'order_info', 'insert',
         CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL, o_orderstatus, o_orderpriority,
         'id,status,priority'
  FROM orders
  UNION ALL
  SELECT 90000000000, 'shop', 'customer', 'bootstrap-start', NULL, NULL, NULL, NULL, NULL, NULL, ''
  FROM region WHERE r_regionkey = 0
  UNION ALL
  SELECT 90000000002 + 2 * r_regionkey, 'other', 'customer', 'insert',
         CAST(r_regionkey AS VARCHAR), r_name, NULL, NULL, NULL, NULL, 'id,name'
  FROM region
),
clean AS (
  SELECT * FROM chg
  WHERE database = 'shop' AND (type IS NULL OR type <> 'bootstrap-start') AND keys <> ''
)
"""

# Config feed (FIXTURES.md 3.3 plus the churn derived from orders) and the
# preloaded config table.
_CONFIG = """
churn AS (
  SELECT o_orderkey - 1000000000 AS seq, o_orderkey AS ok,
         'ods_order_' || CAST(o_orderkey % 61 AS VARCHAR) AS source_table,
         'dim_ods_' || CAST(o_orderkey % 61 AS VARCHAR) AS sink_base,
         CASE WHEN o_orderpriority LIKE '1%' THEN 'id,name'
              WHEN o_orderpriority LIKE '2%' THEN 'id,name,segment' ELSE 'id' END AS sink_columns,
         CASE WHEN o_orderstatus = 'P' THEN 'd' WHEN o_orderstatus = 'F' THEN 'u'
              WHEN o_orderkey % 2 = 0 THEN 'c' ELSE 'r' END AS op
  FROM orders WHERE o_orderkey % 101 <> 0
),
feed AS (
  SELECT seq, op, source_table,
         CASE WHEN op = 'u' AND ok % 7 = 0 THEN sink_base || '_v2' ELSE sink_base END
           AS sink_table,
         sink_columns, 'info' AS sink_family, 'id' AS sink_row_key
  FROM churn
  UNION ALL
  SELECT CAST(seq AS BIGINT), op, source_table, sink_table, sink_columns, sink_family,
         sink_row_key
  FROM (VALUES (-6, 'r', 'customer', 'dim_customer', 'id,name,segment', 'info', 'id'),
               (-5, 'r', 'part', 'dim_part', 'id,name', 'info', 'id'),
               (-4, 'c', 'supplier', 'dim_supplier', 'id,name,nation', 'info', 'id'),
               (-3, 'u', 'supplier', 'dim_supplier', 'id,name', 'info', 'id'),
               (-2, 'd', 'part', 'dim_part', 'id,name', 'info', 'id'),
               (40000000011, 'u', 'supplier', 'dim_supplier', 'id,name,nation', 'info', 'id'),
               (50000000041, 'r', 'part', 'dim_part', 'id,name', 'info', 'id'),
               (50000000121, NULL, 'part', 'dim_part', 'id,name', 'info', 'code'),
               (50000000161, 'c', 'part', 'dim_part', 'id,name', 'info', 'id'))
       AS t(seq, op, source_table, sink_table, sink_columns, sink_family, sink_row_key)
  UNION ALL
  SELECT 60000000001 + 2 * o_orderkey,
         CASE turn WHEN 0 THEN 'c' WHEN 1 THEN 'u' WHEN 2 THEN 'd' WHEN 3 THEN 'r' END,
         'order_info', CASE turn WHEN 3 THEN 'dim_order_alt' ELSE 'dim_order' END,
         CASE turn WHEN 1 THEN 'id,status,priority' WHEN 4 THEN 'status' ELSE 'id,status' END,
         'info', 'id'
  FROM (SELECT o_orderkey, o_orderkey // 50 % 5 AS turn FROM orders WHERE o_orderkey % 50 = 0)
),
preload AS (
  SELECT * FROM (VALUES ('customer', 'dim_customer', 'id,name,segment', 'info', 'id'),
                        ('part', 'dim_part', 'id,name', 'info', 'id'),
                        ('supplier', 'dim_supplier', 'id,name,nation', 'info', 'id'))
       AS t(source_table, sink_table, sink_columns, sink_family, sink_row_key)
  UNION ALL
  SELECT 'ods_order_' || CAST(o_orderkey AS VARCHAR), 'dim_ods_' || CAST(o_orderkey % 61 AS VARCHAR),
         'id,name', 'info', 'id'
  FROM orders
),
ops AS (
  SELECT CAST(-9223372036854775808 AS BIGINT) AS seq, 'r' AS op, * FROM preload
  UNION ALL SELECT * FROM feed
),
iv AS (
  SELECT * FROM (
    SELECT *, lead(seq) OVER (PARTITION BY source_table ORDER BY seq) AS valid_to FROM ops)
  WHERE op IS DISTINCT FROM 'd'
),
life AS (
  SELECT *, op NOT IN ('c', 'r', 'd') OR (op IN ('c', 'r') AND (prev IS NULL OR prev = 'd'))
            AS opens
  FROM (SELECT sink_table, seq, op, lag(op) OVER (PARTITION BY sink_table ORDER BY seq) AS prev
        FROM (SELECT sink_table, seq, coalesce(op, 'u') AS op FROM feed))
),
lc AS (
  SELECT sink_table, arg_max(op, seq) <> 'd' AS live,
         CASE WHEN arg_max(op, seq) <> 'd' THEN max(seq) FILTER (WHERE opens) END AS reset_seq
  FROM life GROUP BY sink_table
)
"""

_ROUTED = """
routed AS (
  SELECT c.*, iv.sink_table, iv.sink_columns, iv.sink_row_key
  FROM clean c JOIN iv ON c.tbl = iv.source_table AND c.seq > iv.seq
       AND c.seq < coalesce(iv.valid_to, 9223372036854775807)
)
"""

ORACLES["change_table"] = f"""
WITH {_CHANGES}
SELECT seq, database, tbl AS "table", type, 1700000000000 + seq AS ts FROM chg
"""

ORACLES["change_clean"] = f"""
WITH {_CHANGES}
SELECT seq, tbl AS "table", type FROM clean
"""

ORACLES["config_decode"] = f"""
WITH {_CONFIG}
SELECT seq, op, source_table AS sourceTable, sink_table AS sinkTable,
       sink_columns AS sinkColumns, sink_family AS sinkFamily, sink_row_key AS sinkRowKey
FROM feed
"""

ORACLES["config_preload"] = f"""
WITH {_CONFIG}
SELECT source_table AS sourceTable, sink_table AS sinkTable, sink_columns AS sinkColumns,
       sink_family AS sinkFamily, sink_row_key AS sinkRowKey
FROM preload
"""

ORACLES["config_latest"] = f"""
WITH {_CONFIG},
last AS (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY seq DESC) AS rn
         FROM ops)
SELECT source_table, sink_table, sink_columns, sink_family, sink_row_key, op
FROM last WHERE rn = 1 AND op IS DISTINCT FROM 'd'
"""

ORACLES["config_intervals"] = f"""
WITH {_CONFIG}
SELECT source_table, sink_table, seq AS valid_from, valid_to FROM iv
"""

ORACLES["table_lifecycle"] = f"""
WITH {_CONFIG},
last AS (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY seq DESC) AS rn
         FROM ops),
routed AS (SELECT DISTINCT sink_table FROM last WHERE rn = 1 AND op IS DISTINCT FROM 'd')
SELECT lc.sink_table, live, reset_seq,
       live AND lc.sink_table NOT IN (SELECT sink_table FROM routed) AS orphan
FROM lc
"""

ORACLES["config_route"] = f"""
WITH {_CHANGES}, {_CONFIG}, {_ROUTED}
SELECT seq, tbl AS "table", sink_table FROM routed
"""

ORACLES["config_route_latest"] = f"""
WITH {_CHANGES}, {_CONFIG},
last AS (SELECT *, row_number() OVER (PARTITION BY source_table ORDER BY seq DESC) AS rn
         FROM ops)
SELECT c.seq, c.tbl AS "table", last.sink_table
FROM clean c JOIN last ON c.tbl = last.source_table AND last.rn = 1 AND last.op IS DISTINCT FROM 'd'
"""

ORACLES["column_prune"] = f"""
WITH {_CHANGES}, {_CONFIG}, {_ROUTED}
SELECT seq, array_to_string(list_sort(list_intersect(string_split(keys, ','),
                                                     string_split(sink_columns, ','))), ',')
       AS keys
FROM routed
"""

ORACLES["row_key"] = f"""
WITH {_CHANGES}, {_CONFIG}, {_ROUTED}
SELECT seq, sink_table,
       CASE WHEN list_contains(string_split(sink_columns, ','), sink_row_key) THEN id END
         AS row_key
FROM routed
"""

ORACLES["row_key_quarantine"] = f"""
WITH {_CHANGES}, {_CONFIG}, {_ROUTED}
SELECT seq, tbl AS "table", sink_table, sink_row_key FROM routed
WHERE NOT list_contains(list_intersect(string_split(keys, ','), string_split(sink_columns, ',')),
                        sink_row_key)
"""

ORACLES["table_generations"] = f"""
WITH {_CONFIG}
SELECT sink_table, seq, CASE WHEN opens THEN seq END AS generation FROM life
WHERE opens OR op = 'd'
"""

# the generation by counting: ops that open or end one, at most as late as the change
ORACLES["change_generation"] = f"""
WITH {_CHANGES}, {_CONFIG}, {_ROUTED}, marks AS (
  SELECT sink_table, seq, opens, lead(seq) OVER (PARTITION BY sink_table ORDER BY seq) AS until
  FROM life WHERE opens OR op = 'd'
)
SELECT r.seq, r.sink_table, m.seq AS generation
FROM routed r JOIN marks m ON r.sink_table = m.sink_table AND m.opens AND r.seq > m.seq
     AND (m.until IS NULL OR r.seq < m.until)
"""

# Snapshot by windows over the unpivoted cells: the last delete of a row hides
# every earlier put; per cell the last non-null put after it wins.
ORACLES["dim_snapshot"] = f"""
WITH {_CHANGES}, {_CONFIG}, {_ROUTED},
live AS (
  SELECT r.* FROM routed r JOIN lc ON r.sink_table = lc.sink_table
  WHERE lc.live AND r.seq > coalesce(lc.reset_seq, -9223372036854775808)
    AND list_contains(string_split(r.sink_columns, ','), r.sink_row_key)
),
marked AS (
  SELECT *, max(CASE WHEN type = 'delete' THEN seq END)
              OVER (PARTITION BY sink_table, id) AS del_seq
  FROM live
),
cells AS (
  SELECT sink_table, id AS row_key, seq, col, val FROM marked
  CROSS JOIN LATERAL (VALUES ('id', id), ('name', name), ('segment', segment),
                             ('nation', nation), ('status', status),
                             ('priority', priority)) AS u(col, val)
  WHERE (type IS NULL OR type <> 'delete') AND seq > coalesce(del_seq, -1)
    AND val IS NOT NULL
    AND list_contains(string_split(keys, ','), col)
    AND list_contains(string_split(sink_columns, ','), col)
)
SELECT sink_table, row_key, col AS "column", arg_max(val, seq) AS value
FROM cells GROUP BY sink_table, row_key, col
"""

_COMMENTS = """
cm AS (
  SELECT doc_id, 100000000000 + doc_id AS seq,
         CASE WHEN doc_id % 13 = 0 THEN 'other' ELSE 'shop' END AS database,
         CASE WHEN doc_id % 10 = 0 THEN 'update' ELSE 'insert' END AS type,
         CAST(doc_id AS VARCHAR) AS id, CAST(doc_id % 100 AS VARCHAR) AS user_id,
         source AS sku_id, '120' || CAST(doc_id % 7 AS VARCHAR) AS appraise,
         text AS comment_txt, '2024-01-01 00:00:00' AS comment_time,
         1700000000000 + doc_id AS ts
  FROM documents
),
ci AS (SELECT * FROM cm WHERE database = 'shop' AND type = 'insert'),
dic AS (SELECT '120' || CAST(r_regionkey AS VARCHAR) AS rowkey, r_name AS dic_name FROM region)
"""

ORACLES["comment_project"] = f"""
WITH {_COMMENTS}
SELECT id, user_id, sku_id, appraise, comment_txt, comment_time, ts FROM cm
"""

ORACLES["comment_filter"] = f"""
WITH {_COMMENTS}
SELECT id, user_id, sku_id, appraise, comment_txt, comment_time, ts FROM ci
"""

ORACLES["dic_lookup"] = f"""
WITH {_COMMENTS}
SELECT id, appraise, dic_name AS appraise_name FROM ci JOIN dic ON ci.appraise = dic.rowkey
"""

ORACLES["comment_info"] = f"""
WITH {_COMMENTS}
SELECT id, user_id, sku_id, appraise, dic_name AS appraise_name, comment_txt, ts
FROM ci JOIN dic ON ci.appraise = dic.rowkey
"""

ORACLES["dic_from_snapshot"] = f"""
SELECT row_key AS rowkey, value AS dic_name FROM ({ORACLES["dim_snapshot"]}) AS cells
WHERE sink_table = 'dim_customer' AND "column" = 'name'
"""
