"""The same answers in plain SQL, for the check against DuckDB."""

from __future__ import annotations

_L = """
l AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_quantity AS quantity,
         CAST(l_shipdate AS DATE) AS order_date, l_partkey AS part_id, l_suppkey AS supp_id,
         l_discount AS discount, l_returnflag AS flag, l_linestatus AS status,
         CAST(year(l_shipdate) AS VARCHAR) AS year, CAST(month(l_shipdate) AS VARCHAR) AS month
  FROM lineitem)"""

_B = _L + """,
b AS (
  SELECT * FROM l
  QUALIFY row_number() OVER (
    PARTITION BY order_id, line_id ORDER BY order_date DESC, part_id DESC, supp_id DESC) = 1)"""

_UI = _B + """,
u AS (SELECT * REPLACE (quantity + 1 AS quantity) FROM b WHERE flag = 'R'),
i AS (SELECT * REPLACE (-1 - order_id AS order_id) FROM b WHERE discount = 0),
ui AS (SELECT * FROM u UNION ALL SELECT * FROM i),
merged AS (
  SELECT * FROM b WHERE NOT EXISTS (
    SELECT 1 FROM u WHERE u.order_id = b.order_id AND u.line_id = b.line_id)
  UNION ALL SELECT * FROM ui)"""

_D = _B + """,
d AS (SELECT o_orderkey AS order_id FROM orders
      WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT')"""

_ERASED = "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'"

_R = "order_id, line_id, quantity, order_date"
_RP = _R + ", year, month"
_PATH = "'year=' || year || '/month=' || month"


def _l(query: str) -> str:
    return f"WITH {_L} {query}"


def _b(query: str) -> str:
    return f"WITH {_B} {query}"


def _m(query: str) -> str:
    return f"WITH {_UI} {query}"


def _d(query: str) -> str:
    return f"WITH {_D} {query}"


_BASE_R = _b(f"SELECT {_R} FROM b")
_BASE_RP = _b(f"SELECT {_RP} FROM b")
_MERGED_R = _m(f"SELECT {_R} FROM merged")
_MERGED_RP = _m(f"SELECT {_RP} FROM merged")

ORACLE: dict[str, str] = {
    # scans and sources
    "full_load_scan": _l(f"SELECT {_R} FROM l"),
    "file_list_scan": """
        SELECT 'lineitem' AS source, count(*) AS n FROM lineitem
        UNION ALL SELECT 'orders' AS source, count(*) AS n FROM orders""",
    "snapshot_read": _MERGED_RP,
    "catalog_scan": _m(f"SELECT {_RP} FROM merged WHERE order_id IN (101, 202, 303)"),
    "json_infer_scan": """
        SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n
        FROM events GROUP BY 1""",
    "json_event_parse": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "stream_upsert": _MERGED_R,
    "stream_added_column": _m(f"""SELECT {_R}, NULL::DOUBLE AS new_col FROM b
           WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.order_id = b.order_id AND u.line_id = b.line_id)
           UNION ALL SELECT {_R}, NULL FROM u UNION ALL SELECT {_R}, quantity * 2 FROM i"""),
    "stream_mor": _MERGED_R,
    "stream_replay_idempotent": _MERGED_R,
    # sinks and writes
    "bulk_insert": "SELECT count(*) AS n, CAST(3 AS BIGINT) AS files FROM lineitem",
    "insert_overwrite": _BASE_R,
    "partitioned_write": _BASE_RP,
    "upsert_cow": _MERGED_RP,
    "upsert_nonpartitioned": _MERGED_R,
    "upsert_idempotent": _MERGED_R,
    "upsert_event_time": _BASE_R,
    "upsert_added_column": _m(
        f"""SELECT {_R}, CAST(NULL AS BIGINT) AS new_col FROM b WHERE NOT EXISTS (
              SELECT 1 FROM u WHERE u.order_id = b.order_id AND u.line_id = b.line_id)
            UNION ALL SELECT {_R}, part_id AS new_col FROM u"""
    ),
    "partition_extract": _b(
        "SELECT year, month, count(*) AS n FROM b GROUP BY year, month"
    ),
    "manifest_read": _MERGED_RP,
    "manifest_files": _m("SELECT year, month, count(*) AS n FROM merged GROUP BY year, month"),
    "manifest_text": _m("SELECT year, month, count(*) AS n FROM merged GROUP BY year, month"),
    "catalog_realtime": _MERGED_RP,
    "stream_offsets": _m(
        """SELECT CAST(0 AS BIGINT) AS batch_id, CAST(NULL AS BIGINT) AS start_offset, CAST(0 AS BIGINT) AS end_offset,
                  count(DISTINCT year(order_date)) AS n_rows, '20240101000002' AS commit_id, count(*) AS rows_received FROM ui"""
    ),
    "commit_metrics_mor": _m(
        f"""SELECT * FROM (
             SELECT '20240101000001' AS commit_id, 'insert' AS action, count(*) AS n FROM b
             UNION ALL SELECT '20240101000004', 'insert', count(*) FROM i
             UNION ALL SELECT '20240101000004', 'update', count(*) FROM u WHERE order_id NOT IN ({_ERASED})
             UNION ALL SELECT '20240101000004', 'delete', count(*) FROM b WHERE order_id IN ({_ERASED}))
           WHERE n > 0"""
    ),
    "pending_actions": _m(
        f"""SELECT (SELECT count(*) FROM i) AS n_insert, (SELECT count(*) FROM u WHERE order_id NOT IN ({_ERASED})) AS n_update,
                  (SELECT count(*) FROM b WHERE order_id IN ({_ERASED})) AS n_delete"""
    ),
    # projections and filters
    "lowercase_columns": _l(f"SELECT {_R} FROM l"),
    "drop_metadata": _BASE_R,
    "derive_keys": _l(
        f"""SELECT order_id, line_id,
                   CAST(order_id AS VARCHAR) || '#' || CAST(line_id AS VARCHAR) AS record_key,
                   order_date, year, month, {_PATH} AS partition_key FROM l"""
    ),
    "filter_in_list": _b(f"SELECT {_R} FROM b WHERE order_id IN (101, 202, 303)"),
    "filter_between": _b(f"SELECT {_R} FROM b WHERE order_id BETWEEN 300 AND 310"),
    "point_lookup": _b(f"SELECT {_R} FROM b WHERE order_id = 100 AND line_id = 6"),
    "filter_null": _m(
        f"""SELECT {_R}, CAST(NULL AS BIGINT) AS new_col FROM b WHERE NOT EXISTS (
              SELECT 1 FROM u WHERE u.order_id = b.order_id AND u.line_id = b.line_id)"""
    ),
    "update_where": _b(
        """SELECT order_id, line_id, CASE WHEN flag = 'R' THEN quantity + 1 ELSE quantity END AS quantity,
                  order_date FROM b"""
    ),
    "update_where_count": _b("SELECT count(*) AS n_updated FROM b WHERE flag = 'R'"),
    # joins
    "delete_candidates": _d(f"SELECT b.order_id, line_id, quantity, order_date FROM b, d WHERE b.order_id = d.order_id"),
    "delete_candidates_semi": _d(f"SELECT {_R} FROM b WHERE order_id IN (SELECT order_id FROM d)"),
    # aggregations, ranking, limit
    "count_all": _b("SELECT count(*) AS n FROM b"),
    "partition_counts": _m(
        "SELECT year, month, count(*) AS n FROM merged GROUP BY year, month ORDER BY year, month"
    ),
    "precombine_batch": _BASE_R,
    "precombine_window": _BASE_R,
    "limit_rows": _b(f"SELECT {_R} FROM b ORDER BY order_id, line_id LIMIT 5"),
    "batch_counts": _m(
        """SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n FROM ui"""
    ),
    "commit_metrics": _m(
        """SELECT * FROM (
             SELECT '20240101000001' AS commit_id, 'insert' AS action, count(*) AS n FROM b
             UNION ALL SELECT '20240101000002', 'insert', count(*) FROM i
             UNION ALL SELECT '20240101000002', 'update', count(*) FROM u
             UNION ALL SELECT '20240101000003', 'delete', count(*) FROM merged WHERE order_id IN (
               SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'))
           WHERE n > 0"""
    ),
    # scalar functions
    "metric_key_split": """
        WITH keyed AS (
          SELECT CASE WHEN o_orderstatus = 'P' THEN 'table_' || o_orderstatus
                      ELSE 'table_' || o_orderstatus || '.commit.' || o_orderpriority END AS key,
                 CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a'
                      ELSE CAST(o_custkey AS VARCHAR) END AS value, o_orderkey
          FROM orders)
        SELECT o_orderkey, split_part(key, '.', 1) AS "table",
               CASE WHEN position('.' IN key) > 0 THEN substr(key, position('.' IN key) + 1) END AS metric,
               TRY_CAST(value AS DOUBLE) AS value
        FROM keyed""",
    "config_list_parse": """
        WITH items AS (
          SELECT unnest(string_split(
            ' ' || o_orderstatus || ' , ' || o_orderpriority || ',, ', ',')) AS item FROM orders)
        SELECT trim(item) AS item, count(*) AS n FROM items WHERE trim(item) <> '' GROUP BY 1""",
    "parse_timestamp": "SELECT event_id, date_trunc('second', ts) AS ts FROM events",
    # keyed-table operators
    "soft_delete_null": _d(
        """SELECT order_id, line_id,
                  CASE WHEN order_id IN (SELECT order_id FROM d) THEN NULL ELSE quantity END AS quantity,
                  order_date FROM b"""
    ),
    "soft_delete_value": _d(
        """SELECT order_id, line_id,
                  CASE WHEN order_id IN (SELECT order_id FROM d) THEN -1 ELSE quantity END AS quantity,
                  order_date FROM b"""
    ),
    "hard_delete": _d(f"SELECT {_R} FROM b WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.order_id = b.order_id)"),
    "delete_where": _b(f"SELECT {_R} FROM b WHERE flag <> 'R'"),
    "mor_read_optimized": _BASE_R,
    "mor_realtime": _MERGED_RP,
    "mor_pending_changes": _m(
        """SELECT ui.order_id, ui.line_id, b.quantity AS old_quantity, ui.quantity AS new_quantity
           FROM ui LEFT JOIN b ON ui.order_id = b.order_id AND ui.line_id = b.line_id"""
    ),
    "compact": _MERGED_R,
    "compactions_show": _m(
        """SELECT '20240101000003' AS commit_id, 'completed' AS state, count(*) AS n_rows FROM u
           UNION ALL SELECT '20240101000005', 'requested', CAST(0 AS BIGINT)"""
    ),
    "commits_show": _m(
        """SELECT '20240101000001' AS commit_id, 'commit' AS kind, 'completed' AS state,
                  (SELECT count(*) FROM b) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated
           UNION ALL SELECT '20240101000002', 'commit', 'rolled_back',
                  (SELECT count(*) FROM i), (SELECT count(*) FROM u)
           UNION ALL SELECT '20240101000003', 'rollback', 'completed', NULL, NULL"""
    ),
    "rollback_latest": _BASE_R,
    "rollback_after_clean": _m(f"""SELECT {_R} FROM b
           WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.order_id = b.order_id AND u.line_id = b.line_id)
           UNION ALL SELECT {_R} FROM u"""),
    "snapshot_as_of": _BASE_R,
    "latest_version_per_partition": _m(
        f"""SELECT partition_path, max(version) AS version FROM (
              SELECT {_PATH} AS partition_path, '20240101000001' AS version FROM b
              UNION ALL SELECT {_PATH}, '20240101000002' FROM ui)
            GROUP BY partition_path"""
    ),
    "retained_versions": _m(
        f""", d AS (SELECT o_orderkey AS order_id FROM orders
                    WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'),
            touched AS (
              SELECT DISTINCT {_PATH} AS partition_path, '20240101000001' AS version FROM b
              UNION ALL SELECT DISTINCT {_PATH}, '20240101000002' FROM ui
              UNION ALL SELECT DISTINCT {_PATH}, '20240101000003' FROM merged
                        WHERE order_id IN (SELECT order_id FROM d)
              UNION ALL SELECT DISTINCT {_PATH}, '20240101000004' FROM merged
                        WHERE quantity >= 50 AND order_id NOT IN (SELECT order_id FROM d))
            SELECT partition_path, version FROM touched
            QUALIFY dense_rank() OVER (PARTITION BY partition_path ORDER BY version DESC) <= 3"""
    ),
    "metadata_columns": _m(
        f"""SELECT order_id, line_id,
                   CASE WHEN flag = 'R' OR order_id < 0 THEN '20240101000002'
                        ELSE '20240101000001' END AS _commit_time,
                   CAST(order_id AS VARCHAR) || '#' || CAST(line_id AS VARCHAR) AS _record_key,
                   {_PATH} AS _partition_path FROM merged"""
    ),
    "list_partitions": _m(f"SELECT DISTINCT {_PATH} AS partition_path FROM merged"),
    # schema operators
    "schema_validate": _b(
        """SELECT false AS ok, CAST(1 AS BIGINT) AS n_added, CAST(0 AS BIGINT) AS n_missing,
                  CAST(1 AS BIGINT) AS n_retyped,
                  count(*) FILTER (WHERE discount = 0) AS n_uncastable FROM b"""
    ),
    "schema_diff": _b(
        """SELECT 'new_col' AS "column", 'added' AS change, count(*) AS n_values FROM b
           UNION ALL SELECT 'order_date', 'missing', CAST(0 AS BIGINT)
           UNION ALL SELECT 'quantity', 'retyped', count(quantity) FROM b"""
    ),
    "evolve_schema": _b(
        """SELECT order_id, line_id, CASE WHEN discount = 0 THEN NULL ELSE quantity END AS quantity,
                  CAST(NULL AS DATE) AS order_date, part_id AS new_col FROM b"""
    ),
    "evolve_strict": _b(
        """SELECT false AS ok,
                  'added new_col bigint; missing order_date date; retyped quantity double -> string' AS report,
                  count(*) AS n_refused FROM b"""
    ),
    "evolve_no_cast": _b(
        """SELECT order_id, line_id,
                  CASE WHEN discount = 0 THEN 'n/a' ELSE CAST(CAST(quantity AS BIGINT) AS VARCHAR) END AS quantity,
                  CAST(NULL AS DATE) AS order_date, part_id AS new_col FROM b"""
    ),
    "force_cast": _b(
        """SELECT order_id, line_id, TRY_CAST(
             CASE WHEN discount = 0 THEN 'n/a' ELSE CAST(quantity AS VARCHAR) END AS DOUBLE) AS quantity
           FROM b"""
    ),
    "null_fill_dropped": _b(
        "SELECT order_id, line_id, CAST(NULL AS DOUBLE) AS quantity, order_date FROM b"
    ),
}
