"""The same queries as plain SQL over the same tables, for DuckDB."""

from __future__ import annotations

_DAY = "strftime(l_shipdate, '%Y-%m-%d')"
_SHIP_MONTH = "strftime(l_shipdate, '%Y-%m-01')"
_ORDER_MONTH = "strftime(o_orderdate, '%Y-%m-01')"
_BUSINESS_DAY = "strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d')"
_RUN_DAY = "'2024-02-01'"
_HAS_LINES = "o_orderkey IN (SELECT l_orderkey FROM lineitem)"
_NO_LINES = "o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"
_LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, "
    "l_discount, l_tax, l_returnflag, l_linestatus"
)
_LINE_COPIES = "SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY l_orderkey"
_ENVELOPE = (
    "'sales.orders' AS \"table\", 'null' AS op_type, 'null' AS op_ts, "
    "'2024-02-01 06:30:00' AS current_ts, 'null' AS pos"
)
_SOME_ORDER_KEYS = "CASE WHEN o_orderkey % 10 <> 7 THEN o_orderkey END"
_SOME_LINE_KEYS = "CASE WHEN l_orderkey % 10 <> 7 THEN l_orderkey END"
_TEXT_ORDERS = "SELECT * REPLACE (CAST(o_orderkey AS VARCHAR) AS o_orderkey)"
_MISSING_SPAN = f"""
    SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders WHERE {_NO_LINES}
"""
_LANDED = f"SELECT *, {_ORDER_MONTH} AS day FROM orders WHERE {_HAS_LINES}"
_EXTRA_BY_DAY = f"""
    SELECT l_orderkey, l_linenumber, day, min(rno) AS first_rno, max(rno) AS last_rno,
           count(*) AS extra_rows
    FROM (
        SELECT l_orderkey, l_linenumber, {_DAY} AS day,
               row_number() OVER (
                   PARTITION BY l_orderkey, l_linenumber ORDER BY {_DAY}
               ) AS rno
        FROM lineitem
    )
    WHERE rno > 1
    GROUP BY l_orderkey, l_linenumber, day
"""
_FIRST_LINES = f"""
    SELECT * EXCLUDE (rno) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}
        ) AS rno
        FROM lineitem
    )
    WHERE rno = 1
"""


_CSV_TEXT = """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
           CAST(o_custkey AS VARCHAR) AS o_custkey,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
           CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) AS o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
           o_orderstatus || ';' || o_orderpriority AS o_orderpriority
    FROM orders
"""


def _drift(column, side, source_type, target_type, action, held, lost):
    def text(value):
        return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"

    return (
        f"SELECT '{column}' AS \"column\", '{side}' AS side, "
        f"{text(source_type)} AS source_type, {text(target_type)} AS target_type, "
        f"'{action}' AS action, CAST({held} AS BIGINT) AS held, "
        f"CAST({lost} AS BIGINT) AS lost FROM orders"
    )


def _lost(column, to):
    return (
        f"count(*) FILTER ({column} IS NOT NULL AND TRY_CAST({column} AS {to}) IS NULL)"
    )


def _coverage(source, target, keys, span=""):
    """Coverage written with the outer join that it replaces."""
    on = " AND ".join(f"s.{k} = t.{k}" for k in keys)
    names = ", ".join(keys)
    nulls = " OR ".join(f"s.{k} IS NULL" for k in keys)
    return f"""
        SELECT *, CASE WHEN matched_rows = source_rows THEN 'present'
                       WHEN matched_rows > source_rows THEN 'duplicated'
                       ELSE 'missing' END AS status
        FROM (
            SELECT CAST(sum(n) AS BIGINT) AS source_rows,
                   CAST(sum(n * coalesce(m, 0)) AS BIGINT) AS matched_rows,
                   CAST(coalesce(sum(n) FILTER (m IS NULL AND NOT ({nulls})), 0) AS BIGINT) AS missing_rows,
                   count(*) FILTER (m IS NULL AND NOT ({nulls})) AS missing_keys,
                   count(*) FILTER (m > 1) AS duplicated_keys,
                   CAST(coalesce(sum(n) FILTER ({nulls}), 0) AS BIGINT) AS null_keys{span}
            FROM (SELECT {names}, count(*) AS n FROM ({source}) GROUP BY {names}) s
            LEFT JOIN (SELECT {names}, count(*) AS m FROM ({target}) GROUP BY {names}) t
            ON {on}
        )
    """


_RETURNED = "SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 25"
_HALF_LANDED = """SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'
            UNION ALL SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 500 = 0"""

ORACLE_SQL: dict[str, str] = {
    "key_range_probe": """
        SELECT min(o_orderkey) AS initrange, max(o_orderkey) AS endrange FROM orders
    """,
    "range_scan": """
        SELECT * FROM orders
        WHERE o_orderkey >= 100 AND o_orderkey <= (SELECT max(event_id) FROM events)
    """,
    "csv_scan": _CSV_TEXT,
    "target_scan": "SELECT * FROM lineitem",
    "scan_with_file": "SELECT *, 'lineitem' AS filename FROM lineitem",
    "change_envelope": f"SELECT {_ENVELOPE}, * FROM orders",
    "decimal_widening": """
        SELECT * REPLACE (
            CAST(CAST(o_orderkey AS DECIMAL(18, 0)) AS BIGINT) AS o_orderkey,
            CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS o_totalprice
        )
        FROM orders
    """,
    "conform_schema": """
        SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY",
               o_orderstatus AS "O_ORDERSTATUS", o_totalprice AS "O_TOTALPRICE",
               o_orderdate AS "O_ORDERDATE", o_orderpriority AS "O_ORDERPRIORITY",
               'batch' AS "ORIGIN", CAST(NULL AS VARCHAR) AS dat_kafka
        FROM orders
    """,
    "schema_drift": " UNION ALL ".join(
        [
            _drift("O_ORDERKEY", "both", "bigint", "int", "cast",
                   "count(o_orderkey)", _lost("o_orderkey", "INTEGER")),
            _drift("o_custkey", "both", "bigint", "bigint", "keep", "count(o_custkey)", 0),
            _drift("o_orderstatus", "both", "string", "string", "keep",
                   "count(o_orderstatus)", 0),
            _drift("o_totalprice", "both", "double", "decimal(7,2)", "cast",
                   "count(o_totalprice)", _lost("o_totalprice", "DECIMAL(7, 2)")),
            _drift("o_orderdate", "both", "timestamp_ntz", "date", "cast",
                   "count(o_orderdate)", _lost("o_orderdate", "DATE")),
            _drift("o_orderpriority", "source", "string", None, "extra",
                   "count(o_orderpriority)", "count(o_orderpriority)"),
            _drift("o_comment", "target", None, "string", "missing", "0 * count(*)", 0),
            _drift("dat_kafka", "target", None, "string", "fill", "0 * count(*)", 0),
        ]
    ),
    "target_order_projection": """
        SELECT l_shipdate AS "L_SHIPDATE", l_linenumber AS "L_LINENUMBER",
               l_orderkey AS "L_ORDERKEY", l_quantity AS "L_QUANTITY"
        FROM lineitem
    """,
    "partition_stamp": f"SELECT *, {_RUN_DAY} AS day FROM orders",
    "business_day_partition": f"SELECT *, {_BUSINESS_DAY} AS day FROM events",
    "coverage_status": _coverage(
        "SELECT * FROM orders",
        "SELECT l_orderkey AS o_orderkey FROM lineitem",
        ["o_orderkey"],
        """,
                   min(s.o_orderkey) FILTER (m IS NULL) AS min_missing,
                   max(s.o_orderkey) FILTER (m IS NULL) AS max_missing""",
    ),
    "composite_coverage": _coverage(
        f"SELECT *, {_DAY} AS day FROM lineitem",
        f"SELECT *, {_DAY} AS day FROM lineitem WHERE l_linestatus = 'F'",
        ["l_orderkey", "l_linenumber", "day"],
    ),
    "coverage_null_keys": _coverage(
        f"SELECT {_SOME_ORDER_KEYS} AS o_orderkey FROM orders",
        f"SELECT {_SOME_LINE_KEYS} AS o_orderkey FROM lineitem",
        ["o_orderkey"],
        """,
                   min(s.o_orderkey) FILTER (m IS NULL) AS min_missing,
                   max(s.o_orderkey) FILTER (m IS NULL) AS max_missing""",
    ),
    "missing_keys": f"""
        SELECT o_orderkey, count(*) AS source_rows FROM orders WHERE {_NO_LINES}
        GROUP BY o_orderkey ORDER BY o_orderkey
    """,
    "missing_text_keys": f"""
        SELECT p_partkey AS l_partkey, count(*) AS source_rows FROM part
        WHERE p_partkey NOT IN ({_RETURNED}) GROUP BY p_partkey
    """,
    "coverage_text_keys": _coverage("SELECT p_partkey AS l_partkey FROM part", _RETURNED, ["l_partkey"]),
    "coverage_dense": _coverage("SELECT * FROM orders", _HALF_LANDED, ["o_orderkey"], """,
                   min(s.o_orderkey) FILTER (m IS NULL) AS min_missing,
                   max(s.o_orderkey) FILTER (m IS NULL) AS max_missing"""),
    "missing_keys_dense": f"""
        SELECT o_orderkey, count(*) AS source_rows FROM orders
        WHERE o_orderkey NOT IN ({_HALF_LANDED}) GROUP BY o_orderkey
    """,
    "missing_keys_preview": f"""
        SELECT o_orderkey, count(*) AS source_rows FROM orders WHERE {_NO_LINES}
        GROUP BY o_orderkey ORDER BY o_orderkey LIMIT 20
    """,
    "missing_range": f"SELECT lo AS min_missing, hi AS max_missing FROM ({_MISSING_SPAN})",
    "missing_rows": f"SELECT * FROM orders WHERE {_NO_LINES}",
    "unlabelled_documents": """
        SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """,
    "rows_in_missing_range": f"""
        SELECT o.* FROM orders o, ({_MISSING_SPAN}) m
        WHERE o_orderkey BETWEEN m.lo AND m.hi
    """,
    "matched_rows": f"""
        SELECT o.*, c.n AS target_rows FROM orders o JOIN ({_LINE_COPIES}) c ON o_orderkey = k
    """,
    "matched_copies": "SELECT o.* FROM orders o JOIN lineitem ON o_orderkey = l_orderkey",
    "present_key_days": f"""
        SELECT o_orderkey, {_DAY} AS day, count(DISTINCT o.rowid_) AS source_rows,
               count(*) AS target_rows
        FROM lineitem JOIN (SELECT *, row_number() OVER () AS rowid_ FROM orders) o
        ON o_orderkey = l_orderkey
        GROUP BY o_orderkey, day
    """,
    "target_duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    """,
    "source_keys_duplicated": f"""
        SELECT o_orderkey, count(*) AS source_rows, max(n) AS target_rows
        FROM orders JOIN ({_LINE_COPIES}) ON o_orderkey = k
        WHERE n > 1
        GROUP BY o_orderkey ORDER BY o_orderkey
    """,
    "duplicate_occurrences": _EXTRA_BY_DAY,
    "duplicate_row_numbers": f"""
        SELECT * FROM (
            SELECT *, {_DAY} AS day, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}
            ) AS rno
            FROM lineitem
        )
        WHERE rno > 1
    """,
    "duplicate_files": f"""
        SELECT o_orderkey, day, filename, count(*) AS extra_rows
        FROM (
            SELECT l_orderkey, {_DAY} AS day, 'month=' || {_SHIP_MONTH} AS filename,
                   row_number() OVER (PARTITION BY l_orderkey ORDER BY {_DAY}) AS rno
            FROM lineitem
        )
        JOIN orders ON o_orderkey = l_orderkey
        WHERE rno > 1
        GROUP BY o_orderkey, day, filename
        ORDER BY o_orderkey
    """,
    "duplicate_line_files": f"""
        SELECT l_orderkey, l_linenumber, day, 'month=' || left(day, 7) || '-01' AS filename, extra_rows
        FROM ({_EXTRA_BY_DAY})
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
        ORDER BY l_orderkey, l_linenumber
    """,
    "dedup_target": _FIRST_LINES,
    "dedup_partition_rewrite": f"SELECT *, {_SHIP_MONTH} AS day FROM ({_FIRST_LINES})",
    "append_static_partition": f"""
        {_LANDED} UNION ALL SELECT *, {_RUN_DAY} AS day FROM orders WHERE {_NO_LINES}
    """,
    "append_dynamic_partition": f"SELECT *, {_BUSINESS_DAY} AS day FROM events",
    "partition_inventory": f"""
        SELECT DISTINCT 'day=' || {_BUSINESS_DAY} AS "partition" FROM events
    """,
    "partition_states": f"""
        SELECT DISTINCT 'day=' || {_BUSINESS_DAY} AS "partition",
               CASE WHEN {_BUSINESS_DAY} = '2024-01-05' THEN 'gone'
                    WHEN {_BUSINESS_DAY} < '2024-01-20' THEN 'registered' ELSE 'new' END AS state
        FROM events
    """,
    "newest_landed": """
        SELECT l_returnflag, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_returnflag
    """,
    "append_resumed": f"{_LANDED} UNION ALL SELECT *, {_RUN_DAY} AS day FROM orders",
    "null_partition_rows": f"""
        SELECT *, CAST(NULL AS VARCHAR) AS day FROM orders WHERE {_NO_LINES}
    """,
    "history_load": f"""
        SELECT {_ENVELOPE}, * REPLACE (
            CAST(CAST(o_orderkey AS DECIMAL(18, 0)) AS BIGINT) AS o_orderkey,
            CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS o_totalprice
        )
        FROM orders
    """,
    "repair_exact": f"""
        {_LANDED} UNION ALL SELECT *, {_RUN_DAY} AS day FROM orders WHERE {_NO_LINES}
    """,
    "repair_range": f"""
        {_LANDED}
        UNION ALL
        SELECT o.*, {_RUN_DAY} AS day FROM orders o, ({_MISSING_SPAN}) m
        WHERE o_orderkey BETWEEN m.lo AND m.hi
    """,
    "repair_null_keys": f"""
        {_LANDED} UNION ALL
        SELECT *, {_RUN_DAY} AS day FROM orders WHERE {_NO_LINES} AND o_orderkey % 10 <> 7
    """,
    "repair_text_key": f"""
        {_TEXT_ORDERS}, CASE WHEN o_orderkey % 3 = 0 THEN {_ORDER_MONTH} ELSE {_RUN_DAY} END AS day FROM orders
    """,
    "repair_text_key_range": f"""
        WITH text AS ({_TEXT_ORDERS}, {_ORDER_MONTH} AS day, o_orderkey % 3 = 0 AS landed FROM orders)
        SELECT * EXCLUDE (landed) FROM text WHERE landed
        UNION ALL
        SELECT * EXCLUDE (landed) REPLACE ({_RUN_DAY} AS day) FROM text
        WHERE o_orderkey BETWEEN (SELECT min(o_orderkey) FROM text WHERE NOT landed)
              AND (SELECT max(o_orderkey) FROM text WHERE NOT landed)
    """,
    "repair_unsynced": f"""
        SELECT *, CASE WHEN o_orderdate < '1995-01-01' OR o_orderkey % 5 <> 0
                       THEN {_ORDER_MONTH} ELSE {_RUN_DAY} END AS day
        FROM orders
    """,
    "repair_full": f"{_LANDED} UNION ALL SELECT *, {_RUN_DAY} AS day FROM orders",
    "repair_from_csv": f"""
        {_LANDED}
        UNION ALL
        SELECT * REPLACE (
            CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
            o_orderstatus || ';' || o_orderpriority AS o_orderpriority
        ), {_RUN_DAY} AS day
        FROM orders WHERE {_NO_LINES}
    """,
    "repair_with_rejects": f"""
        SELECT * REPLACE (CAST(left(o_orderpriority, 1) AS INTEGER) AS o_orderpriority), {_ORDER_MONTH} AS day
        FROM orders WHERE o_orderkey % 3 = 0
        UNION ALL
        SELECT * REPLACE (
            CASE WHEN o_orderstatus = 'F' THEN CAST(left(o_orderpriority, 1) AS INTEGER) END AS o_orderpriority
        ), {_RUN_DAY} AS day
        FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 0
    """,
    "repair_rejects": """
        WITH source AS (
            SELECT o_orderkey % 7 = 0 AS keyless, o_orderkey % 3 = 0 AS landed, o_orderstatus, o_orderpriority,
                   CASE WHEN o_orderkey % 7 = 0 THEN 'no. ' ELSE '' END || o_orderkey AS o_orderkey
            FROM orders
        )
        SELECT 'o_orderkey' AS "column", o_orderkey AS value, 'string' AS source_type, 'bigint' AS target_type,
               o_orderkey, o_orderstatus
        FROM source WHERE keyless
        UNION ALL
        SELECT 'o_orderpriority', o_orderpriority, 'string', 'int', o_orderkey, o_orderstatus
        FROM source WHERE o_orderstatus <> 'F' AND (keyless OR NOT landed)
    """,
    "history_rejects": """
        SELECT o_orderkey, CASE WHEN o_orderkey < 10 THEN o_orderkey * 1000000000000000000 END AS wide,
               CASE WHEN o_orderkey >= 10 THEN o_orderkey || '000000000000000000' END AS value,
               CASE WHEN o_orderkey >= 10 THEN 'bigint' END AS target_type
        FROM orders
    """,
    "history_from_csv": _CSV_TEXT,
}
