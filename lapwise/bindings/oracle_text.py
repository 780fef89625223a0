"""Reference SQL for casts, hashes, typed tables, quality, audit and masking."""

from __future__ import annotations

from lapwise.bindings.oracle_star import STAR, _OUTCOME_ROWS


def _hash(*columns: str) -> str:
    """SHA-256 over columns as text, NULL written as ~, joined by ||."""
    cells = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return f"sha256(concat_ws('||', {cells}))"


def _newest(source: str, key: str, order: str) -> str:
    return f"""SELECT * FROM ({source}) QUALIFY row_number() OVER (
        PARTITION BY {key} ORDER BY {order}) = 1"""


_STATUS_ID = """((strpos('FOP', o_orderstatus) - 1) * 5
    + CAST(left(o_orderpriority, 1) AS INTEGER))"""

_MS = "CAST(round(value * 1000) AS BIGINT)"
_LINE_MS = "CAST(round(l_extendedprice) AS BIGINT)"
_STOP_PARTS = """strftime(ts, '%Y%m%d') AS race, CAST(user_id AS VARCHAR) AS driver,
    CAST(hour(ts) AS VARCHAR) AS stop"""

_METRICS = f"""
lines AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS shipped FROM lineitem),
measured AS (
    SELECT 'lineitem' AS table_name, 'NULL_COUNT' AS metric_name, 'shipped' AS argument_names,
           count(*) FILTER (shipped IS NULL) AS metric_value FROM lines
    UNION ALL SELECT 'lineitem', 'ROW_COUNT', '', count(*) FROM lines
    UNION ALL SELECT 'lineitem', 'DMF_QUANTITY_OUT_OF_RANGE', 'l_quantity',
           count(*) FILTER (l_quantity < 2 OR l_quantity > 49) FROM lines
    UNION ALL SELECT 'lineitem', 'DUPLICATE_COUNT', 'l_orderkey,l_linenumber',
           count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lines
    UNION ALL SELECT 'orders', 'ROW_COUNT', '', count(*) FROM orders
    UNION ALL SELECT 'orders', 'FRESHNESS', 'o_orderdate',
           CAST(epoch(TIMESTAMP '{{fresh}}') - epoch(max(o_orderdate)) AS BIGINT) FROM orders
    UNION ALL SELECT 'orders', 'DUPLICATE_COUNT', 'o_orderkey',
           count(*) - count(DISTINCT o_orderkey) FROM orders
    UNION ALL SELECT 'orders', 'DUPLICATE_COUNT', 'o_custkey',
           count(*) - count(DISTINCT o_custkey) FROM orders
    UNION ALL SELECT 'results', 'NULL_COUNT', 'finish_position',
           count(*) FILTER (finish_position IS NULL) FROM fct_result
    UNION ALL SELECT 'results', 'DMF_GRID_POSITION_OUT_OF_RANGE', 'grid_position',
           count(*) FILTER (grid_position < 0 OR grid_position > 40) FROM fct_result
    UNION ALL SELECT 'pit_stops', 'DMF_IMPLAUSIBLE_PIT_DURATION', 'duration_ms',
           count(*) FILTER (duration_ms < 1000 OR duration_ms > 300000) FROM typed_stop
)
"""

_LOADS = """
document_load AS (
    SELECT d.doc_id, lang AS target_table, source AS file_name,
           TIMESTAMP '2024-01-01' + to_hours(CAST(substr(source, 4) AS INTEGER))
               AS last_load_time,
           coalesce(l.toxic, 0) AS toxic, 'quality ' || l.quality AS error_message
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
),
history AS (
    SELECT target_table, file_name, last_load_time,
           count(*) FILTER (toxic = 0) AS row_count, count(*) AS row_parsed,
           count(*) FILTER (toxic = 1) AS error_count,
           min_by(error_message, doc_id) FILTER (toxic = 1) AS first_error_message,
           CASE WHEN count(*) FILTER (toxic = 1) = 0 THEN 'LOADED'
                WHEN count(*) FILTER (toxic = 0) = 0 THEN 'LOAD_FAILED'
                ELSE 'PARTIALLY_LOADED' END AS load_status
    FROM document_load GROUP BY ALL
)
"""

_PROFILE = """
profile AS (
    SELECT driver_id, driver_ref, driver_code, full_name, nationality, date_of_birth,
           CAST(2002 - year(date_of_birth) AS INTEGER) AS age_years
    FROM dim_driver
)
"""

QUERIES = {
    "duration_parse": f"""
        SELECT event_id,
               CASE WHEN event_type IN ('purchase', 'view')
                    THEN printf('%d:%06.3f', {_MS} // 60000, ({_MS} % 60000) / 1000.0::DOUBLE)
                         || CASE WHEN event_type = 'view' THEN ':ignored' ELSE '' END
                    WHEN event_type = 'click' THEN printf('%.3f', {_MS} / 1000.0::DOUBLE)
                    WHEN event_type = 'error' THEN 'n/a ' || event_type END AS duration,
               CASE WHEN event_type IN ('purchase', 'view', 'click') THEN {_MS} END
                   AS duration_ms
        FROM events""",
    "safe_casts": """
        WITH cell AS (
            SELECT *, split_part(split_part(props, ': ', 2), '}', 1) AS tag_text,
                   CASE WHEN event_type = 'error' THEN event_type
                        ELSE CAST(value AS VARCHAR) END AS text
            FROM events
        )
        SELECT event_id,
               CAST(TRY_CAST(tag_text AS DECIMAL(38,0)) AS BIGINT) AS tag,
               CAST(TRY_CAST(text AS DECIMAL(38,0)) AS BIGINT) AS whole,
               TRY_CAST(text AS DOUBLE) AS "real",
               CAST(TRY_CAST(text || '5' AS DECIMAL(8,2)) AS DOUBLE) AS rounded,
               CASE WHEN event_type <> 'view' THEN CAST(ts AS DATE) END AS day,
               CASE WHEN event_type <> 'click' THEN strftime(ts, '%H:%M:%S') END AS clock,
               coalesce(CAST(TRY_CAST(text AS DECIMAL(38,0)) AS BIGINT),
                        CAST(TRY_CAST(tag_text AS DECIMAL(38,0)) AS BIGINT), -1) AS first_known,
               nullif(event_type, 'signup') AS not_signup,
               CASE WHEN value > 100 THEN 1 ELSE 0 END AS is_large,
               position(':' IN props) AS colon_at
        FROM cell""",
    "date_parts": """
        SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month,
               left(dayname(o_orderdate), 3) AS day_name,
               date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-06-30') AS days,
               CAST(2002 - year(o_orderdate) AS INTEGER) AS years,
               make_date(year(o_orderdate), 1, 1) AS year_start
        FROM orders""",
    "change_hash": f"""
        SELECT c_custkey,
               {_hash("c_name", "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END",
                      "c_nationkey", "c_mktsegment")} AS row_hash
        FROM customer""",
    "conform_circuits": f"""
        WITH typed AS (
            SELECT s_suppkey AS circuit_id, lower(s_name) AS circuit_ref,
                   s_name AS circuit_name, CAST(NULL AS VARCHAR) AS location,
                   'country ' || s_nationkey AS country,
                   CASE WHEN s_acctbal >= 0 THEN CAST(s_nationkey AS DOUBLE) / 4 END AS latitude,
                   CAST(s_nationkey * -2 AS DOUBLE) AS longitude,
                   CAST(round(s_acctbal) AS INTEGER) AS altitude_m,
                   'circuits.csv' AS dw_source_file
            FROM supplier
        )
        SELECT *, {_hash("circuit_ref", "circuit_name", "location", "country", "latitude",
                         "longitude", "altitude_m")} AS row_hash FROM typed""",
    "conform_constructors": f"""
        WITH typed AS (
            SELECT CAST(n_nationkey AS BIGINT) AS constructor_id,
                   lower(n_name) AS constructor_ref, n_name AS constructor_name,
                   CAST(n_regionkey AS VARCHAR) AS nationality,
                   'constructors.csv' AS dw_source_file
            FROM nation
        )
        SELECT *, {_hash("constructor_ref", "constructor_name", "nationality")} AS row_hash
        FROM typed""",
    "conform_drivers": f"""
        WITH typed AS (
            SELECT c_custkey AS driver_id, lower(c_name) AS driver_ref,
                   c_nationkey AS permanent_number, left(c_mktsegment, 3) AS driver_code,
                   CASE WHEN c_acctbal >= 0 THEN split_part(c_name, '#', 1) END AS forename,
                   split_part(c_name, '#', 2) AS surname,
                   CASE WHEN c_nationkey <= 19 THEN make_date(1980, 2, c_nationkey + 10) END
                       AS date_of_birth,
                   c_mktsegment AS nationality,
                   CASE WHEN c_acctbal >= 0
                        THEN split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) END
                       AS full_name,
                   'drivers.csv' AS dw_source_file
            FROM customer
        )
        SELECT *, {_hash("driver_ref", "permanent_number", "driver_code", "forename", "surname",
                         "date_of_birth", "nationality")} AS row_hash FROM typed""",
    "conform_status": f"""
        WITH outcome(letter, digit, text) AS (VALUES {_OUTCOME_ROWS}),
        landed AS (
            SELECT CAST({_STATUS_ID} AS BIGINT) AS status_id, text AS status_description,
                   o_orderdate, o_orderkey
            FROM orders LEFT JOIN outcome
              ON letter = o_orderstatus AND digit = CAST(left(o_orderpriority, 1) AS INTEGER)
        ),
        typed AS (
            SELECT status_id, status_description,
                   (status_id = 1 OR status_description ILIKE '+%Lap%') AS is_classified_finish,
                   'orders-' || year(o_orderdate) AS dw_source_file
            FROM ({_newest("SELECT * FROM landed", "status_id",
                           "o_orderdate DESC, o_orderkey DESC")})
        )
        SELECT *, {_hash("status_description", "is_classified_finish")} AS row_hash
        FROM typed""",
    "conform_races": f"""
        WITH newest AS ({_newest(
            "SELECT *, year(o_orderdate) * 100 + month(o_orderdate) AS race FROM orders",
            "race", "o_orderdate DESC, o_orderkey DESC")}),
        typed AS (
            SELECT CAST(race AS BIGINT) AS race_id,
                   CAST(year(o_orderdate) AS INTEGER) AS season_year,
                   CAST(month(o_orderdate) AS INTEGER) AS round_number,
                   o_custkey AS circuit_id, o_orderpriority AS race_name,
                   CAST(o_orderdate AS DATE) AS race_date,
                   CASE WHEN o_orderkey % 30 < 24
                        THEN lpad(CAST(o_orderkey % 30 AS VARCHAR), 2, '0') || ':15:00' END
                       AS race_start_utc,
                   'orders-' || year(o_orderdate) AS dw_source_file
            FROM newest
        )
        SELECT *, {_hash("season_year", "round_number", "circuit_id", "race_name", "race_date",
                         "race_start_utc")} AS row_hash FROM typed""",
    "conform_results": f"""
        WITH newest AS ({_newest(
            '''SELECT *, l_orderkey * 10 + l_linenumber AS result,
               'lines-' || l_returnflag || '-' || l_suppkey AS file FROM lineitem''',
            "result", "l_shipdate DESC, l_partkey DESC, file DESC")}),
        typed AS (
            SELECT result AS result_id, l_orderkey AS race_id, l_suppkey AS driver_id,
                   l_partkey AS constructor_id,
                   CASE WHEN l_linestatus <> 'O' THEN CAST(l_linenumber AS BIGINT) END
                       AS status_id,
                   CAST(l_suppkey AS INTEGER) AS car_number,
                   CAST(l_quantity AS INTEGER) AS grid_position,
                   CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS finish_position,
                   l_linenumber AS position_order,
                   CAST(l_quantity / 2 AS DECIMAL(8,2)) AS points,
                   CAST(l_quantity AS INTEGER) AS laps_completed,
                   {_LINE_MS} AS race_duration_ms,
                   CAST(NULL AS INTEGER) AS fastest_lap_number,
                   CAST(NULL AS INTEGER) AS fastest_lap_rank,
                   {_LINE_MS} AS fastest_lap_ms,
                   CAST(l_quantity AS INTEGER) / 4.0::DOUBLE AS fastest_lap_speed_kph,
                   file AS dw_source_file
            FROM newest
        )
        SELECT * REPLACE (CAST(points AS DOUBLE) AS points),
               {_hash("race_id", "driver_id", "constructor_id", "status_id", "car_number",
                      "grid_position", "finish_position", "position_order", "points",
                      "laps_completed", "race_duration_ms", "fastest_lap_number",
                      "fastest_lap_rank", "fastest_lap_ms", "fastest_lap_speed_kph")} AS row_hash
        FROM typed""",
    "typed_dedup": f"""
        WITH newest AS ({_newest(
            '''SELECT *, l_orderkey * 10 + l_linenumber AS result,
               'lines-' || l_returnflag || '-' || l_suppkey AS file FROM lineitem''',
            "result", "l_shipdate DESC, l_partkey DESC, file DESC")})
        SELECT result AS result_id, file AS dw_source_file,
               {_hash("l_orderkey", "l_suppkey", "l_partkey",
                      "CASE WHEN l_linestatus <> 'O' THEN l_linenumber END",
                      "CAST(l_quantity AS INTEGER)",
                      "CASE WHEN l_returnflag <> 'R' THEN l_linenumber END", "l_linenumber",
                      "CAST(l_quantity / 2 AS DECIMAL(8,2))", "CAST(l_quantity AS INTEGER)",
                      _LINE_MS, _LINE_MS)} AS narrow_hash
        FROM newest""",
    "conform_pit_stops": f"""
        WITH landed AS (
            SELECT *, {_STOP_PARTS} FROM events WHERE event_type <> 'signup'
        ),
        newest AS ({_newest("SELECT * FROM landed", "race, driver, stop",
                            "ts DESC, event_id DESC")}),
        typed AS (
            SELECT CAST(race AS BIGINT) AS race_id, user_id AS driver_id,
                   CAST(hour(ts) AS INTEGER) AS stop_number,
                   CAST(minute(ts) AS INTEGER) AS lap_number,
                   strftime(ts, '%H:%M:%S') AS stop_time_local,
                   sha256(concat_ws('||', race, driver, stop)) AS pit_stop_key,
                   {_MS} AS duration_ms, 'events.csv' AS dw_source_file
            FROM newest
        )
        SELECT *, {_hash("lap_number", "stop_time_local", "duration_ms")} AS row_hash
        FROM typed""",
    "orphan_checks": """
        SELECT 'lineitem -> orders not pending' AS relationship, count(*) AS orphan_count
        FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P')
          ON l_orderkey = o_orderkey WHERE o_orderkey IS NULL
        UNION ALL SELECT 'lineitem -> suppliers in credit', count(*)
        FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0)
          ON l_suppkey = s_suppkey WHERE s_suppkey IS NULL
        UNION ALL SELECT 'orders -> customers in credit', count(*)
        FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0)
          ON o_custkey = c_custkey WHERE c_custkey IS NULL
        UNION ALL SELECT 'events -> customers in credit', count(*)
        FROM events LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0)
          ON user_id = c_custkey WHERE c_custkey IS NULL
        UNION ALL SELECT 'nation -> region', count(*)
        FROM nation LEFT JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey IS NULL""",
    "quality_metrics": f"""
        WITH {STAR}, {_METRICS.format(fresh="2002-01-01")}
        SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS measurement_time FROM measured""",
    "quality_latest": f"""
        WITH {STAR}, {_METRICS.format(fresh="2003-01-01")}
        SELECT *, TIMESTAMP '2024-01-02 00:00:00' AS measurement_time,
               CASE WHEN metric_name IN ('DUPLICATE_COUNT', 'NULL_COUNT') AND metric_value > 0
                        THEN 'BREACH'
                    WHEN metric_name LIKE 'DMF_%' AND metric_value > 0 THEN 'BREACH'
                    WHEN metric_name = 'ROW_COUNT' AND metric_value = 0 THEN 'BREACH'
                    ELSE 'OK' END AS status
        FROM measured""",
    "audit_append": f"""
        WITH {_LOADS}
        SELECT * FROM history h
        WHERE last_load_time >= TIMESTAMP '2024-01-01 06:00:00'
          AND NOT EXISTS (
              SELECT 1 FROM document_load a
              WHERE a.target_table = 'en' AND a.toxic = 0
                AND a.target_table = h.target_table AND a.file_name = h.file_name
                AND a.last_load_time = h.last_load_time)""",
    "audit_tail": f"""
        WITH {_LOADS}
        SELECT * FROM history ORDER BY last_load_time DESC, target_table, file_name LIMIT 50""",
    "load_reconcile": """
        WITH staged AS (SELECT DISTINCT 'doc-' || doc_id AS file_name FROM documents),
        loaded AS (
            SELECT 'doc-' || doc_id AS file_name FROM labels
            UNION SELECT 'item-' || item_id FROM benchmark
        )
        SELECT coalesce(s.file_name, l.file_name) AS file_name,
               CASE WHEN s.file_name IS NULL THEN 'loaded_only'
                    WHEN l.file_name IS NULL THEN 'staged_only' ELSE 'both' END AS state
        FROM staged s FULL OUTER JOIN loaded l ON s.file_name = l.file_name""",
    "masked_profile": f"""
        WITH {STAR}, {_PROFILE}
        SELECT *, 'engineer' AS seen_by FROM profile
        UNION ALL
        SELECT * REPLACE (make_date(year(date_of_birth), 1, 1) AS date_of_birth), 'analyst'
        FROM profile""",
    "masked_sample": f"""
        WITH {STAR}, {_PROFILE}
        SELECT driver_code, full_name, make_date(year(date_of_birth), 1, 1) AS date_of_birth
        FROM profile WHERE driver_code IS NOT NULL ORDER BY driver_id LIMIT 5""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS tbl, count(*) AS row_count FROM {n}"
        for n in (
            "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
            "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
        )
    ),
    "table_changes": " UNION ALL ".join(
        f"SELECT '{n}' AS tbl, count(*) AS row_count, max({c}) AS last_change FROM {n}"
        for n, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ),
}
