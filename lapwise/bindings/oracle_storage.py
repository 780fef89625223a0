"""Reference SQL for the queries that go through files."""

from __future__ import annotations

from lapwise.bindings.oracle_star import STAR

_LONGEST_STOP = """
longest AS (
    SELECT race_id, driver_id, stop_number, max(duration_ms) AS duration_ms
    FROM typed_stop GROUP BY ALL
)
"""

def _duration(ms: str, minutes: bool = True) -> str:
    """Milliseconds as ``m:ss.SSS``, or ``s.SSS`` without minutes."""
    fraction = f"lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0')"
    if not minutes:
        return f"({ms} // 1000) || '.' || {fraction}"
    return f"({ms} // 60000) || ':' || lpad(CAST({ms} % 60000 // 1000 AS VARCHAR), 2, '0') || '.' || {fraction}"


# Each landed table's columns as SQL over the star.
_LANDED = {
    ("circuits", "dim_circuit"): {
        "circuitId": "circuit_id", "circuitRef": "circuit_ref", "name": "circuit_name",
        "location": "location", "country": "country", "lat": "CAST(latitude AS DECIMAL(18,4))",
        "lng": "CAST(longitude AS DECIMAL(18,4))", "alt": "altitude_m",
    },
    ("constructors", "dim_constructor"): {
        "constructorId": "constructor_id", "constructorRef": "constructor_ref",
        "name": "constructor_name", "nationality": "nationality",
    },
    ("drivers", "dim_driver"): {
        "driverId": "driver_id", "driverRef": "driver_ref", "number": "permanent_number",
        "code": "driver_code", "forename": "forename || ', \"' || surname || '\"'",
        "surname": "'#' || surname", "dob": "date_of_birth", "nationality": "nationality",
    },
    ("status", "dim_status"): {"statusId": "status_id", "status": "status_description"},
    ("races", "dim_race"): {
        "raceId": "race_id", "year": "season_year", "round": "round_number",
        "circuitId": "circuit_id", "name": "race_name", "date": "race_date",
    },
    ("results", "fct_result"): {
        "resultId": "result_id", "raceId": "race_id", "driverId": "driver_id",
        "constructorId": "constructor_id", "number": "driver_id % 100", "grid": "grid_position",
        "position": "finish_position",
        "positionText": "coalesce(CAST(finish_position AS VARCHAR), 'R')",
        "positionOrder": "position_order", "points": "CAST(points AS DECIMAL(18,4))",
        "laps": "laps_completed", "time": _duration("race_duration_ms"),
        "milliseconds": "race_duration_ms", "fastestLap": "laps_completed + 1",
        "rank": "position_order", "fastestLapTime": _duration("fastest_lap_ms"),
        "fastestLapSpeed": "CAST(fastest_lap_speed_kph AS INTEGER)", "statusId": "status_id",
    },
    ("pit_stops", "typed_stop JOIN longest USING (race_id, driver_id, stop_number)"): {
        "raceId": "race_id", "driverId": "driver_id", "stop": "stop_number", "lap": "lap_number",
        "duration": _duration("longest.duration_ms", minutes=False),
    },
}
_CELLS = " UNION ALL ".join(
    f"SELECT '{name}' AS tbl, '{column}' AS column_name, CAST({value} AS VARCHAR) AS value FROM {source}"
    for (name, source), columns in _LANDED.items()
    for column, value in columns.items()
)

_MESSAGE = r"""
message AS (
    SELECT role, concat(conv_id, ',', turn, ',', role, ',',
                        CASE WHEN role = 'user' THEN '"' ELSE '' END,
                        regexp_replace(text, '[\s",]+', ' ', 'g')) AS value
    FROM conversations
)
"""

QUERIES = {
    "upsert_snapshot": """
        SELECT c_custkey AS account_id, c_name AS name,
               CASE WHEN c_acctbal < 0 THEN 'ARREARS' ELSE c_mktsegment END AS segment,
               CASE WHEN c_acctbal < 0 THEN 'second.csv' ELSE 'first.csv' END AS dw_source_file,
               TIMESTAMP '2024-01-01' AS dw_inserted_at,
               CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-01-02'
                    ELSE TIMESTAMP '2024-01-01' END AS dw_updated_at
        FROM customer
        UNION ALL
        SELECT s_suppkey + 1000000000000, s_name, 'SUPPLIER', 'second.csv',
               TIMESTAMP '2024-01-02', TIMESTAMP '2024-01-02'
        FROM supplier""",
    "upsert_report": """
        WITH size AS (
            SELECT (SELECT count(*) FROM customer) AS customers,
                   (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS overdrawn,
                   (SELECT count(*) FROM supplier) AS suppliers
        )
        SELECT 1 AS run, customers AS inserted, CAST(0 AS BIGINT) AS updated,
               CAST(0 AS BIGINT) AS unchanged FROM size
        UNION ALL SELECT 2, suppliers, overdrawn, customers - overdrawn FROM size
        UNION ALL SELECT 3, 0, 0, customers + suppliers FROM size""",
    "csv_roundtrip": f"""
        WITH {STAR}
        SELECT CAST(driver_id AS VARCHAR) AS driverId, driver_ref AS driverRef,
               CAST(permanent_number AS VARCHAR) AS number, driver_code AS code,
               forename || ', "' || surname || '"' AS forename, '#' || surname AS surname,
               CAST(date_of_birth AS VARCHAR) AS dob, nationality,
               CAST(NULL AS VARCHAR) AS url
        FROM dim_driver""",
    "archive_landed": f"""
        WITH {STAR}, {_LONGEST_STOP},
        size AS (
            SELECT 'circuits' AS tbl, count(*) AS row_count FROM dim_circuit
            UNION ALL SELECT 'constructors', count(*) FROM dim_constructor
            UNION ALL SELECT 'drivers', count(*) FROM dim_driver
            UNION ALL SELECT 'status', count(*) FROM dim_status
            UNION ALL SELECT 'races', count(*) FROM dim_race
            UNION ALL SELECT 'results', count(*) FROM fct_result
            UNION ALL SELECT 'pit_stops', count(*) FROM typed_stop
        )
        SELECT tbl, row_count, row_count AS row_parsed, CAST(0 AS BIGINT) AS error_count,
               TRUE AS numbered, CAST(0 AS BIGINT) AS unmatched_files
        FROM size""",
    "archive_standings": f"""
        WITH {STAR}
        SELECT season_year, championship_position, driver_id, constructor_name,
               forename || ', "' || surname || '" #' || surname AS driver_name,
               CAST(cumulative_points AS DOUBLE) AS cumulative_points
        FROM final_rows JOIN (SELECT driver_id, forename, surname FROM dim_driver) USING (driver_id)
        QUALIFY row_number() OVER (PARTITION BY season_year
                                   ORDER BY championship_position, driver_id) <= 20""",
    "star_refresh": f"""
        WITH {STAR}, {_LONGEST_STOP},
        corrected AS (
            SELECT race_id, driver_id, stop_number,
                   CASE stop_number WHEN 1 THEN 500 WHEN 2 THEN 400000 WHEN 3 THEN 61500
                        ELSE duration_ms END AS duration_ms
            FROM longest
        )
        SELECT *, CAST(duration_ms AS DOUBLE) / 1000 AS duration_seconds
        FROM corrected WHERE duration_ms BETWEEN 1000 AND 300000""",
    "incremental_ingest": f"""
        WITH {STAR}
        SELECT CAST(race_id // 100 AS INTEGER) AS season, count(*) AS landed,
               count(*) AS rows, CAST(sum(points) AS DOUBLE) AS points,
               CASE WHEN race_id // 100 <= 1997 THEN TIMESTAMP '2024-01-01'
                    ELSE TIMESTAMP '2024-01-02' END AS arrived
        FROM fct_result GROUP BY race_id // 100""",
    "season_partition": """
        WITH line AS (
            SELECT CAST(year(o_orderdate) AS INTEGER) AS season,
                   CAST(l_quantity AS INTEGER) AS quantity
            FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P')
              ON o_orderkey = l_orderkey
        )
        SELECT season, count(*) AS rows, CAST(sum(quantity) AS BIGINT) AS quantity
        FROM line WHERE season IS NULL OR season BETWEEN 1996 AND 2000 GROUP BY season""",
    "reject_capture": f"""
        WITH {_MESSAGE}
        SELECT 'conversations' AS target_table,
               'unclosed or misplaced quote' AS error_message,
               CAST(position('"' IN value) AS BIGINT) AS character_pos,
               value AS rejected_record, TIMESTAMP '2024-01-01' AS recorded_at
        FROM message WHERE role = 'user'""",
    "reject_counts": f"""
        WITH {_MESSAGE}
        SELECT 'conversations' AS target_table, count(*) FILTER (role = 'user') AS reject_count,
               count(*) FILTER (role <> 'user') AS landed
        FROM message""",
    "audit_record": """
        WITH size AS (
            SELECT count(DISTINCT (lang, source)) AS files, count(*) AS row_count FROM documents
        )
        SELECT 1 AS call, files AS inserted, row_count FROM size
        UNION ALL SELECT 2, 0, row_count FROM size""",
    "metric_history": f"""
        WITH {STAR}, {_LONGEST_STOP},
        metric AS (
            SELECT 'pit_stops' AS table_name, 'DMF_IMPLAUSIBLE_PIT_DURATION' AS metric_name,
                   'duration_ms' AS argument_names,
                   count(*) FILTER (duration_ms NOT BETWEEN 1000 AND 300000) AS metric_value
            FROM longest
            UNION ALL SELECT 'pit_stops', 'DUPLICATE_COUNT', 'pit_stop_key', 0
            UNION ALL SELECT 'drivers', 'DUPLICATE_COUNT', 'driver_id', 0
            UNION ALL SELECT 'drivers', 'NULL_COUNT', 'full_name',
                             count(*) FILTER (full_name IS NULL) FROM dim_driver
            UNION ALL SELECT 'races', 'DUPLICATE_COUNT', 'race_id', 0
            UNION ALL SELECT 'races', 'NULL_COUNT', 'season_year',
                             count(*) FILTER (season_year IS NULL) FROM dim_race
            UNION ALL SELECT 'results', 'DUPLICATE_COUNT', 'result_id', 0
            UNION ALL SELECT 'results', 'ROW_COUNT', '', count(*) FROM fct_result
            UNION ALL SELECT 'results', 'NULL_COUNT', 'race_id',
                             count(*) FILTER (race_id IS NULL) FROM fct_result
            UNION ALL SELECT 'results', 'NULL_COUNT', 'driver_id',
                             count(*) FILTER (driver_id IS NULL) FROM fct_result
            UNION ALL SELECT 'results', 'NULL_COUNT', 'constructor_id',
                             count(*) FILTER (constructor_id IS NULL) FROM fct_result
            UNION ALL SELECT 'results', 'DMF_GRID_POSITION_OUT_OF_RANGE', 'grid_position',
                             count(*) FILTER (grid_position NOT BETWEEN 0 AND 40) FROM fct_result
            UNION ALL SELECT 'results', 'DMF_POINTS_OUT_OF_RANGE', 'points',
                             count(*) FILTER (points NOT BETWEEN 0 AND 50) FROM fct_result
        )
        SELECT *,
               CASE WHEN metric_name = 'ROW_COUNT' AND metric_value = 0 THEN 'BREACH'
                    WHEN metric_name <> 'ROW_COUNT' AND metric_value > 0 THEN 'BREACH'
                    ELSE 'OK' END AS status,
               TIMESTAMP '2024-01-01' AS measurement_time
        FROM metric""",
    "shared_ledger": f"""
        WITH {STAR},
        size AS (
            SELECT count(*) FILTER (race_id // 100 <= 1997) AS half, count(*) AS whole FROM fct_result
        )
        SELECT 1 AS step, 'stream' AS way, half AS landed FROM size
        UNION ALL SELECT 2, 'batch', half FROM size
        UNION ALL SELECT 3, 'batch', whole FROM size
        UNION ALL SELECT 4, 'stream', whole FROM size""",
    "newest_stops": f"""
        WITH {STAR}
        SELECT race_id, driver_id, stop_number, max(duration_ms) AS duration_ms, count(*) AS staged
        FROM typed_stop GROUP BY ALL""",
    "multiline_records": """
        SELECT doc_id, lang, md5(text) AS checksum,
               CAST(len(string_split(text, chr(10))) AS BIGINT) AS lines
        FROM documents""",
    "landed_content": f"""
        WITH {STAR}, {_LONGEST_STOP},
        cell AS (
            {_CELLS}
        )
        SELECT tbl, column_name, count(value) AS filled, count(DISTINCT value) AS different,
               CAST(sum(CAST('0x' || substr(md5(value), 1, 8) AS BIGINT)) AS VARCHAR) AS checksum
        FROM cell GROUP BY tbl, column_name HAVING count(value) > 0""",
    "prepared_files": f"""
        WITH {STAR}
        SELECT CAST(race_id // 100 AS INTEGER) AS season, count(*) AS rows,
               count(grid_position) AS padded,
               count(*) FILTER (finish_position IS NULL) AS unplaced,
               CAST(sum(points) AS DOUBLE) AS points
        FROM fct_result WHERE race_id // 100 BETWEEN 1996 AND 2000 GROUP BY race_id // 100""",
}
