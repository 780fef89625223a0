"""Reference SQL for the star, its views, analyses and feeds over the sales tables."""

from __future__ import annotations

from lapwise.bindings.sales import OUTCOMES

_OUTCOME_ROWS = ", ".join(
    f"('{letter}', {digit}, '{text}')" for (letter, digit), text in OUTCOMES.items()
)

STAR = f"""
outcome(letter, digit, status_description) AS (VALUES {_OUTCOME_ROWS}),
typed_race AS (
    SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS race_id,
           CAST(year(o_orderdate) AS INTEGER) AS season_year,
           CAST(month(o_orderdate) AS INTEGER) AS round_number,
           CAST((year(o_orderdate) * 12 + month(o_orderdate)) % 5 AS BIGINT) AS circuit_id,
           'Round ' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS race_name,
           make_date(year(o_orderdate), month(o_orderdate), 1) AS race_date
    FROM orders
),
dim_race AS (
    SELECT *, CAST(month(race_date) AS INTEGER) AS race_month,
           left(dayname(race_date), 3) AS race_day_name
    FROM typed_race
),
typed_status AS (
    SELECT DISTINCT
           CAST((strpos('FOP', o_orderstatus) - 1) * 5
                + CAST(left(o_orderpriority, 1) AS INTEGER) AS BIGINT) AS status_id,
           t.status_description
    FROM orders LEFT JOIN outcome t
      ON t.letter = o_orderstatus AND t.digit = CAST(left(o_orderpriority, 1) AS INTEGER)
),
dim_status AS (
    SELECT status_id, status_description,
           (status_id = 1 OR status_description ILIKE '+%Lap%') AS is_classified_finish,
           CASE WHEN (status_id = 1 OR status_description ILIKE '+%Lap%') THEN 'Classified'
                WHEN status_description ILIKE '%Disqualified%' THEN 'Disqualified'
                WHEN status_description ILIKE '%Accident%'
                  OR status_description ILIKE '%Collision%'
                  OR status_description ILIKE '%Spun off%' THEN 'Incident'
                WHEN status_description ILIKE '%Withdrew%'
                  OR status_description ILIKE '%Did not%' THEN 'Did not start'
                ELSE 'Mechanical' END AS retirement_category
    FROM typed_status
),
dim_driver AS (
    SELECT c_custkey AS driver_id, lower(c_name) AS driver_ref,
           upper(left(c_mktsegment, 3)) AS driver_code, c_nationkey AS permanent_number,
           split_part(c_name, '#', 1) AS forename, split_part(c_name, '#', 2) AS surname,
           c_name AS full_name,
           DATE '1960-01-01' + CAST(floor(abs(c_acctbal)) AS INTEGER) AS date_of_birth,
           n_name AS nationality
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
),
dim_constructor AS (
    SELECT CAST(n_nationkey AS BIGINT) AS constructor_id, lower(n_name) AS constructor_ref,
           n_name AS constructor_name, r_name AS nationality
    FROM nation LEFT JOIN region ON r_regionkey = n_regionkey
),
dim_circuit AS (
    SELECT CAST(r_regionkey AS BIGINT) AS circuit_id, lower(r_name) AS circuit_ref,
           r_name AS circuit_name, r_name AS location, upper(r_name) AS country,
           CAST(r_regionkey AS DOUBLE) * 10.5::DOUBLE AS latitude,
           CAST(r_regionkey AS DOUBLE) * (-20.25)::DOUBLE AS longitude,
           CAST(r_regionkey * 100 AS INTEGER) AS altitude_m
    FROM region
),
placed AS (
    SELECT *, CASE WHEN o_orderstatus = 'F'
                   THEN CAST((o_orderkey + o_custkey) % 20 + 1 AS INTEGER) END AS finish,
           CAST(o_orderkey % 25 AS INTEGER) AS grid
    FROM orders JOIN customer ON c_custkey = o_custkey
),
fct_result AS (
    SELECT o_orderkey AS result_id,
           CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS race_id,
           o_custkey AS driver_id, CAST(c_nationkey AS BIGINT) AS constructor_id,
           CAST((strpos('FOP', o_orderstatus) - 1) * 5
                + CAST(left(o_orderpriority, 1) AS INTEGER) AS BIGINT) AS status_id,
           grid AS grid_position, finish AS finish_position,
           CAST((o_orderkey + o_custkey) % 20 + 1 AS INTEGER) AS position_order,
           CAST(o_totalprice AS DECIMAL(18,2)) AS points,
           CAST(o_orderkey % 70 AS INTEGER) AS laps_completed,
           CAST(round(o_totalprice) AS BIGINT) AS race_duration_ms,
           CAST(o_orderkey % 9000 + 70000 AS BIGINT) AS fastest_lap_ms,
           CAST(o_orderkey % 300 AS DOUBLE) AS fastest_lap_speed_kph,
           CASE WHEN grid = 0 THEN TRUE ELSE FALSE END AS is_pit_lane_start,
           CASE WHEN grid IS NULL OR grid = 0 OR finish IS NULL THEN NULL
                ELSE grid - finish END AS positions_gained,
           CASE WHEN finish = 1 THEN 1 ELSE 0 END AS is_win,
           CASE WHEN finish <= 3 THEN 1 ELSE 0 END AS is_podium
    FROM placed
),
typed_stop AS (
    SELECT sha256(concat_ws('||', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                            strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))) AS pit_stop_key,
           CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS race_id,
           o_custkey AS driver_id, l_linenumber AS stop_number,
           CAST(l_quantity AS INTEGER) AS lap_number,
           CAST(round(l_extendedprice) AS BIGINT) AS duration_ms
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
),
fct_pit_stop AS (
    SELECT *, CAST(duration_ms AS DOUBLE) / 1000 AS duration_seconds
    FROM typed_stop WHERE duration_ms BETWEEN 1000 AND 300000
),
v_result AS (
    SELECT f.result_id, r.season_year, r.round_number, r.race_name, r.race_date,
           c.circuit_name, c.country AS circuit_country, c.latitude, c.longitude,
           d.driver_id, d.full_name AS driver_name, d.driver_code,
           d.nationality AS driver_nationality, t.constructor_id, t.constructor_name,
           s.status_description, s.is_classified_finish, s.retirement_category,
           f.grid_position, f.finish_position, f.position_order, f.points, f.laps_completed,
           f.positions_gained, f.is_pit_lane_start, f.is_win, f.is_podium, f.fastest_lap_ms,
           f.fastest_lap_speed_kph
    FROM fct_result f
    JOIN dim_race r ON f.race_id = r.race_id
    JOIN dim_circuit c ON r.circuit_id = c.circuit_id
    JOIN dim_driver d ON f.driver_id = d.driver_id
    JOIN dim_constructor t ON f.constructor_id = t.constructor_id
    LEFT JOIN dim_status s ON f.status_id = s.status_id
),
per_round AS (
    SELECT season_year, round_number, race_name, race_date, driver_id, driver_name, driver_code,
           constructor_name, sum(points) AS round_points,
           min(finish_position) AS finish_position
    FROM v_result GROUP BY ALL
),
cumulative AS (
    SELECT *,
           sum(round_points) OVER (PARTITION BY season_year, driver_id ORDER BY round_number
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cumulative_points,
           lag(finish_position) OVER (PARTITION BY season_year, driver_id
               ORDER BY round_number) AS previous_round_finish
    FROM per_round
),
v_progression AS (
    SELECT *, rank() OVER (PARTITION BY season_year, round_number
                           ORDER BY cumulative_points DESC) AS championship_position
    FROM cumulative
),
stops AS (
    SELECT r.season_year, t.constructor_id, t.constructor_name,
           CAST(p.duration_ms AS DOUBLE) AS ms
    FROM fct_pit_stop p
    JOIN dim_race r ON p.race_id = r.race_id
    JOIN fct_result f ON p.race_id = f.race_id AND p.driver_id = f.driver_id
    JOIN dim_constructor t ON f.constructor_id = t.constructor_id
),
stop_stats AS (
    SELECT season_year, constructor_id, constructor_name, count(*) AS stop_count,
           quantile_cont(ms, 0.5) AS median_ms, quantile_cont(ms, 0.9) AS p90_ms,
           sum(ms) / count(*) AS mean_ms, min(ms) AS fastest_ms
    FROM stops GROUP BY ALL HAVING count(*) >= 10
),
v_pit AS (
    SELECT season_year, constructor_id, constructor_name, stop_count,
           round(median_ms) / 1000 AS median_stop_seconds,
           round(mean_ms) / 1000 AS mean_stop_seconds,
           round(fastest_ms) / 1000 AS fastest_stop_seconds,
           round(p90_ms) / 1000 AS p90_stop_seconds,
           rank() OVER (PARTITION BY season_year ORDER BY median_ms) AS season_rank,
           round(median_ms - avg(median_ms) OVER (PARTITION BY season_year)) / 1000
               AS seconds_vs_field_median
    FROM stop_stats
),
v_reliability AS (
    SELECT season_year, constructor_name, count(*) AS entries,
           CAST(sum(CASE WHEN is_classified_finish THEN 1 ELSE 0 END) AS BIGINT)
               AS classified_finishes,
           round(100.0::DOUBLE * sum(CASE WHEN is_classified_finish THEN 1 ELSE 0 END)
                 / nullif(count(*), 0), 1) AS finish_rate_pct,
           CAST(sum(CASE WHEN retirement_category = 'Mechanical' THEN 1 ELSE 0 END) AS BIGINT)
               AS mechanical_dnfs,
           CAST(sum(CASE WHEN retirement_category = 'Incident' THEN 1 ELSE 0 END) AS BIGINT)
               AS incident_dnfs,
           CAST(sum(points) AS DOUBLE) AS season_points
    FROM v_result GROUP BY season_year, constructor_name
),
v_season AS (
    SELECT season_year, count(DISTINCT race_name) AS rounds,
           count(DISTINCT driver_id) AS drivers,
           count(DISTINCT constructor_id) AS constructors,
           min(race_date) AS season_start, max(race_date) AS season_end
    FROM v_result GROUP BY season_year
),
final_rows AS (
    SELECT * FROM v_progression
    QUALIFY row_number() OVER (PARTITION BY season_year, driver_id
                               ORDER BY round_number DESC) = 1
),
name_finals AS (
    SELECT * FROM v_progression
    QUALIFY row_number() OVER (PARTITION BY season_year, driver_name
                               ORDER BY round_number DESC) = 1
)
"""

EVENT_RESULTS = """
event_results AS (
    SELECT event_id AS result_id, user_id AS driver_id, c_name AS driver_name,
           event_type AS race_name, ts AS race_date,
           CASE WHEN event_type <> 'error' THEN CAST(ceil(value) AS INTEGER) END
               AS finish_position,
           CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_win
    FROM events JOIN customer ON c_custkey = user_id
)
"""


def star_query(body: str) -> str:
    return f"WITH {STAR} {body}"


PROGRESSION = """SELECT season_year, round_number, race_name, race_date, driver_id, driver_name,
    driver_code, constructor_name, CAST(round_points AS DOUBLE) AS round_points,
    finish_position, CAST(cumulative_points AS DOUBLE) AS cumulative_points,
    championship_position, previous_round_finish FROM v_progression"""

RESULT_COLUMNS = """* REPLACE (CAST(points AS DOUBLE) AS points)"""

QUERIES = {
    "season_standings": star_query("""
        SELECT season_year, championship_position, driver_id, driver_name, constructor_name,
               CAST(cumulative_points AS DOUBLE) AS cumulative_points
        FROM final_rows
        QUALIFY row_number() OVER (PARTITION BY season_year
                                   ORDER BY championship_position, driver_id) <= 20"""),
    "headline_top10": star_query("""
        SELECT season_year, driver_name, CAST(cumulative_points AS DOUBLE) AS cumulative_points,
               championship_position
        FROM final_rows
        QUALIFY row_number() OVER (PARTITION BY season_year
                                   ORDER BY championship_position, driver_id) <= 10"""),
    "season_progression": star_query(PROGRESSION),
    "wide_result": star_query(f"SELECT {RESULT_COLUMNS} FROM v_result"),
    "season_index": star_query("SELECT * FROM v_season"),
    "season_shape": star_query("SELECT * FROM v_season WHERE season_year >= 1997"),
    "event_classification": star_query("""
        SELECT season_year, race_name, finish_position, driver_id, driver_name,
               constructor_name, grid_position, positions_gained,
               CAST(points AS DOUBLE) AS points, status_description FROM v_result"""),
    "leader_gap": star_query("""
        SELECT season_year, round_number, race_name, driver_id, driver_name,
               CAST(cumulative_points AS DOUBLE) AS cumulative_points,
               CAST(max(cumulative_points) OVER (PARTITION BY season_year, round_number)
                    - cumulative_points AS DOUBLE) AS points_behind_leader
        FROM v_progression
        QUALIFY dense_rank() OVER (PARTITION BY season_year, round_number
                                   ORDER BY cumulative_points DESC) <= 2"""),
    "rolling_form": f"""WITH {EVENT_RESULTS}
        SELECT driver_id, driver_name, race_date, result_id, race_name, finish_position,
               round(avg(finish_position) OVER w, 2) AS form,
               count(*) OVER w AS races_in_window
        FROM event_results WHERE finish_position IS NOT NULL
        WINDOW w AS (PARTITION BY driver_id ORDER BY race_date, result_id
                     ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "pairwise_head_to_head": """
        WITH entry AS (
            SELECT l_orderkey AS race_id, l_suppkey AS driver_id, n_regionkey AS constructor_id,
                   l_linenumber AS position_order, s_name AS full_name, r_name
            FROM lineitem
            JOIN supplier ON s_suppkey = l_suppkey
            JOIN nation ON n_nationkey = s_nationkey
            JOIN region ON r_regionkey = n_regionkey
            JOIN orders ON o_orderkey = l_orderkey
        )
        SELECT a.r_name AS constructor_name, a.full_name AS driver_a, b.full_name AS driver_b,
               count(*) AS races_together,
               CAST(sum(CASE WHEN a.position_order < b.position_order THEN 1 ELSE 0 END)
                    AS BIGINT) AS a_ahead,
               CAST(sum(CASE WHEN b.position_order < a.position_order THEN 1 ELSE 0 END)
                    AS BIGINT) AS b_ahead,
               round(100.0::DOUBLE
                     * sum(CASE WHEN a.position_order < b.position_order THEN 1 ELSE 0 END)
                     / nullif(count(*), 0), 1) AS a_win_pct
        FROM entry a JOIN entry b
          ON a.race_id = b.race_id AND a.constructor_id = b.constructor_id
         AND a.driver_id < b.driver_id
        GROUP BY a.r_name, a.full_name, b.full_name
        HAVING count(*) >= 5""",
    "stop_performance": star_query("SELECT * FROM v_pit"),
    "price_percentiles": """
        SELECT l_returnflag,
               round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.5), 4) AS median_price,
               round(quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.9), 4) AS p90_price
        FROM lineitem GROUP BY l_returnflag""",
    "spread_quartile": star_query("""
        SELECT season_year, constructor_name, stop_count, median_stop_seconds,
               p90_stop_seconds,
               round(p90_stop_seconds - median_stop_seconds, 3) AS consistency_spread,
               season_rank, seconds_vs_field_median,
               ntile(4) OVER (ORDER BY median_stop_seconds, season_year, constructor_id)
                   AS speed_quartile
        FROM v_pit"""),
    "points_pivot": star_query("""
        SELECT constructor_name,
               sum(CASE WHEN season_year = 1996 THEN season_points END) AS "1996",
               sum(CASE WHEN season_year = 1997 THEN season_points END) AS "1997",
               sum(CASE WHEN season_year = 1998 THEN season_points END) AS "1998",
               sum(CASE WHEN season_year = 1999 THEN season_points END) AS "1999",
               sum(CASE WHEN season_year = 2000 THEN season_points END) AS "2000"
        FROM v_reliability WHERE season_year BETWEEN 1996 AND 2000
        GROUP BY constructor_name"""),
    "reliability": star_query("SELECT * FROM v_reliability"),
    "rank_divergence": star_query("""
        SELECT season_year, constructor_name, entries, finish_rate_pct, mechanical_dnfs,
               incident_dnfs, season_points,
               rank() OVER (PARTITION BY season_year ORDER BY finish_rate_pct DESC)
                   AS reliability_rank,
               rank() OVER (PARTITION BY season_year ORDER BY season_points DESC)
                   AS points_rank,
               rank() OVER (PARTITION BY season_year ORDER BY finish_rate_pct DESC)
               - rank() OVER (PARTITION BY season_year ORDER BY season_points DESC)
                   AS rank_divergence
        FROM v_reliability"""),
    "droughts": f"""WITH {EVENT_RESULTS},
        counted AS (
            SELECT *, sum(is_win) OVER (PARTITION BY driver_id ORDER BY race_date, result_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wins_so_far
            FROM event_results
        ),
        island AS (
            SELECT driver_id, driver_name, wins_so_far, count(*) AS races_in_drought,
                   min(race_date) AS drought_start, max(race_date) AS drought_end
            FROM counted WHERE wins_so_far > 0 AND is_win = 0 GROUP BY ALL
        )
        SELECT driver_name, races_in_drought, drought_start, drought_end,
               date_diff('day', drought_start, drought_end) AS days_without_a_win
        FROM island WHERE races_in_drought >= 20
        ORDER BY races_in_drought DESC, drought_start, driver_id LIMIT 15""",
    "season_list": star_query("""
        SELECT season_year, rounds, drivers, constructors FROM v_season WHERE rounds > 0"""),
    "progression_feed": star_query("""
        SELECT season_year, round_number, race_name, driver_name, driver_code,
               constructor_name, CAST(round_points AS DOUBLE) AS round_points,
               CAST(cumulative_points AS DOUBLE) AS cumulative_points, championship_position
        FROM v_progression"""),
    "season_feed": star_query("""
        SELECT season_year, round_number, race_name, driver_name, driver_code,
               constructor_name, CAST(round_points AS DOUBLE) AS round_points,
               CAST(cumulative_points AS DOUBLE) AS cumulative_points, championship_position
        FROM v_progression WHERE season_year = 1997"""),
    "stop_feed": star_query("""
        SELECT season_year, constructor_name, stop_count, median_stop_seconds,
               p90_stop_seconds, fastest_stop_seconds, season_rank, seconds_vs_field_median
        FROM v_pit"""),
    "reliability_feed": star_query("""
        SELECT season_year, constructor_name, entries, finish_rate_pct, mechanical_dnfs,
               incident_dnfs, season_points FROM v_reliability"""),
    "top_contenders": star_query(f"""
        , best AS (
            SELECT season_year, driver_name FROM name_finals
            QUALIFY row_number() OVER (PARTITION BY season_year
                ORDER BY cumulative_points DESC, driver_name) <= 6
        )
        {PROGRESSION} WHERE (season_year, driver_name) IN (SELECT * FROM best)"""),
    "title_margin": star_query("""
        , placed_two AS (
            SELECT season_year, driver_name, cumulative_points,
                   row_number() OVER (PARTITION BY season_year
                       ORDER BY cumulative_points DESC, driver_name) AS place
            FROM name_finals
        ),
        span AS (SELECT season_year, max(round_number) AS rounds FROM v_progression GROUP BY 1)
        SELECT a.season_year, a.driver_name AS champion,
               CAST(a.cumulative_points AS DOUBLE) AS points,
               CAST(a.cumulative_points - coalesce(b.cumulative_points, 0) AS DOUBLE) AS margin,
               rounds
        FROM placed_two a
        LEFT JOIN placed_two b ON a.season_year = b.season_year AND b.place = 2
        JOIN span ON span.season_year = a.season_year
        WHERE a.place = 1"""),
    "dim_driver": star_query("SELECT * FROM dim_driver"),
    "dim_constructor": star_query("SELECT * FROM dim_constructor"),
    "dim_circuit": star_query("SELECT * FROM dim_circuit"),
    "dim_race": star_query("""
        SELECT race_id, season_year, round_number, circuit_id, race_name, race_date,
               race_month, race_day_name FROM dim_race"""),
    "status_category": star_query("SELECT * FROM dim_status"),
    "result_measures": star_query(f"SELECT {RESULT_COLUMNS} FROM fct_result"),
    "stop_fact": star_query("SELECT * FROM fct_pit_stop"),
}
