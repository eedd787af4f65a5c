"""The registered queries once more, as SQL for an independent engine. All share one list of
derived views; only those that a query names are computed."""

from __future__ import annotations

from fleetmill.config import DEFAULT as CFG
from fleetmill.plans.testbed import DAY, FIRST, LAST

DIST = "2e0 * 6371000e0 * asin(sqrt(least(1e0, pow(sin(radians({1} - {0}) / 2), 2) + cos(radians({0})) * cos(radians({1})) * pow(sin(radians({3} - {2}) / 2), 2))))"
PERIOD = "CASE WHEN {0} >= 6 AND {0} < 9 THEN 'morning_peak' WHEN {0} >= 9 AND {0} < 16 THEN 'off_peak' WHEN {0} >= 16 AND {0} < 20 THEN 'evening_peak' ELSE 'night' END"
LOCAL = f"timezone('{CFG.zone}', {{0}} AT TIME ZONE 'UTC')"
LEVEL = "CASE WHEN {0} > 20 THEN 'free_flow' WHEN {0} > 10 THEN 'slow' WHEN {0} > 5 THEN 'congested' ELSE 'gridlock' END"
STATUS = "CASE WHEN {0} < -60 THEN 'early' WHEN {0} <= 300 THEN 'on_time' ELSE 'late' END"
BRACKET = "CASE WHEN {0} < 1500 THEN 'low' WHEN {0} < 4000 THEN 'medium' WHEN {0} < 10000 THEN 'high' ELSE 'very_high' END"
SEVERITY = "CASE WHEN {0} > 1.0 THEN 'critical' WHEN {0} > 0.5 THEN 'severe' WHEN {0} > 0.3 THEN 'moderate' ELSE 'regular' END"
WEEKDAY = f"dayofweek({LOCAL}) BETWEEN 1 AND 5"

#: The fractional axial coordinates, and their rounding as cubes.
HEX_FROM = f"""(SELECT *, floor(q + 0.5e0) AS rq, floor(r + 0.5e0) AS rr, floor(-q - r + 0.5e0) AS rs FROM
  (SELECT *, (x * (sqrt(3e0) / 3e0) - y / 3e0) / {CFG.hex_edge_m}e0 AS q, y * (2e0 / 3e0) / {CFG.hex_edge_m}e0 AS r FROM
    (SELECT *, radians({{1}}) * (6371000e0 * cos(radians(({CFG.lat_min}e0 + {CFG.lat_max}e0) / 2e0))) AS x, radians({{0}}) * 6371000e0 AS y FROM {{2}})))"""
HEX = """CAST((CASE WHEN abs(rq - q) > abs(rr - r) AND abs(rq - q) > abs(rs + q + r) THEN -rr - rs ELSE rq END + 16777216) * 33554432
  + CASE WHEN abs(rq - q) > abs(rr - r) AND abs(rq - q) > abs(rs + q + r) THEN rr WHEN abs(rr - r) > abs(rs + q + r) THEN -rq - rs ELSE rr END + 16777216 AS BIGINT)"""

HEAD = f"""WITH
stops AS (SELECT CAST(s_suppkey AS VARCHAR) AS stop_id, -24e0 + (s_suppkey * 37 % 1000) * 0.0006e0 AS stop_lat, -46.9e0 + (s_suppkey * 53 % 1000) * 0.0006e0 AS stop_lon FROM supplier),
raw AS (SELECT *, (user_id * 31 + event_id) % (SELECT count(*) FROM supplier) AS k FROM events),
positions AS (SELECT event_id, user_id, CAST(user_id AS VARCHAR) AS vehicle_id, CAST(user_id % 20 AS INTEGER) AS line_code, 'L' || CAST(user_id % 20 AS VARCHAR) AS line_number,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE -24e0 + (k * 37 % 1000) * 0.0006e0 + (event_id % 17 - 8) * 1e-4 END AS latitude,
  CASE WHEN event_id % 97 = 0 THEN 0e0 ELSE -46.9e0 + (k * 53 % 1000) * 0.0006e0 + (event_id % 13 - 6) * 1e-4 END AS longitude, ts AS event_ts, k FROM raw),
boxed AS (SELECT * FROM positions WHERE latitude BETWEEN {CFG.lat_min}e0 AND {CFG.lat_max}e0 AND longitude BETWEEN {CFG.lon_min}e0 AND {CFG.lon_max}e0),
featured AS (SELECT *, CAST(hour({LOCAL.format("event_ts")}) AS INTEGER) AS hour_of_day, {WEEKDAY.format("event_ts")} AS is_weekday, strftime(event_ts, '%Y-%m-%d') AS _event_date FROM boxed),
enriched AS (SELECT *, {HEX} AS h3_index FROM {HEX_FROM.format("latitude", "longitude", "featured")}),
lagged AS (SELECT *, lag(latitude) OVER w AS p_lat, lag(longitude) OVER w AS p_lon, lag(event_ts) OVER w AS p_ts FROM enriched WINDOW w AS (PARTITION BY vehicle_id ORDER BY event_ts, event_id)),
moved AS (SELECT *, {DIST.format("p_lat", "latitude", "p_lon", "longitude")} AS distance_m, CAST(floor(epoch(event_ts)) - floor(epoch(p_ts)) AS BIGINT) AS dt FROM lagged WHERE p_ts IS NOT NULL),
speeds AS (SELECT *, (distance_m / 1000e0) / (dt / 3600e0) AS speed_kmh FROM moved WHERE dt > 0 AND (distance_m / 1000e0) / (dt / 3600e0) <= 150),
speed_hourly AS (SELECT date_trunc('hour', event_ts) AS window_start, h3_index, line_code, line_number, {PERIOD.format("hour_of_day")} AS time_period, is_weekday, _event_date, count(*) AS observation_count,
  avg(speed_kmh) AS avg_speed_kmh, stddev_samp(speed_kmh) AS stddev_speed_kmh, quantile_disc(speed_kmh, 0.1) AS p10_speed_kmh, quantile_disc(speed_kmh, 0.5) AS median_speed_kmh,
  quantile_disc(speed_kmh, 0.9) AS p90_speed_kmh, avg(distance_m) AS avg_segment_distance_m, {LEVEL.format("avg(speed_kmh)")} AS congestion_level FROM speeds GROUP BY ALL),
arrivals AS (SELECT event_id, CAST(user_id AS VARCHAR) AS vehicle_id, event_type AS stop_id, 'R' AS route_id, CAST(user_id % 2 AS INTEGER) AS line_code, ts AS arrival_time FROM events),
head_lag AS (SELECT *, lag(arrival_time) OVER (PARTITION BY stop_id, line_code ORDER BY arrival_time, vehicle_id) AS prev FROM arrivals),
headways AS (SELECT *, CAST(floor(epoch(arrival_time)) - floor(epoch(prev)) AS BIGINT) AS headway_seconds FROM head_lag
  WHERE prev IS NOT NULL AND floor(epoch(arrival_time)) - floor(epoch(prev)) BETWEEN 30 AND 7200),
headway_hourly AS (SELECT date_trunc('hour', arrival_time) AS window_start, stop_id, line_code, route_id, {PERIOD.format(f'hour({LOCAL.format("arrival_time")})')} AS time_period, {WEEKDAY.format("arrival_time")} AS is_weekday,
  strftime(arrival_time, '%Y-%m-%d') AS _event_date, count(*) AS arrival_count, avg(headway_seconds) AS avg_headway_seconds, stddev_samp(headway_seconds) AS stddev_headway_seconds,
  min(headway_seconds) AS min_headway_seconds, max(headway_seconds) AS max_headway_seconds, quantile_disc(headway_seconds, 0.5) AS median_headway_seconds,
  stddev_samp(headway_seconds) / avg(headway_seconds) AS headway_cv, {SEVERITY.format("stddev_samp(headway_seconds) / avg(headway_seconds)")} AS bunching_severity FROM headways GROUP BY ALL),
near AS (SELECT p.vehicle_id, s.stop_id, p.line_code, p.event_ts AS arrival_time, p.latitude, p.longitude, {DIST.format("p.latitude", "s.stop_lat", "p.longitude", "s.stop_lon")} AS distance_to_stop_m
  FROM boxed p, stops s WHERE abs(p.latitude - s.stop_lat) < 0.001 AND abs(p.longitude - s.stop_lon) < 0.001),
stop_arrivals AS (SELECT * FROM near WHERE distance_to_stop_m <= 50
  QUALIFY row_number() OVER (PARTITION BY vehicle_id, stop_id, time_bucket(INTERVAL 5 MINUTE, arrival_time) ORDER BY arrival_time, distance_to_stop_m) = 1),
routes AS (SELECT CAST(33000 + n_nationkey AS VARCHAR) || '-10' AS route_id, CAST(n_nationkey AS INTEGER) AS line_code, n_name AS route_short_name, 'Line ' || n_name AS route_long_name FROM nation
  UNION ALL SELECT CAST(33000 + n_nationkey AS VARCHAR) || '-11', CAST(n_nationkey AS INTEGER), 'second', 'second' FROM nation WHERE n_nationkey % 5 = 0),
trips AS (SELECT CAST(33000 + line AS VARCHAR) || CASE WHEN line % 5 = 0 AND c_custkey % 2 = 1 THEN '-11' ELSE '-10' END AS route_id, CAST(c_custkey AS VARCHAR) AS trip_id
  FROM (SELECT c_custkey, least(c_custkey * 7 % 25, c_custkey // 25 * 11 % 25) AS line FROM customer)),
timetable AS (SELECT CAST(k AS VARCHAR) AS trip_id, event_type AS stop_id, k * 1800 + length(event_type) * 60 AS s FROM range(2, 50) AS r(k), (SELECT DISTINCT event_type FROM events)),
clocked AS (SELECT *, hour({LOCAL.format("arrival_time")}) * 3600 + minute({LOCAL.format("arrival_time")}) * 60 + CAST(floor(second({LOCAL.format("arrival_time")})) AS BIGINT) AS a FROM arrivals),
gaps AS (SELECT a.*, t.trip_id, CAST((a.a - t.s + 216000) % 86400 - 43200 AS BIGINT) AS delay_seconds FROM clocked a JOIN timetable t USING (stop_id)),
matched AS (SELECT *, {STATUS.format("delay_seconds")} AS on_time_status FROM gaps QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY abs(delay_seconds), trip_id) = 1),
on_time_hourly AS (SELECT date_trunc('hour', arrival_time) AS window_start, route_id, line_code, {PERIOD.format(f'hour({LOCAL.format("arrival_time")})')} AS time_period, {WEEKDAY.format("arrival_time")} AS is_weekday,
  strftime(arrival_time, '%Y-%m-%d') AS _event_date, count(*) AS total_arrivals, count(*) FILTER (on_time_status = 'on_time') AS on_time_count, count(*) FILTER (on_time_status = 'early') AS early_count,
  count(*) FILTER (on_time_status = 'late') AS late_count, avg(delay_seconds) AS avg_delay_seconds, quantile_disc(delay_seconds, 0.5) AS median_delay_seconds, quantile_disc(delay_seconds, 0.95) AS p95_delay_seconds,
  round(count(*) FILTER (on_time_status = 'on_time') / CAST(count(*) AS DOUBLE) * 100, 2) AS on_time_pct FROM matched GROUP BY ALL),
days AS (SELECT strftime(d, '%Y-%m-%d') AS _event_date FROM generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY) AS g(d)),
actual_week AS (SELECT _event_date, CAST(user_id % 30 AS INTEGER) AS line_code, 'L' || CAST(user_id % 30 AS VARCHAR) AS line_number, count(DISTINCT vehicle_id) AS actual_vehicles, count(*) AS total_observations,
  min(event_ts) AS first_seen, max(event_ts) AS last_seen FROM featured JOIN days USING (_event_date) GROUP BY ALL),
actual AS (SELECT * EXCLUDE (_event_date) FROM actual_week WHERE _event_date = '{DAY}'),
planned AS (SELECT route_id, r.line_code, r.route_short_name, r.route_long_name, count(DISTINCT trip_id) AS planned_trips FROM trips JOIN routes r USING (route_id) GROUP BY ALL),
planned_lines AS (SELECT _event_date, line_code, CAST(sum(planned_trips) AS BIGINT) AS planned_trips, arg_min(route_short_name, route_id) AS route_short_name, arg_min(route_long_name, route_id) AS route_long_name FROM planned, days GROUP BY ALL),
fleet_week AS (SELECT *, CASE WHEN actual_vehicles = 0 THEN 'no_service' WHEN utilization_ratio < 0.5 THEN 'severely_underserved' WHEN utilization_ratio < 0.8 THEN 'underserved' WHEN utilization_ratio <= 1.2 THEN 'normal'
  ELSE 'over_capacity' END AS status FROM (SELECT coalesce(a.line_code, p.line_code) AS line_code, coalesce(line_number, route_short_name) AS line_number, route_long_name,
  coalesce(actual_vehicles, 0) AS actual_vehicles, coalesce(planned_trips, 0) AS planned_trips, coalesce(total_observations, 0) AS total_observations, first_seen, last_seen,
  CASE WHEN planned_trips > 0 THEN coalesce(actual_vehicles, 0) / CAST(planned_trips AS DOUBLE) END AS utilization_ratio, coalesce(a._event_date, p._event_date) AS _event_date
  FROM actual_week a FULL JOIN planned_lines p ON a.line_code = p.line_code AND a._event_date = p._event_date)),
fleet AS (SELECT * FROM fleet_week WHERE _event_date = '{DAY}'),
service AS (SELECT h3_index, hour_of_day, {PERIOD.format("hour_of_day")} AS time_period, is_weekday, count(DISTINCT vehicle_id) AS unique_vehicles, count(*) AS total_observations, count(DISTINCT line_code) AS unique_routes
  FROM enriched WHERE _event_date = '{DAY}' GROUP BY ALL),
tracts AS (SELECT *, {HEX} AS h3_index, population / area_km2 AS population_density, {BRACKET.format("avg_income_brl")} AS income_bracket FROM {HEX_FROM.format("lat", "lon", '''(SELECT CAST(s_suppkey AS VARCHAR) AS tract_code,
  100 + s_suppkey * 7919 % 5000 AS population, 30 + s_suppkey * 101 % 900 AS households, abs(s_acctbal) AS avg_income_brl, 0.5e0 + (s_suppkey % 7) * 0.25e0 AS area_km2, -24e0 + (s_suppkey * 37 % 1000) * 0.0006e0 AS lat,
  -46.9e0 + (s_suppkey * 53 % 1000) * 0.0006e0 AS lon FROM supplier WHERE s_suppkey % 10 <> 9)''')}),
cells AS (SELECT h3_index, CAST(sum(population) AS BIGINT) AS population, CAST(sum(households) AS BIGINT) AS households, avg(avg_income_brl) AS avg_income_brl, avg(population_density) AS population_density,
  {BRACKET.format("avg(avg_income_brl)")} AS income_bracket FROM tracts GROUP BY 1),
equity AS (SELECT *, CASE WHEN income_bracket = 'low' AND v < 2 THEN 'underserved' WHEN income_bracket = 'low' AND v >= 2 THEN 'adequate' WHEN income_bracket IN ('high', 'very_high') THEN 'well_served' ELSE 'moderate' END AS service_equity_score
  FROM (SELECT s.*, population, households, avg_income_brl, population_density, income_bracket, CASE WHEN population > 0 THEN CAST(unique_vehicles AS DOUBLE) / population * 1000 END AS v FROM service s LEFT JOIN cells USING (h3_index)))
"""

WEEK = f"_event_date BETWEEN '{FIRST}' AND '{LAST}'"

QUERIES = {
    "pos_bounds": "SELECT event_id, vehicle_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM boxed",
    "pos_enriched_left": """SELECT event_id, CAST(user_id % 30 AS INTEGER) AS line_code, route_short_name, CASE WHEN route_short_name IS NOT NULL THEN 'Line ' || route_short_name END AS route_long_name
      FROM positions p LEFT JOIN (SELECT * FROM routes WHERE route_id LIKE '%-10') r ON r.line_code = user_id % 30""",
    "pos_dedup": "SELECT vehicle_id, event_ts, min(event_id) AS event_id FROM (SELECT * FROM positions UNION ALL SELECT * FROM positions WHERE event_id % 10 = 0) GROUP BY 1, 2",
    "time_features": f"SELECT event_id, hour_of_day, is_weekday, _event_date, {PERIOD.format('hour_of_day')} AS time_period FROM featured",
    "api_flatten": "SELECT vehicle_id, line_code, line_number, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, event_id % 3 = 0 AS is_accessible, strftime(event_ts, '%Y-%m-%dT%H:%M:%S') AS event_timestamp FROM positions",
    "line_code_extract": "SELECT route_id, CAST(regexp_extract(route_id, '(\\d+)', 1) AS INTEGER) AS line_code FROM routes UNION ALL SELECT n_name, TRY_CAST(regexp_extract(n_name, '(\\d+)', 1) AS INTEGER) FROM nation",
    "haversine_pairs": f"SELECT event_id, round({DIST.format('p.latitude', 's.stop_lat', 'p.longitude', 's.stop_lon')}, 3) AS distance_m FROM boxed p JOIN stops s ON s.stop_id = CAST(p.k AS VARCHAR)",
    "hex_cell": "SELECT event_id, h3_index FROM enriched",
    "speed_pairs": "SELECT event_id, vehicle_id, round(distance_m, 3) AS distance_m, dt AS time_delta_seconds, round(speed_kmh, 4) AS speed_kmh FROM speeds",
    "speed_hourly": """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, h3_index, line_code, line_number, time_period, is_weekday, _event_date, observation_count, round(avg_speed_kmh, 4) AS avg_speed_kmh, round(stddev_speed_kmh, 4) AS stddev_speed_kmh,
      round(p10_speed_kmh, 4) AS p10_speed_kmh, round(median_speed_kmh, 4) AS median_speed_kmh, round(p90_speed_kmh, 4) AS p90_speed_kmh, round(avg_segment_distance_m, 3) AS avg_segment_distance_m, congestion_level FROM speed_hourly""",
    "congestion_class": f"SELECT event_id, {LEVEL.format('speed_kmh')} AS congestion_level FROM speeds",
    "speed_distribution": f"SELECT congestion_level, count(*) AS cells, round(avg(avg_speed_kmh), 2) AS avg_speed, CAST(sum(observation_count) AS BIGINT) AS samples FROM speed_hourly WHERE {WEEK} GROUP BY 1",
    "speed_trend": f"SELECT window_start, round(avg(avg_speed_kmh), 2) AS avg_speed, round(avg(median_speed_kmh), 2) AS median_speed, CAST(sum(observation_count) AS BIGINT) AS samples FROM speed_hourly WHERE {WEEK} GROUP BY 1",
    "worst_corridors": f"""SELECT line_code, line_number, samples, avg_speed, avg_p10, usual_level FROM (SELECT line_code, line_number, CAST(sum(observation_count) AS BIGINT) AS samples, round(avg(avg_speed_kmh), 2) AS avg_speed, round(avg(p10_speed_kmh), 2) AS avg_p10
      FROM speed_hourly WHERE {WEEK} AND is_weekday GROUP BY 1, 2) JOIN (SELECT line_code, line_number, congestion_level AS usual_level FROM speed_hourly WHERE {WEEK} AND is_weekday GROUP BY 1, 2, 3
      QUALIFY row_number() OVER (PARTITION BY line_code ORDER BY count(*) DESC, congestion_level) = 1) USING (line_code, line_number) WHERE samples >= 50 ORDER BY avg_speed, line_code LIMIT 20""",
    "congestion_map": f"""SELECT h3_index, line_code, round(avg_speed_kmh, 1) AS avg_speed, round(median_speed_kmh, 1) AS median_speed, congestion_level, observation_count FROM speed_hourly
      WHERE _event_date = '{DAY}' AND window_start >= TIMESTAMP '{DAY} 12:00:00'""",
    "headways": "SELECT event_id, headway_seconds FROM headways",
    "headway_hourly": """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, stop_id, line_code, route_id, time_period, is_weekday, _event_date, arrival_count, round(avg_headway_seconds, 4) AS avg_headway_seconds, round(stddev_headway_seconds, 4) AS stddev_headway_seconds,
      min_headway_seconds, max_headway_seconds, median_headway_seconds, round(headway_cv, 5) AS headway_cv, bunching_severity FROM headway_hourly""",
    "worst_bunching": f"""SELECT route_id, line_code, stop_id, CAST(sum(arrival_count) AS BIGINT) AS headways, round(avg(headway_cv), 3) AS avg_cv, round(round(avg(avg_headway_seconds) / 60, 6), 1) AS avg_headway_min FROM headway_hourly WHERE {WEEK} AND is_weekday
      GROUP BY 1, 2, 3 HAVING sum(arrival_count) >= 20 ORDER BY avg_cv DESC, stop_id, line_code LIMIT 20""",
    "severity_distribution": f"SELECT bunching_severity, time_period, count(*) AS windows, count(DISTINCT line_code) AS lines, round(avg(headway_cv), 3) AS avg_cv FROM headway_hourly WHERE {WEEK} GROUP BY 1, 2",
    "headway_trend_param": f"SELECT window_start, stop_id, line_code, round(avg_headway_seconds / 60, 1) AS avg_headway_min, round(headway_cv, 3) AS cv, bunching_severity FROM headway_hourly WHERE line_code = 1 AND {WEEK}",
    "stop_arrivals_grid": "SELECT vehicle_id, stop_id, line_code, arrival_time, round(distance_to_stop_m, 3) AS distance_to_stop_m FROM stop_arrivals",
    "schedule_with_route": "SELECT trip_id, stop_id, route_id FROM (SELECT trip_id, route_id AS stop_id FROM trips) JOIN trips USING (trip_id)",
    "nearest_schedule": "SELECT event_id, stop_id, trip_id, delay_seconds FROM matched",
    "on_time_class": "SELECT on_time_status, count(*) AS arrivals FROM matched GROUP BY 1",
    "on_time_hourly": "SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, route_id, line_code, time_period, is_weekday, _event_date, total_arrivals, on_time_count, early_count, late_count, round(avg_delay_seconds, 4) AS avg_delay_seconds, median_delay_seconds, p95_delay_seconds, on_time_pct FROM on_time_hourly",
    "on_time_trend": f"""SELECT window_start, round(sum(on_time_count) * 100e0 / sum(total_arrivals), 1) AS on_time_pct, round(sum(early_count) * 100e0 / sum(total_arrivals), 1) AS early_pct, round(sum(late_count) * 100e0 / sum(total_arrivals), 1) AS late_pct,
      round(round(avg(avg_delay_seconds), 6), 1) AS avg_delay_s, CAST(sum(total_arrivals) AS BIGINT) AS arrivals FROM on_time_hourly WHERE {WEEK} GROUP BY 1""",
    "on_time_worst": f"""SELECT route_id, line_code, CAST(sum(total_arrivals) AS BIGINT) AS arrivals, round(sum(on_time_count) * 100e0 / sum(total_arrivals), 1) AS on_time_pct, round(round(avg(avg_delay_seconds), 6), 1) AS avg_delay_s FROM on_time_hourly WHERE {WEEK}
      GROUP BY 1, 2 HAVING sum(total_arrivals) >= 10 ORDER BY on_time_pct, route_id, line_code LIMIT 20""",
    "peak_compare": f"SELECT time_period, is_weekday, round(sum(on_time_count) * 100e0 / sum(total_arrivals), 1) AS on_time_pct, round(round(avg(avg_delay_seconds), 6), 1) AS avg_delay_s, CAST(sum(total_arrivals) AS BIGINT) AS arrivals FROM on_time_hourly WHERE {WEEK} GROUP BY 1, 2",
    "fleet_actual": "SELECT * FROM actual",
    "fleet_planned": "SELECT * FROM planned",
    "fleet_utilization": "SELECT * REPLACE (round(utilization_ratio, 5) AS utilization_ratio) FROM fleet",
    "fleet_status": "SELECT status, count(*) AS lines, CAST(sum(actual_vehicles) AS BIGINT) AS vehicles, CAST(sum(planned_trips) AS BIGINT) AS trips, round(avg(utilization_ratio), 2) AS avg_utilization FROM fleet GROUP BY 1",
    "fleet_underserved": """SELECT line_code, line_number, actual_vehicles, planned_trips, round(utilization_ratio, 2) AS utilization, status FROM fleet WHERE status IN ('no_service', 'severely_underserved', 'underserved')
      ORDER BY utilization NULLS FIRST, planned_trips DESC, line_code LIMIT 30""",
    "fleet_trend": """SELECT _event_date, CAST(sum(actual_vehicles) AS BIGINT) AS vehicles, CAST(sum(planned_trips) AS BIGINT) AS trips, round(sum(actual_vehicles) / CAST(sum(planned_trips) AS DOUBLE), 2) AS utilization,
      count(*) FILTER (status IN ('severely_underserved', 'no_service')) AS critical_lines, count(*) FILTER (status = 'normal') AS normal_lines FROM fleet_week GROUP BY 1""",
    "fleet_full": "SELECT line_code, line_number, actual_vehicles, planned_trips, round(utilization_ratio, 2) AS utilization FROM fleet WHERE status IN ('normal', 'over_capacity') ORDER BY utilization DESC NULLS LAST, line_code LIMIT 20",
    "service_frequency": "SELECT * FROM service",
    "census_brackets": "SELECT tract_code, h3_index, round(population_density, 4) AS population_density, income_bracket FROM tracts",
    "census_hex": "SELECT h3_index, population, households, round(avg_income_brl, 4) AS avg_income_brl, round(population_density, 4) AS population_density, income_bracket FROM cells",
    "coverage_equity": f"""SELECT h3_index, hour_of_day, time_period, is_weekday, unique_vehicles, total_observations, unique_routes, round(CAST(population AS DOUBLE), 1) AS population, round(CAST(households AS DOUBLE), 1) AS households, round(avg_income_brl, 4) AS avg_income_brl, round(population_density, 4) AS population_density,
      income_bracket, round(v, 5) AS vehicles_per_1k_population, service_equity_score, '{DAY}' AS _event_date FROM equity""",
    "equity_overview": """SELECT income_bracket, service_equity_score, count(DISTINCT h3_index) AS areas, round(avg(v), 2) AS avg_vehicles_per_1k, round(avg(avg_income_brl), 0) AS avg_income, CAST(sum(population) AS BIGINT) AS population
      FROM equity WHERE income_bracket IS NOT NULL GROUP BY 1, 2""",
    "equity_scatter": "SELECT h3_index, hour_of_day, round(avg_income_brl, 4) AS avg_income_brl, round(v, 5) AS vehicles_per_1k_population, round(CAST(population AS DOUBLE), 1) AS population, income_bracket, service_equity_score FROM equity WHERE avg_income_brl IS NOT NULL AND hour_of_day BETWEEN 6 AND 22",
    "equity_underserved": """SELECT h3_index, hour_of_day, population, round(avg_income_brl, 0) AS avg_income, round(v, 2) AS vehicles_per_1k, unique_routes FROM equity WHERE service_equity_score = 'underserved'
      ORDER BY vehicles_per_1k, h3_index, hour_of_day LIMIT 50""",
    "equity_by_hour": "SELECT hour_of_day, income_bracket, round(avg(v), 5) AS avg_vehicles_per_1k, round(avg(unique_routes), 5) AS avg_lines FROM equity WHERE income_bracket IS NOT NULL GROUP BY 1, 2",
    "window_5min": "SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "window_1h": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(avg(value), 6) AS avg_value FROM events GROUP BY 1, 2",
    "stream_dedup_replay": "SELECT vehicle_id, event_ts, min(event_id) AS event_id FROM boxed GROUP BY 1, 2",
    "stream_hourly_replay": """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, h3_index, line_code, line_number, time_period, is_weekday, _event_date, observation_count, round(avg_speed_kmh, 4) AS avg_speed_kmh, congestion_level FROM speed_hourly""",
}


def oracle_sql() -> dict[str, str]:
    return {name: HEAD + sql for name, sql in QUERIES.items()}
