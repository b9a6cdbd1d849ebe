"""SQL twins of the catalog's queries, for DuckDB on the same Parquet tables.

Written on their own, without the star schema: each starts from order lines
read as flight legs and goes straight to its result.
"""

from __future__ import annotations

# Texts, codes, names and labels that results must agree on.
NULL_TEXT = "_dbt_utils_surrogate_key_null_"

LISTED = "('ARN','BMA','GOT','MMX','LLA','UME','OSD','VBY','RNB','KRN')"

LEGS = """
lines AS (
  SELECT *,
    CASE WHEN l_linenumber % 2 = 1 THEN 'arrival' ELSE 'departure' END AS kind,
    ['SK','DY','FR','LH','AY','KL','BA','W6','FI','EW','D8',NULL]
      [(l_orderkey // 60) % 12 + 1] AS airline,
    CASE WHEN l_partkey % 41 = 0 THEN 'SFT'
         WHEN l_linenumber = 1 AND l_orderkey % 5 = 0 THEN 'ARN'
         ELSE ['ARN','BMA','GOT','MMX','LLA','UME','OSD','VBY','RNB','KRN']
           [(l_orderkey // 720) % 10 + 1] END AS home,
    CASE WHEN l_partkey % 67 <> 0 THEN
      ['ARN','BMA','GOT','MMX','LLA','UME','OSD','VBY','RNB','KRN','CPH','OSL','HEL','LHR']
        [(l_orderkey // 7 + l_linenumber) % 14 + 1] END AS away,
    CASE WHEN l_partkey % 61 = 0 THEN NULL
         WHEN l_linenumber = 1 AND l_orderkey % 5 = 0
           THEN TIMESTAMP '2026-01-21 08:00:00' + to_minutes(l_orderkey % 60)
         ELSE TIMESTAMP '2026-01-01' + to_days(CAST(l_orderkey % 60 AS INTEGER))
           + to_minutes((l_orderkey * 7 + l_linenumber * 131) % 1440) END AS sched,
    CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_partkey % 59 = 0 THEN 'ZZZ'
         WHEN l_partkey % 20 IN (0, 1, 2) THEN 'DEL' WHEN l_partkey % 20 = 3 THEN 'CAN'
         WHEN l_partkey % 20 IN (4, 5, 6) THEN 'SCH' WHEN l_partkey % 20 = 7 THEN 'ACT'
         ELSE 'LAN' END AS status
  FROM lineitem
),
landed AS (
  SELECT *, CASE WHEN status = 'LAN' THEN
      sched + to_seconds(((l_partkey * 37 + l_suppkey * 11) % 80) * 60 - 1200) END AS actual
  FROM lines
),
bags AS (
  SELECT *,
    CASE WHEN kind = 'arrival' THEN actual + to_seconds(300 + l_suppkey * 60) END AS bag_one
  FROM landed
),
legs AS (
  SELECT kind, home, away, airline, 'Airline ' || airline ||
      CASE WHEN airline = 'W6' AND l_partkey % 2 = 0 THEN ' Malta' ELSE '' END AS airline_name,
    coalesce(airline, 'XX') || CAST(100 + l_orderkey % 900 AS VARCHAR) AS fid,
    CASE WHEN kind = 'arrival' THEN away ELSE home END AS orig,
    CASE WHEN kind = 'arrival' THEN home ELSE away END AS dest,
    sched, actual, status,
    CAST(1 + l_suppkey % 5 AS VARCHAR) AS terminal,
    'G' || CAST(1 + l_suppkey % 20 AS VARCHAR) AS gate,
    CASE WHEN kind = 'arrival' AND l_partkey % 5 <> 0
      THEN CAST(1 + l_suppkey % 6 AS VARCHAR) END AS carousel,
    bag_one,
    CASE WHEN l_partkey % 11 <> 0
      THEN bag_one + to_seconds(120 + ((l_partkey * 17) % 40) * 60) END AS bag_last,
    CAST(1769300000 + l_partkey % 3 AS VARCHAR) AS load_id,
    lpad(CAST(l_partkey AS VARCHAR), 8, '0') || lpad(CAST(l_suppkey AS VARCHAR), 8, '0')
      || CAST(date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS VARCHAR) AS row_id
  FROM bags
)"""

FLIGHTS = (
    LEGS
    + f""",
newest AS (
  SELECT *, row_number() OVER (
      PARTITION BY kind, fid, sched ORDER BY load_id DESC, row_id DESC) AS version
  FROM legs
),
flights AS (
  SELECT * EXCLUDE (version),
    coalesce(status = 'DEL', false) AS deleted, coalesce(status = 'CAN', false) AS cancelled,
    actual IS NOT NULL AS flown,
    coalesce((CASE WHEN kind = 'arrival' THEN orig ELSE dest END) IN {LISTED}, false) AS domestic,
    (epoch_us(actual) - epoch_us(sched)) / 60000000.0::DOUBLE AS late,
    (epoch_us(bag_last) - epoch_us(bag_one)) / 60000000.0::DOUBLE AS handling,
    coalesce(actual <= sched + INTERVAL 15 MINUTE, false) AS punctual,
    CAST(hour(sched) AS BIGINT) AS hh,
    CASE WHEN hour(sched) BETWEEN 6 AND 11 THEN 'Morning (06:00-11:59)'
         WHEN hour(sched) BETWEEN 12 AND 16 THEN 'Midday/Afternoon (12:00-16:59)'
         WHEN hour(sched) BETWEEN 17 AND 21 THEN 'Evening (17:00-21:59)'
         ELSE 'Night/Red-eye (22:00-05:59)' END AS day_part,
    CAST(isodow(sched) AS BIGINT) AS dow, dayname(sched) AS dow_name,
    CAST(CAST(sched AS DATE) AS TIMESTAMP) AS fday
  FROM newest WHERE version = 1
)"""
)

PERIODS = """
    fday AS flight_date,
    CAST(date_trunc('week', fday) AS TIMESTAMP) AS flight_week,
    CAST(date_trunc('month', fday) AS TIMESTAMP) AS flight_month,
    CAST(year(fday) AS BIGINT) AS flight_year,
    CAST(weekofyear(fday) AS BIGINT) AS week_number,
    CAST(month(fday) AS BIGINT) AS month_number"""


def key(*columns: str) -> str:
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_TEXT}')" for c in columns)
    return f"md5(concat_ws('-', {texts}))"


def with_(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def pct(part: str, whole: str) -> str:
    return f"round(CASE WHEN {whole} > 0 THEN {part} * 100.0::DOUBLE / {whole} END, 2)"


def share(amount: str) -> str:
    return f"round({amount} * 100.0::DOUBLE / (sum({amount}) OVER ()), 2)"


# ---------------------------------------------------------------- raw layer

_RAW_HEAD = """
  fid AS flight_id, fid AS flight_leg_identifier__flight_id,
  orig AS flight_leg_identifier__departure_airport_iata,
  dest AS flight_leg_identifier__arrival_airport_iata,
  CAST(CAST(sched AS DATE) AS TIMESTAMP) AS flight_leg_identifier__flight_departure_date_utc,
  airline_name AS airline_operator__name, airline AS airline_operator__iata,"""
_RAW_PLACE = """
  status AS location_and_status__flight_leg_status,
  terminal AS location_and_status__terminal, gate AS location_and_status__gate,"""
_RAW_ARRIVALS = f"""SELECT {_RAW_HEAD}
  'Airport ' || orig AS departure_airport_swedish,
  'Airport ' || orig AS departure_airport_english,
  sched AS arrival_time__scheduled_utc, CAST(NULL AS TIMESTAMP) AS arrival_time__estimated_utc,
  actual AS arrival_time__actual_utc, {_RAW_PLACE}
  carousel AS baggage__baggage_claim_unit,
  bag_one AS baggage__first_bag_utc, bag_last AS baggage__last_bag_utc,
  load_id AS _dlt_load_id, row_id AS _dlt_id, home AS airport
FROM legs WHERE kind = 'arrival'"""
_RAW_DEPARTURES = f"""SELECT {_RAW_HEAD}
  'Airport ' || dest AS arrival_airport_swedish,
  'Airport ' || dest AS arrival_airport_english,
  sched AS departure_time__scheduled_utc,
  CAST(NULL AS TIMESTAMP) AS departure_time__estimated_utc,
  actual AS departure_time__actual_utc, {_RAW_PLACE}
  load_id AS _dlt_load_id, row_id AS _dlt_id, home AS airport
FROM legs WHERE kind = 'departure'"""

# ---------------------------------------------------------------- models

_STG_HEAD = """
  fid AS flight_id, fid AS flight_number, orig AS origin_airport_iata,
  dest AS destination_airport_iata, fday AS departure_date_utc, airline_name,
  airline AS airline_iata, status AS flight_status, terminal, gate,
  load_id AS _dlt_load_id, row_id AS _dlt_id, orig || '-' || dest AS route_key,
  deleted AS is_deleted, cancelled AS is_cancelled, domestic AS is_domestic,
  late AS delay_minutes, punctual AS is_on_time,"""

_STG_ARRIVALS = f"""SELECT {_STG_HEAD}
  'Airport ' || orig AS origin_airport_swedish, 'Airport ' || orig AS origin_airport_english,
  sched AS scheduled_arrival_utc, CAST(NULL AS TIMESTAMP) AS estimated_arrival_utc,
  actual AS actual_arrival_utc, carousel AS baggage_claim_unit,
  bag_one AS first_bag_utc, bag_last AS last_bag_utc, coalesce(status = 'LAN', false) AS is_landed,
  hh AS arrival_hour, dow AS arrival_day_of_week, dow_name AS arrival_day_name,
  fday AS arrival_date, day_part AS arrival_time_period, handling AS baggage_handling_minutes
FROM flights WHERE kind = 'arrival'"""

_STG_DEPARTURES = f"""SELECT {_STG_HEAD}
  'Airport ' || dest AS destination_airport_swedish,
  'Airport ' || dest AS destination_airport_english,
  sched AS scheduled_departure_utc, CAST(NULL AS TIMESTAMP) AS estimated_departure_utc,
  actual AS actual_departure_utc, coalesce(status = 'SCH', false) AS is_scheduled,
  hh AS departure_hour, dow AS departure_day_of_week, dow_name AS departure_day_name,
  fday AS departure_date, day_part AS departure_time_period
FROM flights WHERE kind = 'departure'"""

_UNIFIED = """
  fid AS flight_id, fid AS flight_number, orig AS origin_airport_iata,
  dest AS destination_airport_iata, fday AS departure_date_utc, airline_name,
  sched AS scheduled_time_utc, actual AS actual_time_utc, status AS flight_status,
  terminal, gate, orig || '-' || dest AS route_key, deleted AS is_deleted,
  cancelled AS is_cancelled, domestic AS is_domestic, late AS delay_minutes,
  hh AS flight_hour, dow AS flight_day_of_week, dow_name AS flight_day_name,
  fday AS flight_date, day_part AS flight_time_period, punctual AS is_on_time,
  CASE WHEN kind = 'arrival' THEN coalesce(status = 'LAN', false) END AS is_landed,
  carousel AS baggage_claim_unit, bag_one AS first_bag_utc, bag_last AS last_bag_utc,
  handling AS baggage_handling_minutes, kind AS flight_type"""

_INT_FLIGHTS = f"SELECT {_UNIFIED}, airline AS airline_iata FROM flights"

_FACT = f"""SELECT {_UNIFIED},
  {key('fid', 'kind', 'sched')} AS flight_key, {key('airline')} AS airline_key,
  {key('orig')} AS origin_airport_key, {key('dest')} AS dest_airport_key,
  CAST(strftime(sched, '%Y%m%d') AS INTEGER) AS flight_date_key
FROM flights"""

_DIM_AIRLINE = f"""SELECT {key('airline')} AS airline_key, airline AS airline_iata, airline_name
FROM flights WHERE airline IS NOT NULL GROUP BY airline, airline_name"""

# Fixed values.
_AIRPORT_NAMES = """names(iata, name) AS (VALUES
  ('ARN', 'Stockholm Arlanda Airport'), ('BMA', 'Bromma Stockholm Airport'),
  ('GOT', 'Göteborg Landvetter Airport'), ('MMX', 'Malmö Airport'), ('LLA', 'Luleå Airport'),
  ('UME', 'Umeå Airport'), ('OSD', 'Åre Östersund Airport'), ('VBY', 'Visby Airport'),
  ('RNB', 'Ronneby Airport'), ('KRN', 'Kiruna Airport'))"""

_DIM_AIRPORT_TRAFFIC = f"""SELECT {key('iata')} AS airport_key, iata AS airport_iata,
  name AS airport_name,
  (SELECT count(*) FROM flights f WHERE f.orig = n.iata) AS as_origin,
  (SELECT count(*) FROM flights f WHERE f.dest = n.iata) AS as_destination
FROM names n"""

_DIM_DATE_TRAFFIC = """
SELECT CAST(d AS TIMESTAMP) AS date_day,
  CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
  CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter,
  CAST(month(d) AS BIGINT) AS month, monthname(d) AS month_name,
  left(monthname(d), 3) AS month_name_short, CAST(weekofyear(d) AS BIGINT) AS week_number,
  CAST(d - to_days(CAST(isodow(d) - 1 AS INTEGER)) AS TIMESTAMP) AS week_start_date,
  CAST(day(d) AS BIGINT) AS day_of_month, CAST(isodow(d) AS BIGINT) AS day_of_week,
  dayname(d) AS day_name, left(dayname(d), 3) AS day_name_short,
  isodow(d) > 5 AS is_weekend, CAST(year(d) AS BIGINT) AS fiscal_year,
  d = DATE '2026-01-25' AS is_today,
  d >= DATE '2026-01-01' AND d <= DATE '2026-01-25' AS is_current_month,
  d >= DATE '2026-01-01' AND d <= DATE '2026-01-25' AS is_current_year,
  coalesce(n, 0) AS flights
FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY))
        AS DATE) AS d)
LEFT JOIN (SELECT CAST(fday AS DATE) AS fd, count(*) AS n FROM flights GROUP BY 1) ON fd = d"""

# ---------------------------------------------------------------- marts

_DELAYS = """
    round(avg(late) FILTER (WHERE flown), 2) AS avg_delay_minutes,
    round(min(late) FILTER (WHERE flown), 2) AS min_delay_minutes,
    round(max(late) FILTER (WHERE flown), 2) AS max_delay_minutes,
    round(quantile_cont(late, 0.5) FILTER (WHERE flown), 2) AS median_delay_minutes,
    count(*) FILTER (WHERE domestic AND NOT deleted) AS domestic_flights,
    count(*) FILTER (WHERE NOT domestic AND NOT deleted) AS international_flights"""

AIRLINE_MART = f"""airline_cells AS (
  SELECT airline AS airline_iata, fday, kind AS flight_type,
    domestic AS is_domestic,
    count(*) FILTER (WHERE NOT deleted) AS total_flights,
    count(*) FILTER (WHERE flown AND late >= 0 AND late < 15) AS on_time_flights,
    count(*) FILTER (WHERE flown AND late >= 15) AS delayed_flights,
    count(*) FILTER (WHERE flown AND late < 0) AS early_flights,
    count(*) FILTER (WHERE cancelled) AS cancelled_flights,
    count(*) FILTER (WHERE flown) AS completed_flights, {_DELAYS}
  FROM flights WHERE airline IS NOT NULL AND fday IS NOT NULL
  GROUP BY airline, fday, kind, domestic
),
airline_mart AS (
  SELECT {key('airline_iata', 'fday', 'flight_type', 'is_domestic')} AS airline_punctuality_key,
    * EXCLUDE (fday), {PERIODS},
    {pct('on_time_flights', 'completed_flights')} AS on_time_percentage,
    {pct('delayed_flights', 'completed_flights')} AS delayed_percentage,
    {pct('early_flights', 'completed_flights')} AS early_percentage,
    {pct('cancelled_flights', 'total_flights')} AS cancelled_percentage
  FROM airline_cells
  JOIN (SELECT DISTINCT airline AS airline_iata, airline_name FROM flights) USING (airline_iata)
)"""

AIRPORT_MART = f"""airport_cells AS (
  SELECT home AS airport_iata, fday, kind AS flight_type, domestic AS is_domestic,
    count(*) FILTER (WHERE NOT deleted) AS total_flights,
    count(*) FILTER (WHERE cancelled) AS cancelled_flights,
    count(*) FILTER (WHERE flown) AS completed_flights,
    count(*) FILTER (WHERE flown AND late < 0) AS ahead_of_schedule_flights,
    count(*) FILTER (WHERE flown AND late <= 15) AS on_time_flights,
    count(*) FILTER (WHERE flown AND late > 15) AS delayed_flights, {_DELAYS}
  FROM flights WHERE home IN {LISTED} AND fday IS NOT NULL
  GROUP BY home, fday, kind, domestic
),
airport_mart AS (
  SELECT {key('airport_iata', 'fday', 'flight_type', 'is_domestic')} AS punctuality_key,
    * EXCLUDE (fday), {PERIODS},
    {pct('cancelled_flights', 'total_flights')} AS cancelled_percentage,
    {pct('ahead_of_schedule_flights', 'completed_flights')} AS ahead_of_schedule_percentage,
    {pct('on_time_flights', 'completed_flights')} AS on_time_percentage,
    {pct('delayed_flights', 'completed_flights')} AS delayed_percentage,
    {pct('completed_flights', 'total_flights')} AS completion_rate
  FROM airport_cells
)"""

HOURLY_MART = f"""hourly_mart AS (
  SELECT {key('home', 'fday', 'hh', 'kind')} AS hourly_traffic_key,
    home AS airport_iata, {PERIODS},
    hh AS flight_hour, day_part AS flight_time_period, kind AS flight_type,
    count(*) FILTER (WHERE NOT deleted) AS flight_count,
    count(*) FILTER (WHERE domestic AND NOT deleted) AS domestic_flights,
    count(*) FILTER (WHERE NOT domestic AND NOT deleted) AS international_flights,
    count(DISTINCT coalesce(airline, '?')) AS unique_airlines,
    round(avg(late) FILTER (WHERE flown), 2) AS avg_delay_minutes,
    count(*) FILTER (WHERE punctual AND flown) AS on_time_flights,
    count(*) FILTER (WHERE flown) AS completed_flights
  FROM flights WHERE home IN {LISTED} AND fday IS NOT NULL
  GROUP BY home, fday, hh, day_part, kind
)"""

BAGGAGE_MART = f"""baggage_mart AS (
  SELECT {key('home', 'carousel', 'fday', 'domestic', 'hh', 'dow')} AS baggage_performance_key,
    home AS airport_iata, carousel AS baggage_claim_unit, domestic AS is_domestic, {PERIODS},
    hh AS flight_hour, day_part AS flight_time_period, dow AS flight_day_of_week,
    dow_name AS flight_day_name,
    count(handling) AS flights_with_baggage_data, count(*) AS total_arrivals,
    round(avg(handling), 2) AS avg_baggage_handling_minutes,
    round(quantile_cont(handling, 0.5), 2) AS median_baggage_handling_minutes,
    round(min(handling), 2) AS min_baggage_handling_minutes,
    round(max(handling), 2) AS max_baggage_handling_minutes,
    round(quantile_cont(handling, 0.9), 2) AS p90_baggage_handling_minutes,
    round(quantile_cont(handling, 0.95), 2) AS p95_baggage_handling_minutes,
    round(avg(late) FILTER (WHERE handling IS NOT NULL), 2) AS avg_flight_delay_minutes,
    round(quantile_cont(late, 0.5) FILTER (WHERE handling IS NOT NULL), 2)
      AS median_flight_delay_minutes
  FROM flights WHERE kind = 'arrival' AND carousel IS NOT NULL
    AND home IN {LISTED} AND fday IS NOT NULL
  GROUP BY home, carousel, domestic, fday, hh, day_part, dow, dow_name
)"""

ROUTE_MART = f"""route_mart AS (
  SELECT {key('home', "orig || '-' || dest", 'fday', 'kind')} AS route_popularity_key,
    home AS airport_iata, orig || '-' || dest AS route_key, orig AS origin_airport_iata,
    dest AS destination_airport_iata, away AS other_airport_iata, kind AS flight_type,
    domestic AS is_domestic, {PERIODS},
    count(*) FILTER (WHERE NOT deleted) AS flight_count,
    count(DISTINCT coalesce(airline, '?')) AS unique_airlines,
    count(*) FILTER (WHERE cancelled) AS cancelled_flights
  FROM flights WHERE away IN {LISTED} AND home IN {LISTED} AND fday IS NOT NULL
  GROUP BY home, away, orig, dest, kind, domestic, fday
)"""

# ---------------------------------------------------------------- exploration

_ARR = "legs WHERE kind = 'arrival'"
_ARR_KEPT = "legs WHERE kind = 'arrival' AND status <> 'DEL'"
_ROUTES = f"""SELECT orig, dest, 'Airport ' || orig AS orig_name, count(*) AS n
  FROM {_ARR_KEPT} GROUP BY orig, dest ORDER BY n DESC, orig, dest LIMIT 20"""

EXPLORE = {
    "row_counts": """SELECT 'flights_' || kind || 's_raw' AS table_name, count(*) AS row_count
FROM legs GROUP BY kind""",
    "sample_arrivals": f"""SELECT * FROM ({_RAW_ARRIVALS})
ORDER BY flight_id, arrival_time__scheduled_utc, _dlt_load_id, _dlt_id LIMIT 5""",
    "sample_departures": f"""SELECT * FROM ({_RAW_DEPARTURES})
ORDER BY flight_id, departure_time__scheduled_utc, _dlt_load_id, _dlt_id LIMIT 5""",
    "status_distribution": f"SELECT status, count(*) AS count FROM {_ARR} GROUP BY status",
    "flights_per_hour": f"""SELECT time_bucket(INTERVAL 1 HOUR, sched) AS arrival_hour,
  count(*) AS flight_count, status FROM {_ARR_KEPT} GROUP BY 1, 3""",
    "flights_per_period": f"""SELECT CASE WHEN hour(sched) BETWEEN 6 AND 11 THEN 'Morning (06:00-11:59)'
         WHEN hour(sched) BETWEEN 12 AND 16 THEN 'Midday/Afternoon (12:00-16:59)'
         WHEN hour(sched) BETWEEN 17 AND 21 THEN 'Evening (17:00-21:59)'
         ELSE 'Night/Red-eye (22:00-05:59)' END AS time_period, count(*) AS flight_count
FROM {_ARR_KEPT} GROUP BY 1""",
    "delay_per_flight": f"""SELECT fid AS flight_id, sched AS arrival_time__scheduled_utc,
  actual AS arrival_time__actual_utc,
  (epoch_us(actual) - epoch_us(sched)) / 60000000.0::DOUBLE AS delay_minutes
FROM {_ARR} AND status = 'LAN' AND actual IS NOT NULL""",
    "top_airlines": f"""SELECT airline_name AS airline, airline AS iata_code,
  count(*) AS flight_count FROM {_ARR_KEPT} GROUP BY 1, 2
ORDER BY flight_count DESC, airline NULLS FIRST LIMIT 30""",
    "airline_delays": f"""SELECT airline_name AS airline, count(*) AS landed_flights,
  round(avg(m), 2) AS avg_delay_minutes, round(min(m), 2) AS best_early_minutes,
  round(max(m), 2) AS worst_late_minutes
FROM (SELECT airline_name, (epoch_us(actual) - epoch_us(sched)) / 60000000.0::DOUBLE AS m
      FROM {_ARR} AND status = 'LAN' AND actual IS NOT NULL)
GROUP BY airline_name HAVING count(*) > 2""",
    "top_routes": f"""SELECT orig AS origin, dest AS destination, orig_name AS origin_name,
  n AS flight_count FROM ({_ROUTES})""",
    "top_routes_named": f"""SELECT orig AS origin_code, orig_name AS origin_name,
  dest AS destination_code, name AS destination_name, n AS flight_count
FROM ({_ROUTES}) LEFT JOIN names ON iata = dest""",
    "top_routes_by_type": f"""SELECT orig AS origin_code, orig_name AS origin_name,
  dest AS destination_code, name AS destination_name,
  CASE WHEN orig IN {LISTED} THEN 'Domestic' ELSE 'International' END AS route_type,
  n AS flight_count
FROM ({_ROUTES}) LEFT JOIN names ON iata = dest""",
    "domestic_share": f"""SELECT route_type, n AS total_flights, {share('n')} AS percentage FROM (
  SELECT CASE WHEN orig IN {LISTED} THEN 'Domestic' ELSE 'International' END AS route_type,
    count(*) AS n FROM {_ARR_KEPT} GROUP BY 1)""",
    "arrival_share": f"""SELECT iata AS airport_code, name AS airport_name, n AS total_arrivals,
  {share('n')} AS percentage_of_traffic
FROM names JOIN (SELECT dest, count(*) AS n FROM {_ARR_KEPT} GROUP BY dest) ON dest = iata""",
    "movement_share": f"""SELECT airport_code, airport_name, arrivals, departures,
  arrivals + departures AS total_movements,
  {share('(arrivals + departures)')} AS percentage_of_total
FROM (SELECT iata AS airport_code, name AS airport_name,
    (SELECT count(*) FROM {_ARR_KEPT} AND dest = iata) AS arrivals,
    (SELECT count(*) FROM legs WHERE kind = 'departure' AND status <> 'DEL' AND orig = iata)
      AS departures
  FROM names)""",
    "weekday_distribution": f"""SELECT day_of_week, day_number, n AS flight_count,
  {share('n')} AS percentage
FROM (SELECT dayname(sched) AS day_of_week, CAST(isodow(sched) AS BIGINT) AS day_number,
    count(*) AS n FROM {_ARR_KEPT} GROUP BY 1, 2)""",
    "completeness": f"""SELECT count(*) AS total_rows, count(fid) AS has_flight_id,
  count(sched) AS has_scheduled, count(actual) AS has_actual, count(status) AS has_status,
  count(airline_name) AS has_airline, count(orig) AS has_origin, count(dest) AS has_destination
FROM {_ARR}""",
}

# ---------------------------------------------------------------- dashboard questions

_JANUARY = "flight_month = TIMESTAMP '2026-01-01'"


def _total(*names: str) -> str:
    return ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in names)


def _trend(period: str) -> str:
    return f"""SELECT *, {pct('on_time_flights', 'completed_flights')} AS on_time_percentage,
  {pct('cancelled_flights', 'total_flights')} AS cancelled_percentage
FROM (SELECT {period}, {_total('total_flights', 'cancelled_flights', 'completed_flights',
                               'on_time_flights')}
      FROM airport_mart GROUP BY {period})"""


def _worst(mart: str, by: str) -> str:
    return f"""SELECT {by}, completed_flights, delayed_flights, avg_delay_minutes,
  {pct('delayed_flights', 'completed_flights')} AS delayed_percentage
FROM (SELECT {by}, {_total('completed_flights', 'delayed_flights')},
        round(CAST(sum(CAST(round(avg_delay_minutes * 100) AS BIGINT) * completed_flights) AS DOUBLE)
          / sum(completed_flights)) / 100 AS avg_delay_minutes
      FROM {mart} WHERE {_JANUARY} GROUP BY {by} HAVING sum(completed_flights) > 0)
ORDER BY avg_delay_minutes DESC, {by} LIMIT 5"""


SERVE = {
    "peak_hours": (HOURLY_MART, f"""SELECT flight_hour, flight_time_period,
  {_total('flight_count', 'domestic_flights', 'international_flights')}
FROM hourly_mart WHERE airport_iata = 'ARN' AND flight_type = 'arrival' AND {_JANUARY}
GROUP BY flight_hour, flight_time_period"""),
    "domestic_comparison": (AIRPORT_MART, f"""SELECT *,
  {pct('on_time_flights', 'completed_flights')} AS on_time_percentage,
  {pct('delayed_flights', 'completed_flights')} AS delayed_percentage,
  {pct('cancelled_flights', 'total_flights')} AS cancelled_percentage,
  {pct('completed_flights', 'total_flights')} AS completion_rate
FROM (SELECT is_domestic, {_total('total_flights', 'cancelled_flights', 'completed_flights',
                                  'ahead_of_schedule_flights', 'on_time_flights',
                                  'delayed_flights')}
      FROM airport_mart WHERE airport_iata = 'GOT' AND flight_year = 2026 AND week_number = 4
      GROUP BY is_domestic)"""),
    "airline_comparison": (AIRLINE_MART, f"""SELECT *,
  {pct('on_time_flights', 'completed_flights')} AS on_time_percentage,
  {pct('delayed_flights', 'completed_flights')} AS delayed_percentage,
  {pct('early_flights', 'completed_flights')} AS early_percentage,
  {pct('cancelled_flights', 'total_flights')} AS cancelled_percentage
FROM (SELECT airline_iata, airline_name, {_total('total_flights', 'on_time_flights',
                                                 'delayed_flights', 'early_flights',
                                                 'cancelled_flights', 'completed_flights')}
      FROM airline_mart WHERE airline_iata IN ('SK', 'DY') AND {_JANUARY}
      GROUP BY airline_iata, airline_name)"""),
    "top_routes": (ROUTE_MART, f"""SELECT route_key, other_airport_iata,
  {_total('flight_count', 'cancelled_flights')}
FROM route_mart WHERE airport_iata = 'ARN' AND flight_type = 'departure' AND {_JANUARY}
GROUP BY route_key, other_airport_iata ORDER BY sum(flight_count) DESC, route_key LIMIT 10"""),
    "slowest_carousels": (BAGGAGE_MART, """SELECT baggage_claim_unit,
  CAST(sum(flights_with_baggage_data) AS BIGINT) AS flights,
  round(CAST(sum(CAST(round(avg_baggage_handling_minutes * 100) AS BIGINT)
      * flights_with_baggage_data) AS DOUBLE)
    / sum(flights_with_baggage_data)) / 100 AS avg_baggage_handling_minutes
FROM baggage_mart WHERE airport_iata = 'ARN' AND flight_day_of_week = 7
GROUP BY baggage_claim_unit HAVING sum(flights_with_baggage_data) > 0
ORDER BY avg_baggage_handling_minutes DESC, baggage_claim_unit LIMIT 3"""),
    "traffic_share": (HOURLY_MART, f"""SELECT airport_iata, flight_count,
  {share('flight_count')} AS percentage_of_traffic
FROM (SELECT airport_iata, {_total('flight_count')} FROM hourly_mart GROUP BY airport_iata)"""),
    "worst_airports": (AIRPORT_MART, _worst("airport_mart", "airport_iata")),
    "worst_airlines": (AIRLINE_MART, _worst("airline_mart", "airline_iata, airline_name")),
    "airline_routes": (AIRPORT_MART, """SELECT airline_iata, airline_name, route_key, flight_count
FROM (SELECT airline AS airline_iata, orig || '-' || dest AS route_key, count(*) AS flight_count
      FROM flights WHERE NOT deleted AND orig IS NOT NULL AND dest IS NOT NULL GROUP BY 1, 2)
JOIN (SELECT DISTINCT airline AS airline_iata, airline_name FROM flights) USING (airline_iata)
WHERE airline_iata IN ('SK', 'W6')
ORDER BY flight_count DESC, airline_iata, airline_name, route_key LIMIT 12"""),
    "route_trend": (ROUTE_MART, f"""SELECT flight_week, count(DISTINCT route_key) AS routes,
  {_total('flight_count', 'cancelled_flights')}
FROM route_mart WHERE airport_iata = 'ARN' GROUP BY flight_week"""),
    "weekly_trend": (AIRPORT_MART, _trend("flight_week")),
    "monthly_trend": (AIRPORT_MART, _trend("flight_month")),
}

# ---------------------------------------------------------------- quality checks

_ALL_MARTS = ",\n".join([AIRLINE_MART, AIRPORT_MART, HOURLY_MART, BAGGAGE_MART, ROUTE_MART])
_TABLES = {
    "stg_flights_arrivals": _STG_ARRIVALS,
    "stg_flights_departures": _STG_DEPARTURES,
    "int_flights": _INT_FLIGHTS,
    "fct_flights": _FACT,
    "dim_airline": _DIM_AIRLINE,
    "dim_airport": f"SELECT {key('iata')} AS airport_key, iata AS airport_iata FROM names",
    "dim_date": f"SELECT date_day, date_key FROM ({_DIM_DATE_TRAFFIC})",
    "mart_airport_hourly_traffic": "SELECT * FROM hourly_mart",
    "mart_airport_punctuality": "SELECT * FROM airport_mart",
    "mart_airline_punctuality": "SELECT * FROM airline_mart",
    "mart_route_popularity": "SELECT * FROM route_mart",
    "mart_baggage_performance": "SELECT * FROM baggage_mart",
}
_STAGED = "flight_id origin_airport_iata destination_airport_iata flight_status route_key"
# Columns under check, and what they may hold.
_FILLED = {
    "stg_flights_arrivals": f"{_STAGED} scheduled_arrival_utc",
    "stg_flights_departures": f"{_STAGED} scheduled_departure_utc",
    "int_flights": "flight_type",
    "fct_flights": "flight_key airline_key origin_airport_key dest_airport_key flight_date_key",
    "dim_airline": "airline_key airline_iata",
    "dim_airport": "airport_key airport_iata",
    "dim_date": "date_key date_day",
    "mart_airport_hourly_traffic": "hourly_traffic_key airport_iata",
    "mart_airport_punctuality": "punctuality_key airport_iata",
    "mart_airline_punctuality": "airline_punctuality_key airline_iata",
    "mart_route_popularity": "route_popularity_key airport_iata",
    "mart_baggage_performance": "baggage_performance_key airport_iata",
}
_UNIQUE = {
    "fct_flights": "flight_key",
    "dim_airline": "airline_key airline_iata",
    "dim_airport": "airport_key airport_iata",
    "dim_date": "date_key date_day",
    "mart_airport_hourly_traffic": "hourly_traffic_key",
    "mart_airport_punctuality": "punctuality_key",
    "mart_airline_punctuality": "airline_punctuality_key",
    "mart_route_popularity": "route_popularity_key",
    "mart_baggage_performance": "baggage_performance_key",
}
_STATUSES = "('SCH','FPL','FLS','SEQ','ACT','CAN','LAN','RER','DIV','DEL')"
_KINDS = "('arrival','departure')"
_ALLOWED = [
    ("stg_flights_arrivals", "destination_airport_iata", LISTED),
    ("stg_flights_arrivals", "flight_status", _STATUSES),
    ("stg_flights_departures", "origin_airport_iata", LISTED),
    ("stg_flights_departures", "flight_status", _STATUSES),
    ("int_flights", "flight_type", _KINDS),
    ("fct_flights", "flight_type", _KINDS),
]


def _check(table: str, column: str, name: str, failing: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name,
  '{name}' AS check_name, ({failing}) AS failing_rows"""


def _quality(checks: list[str]) -> str:
    tables = ",\n".join(f"t_{name} AS ({body})" for name, body in _TABLES.items())
    ctes = f"{FLIGHTS},\n{_AIRPORT_NAMES},\n{_ALL_MARTS},\n{tables}"
    return with_(ctes, "\nUNION ALL\n".join(checks))


def _quality_queries() -> dict[str, str]:
    not_null = [
        _check(t, c, "not_null", f"SELECT count(*) FROM t_{t} WHERE {c} IS NULL")
        for t, columns in _FILLED.items()
        for c in columns.split()
    ]
    unique = [
        _check(t, c, "unique", f"""SELECT count(*) FROM (
  SELECT {c} FROM t_{t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)""")
        for t, columns in _UNIQUE.items()
        for c in columns.split()
    ]
    accepted = [
        _check(t, c, "accepted_values", f"SELECT count(*) FROM t_{t} WHERE {c} NOT IN {values}")
        for t, c, values in _ALLOWED
    ]
    return {
        "quality_not_null": _quality(not_null),
        "quality_unique": _quality(unique),
        "quality_accepted_values": _quality(accepted),
    }


# ---------------------------------------------------------------- longer periods

_LATE_STATS = """
    round(avg(late) FILTER (WHERE flown), 2) AS avg_delay_minutes,
    round(min(late) FILTER (WHERE flown), 2) AS min_delay_minutes,
    round(max(late) FILTER (WHERE flown), 2) AS max_delay_minutes,
    round(quantile_cont(late, 0.5) FILTER (WHERE flown), 2) AS median_delay_minutes,
    round(quantile_cont(late, 0.9) FILTER (WHERE flown), 2) AS p90_delay_minutes"""


def _since(period: str) -> str:
    return f"CAST(date_trunc('{period}', fday) AS TIMESTAMP) AS period_start"


def _airport_period(period: str) -> str:
    return f"""SELECT *,
  {pct('on_time_flights', 'completed_flights')} AS on_time_percentage,
  {pct('cancelled_flights', 'total_flights')} AS cancelled_percentage,
  {pct('completed_flights', 'total_flights')} AS completion_rate
FROM (SELECT home AS airport_iata, {_since(period)}, kind AS flight_type, domestic AS is_domestic,
    count(*) FILTER (WHERE NOT deleted) AS total_flights,
    count(*) FILTER (WHERE cancelled) AS cancelled_flights,
    count(*) FILTER (WHERE flown) AS completed_flights,
    count(*) FILTER (WHERE flown AND late < 0) AS ahead_of_schedule_flights,
    count(*) FILTER (WHERE flown AND late <= 15) AS on_time_flights,
    count(*) FILTER (WHERE flown AND late > 15) AS delayed_flights, {_LATE_STATS}
  FROM flights WHERE home IN {LISTED} AND fday IS NOT NULL GROUP BY ALL)"""


def _distinct_airlines(columns: str, period: str, where: str) -> str:
    return f"""SELECT {columns}, {_since(period)},
  count(DISTINCT coalesce(airline, '?')) AS unique_airlines
FROM flights WHERE {where} AND fday IS NOT NULL GROUP BY ALL"""


_AT_LISTED = f"home IN {LISTED}"
_BOTH_LISTED = f"home IN {LISTED} AND away IN {LISTED}"

PERIOD_TWINS = {
    "airport_punctuality_quarter": _airport_period("quarter"),
    "airport_punctuality_year": _airport_period("year"),
    "airline_punctuality_year": f"""SELECT *,
  {pct('on_time_flights', 'completed_flights')} AS on_time_percentage,
  {pct('cancelled_flights', 'total_flights')} AS cancelled_percentage
FROM (SELECT airline AS airline_iata, {_since('year')}, kind AS flight_type, domestic AS is_domestic,
    count(*) FILTER (WHERE NOT deleted) AS total_flights,
    count(*) FILTER (WHERE cancelled) AS cancelled_flights,
    count(*) FILTER (WHERE flown) AS completed_flights,
    count(*) FILTER (WHERE flown AND late < 0) AS early_flights,
    count(*) FILTER (WHERE flown AND late >= 0 AND late < 15) AS on_time_flights,
    count(*) FILTER (WHERE flown AND late >= 15) AS delayed_flights, {_LATE_STATS}
  FROM flights WHERE airline IS NOT NULL AND fday IS NOT NULL GROUP BY ALL)""",
    "baggage_month": f"""SELECT home AS airport_iata, carousel AS baggage_claim_unit, {_since('month')},
  domestic AS is_domestic, count(handling) AS flights_with_baggage_data, count(*) AS total_arrivals,
  round(avg(handling), 2) AS avg_baggage_handling_minutes,
  round(quantile_cont(handling, 0.5), 2) AS median_baggage_handling_minutes,
  round(quantile_cont(handling, 0.9), 2) AS p90_baggage_handling_minutes,
  round(quantile_cont(handling, 0.95), 2) AS p95_baggage_handling_minutes,
  round(quantile_cont(late, 0.5) FILTER (WHERE handling IS NOT NULL), 2) AS median_flight_delay_minutes
FROM flights WHERE kind = 'arrival' AND carousel IS NOT NULL AND home IN {LISTED} AND fday IS NOT NULL
GROUP BY ALL""",
    "hourly_airlines_month": _distinct_airlines(
        "home AS airport_iata, hh AS flight_hour, kind AS flight_type", "month", _AT_LISTED
    ),
    "airport_airlines_year": _distinct_airlines("home AS airport_iata", "year", _AT_LISTED),
    "route_airlines_year": _distinct_airlines(
        "orig || '-' || dest AS route_key, kind AS flight_type", "year", _BOTH_LISTED
    ),
}

# ---------------------------------------------------------------- star joins

# Easter by the rule of remainders that holds from 1900 to 2099.
_HOLIDAYS = """
easters AS (
  SELECT y, d, e, CAST(make_date(y, 3, 22) + to_days(CAST(d + e
      - CASE WHEN d = 29 AND e = 6 OR d = 28 AND e = 6 AND y % 19 > 10 THEN 7 ELSE 0 END AS INTEGER)) AS DATE) AS easter
  FROM (SELECT y, d, (2 * (y % 4) + 4 * (y % 7) + 6 * d + 5) % 7 AS e
        FROM (SELECT y, (19 * (y % 19) + 24) % 30 AS d FROM range(2020, 2031) AS r(y)))
),
feasts AS (
  SELECT make_date(y, 1, 1) AS day, 'New Year''s Day' AS feast FROM easters
  UNION ALL SELECT make_date(y, 1, 6), 'Epiphany' FROM easters
  UNION ALL SELECT make_date(y, 5, 1), 'May Day' FROM easters
  UNION ALL SELECT make_date(y, 6, 6), 'National Day' FROM easters
  UNION ALL SELECT make_date(y, 12, 25), 'Christmas Day' FROM easters
  UNION ALL SELECT make_date(y, 12, 26), 'Second Day of Christmas' FROM easters
  UNION ALL SELECT easter - 2, 'Good Friday' FROM easters
  UNION ALL SELECT easter, 'Easter Sunday' FROM easters
  UNION ALL SELECT easter + 1, 'Easter Monday' FROM easters
  UNION ALL SELECT easter + 39, 'Ascension Day' FROM easters
  UNION ALL SELECT easter + 49, 'Whit Sunday' FROM easters
  UNION ALL SELECT make_date(y, 6, 20) + CAST((13 - isodow(make_date(y, 6, 20))) % 7 AS INTEGER), 'Midsummer Day' FROM easters
  UNION ALL SELECT make_date(y, 10, 31) + CAST((13 - isodow(make_date(y, 10, 31))) % 7 AS INTEGER), 'All Saints'' Day' FROM easters
),
holidays AS (SELECT day, min(feast) AS holiday_name FROM feasts GROUP BY day),
busy AS (
  SELECT home, iata_name, CAST(fday AS DATE) AS day, count(*) AS n
  FROM flights JOIN (SELECT iata, name AS iata_name FROM names) ON iata = home
  WHERE NOT deleted AND year(fday) = 2026 GROUP BY ALL
),
plain_days AS (
  SELECT home, month(day) AS m, isodow(day) AS w, round(avg(n), 2) AS usual
  FROM busy WHERE day NOT IN (SELECT day FROM holidays) GROUP BY ALL
)"""

STAR_TWINS = {
    "week_punctuality": """SELECT home AS airport_iata, name AS airport_name, dow AS day_of_week,
  dow_name AS day_name, kind AS flight_type, count(*) FILTER (WHERE NOT deleted) AS total_flights,
  count(*) FILTER (WHERE flown) AS completed_flights,
  round(avg(late) FILTER (WHERE flown), 2) AS avg_delay_minutes,
  round(CASE WHEN count(*) FILTER (WHERE flown) > 0 THEN
    count(*) FILTER (WHERE flown AND punctual) * 100.0::DOUBLE / count(*) FILTER (WHERE flown) END, 2)
    AS on_time_percentage
FROM flights JOIN names ON iata = home
WHERE year(fday) = 2026 AND weekofyear(fday) = 4 GROUP BY ALL""",
    "weekend_baggage": """SELECT home AS airport_iata, name AS airport_name,
  carousel AS baggage_claim_unit, fday AS date_day, CAST(weekofyear(fday) AS BIGINT) AS week_number,
  count(*) AS total_arrivals, count(handling) AS flights_with_baggage_data,
  round(avg(handling), 2) AS avg_baggage_handling_minutes
FROM flights JOIN names ON iata = home
WHERE kind = 'arrival' AND carousel IS NOT NULL AND year(fday) = 2026 AND month(fday) = 2 AND dow > 5
GROUP BY ALL""",
    "named_routes": """SELECT orig || '-' || dest AS route_key, o.name AS origin_airport_name,
  d.name AS destination_airport_name, count(*) FILTER (WHERE NOT deleted) AS flight_count,
  count(*) FILTER (WHERE cancelled) AS cancelled_flights,
  round(CASE WHEN count(*) FILTER (WHERE NOT deleted) > 0 THEN count(*) FILTER (WHERE cancelled)
    * 100.0::DOUBLE / count(*) FILTER (WHERE NOT deleted) END, 2) AS cancellation_ratio
FROM flights JOIN names o ON o.iata = orig JOIN names d ON d.iata = dest
WHERE year(fday) = 2026 AND quarter(fday) = 1 GROUP BY ALL""",
}
_HOLIDAY_TRAFFIC = """
SELECT b.home AS airport_iata, b.iata_name AS airport_name, h.holiday_name,
  CAST(b.day AS TIMESTAMP) AS date_day, b.n AS flight_count, p.usual AS usual_flights
FROM busy b JOIN holidays h ON h.day = b.day
LEFT JOIN plain_days p ON p.home = b.home AND p.m = month(b.day) AND p.w = isodow(b.day)"""

# ---------------------------------------------------------------- drift and history

_DRIFT = """
shaped AS (
  SELECT *, right(load_id, 1) = '0' AND right(fid, 1) = '7' AS timeless FROM legs WHERE kind = 'arrival'
)"""
# Declared path → what fills it; as JSON text leaves nulls out, a path is there if a value is.
_DECLARED = {
    "flightId": "fid", "flightLegIdentifier.flightId": "fid",
    "flightLegIdentifier.departureAirportIata": "orig", "flightLegIdentifier.arrivalAirportIata": "dest",
    "flightLegIdentifier.flightDepartureDateUtc": "sched", "airlineOperator.name": "airline_name",
    "airlineOperator.iata": "airline", "departureAirportSwedish": "orig", "departureAirportEnglish": "orig",
    "locationAndStatus.flightLegStatus": "status", "locationAndStatus.terminal": "terminal",
    "locationAndStatus.gate": "gate", "baggage.baggageClaimUnit": "carousel",
    "baggage.firstBagUtc": "bag_one", "baggage.lastBagUtc": "bag_last",
}
_OF_TIMES = {"arrivalTime.scheduledUtc": "sched", "arrivalTime.estimatedUtc": "NULL", "arrivalTime.actualUtc": "actual"}


def _drift_report() -> str:
    missing = [
        f"SELECT load_id, '{path}' AS path, CAST(NULL AS VARCHAR) AS observed_type, 'STRING' AS declared_type,"
        f" 'missing' AS status FROM shaped GROUP BY load_id HAVING count({filled}) = 0"
        for path, filled in _DECLARED.items()
    ]
    missing += [
        f"SELECT load_id, '{path}', NULL, 'STRING', 'missing' FROM shaped GROUP BY load_id"
        f" HAVING count({filled}) = 0 AND count(*) FILTER (WHERE timeless) = 0"
        for path, filled in _OF_TIMES.items()
    ]
    changed = [
        "SELECT DISTINCT load_id, 'locationAndStatus.terminal', 'BIGINT', 'STRING', 'retyped' FROM shaped"
        " WHERE right(load_id, 1) = '1'",
        "SELECT DISTINCT load_id, 'aircraft.type', 'STRING', NULL, 'added' FROM shaped WHERE right(load_id, 1) = '2'",
        "SELECT load_id, 'arrivalTime', CASE WHEN bool_and(timeless) THEN 'STRING' ELSE 'VARIANT' END, NULL,"
        " 'retyped' FROM shaped GROUP BY load_id HAVING bool_or(timeless)",
    ]
    return with_(f"{LEGS},{_DRIFT}", " UNION ALL ".join(missing + changed))


_DRIFT_TYPED = f"""SELECT * EXCLUDE (timeless, _dlt_id) REPLACE (
    CASE WHEN NOT timeless THEN arrival_time__scheduled_utc END AS arrival_time__scheduled_utc,
    CASE WHEN NOT timeless THEN arrival_time__actual_utc END AS arrival_time__actual_utc),
  CASE WHEN timeless THEN 'arrivalTime' ELSE '' END AS drifted
FROM ({_RAW_ARRIVALS.replace('SELECT', 'SELECT timeless,', 1).replace('FROM legs', 'FROM shaped')})"""

_HISTORY = """
per_load AS (
  SELECT airline, load_id, airline_name, count(*) AS n FROM legs WHERE airline IS NOT NULL
  GROUP BY airline, load_id, airline_name
  QUALIFY row_number() OVER (PARTITION BY airline, load_id ORDER BY n DESC, airline_name) = 1
),
runs AS (
  SELECT *, row_number() OVER (PARTITION BY airline ORDER BY load_id)
      - row_number() OVER (PARTITION BY airline, airline_name ORDER BY load_id) AS island FROM per_load
),
spans AS (
  SELECT airline, airline_name, min(load_id) AS valid_from FROM runs GROUP BY airline, airline_name, island
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY airline ORDER BY valid_from) AS period_no,
    lead(valid_from) OVER (PARTITION BY airline ORDER BY valid_from) AS valid_before FROM spans
)"""
_HISTORY_BODY = """SELECT n.airline AS airline_iata, n.airline_name, n.period_no, n.valid_from, n.valid_before,
  count(*) FILTER (WHERE NOT deleted) AS total_flights, count(*) FILTER (WHERE cancelled) AS cancelled_flights,
  count(late) AS completed_flights, round(avg(late), 2) AS avg_delay_minutes,
  round(CASE WHEN count(*) FILTER (WHERE NOT deleted) > 0 THEN count(*) FILTER (WHERE cancelled)
    * 100.0::DOUBLE / count(*) FILTER (WHERE NOT deleted) END, 2) AS cancelled_percentage
FROM flights f JOIN numbered n ON n.airline = f.airline AND f.load_id >= n.valid_from
  AND (n.valid_before IS NULL OR f.load_id < n.valid_before)
GROUP BY ALL"""


# Beside weather, alliances and the local clock.

_FIGURES = """count(*) FILTER (WHERE NOT deleted) AS total_flights,
  count(*) FILTER (WHERE cancelled) AS cancelled_flights, count(late) AS completed_flights,
  round(avg(late), 2) AS avg_delay_minutes,
  round(CASE WHEN count(late) > 0 THEN
    count(*) FILTER (WHERE flown AND punctual) * 100.0::DOUBLE / count(late) END, 2) AS on_time_percentage"""

_WEATHER = f"""
observed AS (
  SELECT {LISTED.replace('(', '[').replace(')', ']')}[user_id % 10 + 1] AS place,
    date_trunc('minute', ts) + INTERVAL 731 DAY AS seen_at, event_type AS sky, value AS wind
  FROM events
  QUALIFY row_number() OVER (PARTITION BY place, seen_at ORDER BY sky DESC NULLS LAST, wind DESC NULLS LAST) = 1
),
skies AS (
  SELECT f.*, CASE WHEN f.sched - o.seen_at <= INTERVAL 3 HOUR THEN o.sky END AS sky,
    CASE WHEN f.sched - o.seen_at <= INTERVAL 3 HOUR THEN o.wind END AS wind
  FROM flights f ASOF LEFT JOIN observed o ON o.place = f.home AND f.sched >= o.seen_at
  WHERE f.home IN {LISTED} AND f.sched IS NOT NULL
)"""

_MEMBERS = """
memberships AS (
  SELECT 'Group ' || CAST(1 + o_orderkey % 5 AS VARCHAR) AS alliance,
    ['SK','DY','FR','LH','AY','KL','BA','W6','FI','EW','D8'][o_custkey % 11 + 1] AS member,
    DATE '2025-12-20' + CAST(o_custkey % 80 AS INTEGER) AS since,
    CASE WHEN o_orderkey % 97 <> 0 THEN
      DATE '2025-12-20' + CAST(o_custkey % 80 AS INTEGER) + CAST(o_orderkey % 4 AS INTEGER) END AS before
  FROM orders
),
days AS (
  SELECT DISTINCT alliance, member, CAST(fday AS DATE) AS d FROM memberships
  JOIN (SELECT DISTINCT fday FROM flights) ON fday >= since AND (before IS NULL OR fday < before)
)"""

# Summer time from the last Sunday of March to that of October, at 01:00 UTC.
_LOCAL = f"""
clocks AS (
  SELECT *, make_timestamp(year(sched), 3, 31, 1, 0, 0)
      - to_days(CAST(isodow(make_date(year(sched), 3, 31)) % 7 AS INTEGER)) AS spring,
    make_timestamp(year(sched), 10, 31, 1, 0, 0)
      - to_days(CAST(isodow(make_date(year(sched), 10, 31)) % 7 AS INTEGER)) AS autumn
  FROM flights WHERE home IN {LISTED}
),
local_flights AS (
  SELECT *, CASE WHEN sched >= spring AND sched < autumn THEN 120 ELSE 60 END AS ahead,
    CASE WHEN actual >= spring AND actual < autumn THEN 120 ELSE 60 END AS moved_ahead,
    sched + to_minutes(ahead) AS wall, actual + to_minutes(moved_ahead) AS moved
  FROM clocks
)"""

SURROUNDED = {
    "weather_punctuality": (_WEATHER, f"""SELECT home AS airport_iata,
  coalesce(sky, 'unknown') AS condition, {_FIGURES} FROM skies GROUP BY 1, 2"""),
    "weather_strong_wind": (_WEATHER, f"""SELECT home AS airport_iata,
  CASE WHEN wind >= 20 THEN 'strong' WHEN wind < 20 THEN 'light' ELSE 'unknown' END AS wind_class,
  {_FIGURES} FROM skies GROUP BY 1, 2"""),
    "alliance_punctuality": (_MEMBERS, f"""SELECT alliance,
  CAST(date_trunc('month', fday) AS TIMESTAMP) AS flight_month, count(DISTINCT airline) AS airlines, {_FIGURES}
FROM flights JOIN days ON member = airline AND d = CAST(fday AS DATE) GROUP BY 1, 2"""),
    "local_hourly_traffic": (_LOCAL, f"""SELECT home AS airport_iata,
  CAST(date_trunc('day', wall) AS TIMESTAMP) AS local_date, CAST(hour(wall) AS BIGINT) AS local_hour,
  CAST(CASE WHEN sched >= autumn AND sched < autumn + INTERVAL 1 HOUR THEN 2 ELSE 1 END AS BIGINT) AS hour_pass,
  CAST(ahead AS BIGINT) AS utc_offset_minutes, kind AS flight_type, {_FIGURES}
FROM local_flights WHERE sched IS NOT NULL GROUP BY ALL"""),
    "local_night_movements": (_LOCAL, """SELECT home AS airport_iata,
  CAST(date_trunc('month', moved) AS TIMESTAMP) AS local_month, count(*) AS movements,
  count(*) FILTER (WHERE hour(moved) >= 22 OR hour(moved) <= 5) AS night_movements,
  round(count(*) FILTER (WHERE hour(moved) >= 22 OR hour(moved) <= 5) * 100.0::DOUBLE / count(*), 2)
    AS night_percentage
FROM local_flights WHERE flown AND NOT deleted AND NOT cancelled GROUP BY 1, 2"""),
}


def oracle_sql() -> dict[str, str]:
    named = f"{LEGS},\n{_AIRPORT_NAMES}"
    twins = {
        "raw_arrivals_from_payload": with_(
            LEGS, f"SELECT * EXCLUDE (_dlt_id) FROM ({_RAW_ARRIVALS})"
        ),
        "raw_departures_from_payload": with_(
            LEGS, f"SELECT * EXCLUDE (_dlt_id) FROM ({_RAW_DEPARTURES})"
        ),
        "raw_arrivals_stored": with_(LEGS, f"""SELECT *, '2026-01-25' AS load_date,
  strftime(arrival_time__scheduled_utc, '%Y-%m-%d') AS flight_day,
  arrival_time__scheduled_utc IS NOT NULL AS timed FROM ({_RAW_ARRIVALS})"""),
        "backfill_window": with_(LEGS, """SELECT strftime(sched, '%Y-%m-%d') AS date,
  home AS airport, kind || 's' AS direction, count(*) AS documents
FROM legs WHERE home IN ('ARN', 'GOT', 'UME')
  AND sched >= TIMESTAMP '2026-01-23' AND sched < TIMESTAMP '2026-01-26'
GROUP BY 1, 2, 3"""),
        "load_summary": with_(LEGS, """SELECT 'flights_' || kind || 's_raw' AS table_name,
  home AS airport, count(*) AS row_count FROM legs GROUP BY kind, home"""),
        "airports_loaded": with_(
            LEGS, "SELECT DISTINCT home AS airport FROM legs WHERE kind = 'arrival'"
        ),
        "stg_flights_arrivals": with_(FLIGHTS, _STG_ARRIVALS),
        "stg_flights_departures": with_(FLIGHTS, _STG_DEPARTURES),
        "int_flights": with_(FLIGHTS, _INT_FLIGHTS),
        "fct_flights": with_(FLIGHTS, _FACT),
        "fct_flights_stored": with_(FLIGHTS, _FACT),
        "dim_airline": with_(FLIGHTS, _DIM_AIRLINE),
        "dim_airport_traffic": with_(f"{FLIGHTS},\n{_AIRPORT_NAMES}", _DIM_AIRPORT_TRAFFIC),
        "dim_date_traffic": with_(FLIGHTS, _DIM_DATE_TRAFFIC),
    }
    for name, mart, table in [
        ("mart_airline_punctuality", AIRLINE_MART, "airline_mart"),
        ("mart_airport_hourly_traffic", HOURLY_MART, "hourly_mart"),
        ("mart_airport_punctuality", AIRPORT_MART, "airport_mart"),
        ("mart_baggage_performance", BAGGAGE_MART, "baggage_mart"),
        ("mart_route_popularity", ROUTE_MART, "route_mart"),
    ]:
        twins[name] = with_(f"{FLIGHTS},\n{mart}", f"SELECT * FROM {table}")
    for name, body in EXPLORE.items():
        twins[f"explore_{name}"] = with_(named, body)
    for name, (mart, body) in SERVE.items():
        twins[f"serve_{name}"] = with_(f"{FLIGHTS},\n{mart}", body)
    for name, body in PERIOD_TWINS.items():
        twins[f"period_{name}"] = with_(FLIGHTS, body)
    starred = f"{FLIGHTS},\n{_AIRPORT_NAMES}"
    for name, body in STAR_TWINS.items():
        twins[f"star_{name}"] = with_(starred, body)
    twins["star_holiday_traffic"] = with_(f"{starred},{_HOLIDAYS}", _HOLIDAY_TRAFFIC)
    twins["raw_arrivals_streamed"] = with_(LEGS, f"""SELECT * EXCLUDE (_dlt_load_id, _dlt_id),
  strftime(arrival_time__scheduled_utc, '%Y-%m-%d') AS flight_day,
  arrival_time__scheduled_utc IS NOT NULL AS timed FROM ({_RAW_ARRIVALS})""")
    twins["drift_report_arrivals"] = _drift_report()
    twins["drift_versions_arrivals"] = with_(f"{LEGS},{_DRIFT}", """SELECT
  row_number() OVER (ORDER BY load_id) AS version, load_id AS first_load, load_id AS last_load,
  CAST(1 AS BIGINT) AS loads, count(*) AS flights FROM shaped GROUP BY load_id""")
    twins["drift_typed_arrivals"] = with_(f"{LEGS},{_DRIFT}", _DRIFT_TYPED)
    twins["airline_history"] = with_(f"{FLIGHTS},{_HISTORY}", _HISTORY_BODY)
    twins["flights_by_load_date"] = with_(FLIGHTS, """SELECT
  CAST(date_trunc('day', TIMESTAMP '1970-01-01' + to_seconds(CAST(load_id AS BIGINT))) AS TIMESTAMP) AS data_load_date,
  kind AS flight_type, count(*) AS flights, count(*) FILTER (WHERE flown) AS completed_flights,
  count(*) FILTER (WHERE sched > TIMESTAMP '1970-01-01' + to_seconds(CAST(load_id AS BIGINT))) AS ahead_flights
FROM flights GROUP BY 1, 2""")
    for name, (ctes, body) in SURROUNDED.items():
        twins[name] = with_(f"{FLIGHTS},{ctes}", body)
    twins.update(_quality_queries())
    return twins
