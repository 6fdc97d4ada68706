"""The registered queries as SQL for an in-process checking engine (DuckDB dialect).

The first part states the derived tables of `plans.tables`, the second the queries.
"""

from __future__ import annotations

CLASSES = (
    "on_time",
    "delay_5min",
    "delay_15min",
    "delay_45min",
    "delay_over_45min",
    "delay_skipped",
    "delay_unknown",
)
DAY = "'%Y-%m-%d'"
SECOND = "'%Y-%m-%d %H:%M:%S'"


def _day(c: str) -> str:
    return f"strftime({c}, {DAY}) AS {c.split('.')[-1]}"


def _sec(c: str, name: str | None = None) -> str:
    return f"strftime({c}, {SECOND}) AS {name or c.split('.')[-1]}"


# --- derived tables -----------------------------------------------------------------------

TRIPS = """
trip_base AS (
  SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day,
         user_id * 37 % 960 + 300 + CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END AS dm,
         CAST(floor(value * 20) AS BIGINT) - 240 AS ds,
         NOT (event_type = 'signup' AND value < 25) AS known,
         isodow(ts) - 1 AS wd
  FROM events
),
trips AS (
  SELECT 'trip_' || event_id AS trip_id,
         'route_K' || route_no AS route_id,
         'K' || route_no AS route_short_name,
         CAST(user_id AS VARCHAR) AS trip_headsign,
         CASE WHEN user_id % 2 = 0 THEN 'Paris Nord' ELSE 'Compiègne' END AS departure_station_name,
         departure AS departure_time_scheduled,
         CASE WHEN known THEN departure + to_seconds(CAST(trunc(ds / 2.0) AS BIGINT)) END AS siri_departure_time_real,
         CAST(NULL AS VARCHAR) AS siri_departure_platform,
         CASE WHEN event_type = 'error' AND value < 15 THEN 'CANCELLED'
              WHEN event_type = 'click' THEN NULL ELSE 'NORMAL' END AS siri_departure_status,
         CASE WHEN user_id % 2 = 0 THEN 'Compiègne' ELSE 'Paris Nord' END AS arrival_station_name,
         arrival AS arrival_time_scheduled,
         CASE WHEN known THEN arrival + to_seconds(ds) END AS siri_arrival_time_real,
         CASE WHEN event_id % 3 = 0 THEN 'Hall ' || (event_id % 4) END AS siri_arrival_platform,
         CASE WHEN event_type = 'error' AND value >= 15 AND value < 25 THEN 'CANCELLED'
              ELSE 'NORMAL' END AS siri_arrival_status,
         CAST(NULL AS VARCHAR) AS siri_trip_status,
         CAST(day AS TIMESTAMP) + INTERVAL 203 MINUTE AS created_at,
         CASE WHEN known THEN arrival + to_seconds(ds) END AS siri_updated_at,
         day AS service_date
  FROM (
    SELECT *, CAST(day AS TIMESTAMP) + to_minutes(dm) AS departure,
           CAST(day AS TIMESTAMP) + to_minutes(dm + 50 + user_id % 31) AS arrival,
           (user_id + CASE user_id % 4 WHEN 1 THEN wd // 3 WHEN 2 THEN wd % 3
                                       WHEN 3 THEN (wd // 2) % 2 ELSE 0 END) % 7 AS route_no
    FROM trip_base
  )
)
"""

CLASSED = """
timed AS (
  SELECT *, date_diff('second', arrival_time_scheduled, siri_arrival_time_real) AS delay_seconds,
         coalesce(siri_departure_status, '') = 'CANCELLED'
           OR coalesce(siri_arrival_status, '') = 'CANCELLED' AS is_cancelled
  FROM trips
),
classed AS (
  SELECT *, CASE WHEN is_cancelled THEN 'delay_skipped'
                 WHEN delay_seconds IS NULL THEN 'delay_unknown'
                 WHEN delay_seconds / 60.0 <= 0 THEN 'on_time'
                 WHEN delay_seconds / 60.0 <= 5 THEN 'delay_5min'
                 WHEN delay_seconds / 60.0 <= 15 THEN 'delay_15min'
                 WHEN delay_seconds / 60.0 <= 45 THEN 'delay_45min'
                 ELSE 'delay_over_45min' END AS delay_class
  FROM timed
)
"""

COUNTS = "count(*) AS total_trains, " + ", ".join(
    f"CAST(sum(CASE WHEN delay_class = '{c}' THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in CLASSES
)
SUMS = "CAST(sum(total_trains) AS BIGINT) AS total_trains, " + ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}" for c in CLASSES
)
COUNT_NAMES = ", ".join(("total_trains", *CLASSES))
SHARES = ", ".join(
    f"CAST(floor(100 * {c} / total_trains) AS BIGINT) AS {c}_percentage" for c in CLASSES
)

MINUTES = "extract(hour FROM {b} - {a}) * 60 + extract(minute FROM {b} - {a})"
SCHEDULED_MINUTES = MINUTES.format(a="departure_time_scheduled", b="arrival_time_scheduled")
REAL_MINUTES = MINUTES.format(a="siri_departure_time_real", b="siri_arrival_time_real")

SEQ = "l_linenumber * 100000000000000000 + l_partkey * 1000000 + l_suppkey"

GTFS = f"""
calendar_dates AS (
  SELECT DISTINCT lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS service_id,
         strftime(DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER), '%Y%m%d') AS date,
         CASE WHEN o_orderkey % 10 = 0 THEN '2' ELSE '1' END AS exception_type
  FROM orders
),
gtfs_trips AS (
  SELECT o_orderpriority AS route_id, lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS service_id,
         CAST(o_orderkey AS VARCHAR) AS trip_id, CAST(o_orderkey // 100 AS VARCHAR) AS trip_headsign
  FROM orders
),
routes AS (
  SELECT DISTINCT o_orderpriority AS route_id, 'K0' || left(o_orderpriority, 1) AS route_short_name
  FROM orders WHERE o_orderpriority <> '5-LOW'
),
stop_times AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
         CASE WHEN l_partkey % 29 <> 0 THEN
           lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') || ':00'
           ELSE '' END AS arrival_time,
         CASE WHEN l_partkey % 31 <> 0 THEN
           lpad(CAST((m + 1) // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST((m + 1) % 60 AS VARCHAR), 2, '0') || ':00'
           ELSE '' END AS departure_time,
         'stop_' || (l_suppkey % 10) AS stop_id,
         position
  FROM (SELECT *, 300 + l_linenumber * 47 + l_orderkey % 1000 + CASE WHEN l_orderkey % 50 = 7 THEN 1440 ELSE 0 END AS m,
               {SEQ} AS position FROM lineitem)
),
services AS (
  SELECT DISTINCT service_id, CAST(strptime(date, '%Y%m%d') AS DATE) AS service_date
  FROM calendar_dates WHERE exception_type = '1'
)
"""


def _clock(text: str, day: str) -> str:
    """GTFS time text as a timestamp."""
    parts = f"string_split({text}, ':')"
    return (
        f"CASE WHEN {text} <> '' THEN CAST({day} AS TIMESTAMP)"
        f" + to_hours(CAST({parts}[1] AS INTEGER)) + to_minutes(CAST({parts}[2] AS INTEGER))"
        f" + to_seconds(CAST({parts}[3] AS INTEGER)) END"
    )


def _corridors(pairs: str) -> str:
    """Trips through both stops of each pair (name_a, stop_a, name_b, stop_b)."""
    return f"""
pairs(name_a, stop_a, name_b, stop_b) AS (VALUES {pairs}),
visits AS (
  SELECT trip_id, stop_id, min(position) AS first_pos,
         arg_max(departure_time, position) AS departure_time,
         arg_max(arrival_time, position) AS arrival_time
  FROM stop_times GROUP BY trip_id, stop_id
),
corridor AS (
  SELECT a.trip_id,
         CASE WHEN a.first_pos < b.first_pos THEN name_a ELSE name_b END AS departure_station_name,
         CASE WHEN a.first_pos < b.first_pos THEN name_b ELSE name_a END AS arrival_station_name,
         CASE WHEN a.first_pos < b.first_pos THEN a.departure_time ELSE b.departure_time END AS departure_time,
         CASE WHEN a.first_pos < b.first_pos THEN b.arrival_time ELSE a.arrival_time END AS arrival_time
  FROM pairs JOIN visits a ON a.stop_id = stop_a JOIN visits b ON b.stop_id = stop_b AND b.trip_id = a.trip_id
)
"""


MAIN_PAIR = "('Paris Nord', 'stop_1', 'Compiègne', 'stop_2')"
MANY_PAIRS = (
    MAIN_PAIR
    + ", ('Gare 3', 'stop_3', 'Gare 4', 'stop_4'), ('Compiègne', 'stop_2', 'Gare 5', 'stop_5')"
    + ", ('Gare 7', 'stop_7', 'Gare 9', 'stop_9'), ('Gare 0', 'stop_0', 'Gare 6', 'stop_6')"
)

SCHEDULE = (
    GTFS
    + ","
    + _corridors(MAIN_PAIR)
    + f""",
schedule AS (
  SELECT c.trip_id, t.route_id, coalesce(r.route_short_name, '') AS route_short_name,
         t.trip_headsign, departure_station_name, arrival_station_name, s.service_date,
         {_clock("departure_time", "s.service_date")} AS departure_time_scheduled,
         {_clock("arrival_time", "s.service_date")} AS arrival_time_scheduled
  FROM corridor c JOIN gtfs_trips t ON t.trip_id = c.trip_id
  JOIN services s ON s.service_id = t.service_id
  LEFT JOIN routes r ON r.route_id = t.route_id
)
"""
)


def _schedule_columns(created_at: str) -> str:
    return f"""trip_id, route_id, route_short_name, trip_headsign, departure_station_name,
         {_sec("departure_time_scheduled")}, arrival_station_name, {_sec("arrival_time_scheduled")},
         {created_at} AS created_at, CAST(NULL AS VARCHAR) AS siri_updated_at, {_day("service_date")}"""


def _iso(wall: str) -> str:
    return (
        "CASE WHEN l_partkey % 50 = 7 THEN 'soon'"
        f" WHEN l_orderkey % 3 = 0 THEN strftime({wall} - INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') || 'Z'"
        f" ELSE strftime({wall}, '%Y-%m-%dT%H:%M:%S') || '+01:00' END"
    )


def _read(wall: str) -> str:
    """What reading the feed text should give: all texts are winter times."""
    return f"CASE WHEN l_partkey % 50 <> 7 THEN {wall} END"


JOURNEYS = f"""
line_base AS (
  SELECT *, {SEQ} AS seq, l_orderkey || '-' || ({SEQ}) AS journey_ref,
         CASE WHEN (l_orderkey // 100 + l_orderkey % 30) % 11 = 0 THEN NULL
              WHEN l_orderkey % 97 = 1 THEN '' ELSE CAST(l_orderkey // 100 AS VARCHAR) END AS train_number,
         CASE WHEN l_partkey % 101 <> 0
              THEN DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) END AS journey_day,
         CASE l_partkey % 11 WHEN 0 THEN 'false' WHEN 1 THEN NULL ELSE 'true' END AS monitored,
         CASE l_suppkey % 7 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS prediction_inaccurate,
         CAST(DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS TIMESTAMP)
           + to_minutes(300 + l_orderkey % 960 + CAST(l_quantity AS INTEGER)) AS base,
         CAST(DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS TIMESTAMP)
           + to_minutes(300 + 2 * l_linenumber) AS polled_at,
         l_linestatus = 'F' AS recorded
  FROM lineitem
),
all_calls AS (
  SELECT journey_ref, seq, train_number, journey_day, polled_at, l_partkey, l_orderkey,
         CASE WHEN recorded THEN 'recorded' ELSE 'estimated' END AS call_kind,
         CASE WHEN recorded THEN 1 ELSE 0 END AS call_position,
         'S' || (l_suppkey % 10) AS stop,
         CASE WHEN l_returnflag = 'R' AND l_partkey % 2 = 0
              THEN CASE l_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'false' ELSE 'true' END END AS cancellation,
         CASE WHEN l_returnflag = 'A' AND l_partkey % 5 = 0 THEN 'true'
              WHEN l_returnflag = 'A' AND l_partkey % 5 = 1 THEN 'false' END AS inaccurate,
         CASE WHEN l_partkey % 3 <> 0 THEN base END AS departure_wall,
         CASE WHEN l_partkey % 4 <> 0 THEN base END AS arrival_wall,
         CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_partkey % 17 = 0 THEN ''
              ELSE 'Hall ' || (l_suppkey % 4) END AS departure_platform,
         CASE WHEN l_suppkey % 6 <> 0 THEN 'Voie ' || (l_partkey % 9) END AS arrival_platform
  FROM line_base
  UNION ALL
  SELECT journey_ref, seq, train_number, journey_day, polled_at, l_partkey, l_orderkey,
         'estimated', CASE WHEN recorded THEN 0 ELSE 1 END,
         CASE WHEN l_suppkey % 37 <> 0 THEN 'S' || (l_partkey % 10) END,
         CASE WHEN l_suppkey % 19 = 0 THEN '' END,
         CASE WHEN l_suppkey % 23 = 0 THEN 'true' END,
         CASE WHEN l_partkey % 3 <> 1 THEN base + INTERVAL 50 MINUTE END,
         CASE WHEN l_partkey % 4 <> 1 THEN base + INTERVAL 50 MINUTE END,
         CASE WHEN l_partkey % 2 <> 0 THEN 'Quai ' || (l_suppkey % 5) END,
         'Hall ' || (l_partkey % 3)
  FROM line_base
),
flags AS (
  SELECT journey_ref,
         arg_min(inaccurate, CASE call_kind WHEN 'recorded' THEN 0 ELSE 1 END * 10 + call_position)
           FILTER (WHERE inaccurate IS NOT NULL) AS call_flag
  FROM all_calls GROUP BY journey_ref
),
valid AS (
  SELECT b.*, CASE WHEN monitored = 'false' THEN 'UNMONITORED'
                   WHEN coalesce(prediction_inaccurate, call_flag) = 'true' THEN 'PREDICTION_INACCURATE'
                   ELSE 'NORMAL' END AS trip_status
  FROM line_base b JOIN flags f ON f.journey_ref = b.journey_ref
  WHERE train_number <> '' AND journey_day IS NOT NULL
),
calls AS (
  SELECT c.*, v.trip_status,
         CASE WHEN c.l_partkey % 50 <> 7 THEN departure_wall END AS expected_departure,
         CASE WHEN c.l_partkey % 50 <> 7 THEN arrival_wall END AS expected_arrival,
         nullif(coalesce(departure_platform, arrival_platform), '') AS platform,
         CASE WHEN cancellation IS NOT NULL THEN 'CANCELLED' WHEN inaccurate = 'true'
              THEN 'PREDICTION_INACCURATE' ELSE 'NORMAL' END AS call_status,
         CASE stop WHEN 'S1' THEN 'Paris Nord' WHEN 'S2' THEN 'Compiègne' END AS station_name
  FROM all_calls c JOIN valid v ON v.journey_ref = c.journey_ref
)
"""

STATION_FOLD = """
station_fold AS (
  SELECT * FROM calls WHERE station_name IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY journey_ref, station_name ORDER BY call_position DESC) = 1
)
"""

SLOTS = """
slots AS (
  SELECT trip_headsign, CAST(departure_time_scheduled AS DATE) AS departure_date,
         departure_station_name, arrival_station_name, count(*) AS n_trips
  FROM trips GROUP BY ALL
)
"""

UPDATES = """
update_log AS (
  SELECT s.trip_headsign, s.departure_date, s.departure_station_name, s.arrival_station_name, s.n_trips,
         d.expected_departure AS siri_departure_time_real, d.platform AS siri_departure_platform,
         d.call_status AS siri_departure_status,
         a.expected_arrival AS siri_arrival_time_real, a.platform AS siri_arrival_platform,
         a.call_status AS siri_arrival_status,
         v.trip_status AS siri_trip_status, v.polled_at AS siri_updated_at, v.seq
  FROM valid v
  JOIN slots s ON s.trip_headsign = v.train_number AND s.departure_date = v.journey_day
  LEFT JOIN station_fold d ON d.journey_ref = v.journey_ref AND d.station_name = s.departure_station_name
  LEFT JOIN station_fold a ON a.journey_ref = v.journey_ref AND a.station_name = s.arrival_station_name
)
"""

REALTIME = (
    "siri_departure_time_real",
    "siri_departure_platform",
    "siri_departure_status",
    "siri_arrival_time_real",
    "siri_arrival_platform",
    "siri_arrival_status",
    "siri_trip_status",
)
SLOT = "trip_headsign, departure_date, departure_station_name, arrival_station_name"


def _fold(name: str, source: str, keys: str) -> str:
    values = ",\n         ".join(
        f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in REALTIME
    )
    return f"""
{name} AS (
  SELECT {keys}, {values}, arg_max(siri_updated_at, seq) AS siri_updated_at, count(*) AS n_updates
  FROM {source} GROUP BY {keys}
)
"""


FOLD = _fold("folded", "update_log", SLOT)

UPSERTED = (
    """
upserted AS (
  SELECT t.trip_id, t.service_date, t.departure_time_scheduled,
         """
    + ", ".join(f"coalesce(f.{c}, t.{c}) AS {c}" for c in (*REALTIME, "siri_updated_at"))
    + """
  FROM trips t LEFT JOIN folded f
    ON f.trip_headsign = t.trip_headsign
   AND f.departure_date = CAST(t.departure_time_scheduled AS DATE)
   AND f.departure_station_name = t.departure_station_name
   AND f.arrival_station_name = t.arrival_station_name
)
"""
)


def _values() -> str:
    return ", ".join(_sec(c) if c.endswith(("_real", "_at")) else c for c in (*REALTIME, "siri_updated_at"))


ENTITIES = f"""
entity_given AS (
  SELECT l_orderkey || '-' || ({SEQ}) AS entity_id, 'trip_' || (l_orderkey % 5000) AS trip_id, l_partkey, l_suppkey,
         CASE WHEN l_suppkey % 5 <> 0 THEN DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) END AS start_date,
         CASE WHEN l_partkey % 13 = 0 THEN 'CANCELED' END AS trip_schedule_relationship,
         CASE WHEN l_partkey % 13 = 0 THEN 'SKIPPED' END AS stop_relationship,
         TIMESTAMP '2024-01-01 01:00:00' + to_days(CAST(l_orderkey % 30 AS INTEGER)) + to_minutes(l_orderkey % 1440)
           + to_minutes(CAST(l_quantity AS INTEGER)) AS base,
         CAST(l_quantity AS BIGINT) * 60 AS delay
  FROM lineitem
),
entity_timed AS (
  SELECT *, CASE WHEN l_partkey % 13 = 0 THEN NULL WHEN l_partkey % 4 <> 0 THEN base - INTERVAL 1 MINUTE
                 WHEN l_partkey % 3 <> 0 THEN base ELSE base + INTERVAL 49 MINUTE END AS first_time
  FROM entity_given
),
run_times AS (
  SELECT trip_id, service_date, min(departure_time_scheduled) AS departs, max(arrival_time_scheduled) AS arrives
  FROM runs GROUP BY 1, 2
),
nearest_run AS (
  SELECT entity_id, service_date
  FROM (SELECT entity_id, e.trip_id, r.service_date, departs,
               greatest(date_diff('second', first_time, departs), date_diff('second', arrives, first_time), 0) AS away
        FROM entity_timed e JOIN run_times r ON r.trip_id = e.trip_id
        WHERE start_date IS NULL AND first_time IS NOT NULL)
  WHERE away <= 43200
  QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY away, departs, service_date) = 1
),
entity_base AS (
  SELECT e.*, coalesce(start_date, n.service_date) AS service_date
  FROM entity_timed e LEFT JOIN nearest_run n ON n.entity_id = e.entity_id
),
entity_stops AS (
  SELECT entity_id, 0 AS stop_position, l_suppkey % 10 AS number,
         CASE WHEN l_partkey % 13 <> 0 AND l_partkey % 3 <> 0 THEN base END AS departure_time,
         CASE WHEN l_partkey % 13 <> 0 AND l_partkey % 3 <> 0 THEN delay END AS departure_delay,
         CASE WHEN l_partkey % 13 <> 0 AND l_partkey % 4 <> 0 THEN base - INTERVAL 1 MINUTE END AS arrival_time,
         CASE WHEN l_partkey % 13 <> 0 AND l_partkey % 4 <> 0 THEN delay END AS arrival_delay,
         stop_relationship
  FROM entity_base
  UNION ALL
  SELECT entity_id, 1, l_partkey % 10,
         CASE WHEN l_partkey % 13 <> 0 AND l_partkey % 3 <> 1 THEN base + INTERVAL 50 MINUTE END,
         CASE WHEN l_partkey % 13 <> 0 AND l_partkey % 3 <> 1 THEN delay END,
         CASE WHEN l_partkey % 13 <> 0 AND l_partkey % 4 <> 1 THEN base + INTERVAL 49 MINUTE END,
         CASE WHEN l_partkey % 13 <> 0 AND l_partkey % 4 <> 1 THEN delay END,
         stop_relationship
  FROM entity_base
),
entity_last AS (
  SELECT * FROM entity_stops WHERE number IN (1, 2)
  QUALIFY row_number() OVER (PARTITION BY entity_id, number ORDER BY stop_position DESC) = 1
)
"""


RUNS = """
runs AS (
  SELECT * EXCLUDE (number) REPLACE ('trip_' || number AS trip_id,
    departure_time_scheduled + to_hours(CASE WHEN number % 4 = 0 THEN 10 ELSE 0 END) AS departure_time_scheduled,
    arrival_time_scheduled + to_hours(CASE WHEN number % 4 = 0 THEN 10 ELSE 0 END) AS arrival_time_scheduled)
  FROM (SELECT *, CAST(substr(trip_id, 6) AS BIGINT) % 5000 AS number FROM trips)
)
"""
RT_LOG = """
rt_log AS (
  SELECT e.trip_id, t.service_date, CAST(t.departure_time_scheduled AS DATE) AS departure_date,
         CAST(split_part(e.entity_id, '-', 2) AS BIGINT) AS seq, e.entity_id,
         d.departure_time AS departure_time_real, d.departure_delay AS departure_delay_seconds,
         a.arrival_time AS arrival_time_real, a.arrival_delay AS arrival_delay_seconds,
         e.trip_schedule_relationship, d.stop_relationship AS departure_schedule_relationship,
         a.stop_relationship AS arrival_schedule_relationship
  FROM entity_base e JOIN runs t ON t.trip_id = e.trip_id AND t.service_date = e.service_date
  LEFT JOIN entity_last d ON d.entity_id = e.entity_id
    AND d.number = CASE t.departure_station_name WHEN 'Paris Nord' THEN 1 ELSE 2 END
  LEFT JOIN entity_last a ON a.entity_id = e.entity_id
    AND a.number = CASE t.arrival_station_name WHEN 'Paris Nord' THEN 1 ELSE 2 END
)
"""
RT_VALUES = (
    "departure_time_real",
    "departure_delay_seconds",
    "arrival_time_real",
    "arrival_delay_seconds",
    "trip_schedule_relationship",
    "departure_schedule_relationship",
    "arrival_schedule_relationship",
)


def _rt_fold() -> str:
    folded = ", ".join(
        f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in RT_VALUES
    )
    shown = ", ".join(_sec(c) if c.endswith("_real") else c for c in RT_VALUES)
    return _with(TRIPS, RUNS, ENTITIES, RT_LOG) + f"""
SELECT trip_id, {_day("service_date")}, {_day("departure_date")}, {shown}, n_updates
FROM (SELECT trip_id, service_date, departure_date, {folded}, count(*) AS n_updates FROM rt_log GROUP BY 1, 2, 3)"""


def _rt_upserted() -> str:
    folded = ", ".join(
        f"arg_max({c}, seq) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in RT_VALUES
    )
    kept = ", ".join(c for c in REALTIME if not c.endswith("_real"))
    return _with(TRIPS, RUNS, ENTITIES, RT_LOG) + f"""
SELECT t.trip_id, {_day("t.service_date")}, {kept},
       {_sec("coalesce(departure_time_real, siri_departure_time_real)", "siri_departure_time_real")},
       {_sec("coalesce(arrival_time_real, siri_arrival_time_real)", "siri_arrival_time_real")},
       CASE WHEN f.trip_id IS NULL THEN strftime(siri_updated_at, {SECOND}) ELSE '2024-01-31 01:30:00' END AS siri_updated_at,
       departure_delay_seconds AS departure_gtfs_delay, arrival_delay_seconds AS arrival_gtfs_delay,
       trip_schedule_relationship, departure_schedule_relationship, arrival_schedule_relationship
FROM runs t LEFT JOIN (SELECT trip_id, service_date, departure_date, {folded} FROM rt_log GROUP BY 1, 2, 3) f
  ON f.trip_id = t.trip_id AND f.service_date = t.service_date AND f.departure_date = CAST(t.departure_time_scheduled AS DATE)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip() for p in parts) + "\n"


# --- line statistics ----------------------------------------------------------------------

_WEEKDAYS = "['Lu', 'Ma', 'Me', 'Je', 'Ve', 'Sa', 'Di']"

LINES = f"""
lines AS (
  SELECT route_short_name || ' ' || trip_headsign AS line, trip_headsign,
         min(departure_station_name || ' → ' || arrival_station_name) AS direction,
         min(strftime(departure_time_scheduled, '%H:%M')) AS first_departure,
         min(strftime(arrival_time_scheduled, '%H:%M')) AS first_arrival,
         min({SCHEDULED_MINUTES}) AS shortest,
         coalesce(CAST(sum(delay_seconds) FILTER (WHERE NOT is_cancelled) AS DOUBLE)
           / nullif(60 * count(delay_seconds) FILTER (WHERE NOT is_cancelled), 0), 0) AS average_delay_minutes,
         count(delay_seconds) FILTER (WHERE NOT is_cancelled) AS known_trains,
         list_sort(list(DISTINCT isodow(departure_time_scheduled))) AS days,
         {COUNTS}
  FROM classed GROUP BY route_short_name, trip_headsign
)
"""

COMMON = f"""
common AS (
  SELECT trip_headsign, strftime(departure_time_scheduled, '%H:%M') AS departure_time,
         strftime(arrival_time_scheduled, '%H:%M') AS arrival_time,
         min({SCHEDULED_MINUTES}) AS duration_scheduled, count(*) AS n_trains
  FROM classed GROUP BY 1, 2, 3
  QUALIFY row_number() OVER (
    PARTITION BY trip_headsign ORDER BY count(*) DESC, departure_time, arrival_time) = 1
)
"""

RANGES = f"""
runs AS (
  SELECT line, min(d) AS first_day, max(d) AS last_day
  FROM (SELECT line, d, d - row_number() OVER (PARTITION BY line ORDER BY d) AS island
        FROM (SELECT line, unnest(days) AS d FROM lines))
  GROUP BY line, island
),
ranges AS (
  SELECT line, string_agg(
           CASE WHEN first_day = last_day THEN {_WEEKDAYS}[first_day]
                ELSE {_WEEKDAYS}[first_day] || ' - ' || {_WEEKDAYS}[last_day] END,
           ', ' ORDER BY first_day) AS day_ranges
  FROM runs GROUP BY line
)
"""
JOURS = f"array_to_string(list_transform(days, lambda d: {_WEEKDAYS}[d]), ', ') AS jours"

DAILY = f"""
daily AS (
  SELECT CAST(departure_time_scheduled AS DATE) AS date, {COUNTS} FROM classed GROUP BY 1
)
"""

#: Two thirds of the trips have real values by now.
DAILY_UPDATES = f"""
daily AS (
  SELECT CAST(departure_time_scheduled AS DATE) AS date, {COUNTS}
  FROM (SELECT * REPLACE (CASE WHEN CAST(substr(trip_id, 6) AS BIGINT) % 3 = 0 THEN 'delay_unknown' ELSE delay_class END AS delay_class) FROM classed)
  GROUP BY 1
)
"""
WEEK_LABEL = """CASE WHEN month(p) = month(p + 6) THEN day(p) || '-' || day(p + 6) || strftime(p, '/%m')
         ELSE day(p) || strftime(p, '/%m') || '-' || day(p + 6) || strftime(p + 6, '/%m') END"""

MINUTES_TEXT = "CASE WHEN {m} < 60 THEN {m} || ' min' ELSE ({m} // 60) || 'h' || lpad(CAST({m} % 60 AS VARCHAR), 2, '0') END"


def _text_of(minutes: str) -> str:
    return MINUTES_TEXT.format(m=f"({minutes})")


def _end_text(label: str, seconds: str) -> str:
    return (
        f"CASE WHEN {seconds} > 0 THEN '{label}: ' || {_text_of(f'CAST(floor({seconds} / 60.0) AS BIGINT)')}"
        f" WHEN {seconds} <= 0 THEN '{label}: À l''heure' END"
    )


def _class_of(seconds: str) -> str:
    return (
        f"CASE WHEN is_cancelled THEN 'delay_skipped' WHEN {seconds} IS NULL THEN 'delay_unknown'"
        f" WHEN {seconds} <= 0 THEN 'on_time' WHEN {seconds} <= 300 THEN 'delay_5min'"
        f" WHEN {seconds} <= 900 THEN 'delay_15min' WHEN {seconds} <= 2700 THEN 'delay_45min'"
        f" ELSE 'delay_over_45min' END"
    )


def _state(real: str, seconds: str) -> str:
    return (
        f"CASE WHEN is_cancelled THEN 'cancelled' WHEN {real} IS NULL THEN 'unknown'"
        f" WHEN {seconds} > 0 THEN 'late' ELSE 'on_time' END"
    )


ENDS = """
ends AS (
  SELECT *, date_diff('second', departure_time_scheduled, siri_departure_time_real) AS dep_s,
         date_diff('second', arrival_time_scheduled, siri_arrival_time_real) AS arr_s
  FROM timed
)
"""

GLOBAL = f"SELECT {COUNT_NAMES}, {SHARES} FROM (SELECT {COUNTS} FROM classed {{where}}) WHERE total_trains > 0"
PRESET = """WHERE CAST(departure_time_scheduled AS DATE) BETWEEN
  least(greatest(DATE '2024-01-15' - {days}, (SELECT min(CAST(departure_time_scheduled AS DATE)) FROM trips)),
        (SELECT max(CAST(departure_time_scheduled AS DATE)) FROM trips))
  AND least(greatest(DATE '2024-01-15', (SELECT min(CAST(departure_time_scheduled AS DATE)) FROM trips)),
        (SELECT max(CAST(departure_time_scheduled AS DATE)) FROM trips))"""


def _line_report() -> str:
    return _with(TRIPS, CLASSED, LINES, COMMON, RANGES) + f"""
SELECT l.line, l.trip_headsign, direction, first_departure AS sort_time,
       c.departure_time AS departure_time_scheduled, c.arrival_time AS arrival_time_scheduled,
       coalesce(c.duration_scheduled, 0) AS duration_scheduled, average_delay_minutes, {JOURS}, day_ranges,
       {COUNT_NAMES}, {SHARES}
FROM lines l JOIN common c ON c.trip_headsign = l.trip_headsign JOIN ranges r ON r.line = l.line
"""


def _stacks() -> str:
    rows = []
    for i, name in enumerate(CLASSES):
        before = " + ".join(CLASSES[:i]) or "0"
        rows.append(
            f"SELECT {_day('date')}, '{name}' AS delay_class, {name} AS trains,"
            f" ({name} * 100) / CAST(total_trains AS DOUBLE) AS height,"
            f' (({before}) * 100) / CAST(total_trains AS DOUBLE) AS "offset" FROM daily WHERE {name} > 0'
        )
    return _with(TRIPS, CLASSED, DAILY) + "\nUNION ALL\n".join(rows)


def _shares() -> str:
    pieces = "\nUNION ALL\n".join(
        f"SELECT line, {i} AS n, '{name}' AS delay_class, {name} AS trains, total_trains,"
        f" (2000 * {name} + total_trains) // (2 * total_trains) AS tenths FROM lines WHERE {name} > 0"
        for i, name in enumerate(CLASSES)
    )
    return (
        _with(TRIPS, CLASSED, LINES, f"pieces AS ({pieces})")
        + """
SELECT line, delay_class, trains,
       CAST(CASE WHEN row_number() OVER (PARTITION BY line ORDER BY n DESC) = 1
            THEN 1000 - coalesce(sum(tenths) OVER (PARTITION BY line ORDER BY n
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            ELSE tenths END AS BIGINT) / 10 AS width,
       tenths / 10 AS percentage
FROM pieces
"""
    )


def _call_text(kind: str) -> str:
    fields = (
        "stop",
        "cancellation",
        "inaccurate",
        _iso("arrival_wall").replace("CASE WHEN", "CASE WHEN arrival_wall IS NULL THEN NULL WHEN", 1),
        "arrival_platform",
        _iso("departure_wall").replace("CASE WHEN", "CASE WHEN departure_wall IS NULL THEN NULL WHEN", 1),
        "departure_platform",
    )
    text = " || '|' || ".join(f"coalesce({f}, '~')" for f in fields)
    return (
        f"coalesce(string_agg({text}, ';' ORDER BY call_position)"
        f" FILTER (WHERE call_kind = '{kind}'), '') AS {kind}_calls"
    )


_SIRI = (JOURNEYS,)
_LOG = (TRIPS, SLOTS, JOURNEYS, STATION_FOLD, UPDATES)
_LOG_COLUMNS = (
    "trip_headsign, strftime(departure_date, '%Y-%m-%d') AS departure_date,"
    " departure_station_name, arrival_station_name"
)


def _filtered(where: str) -> str:
    return _with(TRIPS) + (
        f"SELECT trip_id, {_sec('departure_time_scheduled')} FROM trips WHERE {where}"
    )


def _lines(columns: str) -> str:
    return _with(TRIPS, CLASSED, LINES) + f"SELECT {columns} FROM lines"


SQL: dict[str, str] = {
    "delay_class": _with(TRIPS, CLASSED)
    + "SELECT trip_id, delay_seconds, is_cancelled, delay_class FROM classed",
    "delay_minutes": _with(TRIPS)
    + """SELECT trip_id,
       epoch(siri_departure_time_real - departure_time_scheduled) / 60 AS departure_delay_minutes,
       epoch(siri_arrival_time_real - arrival_time_scheduled) / 60 AS arrival_delay_minutes FROM trips""",
    "trip_durations": _with(TRIPS)
    + f"SELECT trip_id, {SCHEDULED_MINUTES} AS duration_scheduled_minutes, {REAL_MINUTES} AS duration_real_minutes FROM trips",
    "trip_count": _with(TRIPS) + "SELECT count(*) AS n_trips FROM trips",
    "cancelled_trips": _with(TRIPS)
    + f"""SELECT trip_id, {_day("service_date")}, siri_departure_status, siri_arrival_status FROM trips
WHERE siri_departure_status = 'CANCELLED' OR siri_arrival_status = 'CANCELLED'""",
    "date_filter_between": _filtered(
        "CAST(departure_time_scheduled AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"
    ),
    "date_filter_from": _filtered("CAST(departure_time_scheduled AS DATE) >= DATE '2024-01-08'"),
    "date_filter_until": _filtered("CAST(departure_time_scheduled AS DATE) <= DATE '2024-01-21'"),
    "date_range": _with(TRIPS)
    + """SELECT strftime(min(CAST(departure_time_scheduled AS DATE)), '%Y-%m-%d') AS min_date,
       strftime(max(CAST(departure_time_scheduled AS DATE)), '%Y-%m-%d') AS max_date FROM trips""",
    "delay_stats_global": _with(TRIPS, CLASSED) + GLOBAL.format(where=""),
    "delay_stats_by_direction": _with(TRIPS, CLASSED)
    + f"""SELECT direction, {COUNT_NAMES}, {SHARES} FROM (
  SELECT departure_station_name || ' → ' || arrival_station_name AS direction, {COUNTS}
  FROM classed GROUP BY 1)""",
    "delay_stats_by_date": _with(TRIPS, CLASSED, DAILY)
    + f"SELECT {_day('date')}, {COUNT_NAMES}, {SHARES} FROM daily",
    "delay_stats_weekly": _with(TRIPS, CLASSED, DAILY)
    + f"""SELECT strftime(p, {DAY}) AS period_start, {WEEK_LABEL} AS period_label, {COUNT_NAMES}, {SHARES}
FROM (SELECT CAST(date_trunc('week', date) AS DATE) AS p, {SUMS} FROM daily GROUP BY 1)""",
    "delay_timeline_auto": _with(TRIPS, CLASSED, DAILY)
    + f"""SELECT strftime(p, {DAY}) AS period_start,
       CASE WHEN weekly THEN {WEEK_LABEL} ELSE strftime(p, '%d/%m') END AS period_label, {COUNT_NAMES}, {SHARES}
FROM (SELECT weekly, CASE WHEN weekly THEN CAST(date_trunc('week', date) AS DATE) ELSE date END AS p, {SUMS}
      FROM (SELECT *, (SELECT max(date) - min(date) > 30 FROM daily) AS weekly FROM daily) GROUP BY 1, 2)""",
    "preset_week_stats": _with(TRIPS, CLASSED) + GLOBAL.format(where=PRESET.format(days=7)),
    "preset_month_stats": _with(TRIPS, CLASSED) + GLOBAL.format(where=PRESET.format(days=30)),
    "delay_stats_by_line": _lines(
        f"""line, direction, first_departure AS departure_time_scheduled, first_arrival AS arrival_time_scheduled,
       shortest AS duration_scheduled, average_delay_minutes, {JOURS}, {COUNT_NAMES}, {SHARES}"""
    ),
    "avg_delay_by_line": _lines("line, average_delay_minutes, known_trains"),
    "line_common_times": _with(TRIPS, CLASSED, COMMON)
    + "SELECT trip_headsign, departure_time, arrival_time, coalesce(duration_scheduled, 0) AS duration_scheduled, n_trains FROM common",
    "line_weekdays": _lines(f"line, {JOURS}"),
    "line_weekday_ranges": _with(TRIPS, CLASSED, LINES, RANGES) + "SELECT line, day_ranges FROM ranges",
    "line_report": _line_report(),
    "delay_stack_offsets": _stacks(),
    "delay_share_segments": _shares(),
    "report_json": _line_report(),
    "live_board": _with(TRIPS, CLASSED)
    + f"""SELECT route_short_name AS line, trip_id, trip_headsign,
       departure_station_name || ' → ' || arrival_station_name AS direction,
       strftime(departure_time_scheduled, '%H:%M:%S') AS departure_time_scheduled,
       strftime(siri_departure_time_real, '%H:%M:%S') AS departure_time_real,
       replace(siri_departure_platform, 'Hall ', 'H') AS departure_platform,
       strftime(arrival_time_scheduled, '%H:%M:%S') AS arrival_time_scheduled,
       strftime(siri_arrival_time_real, '%H:%M:%S') AS arrival_time_real,
       replace(siri_arrival_platform, 'Hall ', 'H') AS arrival_platform,
       {SCHEDULED_MINUTES} AS duration_scheduled_minutes, {REAL_MINUTES} AS duration_real_minutes,
       epoch(siri_departure_time_real - departure_time_scheduled) / 60 AS departure_delay_minutes,
       epoch(siri_arrival_time_real - arrival_time_scheduled) / 60 AS arrival_delay_minutes,
       {_sec("siri_updated_at", "updated_at")}, is_cancelled AS is_skipped
FROM classed WHERE CAST(departure_time_scheduled AS DATE) = DATE '2024-01-15'""",
    "trip_text_labels": _with(TRIPS, CLASSED, ENDS)
    + f"""SELECT trip_id, {_text_of(SCHEDULED_MINUTES)} AS duration_scheduled_text,
       CASE WHEN {REAL_MINUTES} <> 0 THEN {_text_of(REAL_MINUTES)} END AS duration_real_text,
       coalesce({REAL_MINUTES} <> 0 AND {REAL_MINUTES} > {SCHEDULED_MINUTES}, FALSE) AS duration_exceeded,
       CASE WHEN is_cancelled THEN 'Supprimé'
            WHEN dep_s IS NULL AND arr_s IS NULL THEN ''
            WHEN dep_s = arr_s THEN CASE WHEN dep_s <= 0 THEN 'À l''heure'
                 ELSE {_text_of("CAST(floor(dep_s / 60.0) AS BIGINT)")} END
            ELSE concat_ws(', ', {_end_text("Départ", "dep_s")}, {_end_text("Arrivée", "arr_s")}) END AS delay_text,
       strftime(CASE WHEN {_state("siri_departure_time_real", "dep_s")} = 'late' THEN siri_departure_time_real
                ELSE departure_time_scheduled END, '%H:%M') AS departure_display_time,
       {_state("siri_departure_time_real", "dep_s")} AS departure_display_state,
       {_class_of("dep_s")} AS departure_delay_class,
       strftime(CASE WHEN {_state("siri_arrival_time_real", "arr_s")} = 'late' THEN siri_arrival_time_real
                ELSE arrival_time_scheduled END, '%H:%M') AS arrival_display_time,
       {_state("siri_arrival_time_real", "arr_s")} AS arrival_display_state,
       {_class_of("arr_s")} AS arrival_delay_class
FROM ends""",
    "feed_freshness": _with(TRIPS)
    + f"""SELECT {_sec("m", "updated_at")}, strftime(m, '%d/%m/%Y à %Hh%M') AS formatted_timestamp,
       TIMESTAMP '2024-01-31 01:30:00' - m > INTERVAL 15 MINUTE AS is_outdated
FROM (SELECT max(siri_updated_at) AS m FROM trips)""",
    "past_trip_flag": _with(*_LOG, FOLD, UPSERTED)
    + f"""SELECT trip_id, {_sec("siri_updated_at")},
       coalesce(u.siri_updated_at < (SELECT max(siri_updated_at) FROM upserted), FALSE) AS is_past
FROM upserted u WHERE CAST(departure_time_scheduled AS DATE) = DATE '2024-01-15'""",
    "gtfs_scan": _with(GTFS)
    + """SELECT 'calendar_dates' AS table_name, service_id || '|' || date || '|' || exception_type AS content FROM calendar_dates
UNION ALL SELECT 'trips', route_id || '|' || service_id || '|' || trip_id || '|' || trip_headsign FROM gtfs_trips
UNION ALL SELECT 'routes', route_id || '|' || route_short_name FROM routes
UNION ALL SELECT 'stop_times', trip_id || '|' || arrival_time || '|' || departure_time || '|' || stop_id || '|' || position FROM stop_times""",
    "active_services": _with(GTFS) + f"SELECT service_id, {_day('service_date')} FROM services",
    "service_day_trips": _with(GTFS)
    + f"""SELECT t.trip_id, t.service_id, {_day("service_date")}, count(*) AS n_stops
FROM stop_times st JOIN gtfs_trips t ON t.trip_id = st.trip_id JOIN services s ON s.service_id = t.service_id
GROUP BY t.trip_id, t.service_id, s.service_date""",
    "trips_with_route": _with(GTFS)
    + """SELECT t.*, coalesce(route_short_name, '') AS route_short_name
FROM gtfs_trips t LEFT JOIN routes r ON r.route_id = t.route_id""",
    "corridor_trips": _with(GTFS, _corridors(MAIN_PAIR)) + "SELECT * FROM corridor",
    "corridor_trips_multi": _with(GTFS, _corridors(MANY_PAIRS)) + "SELECT * FROM corridor",
    "gtfs_service_time": _with(GTFS)
    + f"""SELECT trip_id, CAST(position AS VARCHAR) AS stop_sequence,
       strftime({_clock("arrival_time", "DATE '2024-01-15'")}, {SECOND}) AS arrival,
       strftime({_clock("departure_time", "DATE '2024-01-15'")}, {SECOND}) AS departure
FROM stop_times""",
    "schedule_load": _with(SCHEDULE)
    + f"SELECT {_schedule_columns(repr('2024-01-01 03:23:00'))} FROM schedule",
    "schedule_append_new_days": _with(SCHEDULE)
    + f"""SELECT {_schedule_columns("CASE WHEN service_date <= DATE '2024-01-15' THEN '2024-01-01 03:23:00' ELSE '2024-01-16 03:23:00' END")}
FROM schedule""",
    "schedule_load_guard": _with(SCHEDULE)
    + f"""SELECT {_schedule_columns(repr('2024-01-01 03:23:00'))} FROM schedule
WHERE service_date = DATE '2024-01-15'""",
    "trips_scan": _with(TRIPS)
    + f"""SELECT trip_id, departure_station_name, arrival_station_name, {_sec("departure_time_scheduled")},
       {_sec("arrival_time_scheduled")}, trip_headsign, {_day("service_date")} FROM trips""",
    "siri_scan": _with(*_SIRI)
    + f"""SELECT b.journey_ref, b.train_number, strftime(b.journey_day, {DAY}) AS journey_date, monitored,
       prediction_inaccurate, recorded_calls, estimated_calls, {_sec("b.polled_at")}
FROM line_base b JOIN (
  SELECT journey_ref, {_call_text("recorded")}, {_call_text("estimated")} FROM all_calls GROUP BY journey_ref
) c ON c.journey_ref = b.journey_ref""",
    "siri_valid_journeys": _with(*_SIRI)
    + f"SELECT journey_ref, train_number, strftime(journey_day, {DAY}) AS journey_date FROM valid",
    "siri_trip_status": _with(*_SIRI) + "SELECT journey_ref, trip_status FROM valid",
    "siri_calls": _with(*_SIRI)
    + "SELECT journey_ref, call_position, call_kind, stop AS siri_stop_id FROM calls",
    "siri_station_calls": _with(*_SIRI)
    + "SELECT journey_ref, call_position, station_name FROM calls WHERE station_name IS NOT NULL",
    "siri_call_status": _with(*_SIRI) + "SELECT journey_ref, call_position, call_status FROM calls",
    "platform_label": _with(*_SIRI)
    + "SELECT journey_ref, call_position, platform, replace(platform, 'Hall ', 'H') AS platform_label FROM calls",
    "siri_timestamp": _with(*_SIRI)
    + f"""SELECT journey_ref, call_position,
       CASE WHEN departure_wall IS NOT NULL THEN {_iso("departure_wall")} END AS feed_text,
       strftime({_read("departure_wall")}, {SECOND}) AS feed_time
FROM all_calls""",
    "siri_station_fold": _with(*_SIRI, STATION_FOLD)
    + f"""SELECT journey_ref, station_name, {_sec("expected_departure")}, {_sec("expected_arrival")},
       platform, call_status FROM station_fold""",
    "journey_match": _with(TRIPS, SLOTS, *_SIRI)
    + f"""SELECT journey_ref, train_number, strftime(journey_day, {DAY}) AS journey_date, n_trips
FROM valid JOIN (SELECT trip_headsign, departure_date, CAST(sum(n_trips) AS BIGINT) AS n_trips FROM slots GROUP BY 1, 2)
  ON trip_headsign = train_number AND departure_date = journey_day""",
    "journeys_unmatched": _with(TRIPS, SLOTS, *_SIRI)
    + f"""SELECT journey_ref, train_number, strftime(journey_day, {DAY}) AS journey_date FROM valid
WHERE NOT EXISTS (SELECT 1 FROM slots WHERE trip_headsign = train_number AND departure_date = journey_day)""",
    "trip_update_build": _with(*_LOG)
    + f"SELECT {_LOG_COLUMNS}, n_trips, {_values()}, seq FROM update_log",
    "update_fold": _with(*_LOG, FOLD) + f"SELECT {_LOG_COLUMNS}, {_values()}, n_updates FROM folded",
    "schedule_without_update": _with(*_LOG)
    + f"""SELECT trip_id, trip_headsign, {_day("service_date")} FROM trips t
WHERE NOT EXISTS (SELECT 1 FROM update_log u WHERE u.trip_headsign = t.trip_headsign
  AND u.departure_date = CAST(t.departure_time_scheduled AS DATE)
  AND u.departure_station_name = t.departure_station_name AND u.arrival_station_name = t.arrival_station_name)""",
    "feed_counters": _with(*_LOG, FOLD)
    + """SELECT (SELECT count(*) FROM line_base) AS journeys_seen,
       (SELECT count(*) FROM valid v WHERE EXISTS (SELECT 1 FROM slots
          WHERE trip_headsign = v.train_number AND departure_date = v.journey_day)) AS journeys_matched,
       (SELECT count(*) FROM calls c WHERE station_name IS NOT NULL AND EXISTS (SELECT 1 FROM slots
          WHERE trip_headsign = c.train_number AND departure_date = c.journey_day)) AS station_calls,
       (SELECT CAST(sum(n_trips) AS BIGINT) FROM update_log) AS updates,
       (SELECT count(*) FROM trips t WHERE EXISTS (SELECT 1 FROM folded f
          WHERE f.trip_headsign = t.trip_headsign AND f.departure_date = CAST(t.departure_time_scheduled AS DATE)
            AND f.departure_station_name = t.departure_station_name)) AS trips_updated""",
    "trips_upsert": _with(*_LOG, FOLD, UPSERTED)
    + f"SELECT trip_id, {_day('service_date')}, {_values()} FROM upserted",
    "gtfs_rt_updates": _with(TRIPS, RUNS, ENTITIES, RT_LOG)
    + f"SELECT entity_id, trip_id, {_day('departure_date')}, "
    + ", ".join(_sec(c) if c.endswith("_real") else c for c in RT_VALUES)
    + " FROM rt_log",
    "gtfs_rt_fold": _rt_fold(),
    "gtfs_rt_upsert": _rt_upserted(),
    "gtfs_rt_known_trips": _with(TRIPS, RUNS, ENTITIES)
    + """SELECT entity_id, trip_id, trip_schedule_relationship FROM entity_base e
WHERE EXISTS (SELECT 1 FROM runs r WHERE r.trip_id = e.trip_id AND r.service_date = e.service_date)""",
    "stop_id_clean": _with(TRIPS, RUNS, ENTITIES)
    + """SELECT entity_id, stop_position, CASE WHEN number = 9 THEN '' ELSE CAST(number AS VARCHAR) END AS stop_number
FROM entity_stops""",
    "stream_siri_ingest": _with(*_SIRI, STATION_FOLD)
    + f"""SELECT journey_ref, station_name, {_sec("expected_departure")}, {_sec("expected_arrival")},
       platform, call_status, trip_status FROM station_fold""",
    "stream_operating_hours": f"SELECT event_id, {_sec('ts')} FROM events WHERE hour(ts) >= 5 OR hour(ts) <= 1",
    "stream_schedule_join": _with(*_LOG)
    + f"SELECT {_LOG_COLUMNS}, n_trips, {_values()}, seq FROM update_log",
    "stream_update_fold": _with(*_LOG, FOLD) + f"SELECT {_LOG_COLUMNS}, {_values()}, n_updates FROM folded",
    "stream_daily_delay": _with(TRIPS, CLASSED, DAILY) + f"SELECT {_day('date')}, {COUNT_NAMES} FROM daily",
    "stream_daily_updates": _with(TRIPS, CLASSED, DAILY_UPDATES) + f"SELECT {_day('date')}, {COUNT_NAMES} FROM daily",
    "stream_update_dedup": _with(*_SIRI)
    + f"SELECT DISTINCT journey_ref, train_number, {_sec('polled_at')} FROM line_base"
    + f" UNION ALL SELECT DISTINCT journey_ref, train_number, {_sec('polled_at + INTERVAL 2 MINUTE', 'polled_at')} FROM line_base",
    "stream_late_updates": _with(*_SIRI)
    + f"""SELECT journey_ref, train_number, {_sec("polled_at")} FROM line_base
WHERE NOT recorded OR polled_at > (SELECT max(polled_at) FROM line_base WHERE NOT recorded) - INTERVAL 1 DAY""",
    "bootstrap_day": _with(
        SCHEDULE,
        "trips AS (SELECT * FROM schedule)",
        SLOTS,
        JOURNEYS,
        STATION_FOLD,
        UPDATES,
        FOLD,
    )
    + f"""SELECT t.trip_id, route_id, route_short_name, t.trip_headsign, t.departure_station_name,
       {_sec("departure_time_scheduled")}, t.arrival_station_name, {_sec("arrival_time_scheduled")},
       '2024-01-01 03:23:00' AS created_at, {_values()}, {_day("service_date")}
FROM trips t LEFT JOIN folded f ON f.trip_headsign = t.trip_headsign
   AND f.departure_date = CAST(t.departure_time_scheduled AS DATE)
   AND f.departure_station_name = t.departure_station_name
   AND f.arrival_station_name = t.arrival_station_name""",
}
SQL["siri_scan_split"] = SQL["siri_scan"]
