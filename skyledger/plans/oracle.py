"""The catalog's queries once more, as SQL for a second engine to check them against."""

from __future__ import annotations

from skyledger.functions.columns import CLASS_TEXT
from skyledger.plans import incremental

CATEGORICAL = ["UniqueCarrier", "Origin", "Dest", "RouteType"]
NUMERIC = [
    "Month", "DayofMonth", "Distance", "DepHour", "DepMinute", "ArrHour", "ArrMinute", "Diverted",
]

RAW = """
star AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_linenumber AS ln,
         o.o_custkey AS ck, o.o_orderdate AS od, p.p_brand AS brand,
         upper(substr(sr.r_name, 1, 2)) || lpad(CAST(sn.n_nationkey AS VARCHAR), 2, '0') AS sp,
         upper(substr(cr.r_name, 1, 2)) || lpad(CAST(cn.n_nationkey AS VARCHAR), 2, '0') AS cp,
         (l.l_orderkey + l.l_linenumber) % 50 = 0 AS cancelled,
         (l.l_orderkey * 3 + l.l_partkey) % 97 = 0 AS diverted
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
  JOIN region sr ON sn.n_regionkey = sr.r_regionkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN region cr ON cn.n_regionkey = cr.r_regionkey
),
raw AS (
  SELECT ok, pk, sk, ln,
    CASE WHEN (ok + pk) % 503 = 0 THEN 'n/a' ELSE strftime(od, '%Y-%m-%d') END AS FL_DATE,
    brand AS OP_CARRIER,
    CAST(ok AS VARCHAR) AS OP_CARRIER_FL_NUM,
    CASE WHEN (ok + pk) % 1009 <> 0 THEN sp END AS ORIGIN,
    cp AS DEST,
    CASE WHEN NOT cancelled THEN
      CAST(((ok * 37 + ln * 101) % 25) * 100 + (ok * 13 + pk) % 60 AS VARCHAR) END AS DEP_TIME,
    CASE WHEN NOT cancelled THEN
      CAST((ok * 31 + pk * 17 + ln * 7) % 200 - 50 AS VARCHAR) END AS DEP_DELAY,
    CASE WHEN NOT (cancelled OR diverted OR (ok + sk) % 301 = 0) THEN
      CAST((ok * 29 + pk * 11 + ln * 5) % 200 - 60 AS VARCHAR) END AS ARR_DELAY,
    CASE WHEN NOT cancelled THEN CAST(5 + (pk * 7 + ln) % 30 AS VARCHAR) END AS TAXI_OUT,
    CASE WHEN NOT cancelled THEN CAST(2 + (sk * 5 + ln) % 15 AS VARCHAR) END AS TAXI_IN,
    CASE WHEN (ok * 7 + sk) % 211 = 0 THEN ''
      ELSE CAST(100 + (sk * 53 + ck * 29) % 2500 AS VARCHAR) END AS DISTANCE,
    CASE WHEN NOT cancelled THEN
      CAST(30 + (sk * 53 + ck * 29) % 400 AS VARCHAR) END AS AIR_TIME,
    CAST(50 + (sk * 53 + ck * 29) % 400 AS VARCHAR) AS CRS_ELAPSED_TIME,
    CASE WHEN NOT cancelled THEN
      CAST(45 + (sk * 53 + ck * 31) % 420 AS VARCHAR) END AS ACTUAL_ELAPSED_TIME,
    CASE WHEN pk % 3 = 0 THEN CAST(pk % 41 AS VARCHAR) END AS CARRIER_DELAY,
    CASE WHEN pk % 5 = 0 THEN CAST(ok % 23 AS VARCHAR) END AS WEATHER_DELAY,
    CASE WHEN pk % 7 = 0 THEN CAST(ok % 31 AS VARCHAR) END AS NAS_DELAY,
    CASE WHEN pk % 11 = 0 THEN CAST(sk % 13 AS VARCHAR) END AS SECURITY_DELAY,
    CASE WHEN pk % 2 = 0 THEN CAST(ok % 61 AS VARCHAR) END AS LATE_AIRCRAFT_DELAY,
    CASE WHEN cancelled THEN '1.0' ELSE '0.0' END AS CANCELLED,
    CASE WHEN diverted THEN '1.0' ELSE '0.0' END AS DIVERTED
  FROM star
)"""

_NUMBERS = [
    "DEP_DELAY", "ARR_DELAY", "TAXI_OUT", "TAXI_IN", "DISTANCE", "AIR_TIME", "CRS_ELAPSED_TIME",
    "ACTUAL_ELAPSED_TIME", "CANCELLED", "DIVERTED",
]
_CAUSES = [
    "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
]
_FILLED = [
    "ARR_DELAY", "DEP_DELAY", "CARRIER_DELAY", "WEATHER_DELAY", "CANCELLED", "DIVERTED",
    "ACTUAL_ELAPSED_TIME", "CRS_ELAPSED_TIME",
]

CLEAN = f"""
clean AS (
  SELECT TRY_CAST(FL_DATE AS TIMESTAMP) AS FL_DATE, OP_CARRIER, OP_CARRIER_FL_NUM, ORIGIN, DEST,
    DEP_TIME,
    CASE WHEN length(DEP_TIME) = 4 THEN TRY_CAST(substr(DEP_TIME, 1, 2) AS INTEGER)
         WHEN length(DEP_TIME) = 3 THEN TRY_CAST('0' || substr(DEP_TIME, 1, 1) AS INTEGER)
         ELSE 0 END AS DEP_HOUR,
    {", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in _NUMBERS)},
    {", ".join(f"COALESCE(TRY_CAST({c} AS DOUBLE), 0.0) AS {c}" for c in _CAUSES)}
  FROM raw
),
filled AS (
  SELECT * REPLACE ({", ".join(f"COALESCE({c}, 0.0) AS {c}" for c in _FILLED)}) FROM clean
)"""

TRAIN = """
train AS (
  SELECT ok, pk, sk, ln, OP_CARRIER AS UniqueCarrier, ORIGIN AS Origin, DEST AS Dest,
    CAST(month(TRY_CAST(FL_DATE AS DATE)) AS INTEGER) AS "Month",
    CAST(day(TRY_CAST(FL_DATE AS DATE)) AS INTEGER) AS DayofMonth,
    OP_CARRIER_FL_NUM AS FlightNum,
    lpad(DEP_TIME, 4, '0') AS CRSDepTime,
    TRY_CAST(DEP_DELAY AS DOUBLE) AS DepDelay,
    TRY_CAST(DISTANCE AS DOUBLE) AS Distance,
    lpad(CAST(arr // 60 * 100 + arr % 60 AS VARCHAR), 4, '0') AS CRSArrTime,
    CAST(CAST(DIVERTED AS DOUBLE) AS INTEGER) AS Diverted,
    CAST(CAST(CANCELLED AS DOUBLE) AS INTEGER) AS Cancelled,
    CASE WHEN substr(ORIGIN, 1, 2) = substr(DEST, 1, 2) THEN 'Domestic'
         ELSE 'International' END AS RouteType
  FROM (
    SELECT *, (CAST(DEP_TIME AS INTEGER) // 100 * 60 + CAST(DEP_TIME AS INTEGER) % 100
               + CAST(ACTUAL_ELAPSED_TIME AS INTEGER)) % 1440 AS arr
    FROM raw)
),
labelled AS (
  SELECT *, CASE WHEN DepDelay IS NULL OR DepDelay < 15 THEN 0 WHEN DepDelay < 45 THEN 1
                 WHEN DepDelay < 90 THEN 2 ELSE 3 END AS DelayCategory
  FROM train
),
predictions AS (
  SELECT DelayCategory AS label,
    CAST(CASE WHEN (ok + pk) % 5 = 0 THEN (DelayCategory + 1) % 4 ELSE DelayCategory END AS DOUBLE)
      AS prediction
  FROM labelled
)"""

_HHMM = ", ".join(
    f"CAST({c} AS INTEGER) // 100 AS {p}Hour, CAST({c} AS INTEGER) % 100 AS {p}Minute"
    for c, p in (("CRSDepTime", "Dep"), ("CRSArrTime", "Arr")))

FEATURES = f"""
parts AS (SELECT *, {_HHMM} FROM labelled),
features AS (
  SELECT * REPLACE (
    {", ".join(f'COALESCE("{c}", 0) AS "{c}"' for c in NUMERIC)},
    {", ".join(f"COALESCE({c}, 'UNKNOWN') AS {c}" for c in CATEGORICAL)})
  FROM parts
)"""

PAYLOADS = """
payloads AS (
  SELECT event_id, ts, '{' || concat_ws(',',
    '"firstSeen":' || CASE WHEN event_id % 101 = 0 THEN '"' || seen || '"'
      ELSE CAST(seen AS VARCHAR) END,
    '"lastSeen":' || CASE WHEN event_id % 103 = 0 THEN 'true'
      ELSE CAST(seen + 1800 + event_id % 7200 AS VARCHAR) END,
    '"callsign":' || CASE WHEN event_id % 41 = 0 THEN 'null' WHEN event_id % 43 = 0 THEN NULL
      WHEN event_id % 47 = 0 THEN CAST(event_id % 1000 AS VARCHAR)
      ELSE '" AB' || (event_id % 9) || (event_id % 1000) || ' "' END,
    '"estDepartureAirport":' || CASE WHEN event_id % 37 = 0 THEN 'null'
      WHEN event_id % 53 = 0 THEN NULL
      ELSE '"' || CASE WHEN event_id % 2 = 0 THEN 'EG' ELSE 'LF' END
        || (10 + user_id % 80) || '"' END,
    '"estArrivalAirport":' || CASE WHEN event_id % 59 = 0 THEN 'null'
      WHEN event_id % 61 = 0 THEN NULL
      ELSE '"' || CASE WHEN event_id % 3 = 0 THEN 'EG' ELSE 'LF' END
        || (10 + event_id % 80) || '"' END,
    '"estDepartureAirportHorizDistance":' || CASE WHEN event_id % 29 = 0 THEN 'null'
      WHEN event_id % 31 = 0 THEN NULL ELSE CAST(event_id % 5000 AS VARCHAR) END,
    '"scheduledDepartureTime":' || CASE WHEN event_id % 3 = 0 THEN NULL
      WHEN event_id % 17 = 0 THEN '0'
      WHEN event_id % 97 = 0 THEN '"' || seen || '"'
      ELSE CAST(seen - (event_id % 120 - 30) * 60 AS VARCHAR) END,
    '"diverted":' || CASE WHEN event_id % 19 = 0 THEN 'true' WHEN event_id % 23 = 0 THEN NULL
      WHEN event_id % 31 = 1 THEN '"false"' WHEN event_id % 31 = 2 THEN '""'
      WHEN event_id % 31 = 3 THEN '[]' WHEN event_id % 31 = 4 THEN '2.5'
      ELSE 'false' END
    ) || '}' AS value
  FROM (SELECT *, 1704067200 + event_id * 97 AS seen FROM events)
)"""


def _json_text(key: str) -> str:
    return (f"CASE WHEN json_type(value, '$.{key}') IS NULL THEN '' "
            f"WHEN json_type(value, '$.{key}') = 'VARCHAR' "
            f"THEN json_extract_string(value, '$.{key}') END")


def _json_time(key: str) -> str:
    kind, text = f"json_type(value, '$.{key}')", f"json_extract_string(value, '$.{key}')"
    return (f"CASE WHEN {kind} IS NULL THEN 0.0 WHEN {kind} = 'BOOLEAN' "
            f"THEN CASE WHEN {text} = 'true' THEN 1.0 ELSE 0.0 END "
            f"WHEN {kind} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST({text} AS DOUBLE) END")


def _json_number(key: str) -> str:
    return (f"CASE WHEN json_type(value, '$.{key}') IS NULL THEN 0.0 "
            f"ELSE TRY_CAST(json_extract_string(value, '$.{key}') AS DOUBLE) END")


NORMALIZED = f"""
fields AS (
  SELECT event_id, value,
    {_json_text("callsign")} AS callsign,
    {_json_text("estDepartureAirport")} AS origin,
    {_json_text("estArrivalAirport")} AS dest,
    {_json_time("firstSeen")} AS first_seen,
    {_json_time("lastSeen")} AS last_seen,
    {_json_number("estDepartureAirportHorizDistance")} AS miles,
    json_extract_string(value, '$.scheduledDepartureTime') AS planned,
    coalesce(json_type(value, '$.scheduledDepartureTime') = 'VARCHAR', FALSE) AS bad_plan,
    json_type(value, '$.diverted') AS diverted_kind,
    json_extract_string(value, '$.diverted') AS diverted
  FROM payloads
),
problems AS (
  SELECT *, CASE WHEN callsign IS NULL THEN 'unusable callsign'
    WHEN origin IS NULL THEN 'unusable estDepartureAirport'
    WHEN dest IS NULL THEN 'unusable estArrivalAirport'
    WHEN first_seen IS NULL THEN 'unusable firstSeen'
    WHEN last_seen IS NULL THEN 'unusable lastSeen' END AS stream_problem,
    coalesce(stream_problem, CASE WHEN bad_plan THEN 'unusable scheduledDepartureTime' END)
      AS problem
  FROM fields
),
usable AS (
  SELECT substr(trim(callsign), 1, 3) AS UniqueCarrier, origin AS Origin, dest AS Dest,
    CAST(month(left_at) AS INTEGER) AS "Month", CAST(day(left_at) AS INTEGER) AS DayofMonth,
    substr(trim(callsign), 4) AS FlightNum, strftime(left_at, '%H%M') AS CRSDepTime,
    CASE WHEN planned IS NOT NULL AND planned <> '0'
      THEN (first_seen - TRY_CAST(planned AS DOUBLE)) / 60 ELSE CAST(0 AS DOUBLE) END AS DepDelay,
    CAST(miles AS DOUBLE) AS Distance, strftime(arrived, '%H%M') AS CRSArrTime,
    CASE WHEN diverted_kind = 'VARCHAR' THEN CAST(diverted <> '' AS INTEGER)
      WHEN diverted IN ('true', '2.5') THEN 1 ELSE 0 END AS Diverted, 0 AS Cancelled,
    CASE WHEN substr(origin, 1, 2) = substr(dest, 1, 2) THEN 'Domestic'
      ELSE 'International' END AS RouteType, bad_plan
  FROM (
    SELECT *, make_timestamp(CAST(first_seen AS BIGINT) * 1000000) AS left_at,
      make_timestamp(CAST(last_seen AS BIGINT) * 1000000) AS arrived
    FROM problems WHERE stream_problem IS NULL)
),
normalized AS (SELECT * EXCLUDE (bad_plan) FROM usable WHERE NOT bad_plan),
streamed AS (SELECT * EXCLUDE (bad_plan, DepDelay) FROM usable)"""


def _rounded(value: str, places: int = 2) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38, 10)), {places}) AS DOUBLE)"


def _mean(column: str, name: str, places: int = 2) -> str:
    return f"{_rounded(f'AVG({column})', places)} AS {name}"


def _sql(ctes: list[str], body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


_ON_TIME = _rounded("SUM(CASE WHEN ARR_DELAY <= 0 THEN 1 ELSE 0 END) * 100.0 / COUNT(*)")
_SIGNIFICANT = _rounded("AVG(CASE WHEN ARR_DELAY > 15 THEN 1.0 ELSE 0.0 END) * 100")

CARRIER = f"""SELECT OP_CARRIER, COUNT(*) AS total_flights,
  {_mean("ARR_DELAY", "avg_arrival_delay")}, {_mean("DEP_DELAY", "avg_departure_delay")},
  {_mean("AIR_TIME", "avg_air_time")}, {_mean("DISTANCE", "avg_distance")},
  {_mean("CARRIER_DELAY", "avg_carrier_delay")}, {_mean("WEATHER_DELAY", "avg_weather_delay")},
  {_mean("CANCELLED", "cancellation_rate", 4)}, {_mean("DIVERTED", "diversion_rate", 4)},
  COUNT(DISTINCT ORIGIN) AS unique_origins, COUNT(DISTINCT DEST) AS unique_destinations,
  {_ON_TIME} AS on_time_performance, {_SIGNIFICANT} AS significant_delay_percentage,
  {_mean("ACTUAL_ELAPSED_TIME - CRS_ELAPSED_TIME", "avg_time_deviation")}
FROM filled GROUP BY OP_CARRIER"""

ROUTE = f"""SELECT ORIGIN || '-' || DEST AS ROUTE, ORIGIN, DEST, COUNT(*) AS flight_count,
  {_mean("DISTANCE", "distance")}, {_mean("AIR_TIME", "avg_air_time")},
  {_mean("CRS_ELAPSED_TIME", "scheduled_time")}, {_mean("ACTUAL_ELAPSED_TIME", "actual_time")},
  {_mean("ARR_DELAY", "avg_arrival_delay")},
  {_rounded("STDDEV_SAMP(ARR_DELAY)")} AS delay_variability,
  {_mean("CANCELLED", "cancellation_rate", 4)}
FROM clean GROUP BY ORIGIN, DEST"""

CAUSE = f"""SELECT OP_CARRIER, {_mean("CARRIER_DELAY", "avg_carrier_delay")},
  {_mean("WEATHER_DELAY", "avg_weather_delay")}, {_mean("NAS_DELAY", "avg_nas_delay")},
  {_mean("SECURITY_DELAY", "avg_security_delay")},
  {_mean("LATE_AIRCRAFT_DELAY", "avg_late_aircraft_delay")}
FROM clean GROUP BY OP_CARRIER"""

AIRPORT = f"""SELECT ORIGIN, COUNT(*) AS total_departures,
  {_mean("COALESCE(DEP_DELAY, 0)", "avg_departure_delay")},
  {_mean("COALESCE(TAXI_OUT, 0)", "avg_taxi_out_time")},
  {_mean("COALESCE(TAXI_IN, 0)", "avg_taxi_in_time")},
  COUNT(DISTINCT OP_CARRIER) AS num_carriers, COUNT(DISTINCT DEST) AS num_destinations,
  {_mean("COALESCE(CANCELLED, 0)", "cancellation_rate", 4)},
  {_rounded("MAX(COALESCE(DEP_DELAY, 0))")} AS max_departure_delay,
  {_rounded("STDDEV_SAMP(COALESCE(DEP_DELAY, 0))")} AS departure_delay_std
FROM clean WHERE ORIGIN IS NOT NULL GROUP BY ORIGIN"""

TIME = f"""SELECT COALESCE(m, 0) AS "MONTH", COALESCE(d, 0) AS DAY_OF_WEEK,
  COALESCE(DEP_HOUR, 0) AS DEP_HOUR, flight_count,
  COALESCE(avg_arrival_delay, 0.0) AS avg_arrival_delay,
  COALESCE(avg_departure_delay, 0.0) AS avg_departure_delay,
  COALESCE(cancellation_rate, 0.0) AS cancellation_rate
FROM (
  SELECT CAST(month(FL_DATE) AS INTEGER) AS m, CAST(dayofweek(FL_DATE) + 1 AS INTEGER) AS d,
    DEP_HOUR, COUNT(*) AS flight_count, {_mean("ARR_DELAY", "avg_arrival_delay")},
    {_mean("DEP_DELAY", "avg_departure_delay")}, {_mean("CANCELLED", "cancellation_rate", 4)}
  FROM clean GROUP BY 1, 2, 3)"""

_BAND = ("CASE WHEN DISTANCE < 500 THEN 'Short Haul' WHEN DISTANCE < 1500 THEN 'Medium Haul' "
         "ELSE 'Long Haul' END")

DISTANCE = f"""SELECT {_BAND} AS DISTANCE_CATEGORY, COUNT(*) AS flight_count,
  {_mean("ARR_DELAY", "avg_arrival_delay")}, {_mean("AIR_TIME", "avg_air_time")},
  {_mean("CRS_ELAPSED_TIME", "avg_scheduled_time")},
  {_mean("ACTUAL_ELAPSED_TIME", "avg_actual_time")},
  {_mean("CARRIER_DELAY", "avg_carrier_delay")}, {_mean("WEATHER_DELAY", "avg_weather_delay")},
  {_mean("CANCELLED", "cancellation_rate", 4)}
FROM clean GROUP BY 1"""

_SEVERITY = """CASE WHEN CANCELLED = 1 THEN 'Cancelled' WHEN DIVERTED = 1 THEN 'Diverted'
  WHEN ARR_DELAY <= 0 THEN 'On Time' WHEN ARR_DELAY <= 15 THEN 'Slight Delay'
  WHEN ARR_DELAY <= 60 THEN 'Moderate Delay' ELSE 'Severe Delay' END"""

SEVERITY = f"""SELECT OP_CARRIER, {_SEVERITY} AS DELAY_CATEGORY, COUNT(*) AS flight_count
FROM clean GROUP BY 1, 2"""

OVERALL = f"""SELECT COUNT(*) AS total_flights,
  {_mean("ARR_DELAY", "overall_avg_arrival_delay")},
  {_rounded("STDDEV_SAMP(ARR_DELAY)")} AS arrival_delay_std,
  {_mean("DEP_DELAY", "overall_avg_departure_delay")},
  ROUND(quantile_disc(ARR_DELAY, 0.95), 2) AS "95th_percentile_delay",
  {_mean("CANCELLED", "overall_cancellation_rate", 4)},
  {_mean("DIVERTED", "overall_diversion_rate", 4)}, {_ON_TIME} AS on_time_percentage
FROM filled"""

_REPORTS = {
    "carrier_performance": CARRIER,
    "route_analysis": ROUTE,
    "delay_type_analysis": CAUSE,
    "airport_performance": AIRPORT,
    "time_based_analysis": TIME,
    "distance_based_analysis": DISTANCE,
    "delay_severity_analysis": SEVERITY,
    "overall_performance_metrics": OVERALL,
}


def _pagerank(reset: float = 0.15, iters: int = 10) -> str:
    steps = ["""links AS (
  SELECT ORIGIN AS src, DEST AS dst FROM raw WHERE ORIGIN IS NOT NULL AND DEST IS NOT NULL),
degree AS (SELECT src, COUNT(*) AS n FROM links GROUP BY src),
flows AS (
  SELECT src, dst, COUNT(*) * 1.0 / ANY_VALUE(n) AS share
  FROM links JOIN degree USING (src) GROUP BY src, dst),
ports AS (SELECT src AS id FROM links UNION SELECT dst FROM links),
r0 AS (SELECT id, CAST(1 AS DOUBLE) AS rank FROM ports)"""]
    for i in range(1, iters + 1):
        steps.append(f"""r{i} AS (
  SELECT p.id, {reset} + {1 - reset} * COALESCE(SUM(r.rank * f.share), 0) AS rank
  FROM ports p LEFT JOIN flows f ON f.dst = p.id LEFT JOIN r{i - 1} r ON r.id = f.src
  GROUP BY p.id)""")
    steps.append(f"""ranked AS (
  SELECT id, ROUND(rank * (SELECT COUNT(*) / SUM(rank) FROM r{iters}), 6) AS pagerank
  FROM r{iters})""")
    return ",\n".join(steps)


def _indexed() -> str:
    """Position of every category value: most frequent first, equal counts by value."""
    parts = [
        f"""index_{c} AS (
  SELECT {c}, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS DOUBLE) AS {c}Index
  FROM features GROUP BY {c})"""
        for c in CATEGORICAL
    ]
    joins = " ".join(f"JOIN index_{c} USING ({c})" for c in CATEGORICAL)
    return ",\n".join(parts) + f",\nindexed AS (SELECT * FROM features {joins})"


_TRAIN_COLUMNS = """UniqueCarrier, Origin, Dest, "Month", DayofMonth, FlightNum, CRSDepTime,
  DepDelay, Distance, CRSArrTime, Diverted, Cancelled, RouteType"""
_STREAM_COLUMNS = _TRAIN_COLUMNS.replace("DepDelay, ", "")
_RAW_COLUMNS = """FL_DATE, OP_CARRIER, OP_CARRIER_FL_NUM, ORIGIN, DEST, DEP_TIME, DEP_DELAY,
  ARR_DELAY, TAXI_OUT, TAXI_IN, DISTANCE, AIR_TIME, CRS_ELAPSED_TIME, ACTUAL_ELAPSED_TIME,
  CARRIER_DELAY, WEATHER_DELAY, NAS_DELAY, SECURITY_DELAY, LATE_AIRCRAFT_DELAY, CANCELLED,
  DIVERTED"""
# an empty text comes back from CSV as null
_FROM_CSV = f"""SELECT * REPLACE (NULLIF(DISTANCE, '') AS DISTANCE)
FROM (SELECT {_RAW_COLUMNS} FROM raw)"""
_WHOLE = [c for c in (*_NUMBERS, *_CAUSES) if c not in ("CANCELLED", "DIVERTED")]
_INFERRED = f"""FL_DATE, OP_CARRIER, CAST(OP_CARRIER_FL_NUM AS INTEGER) AS OP_CARRIER_FL_NUM,
  ORIGIN, DEST, CAST(DEP_TIME AS INTEGER) AS DEP_TIME,
  {", ".join(f"TRY_CAST({c} AS INTEGER) AS {c}" for c in _WHOLE)},
  CAST(CANCELLED AS DOUBLE) AS CANCELLED, CAST(DIVERTED AS DOUBLE) AS DIVERTED"""

_PARTS_WITH_FILL = f"""SELECT {_STREAM_COLUMNS},
  DepHour, DepMinute, ArrHour, ArrMinute FROM features"""

_KAFKA_JSON = """SELECT '{"UniqueCarrier":"' || UniqueCarrier || '","Origin":"' || Origin
  || '","Dest":"' || Dest || '","Month":' || "Month" || ',"DayofMonth":' || DayofMonth
  || ',"FlightNum":"' || FlightNum || '","CRSDepTime":"' || CRSDepTime || '","Distance":'
  || COALESCE(CAST(Distance AS VARCHAR), 'null') || ',"CRSArrTime":"' || CRSArrTime
  || '","Diverted":' || Diverted || ',"Cancelled":' || Cancelled || ',"RouteType":"'
  || RouteType || '"}' AS value
FROM streamed"""

_METRICS = """classes AS (
  SELECT c, SUM(actual) AS actual, SUM(guessed) AS guessed, SUM(hits) AS hits FROM (
    SELECT CAST(label AS DOUBLE) AS c, 1 AS actual, 0 AS guessed,
      CASE WHEN label = prediction THEN 1 ELSE 0 END AS hits FROM predictions
    UNION ALL SELECT prediction, 0, 1, 0 FROM predictions) GROUP BY c)"""

_TEXT = " ".join(f"WHEN {k} THEN '{v}'" for k, v in CLASS_TEXT.items())

_COUNTED = "SELECT DelayCategory, COUNT(*) AS \"count\" FROM labelled GROUP BY 1"


def oracle_sql() -> dict[str, str]:
    raw, clean = [RAW], [RAW, CLEAN]
    train, features = [RAW, TRAIN], [RAW, TRAIN, FEATURES]
    landed = [PAYLOADS, NORMALIZED]
    links = [RAW, _pagerank()]
    vertices = ("SELECT DISTINCT ORIGIN AS id FROM raw UNION ALL "
                "SELECT DISTINCT DEST AS id FROM raw")
    out = {name: _sql(clean, body) for name, body in _REPORTS.items()}
    out |= {
        "scan_csv_raw": _sql(raw, _FROM_CSV),
        "scan_csv_inferred": _sql(raw, f"SELECT {_INFERRED} FROM raw"),
        "scan_csv_schema": _sql(train, f"SELECT {_TRAIN_COLUMNS} FROM train"),
        "scan_flight_json": _sql([PAYLOADS], "SELECT value FROM payloads"),
        "kafka_record_view": _sql([PAYLOADS], """SELECT 'flights' AS topic,
  CAST(event_id % 2 AS INTEGER) AS "partition", event_id // 2 AS "offset",
  CAST(event_id AS VARCHAR) AS "key", value,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS "timestamp"
FROM payloads"""),
        "message_source": "SELECT 'Message ' || event_id AS value FROM events",
        "write_report_roundtrip": _sql(clean, SEVERITY),
        "export_csv_roundtrip": _sql(landed, """SELECT * REPLACE (
  NULLIF(UniqueCarrier, '') AS UniqueCarrier, NULLIF(FlightNum, '') AS FlightNum,
  NULLIF(Origin, '') AS Origin, NULLIF(Dest, '') AS Dest)
FROM normalized"""),
        "land_raw": _sql(raw, _FROM_CSV),
        "to_kafka_json": _sql(landed, _KAFKA_JSON),
        "prune_airport": _sql(
            clean, "SELECT ORIGIN, DEP_DELAY, TAXI_OUT, TAXI_IN, CANCELLED, OP_CARRIER, DEST "
                   "FROM clean"),
        "clean_flights": _sql(
            clean, "SELECT * REPLACE (strftime(FL_DATE, '%Y-%m-%d %H:%M:%S') AS FL_DATE) "
                   "FROM clean"),
        "dep_hour": _sql(clean, "SELECT DEP_TIME, DEP_HOUR FROM clean"),
        "fill_numeric": _sql(
            clean, f"SELECT {', '.join(_FILLED)}, TAXI_IN, TAXI_OUT FROM filled"),
        "fill_all_numeric": _sql(clean, """SELECT OP_CARRIER, ORIGIN,
  COALESCE(DEP_DELAY, 0) AS DEP_DELAY, COALESCE(ARR_DELAY, 0) AS ARR_DELAY,
  COALESCE(AIR_TIME, 0) AS AIR_TIME, COALESCE(TAXI_IN, 0) AS TAXI_IN
FROM clean"""),
        "fill_strings": _sql(
            train, "SELECT ok, pk, sk, ln, "
            + ", ".join(f"COALESCE({c}, 'UNKNOWN') AS {c}" for c in CATEGORICAL) + " FROM train"),
        "filter_class": _sql(
            train, "SELECT ok, pk, sk, ln, DepDelay, DelayCategory FROM labelled "
                   "WHERE DelayCategory = 2"),
        "distance_band": _sql(
            clean, f"SELECT DISTANCE, {_BAND} AS DISTANCE_CATEGORY FROM clean"),
        "delay_severity_label": _sql(
            clean, f"SELECT CANCELLED, DIVERTED, ARR_DELAY, {_SEVERITY} AS DELAY_CATEGORY "
                   "FROM clean"),
        "delay_label": _sql(
            train, "SELECT ok, pk, sk, ln, DepDelay, DelayCategory FROM labelled"),
        "describe_prediction": _sql(
            train, f"SELECT label, prediction, CASE prediction {_TEXT} END AS DelayDescription "
                   "FROM predictions"),
        "airport_metrics_join": _sql(clean, AIRPORT),
        "top_airports": _sql(clean, AIRPORT + " ORDER BY total_departures DESC, ORIGIN LIMIT 5"),
        "report_row_counts": _sql(clean, " UNION ALL ".join(
            f"SELECT '{name}' AS report, COUNT(*) AS \"rows\" FROM ({body})"
            for name, body in _REPORTS.items())),
        "repartition_stable": _sql(clean, f"""SELECT k AS partitions, c.*
FROM (SELECT OP_CARRIER, COUNT(*) AS total_flights, {_mean("ARR_DELAY", "avg_arrival_delay")}
  FROM clean GROUP BY OP_CARRIER) c, (VALUES ('shuffle width'), ('twice the width')) AS v(k)"""),
        "aggregate_functions": _sql(clean, f"""SELECT OP_CARRIER, COUNT(*) AS flights,
  {_mean("DISTANCE", "mean_distance")},
  CAST(SUM(CASE WHEN ARR_DELAY > 15 THEN 1 ELSE 0 END) AS BIGINT) AS late_flights,
  MAX(ARR_DELAY) AS worst, {_rounded("STDDEV_SAMP(ARR_DELAY)")} AS spread,
  COUNT(DISTINCT ORIGIN) AS origins, quantile_disc(ARR_DELAY, 0.95) AS p95
FROM clean GROUP BY OP_CARRIER"""),
        "distinct_airports": _sql(raw, "SELECT DISTINCT ORIGIN FROM raw"),
        "union_classes": _sql(
            train, "SELECT ok, pk, sk, ln, DepDelay, DelayCategory FROM labelled"),
        "cast_numeric": _sql(raw, """SELECT FL_DATE, DISTANCE, CANCELLED, DEP_TIME,
  TRY_CAST(FL_DATE AS DOUBLE) AS date_number, TRY_CAST(DISTANCE AS DOUBLE) AS miles,
  TRY_CAST(CANCELLED AS DOUBLE) AS cancelled_number, TRY_CAST(DEP_TIME AS INTEGER) AS dep_number
FROM raw"""),
        "parse_date": _sql(raw, """SELECT FL_DATE,
  strftime(TRY_CAST(FL_DATE AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS flown FROM raw"""),
        "date_parts": _sql(clean, """SELECT CAST(month(FL_DATE) AS INTEGER) AS "MONTH",
  CAST(dayofweek(FL_DATE) + 1 AS INTEGER) AS DAY_OF_WEEK, CAST(day(FL_DATE) AS INTEGER) AS "DAY"
FROM clean"""),
        "round_half_up": f"""SELECT l_orderkey, l_linenumber, l_extendedprice,
  {_rounded("l_extendedprice", 1)} AS one_place, {_rounded("l_quantity / 8")} AS eighths
FROM lineitem""",
        "hhmm_parts": _sql(train, f"SELECT CRSDepTime, CRSArrTime, {_HHMM} FROM train"),
        "normalize_flights": _sql(landed, "SELECT * FROM normalized"),
        "normalize_flights_stream": _sql(landed, "SELECT * FROM streamed"),
        "rejected_flights": _sql(
            landed, "SELECT event_id, value, problem FROM problems WHERE problem IS NOT NULL"),
        "flights_in_window": _sql([PAYLOADS], """SELECT event_id, value FROM payloads
WHERE CAST(json_extract_string(value, '$.firstSeen') AS BIGINT)
  BETWEEN 1704800000 - 7 * 24 * 3600 AND 1704800000"""),
        "parse_flight_json": _sql(train, f"SELECT {_STREAM_COLUMNS} FROM train"),
        "graph_vertices": _sql(raw, vertices),
        "graph_edges": _sql(clean, """SELECT ORIGIN AS src, DEST AS dst,
  COALESCE(DISTANCE, 0) AS distance, COALESCE(DEP_DELAY, 0) AS departure_delay,
  COALESCE(ARR_DELAY, 0) AS arrival_delay, OP_CARRIER AS carrier,
  COALESCE(CANCELLED, 0) AS cancelled, COALESCE(DIVERTED, 0) AS diverted
FROM clean"""),
        "graph_counts": _sql(raw, f"""SELECT 'vertices' AS part, COUNT(*) AS total
FROM ({vertices}) UNION ALL SELECT 'edges', COUNT(*) FROM raw"""),
        "airport_pagerank": _sql(links, "SELECT id, pagerank FROM ranked"),
        "top_pagerank": _sql(
            links, "SELECT id, pagerank FROM ranked ORDER BY pagerank DESC, id LIMIT 10"),
        "ml_features": _sql(features, f"""SELECT ok, pk, sk, ln, UniqueCarrier, Origin, Dest,
  "Month", DayofMonth, CRSDepTime, DepDelay, Distance, CRSArrTime, Diverted, RouteType,
  DepHour, DepMinute, ArrHour, ArrMinute, DelayCategory
FROM features"""),
        "stream_preprocess": _sql(features, _PARTS_WITH_FILL),
        "class_distribution": _sql(train, _COUNTED),
        "class_counts": _sql(
            train, f"SELECT *, MAX(\"count\") OVER () AS largest FROM ({_COUNTED})"),
        "oversample_classes": _sql(
            train, f"SELECT *, MAX(\"count\") OVER () AS largest, TRUE AS as_wanted, "
                   f"TRUE AS spread_as_wanted FROM ({_COUNTED})"),
        "train_test_split": "SELECT COUNT(*) AS \"rows\", TRUE AS share_as_wanted FROM lineitem",
        "string_index": _sql([*features, _indexed()], "SELECT "
                             + ", ".join(f"{c}, {c}Index" for c in CATEGORICAL) + " FROM indexed"),
        "confusion_matrix": _sql(
            train, "SELECT label, prediction, COUNT(*) AS \"count\" FROM predictions "
                   "GROUP BY 1, 2"),
        "classification_metrics": _sql([*train, _METRICS], """SELECT
  ROUND(SUM(hits) / SUM(actual), 6) AS accuracy,
  ROUND(SUM(actual * 2.0 * hits / (actual + guessed)) / SUM(actual), 6) AS f1_score
FROM classes"""),
    }
    # what holds of a model whatever its weights are
    fitted = """SELECT COUNT(*) AS "rows", TRUE AS test_share_as_wanted,
  TRUE AS accuracy_as_counted, TRUE AS f1_as_counted FROM lineitem"""
    names = [*NUMERIC, *(f"{c}Vec" for c in CATEGORICAL)]
    out |= {
        "logistic_model": fitted,
        "random_forest_model": fitted,
        "feature_importance": "SELECT feature, TRUE AS is_share, TRUE AS sums_to_one FROM (VALUES "
                              + ", ".join(f"('{name}')" for name in names) + ") AS v(feature)",
        "model_metadata": f"""SELECT '{",".join(CATEGORICAL)}' AS categorical,
  '{",".join(NUMERIC)}' AS numeric, 100 AS numTrees, 10 AS maxDepth,
  'auto' AS featureSubsetStrategy, 'gini' AS impurity, TRUE AS metrics_are_shares, TRUE AS dated""",
        "ml_score_batch": _sql(
            train, "SELECT ok, pk, sk, ln, TRUE AS known_class, TRUE AS text_fits FROM train"),
        "ml_probabilities": _sql(train, """SELECT ok, pk, sk, ln, 4 AS classes,
  TRUE AS sums_to_one, TRUE AS best_is_predicted FROM train"""),
        "stream_score": _sql(features, """SELECT UniqueCarrier, Origin, Dest, CRSDepTime, Distance,
  COUNT(*) AS flights, TRUE AS as_batch FROM features GROUP BY 1, 2, 3, 4, 5"""),
    }
    sizes = " + ".join(f"(SELECT COUNT(*) + 1 FROM index_{c})" for c in CATEGORICAL)
    out["ml_vector"] = _sql([*features, _indexed()], f"""SELECT
  CAST({len(NUMERIC)} + {sizes} AS INTEGER) AS length,
  {", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in NUMERIC)},
  {", ".join(f"CAST({c}Index AS BIGINT) AS {c}VecSlot" for c in CATEGORICAL)}
FROM indexed""")
    out |= incremental.oracle_sql(PAYLOADS, landed, out)
    return out
