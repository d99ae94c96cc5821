"""The test views and every operator's expected result in SQL."""

from __future__ import annotations

FLIGHT_COLUMNS = [
    "FlightDate", "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "Reporting_Airline",
    "IATA_CODE_Reporting_Airline", "DOT_ID_Reporting_Airline", "Tail_Number",
    "Flight_Number_Reporting_Airline", "OriginAirportID", "Origin", "OriginCityName",
    "OriginState", "OriginStateFips", "OriginStateName", "DestAirportID", "Dest",
    "DestCityName", "DestState", "DestStateFips", "DestStateName", "CRSDepTime", "DepTime",
    "CRSArrTime", "ArrTime", "DepDelay", "ArrDelay", "DepDel15", "Cancelled", "Diverted",
    "CancellationCode", "Distance", "AirTime", "CarrierDelay", "WeatherDelay", "NASDelay",
    "SecurityDelay", "LateAircraftDelay",
]
CURATED = [name for name in FLIGHT_COLUMNS if name not in ("DepDel15", "AirTime")]
CAUSES = FLIGHT_COLUMNS[-5:]


def _airport(role: str, number: str) -> str:
    return f"""
      10000 + {number} AS {role}AirportID,
      'A' || lpad(CAST({number} AS VARCHAR), 2, '0') AS {role},
      'City' || CAST({number} AS VARCHAR) AS {role}CityName,
      'S' || CAST({number} % 5 AS VARCHAR) AS {role}State,
      {number} % 5 AS {role}StateFips,
      'State' || CAST({number} % 5 AS VARCHAR) AS {role}StateName"""


def _cause(name: str, minutes: str) -> str:
    return f"CASE WHEN fd >= DATE '1998-01-01' AND dd >= 15 THEN CAST({minutes} AS DOUBLE) END AS {name}"


_LINES = """
lines AS (
  SELECT *, CAST(l_shipdate AS DATE) AS fd, l_suppkey % 12 AS onum, o_custkey % 12 AS dnum,
         l_returnflag = 'R' AND l_partkey % 10 = 0 AS cx
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
),
marked AS (
  SELECT *, CASE WHEN NOT cx THEN l_quantity - 20 END AS dd,
         NOT cx AND l_linestatus = 'F' AND l_partkey % 50 = 1 AS dv
  FROM lines
)"""

_FL = f"""{_LINES},
lfl AS (
  SELECT l_linenumber AS line,
      fd AS FlightDate,
      CAST(extract(year FROM fd) AS INTEGER) AS Year,
      CAST(extract(quarter FROM fd) AS INTEGER) AS Quarter,
      CAST(extract(month FROM fd) AS INTEGER) AS Month,
      CAST(extract(day FROM fd) AS INTEGER) AS DayofMonth,
      CAST(extract(isodow FROM fd) AS INTEGER) AS DayOfWeek,
      'C' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS Reporting_Airline,
      'C' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS IATA_CODE_Reporting_Airline,
      CAST(19000 + s_nationkey AS BIGINT) AS DOT_ID_Reporting_Airline,
      'N' || CAST(l_partkey AS VARCHAR) AS Tail_Number,
      l_orderkey % 1000 AS Flight_Number_Reporting_Airline,
      {_airport("Origin", "onum")},
      {_airport("Dest", "dnum")},
      (l_partkey % 25) * 100 + l_orderkey % 60 AS CRSDepTime,
      CASE WHEN NOT cx THEN (l_partkey % 24) * 100 + l_orderkey % 60 END AS DepTime,
      (l_partkey % 22) * 100 + l_linenumber AS CRSArrTime,
      CASE WHEN NOT cx AND NOT (NOT dv AND l_partkey % 97 = 3)
           THEN (l_partkey % 23) * 100 + l_linenumber END AS ArrTime,
      dd AS DepDelay,
      CASE WHEN NOT dv THEN dd + l_linenumber - 4 END AS ArrDelay,
      CASE WHEN NOT cx THEN CASE WHEN dd >= 15 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
           END AS DepDel15,
      CASE WHEN cx THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Cancelled,
      CASE WHEN dv THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Diverted,
      CASE WHEN cx THEN CASE l_suppkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'A' WHEN 2 THEN 'B'
           WHEN 3 THEN 'C' ELSE 'D' END END AS CancellationCode,
      CAST(200 + onum * 150 + dnum * 10 AS DOUBLE) AS Distance,
      round(CAST(200 + onum * 150 + dnum * 10 AS DOUBLE) / 8) AS AirTime,
      {_cause("CarrierDelay", "l_partkey % 30")},
      {_cause("WeatherDelay", "l_suppkey % 7")},
      {_cause("NASDelay", "l_orderkey % 13")},
      {_cause("SecurityDelay", "l_linenumber % 2")},
      {_cause("LateAircraftDelay", "o_custkey % 17")}
  FROM marked
),
fl AS (SELECT {", ".join(FLIGHT_COLUMNS)} FROM lfl),
copied AS (SELECT * FROM fl UNION ALL SELECT {", ".join(FLIGHT_COLUMNS)} FROM lfl WHERE line = 1),
untidy AS (
  SELECT * REPLACE (CASE WHEN CRSDepTime % 7 <> 0 THEN Dest END AS Dest)
  FROM (SELECT * FROM fl UNION ALL
        SELECT * REPLACE ('  ' || OriginCityName || ' ' AS OriginCityName)
        FROM (SELECT {", ".join(FLIGHT_COLUMNS)} FROM lfl WHERE line = 1))
)"""

_CODE = ("CASE WHEN Cancelled = 1 AND CancellationCode IN ('A', 'B', 'C', 'D') "
         "THEN CancellationCode END")
_KEY = ("CAST(FlightDate AS VARCHAR) || '_' || IATA_CODE_Reporting_Airline || "
        "CAST(Flight_Number_Reporting_Airline AS VARCHAR) || '_' || Origin || '_' || Dest")


def _order(columns: list[str]) -> str:
    return ", ".join(f"{name} ASC NULLS FIRST" for name in columns)


_DELAY_COLUMNS = ["fact_key", "DepDelay", "ArrDelay", *CAUSES]
_AIRPORT_COLUMNS = ["AirportID", "AirportCode", "CityName", "State", "StateFips", "StateName"]
_AIRLINE_COLUMNS = ["IATA_CODE_Reporting_Airline", "Reporting_Airline",
                    "DOT_ID_Reporting_Airline"]


def _role(prefix: str) -> str:
    return (f"SELECT {prefix}AirportID AS AirportID, {prefix} AS AirportCode, "
            f"{prefix}CityName AS CityName, {prefix}State AS State, "
            f"{prefix}StateFips AS StateFips, {prefix}StateName AS StateName FROM cf")


def _numbered(rows: str, columns: list[str], id_column: str) -> str:
    return (f"SELECT *, CAST(row_number() OVER (ORDER BY {_order(columns)}) AS BIGINT) "
            f"AS {id_column} FROM ({rows})")


_STAR = f"""{_FL},
cf AS (
  SELECT {", ".join(CURATED)} FROM (
    SELECT * REPLACE ({_CODE} AS CancellationCode) FROM fl
    WHERE FlightDate IS NOT NULL AND Cancelled IN (0, 1) AND Diverted IN (0, 1)
      AND ((DepTime IS NOT NULL AND ArrTime IS NOT NULL) OR Cancelled = 1))
),
d_time AS ({_numbered('''SELECT DISTINCT FlightDate,
    CAST(extract(year FROM FlightDate) AS INTEGER) AS Year,
    CAST(extract(quarter FROM FlightDate) AS INTEGER) AS Quarter,
    CAST(extract(month FROM FlightDate) AS INTEGER) AS Month,
    CAST(extract(day FROM FlightDate) AS INTEGER) AS DayOfMonth,
    CAST(extract(isodow FROM FlightDate) AS INTEGER) AS DayOfWeek FROM cf''',
    ["FlightDate"], "time_id")}),
d_airport AS ({_numbered(_role("Origin") + " UNION " + _role("Dest"), _AIRPORT_COLUMNS,
                         "airport_id")}),
d_airline AS ({_numbered(f"SELECT DISTINCT {', '.join(_AIRLINE_COLUMNS)} FROM cf",
                         _AIRLINE_COLUMNS, "airline_id")}),
d_delay AS ({_numbered(f'''SELECT DISTINCT {_KEY} AS fact_key, DepDelay, ArrDelay,
    {", ".join(CAUSES)} FROM cf WHERE Cancelled = 0 AND Diverted = 0''',
    _DELAY_COLUMNS, "delay_id")}),
d_cancel AS ({_numbered(f'''SELECT DISTINCT {_KEY} AS fact_key, CancellationCode FROM cf
    WHERE Cancelled = 1''', ["fact_key", "CancellationCode"], "cancellation_id")}),
d_delay1 AS (SELECT * FROM d_delay
             QUALIFY row_number() OVER (PARTITION BY fact_key ORDER BY delay_id) = 1),
d_cancel1 AS (SELECT * FROM d_cancel
              QUALIFY row_number() OVER (PARTITION BY fact_key ORDER BY cancellation_id) = 1),
kf AS (SELECT *, {_KEY} AS fact_key FROM cf)"""

FACT = [
    "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline",
    "Tail_Number", "fact_key", "OriginAirportID", "Origin", "DestAirportID", "Dest",
    "CRSDepTime", "DepTime", "CRSArrTime", "ArrTime", "Distance", "Cancelled", "Diverted",
]
NARROW_FACT = [
    "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline",
    "Tail_Number", "OriginAirportID", "DestAirportID", "CRSDepTime", "DepTime", "DepDelay",
    "CRSArrTime", "ArrTime", "ArrDelay", "Cancelled", "Diverted",
]

_STATUS = """
stops AS (
  SELECT *, strftime(ts, '%Y-%m-%d') AS flight_date,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS dep_iso,
         strftime(ts + INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS arr_iso,
         date_trunc('second', ts) AS dep_at, date_trunc('second', ts) + INTERVAL 2 HOUR AS arr_at,
         'A' || lpad(CAST(user_id % 12 AS VARCHAR), 2, '0') AS dep,
         'A' || lpad(CAST(event_id % 12 AS VARCHAR), 2, '0') AS arr,
         'C' || lpad(CAST(user_id % 20 AS VARCHAR), 2, '0') AS carrier,
         CAST(event_id % 900 AS VARCHAR) AS number,
         CAST(event_id % 500 AS VARCHAR) AS partner,
         CAST(trunc(value) AS INTEGER) AS late
  FROM events
),
status AS (
  SELECT *, CASE WHEN event_id % 11 <> 0 THEN carrier || number END AS flight_iata,
         CASE WHEN event_id % 3 <> 0 THEN 'G' || CAST(event_id % 40 AS VARCHAR) END AS gate,
         CASE WHEN event_id % 4 <> 0 THEN late END AS dep_delay,
         CASE WHEN event_id % 6 <> 0 THEN late END AS arr_delay,
         event_id % 5 = 0 AS shared
  FROM stops
),
flat AS (
  SELECT flight_date || '_' || coalesce(flight_iata, '') || '_' || dep || '_' || arr AS flight_id,
    flight_date, event_type AS flight_status,
    'Airport ' || dep AS departure_airport, 'UTC' AS departure_timezone,
    dep AS departure_iata, 'K' || dep AS departure_icao,
    CAST(user_id % 12 % 4 AS VARCHAR) AS departure_terminal, gate AS departure_gate,
    dep_delay AS departure_delay, dep_at AS departure_scheduled, dep_at AS departure_estimated,
    CASE WHEN event_id % 2 = 0 THEN dep_at END AS departure_actual,
    CAST(NULL AS TIMESTAMP) AS departure_estimated_runway,
    CAST(NULL AS TIMESTAMP) AS departure_actual_runway,
    'Airport ' || arr AS arrival_airport, 'UTC' AS arrival_timezone, arr AS arrival_iata,
    'K' || arr AS arrival_icao, CAST(event_id % 12 % 4 AS VARCHAR) AS arrival_terminal,
    gate AS arrival_gate, CAST(event_id % 9 AS VARCHAR) AS arrival_baggage,
    arr_delay AS arrival_delay, arr_at AS arrival_scheduled, arr_at AS arrival_estimated,
    CASE WHEN event_id % 2 = 0 THEN arr_at END AS arrival_actual,
    CAST(NULL AS TIMESTAMP) AS arrival_estimated_runway,
    CAST(NULL AS TIMESTAMP) AS arrival_actual_runway,
    carrier AS airline_id, number AS flight_number,
    CASE WHEN shared THEN 'PX' || partner END AS codeshared_flight_id
  FROM status
)"""


def _stop_json(prefix: str, code: str, number: str, iso: str, delay: str, baggage: str) -> str:
    return f"""{{'airport': 'Airport ' || {code}, 'timezone': 'UTC', 'iata': {code},
      'icao': 'K' || {code}, 'terminal': CAST({number} % 12 % 4 AS VARCHAR), 'gate': gate,
      {baggage} 'delay': CAST({delay} AS VARCHAR), 'scheduled': {iso}, 'estimated': {iso},
      'actual': CASE WHEN event_id % 2 = 0 THEN {iso} END,
      'estimated_runway': CAST(NULL AS VARCHAR), 'actual_runway': CAST(NULL AS VARCHAR)}}"""


def _when_shared(text: str) -> str:
    return f"CASE WHEN shared THEN {text} END"


_CODESHARED_JSON = ", ".join(f"'{name}': {_when_shared(text)}" for name, text in [
    ("airline_name", "'Partner'"), ("airline_iata", "'PX'"), ("airline_icao", "'PXX'"),
    ("flight_number", "partner"), ("flight_iata", "'PX' || partner"),
    ("flight_icao", "'PXX' || partner")])

_RIDES = f"""{_LINES},
rides AS (
  SELECT CAST(l_suppkey % 2 + 1 AS VARCHAR) AS VendorID,
    l_shipdate AS tpep_pickup_datetime,
    l_shipdate + to_minutes(l_partkey % 50) AS tpep_dropoff_datetime,
    l_linenumber % 5 AS passenger_count, l_quantity / 4 AS trip_distance, 1 AS RatecodeID,
    CASE WHEN l_returnflag = 'R' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CAST(l_partkey % 260 + 1 AS INTEGER) AS PULocationID,
    CAST(o_custkey % 260 + 1 AS INTEGER) AS DOLocationID,
    CAST(l_linenumber % 4 + 1 AS VARCHAR) AS payment_type, l_quantity AS fare_amount,
    CAST(0.5 AS DOUBLE) AS extra, CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(l_partkey % 800 AS DOUBLE) / 100 AS tip_amount, CAST(0 AS DOUBLE) AS tolls_amount,
    CAST(0.3 AS DOUBLE) AS improvement_surcharge,
    CAST(CAST(l_quantity + 1.3 AS DECIMAL(10,2)) AS DOUBLE) AS total_amount,
    CAST(2.5 AS DOUBLE) AS congestion_surcharge
  FROM marked
)"""


def _with(views: str, query: str) -> str:
    return f"WITH {views.strip()}\n{query.strip()}"


def _percent(part: str, whole: str) -> str:
    return (f"CAST(round(CAST(CAST({part} AS DOUBLE) * 100.0::DOUBLE / {whole} "
            f"AS DECIMAL(38,10)), 2) AS DOUBLE)")


_COUNT = "CAST(count(*) AS BIGINT)"
_CANCELLED = "CAST(count(*) FILTER (WHERE Cancelled = 1) AS BIGINT)"
_LATE = "CAST(count(*) FILTER (WHERE DepDel15 = 1) AS BIGINT)"
_DAY_NAME = ("CASE DayOfWeek WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' WHEN 3 THEN 'Wednesday' "
             "WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' WHEN 6 THEN 'Saturday' "
             "WHEN 7 THEN 'Sunday' END")
_REASON = ("CASE CancellationCode WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather' "
           "WHEN 'C' THEN 'National Air System' WHEN 'D' THEN 'Security' ELSE 'Unknown' END")
_MEANS = "avg(DepDelay) AS avg_departure_delay, avg(ArrDelay) AS avg_arrival_delay"
_RATE = "CAST(count(*) FILTER (WHERE Cancelled = 1) AS DOUBLE) / count(*) * 100"
_DRAW = ("md5(concat_ws('|', CAST(FlightDate AS VARCHAR), Tail_Number, "
         "CAST(Flight_Number_Reporting_Airline AS VARCHAR), Origin, Dest, "
         "CAST(CRSDepTime AS VARCHAR)))")


def _number_of(digest: str) -> str:
    return f"CAST('0x' || substr({digest}, 1, 8) AS BIGINT) / 4294967296.0"


def _rest(*used: str) -> str:
    return _order([name for name in FLIGHT_COLUMNS if name not in used])


_BY_YEAR = f"""SELECT Year, {_COUNT} AS total_flights, {_MEANS},
  avg(CarrierDelay) AS avg_carrier_delay, avg(WeatherDelay) AS avg_weather_delay,
  avg(NASDelay) AS avg_nas_delay, avg(SecurityDelay) AS avg_security_delay,
  avg(LateAircraftDelay) AS avg_late_aircraft_delay, {_CANCELLED} AS cancelled_flights,
  {_LATE} AS delayed_flights_15min FROM fl GROUP BY Year ORDER BY Year"""
_TOP_AIRLINES = f"""SELECT Reporting_Airline, {_COUNT} AS total_flights, {_MEANS},
  {_CANCELLED} AS cancelled_flights,
  {_percent("count(*) FILTER (WHERE Cancelled = 1)", "count(*)")} AS cancellation_rate,
  {_percent("count(*) FILTER (WHERE DepDel15 = 1)", "count(*)")} AS delay_rate_15min
  FROM fl GROUP BY Reporting_Airline HAVING count(*) > 1000
  ORDER BY total_flights DESC, Reporting_Airline LIMIT 20"""
_TOP_ROUTES = f"""SELECT Origin || ' → ' || Dest AS route, Origin, Dest, {_COUNT} AS total_flights,
  {_MEANS}, avg(Distance) AS avg_distance, {_CANCELLED} AS cancelled_flights
  FROM fl GROUP BY Origin, Dest HAVING count(*) > 100
  ORDER BY total_flights DESC, Origin, Dest LIMIT 30"""
_MONTHS = f"""SELECT Month, {_COUNT} AS total_flights, {_MEANS}, {_CANCELLED} AS cancelled_flights,
  avg(Distance) AS avg_distance FROM fl GROUP BY Month ORDER BY Month"""
_WEEKDAYS = f"""SELECT DayOfWeek, {_DAY_NAME} AS day_name, {_COUNT} AS total_flights, {_MEANS},
  {_CANCELLED} AS cancelled_flights FROM fl GROUP BY DayOfWeek ORDER BY DayOfWeek"""
_REASONS = f"""SELECT CancellationCode, {_REASON} AS cancellation_reason,
  {_COUNT} AS cancellation_count,
  {_percent("count(*)", "sum(count(*)) OVER ()")} AS percentage
  FROM fl WHERE Cancelled = 1 AND CancellationCode IS NOT NULL GROUP BY CancellationCode
  ORDER BY cancellation_count DESC, CancellationCode"""
_SAMPLE_1998 = f"""SELECT {", ".join(FLIGHT_COLUMNS)} FROM fl WHERE Year = 1998
  ORDER BY {_DRAW}, {_rest()} LIMIT 1000"""

_NULL_COUNTED = [
    "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline",
    "OriginAirportID", "DestAirportID", "Reporting_Airline", "DOT_ID_Reporting_Airline",
    "Dest", "DepTime", "ArrTime", "CancellationCode",
]


def _reported(name: str, total: str, query: str) -> str:
    return (f"SELECT '{name}' AS analysis, {_COUNT} AS result_rows, "
            f"CAST(sum({total}) AS BIGINT) AS flights FROM ({query})")


def _dim_columns(table: str, alias: str, prefix: str, skip: list[str], plain: str) -> str:
    names = {
        "d_time": ["Year", "Quarter", "Month", "DayOfMonth", "DayOfWeek", "time_id"],
        "d_airport": [*_AIRPORT_COLUMNS, "airport_id"],
        "d_airline": [*_AIRLINE_COLUMNS, "airline_id"],
        "d_delay1": [*_DELAY_COLUMNS, "delay_id"],
        "d_cancel1": ["fact_key", "CancellationCode", "cancellation_id"],
    }[table]
    return ", ".join(f"{alias}.{name} AS {name if name == plain else prefix + name}"
                     for name in names if name not in skip)


_JOINED_FLIGHT = "k.fact_key, k.Tail_Number, k.CRSDepTime, k.ArrTime"

# Lines of the untidy CSV whose Distance token is no number.
BAD_FLIGHT_NUMBER = 13


_TOTALS = f"""CAST(count(*) FILTER (WHERE Flight_Number_Reporting_Airline <> {BAD_FLIGHT_NUMBER})
                 AS BIGINT) AS total_rows,
            CAST(count(*) FILTER (WHERE Flight_Number_Reporting_Airline = {BAD_FLIGHT_NUMBER})
                 AS BIGINT) AS total_bad_rows"""


def oracles() -> dict[str, str]:
    everything = "SELECT * FROM fl"
    return {
        # sources and sinks
        "src_csv_roundtrip": _with(_FL, everything),
        "sql_passthrough": _with(_FL, f"""SELECT Origin, {_COUNT} AS flights FROM fl
            WHERE Year = 1998 GROUP BY Origin ORDER BY Origin"""),
        "partitioned_roundtrip": _with(_FL, everything),
        "compact_parquet": _with(_FL, everything),
        "compact_partitions": _with(_FL, f"""SELECT Year, Month, {_COUNT} AS rows,
            sum(Distance) AS distance, 1 AS files FROM fl WHERE Year = 1998 GROUP BY ALL"""),
        # Without a null token, quoted-empty text reads as null.
        "convert_csv": _with(_FL, """SELECT * REPLACE (nullif(CancellationCode, '')
            AS CancellationCode) FROM fl"""),
        "load_tolerant_csv": _with(_FL, f"""{everything}
            WHERE Flight_Number_Reporting_Airline <> {BAD_FLIGHT_NUMBER}"""),
        "load_report": _with(_FL, f"""SELECT true AS all_files, true AS all_bytes,
            {_TOTALS} FROM fl"""),
        "load_unclosed_quote": _with(_FL, f"SELECT {_TOTALS} FROM fl"),
        "load_quoted_breaks": _with(_FL, f"""SELECT true AS good, {_COUNT} AS rows,
            sum(Distance) AS distance, CAST(count(*) FILTER (
                WHERE Flight_Number_Reporting_Airline = {BAD_FLIGHT_NUMBER}) AS BIGINT) AS broken
            FROM fl"""),
        "load_years_missing_file": _with(_FL, f"""SELECT Year, Month, {_COUNT} AS rows,
            (SELECT {_COUNT} FROM fl WHERE Year = 1998 AND Month = 5) AS total_rows,
            (SELECT {_COUNT} FROM fl WHERE Year = 1998 AND Month = 6 AND Origin = 'A00')
                AS total_bad_rows
            FROM fl WHERE Year = 1998 AND Month IN (5, 6) GROUP BY ALL"""),
        "load_month_emptied": _with(_FL, f"""SELECT Year, Month, {_COUNT} AS rows FROM fl
            WHERE Year = 1998 AND Month = 6 GROUP BY ALL"""),
        "load_batches": _with(_FL, f"""SELECT Year, Month, {_COUNT} AS rows, run,
            2 * (SELECT {_COUNT} FROM fl WHERE Year = 1998 AND Month = 6) AS rejected,
            1 AS files, (SELECT {_COUNT} FROM fl WHERE Year = 1998 AND Month = 6) AS loaded
            FROM fl, range(1, 3) r(run)
            WHERE Year = 1998 AND Month IN (5, 6, 7) AND (run = 2 OR Month <> 6) GROUP BY ALL"""),
        "load_all": _with(_FL, everything),
        "load_years": _with(_FL, f"""{everything} WHERE Year BETWEEN 1996 AND 1998
            AND Month BETWEEN 6 AND 8"""),
        "load_month": _with(_FL, f"{everything} WHERE Year = 1998 AND Month = 3"),
        "load_month_stray_rows": _with(
            _FL, f"{everything} WHERE Year = 1998 AND Month IN (5, 6)"),
        "dataset_summary": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, {_COUNT} AS num_rows FROM {name}"
            for name in ("lineitem", "orders", "events")),
        "catalog_summary": _with(_FL, f"""SELECT 'flights_raw' AS table_name, {_COUNT} AS num_rows,
            'Year,Month' AS partitioning, 'Reporting_Airline,Origin,Dest' AS clustering,
            true AS all_bytes, sum(Distance) AS distance FROM fl
            UNION ALL SELECT 'flights_processed', 0, 'event_date', 'airline,origin,destination',
              true, NULL
            UNION ALL SELECT 'flights_analytics', 0, 'year,month', 'airline,origin,destination',
              true, NULL"""),
        "export_roundtrip": _with(_FL, _BY_YEAR),
        "export_json_roundtrip": _with(_FL, _BY_YEAR),
        "export_parquet_roundtrip": _with(_FL, _BY_YEAR),
        "observed_counts": _with(_FL, f"SELECT {_COUNT} AS rows FROM fl"),
        "to_messages": _with(_STATUS, f"""SELECT
            CAST(to_json({{'flight_id': flight_date || '_' || coalesce(flight_iata, '') || '_'
              || dep || '_' || arr}}) AS VARCHAR) AS key,
            CAST(to_json({{'flight_date': flight_date, 'flight_status': event_type,
              'departure': {_stop_json("departure", "dep", "user_id", "dep_iso", "dep_delay", "")},
              'arrival': {_stop_json("arrival", "arr", "event_id", "arr_iso", "arr_delay",
                                     "'baggage': CAST(event_id % 9 AS VARCHAR),")},
              'airline': {{'name': 'Airline ' || CAST(user_id % 20 AS VARCHAR), 'iata': carrier,
                           'icao': 'I' || carrier}},
              'flight': {{'number': number, 'iata': flight_iata, 'icao': 'I' || number,
                          'codeshared': {{{_CODESHARED_JSON}}}}}}}) AS VARCHAR) AS value
            FROM status"""),
        "payload_explode": _with(_STATUS, """SELECT flight_date, event_type AS flight_status,
            dep AS departure_iata, dep_delay AS departure_delay, number AS flight_number
            FROM status UNION ALL
            SELECT flight_date, event_type, dep, dep_delay, number FROM status
            WHERE event_id % 3 = 0"""),
        "payload_normalise": _with(_STATUS, """SELECT number AS flight_number,
            CAST(dep_delay AS VARCHAR) AS departure_delay,
            CAST(arr_delay AS VARCHAR) AS arrival_delay, true AS has_codeshared,
            CASE WHEN shared THEN 'PX' || partner END AS codeshared_iata FROM status"""),
        "ride_read": _with(_RIDES, "SELECT * FROM rides"),
        "ride_to_messages": _with(_RIDES, """SELECT CAST(PULocationID AS VARCHAR) AS key,
            VendorID AS vendor, strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') AS pickup,
            CAST(DOLocationID AS VARCHAR) AS dropoff_location,
            CAST(total_amount AS DOUBLE) AS total_amount FROM rides"""),
        "ride_decode": _with(_RIDES, "SELECT PULocationID AS key, * FROM rides"),

        # cleaning and projections
        "clean_flights": _with(_STAR, "SELECT * FROM cf"),
        "cancellation_code_norm": _with(_FL, f"""SELECT * REPLACE ({_CODE} AS CancellationCode)
            FROM fl"""),
        "trim_strings": _with(_FL, """SELECT * REPLACE (trim(OriginCityName) AS OriginCityName)
            FROM untidy"""),
        "dropna_critical": _with(_FL, "SELECT * FROM untidy WHERE Dest IS NOT NULL"),
        "clean_flights_dedup": _with(_FL, """SELECT DISTINCT *
            REPLACE (trim(OriginCityName) AS OriginCityName) FROM untidy
            WHERE Dest IS NOT NULL"""),
        "distinct_rows": _with(_FL, "SELECT DISTINCT * FROM copied"),
        "data_quality": _with(_FL, " UNION ALL ".join(
            f"""SELECT '{name}' AS column_name, {_COUNT} AS total_rows,
            CAST(count(*) FILTER (WHERE {name} IS NULL) AS BIGINT) AS null_count FROM untidy"""
            for name in _NULL_COUNTED)),
        "hhmm_timestamp": _with(_FL, """SELECT FlightDate, CRSDepTime, Tail_Number,
            CASE WHEN CRSDepTime < 2400 THEN CAST(FlightDate AS TIMESTAMP)
              + to_minutes(CRSDepTime // 100 * 60 + CRSDepTime % 100) END AS departs,
            CASE WHEN CRSDepTime <= 2400 THEN CAST(FlightDate AS TIMESTAMP)
              + to_minutes(CRSDepTime // 100 * 60 + CRSDepTime % 100) END AS departs_rolled
            FROM fl"""),
        "bi_flights": _with(_FL, f"""SELECT FlightDate, Year, Quarter, Month, Reporting_Airline,
            Flight_Number_Reporting_Airline AS Flight_Number, Origin, OriginCityName, Dest,
            DestCityName, CASE WHEN CRSDepTime < 2400 THEN CAST(FlightDate AS TIMESTAMP)
              + to_minutes(CRSDepTime // 100 * 60 + CRSDepTime % 100) END AS CRSDepTimestamp,
            DepDelay, ArrDelay, CASE WHEN DepDel15 = 1 THEN 1 ELSE 0 END AS Is_Delayed,
            CASE WHEN Cancelled = 1 THEN 1 ELSE 0 END AS Is_Cancelled,
            {", ".join(f"coalesce({name}, 0::DOUBLE) AS {name}" for name in CAUSES)} FROM fl"""),
        "fact_key": _with(_FL, f"SELECT Tail_Number, CRSDepTime, {_KEY} AS fact_key FROM untidy"),
        "fact_flights_projection": _with(_FL, f"SELECT {', '.join(NARROW_FACT)} FROM fl"),
        "daily_mart": _with(_FL, f"""SELECT FlightDate AS date, Reporting_Airline AS airline,
            Origin AS origin, Dest AS destination, {_COUNT} AS total_flights,
            {_CANCELLED} AS cancelled_flights,
            CAST(count(*) FILTER (WHERE Diverted = 1) AS BIGINT) AS diverted_flights, {_MEANS},
            sum(Distance) AS total_distance, avg(AirTime) AS avg_air_time FROM fl
            GROUP BY ALL"""),
        "route_frequency": _with(_FL, f"""SELECT Origin, Dest, {_COUNT} AS count FROM fl
            GROUP BY Origin, Dest"""),

        # star schema
        "dim_time": _with(_STAR, "SELECT * FROM d_time"),
        "dim_airports": _with(_STAR, "SELECT * FROM d_airport"),
        "dim_airlines": _with(_STAR, "SELECT * FROM d_airline"),
        "dim_delays": _with(_STAR, "SELECT * FROM d_delay"),
        "dim_cancellations": _with(_STAR, "SELECT * FROM d_cancel"),
        "join_dim_time": _with(_STAR, f"""SELECT {_JOINED_FLIGHT}, k.FlightDate,
            {_dim_columns("d_time", "d", "time_", ["FlightDate"], "time_id")}
            FROM kf k LEFT JOIN d_time d ON k.FlightDate = d.FlightDate"""),
        "join_airport_roles": _with(_STAR, f"""SELECT {_JOINED_FLIGHT}, k.OriginAirportID,
            k.DestAirportID, {_dim_columns("d_airport", "o", "origin_", ["AirportID"], "")},
            {_dim_columns("d_airport", "d", "dest_", ["AirportID"], "")}
            FROM kf k LEFT JOIN d_airport o ON k.OriginAirportID = o.AirportID
            LEFT JOIN d_airport d ON k.DestAirportID = d.AirportID"""),
        "join_dim_airline": _with(_STAR, f"""SELECT {_JOINED_FLIGHT},
            k.IATA_CODE_Reporting_Airline, d.Reporting_Airline AS airline_Reporting_Airline,
            d.airline_id FROM kf k LEFT JOIN d_airline d
            ON k.IATA_CODE_Reporting_Airline = d.IATA_CODE_Reporting_Airline
            AND k.DOT_ID_Reporting_Airline = d.DOT_ID_Reporting_Airline"""),
        "join_dim_delay": _with(_STAR, f"""SELECT {_JOINED_FLIGHT},
            {_dim_columns("d_delay1", "d", "delay_", ["fact_key"], "delay_id")}
            FROM kf k LEFT JOIN d_delay1 d ON k.fact_key = d.fact_key"""),
        "join_dim_cancel": _with(_STAR, f"""SELECT {_JOINED_FLIGHT},
            {_dim_columns("d_cancel1", "d", "cancellation_", ["fact_key"], "cancellation_id")}
            FROM kf k LEFT JOIN d_cancel1 d ON k.fact_key = d.fact_key"""),
        "fact_table": _with(_STAR, f"SELECT DISTINCT {', '.join(FACT)} FROM kf"),
        "fact_table_smj": _with(_STAR, f"SELECT DISTINCT {', '.join(FACT)} FROM kf"),
        "fact_table_with_ids": _with(_STAR, f"""SELECT DISTINCT
            {", ".join("k." + name for name in FACT)}, t.time_id,
            o.airport_id AS origin_airport_id, d.airport_id AS dest_airport_id, a.airline_id,
            y.delay_id, c.cancellation_id
            FROM kf k LEFT JOIN d_time t ON k.FlightDate = t.FlightDate
            LEFT JOIN d_airport o ON k.OriginAirportID = o.AirportID
            LEFT JOIN d_airport d ON k.DestAirportID = d.AirportID
            LEFT JOIN d_airline a
              ON k.IATA_CODE_Reporting_Airline = a.IATA_CODE_Reporting_Airline
              AND k.DOT_ID_Reporting_Airline = a.DOT_ID_Reporting_Airline
            LEFT JOIN d_delay1 y ON k.fact_key = y.fact_key
            LEFT JOIN d_cancel1 c ON k.fact_key = c.fact_key"""),
        "fact_table_bucketed": _with(_STAR, f"""SELECT DISTINCT
            {", ".join("k." + name for name in FACT)}, y.delay_id, c.cancellation_id
            FROM kf k LEFT JOIN d_delay1 y ON k.fact_key = y.fact_key
            LEFT JOIN d_cancel1 c ON k.fact_key = c.fact_key"""),

        # analyses
        "table_info": _with(_FL, f"""SELECT {_COUNT} AS total_rows,
            count(DISTINCT Year) AS unique_years, min(Year) AS min_year, max(Year) AS max_year,
            count(DISTINCT Reporting_Airline) AS unique_airlines,
            count(DISTINCT Origin) AS unique_origins, count(DISTINCT Dest) AS unique_destinations
            FROM fl"""),
        "table_summary": _with(_FL, f"""SELECT {_COUNT} AS total_rows,
            count(DISTINCT Reporting_Airline) AS unique_airlines,
            count(DISTINCT Origin) AS unique_origins,
            count(DISTINCT Dest) AS unique_destinations, min(FlightDate) AS earliest_date,
            max(FlightDate) AS latest_date, avg(DepDelay) AS avg_dep_delay,
            avg(ArrDelay) AS avg_arr_delay,
            CAST(count(*) FILTER (WHERE Cancelled > 0) AS BIGINT) AS cancelled_flights,
            CAST(count(*) FILTER (WHERE Diverted > 0) AS BIGINT) AS diverted_flights FROM fl"""),
        "delays_by_year": _with(_FL, _BY_YEAR),
        "top_airlines": _with(_FL, _TOP_AIRLINES),
        "top_routes": _with(_FL, _TOP_ROUTES),
        "monthly_trends": _with(_FL, _MONTHS),
        "day_of_week": _with(_FL, _WEEKDAYS),
        "cancellation_analysis": _with(_FL, _REASONS),
        "cancellation_rate_by_year": _with(_FL, f"""SELECT Year, {_RATE} AS cancellation_rate
            FROM fl GROUP BY Year ORDER BY Year"""),
        "cancellation_rate_by_month": _with(_FL, f"""SELECT Month, {_RATE} AS cancellation_rate
            FROM fl GROUP BY Month ORDER BY Month"""),
        "cancellation_rate_by_dow": _with(_FL, f"""SELECT DayOfWeek, {_DAY_NAME} AS day_name,
            {_RATE} AS cancellation_rate FROM fl GROUP BY DayOfWeek ORDER BY DayOfWeek"""),
        "dow_vs_mean": _with(_FL, f"""SELECT *, total_flights < mean_flights AS below_mean FROM (
            SELECT DayOfWeek, {_DAY_NAME} AS day_name, {_COUNT} AS total_flights,
            avg(count(*)) OVER () AS mean_flights FROM fl GROUP BY DayOfWeek)"""),
        "report_outputs": _with(_FL, " UNION ALL ".join([
            _reported("delays_by_year", "total_flights", _BY_YEAR),
            _reported("top_airlines", "total_flights", _TOP_AIRLINES),
            _reported("top_routes", "total_flights", _TOP_ROUTES),
            _reported("monthly_trends", "total_flights", _MONTHS),
            _reported("day_of_week", "total_flights", _WEEKDAYS),
            _reported("cancellation_analysis", "cancellation_count", _REASONS),
            f"SELECT 'table_info', 1, {_COUNT} FROM fl"])),

        # samples
        "table_summary_merged": _with(_FL, f"""SELECT Year, {_COUNT} AS total_rows,
            count(DISTINCT Reporting_Airline) AS unique_airlines,
            count(DISTINCT Origin) AS unique_origins,
            count(DISTINCT Dest) AS unique_destinations, min(FlightDate) AS earliest_date,
            max(FlightDate) AS latest_date, avg(DepDelay) AS avg_dep_delay,
            avg(ArrDelay) AS avg_arr_delay,
            CAST(count(*) FILTER (WHERE Cancelled > 0) AS BIGINT) AS cancelled_flights,
            CAST(count(*) FILTER (WHERE Diverted > 0) AS BIGINT) AS diverted_flights,
            true AS aircraft_within_3_percent FROM fl GROUP BY Year"""),
        "block_sample": _with(_FL, f"""{everything} WHERE
            md5('7|Year=' || Year || '/Month=' || Month)[:16] < '4000000000000000'"""),
        "table_sample_drawn": _with(_FL, f"""{everything} WHERE {_number_of(_DRAW)} < 0.01
            ORDER BY {_number_of(_DRAW)}, {_rest()} LIMIT 1000"""),
        "weighted_route_sample_drawn": _with(_FL, f"""SELECT Origin, Dest, {_COUNT} AS count
            FROM fl GROUP BY Origin, Dest ORDER BY
            -ln(1 - {_number_of("md5('7|' || Origin || '|' || Dest)")}) / count(*), Origin, Dest
            LIMIT 5"""),
        "year_filter": _with(_FL, f"{everything} WHERE Year = 1998"),
        "recent_data": _with(_FL, f"""{everything}
            WHERE FlightDate >= DATE '2001-10-15' - 30
            ORDER BY FlightDate DESC, {_rest("FlightDate")} LIMIT 1000"""),
        "specific_routes": _with(_FL, f"""{everything}
            WHERE Origin IN ('A00', 'A03') AND Dest IN ('A01', 'A07')
            ORDER BY FlightDate DESC, {_rest("FlightDate")} LIMIT 500"""),
        "airlines_sample": _with(_FL, f"""{everything}
            WHERE Reporting_Airline IN ('C01', 'C05', 'C24') QUALIFY row_number() OVER (
              PARTITION BY Reporting_Airline ORDER BY {_DRAW}, {_rest()}) <= 200"""),
        "random_sample_year": _with(_FL, _SAMPLE_1998),
        "sample_stats": _with(_FL, f"""SELECT {_COUNT} AS total_rows,
            {len(FLIGHT_COLUMNS)} AS column_count,
            count(DISTINCT Reporting_Airline) AS unique_airlines,
            count(DISTINCT Origin) AS unique_origins,
            count(DISTINCT Dest) AS unique_destinations, min(FlightDate) AS earliest_date,
            max(FlightDate) AS latest_date FROM ({_SAMPLE_1998})"""),

        # messages and streams
        "rt_flight_id": _with(_STATUS, "SELECT flight_id, flight_number FROM flat"),
        "rt_flight_id_alt": _with(_STATUS, """SELECT
            flight_date || '_' || number || '_' || dep_iso AS flight_id FROM status"""),
        "json_parse": _with(_STATUS, """SELECT flight_id, flight_date, flight_status,
            departure_iata, arrival_iata, arrival_baggage, flight_number,
            codeshared_flight_id FROM flat"""),
        "json_parse_wide": _with(_STATUS, """SELECT flight_date, event_type AS flight_status,
            'Airport ' || dep AS dept_airport, dep_delay AS departure_delay, number AS flight_number,
            CASE WHEN shared THEN CAST(to_json({'airline_name': 'Partner', 'airline_iata': 'PX',
              'airline_icao': 'PXX', 'flight_number': partner, 'flight_iata': 'PX' || partner,
              'flight_icao': 'PXX' || partner}) AS VARCHAR) END AS codeshared FROM status"""),
        "flatten_flight": _with(_STATUS, "SELECT * FROM flat"),
        "live_flights": _with(_STATUS, """SELECT departure_scheduled AS timestamp, flight_id,
            airline_id AS airline, flight_number, departure_iata AS origin,
            arrival_iata AS destination, departure_scheduled AS scheduled_departure,
            departure_actual AS actual_departure, arrival_scheduled AS scheduled_arrival,
            arrival_actual AS actual_arrival, flight_status AS status,
            CAST(NULL AS VARCHAR) AS aircraft_type, CAST(NULL AS DOUBLE) AS latitude,
            CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS DOUBLE) AS altitude,
            CAST(NULL AS DOUBLE) AS speed FROM flat"""),
        "stream_flatten": _with(_STATUS, "SELECT * FROM flat"),
        "stream_parquet_sink": _with(_STATUS, "SELECT * FROM flat"),
        "stream_foreach_batch": _with(_STATUS, "SELECT * FROM flat"),
        "stream_wide": _with(_STATUS, """SELECT flight_date, event_type AS flight_status,
            'Airport ' || dep AS dept_airport, arr_delay AS arrival_delay FROM status"""),
        "stream_dual_sink": _with(_STATUS, " UNION ALL ".join(
            f"""SELECT '{sink}' AS sink, flight_date, {_COUNT} AS rows FROM flat
            GROUP BY flight_date""" for sink in ("files", "copy"))),
        "stream_dual_replayed": _with(_STATUS, " UNION ALL ".join(
            f"SELECT '{sink}' AS sink, * FROM flat" for sink in ("files", "copy"))),
        "stream_restart": _with(_STATUS, "SELECT flight_id, flight_status FROM flat"),
        "stream_two_checkpoints": _with(_STATUS, "SELECT flight_id, flight_status FROM flat"),
    }
