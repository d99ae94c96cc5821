"""Explicit schemas; nothing on the hot path infers a schema from data."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# ---- fixed values: names and order are those of the published data sets -------------------

CALENDAR = ["Year", "Quarter", "Month", "DayofMonth", "DayOfWeek"]
DELAY_CAUSES = ["CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]

CURATED_COLUMNS = [
    "FlightDate", "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek",
    "IATA_CODE_Reporting_Airline", "Tail_Number", "Flight_Number_Reporting_Airline",
    "OriginAirportID", "DestAirportID", "CRSDepTime", "DepTime", "DepDelay", "CRSArrTime",
    "ArrTime", "ArrDelay", "Cancelled", "Diverted", "Distance", "Origin", "OriginCityName",
    "OriginState", "OriginStateFips", "OriginStateName", "Dest", "DestCityName", "DestState",
    "DestStateFips", "DestStateName", "Reporting_Airline", "DOT_ID_Reporting_Airline",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
    "CancellationCode",
]

REQUIRED_COLUMNS = [*CALENDAR, "FlightDate"]

# -------------------------------------------------------------------------------------------


def _fields(kind: DataType, *names: str) -> list[StructField]:
    return [StructField(name, kind, True) for name in names]


_LONG, _DOUBLE, _TEXT, _TIME = LongType(), DoubleType(), StringType(), TimestampType()


def _airport(role: str) -> list[StructField]:
    return [
        *_fields(_LONG, f"{role}AirportID", f"{role}AirportSeqID", f"{role}CityMarketID"),
        *_fields(_TEXT, role, f"{role}CityName", f"{role}State"),
        *_fields(_LONG, f"{role}StateFips"),
        *_fields(_TEXT, f"{role}StateName"),
        *_fields(_LONG, f"{role}Wac"),
    ]


def _diversion(number: int) -> list[StructField]:
    stop = f"Div{number}"
    return [
        *_fields(_TEXT, f"{stop}Airport"),
        *_fields(_LONG, f"{stop}AirportID", f"{stop}AirportSeqID", f"{stop}WheelsOn"),
        *_fields(_DOUBLE, f"{stop}TotalGTime", f"{stop}LongestGTime"),
        *_fields(_LONG, f"{stop}WheelsOff"),
        *_fields(_TEXT, f"{stop}TailNum"),
    ]


RAW_FLIGHTS = StructType([
    *_fields(_LONG, *CALENDAR),
    *_fields(DateType(), "FlightDate"),
    *_fields(_TEXT, "Reporting_Airline"),
    *_fields(_LONG, "DOT_ID_Reporting_Airline"),
    *_fields(_TEXT, "IATA_CODE_Reporting_Airline", "Tail_Number"),
    *_fields(_LONG, "Flight_Number_Reporting_Airline"),
    *_airport("Origin"),
    *_airport("Dest"),
    *_fields(_LONG, "CRSDepTime", "DepTime"),
    *_fields(_DOUBLE, "DepDelay", "DepDelayMinutes", "DepDel15"),
    *_fields(_LONG, "DepartureDelayGroups"),
    *_fields(_TEXT, "DepTimeBlk"),
    *_fields(_DOUBLE, "TaxiOut"),
    *_fields(_LONG, "WheelsOff", "WheelsOn"),
    *_fields(_DOUBLE, "TaxiIn"),
    *_fields(_LONG, "CRSArrTime", "ArrTime"),
    *_fields(_DOUBLE, "ArrDelay", "ArrDelayMinutes", "ArrDel15"),
    *_fields(_LONG, "ArrivalDelayGroups"),
    *_fields(_TEXT, "ArrTimeBlk"),
    *_fields(_DOUBLE, "Cancelled"),
    *_fields(_TEXT, "CancellationCode"),
    *_fields(_DOUBLE, "Diverted", "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Flights",
             "Distance"),
    *_fields(_LONG, "DistanceGroup"),
    *_fields(_DOUBLE, *DELAY_CAUSES, "FirstDepTime", "TotalAddGTime", "LongestAddGTime"),
    *_fields(_LONG, "DivAirportLandings"),
    *_fields(_DOUBLE, "DivReachedDest", "DivActualElapsedTime", "DivArrDelay", "DivDistance"),
    *[field for number in range(1, 6) for field in _diversion(number)],
])

DAILY_MART = StructType([
    *_fields(DateType(), "date"),
    *_fields(_TEXT, "airline", "origin", "destination"),
    *_fields(_LONG, "total_flights", "cancelled_flights", "diverted_flights"),
    *_fields(_DOUBLE, "avg_departure_delay", "avg_arrival_delay", "total_distance",
             "avg_air_time"),
])

LIVE_FLIGHTS = StructType([
    *_fields(_TIME, "timestamp"),
    *_fields(_TEXT, "flight_id", "airline", "flight_number", "origin", "destination"),
    *_fields(_TIME, "scheduled_departure", "actual_departure", "scheduled_arrival",
             "actual_arrival"),
    *_fields(_TEXT, "status", "aircraft_type"),
    *_fields(_DOUBLE, "latitude", "longitude", "altitude", "speed"),
])


# ---- flight-status messages ---------------------------------------------------------------

_STOP_TIMES = ["scheduled", "estimated", "actual", "estimated_runway", "actual_runway"]
_STOP_PLACE = ["airport", "timezone", "iata", "icao", "terminal", "gate"]


def _stop(delay_type: DataType, baggage: bool) -> StructType:
    return StructType([
        *_fields(_TEXT, *_STOP_PLACE, *(["baggage"] if baggage else [])),
        *_fields(delay_type, "delay"),
        *_fields(_TEXT, *_STOP_TIMES),
    ])


_AIRLINE = StructType(_fields(_TEXT, "name", "iata", "icao"))
CODESHARED = StructType(_fields(_TEXT, "airline_name", "airline_iata", "airline_icao",
                                "flight_number", "flight_iata", "flight_icao"))
_AIRCRAFT = StructType(_fields(_TEXT, "registration", "iata", "icao", "icao24"))


def _flight_message(delay_type: DataType, codeshared: DataType,
                    extra: list[StructField]) -> StructType:
    return StructType([
        *_fields(_TEXT, "flight_date", "flight_status"),
        StructField("departure", _stop(delay_type, baggage=False)),
        StructField("arrival", _stop(delay_type, baggage=True)),
        StructField("airline", _AIRLINE),
        StructField("flight", StructType([
            *_fields(_TEXT, "number", "iata", "icao"),
            StructField("codeshared", codeshared),
        ])),
        *extra,
    ])


MESSAGE_KEY = StructType(_fields(_TEXT, "flight_id"))
FLIGHT_MESSAGE = _flight_message(_TEXT, CODESHARED, [])
WIDE_FLIGHT_MESSAGE = _flight_message(IntegerType(), _TEXT, [
    StructField("aircraft", _AIRCRAFT),
    StructField("live", _TEXT),
])
# What the status service returns: delays are numbers there, code-share is an object or null.
API_FLIGHT = _flight_message(IntegerType(), CODESHARED, [])

FLAT_STOP_TEXT = {"departure": _STOP_PLACE, "arrival": [*_STOP_PLACE, "baggage"]}
FLAT_STOP_TIMES = _STOP_TIMES


def _flat_stop(name: str) -> list[StructField]:
    return [
        *_fields(_TEXT, *[f"{name}_{part}" for part in FLAT_STOP_TEXT[name]]),
        *_fields(IntegerType(), f"{name}_delay"),
        *_fields(_TIME, *[f"{name}_{part}" for part in _STOP_TIMES]),
    ]


FLAT_FLIGHT = StructType([
    *_fields(_TEXT, "flight_id", "flight_date", "flight_status"),
    *_flat_stop("departure"),
    *_flat_stop("arrival"),
    *_fields(_TEXT, "airline_id", "flight_number", "codeshared_flight_id"),
])


# ---- rides --------------------------------------------------------------------------------

_MONEY = DecimalType(10, 2)

RIDE = StructType([
    *_fields(_TEXT, "VendorID"),
    *_fields(_TIME, "tpep_pickup_datetime", "tpep_dropoff_datetime"),
    *_fields(IntegerType(), "passenger_count"),
    *_fields(_MONEY, "trip_distance"),
    *_fields(IntegerType(), "RatecodeID"),
    *_fields(_TEXT, "store_and_fwd_flag"),
    *_fields(IntegerType(), "PULocationID", "DOLocationID"),
    *_fields(_TEXT, "payment_type"),
    *_fields(_MONEY, "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
             "improvement_surcharge", "total_amount", "congestion_surcharge"),
])


def as_text(schema: StructType) -> StructType:
    """The same columns, all strings: how delimited files are read before typed parsing."""
    return StructType(_fields(_TEXT, *schema.fieldNames()))
