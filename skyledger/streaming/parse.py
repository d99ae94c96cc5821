"""Parse and flatten flight-status messages; the same for batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.schemas import (
    FLAT_STOP_TEXT,
    FLAT_STOP_TIMES,
    FLIGHT_MESSAGE,
    MESSAGE_KEY,
    WIDE_FLIGHT_MESSAGE,
)
from skyledger.sources.messages import decode_text


def parse_messages(messages: DataFrame, value_schema: StructType = FLIGHT_MESSAGE) -> DataFrame:
    """``flight_id`` from the key and the value's fields as columns.

    Proper JSON keys and those with single quotes are both read. A value that does not parse
    gives a row of nulls, as does a null value; ``dead_letters`` selects the former.
    """
    return decode_text(messages).select(
        F.from_json("key", MESSAGE_KEY)["flight_id"].alias("flight_id"),
        F.from_json("value", value_schema).alias("flight_message"),
    ).select("flight_id", "flight_message.*")


def dead_letters(messages: DataFrame, value_schema: StructType = FLIGHT_MESSAGE) -> DataFrame:
    """Messages whose value is present but is no JSON of the expected shape."""
    marked = StructType([*value_schema.fields]).add("_malformed", "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    text = decode_text(messages)
    parsed = F.from_json("value", marked, options)
    return text.filter(F.col("value").isNotNull() & parsed["_malformed"].isNotNull())


def parse_wide_messages(messages: DataFrame) -> DataFrame:
    """Variant with aircraft, live position and code-share as raw JSON text; adds the departure
    airport as a column of its own and keeps the nested ones."""
    value = F.from_json(F.col("value").cast("string"), WIDE_FLIGHT_MESSAGE)
    return (messages.select(value.alias("flight_message")).select("flight_message.*")
            .withColumn("dept_airport", F.col("departure.airport")))


def _stop_columns(stop: str) -> list[Column]:
    def part(name: str) -> Column:
        return F.col(f"{stop}.{name}")

    text = [part(name).alias(f"{stop}_{name}") for name in FLAT_STOP_TEXT[stop]]
    delay = part("delay").try_cast("int").alias(f"{stop}_delay")
    times = [part(name).try_cast("timestamp").alias(f"{stop}_{name}")
             for name in FLAT_STOP_TIMES]
    return [*text, delay, *times]


def flatten_flights(parsed: DataFrame) -> DataFrame:
    """The 31 flat columns; text that is no number or time becomes null."""
    return parsed.select(
        "flight_id", "flight_date", "flight_status",
        *_stop_columns("departure"),
        *_stop_columns("arrival"),
        F.col("airline.iata").alias("airline_id"),
        F.col("flight.number").alias("flight_number"),
        F.col("flight.codeshared.flight_iata").alias("codeshared_flight_id"),
    )


def flight_stream(messages: DataFrame) -> DataFrame:
    """Messages to flat rows: a stateless projection, no shuffle."""
    return flatten_flights(parse_messages(messages))


def live_flights(flat: DataFrame, received: Column | None = None) -> DataFrame:
    """Rows of the live-flight table. No message carries position, altitude, speed or aircraft
    type: those columns are typed nulls. Rows without an id are out, the table requires one."""
    unknown = F.lit(None)
    time = received if received is not None else F.current_timestamp()
    return flat.filter(F.col("flight_id").isNotNull()).select(
        time.alias("timestamp"),
        "flight_id",
        F.col("airline_id").alias("airline"),
        "flight_number",
        F.col("departure_iata").alias("origin"),
        F.col("arrival_iata").alias("destination"),
        F.col("departure_scheduled").alias("scheduled_departure"),
        F.col("departure_actual").alias("actual_departure"),
        F.col("arrival_scheduled").alias("scheduled_arrival"),
        F.col("arrival_actual").alias("actual_arrival"),
        F.col("flight_status").alias("status"),
        unknown.cast("string").alias("aircraft_type"),
        *[unknown.cast("double").alias(name)
          for name in ("latitude", "longitude", "altitude", "speed")],
    )
