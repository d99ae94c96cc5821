"""Joins of flights with the dimensions, and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from skyledger.functions.flights import fact_key

# ---- fixed values -------------------------------------------------------------------------

FACT_COLUMNS = [
    "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline",
    "Tail_Number", "fact_key", "OriginAirportID", "Origin", "DestAirportID", "Dest",
    "CRSDepTime", "DepTime", "CRSArrTime", "ArrTime", "Distance", "Cancelled", "Diverted",
]
NARROW_FACT_COLUMNS = [
    "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline",
    "Tail_Number", "OriginAirportID", "DestAirportID", "CRSDepTime", "DepTime", "DepDelay",
    "CRSArrTime", "ArrTime", "ArrDelay", "Cancelled", "Diverted",
]

AIRLINE_KEY = ["IATA_CODE_Reporting_Airline", "DOT_ID_Reporting_Airline"]

# -------------------------------------------------------------------------------------------

# A dimension of at most this many rows may be broadcast on request (some 100 bytes each).
BROADCAST_ROWS = 100_000


def with_fact_key(flights: DataFrame) -> DataFrame:
    return flights.withColumn("fact_key", fact_key())


def distinct_facts(flights: DataFrame, *more: str) -> DataFrame:
    """The distinct fact rows; the key, which follows from other columns of a row, is not moved."""
    columns = [*FACT_COLUMNS, *more]
    parts = flights.select(*[name for name in columns if name != "fact_key"]).distinct()
    return with_fact_key(parts).select(*columns)


def fact_flights_projection(flights: DataFrame) -> DataFrame:
    """Fact rows without any join."""
    return flights.select(*NARROW_FACT_COLUMNS)


def one_per_key(dim: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """The dimension row with the smallest id for each key, so that a join cannot fan out."""
    others = [name for name in dim.columns if name not in keys]
    return dim.groupBy(*keys).agg(*[F.min_by(name, id_column).alias(name) for name in others])


def _prefixed(dim: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return dim.select(*[F.col(name) if name in keep else F.col(name).alias(f"{prefix}{name}")
                        for name in dim.columns])


def is_small(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``dim`` has at most ``max_rows`` rows. The count reads no column that the rows do
    not depend on and stops once it has seen one row more."""
    return dim.select(F.lit(1)).limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a dimension after counting that it is small, else ask for a sort-merge join."""
    return F.broadcast(dim) if is_small(dim, max_rows) else dim.hint("merge")


def _join_large(facts: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """Left join with a table that has each key once, however skewed the facts are.

    Adaptive execution splits a hot key's partition only where both inputs of the join come
    straight from a shuffle made for it. ``lookup`` is an aggregate by its key, whose own
    partitioning Spark would reuse instead; a marked key makes it shuffle the (narrow) lookup
    for the join. Facts with a null in the key match nothing and would all meet in one task:
    they get a scattered key that carries another mark. A key of one text is moved in its marked
    form alone.
    """
    separated = [part for name in keys for part in (F.lit("|"), F.col(name).cast("string"))]
    marked = F.concat(F.lit("k"), *separated)
    scattered = F.concat(F.lit("n"), F.xxhash64(*facts.columns).cast("string"))
    left = facts.withColumn("_key", F.coalesce(marked, scattered))
    right = lookup.withColumn("_key", marked).drop(*keys)
    if len(keys) > 1 or not isinstance(facts.schema[keys[0]].dataType, StringType):
        return left.join(right, "_key", "left").drop("_key")
    text = F.when(F.col("_key").startswith("k"), F.expr("substring(_key, 3)")).alias(keys[0])
    return left.drop(*keys).join(right, "_key", "left").select(*[
        text if name in keys else F.col(name) for name in facts.columns],
        *[name for name in right.columns if name != "_key"])


def _join_dim(facts: DataFrame, dim: DataFrame, lookup: DataFrame, keys: list[str],
              max_rows: int) -> DataFrame:
    """Left join with ``lookup``, which has no more rows than the stored ``dim``: by broadcast
    if that is small, else in a way that stands any skew of the facts."""
    if is_small(dim, max_rows):
        return facts.join(F.broadcast(lookup), keys, "left")
    return _join_large(facts, lookup, keys)


def join_time(flights: DataFrame, dim_time: DataFrame,
              max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``time_*`` columns by flight date."""
    calendar = _prefixed(dim_time, "time_", keep=("FlightDate", "time_id"))
    return _join_dim(flights, dim_time, calendar, ["FlightDate"], max_rows)


def join_airports(flights: DataFrame, dim_airport: DataFrame,
                  max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the airport dimension in both of its roles, as ``origin_*`` and ``dest_*``."""
    unique = one_per_key(dim_airport, ["AirportID"], "airport_id")
    for key, prefix in (("OriginAirportID", "origin_"), ("DestAirportID", "dest_")):
        role = _prefixed(unique.withColumnRenamed("AirportID", key), prefix, keep=(key,))
        flights = _join_dim(flights, dim_airport, role, [key], max_rows)
    return flights


def join_airline(flights: DataFrame, dim_airline: DataFrame,
                 max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add ``airline_*`` columns. The key is code plus DOT id: a code may have been reused."""
    unique = one_per_key(dim_airline, AIRLINE_KEY, "airline_id")
    carrier = _prefixed(unique, "airline_", keep=(*AIRLINE_KEY, "airline_id"))
    return _join_dim(flights, dim_airline, carrier, AIRLINE_KEY, max_rows)


def join_delay(keyed: DataFrame, dim_delay: DataFrame) -> DataFrame:
    """Add ``delay_*`` columns by fact key; this dimension has about one row per flight."""
    unique = one_per_key(dim_delay, ["fact_key"], "delay_id")
    lookup = _prefixed(unique, "delay_", keep=("fact_key", "delay_id"))
    return _join_large(keyed, lookup, ["fact_key"])


def join_cancellation(keyed: DataFrame, dim_cancel: DataFrame) -> DataFrame:
    """Add ``cancellation_*`` columns by fact key."""
    unique = one_per_key(dim_cancel, ["fact_key"], "cancellation_id")
    lookup = _prefixed(unique, "cancellation_", keep=("fact_key", "cancellation_id"))
    return _join_large(keyed, lookup, ["fact_key"])


def fact_table(flights: DataFrame, dim_time: DataFrame, dim_airport: DataFrame,
               dim_airline: DataFrame, dim_delay: DataFrame,
               dim_cancel: DataFrame) -> DataFrame:
    """The default fact build: five left joins of which the output keeps no column.

    Left joins on unique keys neither drop nor repeat rows, so Catalyst removes all of them
    below the distinct and the plan is one aggregate over the projected flights.
    """
    joined = join_time(with_fact_key(flights), dim_time)
    joined = join_airline(join_airports(joined, dim_airport), dim_airline)
    joined = join_cancellation(join_delay(joined, dim_delay), dim_cancel)
    return distinct_facts(joined)


def fact_table_hinted(flights: DataFrame, dim_time: DataFrame, dim_airport: DataFrame,
                      dim_airline: DataFrame, dim_delay: DataFrame,
                      dim_cancel: DataFrame) -> DataFrame:
    """Same rows with physical hints for the event dimensions: sort-merge with the delays, a
    broadcast of the cancellations if they are few (the others are size-checked anyway)."""
    return fact_table(flights, dim_time, dim_airport, dim_airline, dim_delay.hint("merge"),
                      broadcast_if_small(dim_cancel))


def event_ids(dim_delay: DataFrame, dim_cancel: DataFrame) -> DataFrame:
    """(fact_key, delay_id, cancellation_id), one row per key."""
    no_id = F.lit(None).cast("bigint")
    delays = dim_delay.select("fact_key", "delay_id", no_id.alias("cancellation_id"))
    cancels = dim_cancel.select("fact_key", no_id.alias("delay_id"), "cancellation_id")
    return (delays.unionByName(cancels)
            .filter(F.col("fact_key").isNotNull())
            .groupBy("fact_key")
            .agg(F.min("delay_id").alias("delay_id"),
                 F.min("cancellation_id").alias("cancellation_id")))


def fact_table_with_ids(flights: DataFrame, dim_time: DataFrame, dim_airport: DataFrame,
                        dim_airline: DataFrame, dim_delay: DataFrame, dim_cancel: DataFrame,
                        max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Fact rows carrying the surrogate ids of all dimensions.

    The distinct runs first: copies of one flight collapse in its map-side aggregate, however
    many there are, and no join sees them. Both event dimensions are folded into one lookup so
    that the flights are shuffled on the fact key once.
    """
    facts = distinct_facts(flights, "DOT_ID_Reporting_Airline")
    facts = _join_large(facts, event_ids(dim_delay, dim_cancel), ["fact_key"])

    dates = dim_time.select("FlightDate", "time_id")
    facts = _join_dim(facts, dim_time, dates, ["FlightDate"], max_rows)
    airports = dim_airport.groupBy("AirportID").agg(F.min("airport_id").alias("_id"))
    for role, id_column in (("Origin", "origin_airport_id"), ("Dest", "dest_airport_id")):
        key = f"{role}AirportID"
        ids = airports.select(F.col("AirportID").alias(key), F.col("_id").alias(id_column))
        facts = _join_dim(facts, dim_airport, ids, [key], max_rows)
    airlines = dim_airline.groupBy(*AIRLINE_KEY).agg(F.min("airline_id").alias("airline_id"))
    facts = _join_dim(facts, dim_airline, airlines, AIRLINE_KEY, max_rows)

    return facts.select(*FACT_COLUMNS, "time_id", "origin_airport_id", "dest_airport_id",
                        "airline_id", "delay_id", "cancellation_id")
