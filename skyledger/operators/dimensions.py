"""Star-schema dimensions with dense surrogate ids."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.flights import fact_key, iso_weekday
from skyledger.operators.ids import with_dense_id
from skyledger.schemas import DELAY_CAUSES


def time_rows(flights: DataFrame) -> DataFrame:
    """Distinct dates with their calendar parts; the parts are computed after the distinct."""
    return flights.select("FlightDate").distinct().select(
        "FlightDate",
        F.year("FlightDate").alias("Year"),
        F.quarter("FlightDate").alias("Quarter"),
        F.month("FlightDate").alias("Month"),
        F.dayofmonth("FlightDate").alias("DayOfMonth"),
        iso_weekday("FlightDate").alias("DayOfWeek"),
    )


def airport_rows(flights: DataFrame) -> DataFrame:
    """Airports seen in either role, from one scan: each flight yields its two airports and the
    distinct collapses them before the shuffle."""

    def role(prefix: str):
        return F.struct(
            F.col(f"{prefix}AirportID").alias("AirportID"),
            F.col(prefix).alias("AirportCode"),
            F.col(f"{prefix}CityName").alias("CityName"),
            F.col(f"{prefix}State").alias("State"),
            F.col(f"{prefix}StateFips").alias("StateFips"),
            F.col(f"{prefix}StateName").alias("StateName"),
        )

    return flights.select(F.inline(F.array(role("Origin"), role("Dest")))).distinct()


def airline_rows(flights: DataFrame) -> DataFrame:
    return flights.select("IATA_CODE_Reporting_Airline", "Reporting_Airline",
                          "DOT_ID_Reporting_Airline").distinct()


def delay_rows(flights: DataFrame) -> DataFrame:
    """Delays of flights that were neither cancelled nor diverted."""
    flown = flights.filter((F.col("Cancelled") == 0) & (F.col("Diverted") == 0))
    return flown.select(fact_key().alias("fact_key"), "DepDelay", "ArrDelay",
                        *DELAY_CAUSES).distinct()


def cancellation_rows(flights: DataFrame) -> DataFrame:
    return (flights.filter(F.col("Cancelled") == 1)
            .select(fact_key().alias("fact_key"), "CancellationCode").distinct())


def _numbered(rows: DataFrame, id_column: str) -> DataFrame:
    # The natural key comes first in every row set; the other columns break its ties.
    return with_dense_id(rows, id_column, rows.columns)


def dim_time(flights: DataFrame) -> DataFrame:
    return _numbered(time_rows(flights), "time_id")


def dim_airports(flights: DataFrame) -> DataFrame:
    return _numbered(airport_rows(flights), "airport_id")


def dim_airlines(flights: DataFrame) -> DataFrame:
    return _numbered(airline_rows(flights), "airline_id")


def dim_delays(flights: DataFrame) -> DataFrame:
    return _numbered(delay_rows(flights), "delay_id")


def dim_cancellations(flights: DataFrame) -> DataFrame:
    return _numbered(cancellation_rows(flights), "cancellation_id")


DIMENSIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "time": dim_time,
    "airport": dim_airports,
    "airline": dim_airlines,
    "delay": dim_delays,
    "cancel": dim_cancellations,
}


def build_dims(flights: DataFrame, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The chosen dimensions (``all`` or none named: every one)."""
    chosen = list(DIMENSIONS) if not names or "all" in names else names
    unknown = [name for name in chosen if name not in DIMENSIONS]
    if unknown:
        raise ValueError(f"unknown dimensions {unknown}; choose from {list(DIMENSIONS)}")

    # The builds run side by side: those of the small dimensions fill the gaps of the large.
    def build(name: str) -> DataFrame:
        return DIMENSIONS[name](flights)

    with ThreadPoolExecutor(max_workers=len(chosen)) as pool:
        tasks = {name: pool.submit(inheritable_thread_target(flights.sparkSession)(build), name)
                 for name in chosen}
        return {name: task.result() for name, task in tasks.items()}
