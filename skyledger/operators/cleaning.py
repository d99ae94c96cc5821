"""Projection, normalisation and row filters on raw flights."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from skyledger.functions.flights import CANCELLATION_REASONS
from skyledger.schemas import CURATED_COLUMNS

# ---- fixed values -------------------------------------------------------------------------

IDENTIFYING_COLUMNS = [
    "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline",
    "OriginAirportID", "DestAirportID", "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek",
    "Reporting_Airline", "DOT_ID_Reporting_Airline",
]
INDICATOR_COLUMNS = ["Cancelled", "Diverted"]
CRITICAL_COLUMNS = ["FlightDate", "Origin", "Dest", "Reporting_Airline"]

# -------------------------------------------------------------------------------------------


def _present(df: DataFrame, names: list[str]) -> list[str]:
    available = set(df.columns)
    return [name for name in names if name in available]


def curated_projection(df: DataFrame) -> DataFrame:
    """Keep those of the curated columns that the input has, in curated order."""
    return df.select(*_present(df, CURATED_COLUMNS))


def normalise_cancellation_code(df: DataFrame) -> DataFrame:
    """Keep a code only on cancelled flights and only when it is a known letter."""
    known = (F.col("Cancelled").try_cast("double") == 1) & F.col("CancellationCode").isin(
        list(CANCELLATION_REASONS))
    return df.withColumn("CancellationCode", F.when(known, F.col("CancellationCode")))


def validity(df: DataFrame) -> Column:
    """Row test: identified, indicators 0/1, and departure and arrival known if flown.

    Each part applies only where the input has the column it speaks about.
    """
    tests = [F.col(name).isNotNull() for name in _present(df, IDENTIFYING_COLUMNS)]
    # Text such as "0.00" counts by its number; text that is none fails the test.
    tests += [F.coalesce(F.col(name).try_cast("double").isin(0.0, 1.0), F.lit(False))
              for name in _present(df, INDICATOR_COLUMNS)]
    clock = _present(df, ["DepTime", "ArrTime"])
    if clock:
        flown = reduce(and_, [F.col(name).isNotNull() for name in clock])
        cancelled = (F.col("Cancelled").try_cast("double") == 1) if "Cancelled" in df.columns else F.lit(False)
        tests.append(flown | cancelled)
    return reduce(and_, tests, F.lit(True))


def clean_flights(df: DataFrame) -> DataFrame:
    """The cleaning pipeline: one narrow stage, filters reach the Parquet scan."""
    kept = curated_projection(df)
    kept = kept.filter(validity(kept))
    if {"Cancelled", "CancellationCode"} <= set(kept.columns):
        kept = normalise_cancellation_code(kept)
    return kept


def drop_missing_critical(df: DataFrame) -> DataFrame:
    """Drop rows with a null in any critical column that is present."""
    names = _present(df, CRITICAL_COLUMNS)
    return df.dropna(subset=names) if names else df


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column in one projection."""
    return df.select(*[
        F.trim(F.col(field.name)).alias(field.name)
        if isinstance(field.dataType, StringType) else F.col(field.name)
        for field in df.schema.fields
    ])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row de-duplication; copies collapse in the map-side aggregate before the shuffle."""
    return df.distinct()


def clean_flights_dedup(df: DataFrame) -> DataFrame:
    """Second cleaning pipeline: null test and trim first, so that the shuffle of the distinct
    carries only rows that stay and padded copies collapse too."""
    return distinct_rows(trim_strings(drop_missing_critical(df)))
