"""Profiles by month that merge, so that a new month does not rescan the history.

A month's profile is one row: additive measures and a distinct-count sketch per profiled column.
Sketches of any months merge into that of their union; a month that is loaded again replaces its own
row. Counts, sums and dates are exact, distinct counts approximate (exact while small).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sinks.files import replace_months

# ---- fixed values -------------------------------------------------------------------------

#: Distinct-counted columns and their names in the merged profile.
DISTINCT = {
    "Reporting_Airline": "unique_airlines",
    "Origin": "unique_origins",
    "Dest": "unique_destinations",
    "Tail_Number": "unique_aircraft",
}

# -------------------------------------------------------------------------------------------

# 2^14 registers: a standard error of some 0.7 %, in at most 16 kB a column and month.
SKETCH_BITS = 14

_KEYS = ["Year", "Month"]
_DELAYS = ["DepDelay", "ArrDelay"]


def month_profiles(flights: DataFrame) -> DataFrame:
    """One row for each year and month. Sketches are filled before the shuffle, so that a month
    with a third of the rows sends as little as any other."""
    return flights.groupBy(*_KEYS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("FlightDate").alias("first_date"),
        F.max("FlightDate").alias("last_date"),
        F.count_if(F.col("Cancelled") > 0).alias("cancelled"),
        F.count_if(F.col("Diverted") > 0).alias("diverted"),
        *[F.sum(name).alias(f"sum_{name}") for name in _DELAYS],
        *[F.count(name).alias(f"n_{name}") for name in _DELAYS],
        *[F.hll_sketch_agg(name, F.lit(SKETCH_BITS)).alias(f"sketch_{name}") for name in DISTINCT],
    )


def update_profiles(flights: DataFrame, path: str,
                    months: Iterable[tuple[int, int]] | None = None) -> None:
    """Bring the stored profiles of ``months`` up to date and leave the others. ``flights`` needs to
    hold only those months; of a whole table, the other months' directories are not read. A month
    of which there is no row loses its profile. Without ``months``: those that ``flights`` has.
    Flights without a year or a month, which no load stores, are refused."""
    if months is None:
        # Two numbers a month.
        months = [tuple(row) for row in flights.select(*_KEYS).distinct().collect()]
        if any(None in month for month in months):
            raise ValueError("flights without a year or a month have no profile")
    else:
        months = list(months)
        wanted = [(F.col("Year") == year) & (F.col("Month") == month) for year, month in months]
        flights = flights.filter(reduce(or_, wanted, F.lit(False)))
    replace_months(month_profiles(flights), path, months)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def merged_profile(profiles: DataFrame, *by: str) -> DataFrame:
    """The profile of all months together, or of each group of them (``by`` Year, say); as a table
    summary, with approximate distinct counts."""

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))

    def distinct(name: str) -> Column:
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{name}")), F.lit(0))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    return profiles.groupBy(*by).agg(
        total("rows").alias("total_rows"),
        *[distinct(name).alias(alias) for name, alias in DISTINCT.items()],
        F.min("first_date").alias("earliest_date"),
        F.max("last_date").alias("latest_date"),
        mean("DepDelay").alias("avg_dep_delay"),
        mean("ArrDelay").alias("avg_arr_delay"),
        total("cancelled").alias("cancelled_flights"),
        total("diverted").alias("diverted_flights"),
    )
