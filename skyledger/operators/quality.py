"""Data-quality figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------

CHECKED_COLUMNS = [
    "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline",
    "OriginAirportID", "DestAirportID", "Reporting_Airline", "DOT_ID_Reporting_Airline",
]

# -------------------------------------------------------------------------------------------


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per checked column: (column_name, total_rows, null_count), from a single scan."""
    available = set(df.columns)
    names = [name for name in (columns or CHECKED_COLUMNS) if name in available]
    wide = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in names],
    )
    if not names:
        return wide.select(F.lit(None).cast("string").alias("column_name"), "total_rows",
                           F.lit(None).cast("bigint").alias("null_count"))
    return (wide.unpivot(["total_rows"], names, "column_name", "null_count")
            .select("column_name", "total_rows", "null_count"))


def preview(df: DataFrame, limit: int = 5) -> DataFrame:
    return df.limit(limit)


def data_quality_report(df: DataFrame, sample_limit: int = 5) -> dict[str, object]:
    """Total, null counts and a few sample rows for a log line (two small jobs)."""
    counts = null_profile(df).collect()
    return {
        "total_rows": counts[0]["total_rows"],
        "null_counts": {row["column_name"]: row["null_count"] for row in counts
                        if row["column_name"] is not None},
        "sample": [row.asDict() for row in preview(df, sample_limit).collect()],
    }


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Row count as a by-product of whatever action runs on ``df`` next, not a job of its own."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
