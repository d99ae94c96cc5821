"""Business-intelligence table, daily mart and route frequencies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.flights import flag, hhmm_timestamp
from skyledger.schemas import DELAY_CAUSES


def bi_flights(df: DataFrame, midnight_rollover: bool = False) -> DataFrame:
    """The 20-column reporting table: a pure projection."""
    causes = [F.coalesce(F.col(cause), F.lit(0.0)).alias(cause) for cause in DELAY_CAUSES]
    return df.select(
        "FlightDate", "Year", "Quarter", "Month", "Reporting_Airline",
        F.col("Flight_Number_Reporting_Airline").alias("Flight_Number"),
        "Origin", "OriginCityName", "Dest", "DestCityName",
        hhmm_timestamp("FlightDate", "CRSDepTime", midnight_rollover).alias("CRSDepTimestamp"),
        "DepDelay", "ArrDelay",
        flag("DepDel15").alias("Is_Delayed"),
        flag("Cancelled").alias("Is_Cancelled"),
        *causes,
    )


def daily_mart(df: DataFrame) -> DataFrame:
    """Totals per (date, airline, origin, destination); rows without one of the keys are out,
    since the mart requires all four."""
    keyed = df.dropna(subset=["FlightDate", "Reporting_Airline", "Origin", "Dest"])
    return keyed.groupBy(
        F.col("FlightDate").alias("date"),
        F.col("Reporting_Airline").alias("airline"),
        F.col("Origin").alias("origin"),
        F.col("Dest").alias("destination"),
    ).agg(
        F.count(F.lit(1)).alias("total_flights"),
        F.count_if(F.col("Cancelled") == 1).alias("cancelled_flights"),
        F.count_if(F.col("Diverted") == 1).alias("diverted_flights"),
        F.avg("DepDelay").alias("avg_departure_delay"),
        F.avg("ArrDelay").alias("avg_arrival_delay"),
        F.sum("Distance").alias("total_distance"),
        F.avg("AirTime").alias("avg_air_time"),
    )


def route_frequency(df: DataFrame) -> DataFrame:
    """(Origin, Dest, count): the weights for the weighted route choice."""
    return df.groupBy("Origin", "Dest").agg(F.count(F.lit(1)).alias("count"))
