"""Delay, cancellation, airline, route, season and weekday analyses.

Each analysis is an aggregate over a few low-cardinality keys followed by arithmetic on the
small result. The aggregate keeps *additive* measures (counts, sums, counts of non-null) and
averages are formed from them at the end, so that one pass over the flights can serve all
analyses (``analysis_cube``) and partial results can be added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions.flights import cancellation_reason, day_name, percentage, route_label
from skyledger.schemas import DELAY_CAUSES

# ---- fixed values -------------------------------------------------------------------------

MIN_AIRLINE_FLIGHTS, TOP_AIRLINES = 1000, 20
MIN_ROUTE_FLIGHTS, TOP_ROUTES = 100, 30

AVERAGES = {
    "avg_departure_delay": "DepDelay",
    "avg_arrival_delay": "ArrDelay",
    "avg_distance": "Distance",
    "avg_carrier_delay": "CarrierDelay",
    "avg_weather_delay": "WeatherDelay",
    "avg_nas_delay": "NASDelay",
    "avg_security_delay": "SecurityDelay",
    "avg_late_aircraft_delay": "LateAircraftDelay",
}

# -------------------------------------------------------------------------------------------

_BOTH_DELAYS = ["DepDelay", "ArrDelay"]


def _measures(averaged: list[str]) -> list[Column]:
    sums = [F.sum(name).alias(f"sum_{name}") for name in averaged]
    counts = [F.count(name).alias(f"n_{name}") for name in averaged]
    return [
        F.count(F.lit(1)).alias("total_flights"),
        F.count_if(F.col("Cancelled") == 1).alias("cancelled_flights"),
        F.count_if(F.col("DepDel15") == 1).alias("delayed_flights_15min"),
        *sums, *counts,
    ]


def _average(alias: str) -> Column:
    source = AVERAGES[alias]
    return F.try_divide(F.col(f"sum_{source}"), F.col(f"n_{source}")).alias(alias)


def _grouped(flights: DataFrame, keys: list[str], averaged: list[str]) -> DataFrame:
    return flights.dropna(subset=keys).groupBy(*keys).agg(*_measures(averaged))


def _present_years(measures: DataFrame) -> DataFrame:
    return measures.select(
        "Year", "total_flights", _average("avg_departure_delay"), _average("avg_arrival_delay"),
        _average("avg_carrier_delay"), _average("avg_weather_delay"), _average("avg_nas_delay"),
        _average("avg_security_delay"), _average("avg_late_aircraft_delay"),
        "cancelled_flights", "delayed_flights_15min",
    ).orderBy("Year")


def _present_airlines(measures: DataFrame, limit: int, min_flights: int) -> DataFrame:
    flights = F.col("total_flights")
    return measures.filter(flights > min_flights).select(
        "Reporting_Airline", "total_flights", _average("avg_departure_delay"),
        _average("avg_arrival_delay"), "cancelled_flights",
        percentage(F.col("cancelled_flights"), flights).alias("cancellation_rate"),
        percentage(F.col("delayed_flights_15min"), flights).alias("delay_rate_15min"),
    ).orderBy(F.desc("total_flights"), "Reporting_Airline").limit(limit)


def _present_routes(measures: DataFrame, limit: int, min_flights: int) -> DataFrame:
    return measures.filter(F.col("total_flights") > min_flights).select(
        route_label().alias("route"), "Origin", "Dest", "total_flights",
        _average("avg_departure_delay"), _average("avg_arrival_delay"),
        _average("avg_distance"), "cancelled_flights",
    ).orderBy(F.desc("total_flights"), "Origin", "Dest").limit(limit)


def _present_months(measures: DataFrame) -> DataFrame:
    return measures.select(
        "Month", "total_flights", _average("avg_departure_delay"),
        _average("avg_arrival_delay"), "cancelled_flights", _average("avg_distance"),
    ).orderBy("Month")


def _present_weekdays(measures: DataFrame) -> DataFrame:
    return measures.select(
        "DayOfWeek", day_name("DayOfWeek").alias("day_name"), "total_flights",
        _average("avg_departure_delay"), _average("avg_arrival_delay"), "cancelled_flights",
    ).orderBy("DayOfWeek")


def _present_cancellations(measures: DataFrame) -> DataFrame:
    """Shares of the total; the window runs over one row per code."""
    total = F.sum("cancelled_flights").over(Window.partitionBy())
    return (
        measures.filter(F.col("cancelled_flights") > 0)
        .select(
            "CancellationCode",
            cancellation_reason("CancellationCode").alias("cancellation_reason"),
            F.col("cancelled_flights").alias("cancellation_count"),
            percentage(F.col("cancelled_flights"), total).alias("percentage"),
        )
        .orderBy(F.desc("cancellation_count"), "CancellationCode")
    )


def delays_by_year(flights: DataFrame) -> DataFrame:
    return _present_years(_grouped(flights, ["Year"], [*_BOTH_DELAYS, *DELAY_CAUSES]))


def top_airlines(flights: DataFrame, limit: int = TOP_AIRLINES,
                 min_flights: int = MIN_AIRLINE_FLIGHTS) -> DataFrame:
    measures = _grouped(flights, ["Reporting_Airline"], _BOTH_DELAYS)
    return _present_airlines(measures, limit, min_flights)


def top_routes(flights: DataFrame, limit: int = TOP_ROUTES,
               min_flights: int = MIN_ROUTE_FLIGHTS) -> DataFrame:
    measures = _grouped(flights, ["Origin", "Dest"], [*_BOTH_DELAYS, "Distance"])
    return _present_routes(measures, limit, min_flights)


def monthly_trends(flights: DataFrame) -> DataFrame:
    return _present_months(_grouped(flights, ["Month"], [*_BOTH_DELAYS, "Distance"]))


def day_of_week(flights: DataFrame) -> DataFrame:
    return _present_weekdays(_grouped(flights, ["DayOfWeek"], _BOTH_DELAYS))


def cancellation_analysis(flights: DataFrame) -> DataFrame:
    """Reasons of cancellations with a non-null code; a blank code counts as Unknown."""
    cancelled = flights.filter(F.col("Cancelled") == 1)
    return _present_cancellations(_grouped(cancelled, ["CancellationCode"], []))


def _with_rate(result: DataFrame) -> DataFrame:
    rate = F.col("cancelled_flights") / F.col("total_flights") * 100
    return result.withColumn("cancellation_rate", rate)


def cancellation_rate_by_year(flights: DataFrame) -> DataFrame:
    measures = _with_rate(_grouped(flights, ["Year"], []))
    return measures.select("Year", "cancellation_rate").orderBy("Year")


def cancellation_rate_by_month(flights: DataFrame) -> DataFrame:
    measures = _with_rate(_grouped(flights, ["Month"], []))
    return measures.select("Month", "cancellation_rate").orderBy("Month")


def cancellation_rate_by_dow(flights: DataFrame) -> DataFrame:
    measures = _with_rate(_grouped(flights, ["DayOfWeek"], []))
    return measures.select("DayOfWeek", day_name("DayOfWeek").alias("day_name"),
                           "cancellation_rate").orderBy("DayOfWeek")


def dow_vs_mean(flights: DataFrame) -> DataFrame:
    """Weekday volumes against their mean; the window runs over at most seven rows."""
    measures = _grouped(flights, ["DayOfWeek"], [])
    mean = F.avg("total_flights").over(Window.partitionBy())
    return measures.select(
        "DayOfWeek", day_name("DayOfWeek").alias("day_name"), "total_flights",
        mean.alias("mean_flights"), (F.col("total_flights") < mean).alias("below_mean"),
    ).orderBy("DayOfWeek")


def table_info(flights: DataFrame) -> DataFrame:
    """Row count, distinct counts and year range.

    Distinct counts of several columns make Spark expand every row once per column. Grouping
    by the four columns first leaves that work to one row per (year, airline, route).
    """
    grain = flights.groupBy("Year", "Reporting_Airline", "Origin", "Dest").agg(
        F.count(F.lit(1)).alias("flights"))
    return grain.agg(
        F.coalesce(F.sum("flights"), F.lit(0)).alias("total_rows"),
        F.count_distinct("Year").alias("unique_years"),
        F.min("Year").alias("min_year"),
        F.max("Year").alias("max_year"),
        F.count_distinct("Reporting_Airline").alias("unique_airlines"),
        F.count_distinct("Origin").alias("unique_origins"),
        F.count_distinct("Dest").alias("unique_destinations"),
    )


def table_summary(flights: DataFrame) -> DataFrame:
    """Row count, distinct counts, date range, mean delays, cancelled and diverted flights;
    pre-grouped by airline and route for the same reason as ``table_info``."""
    sums = [F.sum(name).alias(f"sum_{name}") for name in _BOTH_DELAYS]
    counts = [F.count(name).alias(f"n_{name}") for name in _BOTH_DELAYS]
    grain = flights.groupBy("Reporting_Airline", "Origin", "Dest").agg(
        F.count(F.lit(1)).alias("flights"),
        F.min("FlightDate").alias("first_date"),
        F.max("FlightDate").alias("last_date"),
        F.count_if(F.col("Cancelled") > 0).alias("cancelled"),
        F.count_if(F.col("Diverted") > 0).alias("diverted"),
        *sums, *counts,
    )

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(f"sum_{name}"), F.sum(f"n_{name}"))

    return grain.agg(
        F.coalesce(F.sum("flights"), F.lit(0)).alias("total_rows"),
        F.count_distinct("Reporting_Airline").alias("unique_airlines"),
        F.count_distinct("Origin").alias("unique_origins"),
        F.count_distinct("Dest").alias("unique_destinations"),
        F.min("first_date").alias("earliest_date"),
        F.max("last_date").alias("latest_date"),
        mean("DepDelay").alias("avg_dep_delay"),
        mean("ArrDelay").alias("avg_arr_delay"),
        F.coalesce(F.sum("cancelled"), F.lit(0)).alias("cancelled_flights"),
        F.coalesce(F.sum("diverted"), F.lit(0)).alias("diverted_flights"),
    )


# ---- all analyses from one pass -----------------------------------------------------------

_CUBE_KEYS = {
    "delays_by_year": ["Year"],
    "top_airlines": ["Reporting_Airline"],
    "top_routes": ["Origin", "Dest"],
    "monthly_trends": ["Month"],
    "day_of_week": ["DayOfWeek"],
    "cancellation_analysis": ["CancellationCode"],
}
_ANALYSIS = "analysis"


def analysis_cube(flights: DataFrame) -> DataFrame:
    """Additive measures of every analysis in one scan and one small shuffle.

    Grouping sets evaluate the six groupings side by side; the map-side aggregate reduces each
    task to one row per group, so what is shuffled is tiny however many flights there are.
    """
    columns = [name for keys in _CUBE_KEYS.values() for name in keys]
    code = F.when(F.col("Cancelled") == 1, F.col("CancellationCode"))
    source = flights.withColumn("CancellationCode", code)
    sets = [[F.col(name) for name in keys] for keys in _CUBE_KEYS.values()]
    cube = source.groupingSets(sets, *[F.col(name) for name in columns]).agg(
        F.grouping_id().alias("_set"), *_measures([*AVERAGES.values()]))

    # Bit i (from the left) of a grouping id is set when column i is *not* in the set.
    label = F.lit(None).cast("string")
    for analysis, keys in _CUBE_KEYS.items():
        bits = "".join("0" if name in keys else "1" for name in columns)
        label = F.when(F.col("_set") == int(bits, 2), analysis).otherwise(label)
    return cube.withColumn(_ANALYSIS, label).drop("_set")


def cube_results(cube: DataFrame) -> dict[str, DataFrame]:
    """The six analyses and the table profile, all from the cube's few rows."""

    def slice_of(analysis: str, with_null_keys: bool = False) -> DataFrame:
        part = cube.filter(F.col(_ANALYSIS) == analysis)
        return part if with_null_keys else part.dropna(subset=_CUBE_KEYS[analysis])

    def distinct_keys(analysis: str, name: str) -> Column:
        return F.count_distinct(F.when(F.col(_ANALYSIS) == analysis, F.col(name)))

    by_year = F.col(_ANALYSIS) == "delays_by_year"
    info = cube.agg(
        F.coalesce(F.sum(F.when(by_year, F.col("total_flights"))), F.lit(0)).alias("total_rows"),
        distinct_keys("delays_by_year", "Year").alias("unique_years"),
        F.min("Year").alias("min_year"),
        F.max("Year").alias("max_year"),
        distinct_keys("top_airlines", "Reporting_Airline").alias("unique_airlines"),
        distinct_keys("top_routes", "Origin").alias("unique_origins"),
        distinct_keys("top_routes", "Dest").alias("unique_destinations"),
    )
    return {
        "table_info": info,
        "delays_by_year": _present_years(slice_of("delays_by_year")),
        "top_airlines": _present_airlines(slice_of("top_airlines"), TOP_AIRLINES,
                                          MIN_AIRLINE_FLIGHTS),
        "top_routes": _present_routes(slice_of("top_routes"), TOP_ROUTES, MIN_ROUTE_FLIGHTS),
        "monthly_trends": _present_months(slice_of("monthly_trends")),
        "day_of_week": _present_weekdays(slice_of("day_of_week")),
        "cancellation_analysis": _present_cancellations(slice_of("cancellation_analysis")),
    }
