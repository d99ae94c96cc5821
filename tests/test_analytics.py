from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from skyledger.operators import analytics, curate, sampling
from skyledger.plans.report import report_results, write_report
from tests.conftest import plan_of, rows

# ---- fixed values: column order of the published result files ------------------------------
RESULT_COLUMNS = {
    "delays_by_year": "Year total_flights avg_departure_delay avg_arrival_delay "
                      "avg_carrier_delay avg_weather_delay avg_nas_delay avg_security_delay "
                      "avg_late_aircraft_delay cancelled_flights delayed_flights_15min",
    "top_airlines": "Reporting_Airline total_flights avg_departure_delay avg_arrival_delay "
                    "cancelled_flights cancellation_rate delay_rate_15min",
    "top_routes": "route Origin Dest total_flights avg_departure_delay avg_arrival_delay "
                  "avg_distance cancelled_flights",
    "monthly_trends": "Month total_flights avg_departure_delay avg_arrival_delay "
                      "cancelled_flights avg_distance",
    "day_of_week": "DayOfWeek day_name total_flights avg_departure_delay avg_arrival_delay "
                   "cancelled_flights",
    "cancellation_analysis": "CancellationCode cancellation_reason cancellation_count "
                             "percentage",
}


@pytest.fixture(scope="module")
def gappy(flights):
    """Flights, some of which lack a year, an airline or a destination."""
    number = F.col("Flight_Number_Reporting_Airline")
    return flights.withColumns({
        "Year": F.when(number % 10 != 0, F.col("Year")),
        "Reporting_Airline": F.when(number % 10 != 1, F.col("Reporting_Airline")),
        "Dest": F.when(number % 10 != 2, F.col("Dest")),
    })


@pytest.mark.parametrize("name", RESULT_COLUMNS)
def test_result_columns(flights, name):
    assert getattr(analytics, name)(flights).columns == RESULT_COLUMNS[name].split()


def test_totals_agree(flights):
    total = flights.count()
    for name in ("delays_by_year", "monthly_trends", "day_of_week"):
        assert getattr(analytics, name)(flights).agg(F.sum("total_flights")).first()[0] == total


@pytest.mark.parametrize("source", ["flights", "gappy"])
def test_one_pass_report_equals_the_single_analyses(request, source):
    df = request.getfixturevalue(source)
    for name, result in report_results(df).items():
        single = getattr(analytics, name)(df)
        assert result.columns == single.columns
        assert result.exceptAll(single).count() == 0 == single.exceptAll(result).count(), name


def test_cube_scans_once(flights):
    assert plan_of(analytics.analysis_cube(flights)).count("Scan parquet") == 2


def test_report_files(spark, flights, tmp_path):
    summary = write_report(flights, str(tmp_path))
    assert set(summary["outputs"]) == set(RESULT_COLUMNS)
    assert summary["table_info"]["total_rows"] == flights.count()
    years = spark.read.option("header", True).csv(summary["outputs"]["delays_by_year"])
    assert years.columns == RESULT_COLUMNS["delays_by_year"].split()


def test_thresholds_and_limits(flights):
    assert analytics.top_airlines(flights, min_flights=0, limit=3).count() == 3
    assert analytics.top_airlines(flights, min_flights=10**9).count() == 0
    volumes = [row["total_flights"] for row in
               analytics.top_routes(flights, min_flights=1).collect()]
    assert volumes == sorted(volumes, reverse=True) and len(volumes) == 30


def test_empty_input(flights):
    none = flights.filter("Year = 1")
    assert analytics.delays_by_year(none).count() == 0
    assert analytics.cancellation_analysis(none).count() == 0
    assert analytics.table_info(none).first()["total_rows"] == 0
    summary = analytics.table_summary(none).first()
    assert summary["total_rows"] == 0 and summary["avg_dep_delay"] is None


def test_blank_code_is_unknown_and_null_is_left_out(spark):
    df = spark.createDataFrame(
        [(1.0, ""), (1.0, "B"), (1.0, None), (0.0, "A")],
        "Cancelled double, CancellationCode string").withColumn("DepDel15", F.lit(0.0))
    assert rows(analytics.cancellation_analysis(df)) == [
        ("", "Unknown", 1, 50.0), ("B", "Weather", 1, 50.0)]


def test_random_sample_is_uniform_without_repeats(spark):
    df = spark.range(1000).withColumn("Year", F.lit(1999))
    sample = sampling.random_sample(df, 200, year=1999, seed=3)
    assert sample.select("id").distinct().count() == 200
    assert 350 < sample.agg(F.avg("id")).first()[0] < 650
    assert sampling.random_sample(df, 5, year=2000).count() == 0


@pytest.mark.parametrize("rows_each", [7, 1500])
def test_rows_per_airline_on_a_hot_airline(spark, rows_each):
    """Above and below the group limit the kept rows are the smallest draws of each airline."""
    df = spark.range(0, 12000, 1, 8).select(
        F.when(F.col("id") % 10 < 9, "HOT").otherwise(F.concat(F.lit("Z"), F.col("id") % 3))
        .alias("Reporting_Airline"),
        F.lit(datetime.date(2020, 1, 1)).alias("FlightDate"), F.col("id"))
    sample = sampling.airlines_sample(df, ["HOT", "Z0"], rows_each, by=F.xxhash64("id"))
    taken = rows(sample, "Reporting_Airline", "id")
    expected = []
    for airline in ("HOT", "Z0"):
        ranked = (df.filter(F.col("Reporting_Airline") == airline)
                  .orderBy(F.xxhash64("id")).limit(rows_each))
        expected += rows(ranked, "Reporting_Airline", "id")
    assert taken == sorted(expected, key=repr)


def test_rows_per_airline_are_cut_before_the_shuffle(flights):
    assert "WindowGroupLimit" in plan_of(sampling.airlines_sample(flights, ["C01"], 10))


def test_seeded_samples_repeat(flights):
    names = [row[0] for row in analytics.top_airlines(flights, 2, 0).collect()]
    one = sampling.airlines_sample(flights, names, 5, seed=11)
    two = sampling.airlines_sample(flights, names, 5, seed=11)
    assert rows(one) == rows(two) and one.count() == 10


def test_weighted_sample(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 10**9), ("d", None)],
                               "name string, count long")
    assert rows(sampling.weighted_sample(df, "count", 1, seed=1), "name") == [("c",)]
    assert rows(sampling.weighted_sample(df, "count", 10), "name") == [("b",), ("c",)]


def test_weights_decide_how_often(spark):
    df = spark.createDataFrame([("x", 1), ("y", 3)], "name string, count long")
    wins = sum(sampling.weighted_sample(df, "count", 1, seed=seed).first()["name"] == "y"
               for seed in range(40))
    assert 20 <= wins <= 38


def test_table_sample_size(flights):
    assert sampling.table_sample(flights, 0.5, 100, seed=1).count() == 100
    assert 20 < sampling.table_sample(flights, 0.01, 10**6, seed=1).count() < 120


def test_recent_data(spark):
    today = datetime.date.today()
    df = spark.createDataFrame([(today - datetime.timedelta(days=n), n) for n in (0, 30, 31)],
                               "FlightDate date, n int")
    assert [row["n"] for row in sampling.recent_data(df).collect()] == [0, 30]
    assert [row["n"] for row in sampling.recent_data(df, days=40, limit=2).collect()] == [0, 30]


def test_route_values_are_bound(flights):
    assert sampling.specific_routes(flights, ["A00' OR '1'='1"], ["A01"]).count() == 0
    assert sampling.specific_routes(flights, [], ["A01"]).count() == 0


def test_sample_stats_of_few_columns(spark):
    stats = sampling.sample_stats(spark.createDataFrame([("A",), ("A",)], "Origin string"))
    assert stats.first().asDict() == {"total_rows": 2, "column_count": 1, "unique_origins": 1}


def test_route_weights(flights):
    frequency = curate.route_frequency(flights)
    assert frequency.columns == ["Origin", "Dest", "count"]
    assert frequency.agg(F.sum("count")).first()[0] == flights.count()


def test_a_seed_fixes_the_draw(spark, flights):
    """Neither partitioning nor plan may change a seeded sample."""
    drawn = set()
    for parts, adaptive in ((4, "true"), (7, "true"), (4, "false")):
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        df = flights.repartition(parts)
        drawn.add((str(rows(sampling.random_sample(df, 5, seed=7), "Origin", "Dest", "FlightDate")),
                   str(rows(sampling.table_sample(df, 0.01, 20, seed=7), "Origin", "Dest")),
                   str(rows(sampling.weighted_sample(
                       df.groupBy("Origin").count(), "count", 3, seed=7), "Origin"))))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(drawn) == 1
