from __future__ import annotations

import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from skyledger.functions.flights import cancellation_reason, day_name, hhmm_timestamp, percentage
from skyledger.operators import cleaning, curate, quality
from skyledger.schemas import CURATED_COLUMNS, RAW_FLIGHTS
from tests.conftest import plan_of, rows

SCHEMA = """FlightDate string, Year int, Quarter int, Month int, DayofMonth int, DayOfWeek int,
    IATA_CODE_Reporting_Airline string, Flight_Number_Reporting_Airline string,
    OriginAirportID int, DestAirportID int, DepTime int, ArrTime int, Cancelled int,
    CancellationCode string, Reporting_Airline string, DOT_ID_Reporting_Airline int"""


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame([
        ("2021-03-01", 2021, 1, 3, 1, 1, "AA", "100", 1, 2, 700, 900, 0, None, "AA", 19805),
        ("2021-03-02", 2021, 1, 3, 2, 2, "DL", "200", 1, 3, None, None, 1, "A", "DL", 19790),
        (None, 2021, 1, 3, 3, 3, "UA", "300", 1, 4, 800, 1000, 0, None, "UA", 19977),
        ("2021-03-04", 2021, 1, 3, 4, 4, "UA", "301", 1, 4, 800, None, 0, None, "UA", 19977),
        ("2021-03-05", 2021, 1, 3, 5, 5, "UA", "302", 1, 4, 800, 1000, 2, None, "UA", 19977),
        ("2021-03-06", 2021, 1, 3, 6, 6, "WN", "400", 1, 4, None, None, 1, "", "WN", 19393),
        ("2021-03-07", 2021, 1, 3, 7, 7, "WN", "401", 1, 4, 800, 900, 0, "B", "WN", 19393),
    ], SCHEMA)


def test_cleaning_without_a_diverted_column(raw):
    cleaned = cleaning.clean_flights(raw)
    assert rows(cleaned, "Flight_Number_Reporting_Airline", "CancellationCode") == [
        ("100", None), ("200", "A"), ("400", None), ("401", None)]
    assert cleaned.columns == [name for name in CURATED_COLUMNS if name in raw.columns]


def test_diverted_must_be_zero_or_one(raw):
    marked = raw.withColumn("Diverted", F.when(F.col("DayofMonth") == 1, 0.0).when(
        F.col("DayofMonth") == 2, 1.0).when(F.col("DayofMonth") == 6, 3.0))
    assert rows(cleaning.clean_flights(marked), "DayofMonth") == [(1,), (2,)]


def test_cleaning_raw_columns(spark):
    cleaned = cleaning.clean_flights(spark.createDataFrame([], RAW_FLIGHTS))
    assert cleaned.columns == CURATED_COLUMNS
    assert cleaned.count() == 0


def test_trim_and_distinct_collapse_padded_copies(spark):
    df = spark.createDataFrame(
        [("2021-01-01", " A", "B", "X", 1), ("2021-01-01", "A ", "B", "X", 1),
         ("2021-01-01", "A", None, "X", 1)],
        "FlightDate string, Origin string, Dest string, Reporting_Airline string, n int")
    assert rows(cleaning.clean_flights_dedup(df)) == [("2021-01-01", "A", "B", "X", 1)]


def test_drop_missing_ignores_absent_columns(spark):
    df = spark.createDataFrame([("A", 1), (None, 2)], "Origin string, n int")
    assert rows(cleaning.drop_missing_critical(df), "n") == [(1,)]
    assert cleaning.drop_missing_critical(df.select("n")).count() == 2


def test_filters_reach_the_scan(flights):
    plan = plan_of(cleaning.clean_flights(flights))
    assert "IsNotNull(FlightDate)" in plan and "Exchange" not in plan


@pytest.mark.parametrize("clock, plain, rolled", [
    (5, datetime.datetime(2024, 2, 29, 0, 5), datetime.datetime(2024, 2, 29, 0, 5)),
    (1430, datetime.datetime(2024, 2, 29, 14, 30), datetime.datetime(2024, 2, 29, 14, 30)),
    (2400, None, datetime.datetime(2024, 3, 1)),
    (2401, None, None),
    (1299, None, None),
    (None, None, None),
])
def test_clock_numbers(spark, clock, plain, rolled):
    df = spark.createDataFrame([(datetime.date(2024, 2, 29), clock)], "d date, t int")
    assert df.select(hhmm_timestamp("d", "t").alias("a"),
                     hhmm_timestamp("d", "t", midnight_rollover=True).alias("b")).first() == Row(
        a=plain, b=rolled)


def test_labels(spark):
    days = spark.createDataFrame([(1,), (7,), (0,), (8,), (None,)], "d int")
    assert [row[0] for row in days.select(day_name("d")).collect()] == [
        "Monday", "Sunday", None, None, None]
    codes = spark.createDataFrame([("A",), ("D",), ("",), (None,)], "c string")
    assert [row[0] for row in codes.select(cancellation_reason("c")).collect()] == [
        "Carrier", "Security", "Unknown", "Unknown"]


def test_percentage_rounds_ties_away_from_zero(spark):
    df = spark.createDataFrame([(1, 800), (201, 20000), (1, 3)], "x int, n int")
    assert [row[0] for row in df.select(percentage(F.col("x"), F.col("n"))).collect()] == [
        0.13, 1.01, 33.33]


def test_bi_table_flags_and_zeroes(flights):
    bi = curate.bi_flights(flights)
    assert len(bi.columns) == 20
    nulls = bi.filter("CarrierDelay IS NULL OR Is_Delayed IS NULL OR Is_Cancelled IS NULL")
    assert nulls.count() == 0


def test_mart_adds_up(flights):
    mart = curate.daily_mart(flights)
    total = mart.agg(F.sum("total_flights"), F.sum("cancelled_flights")).first()
    assert total[0] == flights.count()
    assert total[1] == flights.filter("Cancelled = 1").count()


def test_quality_report(raw):
    report = quality.data_quality_report(raw, sample_limit=2)
    assert report["total_rows"] == 7
    assert report["null_counts"]["FlightDate"] == 1
    assert len(report["sample"]) == 2
    assert len(report["null_counts"]) == 7


def test_quality_takes_one_scan(flights):
    assert plan_of(quality.null_profile(flights)).count("Scan parquet") == 2  # tree and details


def test_count_as_by_product(spark, raw, tmp_path):
    df, seen = quality.counted(raw, "rows seen")
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 7}


def test_text_indicators_count_by_their_number(spark):
    df = spark.createDataFrame(
        [("0.00",), ("1",), ("2",), ("x",), ("",), (None,)], "Cancelled string")
    kept = df.filter(cleaning.validity(df))
    assert sorted(r.Cancelled for r in kept.collect()) == ["0.00", "1"]


def test_entry_sessions_get_the_zone(spark):
    from skyledger.session import apply_settings

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    assert apply_settings(spark).conf.get("spark.sql.session.timeZone") == "UTC"
