"""Mergeable profiles and samples of whole files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.operators import analytics, profile, sampling
from skyledger.sinks.files import write_partitioned
from tests.conftest import plan_of, rows


def test_merged_months_equal_the_exact_summary(flights):
    """All but the distinct aircraft, of which there are many, equal; those within 2 %."""
    merged = profile.merged_profile(profile.month_profiles(flights))
    exact = analytics.table_summary(flights)
    same = [name for name in exact.columns if not name.startswith("avg")]
    assert rows(merged, *same) == rows(exact, *same)
    for name in ("avg_dep_delay", "avg_arr_delay"):
        assert merged.first()[name] == pytest.approx(exact.first()[name])
    aircraft = flights.select("Tail_Number").distinct().count()
    assert merged.first()["unique_aircraft"] == pytest.approx(aircraft, rel=0.02)


def test_sketches_stay_close_at_many_values(spark):
    """Months that share half of their aircraft: the union is not the sum."""
    def month(number, first):
        return spark.range(first, first + 40000).select(
            F.lit(2001).alias("Year"), F.lit(number).alias("Month"),
            F.make_date(F.lit(2001), F.lit(number), F.lit(1)).alias("FlightDate"),
            F.lit(0.0).alias("Cancelled"), F.lit(0.0).alias("Diverted"),
            F.lit(1.0).alias("DepDelay"), F.lit(None).cast("double").alias("ArrDelay"),
            F.lit("X").alias("Reporting_Airline"), F.lit("A").alias("Origin"),
            F.lit(None).cast("string").alias("Dest"),
            F.concat(F.lit("N"), F.col("id").cast("string")).alias("Tail_Number"))

    merged = profile.merged_profile(
        profile.month_profiles(month(1, 0).unionByName(month(2, 20000)))).first()
    assert merged["unique_aircraft"] == pytest.approx(60000, rel=0.02)
    assert (merged["unique_airlines"], merged["unique_destinations"]) == (1, 0)
    assert (merged["avg_dep_delay"], merged["avg_arr_delay"]) == (1.0, None)


def test_a_month_replaces_its_own_profile_only(spark, flights, tmp_path):
    path, stored = str(tmp_path / "profiles"), str(tmp_path / "flights")
    write_partitioned(flights, stored, ["Year", "Month"])
    table = spark.read.parquet(stored)
    profile.update_profiles(table, path)
    before = {tuple(row[:2]): row[2] for row in profile.read_profiles(spark, path).select(
        "Year", "Month", "rows").collect()}
    profile.update_profiles(table.filter("DayofMonth <= 10"), path, [(1998, 6), (1890, 1)])
    profile.update_profiles(table.filter("Month = 1"), path, [(1998, 7)])
    profile.update_profiles(table, path, [])
    after = {tuple(row[:2]): row[2] for row in profile.read_profiles(spark, path).select(
        "Year", "Month", "rows").collect()}
    part = flights.filter("Year = 1998 AND Month = 6 AND DayofMonth <= 10").count()
    expected = before | {(1998, 6): part}
    del expected[(1998, 7)]
    assert after == expected and 0 < part < before[(1998, 6)]


def test_a_month_is_read_by_its_directory(spark, flights, tmp_path, monkeypatch):
    write_partitioned(flights, str(tmp_path / "flights"), ["Year", "Month"])
    plans = []
    monkeypatch.setattr(profile, "replace_months", lambda df, *_: plans.append(plan_of(df)))
    profile.update_profiles(spark.read.parquet(str(tmp_path / "flights")), "unused", [(1998, 6)])
    assert "PartitionFilters: [isnotnull(Year" in plans[0]


def test_flights_without_a_month_are_refused(flights, tmp_path):
    with pytest.raises(ValueError, match="without a year"):
        profile.update_profiles(flights.withColumn("Month", F.lit(None).cast("int")),
                                str(tmp_path / "profiles"))


def test_profile_of_nothing(flights):
    merged = profile.merged_profile(profile.month_profiles(flights.limit(0))).first()
    assert (merged["total_rows"], merged["unique_airlines"], merged["earliest_date"]) == (0, 0, None)


def _scanned(df):
    """(files, bytes) that the scan of ``df`` read."""
    df.collect()
    metrics = df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    return metrics.apply("numFiles").value(), metrics.apply("filesSize").value()


def test_block_sample_reads_only_drawn_files(spark, tmp_path):
    path = str(tmp_path / "blocks")
    spark.range(64000).repartition(64).write.parquet(path)
    table = spark.read.parquet(path)
    sample = sampling.block_sample(table, 0.25, seed=3)
    drawn = [row[0] for row in sample.select("_metadata.file_path").distinct().collect()]
    everything, some = _scanned(table), _scanned(sample)
    assert 0 < len(drawn) < 40 and some[0] == len(drawn)
    assert some[1] < everything[1] * 0.7 and everything[0] == 64
    whole = table.filter(F.col("_metadata.file_path").isin(drawn))
    assert rows(sample) == rows(whole) == rows(sampling.block_sample(table, 0.25, seed=3))
    assert rows(sampling.block_sample(table, 0.25, seed=4)) != rows(sample)


def test_block_sample_bounds(spark, tmp_path):
    path = str(tmp_path / "blocks")
    spark.range(100).repartition(4).write.parquet(path)
    table = spark.read.parquet(path)
    assert sampling.block_sample(table, 0).count() == 0
    assert sampling.block_sample(table, 1).count() == 100


def test_weighted_draws_given(spark):
    """Equal numbers: the largest weights win; none and negative ones never do."""
    df = spark.createDataFrame([("a", 1), ("b", 9), ("c", 0), ("d", None), ("e", 5)],
                               "name string, weight int")
    picked = sampling.weighted_sample(df, "weight", 4, by=F.lit(0.5))
    assert [row["name"] for row in picked.collect()] == ["b", "e", "a"]
