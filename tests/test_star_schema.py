from __future__ import annotations

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skyledger.operators import dimensions, fact
from skyledger.operators.cleaning import clean_flights
from skyledger.operators.ids import with_dense_id
from skyledger.plans import bucketed, star_schema
from skyledger.storage import matching_paths, shared_dir
from tests.conftest import plan_of, rows


@pytest.fixture(scope="module")
def cleaned(flights):
    return clean_flights(flights)


@pytest.fixture(scope="module")
def dims(cleaned):
    return {f"dim_{name}": dim for name, dim in dimensions.build_dims(cleaned).items()}


def repeated(flight, times):
    """The flight with ``times`` different arrival times."""
    times = F.sequence(F.lit(0), F.lit(times - 1)).cast("array<bigint>")
    return flight.withColumn("ArrTime", F.explode(times))


def test_ids_equal_a_plain_row_number(spark):
    df = spark.range(20000).select((F.xxhash64("id") % 300).alias("k"), F.col("id").alias("v"))
    plain = df.withColumn("n", F.row_number().over(Window.orderBy("k", "v")))
    assert with_dense_id(df, "n", ["k", "v"]).exceptAll(
        plain.withColumn("n", F.col("n").cast("bigint"))).count() == 0


def test_ids_spread_a_hot_leading_key(spark):
    """One leading key on all rows still gives several slices, none of them the whole."""
    df = spark.range(400000).select(F.lit("same").alias("k"), F.col("id").alias("v"))
    ranged = df.repartitionByRange("k", "v").groupBy(F.spark_partition_id()).count()
    sizes = [row["count"] for row in ranged.collect()]
    assert len(sizes) > 1 and max(sizes) < 300000
    ids = with_dense_id(df, "n", ["k", "v"])
    assert ids.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (1, 400000, 400000)


def test_ids_of_nothing_and_of_nulls(spark):
    empty = spark.createDataFrame([], "k string")
    assert with_dense_id(empty, "n", ["k"]).count() == 0
    df = spark.createDataFrame([(None,), ("b",), ("a",)], "k string")
    assert rows(with_dense_id(df, "n", ["k"])) == [("a", 2), ("b", 3), (None, 1)]


def test_ids_are_stored_values(spark, cleaned):
    """Reading a numbered table takes no join, window or exchange, and no slices stay behind."""
    plan = plan_of(dimensions.dim_delays(cleaned))
    assert not any(step in plan for step in ("Exchange", "Join", "Window"))
    assert not matching_paths(spark, f"{shared_dir(spark)}/skyledger/*-slices-*")


def test_fact_with_ids_joins_each_lookup_once(cleaned, dims):
    plan = plan_of(fact.fact_table_with_ids(cleaned, **dims))
    joins = re.findall(r"^\(\d+\) \w*Join", plan, re.M)
    assert len(joins) == 5


@pytest.mark.parametrize("name, id_column", [
    ("time", "time_id"), ("airport", "airport_id"), ("airline", "airline_id"),
    ("delay", "delay_id"), ("cancel", "cancellation_id")])
def test_ids_are_dense(dims, name, id_column):
    dim = dims[f"dim_{name}"]
    low, high, distinct, total = dim.agg(
        F.min(id_column), F.max(id_column), F.count_distinct(id_column),
        F.count(F.lit(1))).first()
    assert (low, high, distinct) == (1, total, total)


def test_weekday_is_monday_based(spark):
    df = spark.sql("SELECT DATE '2024-01-01' AS FlightDate")
    assert dimensions.dim_time(df).first()["DayOfWeek"] == 1


def test_delays_leave_out_cancelled_and_diverted(spark, cleaned):
    expected = cleaned.filter("Cancelled = 0 AND Diverted = 0").select(
        "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline",
        "Origin", "Dest").distinct().count()
    assert dimensions.delay_rows(cleaned).select("fact_key").distinct().count() == expected


def test_chosen_dimensions(cleaned):
    assert list(dimensions.build_dims(cleaned, ["airline"])) == ["airline"]
    with pytest.raises(ValueError, match="unknown"):
        dimensions.build_dims(cleaned, ["weather"])


def test_fact_equals_distinct_flights(cleaned, dims):
    expected = fact.with_fact_key(cleaned).select(*fact.FACT_COLUMNS).distinct().count()
    built = fact.fact_table(cleaned, **dims)
    assert built.count() == expected
    assert "Join" not in plan_of(built)


def test_hinted_fact_has_the_same_rows(cleaned, dims):
    default, hinted = fact.fact_table(cleaned, **dims), fact.fact_table_hinted(cleaned, **dims)
    assert default.exceptAll(hinted).count() == 0 == hinted.exceptAll(default).count()


def test_broadcast_only_below_the_limit(dims):
    dim = dims["dim_airport"]
    other = dim.select("AirportID").hint("shuffle_hash")

    def plan(limit):
        return plan_of(other.join(fact.broadcast_if_small(dim, limit), "AirportID", "left"))

    assert "BroadcastHashJoin" in plan(1000)
    assert "SortMergeJoin" in plan(3)


def test_ids_and_copies_and_missing_keys(spark, cleaned, dims):
    """Copies, a repeated flight key with other clock times, and flights without a key."""
    one = cleaned.filter("Cancelled = 0 AND Diverted = 0").limit(1)
    variants = repeated(one, 50)
    keyless = variants.withColumn("Origin", F.lit(None).cast("string"))
    source = cleaned.unionByName(variants).unionByName(variants).unionByName(keyless)
    built = fact.fact_table_with_ids(source, **dims)
    expected = fact.with_fact_key(source).select(*fact.FACT_COLUMNS).distinct().count()
    assert built.count() == expected
    assert built.filter("fact_key IS NULL").count() == 50
    assert built.filter("fact_key IS NULL AND delay_id IS NOT NULL").count() == 0
    assert built.filter("time_id IS NULL OR airline_id IS NULL").count() == 0


def test_hot_fact_key_is_split(spark, cleaned, dims):
    """A third of the rows on one key: the join's skewed partition is divided at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20kb",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    one = cleaned.filter("Cancelled = 0 AND Diverted = 0").limit(1)
    source = cleaned.unionByName(repeated(one, 60000).repartition(8))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        built = fact.fact_table_with_ids(source, **dims)
        picked = built.select("ArrTime", "delay_id")
        found = picked.collect()
        executed = picked._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    ids = {row["delay_id"] for row in found if (row["ArrTime"] or 0) >= 2400}
    assert len(ids) == 1 and None not in ids
    assert sum(row["delay_id"] in ids for row in found) >= 60000
    assert "skew=true" in executed


def test_bucketed_fact_merges_without_an_exchange(cleaned, dims):
    built = bucketed.fact_table_bucketed(cleaned, **dims)
    plan = plan_of(built)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    expected = fact.fact_table_with_ids(cleaned, **dims).select(*built.columns)
    assert built.exceptAll(expected).count() == 0 == expected.exceptAll(built).count()


def test_bucketed_fact_deals_hot_and_missing_keys(spark, cleaned, dims):
    """A third of the rows on one key and a third without one: no bucket holds either whole."""
    one = cleaned.filter("Cancelled = 0 AND Diverted = 0").limit(1)
    hot = repeated(one, 8000)
    keyless = hot.withColumn("Origin", F.lit(None).cast("string"))
    source = cleaned.unionByName(hot).unionByName(keyless)
    bucketed.store_bucketed(source, dims["dim_delay"], dims["dim_cancel"], "hot_facts",
                            "hot_events", buckets=16)
    sizes = [row["count"] for row in spark.table("hot_facts").groupBy(
        F.input_file_name()).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * sum(sizes) / 16
    built = bucketed.bucketed_fact(spark, "hot_facts", "hot_events")
    assert "Exchange" not in plan_of(built)
    expected = fact.fact_table_with_ids(source, **dims).select(*built.columns)
    assert built.exceptAll(expected).count() == 0 == expected.exceptAll(built).count()


def test_large_dimensions_join_alike(cleaned, dims):
    """With a broadcast limit of zero every join takes the other way; the rows are the same."""
    small = fact.fact_table_with_ids(cleaned, **dims)
    large = fact.fact_table_with_ids(cleaned, **dims, max_rows=0)
    assert small.exceptAll(large).count() == 0 == large.exceptAll(small).count()
    for join, dim in ((fact.join_time, "dim_time"), (fact.join_airports, "dim_airport"),
                      (fact.join_airline, "dim_airline")):
        few, many = join(cleaned, dims[dim]), join(cleaned, dims[dim], max_rows=0)
        assert few.exceptAll(many.select(*few.columns)).count() == 0
        assert few.count() == many.count() == cleaned.count()


def test_airline_join_does_not_fan_out_on_reused_codes(spark):
    flights = spark.createDataFrame([("X", 1), ("X", 2)], """IATA_CODE_Reporting_Airline string,
        DOT_ID_Reporting_Airline long""")
    dim = spark.createDataFrame([("X", "X", 1, 1), ("X", "X", 2, 2), ("X", "Y", 2, 3)],
                                """IATA_CODE_Reporting_Airline string, Reporting_Airline string,
                                DOT_ID_Reporting_Airline long, airline_id long""")
    assert rows(fact.join_airline(flights, dim), "DOT_ID_Reporting_Airline", "airline_id") == [
        (1, 1), (2, 2)]


def test_stored_schema(spark, cleaned, tmp_path):
    folder = str(tmp_path / "dims")
    star_schema.write_dims(cleaned, folder)
    for build in star_schema.FACT_BUILDS:
        star_schema.write_fact(cleaned, folder, str(tmp_path / build), build, files=2)
    counts = {build: spark.read.parquet(str(tmp_path / build)).count()
              for build in star_schema.FACT_BUILDS}
    assert len(set(counts.values())) == 1
