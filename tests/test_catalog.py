"""Layouts kept in the catalog."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.sinks import catalog
from skyledger.sinks import files as sinks
from tests.conftest import rows


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE kept LOCATION '{tmp_path / 'kept'}'")
    yield "kept"
    spark.sql("DROP DATABASE kept CASCADE")


def test_layout_comes_back_from_the_catalog(spark, database):
    for table in sinks.create_tables(spark, database):
        declared = sinks.LAYOUTS[table.split(".")[1]]
        layout = catalog.table_layout(spark, table)
        assert layout.partition_by == list(declared.partition_by)
        assert layout.cluster_by == declared.cluster_by and layout.declared


def test_order_of_an_existing_table_stays(spark, database):
    [table] = sinks.create_tables(spark, database, ["flights_raw"])
    catalog.declare_clustering(spark, table, ["Dest"])
    sinks.create_tables(spark, database, ["flights_raw"])
    assert catalog.table_layout(spark, table).cluster_by == ["Dest"]
    with pytest.raises(ValueError, match="clustered"):
        catalog.declare_clustering(spark, table, ["Nowhere"])


def test_a_table_without_a_layout(spark, database):
    spark.range(3).write.saveAsTable("kept.plain")
    layout = catalog.table_layout(spark, "kept.plain")
    assert (layout.partition_by, layout.cluster_by, layout.declared) == ([], [], False)
    sinks.append_to_table(spark.range(2), "kept.plain")
    (row,) = sinks.catalog_inventory(spark, ["kept.plain"]).collect()
    assert (row["num_rows"], row["partitioning"], row["clustering"]) == (5, "", "")


def test_appended_rows_by_name(spark, database):
    """Columns in another order, one missing, one of another type; an unknown one is refused."""
    spark.sql("CREATE TABLE kept.t (a INT, b STRING, c DOUBLE) USING parquet PARTITIONED BY (a)")
    sinks.append_to_table(spark.sql("SELECT 'x' AS b, 1L AS a"), "kept.t")
    assert rows(spark.table("kept.t"), "a", "b", "c") == [(1, "x", None)]
    with pytest.raises(ValueError, match="no columns"):
        sinks.append_to_table(spark.sql("SELECT 1 AS a, 2 AS d"), "kept.t")


def _rows_read(df):
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_declared_order_lets_row_groups_be_skipped(spark, database):
    """The same rows appended to a table that declares an order and to one that does not: a filter
    on the ordered column reads a part of the one and all of the other."""
    size = {"parquet.block.size": "65536", "parquet.page.row.count.limit": "1000"}
    given = spark.range(200000).select(
        (F.xxhash64("id") % 1000).alias("k"), F.col("id"), F.lit(1).alias("part"))
    read = {}
    for name in ("ordered", "loose"):
        options = ", ".join(f"'{key}' = '{value}'" for key, value in size.items())
        spark.sql(f"CREATE TABLE kept.{name} (k BIGINT, id BIGINT, part INT) USING parquet "
                  f"OPTIONS ({options}) PARTITIONED BY (part)")
        if name == "ordered":
            catalog.declare_clustering(spark, "kept.ordered", ["k"])
        sinks.append_to_table(given, f"kept.{name}")
        found = spark.table(f"kept.{name}").filter("k = 77")
        read[name] = _rows_read(found.select("id"))
        assert rows(found, "id") == rows(given.filter("k = 77"), "id")
    assert read["ordered"] < 0.2 * read["loose"] and read["loose"] > 100000
