"""Layouts of catalog tables: kept with the table and read back from it."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession

CLUSTER_PROPERTY = "skyledger.cluster_by"


@dataclass(frozen=True)
class StoredLayout:
    """What the catalog says of a table; ``declared`` if it says how rows are ordered."""

    location: str
    partition_by: list[str]
    cluster_by: list[str]
    declared: bool


def declare_clustering(spark: SparkSession, table: str, columns: list[str]) -> None:
    """Keep with the table in which order the rows of its files are to be."""
    unknown = set(columns) - set(spark.table(table).columns)
    if unknown or any("," in name for name in columns):
        raise ValueError(f"{table} cannot be clustered by {columns}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES "
              f"('{CLUSTER_PROPERTY}' = '{','.join(columns)}')")


def table_layout(spark: SparkSession, table: str) -> StoredLayout:
    [(text,)] = spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").collect()
    described = json.loads(text)
    order = described.get("table_properties", {}).get(CLUSTER_PROPERTY)
    return StoredLayout(described["location"], described.get("partition_columns", []),
                        order.split(",") if order else [], order is not None)
