"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import datetime
import glob
import math
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    number = float(value)
    return None if math.isnan(number) else number


def _rows(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda index: names[index])
    return Counter(tuple(_plain(row[index]) for index in order) for row in rows)


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, text: str) -> str:
    """Empty if both hold the same columns and rows, else what differs."""
    cursor = connection.execute(text)
    expected_names = [column[0] for column in cursor.description]
    expected = _rows(expected_names, cursor.fetchall())
    if sorted(result.columns) != sorted(expected_names):
        return f"columns {sorted(result.columns)} != {sorted(expected_names)}"
    actual = _rows(result.columns, [tuple(row) for row in result.collect()])
    if actual == expected:
        return ""
    surplus, missing = list((actual - expected).items()), list((expected - actual).items())
    return (f"{sum(actual.values())} rows, {sum(expected.values())} expected; "
            f"surplus {surplus[:2]}; missing {missing[:2]}")
