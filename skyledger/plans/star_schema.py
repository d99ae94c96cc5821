"""From cleaned flights to stored dimensions and fact."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from skyledger.operators import fact
from skyledger.operators.dimensions import DIMENSIONS, build_dims
from skyledger.plans.bucketed import fact_table_bucketed
from skyledger.sinks.files import save_dimension, write_parquet

log = logging.getLogger(__name__)


def write_dims(flights: DataFrame, folder: str, names: list[str] | None = None) -> dict[str, str]:
    """Build and store the chosen dimensions; returns their paths."""
    paths = {}
    for name, dim in build_dims(flights, names).items():
        paths[name] = save_dimension(dim, folder, name)
        log.info("dimension %s written to %s", name, paths[name])
    return paths


def read_dims(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {f"dim_{name}": spark.read.parquet(f"{folder.rstrip('/')}/dim-{name}.parquet")
            for name in DIMENSIONS}


FACT_BUILDS = {
    "default": fact.fact_table,
    "hinted": fact.fact_table_hinted,
    "with_ids": fact.fact_table_with_ids,
    "bucketed": fact_table_bucketed,
}


def write_fact(flights: DataFrame, dims_folder: str, target: str, build: str = "default",
               files: int | None = None) -> None:
    dims = read_dims(flights.sparkSession, dims_folder)
    write_parquet(FACT_BUILDS[build](flights, **dims), target, files=files)
