"""Spark session with the settings the operators rely on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    # AQE sizes shuffles, turns small sides into broadcasts and splits hot keys.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even when that costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM leaves methods above 8000 bytes of byte code interpreted. Wide projections (the
    # raw table has 109 columns) reach that when fused into one method; beyond this limit Spark
    # compiles them as several smaller ones, which is four times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "skyledger",
    configs: Mapping[str, str] | None = None,
    master: str | None = None,
) -> SparkSession:
    """Get or create a session; ``configs`` override the defaults above.

    ``spark.sql.shuffle.partitions`` is left to the cluster: AQE coalesces it downwards, so a
    large value there is right for large inputs and harmless for small ones.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(configs or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Give a session that was built elsewhere those defaults that may change at run time."""
    for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit",
                "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, SESSION_DEFAULTS[key])
    return spark
