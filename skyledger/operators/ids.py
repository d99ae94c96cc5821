"""Dense surrogate ids 1..n in key order, without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.storage import delete_path, scratch_path

_SLICE, _POSITION, _BEFORE = "_slice", "_position", "_before"


def with_dense_id(df: DataFrame, id_column: str, order_by: list[str]) -> DataFrame:
    """Equal to ``row_number() OVER (ORDER BY order_by)``, at any size; the result reads a table in
    the shared folder that holds the ids.

    The rows are range-partitioned and sorted on the whole order (so one repeated leading key
    still spreads over several slices), numbered inside their slice and staged. The staged slice
    number and position are facts that no task retry can change. Slice sizes come from two pruned
    columns of that table; their running sum, one row per slice, is broadcast to a second pass,
    which shuffles nothing and writes the final ids. Then the staged rows go: readers meet
    neither join nor offset.

    ``order_by`` must identify a row, else equal rows get their ids in any order.
    """
    spark = df.sparkSession
    staged, final = scratch_path(spark, f"{id_column}-slices"), scratch_path(spark, id_column)
    local_number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    (df.repartitionByRange(*order_by)
     .sortWithinPartitions(*order_by)
     .select("*", F.spark_partition_id().alias(_SLICE), (local_number + 1).alias(_POSITION))
     .write.option("compression", "zstd").parquet(staged))
    sliced = spark.read.parquet(staged)
    running = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(_SLICE).agg(F.max(_POSITION).alias("_size"))
        .select(_SLICE, F.coalesce(F.sum("_size").over(running), F.lit(0)).alias(_BEFORE))
    )
    numbered = sliced.join(F.broadcast(offsets), _SLICE).select(
        *df.columns, (F.col(_BEFORE) + F.col(_POSITION)).alias(id_column))
    numbered.write.option("compression", "zstd").parquet(final)
    delete_path(spark, staged)
    return spark.read.schema(numbered.schema).parquet(final)
