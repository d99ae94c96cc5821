"""Reading the given tables, session settings and scratch tables for these operators."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from skyledger.storage import CHECKPOINT_SETTING, delete_path, scratch_path, shuffles_removed

#: Rows handed to Python at once: texts are long, and a worker holds one batch at a time.
ARROW_ROWS = 512


def prepared(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, and a shared folder where a local session names none."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    context = spark.sparkContext
    if (not spark.conf.get(CHECKPOINT_SETTING, None) and not context.getCheckpointDir()
            and context.master.startswith("local")):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="skyledger-"))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the cluster's shared folder and read from there.

    This cuts the lineage at files that outlive any executor; what was shuffled for it goes.
    """
    path = scratch_path(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that nothing is going to read any more."""
    for folder in {path.rpartition("/")[0] for path in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
