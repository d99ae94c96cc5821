"""Streaming writes: checkpointed, append-only and safe to replay."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from skyledger.storage import path_exists, touch

# ---- fixed values -------------------------------------------------------------------------

TRIGGER, OUTPUT_MODE, PARTITION_BY = "5 seconds", "append", "flight_date"

# -------------------------------------------------------------------------------------------

BATCH_COLUMN = "batch_id"


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``trigger``: an interval, ``available`` to drain the source and stop, or None for
    batches back to back."""
    if trigger is None:
        return writer
    if trigger == "available":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def file_sink(stream: DataFrame, path: str, checkpoint: str, trigger: str | None = TRIGGER,
              output_mode: str = OUTPUT_MODE, file_format: str = "parquet",
              partition_by: str | None = PARTITION_BY) -> DataStreamWriter:
    """Files in directories by flight date; the sink's log makes each batch appear once."""
    writer = (stream.writeStream.format(file_format).option("path", path)
              .option("checkpointLocation", checkpoint).outputMode(output_mode))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _triggered(writer, trigger)


def table_sink(stream: DataFrame, checkpoint: str, trigger: str | None = TRIGGER,
               output_mode: str = OUTPUT_MODE, target: str = "parquet",
               **options: str) -> DataStreamWriter:
    """Writer for a warehouse connector; start it with ``start()`` or ``toTable(name)``."""
    writer = (stream.writeStream.format(target).options(**options)
              .option("checkpointLocation", checkpoint).outputMode(output_mode))
    return _triggered(writer, trigger)


def replayable_batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: every batch owns a directory and overwrites it, so that a
    batch that runs twice is stored once.

    The directory is named after the query's id, which its checkpoint keeps, and the batch: a
    query with another checkpoint counts its batches anew and must not touch those stored here.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(path, _batch_name(batch, batch_id)))

    return write


def _batch_name(batch: DataFrame, batch_id: int) -> str:
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("batches are named after their query: write them from foreachBatch")
    return f"{query}-{batch_id}"


def _batch_folder(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{BATCH_COLUMN}={name}"


Target = Callable[[DataFrame, str], None]


def parquet_target(path: str, partition_by: str | None = None) -> Target:
    """A target of ``dual_batch_writer``: the batch's directory below ``path``, replaced whole."""

    def write(batch: DataFrame, name: str) -> None:
        writer = batch.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(_batch_folder(path, name))

    return write


def dual_batch_writer(targets: Mapping[str, Target],
                      markers: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that commits one batch to several targets.

    The batch is parsed once and kept on the executors' disks while the targets are written (a lost
    executor's part is read again). After each target an empty marker file goes to
    ``markers/<target>/<query>-<batch>``. If a target fails, so does the batch, and Spark hands the
    same one out after the restart: targets with a marker are left as they are and only the others
    are written. A target that failed half-way is overwritten, so writing to one must replace
    what an earlier try of the same batch left.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, _batch_name(batch, batch_id)
        marks = {target: f"{markers.rstrip('/')}/{target}/{name}" for target in targets}
        pending = [target for target in targets if not path_exists(spark, marks[target])]
        if not pending:
            return
        batch.persist(StorageLevel.DISK_ONLY)
        try:
            for target in pending:
                targets[target](batch, name)
                touch(spark, marks[target])
        finally:
            batch.unpersist()

    return write


def batch_sink(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
               trigger: str | None = None) -> DataStreamWriter:
    return _triggered(
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), trigger)


def start_dual_sink(stream: DataFrame, path: str, checkpoint: str, second_path: str,
                    second_checkpoint: str,
                    trigger: str | None = TRIGGER) -> list[StreamingQuery]:
    """Two independent queries over one parsed stream: files by date, and the warehouse copy.

    Each has its own checkpoint, so one may lag or restart without the other.
    """
    files = file_sink(stream, path, checkpoint, trigger).start()
    copy = batch_sink(stream, replayable_batch_writer(second_path), second_checkpoint,
                      trigger).start()
    return [files, copy]


def dual_sink(stream: DataFrame, path: str, second_path: str, markers: str, checkpoint: str,
              trigger: str | None = TRIGGER,
              partition_by: str | None = PARTITION_BY) -> DataStreamWriter:
    """One query that reads the stream once and writes files by date and the warehouse copy; both
    hold the same batches whenever it rests."""
    targets = {"files": parquet_target(path, partition_by), "copy": parquet_target(second_path)}
    return batch_sink(stream, dual_batch_writer(targets, markers), checkpoint, trigger)


def console_sink(stream: DataFrame, checkpoint: str,
                 trigger: str | None = TRIGGER) -> DataStreamWriter:
    """Print decoded messages."""
    writer = (stream.writeStream.format("console").option("truncate", False)
              .option("checkpointLocation", checkpoint))
    return _triggered(writer, trigger)


def read_batches(spark, path: str, schema: StructType | None = None) -> DataFrame:
    """All batches a replayable writer has stored, without the batch column. A ``schema`` spares
    reading footers and gives columns that are directories their type."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop(F.col(BATCH_COLUMN))
