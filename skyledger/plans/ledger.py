"""Load many files in batches that fail alone, and load again only what failed.

A batch has its own budget of bad rows. One that exceeds it, or cannot be read, is tried again file
by file, so that a bad file costs nothing but itself. The ledger, a table in the shared storage, has
a row for each file of each attempt; files that it knows as loaded, with the same length, are left
out by the next run. Rejected rows are kept beside it, with file and reason.

A batch is entered once its months are in place. If a run ends in between, the next one loads those
files again, which changes nothing in mode ``replace_months``; ``append`` would add them twice and is
refused.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.plans.history import MAX_BAD_RECORDS, TooManyBadRecords, load_csv
from skyledger.storage import matching_paths, path_exists

log = logging.getLogger(__name__)

BATCH_FILES = 50
LOADED, FAILED = "loaded", "failed"

SCHEMA = ("run string, batch string, file string, length long, outcome string, output_rows long, "
          "bad_rows long, error string, entered timestamp")


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """A row for each file of each attempt."""
    path = f"{ledger.rstrip('/')}/attempts"
    if not path_exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


def outcomes(spark: SparkSession, ledger: str) -> DataFrame:
    """The last attempt of each file."""
    columns = [field.name for field in read_ledger(spark, ledger).schema.fields if field.name != "file"]
    last = read_ledger(spark, ledger).groupBy("file").agg(
        F.max_by(F.struct(*columns), F.struct("entered", "outcome")).alias("last"))
    return last.select("file", "last.*")


def rejected_rows(spark: SparkSession, ledger: str) -> DataFrame:
    """batch, file_path, reason, row (JSON) of all bad rows of all attempts."""
    path = f"{ledger.rstrip('/')}/rejected"
    schema = "file_path string, reason string, row string, batch string"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _batches(files: list[tuple[str, int]], size: int) -> Iterator[list[tuple[str, int]]]:
    for start in range(0, len(files), size):
        yield files[start:start + size]


def load_batches(spark: SparkSession, pattern: str, target: str, ledger: str,
                 batch_files: int = BATCH_FILES, max_bad_records: int = MAX_BAD_RECORDS,
                 **options) -> DataFrame:
    """Load the files that match ``pattern`` (named YYYY_MM.csv) and are not loaded yet; returns the
    ledger's rows of this run."""
    if options.get("mode", "replace_months") != "replace_months":
        raise ValueError("batches can be repeated only if they replace months")
    options["mode"] = "replace_months"
    known = {(row.file, row.length) for row in outcomes(spark, ledger)
             .where(F.col("outcome") == LOADED).select("file", "length").collect()}
    # One entry per file, as in the listing itself.
    files = [file for file in matching_paths(spark, pattern) if file not in known]
    run, folder = uuid.uuid4().hex, ledger.rstrip("/")

    def attempt(batch: list[tuple[str, int]]) -> str | None:
        """Loads and enters a batch; the reason why it failed, if it did."""
        name = uuid.uuid4().hex
        try:
            report = load_csv(spark, [path for path, _ in batch], target,
                              max_bad_records=max_bad_records,
                              rejected=f"{folder}/rejected/batch={name}", **options)
        except (TooManyBadRecords, PySparkException, Py4JError, ValueError) as error:
            if len(batch) > 1:
                return str(error)
            enter(name, batch, FAILED, None, str(error).split("\n")[0])
            return str(error)
        enter(name, batch, LOADED, report, None)
        return None

    def enter(name: str, batch: list, outcome: str, report: DataFrame | None,
              error: str | None) -> None:
        entries = spark.createDataFrame(
            [(run, name, path, length, outcome, error) for path, length in batch],
            "run string, batch string, file string, length long, outcome string, error string")
        if report is None:
            counts = entries.select("*", F.lit(None).cast("long").alias("output_rows"),
                                    F.lit(None).cast("long").alias("bad_rows"))
        else:
            # A directory named like a month has the rows of all files in it.
            of = F.regexp_extract("file_path", r"^(.*/\d{4}_\d{1,2}\.csv)(?:/[^/]*)?$", 1)
            by_file = report.groupBy(F.regexp_replace(of, "^file:/+", "file:/").alias("key")).agg(
                F.sum("output_rows").alias("output_rows"), F.sum("bad_rows").alias("bad_rows"))
            counts = (entries.withColumn("key", F.regexp_replace("file", "^file:/+", "file:/"))
                      .join(by_file, "key", "left")
                      .withColumns({c: F.coalesce(c, F.lit(0).cast("long"))
                                    for c in ("output_rows", "bad_rows")}))
        counts.select("run", "batch", "file", "length", "outcome", "output_rows", "bad_rows", "error",
                      F.current_timestamp().alias("entered")) \
            .coalesce(1).write.mode("append").parquet(f"{folder}/attempts")

    for batch in _batches(files, batch_files):
        failed = attempt(batch)
        if failed and len(batch) > 1:
            log.warning("a batch of %d files is loaded file by file: %s", len(batch), failed)
            for file in batch:
                attempt([file])
    return read_ledger(spark, ledger).where(F.col("run") == run)
