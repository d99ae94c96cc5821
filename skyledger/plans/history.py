"""Load monthly CSV files into the partitioned flight table."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.schemas import RAW_FLIGHTS, REQUIRED_COLUMNS
from skyledger.sinks.files import LAYOUTS, replace_months, write_partitioned
from skyledger.sources.files import months_of, monthly_pattern, path_month
from skyledger.sources.tolerant import (
    BAD_REASON,
    BOOKKEEPING,
    FILE_PATH,
    FILE_SIZE,
    OPEN_QUOTE,
    read_tolerant,
)
from skyledger.storage import matching_paths, materialise

log = logging.getLogger(__name__)

# ---- fixed values -------------------------------------------------------------------------

MAX_BAD_RECORDS = 1000
STRAY = "month:stray"

# -------------------------------------------------------------------------------------------


class TooManyBadRecords(ValueError):
    """More bad rows than the load may skip; nothing was written."""


@dataclass
class Load:
    """Parsed rows of a load, staged in the shared folder."""

    rows: DataFrame

    @property
    def good(self) -> DataFrame:
        return self.rows.filter(F.col(BAD_REASON).isNull()).drop(*BOOKKEEPING)

    @property
    def bad(self) -> DataFrame:
        return self.rows.filter(F.col(BAD_REASON).isNotNull())

    def rejected(self) -> DataFrame:
        """file_path, reason and row (JSON) of the bad rows, of whatever columns."""
        return self.bad.select(
            F.col(FILE_PATH).alias("file_path"), F.col(BAD_REASON).alias("reason"),
            F.to_json(F.struct(*[c for c in self.rows.columns if c not in BOOKKEEPING]))
            .alias("row"))

    def report(self) -> DataFrame:
        """Per file: rows loaded, rows skipped, bytes; from three columns of the staged rows."""
        good = F.col(BAD_REASON).isNull()
        return self.rows.groupBy(F.col(FILE_PATH).alias("file_path")).agg(
            F.count_if(good).alias("output_rows"),
            F.count_if(~good).alias("bad_rows"),
            F.max(FILE_SIZE).alias("input_bytes"),
        )


def stage_csv(spark: SparkSession, path: str | list[str], schema: StructType = RAW_FLIGHTS,
              required: list[str] | None = None, quoted_newlines: bool = True) -> Load:
    """Parse CSV files once into typed, staged rows.

    Files are read in splits, so even a single huge file is parsed by many tasks. Only the files
    in which a field opens a quote that its line does not close are read again by physical lines,
    which replaces their first reading: see ``sources.spanning``.
    """
    needed = [name for name in (REQUIRED_COLUMNS if required is None else required)
              if name in schema.fieldNames()]
    rows = materialise(read_tolerant(spark, path, schema, needed), "load")
    if not quoted_newlines:
        return Load(rows)
    flagged = rows.filter(OPEN_QUOTE).select(FILE_PATH).distinct()
    # At most one entry per input file, which the driver has listed already.
    spanning = [row[0] for row in flagged.collect()]
    if not spanning:
        return Load(rows)
    log.info("%d files have quotes that their line does not close", len(spanning))
    again = materialise(read_tolerant(spark, spanning, schema, needed, spanning=True), "load")
    return Load(rows.join(F.broadcast(flagged), FILE_PATH, "left_anti").select(*rows.columns)
                .unionByName(again))


def only_own_months(load: Load) -> Load:
    """Rows of another month than their file's are bad rows."""
    year, month = path_month(FILE_PATH)
    own = F.coalesce((F.col("Year") == year) & (F.col("Month") == month), F.lit(False))
    return Load(load.rows.withColumn(BAD_REASON, F.coalesce(
        BAD_REASON, F.when(~own, F.lit(STRAY)))))


def load_csv(spark: SparkSession, path: str | list[str], target: str, mode: str = "append",
             schema: StructType = RAW_FLIGHTS, required: list[str] | None = None,
             partition_by: list[str] | None = None, cluster_by: list[str] | None = None,
             max_bad_records: int = MAX_BAD_RECORDS, quoted_newlines: bool = True,
             own_months: bool = False, rejected: str | None = None) -> DataFrame:
    """Load files in one job; returns the per-file report, which counts as loaded what is stored.

    Modes: ``append``; ``overwrite`` replaces the table once, for all files together;
    ``replace_months`` replaces exactly the months that the names of the files say (YYYY_MM.csv), so
    that repeating a load changes nothing: a file without rows empties its month. With
    ``own_months``, and always in that mode, rows of another month than their file's are bad. The
    target is untouched when there are more than ``max_bad_records`` bad rows. Bad rows are added
    to ``rejected`` as JSON, with file and reason, in either case.
    """
    if mode not in ("append", "overwrite", "replace_months"):
        raise ValueError(f"mode {mode!r} is none of append, overwrite, replace_months")
    layout = LAYOUTS["flights_raw"]
    partition_by = list(layout.partition_by) if partition_by is None else partition_by
    cluster_by = layout.cluster_by if cluster_by is None else cluster_by
    months = set()
    if mode == "replace_months":
        if partition_by != ["Year", "Month"]:
            raise ValueError("replace_months needs a table by Year and Month")
        patterns = [path] if isinstance(path, str) else path
        months = months_of(file for one in patterns for file, _ in matching_paths(spark, one))
    load = stage_csv(spark, path, schema, required, quoted_newlines)
    if own_months or mode == "replace_months":
        load = only_own_months(load)
    report = load.report()
    bad = report.agg(F.coalesce(F.sum("bad_rows"), F.lit(0))).first()[0]
    if bad and rejected:
        load.rejected().write.mode("append").parquet(rejected)
    if bad > max_bad_records:
        raise TooManyBadRecords(f"{bad} bad rows, {max_bad_records} allowed")
    if mode == "replace_months":
        replace_months(load.good, target, months, cluster_by)
    else:
        write_partitioned(load.good, target, partition_by, cluster_by, mode)
    return report


def load_all(spark: SparkSession, folder: str, target: str, mode: str = "append",
             **options) -> DataFrame:
    """Every CSV file directly below ``folder``."""
    return load_csv(spark, f"{folder.rstrip('/')}/*.csv", target, mode, **options)


def load_years(spark: SparkSession, folder: str, target: str, start_year: int, end_year: int,
               start_month: int | None = None, end_month: int | None = None,
               mode: str = "replace_months", **options) -> DataFrame:
    """The files of a range of years, optionally of the same months in each year."""
    pattern = monthly_pattern(folder, start_year, end_year, start_month, end_month)
    return load_csv(spark, pattern, target, mode, own_months=True, **options)


def load_month(spark: SparkSession, folder: str, target: str, year: int, month: int,
               mode: str = "replace_months", **options) -> DataFrame:
    return load_years(spark, folder, target, int(year), int(year), int(month), int(month), mode,
                      **options)


def load_totals(report: DataFrame) -> DataFrame:
    """One row over all files of a load report."""
    return report.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.coalesce(F.sum("output_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("bad_rows"), F.lit(0)).alias("total_bad_rows"),
        F.coalesce(F.sum("input_bytes"), F.lit(0)).alias("total_bytes"),
    )
