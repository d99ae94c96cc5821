"""Parquet layouts, compaction, conversion, exports and warehouse tables."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger import schemas
from skyledger.sinks.catalog import declare_clustering, table_layout
from skyledger.sources.files import read_csv
from skyledger.storage import (
    delete_path, matching_paths, path_exists, qualified, settings, shuffles_removed, swap_directory)

log = logging.getLogger(__name__)

#: Directories of a table that are rewritten at the same time, each by a job of its own.
DIRECTORIES_AT_ONCE = 8


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None,
                  dry_run: bool = False) -> None:
    """Write ``df``; mode ``errorifexists`` refuses to replace anything.

    The rows are written where they are, without a shuffle. A number of ``files`` costs one; it
    does not, as a coalesce would, reduce the parallelism of the work above the write.
    """
    if dry_run:
        log.info("dry run: nothing written to %s", path)
        return
    out = df.repartition(files) if files else df
    with shuffles_removed(df.sparkSession):
        out.write.mode(mode).parquet(path)


def save_dimension(df: DataFrame, folder: str, name: str) -> str:
    path = f"{folder.rstrip('/')}/dim-{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return path


def clustered(df: DataFrame, partition_by: list[str], cluster_by: list[str]) -> DataFrame:
    """Rows of one directory together and sorted for min/max skipping.

    A rebalance, not a repartition: a month that holds a third of the rows is split over
    several tasks, and small months are packed together.
    """
    keys = [F.col(name) for name in partition_by]
    order = [*partition_by, *cluster_by]
    return df.hint("rebalance", *keys).sortWithinPartitions(*order)


def write_partitioned(df: DataFrame, path: str, partition_by: list[str],
                      cluster_by: list[str] | None = None, mode: str = "overwrite",
                      replace_touched_only: bool = False) -> None:
    """Partitioned Parquet; optionally replace only the directories that get new rows, which
    makes a repeated monthly load harmless."""
    overwrite = "dynamic" if replace_touched_only else "static"
    with shuffles_removed(df.sparkSession):
        (clustered(df, partition_by, cluster_by or []).write.mode(mode)
         .option("partitionOverwriteMode", overwrite)
         .partitionBy(*partition_by).parquet(path))


def replace_months(df: DataFrame, path: str, months: Iterable[tuple[int, int]],
                   cluster_by: list[str] | None = None) -> None:
    """Make the rows of ``df`` all that a table by Year and Month holds of the given ``months``.

    The rows are written beside the table first, and then each month's directory takes the place
    of the old one; a month without rows goes. Other months are not touched, whatever the rows say.
    A run that stops in between leaves every month either old or new, and can be repeated.
    """
    spark = df.sparkSession
    staged = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    write_partitioned(df, staged, ["Year", "Month"], cluster_by)
    for year, month in sorted(months):
        part = f"Year={year}/Month={month}"
        if path_exists(spark, f"{staged}/{part}"):
            swap_directory(spark, f"{staged}/{part}", f"{path.rstrip('/')}/{part}")
        elif path_exists(spark, f"{path}/{part}"):
            delete_path(spark, f"{path}/{part}")
    delete_path(spark, staged)


def _read_in_parts(spark: SparkSession, share: int, largest: int) -> AbstractContextManager[None]:
    """Stored tables are read in parts of a quarter of the ``share`` of a file in here, so that as many
    of them as a file takes can be put together without moving rows. Files up to the size ``largest``
    are not cut: one with a single row group would leave parts without rows."""
    return settings(spark, {
        "spark.sql.files.maxPartitionBytes": str(max(share // 4, largest, 1)),
        "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"})


def compact_parquet(spark: SparkSession, source: str, target: str,
                    files: int | None = None, file_bytes: int = 128 << 20) -> DataFrame:
    """Rewrite a directory of many files as few (without a number: as many as fit the advisory
    partition size); returns a reader over the result. A source with more than ``file_bytes`` for
    each of ``files`` gets more of them, as one task writes a file.

    A task reads the files whose rows it writes; rows are only moved if the source falls into fewer
    parts than files are asked for.

    Source and target must differ: overwriting a directory while reading it loses the data.
    """
    if qualified(spark, source) == qualified(spark, target):
        raise ValueError("compact into another directory, or use compact_in_place")
    df = spark.read.parquet(source)
    if not files:
        write_parquet(df.hint("rebalance"), target)
    else:
        held = sum(size for _, size in matching_paths(spark, source))
        files = max(files, -(-held // file_bytes))
        largest = _data_files(spark, source).agg(F.max("length")).first()[0] or 0
        with _read_in_parts(spark, held // files, min(largest, file_bytes)):
            if df.rdd.getNumPartitions() < files:
                write_parquet(df, target, files=files)
            else:
                write_parquet(df.coalesce(files), target)
    return spark.read.schema(df.schema).parquet(target)


def compact_in_place(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """Compact into a sibling directory and swap it in once it is complete. A table in directories
    of key values keeps them: see ``compact_partitions``."""
    if _partition_files(spark, path).filter("folder <> ''").isEmpty():
        staged = f"{path.rstrip('/')}.compacting"
        compact_parquet(spark, path, staged, files)
        swap_directory(spark, staged, path)
    else:
        compact_partitions(spark, path)
    return spark.read.parquet(path)


def _data_files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").load(path).select("path", "length"))


def _partition_files(spark: SparkSession, path: str) -> DataFrame:
    """folder (below the table, like Year=2001/Month=5), files, bytes, largest."""
    # The part of the path that is made of key values.
    folder = F.regexp_extract("path", r"/((?:[^/=]+=[^/]*/)+)[^/]*$", 1)
    return _data_files(spark, path).groupBy(F.rtrim(folder, F.lit("/")).alias("folder")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("length").alias("largest"))


def compact_partitions(spark: SparkSession, path: str, cluster_by: list[str] | None = None,
                       file_bytes: int = 128 << 20) -> list[str]:
    """Rewrite those directories of a partitioned table that have more files than their bytes need;
    returns them.

    No row leaves its directory: tasks read the files of a directory and write as many as it needs.
    Some directories are rewritten at a time, the largest first, and each takes the place of the old
    one as soon as it is complete, so that readers see the old files or the new ones, the disk holds
    few directories twice, and other directories stay as they are.
    """
    needed = F.ceil(F.col("bytes") / file_bytes)
    # One entry per directory of the table.
    rewritten = (_partition_files(spark, path).withColumn("needed", needed)
                 .filter((F.col("folder") != "") & (F.col("files") > F.col("needed")))
                 .orderBy(F.col("bytes").desc()).collect())
    if not rewritten:
        return []
    table, folders = path.rstrip("/"), [row.folder for row in rewritten]
    names = [part.split("=")[0] for part in folders[0].split("/")]
    found = spark.read.option("basePath", table).parquet(*[f"{table}/{folder}" for folder in folders])
    schema = StructType([column for column in found.schema if column.name not in names])
    order = [name for name in cluster_by or [] if name not in names]
    staged = f"{table}.compacting-{uuid.uuid4().hex}"

    def compact(folder: str, files: int) -> None:
        rows = spark.read.schema(schema).parquet(f"{table}/{folder}").coalesce(max(files, 1))
        (rows.sortWithinPartitions(*order) if order else rows).write.option(
            "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{staged}/{folder}")
        swap_directory(spark, f"{staged}/{folder}", f"{table}/{folder}")

    try:
        largest = min(max(row.largest for row in rewritten), file_bytes)
        with (_read_in_parts(spark, file_bytes, largest),
              ThreadPoolExecutor(DIRECTORIES_AT_ONCE) as pool):
            list(pool.map(compact, folders, [row.needed for row in rewritten]))
    finally:
        delete_path(spark, staged)
    return sorted(folders)


def convert_csv(spark: SparkSession, source: str, target: str, schema: StructType | None = None,
                infer: bool = False, partition_by: list[str] | None = None,
                files: int | None = None, dry_run: bool = False,
                multiline: bool = False, header: bool = True) -> bool:
    """CSV to Parquet; true if something was written. An empty input is found by looking for
    one row, not by counting all."""
    df = read_csv(spark, source, schema, infer, multiline, header=header)
    log.info("input schema: %s", df.schema.simpleString())
    if df.isEmpty():
        log.warning("no rows in %s", source)
        return False
    if dry_run:
        log.info("dry run: nothing written to %s", target)
        return False
    if partition_by:
        write_partitioned(df, target, partition_by)
    else:
        write_parquet(df, target, files=files)
    return True


# ---- exports ------------------------------------------------------------------------------


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header; ``single_file`` is meant for results of report size."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    """One JSON record per line, ISO dates, nulls written out."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


EXPORTS = {"csv": export_csv, "json": export_json, "parquet": export_parquet}


# ---- warehouse tables ---------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """How a table is stored: directories by ``partition_by`` (names, or new columns given as
    SQL expressions), rows inside a file in ``cluster_by`` order."""

    schema: StructType
    partition_by: Mapping[str, str]
    cluster_by: list[str] = field(default_factory=list)

    def stored(self, df: DataFrame) -> DataFrame:
        return df.withColumns({name: F.expr(text) for name, text in self.partition_by.items()})


# Directories by year and month: one per day would mean some 13,000 for the history.
LAYOUTS = {
    "flights_raw": Layout(schemas.RAW_FLIGHTS, {"Year": "Year", "Month": "Month"},
                          ["Reporting_Airline", "Origin", "Dest"]),
    "flights_processed": Layout(schemas.LIVE_FLIGHTS, {"event_date": "to_date(timestamp)"},
                                ["airline", "origin", "destination"]),
    "flights_analytics": Layout(schemas.DAILY_MART,
                                {"year": "year(date)", "month": "month(date)"},
                                ["airline", "origin", "destination"]),
}


def create_tables(spark: SparkSession, database: str | None = None,
                  names: list[str] | None = None) -> list[str]:
    """Create the empty partitioned tables that do not exist yet. The order of their rows is kept
    with the table, see ``catalog.table_layout``; that of an existing table stays as it is."""
    created = []
    for name in names or list(LAYOUTS):
        layout = LAYOUTS[name]
        table = f"{database}.{name}" if database else name
        empty = layout.stored(spark.createDataFrame([], layout.schema))
        (empty.write.mode("ignore").format("parquet")
         .partitionBy(*layout.partition_by).saveAsTable(table))
        if not table_layout(spark, table).declared:
            declare_clustering(spark, table, layout.cluster_by)
        created.append(table)
    return created


def write_layout(df: DataFrame, name: str, path: str, mode: str = "overwrite",
                 replace_touched_only: bool = False) -> None:
    """Store rows in the layout declared for table ``name``."""
    layout = LAYOUTS[name]
    write_partitioned(layout.stored(df), path, list(layout.partition_by), layout.cluster_by,
                      mode, replace_touched_only)


def write_table(df: DataFrame, name: str, mode: str = "overwrite", target: str | None = None,
                options: Mapping[str, str] | None = None) -> None:
    """Catalog table, or a table of the warehouse connector named by ``target``."""
    if target is None:
        df.write.mode(mode).saveAsTable(name)
    else:
        (df.write.format(target).options(**(options or {})).option("table", name)
         .mode(mode).save())


def append_to_table(df: DataFrame, table: str) -> None:
    """Add rows to a catalog table in the layout that the catalog holds for it: rows of one
    directory together, in the order that the table declares. Columns go by name; one that the
    table lacks is an error, one that ``df`` lacks becomes null."""
    spark = df.sparkSession
    layout, schema = table_layout(spark, table), spark.table(table).schema
    extra = set(df.columns) - set(schema.names)
    if extra:
        raise ValueError(f"{table} has no columns {sorted(extra)}")
    rows = df.select(*[
        (F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None))
        .cast(field.dataType).alias(field.name) for field in schema])
    if layout.partition_by or layout.cluster_by:
        rows = clustered(rows, layout.partition_by, layout.cluster_by)
    rows.write.insertInto(table)


def table_inventory(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """(table_name, num_rows, num_bytes, partitioning, clustering) of Parquet tables by path.

    Rows come from the file footers, bytes from the file listing; no column is read.
    """
    return _inventory(spark, {name: (spark.read.parquet(path), path)
                              for name, path in tables.items()},
                      {name: (list(LAYOUTS[name].partition_by), LAYOUTS[name].cluster_by)
                       for name in tables.keys() & LAYOUTS.keys()})


def catalog_inventory(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """The same of catalog tables, empty ones included, with the layout that the catalog holds."""
    layouts = {name: table_layout(spark, name) for name in tables}
    return _inventory(spark, {name: (spark.table(name), layout.location)
                              for name, layout in layouts.items()},
                      {name: (layout.partition_by, layout.cluster_by)
                       for name, layout in layouts.items()})


def _inventory(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, str]],
               layouts: Mapping[str, tuple[list[str], list[str]]]) -> DataFrame:
    nothing = F.lit(0).cast("bigint")
    parts = []
    for name, (rows, path) in tables.items():
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .option("pathGlobFilter", "*.parquet").load(path))
        parts.append(rows.agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(name).alias("table_name"), "num_rows", nothing.alias("num_bytes")))
        parts.append(files.agg(F.sum("length").alias("num_bytes")).select(
            F.lit(name).alias("table_name"), nothing.alias("num_rows"), "num_bytes"))
    if not parts:
        raise ValueError("no tables given")
    totals = (reduce(DataFrame.unionByName, parts).groupBy("table_name")
              .agg(F.sum("num_rows").alias("num_rows"),
                   F.coalesce(F.sum("num_bytes"), nothing).alias("num_bytes")))

    def declared(part: int):
        label = F.lit(None).cast("string")
        for name, layout in layouts.items():
            label = F.when(F.col("table_name") == name, ",".join(layout[part])).otherwise(label)
        return label

    return totals.select("*", declared(0).alias("partitioning"), declared(1).alias("clustering"))
