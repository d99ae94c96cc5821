"""CSV, Parquet and table readers, and the choice of monthly files."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# ---- fixed values: monthly files are called YYYY_MM.csv -----------------------------------

MONTHLY_NAME = r"^(\d{4})_(\d{1,2})\.csv$"
# The same in the path of a file, also of one in a directory of that name.
MONTHLY_PATH = r"/(\d{4})_(\d{1,2})\.csv(?:/[^/]*)?$"

# -------------------------------------------------------------------------------------------

# No such token occurs in the data: a quoted "" then stays an empty string instead of null.
NO_NULL_TOKEN = "\\N"
LISTING = "path string, length long"


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
             infer: bool = False, multiline: bool = False,
             null_token: str | None = None, header: bool = True) -> DataFrame:
    """CSV, by default with a header line; without one columns are called _c0, _c1 and so on.
    Columns get the types of ``schema``; without one they are strings, or inferred on request
    (which reads the files twice)."""
    reader = spark.read.option("header", header).option("multiLine", multiline)
    reader = reader.option("quote", '"').option("escape", '"')
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str, source: str | None = None,
               options: Mapping[str, str] | None = None) -> DataFrame:
    """A catalog table, or one that a warehouse connector named by ``source`` serves."""
    if source is None:
        return spark.read.table(name)
    return spark.read.format(source).options(**(options or {})).option("table", name).load()


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None,
            args: Mapping[str, object] | None = None) -> DataFrame:
    """Run SQL against the catalog and the given frames; values are bound, never spliced in.
    The result stays distributed."""
    for name, frame in (tables or {}).items():
        frame.createOrReplaceTempView(name)
    return spark.sql(text, args=dict(args or {}))


def unless_no_files(read: Callable[[], DataFrame], empty: Callable[[], DataFrame]) -> DataFrame:
    """``read()``, or ``empty()`` where the path pattern matches no file."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty()


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, length) of the files a pattern matches; file contents are not read."""
    return unless_no_files(
        lambda: spark.read.format("binaryFile").load(pattern).select("path", "length"),
        lambda: spark.createDataFrame([], LISTING),
    )


def list_csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """The CSV files directly below ``folder``, in order of their path."""
    return list_files(spark, f"{folder.rstrip('/')}/*.csv").orderBy("path")


def _alternatives(values: list[str]) -> str:
    return "{" + ",".join(values) + "}"


def monthly_pattern(folder: str, start_year: int, end_year: int, start_month: int | None = None,
                    end_month: int | None = None) -> str:
    """Path pattern of the monthly files of a range of years, and of months within each year.

    The month test is independent of the year: 2000..2002 with 6..8 means three summers. Files
    outside the pattern are not even listed as input.
    """
    if start_year > end_year:
        raise ValueError(f"years {start_year}..{end_year} are in the wrong order")
    years = _alternatives([str(year) for year in range(start_year, end_year + 1)])
    base = f"{folder.rstrip('/')}/{years}_"
    if start_month is None and end_month is None:
        return f"{base}*.csv"
    months = range(start_month or 1, (end_month or 12) + 1)
    spellings = [text for month in months for text in dict.fromkeys([str(month),
                                                                     f"{month:02d}"])]
    if not spellings:
        raise ValueError(f"months {start_month}..{end_month} are in the wrong order")
    return f"{base}{_alternatives(spellings)}.csv"


def with_file_month(df: DataFrame) -> DataFrame:
    """Add ``file_year`` and ``file_month`` read from the name of the source file."""
    name = F.col("_metadata.file_name")

    def number(group: int):
        return F.regexp_extract(name, MONTHLY_NAME, group).try_cast("int")

    return df.select("*", number(1).alias("file_year"), number(2).alias("file_month"))


def path_month(path: Column | str) -> tuple[Column, Column]:
    """Year and month that the path of a monthly file names, or nulls."""
    return tuple(F.regexp_extract(path, MONTHLY_PATH, group).try_cast("int") for group in (1, 2))


def months_of(paths: Iterable[str]) -> set[tuple[int, int]]:
    """The (year, month) of each path; one that names none is refused."""
    months = set()
    for path in paths:
        found = re.search(MONTHLY_PATH, path)
        if not found:
            raise ValueError(f"{path} is not named like 2001_05.csv")
        months.add((int(found[1]), int(found[2])))
    return months
