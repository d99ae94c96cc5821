"""Tolerant typed CSV reading.

Every token is read as text and cast on its own. Short rows are filled with nulls and surplus
columns are ignored; a row is *bad* only if a non-blank token does not fit the column's type or
a required column is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skyledger.schemas import as_text
from skyledger.sources.files import NO_NULL_TOKEN, unless_no_files
from skyledger.sources.spanning import read_records

FILE_PATH, FILE_SIZE, BAD_REASON = "_file_path", "_file_size", "_bad_reason"
_MALFORMED, OPEN_QUOTE, UNREADABLE = "_malformed", "_open_quote", "_unreadable"
_BETWEEN = "\x1f"
BOOKKEEPING = [FILE_PATH, FILE_SIZE, BAD_REASON, OPEN_QUOTE]


_CSV_OPTIONS = {"nullValue": NO_NULL_TOKEN, "escape": '"'}


def read_text_columns(spark: SparkSession, path: str | list[str],
                      schema: StructType) -> DataFrame:
    """The columns of ``schema`` as text, with source file and a mark on lines in which a field opens
    a quote that the line does not close: such a line may begin a record that spans lines."""
    text_schema = as_text(schema).add(StructField(_MALFORMED, StringType()))

    def read() -> DataFrame:
        reader = (
            spark.read.schema(text_schema).option("header", True).options(**_CSV_OPTIONS)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _MALFORMED)
        )
        quotes = F.length(_MALFORMED) - F.length(F.replace(F.col(_MALFORMED), F.lit('"')))
        # A field that opens a quote and does not close it keeps the quote as its first character.
        fields = F.concat_ws(_BETWEEN, F.lit(""), *[F.col(name) for name in schema.fieldNames()])
        return reader.csv(path).select(
            *schema.fieldNames(),
            F.col("_metadata.file_path").alias(FILE_PATH),
            F.col("_metadata.file_size").alias(FILE_SIZE),
            (F.coalesce(quotes % 2 == 1, F.lit(False)) | fields.contains(_BETWEEN + '"'))
            .alias(OPEN_QUOTE), F.lit(None).cast("string").alias(UNREADABLE),
        )

    def empty() -> DataFrame:
        return spark.createDataFrame([], as_text(schema)).select(
            "*", F.lit(None).cast("string").alias(FILE_PATH),
            F.lit(None).cast("bigint").alias(FILE_SIZE), F.lit(False).alias(OPEN_QUOTE),
            F.lit(None).cast("string").alias(UNREADABLE))

    return unless_no_files(read, empty)


def read_spanning_columns(spark: SparkSession, paths: list[str],
                          schema: StructType) -> DataFrame:
    """The same columns of files with records that span lines, and why a record is bad already."""
    text_schema = as_text(schema)
    options = {**_CSV_OPTIONS, "mode": "PERMISSIVE"}
    parsed = F.from_csv("record", text_schema.toDDL(), options).alias("row")
    return (read_records(spark, paths).where("record IS NOT NULL")
            .select(parsed, "file_path", "file_size", "reason")
            .select("row.*", F.col("file_path").alias(FILE_PATH), F.col("file_size").alias(FILE_SIZE),
                    F.lit(False).alias(OPEN_QUOTE), F.col("reason").alias(UNREADABLE)))


def parse_typed(text: DataFrame, schema: StructType, required: list[str]) -> DataFrame:
    """Cast every column; ``_bad_reason`` names the first offending column, null on good rows."""

    def blank(name: str) -> Column:
        return F.coalesce(F.trim(F.col(name)) == "", F.lit(True))

    typed, reasons = [], []
    for field in schema.fields:
        name = field.name
        if isinstance(field.dataType, StringType):
            typed.append(F.col(name))
            continue
        value = F.trim(F.col(name)).try_cast(field.dataType)
        typed.append(value.alias(name))
        reasons.append(F.when(~blank(name) & value.isNull(), F.lit(f"type:{name}")))
    reasons += [F.when(blank(name), F.lit(f"missing:{name}")) for name in required]
    reason = F.coalesce(UNREADABLE, *reasons)
    return text.select(*typed, FILE_PATH, FILE_SIZE, reason.alias(BAD_REASON), OPEN_QUOTE)


def read_tolerant(spark: SparkSession, path: str | list[str], schema: StructType,
                  required: list[str], spanning: bool = False) -> DataFrame:
    """Typed rows of ``schema`` plus the bookkeeping columns."""
    read = read_spanning_columns if spanning else read_text_columns
    return parse_typed(read(spark, path, schema), schema, required)
