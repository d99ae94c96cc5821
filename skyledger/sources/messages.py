"""Message topics, API payloads and ride files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from skyledger.schemas import API_FLIGHT, RIDE


def _topic_options(servers: str, topics: str, starting: str,
                   options: Mapping[str, str] | None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
        **(options or {}),
    }


def topic_stream(spark: SparkSession, servers: str, topics: str, starting: str = "latest",
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """Stream of a topic's messages (needs Spark's Kafka connector on the class path)."""
    return (spark.readStream.format("kafka")
            .options(**_topic_options(servers, topics, starting, options)).load())


def topic_batch(spark: SparkSession, servers: str, topics: str, starting: str = "earliest",
                options: Mapping[str, str] | None = None) -> DataFrame:
    """The messages a topic holds now."""
    return (spark.read.format("kafka")
            .options(**_topic_options(servers, topics, starting, options)).load())


def message_files(spark: SparkSession, path: str,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of messages archived as Parquet files with binary key and value."""
    reader = spark.readStream.schema("key binary, value binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def decode_text(messages: DataFrame) -> DataFrame:
    """Key and value as UTF-8 text, for logging to a console sink."""
    return messages.select(F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"))


def explode_payload(payload: DataFrame) -> DataFrame:
    """One row per flight of the API answers' ``data`` lists."""
    return payload.select(F.explode("data").alias("flight")).select("flight.*")


def read_payload(spark: SparkSession, path: str, flight: StructType = API_FLIGHT,
                 multiline: bool = True) -> DataFrame:
    """Flights of saved API answers ``{"data": [...]}``: one JSON document per file, or, in
    files that can be split, one per line."""
    schema = StructType([StructField("data", ArrayType(flight))])
    answers = spark.read.schema(schema).option("multiLine", multiline).json(path)
    return explode_payload(answers)


def read_rides(spark: SparkSession, path: str) -> DataFrame:
    """Typed ride records of a CSV file with header."""
    return (spark.read.schema(RIDE).option("header", True)
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def decode_rides(messages: DataFrame) -> DataFrame:
    """Ride messages: integer key and the ride's columns; nulls where either does not parse."""
    text = decode_text(messages)
    ride = F.from_json("value", RIDE, {"timestampFormat": "yyyy-MM-dd HH:mm:ss"})
    return text.select(F.col("key").try_cast("int").alias("key"), ride.alias("ride")).select(
        "key", "ride.*")
