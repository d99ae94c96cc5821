"""Keyed JSON messages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.messages import flight_id
from skyledger.schemas import CODESHARED

# ---- fixed values: producer settings ------------------------------------------------------

PRODUCER_OPTIONS = {
    "kafka.compression.type": "snappy",
    "kafka.batch.size": "1000000",
    "kafka.linger.ms": "10000",
    "kafka.max.request.size": "3145728",
    "kafka.partitioner.class": "org.apache.kafka.clients.producer.RoundRobinPartitioner",
}

# -------------------------------------------------------------------------------------------


def normalise_payload(flights: DataFrame) -> DataFrame:
    """A missing code-share becomes an empty record; delays become text, null stays null."""
    empty = F.from_json(F.lit("{}"), CODESHARED)
    codeshared = F.coalesce("flight.codeshared", empty)
    return (
        flights
        .withColumn("flight", F.col("flight").withField("codeshared", codeshared))
        .withColumn("departure", F.col("departure").withField(
            "delay", F.col("departure.delay").cast("string")))
        .withColumn("arrival", F.col("arrival").withField(
            "delay", F.col("arrival.delay").cast("string")))
    )


def to_messages(rows: DataFrame, key: Column, value: Column, keep_nulls: bool = False,
                timestamp_format: str | None = None) -> DataFrame:
    """(key, value, headers): texts of the key and value columns.

    Struct keys and values are written as JSON. A null value stays null, which a topic takes
    as a deletion mark. The header holds a fresh correlation id.
    """
    options = {"ignoreNullFields": str(not keep_nulls).lower()}
    if timestamp_format:
        options["timestampFormat"] = timestamp_format
    parts = rows.select(key.alias("key"), value.alias("value"))

    def text(name: str) -> Column:
        column = F.col(name)
        if parts.schema[name].dataType.typeName() != "struct":
            return column.cast("string")
        return F.when(column.isNotNull(), F.to_json(column, options))

    header = F.struct(F.lit("correlation_id").alias("key"),
                      F.uuid().cast("binary").alias("value"))
    return parts.select(text("key").alias("key"), text("value").alias("value"),
                        F.array(header).alias("headers"))


def flight_messages(flights: DataFrame, key: Column | None = None,
                    keep_nulls: bool = False) -> DataFrame:
    """Messages of normalised flights under ``{"flight_id": …}``."""
    identifier = F.struct((key if key is not None else flight_id()).alias("flight_id"))
    value = F.struct(*[F.col(name) for name in flights.columns])
    return to_messages(flights, identifier, value, keep_nulls)


def ride_messages(rides: DataFrame) -> DataFrame:
    """Ride messages keyed by pickup location."""
    value = F.struct(*[F.col(name) for name in rides.columns])
    return to_messages(rides, F.col("PULocationID"), value,
                       timestamp_format="yyyy-MM-dd HH:mm:ss")


def unkeyed_messages(rows: DataFrame) -> DataFrame:
    """Value-only messages, one JSON text per row."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def write_topic(messages: DataFrame, servers: str, topic: str,
                options: Mapping[str, str] | None = None) -> None:
    """Send to a topic (needs Spark's Kafka connector on the class path)."""
    (messages.write.format("kafka")
     .options(**{**PRODUCER_OPTIONS, **(options or {})})
     .option("includeHeaders", "true")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
