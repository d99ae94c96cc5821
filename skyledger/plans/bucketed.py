"""Facts and event ids in bucketed tables, joined by merging bucket with bucket.

Both tables are dealt by flight key once, when they are written. Any number of later joins by that
key then read bucket beside bucket and move no row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.fact import FACT_COLUMNS, event_ids, with_fact_key
from skyledger.storage import materialise, scratch_path

SLICE = "key_slice"
BUCKET_KEYS = ["fact_key", SLICE]


def _write_bucketed(dealt: DataFrame, table: str, path: str, buckets: int) -> None:
    """One file a bucket, if the rows are dealt by the same hash that names the bucket."""
    (dealt.write.mode("overwrite").option("compression", "zstd")
     .bucketBy(buckets, *BUCKET_KEYS).sortBy(*BUCKET_KEYS).option("path", path)
     .saveAsTable(table))


def _hot_keys(facts: DataFrame, buckets: int) -> DataFrame:
    """(fact_key, slices) of the keys with more rows than a mean bucket: fewer than ``buckets`` of
    them, whatever the data, so that they can be broadcast.

    Frequent items, which miss no key above their support and cost no shuffle of all keys, name the
    candidates; those are counted. Beyond 5,000 buckets the least support may miss keys that hold
    less than a ten-thousandth of the rows, which then stay in one bucket.
    """
    total = facts.count()
    share = max(total // buckets, 1)
    keyed = facts.select("fact_key").filter(F.col("fact_key").isNotNull())
    candidates = keyed.stat.freqItems(["fact_key"], max(0.5 / buckets, 1e-4)).select(
        F.explode("fact_key_freqItems").alias("fact_key"))
    counted = keyed.join(F.broadcast(candidates), "fact_key").groupBy("fact_key").agg(
        F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("rows") > share).select(
        "fact_key", F.least(F.ceil(F.col("rows") / share), F.lit(buckets)).cast("int")
        .alias("slices"))


def _sliced(slices: Column, columns: list[str]) -> Column:
    return F.pmod(F.xxhash64(*columns), slices).cast("int")


def store_bucketed(flights: DataFrame, dim_delay: DataFrame, dim_cancel: DataFrame,
                   facts_table: str, events_table: str, buckets: int | None = None,
                   folder: str | None = None) -> None:
    """Write distinct facts and (fact_key, delay_id, cancellation_id) as bucketed catalog tables.

    A key with more rows than a mean bucket is dealt over several slices, and its one row of event
    ids is repeated for each; facts without a key match nothing and are dealt over all buckets.
    So no bucket holds a hot key whole. Rows of such keys, or of none, lose their copies before they
    are dealt, all others in their bucket, so that most rows move once. ``buckets`` defaults to the shuffle partitions, ``folder``
    to a new one in the shared folder.
    """
    spark = flights.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = folder or scratch_path(spark, "bucketed")
    facts = with_fact_key(flights).select(*FACT_COLUMNS)
    hot = materialise(_hot_keys(facts, buckets), "hot-keys")

    slices = F.when(F.col("fact_key").isNull(), F.lit(buckets)).otherwise(
        F.coalesce("slices", F.lit(1)))
    marked = facts.join(F.broadcast(hot), "fact_key", "left").select(*FACT_COLUMNS, "slices")
    alone = F.col("fact_key").isNotNull() & F.col("slices").isNull()
    dealt = marked.filter(alone).unionByName(marked.filter(~alone).distinct()).select(
        *FACT_COLUMNS, _sliced(slices, FACT_COLUMNS).alias(SLICE))
    _write_bucketed(dealt.repartition(buckets, *BUCKET_KEYS).distinct(), facts_table,
                    f"{folder}/facts", buckets)

    ids = event_ids(dim_delay, dim_cancel)
    every = F.sequence(F.lit(0), F.coalesce("slices", F.lit(1)) - 1)
    repeated = ids.join(F.broadcast(hot), "fact_key", "left").select(
        *ids.columns, F.explode(every).alias(SLICE))
    _write_bucketed(repeated.repartition(buckets, *BUCKET_KEYS), events_table,
                    f"{folder}/events", buckets)


def bucketed_fact(spark: SparkSession, facts_table: str, events_table: str) -> DataFrame:
    """Facts with the ids of their delay and cancellation: a sort-merge join without an exchange.
    Spark sorts each bucket's rows, which lie in order already; the merge holds one row a key."""
    events = spark.table(events_table).hint("merge")
    return spark.table(facts_table).join(events, BUCKET_KEYS, "left").select(
        *FACT_COLUMNS, "delay_id", "cancellation_id")


def fact_table_bucketed(flights: DataFrame, dim_time: DataFrame, dim_airport: DataFrame,
                        dim_airline: DataFrame, dim_delay: DataFrame, dim_cancel: DataFrame,
                        buckets: int | None = None) -> DataFrame:
    """The fact through bucketed tables of its own; dates, airports and airlines are not looked up,
    as the facts hold their natural keys."""
    spark = flights.sparkSession
    names = [f"{kind}_{uuid.uuid4().hex}" for kind in ("facts", "events")]
    store_bucketed(flights, dim_delay, dim_cancel, *names, buckets=buckets)
    return bucketed_fact(spark, *names)
