"""Mixing sources to target weights with hash thresholds, without sorting documents.

The size of a document is its number of words. Sources in code point order (null last) get
weights in turn; they share ``share`` times all words by weight, but a source's target stops at
``cap`` times its size, and the excess is shared again by weight until none is above.

A source takes every document as often as its target holds the whole source, and once more
each document whose hash is not above the source's threshold. The threshold is found with nested
histograms: words by source and hash bucket, running sums over the buckets, and then the same
inside the one bucket that holds the boundary, and last by single hash in the boundary's bucket.
The hash at the boundary is taken if that brings the sum nearer to the target, so that a source
misses its target by half a document at most. A larger target never drops a document.

Null and empty texts have size 0 and take nothing; a null source is a source. Rows with the same
id have the same hash and are taken or left together. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from skyledger.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"

_HASH_BITS, _STEP = 60, 12


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_of(doc_id: Column) -> Column:
    """60 bits of the MD5 of the id."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, _HASH_BITS // 4), 16, 10).cast("long")


def targets(sized: DataFrame, weights: Sequence[int], share: Fraction, cap: int) -> DataFrame:
    """One row per source: source, source_size, target, whole copies, and the rest to fill, doubled.

    All sums are whole numbers; ``target`` is num / den.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights are positive whole numbers")
    by_source = W.orderBy(F.col("source").asc_nulls_last())
    fill = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    p, q = share.numerator, share.denominator
    cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = sources.withColumn("place", F.row_number().over(by_source)).withColumn(
        "weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    total = F.sum("source_size").over(W.partitionBy())
    before = F.coalesce(
        F.sum("source_size").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    heavier = F.sum("weight").over(fill.rowsBetween(W.currentRow, W.unboundedFollowing))
    # The smallest sources for their weight are full first: full if an equal share per weight of
    # what the fuller ones leave is at least what the source can take.
    full = ranked.withColumn("total", total).withColumn("full", (
        F.lit(q * cap) * F.col("source_size") * heavier
        <= F.col("weight") * (F.lit(p) * F.col("total") - F.lit(q * cap) * before)))
    everything = W.partitionBy()
    taken = F.sum(F.when(F.col("full"), F.col("source_size")).otherwise(0)).over(everything)
    rest = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    numerator = F.when(F.col("full"), F.lit(cap) * F.col("source_size")).otherwise(
        F.col("weight") * (F.lit(p) * F.col("total") - F.lit(q * cap) * taken))
    denominator = F.when(F.col("full"), F.lit(1).cast("long")).otherwise(F.lit(q) * rest)
    return full.withColumn("num", numerator).withColumn("den", denominator).withColumn(
        "copies", F.when(F.col("source_size") > 0,
                         F.expr("num div (den * source_size)")).otherwise(F.lit(0).cast("long"))
    ).select(
        "source", "source_size", (F.col("num") / F.col("den")).alias("target"), "copies",
        F.expr("(2 * num) div den - 2 * copies * source_size").alias("room"))


def _boundary(sized: DataFrame, open_sources: DataFrame, shift: int) -> DataFrame:
    """The bucket of each source in which the running sum passes the room, if there is one.

    A bucket whose sums before and up to it are b and u is taken whole if 2u is within the room,
    left whole if 2b is beyond it.
    """
    inside = sized.join(open_sources, (sized["source"].eqNullSafe(open_sources["source"]))
                        & (F.shiftright("hash", shift + _STEP) == F.col("prefix"))).select(
        sized["source"], "size", F.shiftright("hash", shift).alias("bucket"), "room")
    sums = inside.groupBy("source", "room", "bucket").agg(F.sum("size").alias("words"))
    run = W.partitionBy("source").orderBy("bucket")
    upto = sums.withColumn("upto", F.sum("words").over(run))
    return upto.where("2 * (upto - words) <= room and room < 2 * upto").select(
        "source", F.col("bucket").alias("prefix"),
        (F.col("room") - 2 * (F.col("upto") - F.col("words"))).alias("room"))


def thresholds(sized: DataFrame, weights: Sequence[int], share: Fraction, cap: int) -> DataFrame:
    """source, source_size, target, copies and the largest hash that is taken once more."""
    goals = stored(targets(sized, weights, share, cap), "mix-targets")
    first = _HASH_BITS - _STEP
    start = goals.select("source", F.lit(0).cast("long").alias("prefix"), "room")
    one = stored(_boundary(sized, start, first), "mix-level1")
    two = stored(_boundary(sized, one, first - _STEP), "mix-level2")
    inside = sized.join(two, (sized["source"].eqNullSafe(two["source"]))
                        & (F.shiftright("hash", first - _STEP) == F.col("prefix"))).select(
        sized["source"], "size", "hash", "room")
    sums = inside.groupBy("source", "room", "hash").agg(F.sum("size").alias("words"))
    run = W.partitionBy("source").orderBy("hash")
    three = sums.withColumn("upto", F.sum("words").over(run)).where(
        "2 * upto - words <= room").groupBy("source").agg(F.max("hash").alias("last"))

    def keyed(df: DataFrame, name: str, value: Column) -> DataFrame:
        return df.select(F.col("source").alias(f"{name}_source"), value.alias(name))

    def joined(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
        return left.join(right, left["source"].eqNullSafe(F.col(f"{name}_source")), "left")

    below = lambda shift: F.shiftleft(F.col("prefix"), shift) - 1
    found = joined(goals, keyed(one, "t1", below(first)), "t1")
    found = joined(found, keyed(two, "t2", below(first - _STEP)), "t2")
    found = joined(found, keyed(three, "t3", F.col("last")), "t3")
    whole = F.when(F.col("room") >= 2 * F.col("source_size"), F.lit((1 << _HASH_BITS) - 1)) \
        .otherwise(F.lit(-1)).cast("long")
    return found.select("source", "source_size", "target", "copies",
                        F.coalesce("t3", "t2", "t1", whole).alias("threshold"))


def mixed(
    documents: DataFrame,
    weights: Sequence[int] = (3, 1, 2),
    share: Fraction = Fraction(3, 2),
    cap: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, size, hash per document; the thresholds per source).

    Sizes are counted once and kept as a narrow table, which the histograms read.
    """
    sized = stored(documents.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        size_of(F.col(text)).alias("size"), hash_of(F.col(doc_id)).alias("hash")), "mix-sizes")
    return sized, stored(thresholds(sized, weights, share, cap), "mix-thresholds")


def times_taken(hash_column: Column) -> Column:
    """How often a document that stands beside its source's threshold is taken."""
    return F.col("copies") + F.when(hash_column <= F.col("threshold"), 1).otherwise(0)


def takes(sized: DataFrame, limits: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: words that the mix takes, repeats counted.

    The thresholds are a stored table, so the join is a broadcast only if its files are small.
    """
    limits = limits.withColumnRenamed("source", "limit_source")
    return sized.join(limits, sized["source"].eqNullSafe(F.col("limit_source"))).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * times_taken(F.col("hash"))).alias("taken"), "source")


def mixture(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
            source: str = "source", **settings) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    _, limits = mixed(documents, doc_id=doc_id, text=text, source=source, **settings)
    limits = limits.select(F.col("source").alias("limit_source"), "copies", "threshold")
    # The documents' columns go through as one, so that none can clash.
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            F.col(source).alias("source"), hash_of(F.col(doc_id)).alias("hash"))
    times = times_taken(F.col("hash")).cast("int")
    return rows.join(limits, F.col("source").eqNullSafe(F.col("limit_source"))).select(
        "row", F.explode(F.array_repeat(F.lit(1), times))).select("row.*")
