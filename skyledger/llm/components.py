"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.tables import discard, stored

#: Links that a task joins at once.
PIECE = 1 << 20


def _stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links as stars: each node that is not the least of its component here, and that one."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[:len(u)], place[len(u):]
    low = np.arange(len(nodes))
    while True:
        x, y = low[a], low[b]
        if (x == y).all():
            larger = low != np.arange(len(nodes))
            return nodes[larger], nodes[low[larger]]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a task, piece by piece, as stars."""

    def stars() -> pa.RecordBatch:
        u, v = (np.concatenate([b.column(c).to_numpy() for b in piece]) for c in ("u", "v"))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _stars(u, v)], names=["u", "v"])

    piece: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        piece.append(batch)
        held += batch.num_rows
        if held >= PIECE:
            yield stars()
            piece, held = [], 0
    if piece:
        yield stars()


def _unfinished(edges: DataFrame) -> bool:
    """Whether stars of different tasks touch each other."""
    ends = edges.union(edges.select(F.col("v").alias("u"), F.lit(None).cast("long").alias("v")))
    # A node of finished stars is the least of one, or has the least of one as its only neighbour.
    return bool(ends.groupBy("u").agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("up"),
        F.count("*").alias("rows")).agg(F.max(
            (F.col("up") > 0) & ((F.col("low") < F.col("high")) | (F.col("rows") > F.col("up"))))
        ).first()[0])


def _least(edges: DataFrame, other: str) -> DataFrame:
    return edges.groupBy("u").agg(F.min(other).alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the least node that links lead to, for every node with a link.

    Each task joins the links that it reads into stars. While stars of different tasks touch each
    other, rounds of large stars and small stars follow: every node hands its neighbours on to the
    least node it knows, first the larger neighbours, then the smaller ones. Each round is two
    aggregations and joins over the stars; a node with many links is split by the join like any
    hot key.
    """
    def joined(edges: DataFrame) -> DataFrame:
        # Written first, so that few tasks read many links each.
        plain = stored(edges.where("u <> v"), "links")
        stars = stored(plain.mapInArrow(_joined, "u long, v long"), "stars")
        discard(plain)
        return stars

    edges = joined(links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")))
    while _unfinished(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both, "v"), "u").where("v > u").select(
            F.col("v").alias("u"), F.least("m", "u").alias("v"))
        # Now v is always the smaller end.
        small = large.join(_least(large, "v"), "u")
        before, edges = edges, joined(small.select("u", F.col("m").alias("v")).union(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))))
        discard(before)
    return edges.union(edges.select("v", "v")).groupBy(F.col("u").alias("node")).agg(
        F.min("v").alias("component"))
