"""Approximate nearest neighbours: inverted lists scanned by an adaptive number of dimensions.

Equal vectors are one class, of which only the smallest ids can be among a query's nearest. Class
vectors are turned by a random rotation and dealt to lists by their nearest centroid; centroids
are fitted on a bounded sample, but every vector is in a list. A query looks through the lists of
its nearest centroids. In a list vectors lie in blocks of columns: after each block the partial
distance of a candidate, scaled up to all dimensions, is tested against the distance of the k-th
nearest so far, with a margin that shrinks as dimensions are seen; a candidate that fails is
abandoned. Survivors are measured on their original vectors in double precision.

Lists are dealt in cells of bounded size, so that a list that holds much of the table is scanned
by many tasks; every cell of a probed list is scanned, and no candidate is capped.

Vectors that are null, empty or zero, or hold a null, NaN or infinite component take no part;
neither do rows without an id. There is no distance between vectors of different numbers of
components: each width is searched by itself, with an index of its own, so that a query finds rows
of its own width. Rows that repeat both id and vector count once. A table without valid vectors, or with a query alone, gives no rows for
it. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from skyledger.llm.tables import stored

#: Vectors that centroids are fitted on, at most.
FIT_ROWS = 16_384
MAX_LISTS = 1_024
#: Of those, the ones that the number of probes is measured with, and the recall it must reach.
TRIAL_QUERIES, RECALL = 256, 0.97
#: Vectors of a list, and queries that probe it, that meet in one cell.
CELL_ROWS, CELL_QUERIES = 1_024, 512
BLOCK = 16
#: Standard deviations of the margin in the test that abandons a candidate.
MARGIN = 2.1
SEED = 42


def valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def rotation(dimensions: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, by the inner product; good enough to choose lists."""
    return ((points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1)[None])


def fitted(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Centroids of the sample by Lloyd's rounds; an empty one moves to the farthest point."""
    centres = sample[np.random.default_rng(SEED).permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        distances = squares(sample, centres)
        own = distances.argmin(1)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
        empty = np.flatnonzero(~full)
        if len(empty):
            centres[empty] = sample[np.argsort(distances.min(1))[::-1][:len(empty)]]
    return centres


def fitted_probes(sample: np.ndarray, centres: np.ndarray, k: int, goal: float) -> int:
    """Lists to look through so that a share ``goal`` of nearest neighbours is in one of them.

    Measured by brute force inside the sample. In the whole table neighbours are nearer than in a
    sample of it, so that their lists are found at least as early.
    """
    asking = sample[:TRIAL_QUERIES]
    distances = squares(asking, sample)
    distances[np.arange(len(asking)), np.arange(len(asking))] = np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return 1
    near = np.argpartition(distances, k - 1, axis=1)[:, :k]
    own = np.concatenate([squares(part, centres).argmin(1)
                          for part in np.array_split(sample, len(sample) // 1024 + 1)])
    ranks = squares(asking, centres).argsort(1).argsort(1)
    found = np.take_along_axis(ranks, own[near], axis=1)
    return int(np.quantile(found, goal, method="higher")) + 1


def scan(query: np.ndarray, blocks: list[np.ndarray], margin: float, k: int) -> np.ndarray:
    """Positions of the candidates that no test abandons.

    ``blocks`` hold the same candidates' columns; the first candidates are measured in full and
    give the bound that the others are tested against.
    """
    n, total = len(blocks[0]), sum(b.shape[1] for b in blocks)
    seeds = min(n, 4 * k)
    at, first = 0, np.zeros(seeds)
    for block in blocks:
        first += ((block[:seeds] - query[at:at + block.shape[1]]) ** 2).sum(1)
        at += block.shape[1]
    bound = np.partition(first, k - 1)[k - 1] if seeds >= k else np.inf
    alive, partial, seen = np.arange(seeds, n), np.zeros(n - seeds), 0
    for block in blocks:
        if not len(alive):
            break
        width = block.shape[1]
        partial = partial + ((block[alive] - query[seen:seen + width]) ** 2).sum(1)
        seen += width
        slack = (1 + margin / math.sqrt(seen)) ** 2 if seen < total else 1 + 1e-9
        keep = partial * (total / seen) <= bound * slack
        alive, partial = alive[keep], partial[keep]
    return np.concatenate([np.flatnonzero(first <= bound * (1 + 1e-9)), alive])


def _cell_scan(k: int, margin: float):
    """Nearest rows of one cell for each query in it, by exact distance, ties to smaller ids."""

    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vectors) and len(queries):
            turned = np.stack(vectors["turned"].to_numpy())
            blocks = [np.ascontiguousarray(turned[:, i:i + BLOCK])
                      for i in range(0, turned.shape[1], BLOCK)]
            exact = np.stack(vectors["vector"].to_numpy()).astype(np.float64)
            members = vectors["ids"].to_list()
            for rep, vector, turned_query in zip(
                    queries["rep"], queries["vector"], queries["turned"], strict=True):
                at = scan(np.asarray(turned_query), blocks, margin, k)
                scores = np.sqrt(((exact[at] - np.asarray(vector, np.float64)) ** 2).sum(1))
                order = np.argsort(scores, kind="stable")
                if len(order) > k:
                    order = order[scores[order] <= scores[order[k - 1]]]
                rows = sorted((scores[i], vec_id) for i in order for vec_id in members[at[i]])[:k]
                found += [(rep, vec_id, score) for score, vec_id in rows]
        return pd.DataFrame(found, columns=["rep", "vec_id", "score"])

    return run


def nearest(
    embeddings: DataFrame,
    is_query: Callable[[Column], Column],
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    probes: int | None = None,
    margin: float = MARGIN,
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's ``k`` nearest rows but its own.

    ``probes`` lists are looked through per query; by default as many as it takes for a recall of
    ``RECALL`` in the sample. With as many probes as lists and an infinite margin the search is
    exact.
    """
    rows = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    rows = stored(rows.where(F.col("vec_id").isNotNull() & valid(F.col("vector")))
                  .withColumn("vector", F.col("vector").cast("array<double>")), "ann-rows")
    widths = sorted(r["width"] for r in rows.select(F.size("vector").alias("width")).distinct().collect())
    found = [_nearest_of_width(rows.where(F.size("vector") == width), width, is_query, k, probes, margin)
             for width in widths or [1]]
    return reduce(DataFrame.union, found)


def _nearest_of_width(rows: DataFrame, width: int, is_query: Callable[[Column], Column], k: int,
                      probes: int | None, margin: float) -> DataFrame:
    """``nearest`` of valid rows (vec_id, vector) that all have ``width`` components."""
    spark = rows.sparkSession

    # One more than k ids of a class, as a query leaves itself out.
    smallest = rows.dropDuplicates(["vec_id", "vector"]).withColumn("place", F.row_number().over(
        W.partitionBy("vector").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    classes = stored(smallest.groupBy("vector").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn(
        "rep", F.col("ids")[0]), "ann-classes")
    asking = rows.where(is_query(F.col("vec_id"))).select(
        F.col("vec_id").alias("query_id"), "vector").distinct()
    asked = stored(asking.join(classes.select("rep", "vector"), "vector")
                   .select("query_id", "rep"), "ann-queries")

    n = classes.count()
    sample = classes.orderBy(F.xxhash64("rep")).limit(FIT_ROWS).select("vector").toPandas()
    turn = rotation(width)
    lists = max(1, min(MAX_LISTS, n // 8 + 1, int(math.sqrt(n)) + 1))
    centres = np.zeros((1, width))
    if len(sample):
        points = np.stack(sample["vector"].to_numpy()) @ turn
        centres = fitted(points, lists)
        if probes is None:
            probes = fitted_probes(points, centres, k, RECALL)
    probes = min(probes or 1, len(centres))
    index = spark.sparkContext.broadcast((turn, centres))

    def dealt(parts):
        turn, centres = index.value
        for part in parts:
            if len(part):
                turned = np.stack(part["vector"].to_numpy()) @ turn
                part["list"] = squares(turned, centres).argmin(1).astype(np.int32)
                part["turned"] = list(turned)
                yield part

    def probing(parts):
        turn, centres = index.value
        for part in parts:
            if len(part):
                turned = np.stack(part["vector"].to_numpy()) @ turn
                part["lists"] = list(np.argsort(squares(turned, centres), axis=1)[:, :probes]
                                     .astype(np.int32))
                part["turned"] = list(turned)
                yield part

    shape = "rep long, vector array<double>, turned array<double>, "
    listed = stored(classes.select("rep", "vector", "ids").mapInPandas(
        dealt, shape + "ids array<long>, list int"), "ann-lists")
    probed = stored(asked.select("rep").distinct().join(classes, "rep").select("rep", "vector")
                    .mapInPandas(probing, shape + "lists array<int>")
                    .withColumn("list", F.explode("lists")).drop("lists"), "ann-probes")

    # Cells: so many by list, for its vectors and for the queries that probe it.
    sizes = listed.groupBy("list").agg(F.ceil(F.count("*") / CELL_ROWS).alias("parts")).join(
        probed.groupBy("list").agg(F.ceil(F.count("*") / CELL_QUERIES).alias("shares")), "list")
    sizes = F.broadcast(sizes)  # at most MAX_LISTS rows

    def spread(df: DataFrame, own: str, other: str) -> DataFrame:
        """A row's own slice by hash, in every slice of the other side."""
        return df.join(sizes, "list").withColumn(
            own, F.pmod(F.xxhash64("rep"), F.col(f"{own}s"))).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}s") - 1))) \
            .drop("parts", "shares")

    cell = ["list", "part", "share"]
    found = spread(listed, "part", "share").groupBy(*cell).cogroup(
        spread(probed, "share", "part").groupBy(*cell)).applyInPandas(
        _cell_scan(k + 1, margin), "rep long, vec_id long, score double")
    nearest_of = W.partitionBy("rep").orderBy("score", "vec_id")
    best = found.withColumn("place", F.row_number().over(nearest_of)) \
        .where(F.col("place") <= k + 1).drop("place")
    by_query = W.partitionBy("query_id").orderBy("score", "vec_id")
    return asked.join(best, "rep").where(F.col("vec_id") != F.col("query_id")).withColumn(
        "rank", F.row_number().over(by_query).cast("int")).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
