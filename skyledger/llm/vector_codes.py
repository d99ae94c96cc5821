"""Vector codes: each vector as the indices of the nearest entries of a codebook for each part.

Components become whole numbers, floor(256 * x), so that all sums and distances are exact. A vector
is cut into ``parts`` equal consecutive parts; the codebook of a part starts with that part of the
vectors of least id. Each Lloyd round assigns every part to its nearest entry and then moves each
entry to the floor of the mean of its parts; the parts are assigned once more at the end.

A round is a pass over the vectors in Spark tasks, with the codebooks handed to them (``entries``
times the width of a vector, whatever the number of vectors). It stores the code of each part and its
exact distance, and the next pass looks at active entries only: where the assigned entry of a
part did not move, all entries that did not move are as far as before, and only those that moved
are compared with the stored distance. Where it did move, all entries are compared again. Of
equally near entries the one of lower index is taken, in both cases. Sums are taken in each task
first, one row for each component of an entry, and the tables between the rounds lie in the
cluster's shared folder, where the one before last is deleted.

Vectors that are null or hold null, NaN or infinite components are left out. If widths differ, or
are no multiple of the number of parts, vectors are read as if zeros followed up to the next
multiple above the widest one; an empty vector is all zeros. Rows without an id come after all
others, rows that share an id in the order of their components; equal rows count each. With fewer
vectors than entries the codebook has as many entries as there are vectors. Labels may be null,
which count as one label. Other columns are not read. An empty table gives no rows. Components
whose distances might not fit 64 bits raise an error rather than a wrong result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.tables import prepared
from skyledger.storage import delete_path, scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256

#: Whole numbers below this in size keep the distances of 2 ** 10 components within 64 bits.
_LARGEST = 1 << 25

_STATE = "vec_id {id}, label {label}, q array<int>, codes binary, distances array<long>"


@dataclass
class Codes:
    """``rows``: vec_id, label, codes (a byte for each part) and distances; ``codebooks``: part,
    entry, position."""

    rows: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        numbers = ",".join(map(str, self.codebooks.ravel().tolist()))
        return hashlib.sha256(numbers.encode()).hexdigest()


def _whole(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """vec_id, label, q: the vectors that take part, in whole numbers."""
    part = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE))
    fits = F.forall("q", lambda x: F.abs(x) < _LARGEST)
    return (vectors.where(F.col(vector).isNotNull()).where(part)
            .select(F.col(key).alias("vec_id"), F.col(label).alias("label"), scaled.alias("q"))
            .withColumn("q", F.when(fits, F.col("q")).otherwise(
                F.raise_error(F.lit(f"a component reaches {_LARGEST / SCALE:g} in size"))))
            .withColumn("q", F.col("q").cast("array<int>")))


def _matrix(column: pa.Array, parts: int, step: int) -> np.ndarray:
    """(vectors, parts, step) of a column of lists, with zeros behind the shorter ones."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), parts * step), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out.reshape(len(sizes), parts, step)


def _distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each row of ``x`` from each entry, exactly."""
    most = max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0))
    if 4 * x.shape[1] * int(most) ** 2 < 1 << 53:
        # Every term is a whole number that a double holds, so that no digit is lost.
        a, b = x.astype(np.float64), entries.astype(np.float64)
        found = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
        return found.astype(np.int64)
    out = np.empty((len(x), len(entries)), dtype=np.int64)
    for i, entry in enumerate(entries):
        out[:, i] = ((x - entry) ** 2).sum(1)
    return out


def nearest(x: np.ndarray, entries: np.ndarray, moved: np.ndarray | None = None,
            codes: np.ndarray | None = None,
            distances: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(code, squared distance) of each row of one part; of equals the lower index.

    ``moved`` marks the entries that are elsewhere than when ``codes`` and ``distances`` were found.
    """
    if moved is None:
        found = _distances(x, entries)
        best = found.argmin(1)
        return best, found[np.arange(len(x)), best]
    codes, distances = codes.copy(), distances.copy()
    active = np.flatnonzero(moved)
    again = moved[codes]
    if again.any():
        codes[again], distances[again] = nearest(x[again], entries)
    still = np.flatnonzero(~again)
    if len(active) and len(still):
        found = _distances(x[still], entries[active])
        best = found.argmin(1)
        least, index = found[np.arange(len(still)), best], active[best]
        better = (least < distances[still]) | ((least == distances[still]) & (index < codes[still]))
        codes[still[better]], distances[still[better]] = index[better], least[better]
    return codes, distances


def _assigning(codebooks: np.ndarray, moved: np.ndarray | None):
    parts, _, step = codebooks.shape

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(2), parts, step)
            codes = np.zeros((len(x), parts), dtype=np.int64)
            distances = np.zeros((len(x), parts), dtype=np.int64)
            if moved is not None:
                codes[:] = np.frombuffer(b"".join(batch.column(3).to_pylist()),
                                         np.uint8).reshape(len(x), parts)
                distances[:] = batch.column(4).flatten().to_numpy().reshape(len(x), parts)
            for p in range(parts):
                known = () if moved is None else (moved[p], codes[:, p], distances[:, p])
                codes[:, p], distances[:, p] = nearest(x[:, p], codebooks[p], *known)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 pa.array([row.tobytes() for row in codes.astype(np.uint8)], pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(distances.ravel()))],
                names=["vec_id", "label", "q", "codes", "distances"])

    return assigned


def _summing(parts: int, entries: int, step: int):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(parts * entries, dtype=np.int64)
        sums = np.zeros((parts * entries, step), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), parts, step)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8)
            slot = (codes.reshape(len(x), parts) + np.arange(parts) * entries).ravel()
            counts += np.bincount(slot, minlength=len(counts))
            np.add.at(sums, slot, x.reshape(-1, step))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, step)), pa.array(np.tile(np.arange(step), len(used))),
             pa.array(np.repeat(counts[used], step)), pa.array(sums[used].ravel())],
            names=["slot", "position", "n", "total"])

    return summed


def _means(state: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks with each entry at the floor of the mean of its parts; unused ones stay."""
    parts, entries, step = codebooks.shape
    sums = (state.select("q", "codes")
            .mapInArrow(_summing(parts, entries, step), "slot long, position long, n long, total long")
            .groupBy("slot", "position")
            .agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"),
                 F.sum(F.col("total").cast("decimal(38,0)")).alias("total")))
    out = codebooks.copy()
    # At most a row for each component of the codebooks.
    for row in sums.collect():
        out[row.slot // entries, row.slot % entries, row.position] = int(row.total) // int(row.n)
    return out


def compressed(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
               label: str = "label", parts: int = PARTS, entries: int = ENTRIES,
               rounds: int = ROUNDS) -> Codes:
    """Codes of all vectors that take part, and the codebooks behind them."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    spark = prepared(vectors.sparkSession)
    whole = _whole(vectors, key, vector, label)
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).collect()
    width = whole.agg(F.max(F.size("q"))).first()[0] or 0
    step = max(1, -(-width // parts))
    if width > 1 << 10 and parts * step * (2 * _LARGEST) ** 2 >= 1 << 63:
        raise ValueError(f"distances of {width} components might not fit 64 bits")
    codebooks = np.zeros((parts, max(1, len(first)), step), dtype=np.int64)
    if first:
        start = _matrix(pa.array([row.q for row in first], pa.list_(pa.int32())), parts, step)
        codebooks = start.transpose(1, 0, 2).copy()

    types = {f.name: f.dataType.simpleString() for f in whole.schema.fields}
    schema = _STATE.format(id=types["vec_id"], label=types["label"])
    moved, state, path = None, whole, None
    for turn in range(rounds + 1):
        before, path = path, scratch_path(spark, "vector-codes")
        state.mapInArrow(_assigning(codebooks, moved), schema).write.parquet(path)
        state = spark.read.schema(schema).parquet(path)
        if before:
            delete_path(spark, before)
        if turn < rounds:
            after = _means(state, codebooks)
            moved, codebooks = (after != codebooks).any(2), after
    return Codes(state.select("vec_id", "label", "codes", "distances"), codebooks)


def with_errors(codes: Codes) -> DataFrame:
    """vec_id, label, codes, error (squared distances over all parts) and label_error (over all
    rows of the label)."""
    rows = codes.rows.select(
        "vec_id", "label", "codes",
        F.aggregate("distances", F.lit(0).cast("long"), lambda a, b: a + b).alias("error"))
    by_label = rows.groupBy("label").agg(
        F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    by_label = by_label.withColumnRenamed("label", "of")
    return rows.join(by_label, rows["label"].eqNullSafe(by_label["of"])).drop("of")
