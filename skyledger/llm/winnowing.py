"""Document fingerprints by winnowing.

All runs of ``GRAM`` code points of a text are hashed; of every ``WINDOW`` consecutive hashes the
least is kept with its position, the rightmost of equal ones. Two texts that share a run of at
least ``GRAM + WINDOW - 1`` code points share a kept hash, and no shared kept hash comes from less
than ``GRAM`` code points. A text with fewer grams than a window keeps its least one; a text
shorter than a gram keeps the hash of the whole; an empty or null text keeps nothing.

The likeness of two fingerprints is the Jaccard index of their sets of hashes: 1 for equal ones,
empty ones included, 0 if just one is empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.tables import partitions
from skyledger.llm.words import mixed

GRAM, WINDOW = 20, 45

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
#: Grams fingerprinted at once, so that a very long text needs no more memory than this.
_CHUNK = 1 << 18


def _gram_hashes(points: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``gram`` values, put together from runs of powers of two."""
    power = lambda n: _U64(pow(_BASE, n, 1 << 64))
    piece = points.astype(_U64) + _U64(1)
    done, size, out = 0, 1, None
    while done < gram:
        if gram & size:
            n = len(points) - done - size + 1
            out = piece if out is None else out[:n] * power(size) + piece[done:done + n]
            done += size
        if done < gram:
            n = len(points) - 2 * size + 1
            piece = piece[:n] * power(size) + piece[size:size + n]
            size *= 2
    return mixed(out[:len(points) - gram + 1], gram)


def _least(hashes: np.ndarray, window: int) -> np.ndarray:
    """Position of the least hash, rightmost of equals, of each window."""
    value, at, size = hashes, np.arange(len(hashes)), 1
    while size < window:
        step = min(size, window - size)
        n = len(value) - step
        right = value[step:] <= value[:n]
        value = np.where(right, value[step:], value[:n])
        at = np.where(right, at[step:], at[:n])
        size += step
    return at


def fingerprint(text: str | None, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) that are kept of a text, in order of position."""
    points = np.frombuffer((text or "").encode("utf-32-le"), dtype="<u4")
    if not len(points):
        return np.zeros(0, _U64), np.zeros(0, np.int64)
    gram = min(gram, len(points))
    grams = len(points) - gram + 1
    window = min(window, grams)
    hashes, places = [], []
    for start in range(0, grams - window + 1, _CHUNK):
        stop = min(start + _CHUNK, grams - window + 1)
        part = _gram_hashes(points[start:stop + window + gram - 2], gram)
        at = np.unique(_least(part, window))
        hashes.append(part[at])
        places.append(at + start)
    at, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], at


def packed(kept: tuple[np.ndarray, np.ndarray]) -> str:
    """A fingerprint as text: 16 hexadecimal digits of the hash, 8 of the position, and so on."""
    out = np.empty(len(kept[0]), dtype=[("hash", ">u8"), ("position", ">u4")])
    out["hash"], out["position"] = kept
    return out.tobytes().hex()


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    x, y = np.unique(a[0]), np.unique(b[0])
    if not len(x) and not len(y):
        return 1.0
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text",
                 gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """The key and the kept (hash, position) of each text; one pass, no shuffle."""
    rows = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kind = "doc_id {}, kept array<struct<hash:long,position:int>>".format(
        rows.schema["doc_id"].dataType.simpleString())

    def run(batches):
        for batch in batches:
            kept = []
            for value in batch.column(1).to_pylist():
                hashes, at = fingerprint(value, gram, window)
                kept.append([{"hash": h, "position": p} for h, p in zip(
                    hashes.view(np.int64).tolist(), at.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.list_(pa.struct(
                    [("hash", pa.int64()), ("position", pa.int32())])))], names=["doc_id", "kept"])

    return rows.mapInArrow(run, kind)


# ---- a document beside the next one -----------------------------------------------------------

PAIRS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
         "edited_fingerprint string, near_edited double, near_next double")

#: Stands for a null id, which comes last.
_NULL_ID = -(1 << 63)
_LEAST = -(1 << 63)


def _edges(bounds: list[int]) -> list[tuple[int, int]]:
    """(down, mark) at which slots begin. An id that holds several shares of the rows is cut into as
    many slots by its marks."""
    edges = []
    for down in sorted(set(bounds)):
        shares = bounds.count(down)
        edges += [(down, _LEAST + i * ((1 << 64) // shares)) for i in range(shares)]
    return edges


def _slots(edges: list[tuple[int, int]], heads: dict[int, tuple[int, int]]):
    """slot: how many edges lie at or before a row. guest_in: the slot that sees a row as guest.

    ``edges`` has an entry per partition at most, ``heads`` the first row of each slot.
    """
    downs, marks = (np.array([e[i] for e in edges], dtype=np.int64) for i in (0, 1))
    order = sorted(heads)
    host = {heads[slot]: order[i - 1] for i, slot in enumerate(order)}
    first_downs = np.array([down for down, _ in host], dtype=np.int64)

    @F.pandas_udf("slot int, guest_in int")
    def slots(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for down, mark in parts:
            down, mark = down.to_numpy(), mark.to_numpy()
            begin, slot = (np.searchsorted(downs, down, side) for side in ("left", "right"))
            # Of the edges of one id those at or before the mark count.
            several = slot - begin > 1
            for at in np.unique(begin[several]):
                chosen = several & (begin == at)
                own = marks[at:np.searchsorted(downs, downs[at], "right")]
                slot[chosen] = at + np.searchsorted(own, mark[chosen], "right")
            guest_in = np.full(len(down), -1, dtype=np.int32)
            for i in np.flatnonzero(np.isin(down, first_downs)):
                guest_in[i] = host.get((down[i].item(), mark[i].item()), -1)
            yield pd.DataFrame({"slot": slot.astype(np.int32), "guest_in": guest_in})

    return slots


def _in_order(documents: DataFrame) -> DataFrame:
    """guest, doc_id, text: a partition per slot, its documents by descending id, then its guest.

    The guest of a slot is the first document of the next slot that has any; behind the last slot
    the first follows again. ``down`` is the complement of the id, so that ids descend. Rows of an
    id that holds several shares of the table go by a digest of their text, ``mark``, and then by
    the text, other equal ids by the text. Texts are shuffled once; an id per partition goes to the
    driver.
    """
    n = partitions(documents.sparkSession)
    rows = documents.withColumn("down", F.bitwise_not(F.coalesce("doc_id", F.lit(_NULL_ID))))
    fractions = [i / n for i in range(1, n)] or [0.5]
    bounds = rows.agg(F.percentile_approx("down", fractions, 10_000)).first()[0] or []
    edges = _edges(list(bounds)[:n - 1])
    hot = sorted({down for down, mark in edges if mark != _LEAST})
    mark = F.lit(0).cast("long")
    if hot:
        mark = F.when(F.array_contains(F.lit(hot).cast("array<bigint>"), F.col("down")),
                      F.xxhash64("text")).otherwise(mark)
    rows = rows.withColumn("mark", mark)
    heads = {r["slot"]: (r["head"]["down"], r["head"]["mark"]) for r in rows.select(
        _slots(edges, {})("down", "mark")["slot"].alias("slot"), "down", "mark").groupBy("slot")
        .agg(F.min(F.struct("down", "mark")).alias("head")).collect()}
    dealt = rows.withColumn("at", _slots(edges, heads)("down", "mark")).select(
        "doc_id", "down", "mark", "text", F.explode(F.filter(F.array(
            F.struct(F.lit(False).alias("guest"), F.col("at.slot").alias("slot")),
            F.struct(F.lit(True).alias("guest"), F.col("at.guest_in").alias("slot"))),
            lambda x: x["slot"] >= 0)).alias("place"))
    return dealt.select(F.col("place.slot").alias("slot"), F.col("place.guest").alias("guest"),
                        "doc_id", "down", "mark", "text").repartitionById(n, "slot") \
        .sortWithinPartitions("guest", "down", "mark", "text").select("guest", "doc_id", "text")


def beside_next(documents: DataFrame, key: str = "doc_id", text: str = "text",
                gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Each document's fingerprint beside that of its edited text and of the next document.

    The next document is the one with the next smaller id; the first follows on the last, a null
    id is the smallest. The edited text has its last floor(n / 2) of n code points replaced by
    the first as many of the next document. Columns: ``PAIRS``.

    Rows that repeat an id follow each other in an order that depends on their texts alone; repeated
    rows stay as often as they are there. An id, or the lack of one, that holds much of the table
    is cut into several tasks by its texts. Null texts count as empty, very long ones are hashed piece by
    piece, an empty table gives no rows, and other columns are not read. Ids must be integers.
    """
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def row(doc_id, value, kept, following, following_kept):
        n = len(value)
        edited = value[:n - n // 2] + following[:n // 2]
        edited_kept = fingerprint(edited, gram, window)
        return (doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), packed(kept),
                packed(edited_kept), likeness(kept, edited_kept), likeness(kept, following_kept))

    def run(batches):
        names = [f.split()[0] for f in PAIRS.split(", ")]
        before, over = None, False
        for batch in batches:
            out = []
            for guest, doc_id, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if over:
                    break
                value = value or ""
                kept = fingerprint(value, gram, window)
                if before is not None:
                    out.append(row(*before, value, kept))
                before, over = (doc_id, value, kept), guest
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) if c[0] is not None or names[i] != "doc_id"
                     else pa.array(c, pa.int64()) for i, c in enumerate(zip(*out, strict=True))],
                    names=names)

    return _in_order(rows).mapInArrow(run, PAIRS)
