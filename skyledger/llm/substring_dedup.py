"""Substring dedup with difference-cover anchors.

A window of ``LENGTH`` consecutive words of one text is repeated if its words also start anywhere
else, in the same text too. Every word covered by a repeated window is removed; windows are judged
on the input. Words are runs of characters other than space and U+0009 to U+000D, compared as they
are.

Whatever two positions are compared, some shift below ``PERIOD`` takes both to a position of the
cover modulo the period. Hence two equal windows share an anchor: a run of ``ANCHOR`` words that
begins at a cover position of either text. Only anchors are hashed and compared at first, about a
quarter of all positions. From each anchor that occurs twice the search extends to the windows
that hold it, whose full hashes (96 bits) decide.

Texts are dealt to buckets of a few megabytes, in one shuffle that all three passes read. A bucket
sends each hash once, however often it occurs inside, with a mark if it is more than once; a
passage that a third of all texts share is thus one row per bucket, and nothing is paired.

Null and empty texts have no words; what is kept of them is empty. Texts shorter than a window
lose nothing. Rows that repeat an id are texts of their own. Empty tables give no rows. Columns
beyond id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from skyledger.llm.tables import partitions
from skyledger.llm.words import Words, text_bytes, window_hashes

LENGTH = 35
#: Each difference modulo the period is one of two members of the cover.
PERIOD, COVER = 21, (0, 1, 6, 8, 18)
ANCHOR = LENGTH - (PERIOD - 1)
#: Bytes of text in a bucket, about.
BUCKET_BYTES = 4 << 20

_COVERED = np.isin(np.arange(PERIOD), COVER)
MAX_BUCKETS = (1 << 31) - 1


class _Texts:
    """Words of a bucket, with each word's place in its text and the words from there to its end."""

    def __init__(self, column: pa.ChunkedArray):
        texts = pa.chunked_array(column, pa.string()).cast(pa.large_string())
        raw, offsets = text_bytes(texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0))
        self.offsets = offsets
        self.words = Words(raw, offsets)
        self.counts = self.words.text_ends - self.words.text_starts
        self.place = np.arange(len(self.words)) - np.repeat(self.words.text_starts, self.counts)
        self.left = np.repeat(self.counts, self.counts) - self.place
        self.hashes = self.words.hashes()

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of all anchors."""
        hashes = window_hashes(self.hashes, ANCHOR)
        n = len(hashes)
        at = np.flatnonzero(_COVERED[self.place[:n] % PERIOD] & (self.left[:n] >= ANCHOR))
        return at, hashes[at]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions, hashes) of all windows."""
        hashes = window_hashes(self.hashes, LENGTH)
        at = np.flatnonzero(self.left[:len(hashes)] >= LENGTH)
        return at, hashes[at]


def _known(values: np.ndarray, column: pa.ChunkedArray) -> np.ndarray:
    """Which of the values are in the column."""
    wanted = np.sort(column.to_numpy().view(np.uint64))
    if not len(wanted):
        return np.zeros(len(values), dtype=bool)
    return wanted[np.minimum(np.searchsorted(wanted, values), len(wanted) - 1)] == values


def _anchor_hashes(key: tuple, texts: pa.Table) -> pa.Table:
    """hash, and bucket * 2, plus 1 if the hash occurs more than once here."""
    _, hashes = _Texts(texts["text"]).anchors()
    found, counts = np.unique(hashes, return_counts=True)
    tags = (np.int64(key[0].as_py()) << 1) | (counts > 1)
    return pa.table({"hash": found.view(np.int64), "tag": tags.astype(np.int64)})


def _window_hashes(key: tuple, texts: pa.Table, repeated: pa.Table) -> pa.Table:
    """Hashes of the windows that hold a repeated anchor, with 32 bits more of another in ``rest``.

    What differs from row to row stands side by side, so that shuffles compress the remainder.
    """
    t = _Texts(texts["text"])
    at, hashes = t.anchors()
    hits = at[_known(hashes, repeated["hash"])]
    # A window holds an anchor if it starts at most PERIOD - 1 words before it.
    near = np.zeros(len(t.words) + 1, dtype=np.int32)
    np.add.at(near, np.maximum(hits - (PERIOD - 1), 0), 1)
    np.add.at(near, hits + 1, -1)
    near = np.cumsum(near)[:-1] > 0
    at, hashes = t.windows()
    chosen = near[at]
    at, hashes = at[chosen], hashes[chosen]
    found, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    rest = np.zeros(0, np.int32)
    if len(found):
        second = window_hashes(t.hashes, LENGTH, seed=1)[at[first]]
        rest = (second >> np.uint64(32)).astype(np.uint32).view(np.int32)
    tags = (np.int64(key[0].as_py()) << 1) | (counts > 1)
    return pa.table({"tag": tags.astype(np.int64), "hash": found.view(np.int64), "rest": rest})


def _kept(key: tuple, texts: pa.Table, repeated: pa.Table) -> pa.Table:
    """doc_id, words, words removed, and the others joined by one space."""
    t = _Texts(texts["text"])
    at, hashes = t.windows()
    hits = at[_known(hashes, repeated["hash"])]
    n = len(t.words)
    covered = np.zeros(n + 1, dtype=np.int32)
    np.add.at(covered, hits, 1)
    np.add.at(covered, np.minimum(hits + LENGTH, n), -1)
    gone = np.cumsum(covered)[:-1] > 0
    kept = np.flatnonzero(~gone)
    sums = np.concatenate(([0], np.cumsum(gone)))
    removed = sums[t.words.text_ends] - sums[t.words.text_starts]
    # The sign behind each kept word that is not its text's last becomes the space.
    text_of = np.repeat(np.arange(len(t.counts)), t.counts)[kept]
    inner = kept[:-1][text_of[:-1] == text_of[1:]]
    edges = np.zeros(len(t.words.raw) + 1, dtype=np.int8)
    edges[t.words.starts[kept]] += 1
    edges[t.words.ends[kept]] -= 1
    chosen = np.cumsum(edges, dtype=np.int8)[:-1].astype(bool)
    spaces = t.words.ends[inner]
    chosen[spaces] = True
    raw = t.words.raw.copy()
    raw[spaces] = 0x20
    stops = np.concatenate(([0], np.cumsum(chosen)))[t.offsets].astype(np.int64)
    kept_texts = pa.LargeStringArray.from_buffers(
        len(t.counts), pa.py_buffer(stops.tobytes()), pa.py_buffer(raw[chosen].tobytes()))
    return pa.table({"doc_id": texts["doc_id"], "n_words": t.counts.astype(np.int64),
                     "n_removed": removed.astype(np.int64), "kept": kept_texts.cast(pa.string())})


def deduplicated(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept: the words that no repeated window covers."""
    spark = documents.sparkSession
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = partitions(spark)
    buckets = min(max(-(-size // BUCKET_BYTES), 4 * n), MAX_BUCKETS)
    bucket = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(buckets).cast("long")).cast("int")
    dealt = rows.withColumn("bucket", bucket).repartition(n, "bucket")

    def repeated(found: DataFrame, *same: str) -> DataFrame:
        """bucket and hash wherever a hash occurs in two buckets or twice in one."""
        group = W.partitionBy(*same)
        return found.withColumn("multiple", F.col("tag").bitwiseAND(F.lit(1))).withColumn(
            "places", F.count("*").over(group) + F.max("multiple").over(group)) \
            .where(F.col("places") > 1).select(
            F.shiftright(F.col("tag"), 1).cast("int").alias("bucket"), "hash")

    texts = dealt.groupBy("bucket")
    anchors = texts.applyInArrow(_anchor_hashes, "hash long, tag long")
    windows = texts.cogroup(repeated(anchors, "hash").groupBy("bucket")).applyInArrow(
        _window_hashes, "tag long, hash long, rest int")
    twice = repeated(windows, "hash", "rest")
    return texts.cogroup(twice.groupBy("bucket")).applyInArrow(
        _kept, "doc_id long, n_words long, n_removed long, kept string")
