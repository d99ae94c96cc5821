"""Words, lines and their hashes for a whole Arrow batch of texts at once.

A word is a run of characters other than space and U+0009 to U+000D; those are single bytes in
UTF-8, so that words are cut on the raw bytes of an Arrow column without decoding it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U64 = np.uint64
_BASE = _U64(0x9E3779B97F4A7C15)
_BASE_INVERSE = _U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

#: Powers are tabled for so many bytes; longer batches are cut between texts, longer texts
#: multiply on from the end of the table.
_TABLE = 1 << 16


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=_U64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_POWERS, _INVERSES = _powers(_BASE, _TABLE), _powers(_BASE_INVERSE, _TABLE)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Each 64-bit value scrambled; another seed gives another independent value."""
    x = x + _U64((seed * 0xD1B54A32D192ED03 + 0x8CB92BA72F3D8DD7) % (1 << 64))
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and where each begins and the last ends; null is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


class Words:
    """All words of a batch of texts: byte ranges, the text of each, and 64-bit hashes.

    ``text_ends[i]`` is the number of words up to the end of text ``i``. ``between`` marks the bytes
    that stand between words, if others than space and U+0009 to U+000D.
    """

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False,
                 between: np.ndarray = _SPACE):
        self.raw = _LOWER[raw] if lower else raw
        # Comparisons are faster than a look at the table.
        inside = (raw != 0x20) & (raw - np.uint8(9) > 4) if between is _SPACE else ~between[raw]
        first = np.zeros(len(raw) + 1, dtype=bool)
        first[offsets[offsets < len(raw)]] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | first[1:-1]
        ends = inside
        ends = ends.copy()
        ends[:-1] &= ~inside[1:] | first[1:-1]
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.text_ends = np.searchsorted(self.starts, offsets[1:])
        self.text_starts = np.concatenate(([0], self.text_ends[:-1])).astype(np.int64)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, the same in every batch."""
        out = np.empty(len(self.starts), dtype=_U64)
        sizes = self.ends - self.starts
        done = 0
        while done < len(out):
            # As many words as the table of powers reaches from the first one's start.
            base = int(self.starts[done])
            stop = int(np.searchsorted(self.ends, base + _TABLE - 1, side="right"))
            if stop <= done:
                out[done] = _long_hash(self.raw[base:self.ends[done]])
                done += 1
                continue
            part = self.raw[base:self.ends[stop - 1]]
            sums = np.zeros(len(part) + 1, dtype=_U64)
            np.cumsum((part.astype(_U64) + _U64(1)) * _POWERS[:len(part)], out=sums[1:])
            begin, end = self.starts[done:stop] - base, self.ends[done:stop] - base
            out[done:stop] = (sums[end] - sums[begin]) * _INVERSES[begin]
            done = stop
        return mixed(out + sizes.astype(_U64) * _U64(0xA0761D6478BD642F), seed)


def _long_hash(raw: np.ndarray) -> np.uint64:
    """The polynomial of a word longer than the table of powers."""
    total, scale = 0, 1
    for start in range(0, len(raw), _TABLE):
        part = raw[start:start + _TABLE].astype(_U64) + _U64(1)
        total += int((part * _POWERS[:len(part)]).sum(dtype=_U64)) * scale
        scale = scale * pow(int(_BASE), _TABLE, 1 << 64) % (1 << 64)
    return _U64(total % (1 << 64))


def window_hashes(words: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``length`` consecutive word hashes that begin at each position.

    Put together from halves: a window of 2m is one of m and the one of m behind it.
    """
    if len(words) < length:
        return np.zeros(0, dtype=_U64)
    base = 0xC2B2AE3D27D4EB4F + 2 * seed
    done, size, out = 0, 1, None
    piece = words if not seed else mixed(words, seed)
    while True:
        if length & size:
            if out is None:
                out = piece
            else:
                n = len(words) - (done + size) + 1
                out = out[:n] * _U64(pow(base, size, 1 << 64)) + piece[done:done + n]
            done += size
        if done == length:
            return mixed(out[:len(words) - length + 1], seed + 1)
        n = len(words) - 2 * size + 1
        piece = piece[:n] * _U64(pow(base, size, 1 << 64)) + piece[size:size + n]
        size *= 2


def order_by(owner: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Order by owner, then by 64-bit value.

    One sort by a key of the owner and the value's high bits; if different values of an owner
    agree in those (hardly ever), a sort by both.
    """
    if not len(owner):
        return np.zeros(0, dtype=np.int64)
    bits = max(1, int(owner.max()).bit_length())
    keys = (owner.astype(_U64) << _U64(64 - bits)) | (values >> _U64(bits))
    order = np.argsort(keys)
    same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
    if (values[order[same + 1]] != values[order[same]]).any():
        return np.lexsort((values, owner))
    return order


def slices(batch: pa.RecordBatch, column: str, limit: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch cut between rows into parts of about ``limit`` bytes of text, one row at least."""
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
    start, rows = 0, batch.num_rows
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield batch.slice(start, stop - start)
        start = stop
