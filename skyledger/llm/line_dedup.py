"""Line dedup by an exact set-similarity join.

The set of a line are its distinct words (runs of characters other than space and U+0009 to
U+000D, as they are). A line is removed if an earlier line, by document id and then by its place,
has a set of Jaccard similarity 0.8 or more; it is judged on the input, so that a removed line
still removes later ones. Lines without words stay.

1. Lines with equal sets are one class; only its first line can stay.
2. Words are counted in all lines, by 32 bits of a hash, and a byte that says how rare each is goes
   back to the buckets that have it. Each class orders its words by rarity; similar sets share
   one of their first n - ceil(0.8 n) + 1 words (prefix filter). Where two classes meet at a word,
   sizes must fit (length filter), so must the words left behind it (positional filter), and the
   parity bits of both sets, 128 or for few words 64, may differ in no more bits than the sets may
   in words. A class that meets no other this way is alone.
3. The other classes meet again at those words with their whole sets, and the Jaccard similarity
   decides whether one of them has an earlier match.

Sets of up to three words are similar only if equal. Texts are dealt to buckets in one shuffle that
all passes read, compressed and with a key of each line's set; a bucket sends each word and each
class once.

Null and empty texts stay as they are, null texts as empty ones. Lines end at a line feed, which
goes with a removed line. Rows that repeat an id are ordered by their text; equal rows are copies
of which the first is kept. Extra columns of the documents are carried along unread. Empty tables
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.tables import partitions
from skyledger.llm.words import Words, mixed, order_by, slices, text_bytes

BUCKET_BYTES = 8 << 20
#: Texts that a task holds to send those of one bucket together.
HELD_BYTES = 16 << 20
#: Lines of so many words at most have 64 parity bits.
FEW = 48

_U64 = np.uint64


class Breaks:
    """Where the lines of some texts begin and end, and the text and number of each."""

    def __init__(self, column: pa.Array):
        self.raw, self.offsets = raw, offsets = text_bytes(column)
        feeds = np.flatnonzero(raw == 10) + 1
        # A line begins with each text that is not empty and behind each line feed inside one.
        begins = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], feeds]))
        begins = begins[begins < len(raw)]
        self.begins, self.ends = begins, np.append(begins[1:], len(raw))[:len(begins)]
        self.text = np.searchsorted(offsets, begins, side="right") - 1
        first = np.searchsorted(self.text, np.arange(len(offsets) - 1))
        self.number = np.arange(len(begins)) - first[self.text]


class Lines(Breaks):
    """Lines of some texts and the set of words of each, sorted by hash."""

    def __init__(self, column: pa.Array):
        super().__init__(column)
        begins = self.begins
        words = Words(self.raw, self.offsets)
        owner = np.repeat(np.arange(len(begins)), np.diff(np.searchsorted(
            words.starts, np.append(begins, len(self.raw)))))
        hashes = words.hashes()
        order = order_by(owner, hashes)
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        self.members, self.owner = hashes[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(begins)).astype(np.int64)
        self.stops = np.cumsum(self.sizes)
        self.starts = self.stops - self.sizes

    def keys(self) -> np.ndarray:
        """A hash of each set, the last bit of which says whether it has more than three words."""
        total = np.zeros(len(self.members) + 1, dtype=_U64)
        np.cumsum(mixed(self.members, 1), out=total[1:])
        sums = mixed(total[self.stops] - total[self.starts], 2)
        return ((sums & ~_U64(1)) | (self.sizes > 3).astype(_U64)).view(np.int64)

    def parities(self) -> tuple[np.ndarray, np.ndarray]:
        """Bit b of a line, of 128: whether an odd number of its words has hash b. A line of few
        words has 64, which are those of 128 folded."""
        at = mixed(self.members, 5) & _U64(127)
        bit = _U64(1) << (at & _U64(63))
        out = np.zeros((2, len(self.sizes)), dtype=_U64)
        full = self.sizes > 0
        if full.any():
            for half in (0, 1):
                out[half, full] = np.bitwise_xor.reduceat(
                    np.where((at >> _U64(6)) == _U64(half), bit, _U64(0)), self.starts[full])
        few = self.sizes <= FEW
        out[0, few] ^= out[1, few]
        out[1, few] = 0
        return out[0], out[1]


#: The key of a line without words.
_EMPTY = int(((mixed(np.zeros(1, dtype=_U64), 2)) & ~_U64(1)).view(np.int64)[0])


def _flat(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _ranks(documents: pa.RecordBatch | pa.Table) -> np.ndarray:
    """Place of each row by document id, nulls first, then by tie."""
    frame = pa.table({c: documents.column(c) for c in ("doc_id", "tie")}).to_pandas()
    order = frame.sort_values(["doc_id", "tie"], na_position="first", kind="stable").index
    ranks = np.empty(len(frame), dtype=np.int64)
    ranks[order] = np.arange(len(frame))
    return ranks


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, rows: rows of one bucket as a compressed Arrow stream, with the keys of their lines."""

    def packed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks()
        buckets = whole["bucket"].to_numpy()
        order = np.argsort(buckets, kind="stable")
        whole, buckets = whole.drop_columns(["bucket"]).take(pa.array(order)), buckets[order]
        cuts = np.flatnonzero(np.concatenate(([True], buckets[1:] != buckets[:-1], [True])))
        rows = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, whole.schema,
                                   options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
                stream.write_table(whole.slice(a, b - a).combine_chunks())
            rows.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(buckets[cuts[:-1]], pa.int32()), pa.array(rows, pa.binary())],
            names=["bucket", "rows"])

    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            lines = Lines(part.column(part.schema.get_field_index("text")))
            ends = 8 * np.searchsorted(lines.text, np.arange(part.num_rows + 1))
            keys = pa.Array.from_buffers(pa.binary(), part.num_rows, [
                None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(lines.keys().tobytes())])
            held.append(part.append_column("keys", keys))
            size += len(lines.raw)
            if size >= HELD_BYTES:
                yield packed(held)
                held, size = [], 0
    if held:
        yield packed(held)


def _opened(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """The rows of a bucket; and of each line the key, the text and the number."""
    texts = pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in rows["rows"]])
    own = texts["keys"].to_pylist()
    counts = np.array([len(x) // 8 for x in own], dtype=np.int64)
    text = np.repeat(np.arange(len(own)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return texts, np.frombuffer(b"".join(own), np.int64), text, number


def _first_lines(keys: np.ndarray, text: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, lines): of each class its first line in the order of documents."""
    full = np.flatnonzero(keys != _EMPTY)
    ranked = full[np.argsort(rank[text[full]], kind="stable")]
    found, first = np.unique(keys[ranked], return_index=True)
    return found, ranked[first]


def _classes(key: tuple, rows: pa.Table) -> pa.Table:
    """Of each bucket the first line of each class."""
    texts, keys, text, number = _opened(rows)
    found, at = _first_lines(keys, text, _ranks(texts))
    owner = pa.array(text[at])
    return pa.table({"k1": found, "long": pa.array((found & 1) == 1),
                     "doc_id": texts["doc_id"].take(owner), "tie": texts["tie"].take(owner),
                     "number": number[at], "bucket": np.full(len(at), key[0].as_py(), np.int32)})


def _short(words: np.ndarray) -> np.ndarray:
    """32 bits of each word, by which words are counted. Words that share them share one count;
    any order that all lines agree on is good for the prefixes."""
    return (words >> _U64(32)).astype(np.int64)


def _by_part(lines: Lines, parts: int) -> np.ndarray:
    """A number for each word, by which words go by part and then by value."""
    words = _short(lines.members)
    return ((words % parts) << 32) | words


def _narrow(values: np.ndarray) -> tuple[bytes, bytes]:
    """16 bits of each value; and those values that need more."""
    wide = values >= 0xFFFF
    return (np.where(wide, 0xFFFF, values).astype(np.uint16).tobytes(),
            values[wide].astype(np.uint32).tobytes())


def _widened(narrow: bytes, wide: bytes) -> np.ndarray:
    values = np.frombuffer(narrow, np.uint16).astype(np.int64)
    values[values == 0xFFFF] = np.frombuffer(wide, np.uint32)
    return values


def _word_counts(parts: int):
    """A row for each part of the words that a bucket has: the steps from word to word, in units of
    the number of parts, and in how many lines they are."""
    def counted(key: tuple, rows: pa.Table) -> pa.Table:
        words, counts = np.unique(
            _by_part(Lines(_flat(_opened(rows)[0]["text"])), parts), return_counts=True)
        words, part = words & 0xFFFFFFFF, words >> 32
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(part) > 0, [True]))) if len(part) else []
        pieces = list(zip(cuts[:-1], cuts[1:], strict=True))
        steps = [_narrow(np.diff(words[a:b] // parts, prepend=0)) for a, b in pieces]
        counts = [_narrow(counts[a:b]) for a, b in pieces]
        return pa.table({
            "part": np.array([part[a] for a, _ in pieces], dtype=np.int32),
            "bucket": np.full(len(pieces), key[0].as_py(), np.int32),
            "steps": pa.array([x for x, _ in steps], pa.binary()),
            "far": pa.array([x for _, x in steps], pa.binary()),
            "counts": pa.array([x for x, _ in counts], pa.binary()),
            "many": pa.array([x for _, x in counts], pa.binary())})

    return counted


def _levels(rows: pa.Table) -> pa.Table:
    """Of one part of the words, a row back to each bucket: how frequent each of its words is, in
    quarters of a power of two; zero for words that no other line has."""
    steps, far, counts, many = (rows[c].to_pylist() for c in ("steps", "far", "counts", "many"))
    words = [np.cumsum(_widened(*x)) for x in zip(steps, far, strict=True)]
    counts = np.concatenate([_widened(*x) for x in zip(counts, many, strict=True)])
    different, place = np.unique(np.concatenate(words), return_inverse=True)
    total = np.zeros(len(different), dtype=np.int64)
    np.add.at(total, place, counts)
    level = np.minimum(4 * np.log2(np.maximum(total, 1)), 255).astype(np.uint8)[place]
    ends = np.cumsum([len(x) for x in words])
    return pa.table({"bucket": rows["bucket"], "part": rows["part"], "levels": pa.array(
        [level[end - len(x):end].tobytes() for x, end in zip(words, ends, strict=True)], pa.binary())})


def _ordered(lines: Lines, rows: np.ndarray,
             levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(line, word, position, word before) of the prefixes of the lines, rarest words first."""
    picked = np.zeros(len(lines.sizes), dtype=bool)
    picked[rows] = True
    at = np.flatnonzero(picked[lines.owner])
    members, owner, df = lines.members[at], lines.owner[at], levels[at]
    # Equal levels stay in the order of hashes, which all lines share.
    order = np.argsort((owner << 8) | df, kind="stable")
    members, owner, df = members[order], owner[order], df[order]
    n = lines.sizes[owner]
    position = np.arange(len(owner)) - np.repeat(np.cumsum(lines.sizes[rows]) - lines.sizes[rows],
                                                 lines.sizes[rows])
    prefix = (position < n - (4 * n + 4) // 5 + 1) & (df > 0)
    # Words of one line alone are no place to meet, so that the word before must not be one.
    short = _short(members)
    met = np.where((position[1:] > 0) & (df[:-1] > 0), short[:-1], 0)
    before = np.concatenate((np.zeros(min(1, len(members)), dtype=np.int64), met))
    return owner[prefix], short[prefix], position[prefix], before[prefix]


def _prefixes(parts: int):
    """The word and the size, the word before and the position, parity bits, and bucket and place of
    the class there, for each word of a prefix.

    Two lines with the same word before have met there, also if different words share their 32
    bits, as it is by those that lines meet.
    """
    def prefixes(key: tuple, rows: pa.Table, known: pa.Table) -> pa.Table:
        texts, keys, text, _ = _opened(rows)
        lines = Lines(_flat(texts["text"]))
        found, at = _first_lines(keys, text, _ranks(texts))
        picked = np.isin(found, known["k1"].drop_null().to_numpy())
        places = np.zeros(len(keys), dtype=np.int64)
        places[at] = np.arange(len(at))
        chosen = np.sort(at[picked])
        place = np.unique(_by_part(lines, parts), return_inverse=True)[1]
        pieces = sorted(zip(known["part"].to_pylist(), known["levels"].to_pylist(), strict=True),
                        key=lambda x: -1 if x[0] is None else x[0])
        levels = np.frombuffer(b"".join(x for _, x in pieces if x is not None), np.uint8)
        line, word, position, before = _ordered(lines, chosen, levels[place].astype(np.int64))
        bits, more = (x.view(np.int64)[line] for x in lines.parities())
        return pa.table({"at": (word.astype(np.int32).astype(np.int64) << 32) | lines.sizes[line],
                         "before": (before << 32).astype(np.int64) | position, "bits": bits, "more": more,
                         "line": (np.int64(key[0].as_py()) << 32) | places[line]})

    return prefixes


def _meeting(word, size, position, bits, more, before) -> np.ndarray:
    """Which rows, sorted by word and size, meet another of the same word that all filters let pass.

    Two lines with the same word before have met there. A row looks on until the lines are too long
    for it.
    """
    met = np.zeros(len(word), dtype=bool)
    left = np.arange(len(word))
    step = 0
    while True:
        step += 1
        left = left[left + step < len(word)]
        other = left + step
        near = (word[left] == word[other]) & (5 * size[left] >= 4 * size[other])
        left, other = left[near], other[near]
        if not len(left):
            return met
        both = size[left] + size[other]
        common = np.minimum(size[left] - position[left], size[other] - position[other])
        fits = 9 * common >= 4 * both
        fits &= (before[left] != before[other]) | (before[left] == 0)
        x, y = left[fits], other[fits]
        differ, beyond = bits[x] ^ bits[y], more[x] ^ more[y]
        # Of a line of few words the halves are folded, so are those of one it meets.
        folded = np.bitwise_count(differ ^ beyond).astype(np.int64)
        whole = np.bitwise_count(differ).astype(np.int64) + np.bitwise_count(beyond)
        fits = np.where(size[x] <= FEW, folded, whole) <= (size[x] + size[y]) // 9
        met[x[fits]] = True
        met[y[fits]] = True


def _by_run(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The rows, sorted by ``key``, in tables that end where a run of the key ends."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        last = batch.column(key)[-1].as_py()
        if batch.column(key)[0].as_py() == last or sum(b.num_rows for b in rest) < 50_000:
            continue
        whole = pa.Table.from_batches(rest)
        cut = int(np.searchsorted(whole[key].to_numpy(), last))
        yield whole.slice(0, cut)
        rest = whole.slice(cut).to_batches()
    if rest:
        yield pa.Table.from_batches(rest)


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def with_words() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("word", pa.array(batch.column("at").to_numpy() >> 32))

    for run in _by_run(with_words(), "word"):
        at, before = (run[c].to_numpy() for c in ("at", "before"))
        bits, more = (run[c].to_numpy().view(_U64) for c in ("bits", "more"))
        met = _meeting(at >> 32, at & 0xFFFFFFFF, before & 0xFFFFFFFF, bits, more, before >> 32)
        yield from run.filter(pa.array(met)).select(["line", "word"]).to_batches()


def _whole_sets(key: tuple, rows: pa.Table, met: pa.Table) -> pa.Table:
    """word, class, members and place, for each word at which a class may have met a similar one."""
    texts, keys, text, number = _opened(rows)
    keys, at = _first_lines(keys, text, _ranks(texts))
    place, which = np.unique(met["line"].to_numpy() & 0xFFFFFFFF, return_inverse=True)
    at, keys = at[place], keys[place]
    # Of the lines that met, a text each.
    breaks = Breaks(_flat(texts["text"]))
    sizes = breaks.ends[at] - breaks.begins[at]
    stops = np.concatenate(([0], np.cumsum(sizes)))
    raw = breaks.raw[np.repeat(breaks.begins[at] - stops[:-1], sizes) + np.arange(stops[-1])]
    lines = Lines(pa.LargeStringArray.from_buffers(
        len(at), pa.py_buffer(stops.astype(np.int64).tobytes()), pa.py_buffer(raw.tobytes())))
    members = [lines.members[a:b].tobytes() for a, b in zip(lines.starts, lines.stops, strict=True)]
    owner = pa.array(text[at][which])
    return pa.table({
        "word": met["word"], "k1": keys[which],
        "members": pa.array([members[i] for i in which.tolist()], pa.binary()),
        "doc_id": texts["doc_id"].take(owner), "tie": texts["tie"].take(owner),
        "number": number[at][which]})


#: Sets compared with others at once.
_BLOCK = 256


def _later(order: list, members: list[np.ndarray]) -> list[bool]:
    """Which sets have a similar one that is earlier in ``order``."""
    rank = sorted(range(len(members)), key=lambda i: order[i])
    sizes = np.array([len(members[i]) for i in rank])
    values, code, df = np.unique(np.concatenate([members[i] for i in rank]),
                                 return_inverse=True, return_counts=True)
    common = np.cumsum(df > 1) - 1
    owner = np.repeat(np.arange(len(rank)), sizes)
    shared = df[code] > 1
    code, owner = common[code[shared]], owner[shared]
    width = int(common[-1]) + 1
    starts = np.searchsorted(owner, np.arange(len(rank) + 1))

    def matrix(a: int, b: int) -> np.ndarray:
        out = np.zeros((b - a, width), dtype=np.float32)
        out[owner[starts[a]:starts[b]] - a, code[starts[a]:starts[b]]] = 1
        return out

    gone = np.zeros(len(rank), dtype=bool)
    for a in range(0, len(rank), _BLOCK):
        b = min(a + _BLOCK, len(rank))
        rows = matrix(a, b)
        for c in range(0, b, _BLOCK):
            if gone[a:b].all():
                break
            d = min(c + _BLOCK, b)
            overlap = rows @ matrix(c, d).T
            similar = 9 * overlap >= 4 * (sizes[a:b, None] + sizes[None, c:d])
            similar &= np.arange(c, d)[None] < np.arange(a, b)[:, None]
            gone[a:b] |= similar.any(1)
    out = [False] * len(rank)
    for i, late in zip(rank, gone.tolist(), strict=True):
        out[i] = late
    return out


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of which a run of rows with one word has an earlier match."""
    for table in _by_run(batches, "word"):
        words = table["word"].to_numpy()
        cuts = np.flatnonzero(np.concatenate(([True], words[1:] != words[:-1], [True])))
        keys = table["k1"].to_numpy()
        order = [(doc_id is not None, doc_id or 0, tie, number) for doc_id, tie, number in zip(
            *(table[c].to_pylist() for c in ("doc_id", "tie", "number")), strict=True)]
        members = table["members"].to_pylist()
        late = []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            # A class may come twice, by words that share their 32 bits.
            once = a + np.unique(keys[a:b], return_index=True)[1]
            if len(once) > 1:
                found = _later([order[i] for i in once],
                               [np.frombuffer(members[i], dtype=_U64) for i in once])
                late += keys[once[np.array(found)]].tolist()
        if late:
            yield pa.RecordBatch.from_arrays([pa.array(sorted(set(late)), pa.int64())], names=["k1"])


def _rewritten(key: tuple, rows: pa.Table, stay: pa.Table) -> pa.Table:
    """The rows of a bucket with the lines that stay; and lines with words before and after."""
    texts, keys, text, _ = _opened(rows)
    lines = Breaks(_flat(texts["text"]))
    full = keys != _EMPTY
    keep = ~full
    # In the order of documents, so that of equal lines the first one stays.
    found, first = _first_lines(keys, text, _ranks(texts))
    keep[first[np.isin(found, stay["k1"].to_numpy())]] = True
    edges = np.zeros(len(lines.raw) + 1, dtype=np.int64)
    np.add.at(edges, lines.begins[keep], 1)
    np.add.at(edges, lines.ends[keep], -1)
    chosen = np.cumsum(edges)[:-1] > 0
    raw = lines.raw[chosen]
    stops = np.concatenate(([0], np.cumsum(chosen)))[lines.offsets].astype(np.int64)
    count = len(lines.offsets) - 1
    left_over = pa.LargeStringArray.from_buffers(
        count, pa.py_buffer(stops.tobytes()), pa.py_buffer(raw.tobytes())).cast(pa.string())
    total = np.bincount(lines.text[full], minlength=count)
    left = np.bincount(lines.text[full & keep], minlength=count)
    out = texts.drop_columns(["keys", "tie", "text"])
    return out.append_column("text", left_over).append_column(
        "lines", pa.array(total.astype(np.int64))).append_column(
        "lines_left", pa.array(left.astype(np.int64)))


def deduplicated(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the lines that stay, and ``lines``, ``lines_left``: lines with words
    before and after. A last line feed that a removed line leaves behind stays."""
    spark = documents.sparkSession
    size = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = partitions(spark)
    # The larger a bucket, the fewer buckets send the same word; enough of them for all cores.
    buckets = min(max(-(-size // BUCKET_BYTES), 4 * spark.sparkContext.defaultParallelism),
                  (1 << 31) - 1)
    others = [c for c in documents.columns if c not in (key, text)]
    # Other columns go through under names of their own.
    rows = documents.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("bucket", F.pmod(
        F.xxhash64("doc_id", "tie"), F.lit(buckets).cast("long")).cast("int"))

    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie", "number")
    dealt = rows.mapInArrow(_dealt, "bucket int, rows binary").repartition(n, "bucket")
    narrow = dealt.groupBy("bucket")
    firsts = narrow.applyInArrow(
        _classes, "k1 long, long boolean, doc_id long, tie long, number long, bucket int") \
        .groupBy("k1").agg(F.min(F.struct(order.alias("order"), "bucket", "long")).alias("x")) \
        .select("k1", "x.bucket", "x.long")
    # A word goes out once from each bucket that has it, however frequent it is, and comes back once.
    counted = narrow.applyInArrow(
        _word_counts(n),
        "part int, bucket int, steps binary, far binary, counts binary, many binary")
    levels = counted.groupBy("part").applyInArrow(_levels, "bucket int, part int, levels binary")
    long_firsts = firsts.where("long")
    known = long_firsts.select("bucket", "k1", F.lit(None).cast("int").alias("part"),
                               F.lit(None).cast("binary").alias("levels")).union(
        levels.select("bucket", F.lit(None).cast("long").alias("k1"), "part", "levels"))
    prefixes = narrow.cogroup(known.groupBy("bucket")).applyInArrow(
        _prefixes(n), "at long, before long, bits long, more long, line long")
    # By word, and by size within a word.
    plausible = prefixes.repartition(n, F.shiftright("at", 32)).sortWithinPartitions("at").mapInArrow(
        _plausible, "line long, word long")
    met = plausible.groupBy(F.shiftright("line", 32).cast("int").alias("bucket"))
    sets = narrow.cogroup(met).applyInArrow(
        _whole_sets, "word long, k1 long, members binary, doc_id long, tie long, number long")
    late = sets.repartition(n, "word").sortWithinPartitions("word").mapInArrow(
        _verified, "k1 long").distinct()
    stay = firsts.join(late, "k1", "left_anti").select("bucket", "k1")
    schema = ", ".join(["doc_id long", *[
        f"c{i} {documents.schema[c].dataType.simpleString()}" for i, c in enumerate(others)],
        "text string", "lines long", "lines_left long"])
    done = narrow.cogroup(stay.groupBy("bucket")).applyInArrow(_rewritten, schema)
    return done.select(
        F.col("doc_id").alias(key), F.col("text").alias(text),
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(others)], "lines", "lines_left")
