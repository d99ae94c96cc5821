"""N-gram Jaccard join with a prefix tree: exact links and components of near-duplicate texts.

A text's set are its distinct shingles of ``SIZE`` words, A to Z lowered; with fewer words the
whole sequence is the one member, without words the set is empty and links with nothing. Two
texts link if 100 * |x & y| >= 80 * |x or y|.

1. Equal sets are one class, which has a number from here on.
2. Sets that could link meet in a block. The members of a set are dealt by hash to so many
   segments that linked sets, which differ in at most (|x| + |y|) / 9 members, agree on a segment
   that is not empty. So many depends on size; sizes double from level to level, and a set whose
   partners may be on the next level is dealt there too. If by chance too many segments are empty
   for this to be sure, the set adds its members of least hash, as in a prefix filter. The
   same count says how many segments agree at least; a set that shares fewer hashes with all
   others links with none, and goes. Hashes are compared by bucket of texts: a bucket gets those
   of its hashes back that occur elsewhere, and only then are sets sent anywhere, once each.
   Texts go to their bucket many at a time, compressed. Of a hash the first ``OFFERED_BITS`` are
   compared, sent as the differences of sorted ones; two that agree by chance in those are told
   apart when the hashes of whole sets are counted.
3. The sets of a block, in one order (frequent members first), are a prefix tree. A walk through
   it carries the overlaps so far of all sets at once, so that sets with a common beginning share
   them; a set leaves the walk where the rest of the subtree's sets cannot lift the overlap to
   what both sizes ask for. Members of one set alone only count for its size.
   Blocks are those sets of one level that shared hashes lead to.
4. A block too large for one task is cut by size into bands, and bands into chunks by hash. Rounds
   with different hashes join most of what belongs together; then pairs of chunks of one band or
   of neighbours are walked through, except where both are in one component already, so that
   nothing is missed and little is walked twice. There may be many more pairs than chunks: they go
   in waves that each send a set ``WAVE`` times on average.

A stored table that nothing reads any more is deleted at once.

Null texts are empty. Each row links by its own text, whether or not others have its id or it has
none. A component is named by its least id; only one in which no row has an id has a null name.
Empty tables give no rows. Columns beyond id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from skyledger.llm.components import components
from skyledger.llm.tables import discard, partitions, stored
from skyledger.llm.words import Words, mixed, order_by, slices, text_bytes, window_hashes

SIZE = 5
BUCKET_BYTES = 4 << 20
#: Bytes of text that a task holds to compress those of a bucket together.
PACK_BYTES = 32 << 20
#: Bits of a hash that buckets compare, and bytes of text whose hashes one task compares.
OFFERED_BITS, SLICE_BYTES = 40, 16 << 20
#: Members and sets of a block that one task walks through at most.
CHUNK_MEMBERS, CHUNK_SETS = 1 << 18, 512
ROUNDS = 2
PEELS = 3
WAVE = 2

_U64 = np.uint64


class Sets:
    """The shingle sets of some texts: members of text i are ``members[starts[i]:ends[i]]``, sorted."""

    def __init__(self, column: pa.Array):
        raw, offsets = text_bytes(column)
        words = Words(raw, offsets, lower=True)
        counts = words.text_ends - words.text_starts
        hashes = words.hashes()
        grams = window_hashes(hashes, SIZE)
        owner = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(hashes)) - words.text_starts[owner]
        whole = (counts[owner] - place >= SIZE)[:len(grams)]
        members, owner = grams[whole], owner[:len(grams)][whole]
        short = np.flatnonzero((counts > 0) & (counts < SIZE))
        if len(short):
            single = [window_hashes(hashes[words.text_starts[i]:words.text_ends[i]], int(counts[i]))[0]
                      ^ _U64(counts[i]) for i in short]
            members = np.concatenate([members, np.array(single, dtype=_U64)])
            owner = np.concatenate([owner, short])
        order = order_by(owner, members)
        members, owner = members[order], owner[order]
        new = np.ones(len(members), dtype=bool)
        new[1:] = (members[1:] != members[:-1]) | (owner[1:] != owner[:-1])
        self.members, self.owner = members[new], owner[new]
        self.sizes = np.bincount(self.owner, minlength=len(counts)).astype(np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def sums(self, seed: int) -> np.ndarray:
        """A hash of each set, whatever the order of members."""
        total = np.zeros(len(self.members) + 1, dtype=_U64)
        np.cumsum(mixed(self.members, seed), out=total[1:])
        return mixed(total[self.ends] - total[self.starts], seed + 1)

    def signatures(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
        """(text, level, hash) of the segments of the chosen texts, and needs.

        ``needs[level]`` is the number of its hashes there that a text shares at least with any
        set it links with, by text.
        """
        texts, levels, found, needs = [], [], [], {}
        level = np.zeros(len(self.sizes), dtype=np.int64)
        level[chosen] = np.ceil(np.log2(np.maximum(self.sizes[chosen], 4) / 4) - 1e-12)
        for k in np.unique(level[chosen]).tolist() if len(chosen) else []:
            own = chosen[level[chosen] == k]
            up = own[5 * self.sizes[own] > 4 * (4 << k)]
            for rows, at in ((own, k), (up, k + 1)):
                if len(rows):
                    text, hashes, need = self._segments(rows, at)
                    texts.append(text)
                    levels.append(np.full(len(text), at))
                    found.append(hashes)
                    needs[at] = np.maximum(needs[at], need) if at in needs else need
        if not texts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U64), {}
        return np.concatenate(texts), np.concatenate(levels), np.concatenate(found), needs

    def _segments(self, rows: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        top = 4 << level
        segments = top // 4
        picked = np.zeros(len(self.sizes), dtype=bool)
        picked[rows] = True
        at = np.flatnonzero(picked[self.owner])
        members, owner = self.members[at], self.owner[at]
        segment = ((mixed(members, 11) >> _U64(32)) * _U64(segments) >> _U64(32)).astype(np.int64)
        place = owner * segments + segment
        order = np.argsort(place, kind="stable")
        place, values = place[order], mixed(members, 13)[order]
        heads = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        text, segment = np.divmod(place[heads], segments)
        hashes = mixed(np.add.reduceat(values, heads) + mixed(segment.astype(_U64), 17 + level), 19)
        # Of the segments that are not empty, those without a different member agree.
        full = np.bincount(text, minlength=len(self.sizes))[rows]
        sizes = self.sizes[rows]
        agree = full - (sizes + np.minimum(sizes * 5 // 4, top)) // 9
        need = np.zeros(len(self.sizes), dtype=np.int64)
        need[rows] = np.maximum(agree, 1)
        more_texts, more = [text], [hashes]
        for row in rows[agree < 1]:
            n = int(self.sizes[row])
            prefix = n - (4 * n + 4) // 5 + 1
            more_texts.append(np.full(prefix, row))
            more.append(mixed(self.members[self.starts[row]:self.starts[row] + prefix], 23 + level))
        return np.concatenate(more_texts), np.concatenate(more), need


# ---- the passes over the texts ----------------------------------------------------------------


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets = Sets(part.column(2))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), part.column(3), pa.array(sets.sizes),
                 pa.array(sets.sums(1).view(np.int64)), pa.array(sets.sums(3).view(np.int64))],
                names=["doc_id", "bucket", "tie", "n_shingles", "k1", "k2"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """bucket, texts: texts with at least one byte of one bucket, compressed, with their lengths."""
    texts: dict[int, list[bytes]] = {}
    held = 0

    def flushed() -> pa.RecordBatch:
        blobs = []
        for part in texts.values():
            sizes = np.array([len(text) for text in part], dtype=np.int64)
            head = np.array([len(part), sizes.sum()], dtype=np.int64)
            blobs.append(head.tobytes() + pa.compress(
                sizes.tobytes() + b"".join(part), codec="zstd", asbytes=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(texts), pa.int32()), pa.array(blobs, pa.binary())],
            names=["bucket", "texts"])

    for batch in batches:
        raw, offsets = text_bytes(batch.column(1))
        data, ends = raw.tobytes(), offsets.tolist()
        for bucket, start, stop in zip(batch.column(0).to_pylist(), ends, ends[1:]):
            if stop > start:
                texts.setdefault(bucket, []).append(data[start:stop])
        held += len(data)
        if held >= PACK_BYTES:
            yield flushed()
            texts, held = {}, 0
    if texts:
        yield flushed()


def _unpacked(blobs: pa.ChunkedArray) -> pa.Array:
    """The texts of a bucket."""
    sizes, data = [np.zeros(1, np.int64)], []
    for blob in blobs.to_pylist():
        count, length = np.frombuffer(blob, np.int64, 2).tolist()
        raw = pa.decompress(blob[16:], 8 * count + length, codec="zstd", asbytes=True)
        sizes.append(np.frombuffer(raw, np.int64, count))
        data.append(raw[8 * count:])
    offsets = np.cumsum(np.concatenate(sizes))
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(b"".join(data)))


def _coded(values: np.ndarray, marked: np.ndarray) -> bytes:
    """Sorted different numbers of ``OFFERED_BITS`` with a mark each, compressed."""
    steps = np.diff(values, prepend=_U64(0)).view(np.uint8).reshape(-1, 8)
    planes = steps[:, :-(-OFFERED_BITS // 8)].T.tobytes()
    return len(values).to_bytes(4, "little") + pa.compress(
        np.packbits(marked).tobytes() + planes, codec="zstd", asbytes=True)


def _decoded(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    count, width = int.from_bytes(blob[:4], "little"), -(-OFFERED_BITS // 8)
    marks = -(-count // 8)
    raw = np.frombuffer(pa.decompress(blob[4:], marks + width * count, codec="zstd"), np.uint8)
    steps = np.zeros((count, 8), dtype=np.uint8)
    steps[:, :width] = raw[marks:].reshape(width, count).T
    return (np.cumsum(steps.view(_U64).ravel(), dtype=_U64),
            np.unpackbits(raw[:marks], count=count).astype(bool))


def _offered(hashes: np.ndarray) -> np.ndarray:
    return hashes >> _U64(64 - OFFERED_BITS)


def _chosen(texts: pa.Table, classes: np.ndarray) -> tuple[Sets, np.ndarray, np.ndarray]:
    """The sets of a bucket, the texts that stand for a class, and the place of that class."""
    sets = Sets(_unpacked(texts["texts"]))
    keys = sets.sums(1).view(np.int64)
    order = np.argsort(classes, kind="stable")
    at = np.minimum(np.searchsorted(classes[order], keys), max(len(classes) - 1, 0))
    hit = np.flatnonzero((classes[order][at] == keys) & (sets.sizes > 0)) if len(classes) else \
        np.zeros(0, np.int64)
    _, first = np.unique(keys[hit], return_index=True)
    rows = hit[first]
    return sets, rows, order[at[rows]] if len(rows) else rows


def _offers(n_slices: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def offers(key: tuple, texts: pa.Table, classes: pa.Table) -> pa.Table:
        """By slice of the hashes those of a bucket, marked if more than one class here has them."""
        sets, rows, _ = _chosen(texts, classes["k1"].to_numpy())
        _, _, hashes, _ = sets.signatures(rows)
        found, counts = np.unique(_offered(hashes), return_counts=True)
        of = (found * _U64(n_slices)) >> _U64(OFFERED_BITS)
        cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(found)] if len(found) else []
        return pa.table({
            "slice": pa.array([int(of[a]) for a in cuts[:-1]], pa.int32()),
            "bucket": pa.array([key[0].as_py()] * len(cuts[:-1]), pa.int32()),
            "hashes": pa.array([_coded(found[a:b], counts[a:b] > 1)
                                for a, b in zip(cuts, cuts[1:])], pa.binary())})

    return offers


def _shared(key: tuple, offers: pa.Table) -> pa.Table:
    """bucket, hashes: those that another bucket or another class of this one has as well."""
    parts = [_decoded(blob) for blob in offers["hashes"].to_pylist()]
    found, at, counts = np.unique(np.concatenate([values for values, _ in parts]),
                                  return_inverse=True, return_counts=True)
    several = counts > 1
    several[at[np.concatenate([marked for _, marked in parts])]] = True
    buckets, shared, done = [], [], 0
    for bucket, (values, marked) in zip(offers["bucket"].to_pylist(), parts, strict=True):
        keep = several[at[done:done + len(values)]]
        done += len(values)
        if keep.any():
            buckets.append(bucket)
            shared.append(_coded(values[keep], marked[keep]))
    return pa.table({"bucket": pa.array(buckets, pa.int32()),
                     "hashes": pa.array(shared, pa.binary())})


_PARTS = pa.list_(pa.struct([("level", pa.int64()), ("need", pa.int64()),
                             ("hashes", pa.list_(pa.int64()))]))


def _candidates(key: tuple, texts: pa.Table, known: pa.Table) -> pa.Table:
    """node, n, members and parts: by level the shared hashes, if there are enough of them."""
    classes = known.filter(known["hashes"].is_null())
    sets, rows, at = _chosen(texts, classes["k1"].to_numpy())
    nodes = classes["node"].to_numpy()[at] if len(rows) else np.zeros(0, np.int64)
    shared = np.sort(np.concatenate([np.zeros(0, _U64), *(
        _decoded(blob)[0] for blob in known["hashes"].drop_null().to_pylist())]))
    text, level, hashes, needs = sets.signatures(rows)
    if len(shared):
        offered = _offered(hashes)
        keep = shared[np.minimum(np.searchsorted(shared, offered), len(shared) - 1)] == offered
    else:
        keep = np.zeros(len(hashes), dtype=bool)
    text, level, hashes = text[keep], level[keep], hashes[keep].view(np.int64)
    order = np.lexsort((level, text))
    text, level, hashes = text[order], level[order], hashes[order]
    cuts = np.flatnonzero((text[1:] != text[:-1]) | (level[1:] != level[:-1])) + 1
    parts: dict[int, list] = {}
    for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True):
        if a == b:
            continue
        need = int(needs[int(level[a])][text[a]])
        if b - a >= need:
            parts.setdefault(int(text[a]), []).append(
                {"level": int(level[a]), "need": need, "hashes": hashes[a:b].tolist()})
    kept = [(row, node) for row, node in zip(rows.tolist(), nodes, strict=True) if row in parts]
    return pa.table({
        "node": pa.array([node for _, node in kept], pa.int64()),
        "n": pa.array([sets.sizes[row] for row, _ in kept], pa.int64()),
        "members": pa.array([sets.members[sets.starts[row]:sets.ends[row]].tobytes()
                             for row, _ in kept], pa.binary()),
        "parts": pa.array([parts[row] for row, _ in kept], _PARTS)})


# ---- the prefix tree --------------------------------------------------------------------------


def linked(members: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links (i, root) that join the given sets to their components, found by a walk of their tree."""
    count = len(members)
    sizes = np.array([len(m) for m in members], dtype=np.int64)
    parent = list(range(count))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    flat = np.concatenate(members)
    values, code, df = np.unique(flat, return_inverse=True, return_counts=True)
    rank = np.full(len(values), -1, dtype=np.int64)
    common = np.flatnonzero(df > 1)
    common = common[np.argsort(-df[common], kind="stable")]
    rank[common] = np.arange(len(common))
    owner = np.repeat(np.arange(count), sizes)
    token = rank[code]
    has = np.zeros((len(common), count), dtype=np.uint8)
    has[token[token >= 0], owner[token >= 0]] = 1
    paths = []
    stops = np.cumsum(sizes)
    for a, b in zip(stops - sizes, stops, strict=True):
        path = np.sort(token[a:b])
        paths.append(path[np.searchsorted(path, 0):])
    order = sorted(range(count), key=lambda i: paths[i].astype(">i4").tobytes())
    # Depth at which the path of each set leaves that of the one before.
    shared = [0]
    for x, y in zip(order, order[1:]):
        a, b = paths[x], paths[y]
        n = min(len(a), len(b))
        differs = np.flatnonzero(a[:n] != b[:n])
        shared.append(int(differs[0]) if len(differs) else n)
    shared.append(0)
    # A node of the tree: depth, sets still in the walk, their overlaps. The root has all.
    stack = [(0, np.arange(count), np.zeros(count, dtype=np.int64))]
    for i, own in enumerate(order):
        path = paths[own]
        while stack[-1][0] > shared[i]:
            stack.pop()
        depth, alive, overlap = stack[-1]
        # Nodes at which sets to come leave this path; each is kept while its subtree lasts.
        turns, low = [], len(path) + 1
        for later in shared[i + 1:]:
            if later < low:
                low = later
                if later > depth:
                    turns.append(later)
            if low <= depth:
                break
        for stop in [*reversed(turns), None]:
            to = len(path) if stop is None else stop
            if to > depth:
                overlap = overlap + has[path[depth:to]][:, alive].sum(0, dtype=np.int64)
                depth = to
            if stop is None:
                rest, least = 0, sizes[own]
            else:
                end = i
                while end + 1 < count and shared[end + 1] >= stop:
                    end += 1
                below = order[i:end + 1]
                rest = max(len(paths[s]) for s in below) - stop
                least = min(sizes[s] for s in below)
            keep = 9 * (overlap + rest) >= 4 * (sizes[alive] + least)
            alive, overlap = alive[keep], overlap[keep]
            if stop is not None:
                stack.append((stop, alive, overlap))
        for other in alive[9 * overlap >= 4 * (sizes[alive] + sizes[own])]:
            x, y = root(int(other)), root(own)
            if x != y:
                parent[x] = y
    return [(i, root(i)) for i in range(count) if root(i) != i]


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each run of rows with one block and part; only the run at hand is held."""

    def links(nodes, members):
        if len(nodes) < 2:
            return []
        return [(nodes[i], nodes[j]) for i, j in linked(members) if nodes[i] != nodes[j]]

    key, nodes, members, seen = None, [], [], set()
    out: list[tuple[int, int]] = []
    for batch in batches:
        for *at, node, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != key:
                out += links(nodes, members)
                key, nodes, members = at, [], []
            nodes.append(node)
            members.append(np.frombuffer(raw, dtype=_U64))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])
            out = []
    out += links(nodes, members)
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])


def _walk(rows: DataFrame) -> DataFrame:
    """rows: block, part, node, members. Links a, b."""
    dealt = rows.select("block", "part", "node", "members").repartition(
        partitions(rows.sparkSession), "block", "part").sortWithinPartitions("block", "part", "node")
    return dealt.mapInArrow(_walked, "a long, b long")


def _chunk_count(n: str = "n") -> "F.Column":
    return F.greatest(F.ceil(F.sum(n) / CHUNK_MEMBERS), F.ceil(F.count("*") / CHUNK_SETS))


def _placed(sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """The sets (node, n, members) of each block, with the number of its chunks."""
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(1.25)) + 1e-9).cast("int")
    placed = sets.join(blocks, "node").withColumn("band", band)
    sizes = stored(placed.groupBy("block").agg(_chunk_count().alias("chunks")), "ngram-blocks")
    return stored(placed.join(sizes, "block"), "ngram-placed")


def _links(placed: DataFrame) -> DataFrame:
    """All links that components need, among the sets of each block; their table is discarded.

    Sizes of linked sets differ by a quarter at most, so they are in one band or in neighbours.
    """
    found = stored(_walk(placed.where("chunks = 1").withColumn("part", F.lit(0))), "ngram-links")
    if not placed.where("chunks > 1").head(1):
        discard(placed)
        return found
    large = placed.where("chunks > 1").drop("chunks")
    bands = stored(large.groupBy("block", "band").agg(_chunk_count().alias("chunks")), "ngram-bands")
    for salt in range(ROUNDS):
        part = F.xxhash64("band", F.pmod(F.xxhash64("node", F.lit(salt)), F.col("chunks")))
        found = found.union(stored(_walk(large.join(bands, ["block", "band"])
                                         .withColumn("part", part)), "ngram-links"))

    # What is still apart. A component that fills chunks of a band has some of its own, others
    # share chunks; two chunks of one component need no walk.
    so_far = stored(components(found), "ngram-components")
    apart = large.join(so_far, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    several = apart.groupBy("block").agg(
        (F.min("component") < F.max("component")).alias("several")).where("several")
    groups = apart.join(several, "block", "left_semi").groupBy("block", "band", "component").agg(
        F.count("*").alias("sets"), F.sum("n").alias("total")).withColumn(
        "whole", F.when((F.col("sets") >= CHUNK_SETS // 4)
                        | (F.col("total") >= CHUNK_MEMBERS // 4), F.col("component")))
    groups = stored(groups, "ngram-groups")
    shared = W.partitionBy("block", "band", "whole")
    dealt = groups.select("block", "band", "component", "whole", F.greatest(
        F.ceil(F.sum("total").over(shared) / CHUNK_MEMBERS),
        F.ceil(F.sum("sets").over(shared) / CHUNK_SETS)).alias("chunks"))
    chunk = F.xxhash64("block", "band", "whole", F.pmod(
        F.xxhash64("node", F.lit("chunk")), F.col("chunks")))
    chunked = stored(apart.join(dealt, ["block", "band", "component"]).select(
        "block", "band", "whole", chunk.alias("chunk"), "node", "members"), "ngram-chunks")
    discard(placed)
    names = stored(chunked.groupBy("block", "band", "whole", "chunk").agg(
        F.sum(F.octet_length("members")).alias("bytes")), "ngram-names")
    other = names.select(
        "block", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"),
        F.col("band").alias("with_band"), F.col("whole").alias("with_whole"),
        F.col("chunk").alias("with"), F.col("bytes").alias("with_bytes"))
    pairs = stored(names.join(other, ["block", "band"]).where(
        "band < with_band or chunk <= with").where(
        "whole is null or with_whole is null or whole <> with_whole").select(
        "block", "chunk", "with", F.xxhash64("chunk", "with").alias("part"),
        (F.col("bytes") + F.when(F.col("chunk") != F.col("with"), F.col("with_bytes")).otherwise(0))
        .alias("bytes")), "ngram-pairs")
    ends = pairs.select("block", "chunk", "part").union(
        pairs.where("chunk <> with").select("block", F.col("with").alias("chunk"), "part"))
    joined = so_far.select(F.col("node").alias("a"), F.col("component").alias("b"))
    sent, held = (table.agg(F.sum("bytes")).first()[0] or 0 for table in (pairs, names))
    waves = max(math.ceil(sent / (WAVE * max(held, 1))), 1)
    for wave in range(waves):
        of_wave = ends.where(F.pmod(F.xxhash64("part", F.lit("wave")), F.lit(waves)) == wave)
        joined = joined.union(stored(_walk(chunked.join(of_wave, ["block", "chunk"])), "ngram-links"))
    discard(chunked)
    return joined


def _kept(met: DataFrame, key: list[str], condition: str) -> DataFrame:
    """Those rows whose number per key (``left``) meets a condition; ``met`` is discarded."""
    kept = stored(met.withColumn("left", F.count("*").over(W.partitionBy(*key))).where(condition)
                  .drop("left"), "ngram-met")
    discard(met)
    return kept


def _grouped(documents: DataFrame, key: str, text: str, tie: Column) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, tie, n_shingles, k1, k2), and the classes of those with words (k1, k2, first,
    component): ``first`` is the least (unknown, doc_id, tie) of a class, rows without an id last."""
    spark = documents.sparkSession
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"),
                            tie.alias("tie"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = partitions(spark)
    buckets = min(max(-(-size // BUCKET_BYTES), 4 * n), (1 << 31) - 1)
    bucket = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(buckets).cast("long")).cast("int")
    bucketed = rows.select("doc_id", bucket.alias("bucket"), "text", "tie")
    keys = stored(bucketed.mapInArrow(
        _keys, "doc_id long, bucket int, tie binary, n_shingles long, k1 long, k2 long"),
        "ngram-keys")
    first = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "tie")
    # Numbers are fixed as they are written.
    classes = stored(keys.where("n_shingles > 0").groupBy("k1", "k2").agg(
        F.min(F.struct(first.alias("first"), "bucket")).alias("x")).select(
        "k1", "k2", "x.first", "x.bucket").withColumn("node", F.monotonically_increasing_id()),
        "ngram-classes")

    texts = bucketed.select("bucket", "text").mapInArrow(_packed, "bucket int, texts binary") \
        .repartition(n, "bucket").groupBy("bucket")
    offers = texts.cogroup(classes.select("bucket", "k1").groupBy("bucket")).applyInArrow(
        _offers(max(-(-size // SLICE_BYTES), 1)), "slice int, bucket int, hashes binary")
    shared = offers.groupBy("slice").applyInArrow(_shared, "bucket int, hashes binary")
    known = classes.select("bucket", "node", "k1", F.lit(None).cast("binary").alias("hashes")).union(
        shared.select("bucket", F.lit(None).cast("long"), F.lit(None).cast("long"), "hashes"))
    sets = stored(texts.cogroup(known.groupBy("bucket")).applyInArrow(
        _candidates, "node long, n long, members binary, "
        "parts array<struct<level:long,need:long,hashes:array<long>>>"), "ngram-sets")

    met = stored(sets.select("node", "n", F.explode("parts").alias("part")).select(
        "node", "n", "part.level", "part.need", F.explode("part.hashes").alias("hash")), "ngram-met")
    whole = stored(sets.select("node", "n", "members"), "ngram-members")
    discard(sets)
    for _ in range(PEELS):
        # Hashes that one set alone has left, and then sets that have too few hashes left, go.
        met = _kept(met, ["hash"], "left > 1")
        met = _kept(met, ["node", "level"], "left >= need")
    # Sets of a hash by size; between two neighbours too far apart no link leads across.
    by_size = W.partitionBy("hash").orderBy("n", "node")
    vertex = F.xxhash64("node", "level")
    chain = met.select("n", "hash", "node", vertex.alias("a")).withColumn(
        "b", F.lag("a").over(by_size)).withColumn("less", F.lag("n").over(by_size)).where(
        "5 * less >= 4 * n").select("a", "b")
    blocks = stored(met.select("node", vertex.alias("vertex")).distinct().join(
        components(chain).withColumnRenamed("node", "vertex"), "vertex").select(
        "node", F.col("component").alias("block")).distinct(), "ngram-candidates")
    discard(met)
    placed = _placed(whole, blocks)
    discard(whole)
    joined = components(_links(placed))
    return keys, classes.join(joined, "node", "left").select(
        "k1", "k2", "first", F.coalesce("component", "node").alias("component"))


def _firsts(classes: DataFrame) -> DataFrame:
    return classes.groupBy("component").agg(F.min("first").alias("first"))


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: the least id that links lead to, itself included."""
    keys, classes = _grouped(documents, key, text, F.lit(None).cast("binary"))
    classes = stored(classes, "ngram-named")
    names = _firsts(classes).select("component", F.col("first.doc_id").alias("component_id"))
    named = classes.join(names, "component").select("k1", "k2", "component_id")
    return keys.join(named, ["k1", "k2"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
        .alias("component_id"))


def one_of_each(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each component the row with the least id, of several the one whose digest is least; rows
    without an id come last. Rows without words stay, but for copies in every column."""
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    digest = F.unhex(F.sha2(F.to_json(whole), 256))
    keys, classes = _grouped(documents, key, text, digest)
    kept = _firsts(classes).select("first.tie").union(
        keys.where("n_shingles = 0").select("tie"))
    # The digest stands for the whole row, its id included.
    return documents.select(whole.alias("row"), digest.alias("tie")).dropDuplicates(["tie"]) \
        .join(kept.distinct(), "tie", "left_semi").select("row.*")
