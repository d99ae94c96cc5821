"""SimHash near-duplicates through vantage-point trees.

A fingerprint has 64 bits: bit b is 1 if more than half of the hashes of a text's shingles have it.
A shingle are three consecutive words, lower-cased (A-Z) and joined by one space, hashed by XXH64
with seed 42; repeated ones count each time. A shorter text is one shingle, one without words has
the fingerprint zero. Fingerprints link if they differ in 2 bits or fewer.

1. Texts become fingerprints in the tasks that read them, and equal ones become one.
2. A vantage-point tree is grown on a sample of them (``SAMPLE`` for each shard and at most
   ``MOST_SAMPLED`` altogether): a node takes the vantage point and the radius that halve its part
   best, with few fingerprints close to the border. It grows until a leaf, a shard, stands for
   about ``SHARD`` fingerprints, so that the number of shards follows that of fingerprints.
3. Every fingerprint goes down the tree to its home. By the triangle inequality, one within the
   border's distance of a radius can link to one on the other side: it goes there as a guest, too,
   from one of the two sides, so that each pair meets in exactly one shard.
4. A shard goes on in the same way by itself, down to leaves of ``LEAF`` fingerprints that are
   compared with each other and with their guests. It returns for each fingerprint with a link the
   least one of its component in the shard, a row each however many pairs there are.
5. Connected components of these rows put the shards together.

The share of guests grows with the depth of the tree, by some 40 % a level, as random fingerprints
differ from any point in about as many bits; a guest is 13 bytes.

Null texts count as empty. Rows may repeat ids or have none: a component's id is the least id in it,
null only if none of its rows has one. Very long texts are hashed in pieces. Other columns are not
read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.components import components
from skyledger.llm.tables import prepared, stored
from skyledger.llm.words import Words, slices, text_bytes

WORDS, SEED, DISTANCE = 3, 42, 2
SHARD, SAMPLE, MOST_SAMPLED, LEAF = 1 << 14, 64, 1 << 20, 256

_U64 = np.uint64
_LANES = _U64(0x0101010101010101)


# ---- fingerprints -------------------------------------------------------------------------


def _shingles(words: Words, length: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, begins, ends, text): the words of all texts with one space between, and where each
    shingle lies in them."""
    sizes = words.ends - words.starts
    total = int(sizes.sum())
    number = np.repeat(np.arange(len(words)), sizes)
    source = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + words.starts[number]
    joined = np.full(total + len(words), 0x20, dtype=np.uint8)
    joined[np.arange(total) + number] = words.raw[source]
    ends = np.cumsum(sizes) + np.arange(len(words))
    begins = ends - sizes
    counts = words.text_ends - words.text_starts
    made = np.where(counts >= length, counts - length + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), made)
    first = words.text_starts[text] + np.arange(len(text)) - np.repeat(np.cumsum(made) - made, made)
    last = np.minimum(first + length, words.text_ends[text]) - 1
    return joined.tobytes(), begins[first], ends[last], text


def _majorities(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Of each text the bits that more than half of its hashes have; the hashes lie by text."""
    counts = np.zeros((texts, 64), dtype=np.int64)
    if len(hashes):
        # Up to 255 hashes of a text are added at once, in eight counters of a byte.
        new = np.concatenate(([True], text[1:] != text[:-1]))
        run = np.arange(len(text)) - np.maximum.accumulate(np.where(new, np.arange(len(text)), 0))
        starts = np.flatnonzero(run % 255 == 0)
        owner = text[starts]
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        for bit in range(8):
            lanes = np.add.reduceat((hashes >> _U64(bit)) & _LANES, starts)
            lanes = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
            counts[owner[first], bit::8] = np.add.reduceat(lanes, first)
    bits = 2 * counts > np.bincount(text, minlength=texts)[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(_U64).ravel()


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(*text_bytes(part.column(1)), lower=True)
            joined, begins, ends, text = _shingles(words, WORDS)
            hashed = xxhash.xxh64_intdigest
            hashes = np.fromiter((hashed(joined[a:b], SEED) for a, b in zip(
                begins.tolist(), ends.tolist(), strict=True)), _U64, len(begins))
            found = _majorities(hashes, text, part.num_rows)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))],
                                             names=["doc_id", "fingerprint"])


def fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (64 bits as a long) of every document."""
    prepared(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    return documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _fingerprints, f"doc_id {kind}, fingerprint long")


# ---- vantage-point trees ------------------------------------------------------------------


@dataclass
class Split:
    """Points within ``radius`` of ``vantage`` go inside; ``outward``: those inside that are
    close to the border are guests outside, else the other way round."""

    vantage: np.uint64
    radius: int
    outward: bool

    def sides(self, homes: np.ndarray, guests: np.ndarray, distance: int):
        """((homes, guests) inside, (homes, guests) outside), as masks over ``homes`` then
        ``guests``."""
        home, guest = (np.bitwise_count(x ^ self.vantage).astype(np.int64) for x in (homes, guests))
        inside = home <= self.radius
        near = (inside & (home > self.radius - distance) if self.outward
                else ~inside & (home <= self.radius + distance))
        below, above = guest <= self.radius + distance, guest > self.radius - distance
        nothing = np.zeros(len(homes), dtype=bool)
        return ((inside, np.concatenate((nothing if self.outward else near, below))),
                (~inside, np.concatenate((near if self.outward else nothing, above))))


def best_split(points: np.ndarray, distance: int, tries: int = 8) -> Split | None:
    """The split with the fewest points close to its border among those that leave a quarter on
    each side, or else the most even one; none if no vantage point tells the points apart."""
    best, least = None, None
    for vantage in points[np.linspace(0, len(points) - 1, min(tries, len(points))).astype(int)]:
        counts = np.bincount(np.bitwise_count(points ^ vantage), minlength=65 + distance)
        sums = np.concatenate((np.zeros(distance, np.int64), np.cumsum(counts)))
        radius = np.arange(64)
        below = sums[radius + distance]
        inner, outer = below - sums[radius], sums[radius + 2 * distance] - below
        smaller = np.minimum(below, len(points) - below)
        even = 4 * smaller >= len(points)
        # Uneven ones come after all even ones, and those that part nothing are out.
        cost = np.where(even, np.minimum(inner, outer), 3 * len(points) - smaller)
        cost[smaller == 0] = 4 * len(points)
        at = int(cost.argmin())
        if cost[at] < 4 * len(points) and (least is None or cost[at] < least):
            least, best = cost[at], Split(vantage, at, bool(inner[at] <= outer[at]))
    return best


def grown(sample: np.ndarray, leaf: int, distance: int = DISTANCE) -> list[tuple]:
    """A tree on a sample: (split, inside, outside), with numbers of nodes, or of leaves as ~number.

    It goes on down to about ``leaf`` points of the sample.
    """
    nodes: list[list] = []
    leaves = 0
    work = [(sample, None, 0)]
    while work:
        points, parent, side = work.pop()
        split = best_split(points, distance) if len(points) > leaf else None
        if split is None:
            name, leaves = ~leaves, leaves + 1
        else:
            name = len(nodes)
            nodes.append([split, 0, 0])
            inside = np.bitwise_count(points ^ split.vantage) <= split.radius
            work += [(points[inside], name, 1), (points[~inside], name, 2)]
        if parent is not None:
            nodes[parent][side] = name
    return [tuple(node) for node in nodes]


def dealt(points: np.ndarray, tree: list[tuple], distance: int = DISTANCE) -> tuple:
    """(place of the point, shard, whether it is a guest), for every shard that a point goes to."""
    none = np.zeros(0, np.int64)
    out = []
    work = [(0 if tree else -1, np.arange(len(points)), none)]
    while work:
        name, homes, guests = work.pop()
        if name < 0:
            out.append((homes, ~name, False))
            out.append((guests, ~name, True))
            continue
        split, *children = tree[name]
        both = np.concatenate((homes, guests))
        for child, (home, guest) in zip(
                children, split.sides(points[homes], points[guests], distance), strict=True):
            work.append((child, homes[home], both[guest]))
    place = np.concatenate([rows for rows, _, _ in out])
    sizes = [len(rows) for rows, _, _ in out]
    return (place, np.repeat([shard for _, shard, _ in out], sizes),
            np.repeat([guest for _, _, guest in out], sizes))


class _Forest:
    """Components of points that are joined in bulk."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if (up == x).all():
                return x
            self.parent[x] = self.parent[up]
            x = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def _compared(points: np.ndarray, homes: np.ndarray, guests: np.ndarray, distance: int,
              forest: _Forest, block: int = 512) -> None:
    """All pairs of the homes of a leaf, and of homes with guests, a block at a time."""
    both = np.concatenate((homes, guests))
    for a in range(0, len(homes), block):
        rows = homes[a:a + block]
        # Pairs of homes once: from the row on.
        for b in range(a, len(both), 4 * block):
            others = both[b:b + 4 * block]
            near = np.bitwise_count(points[rows][:, None] ^ points[others][None]) <= distance
            i, j = np.nonzero(near)
            forest.join(rows[i], others[j])


def linked(homes: np.ndarray, guests: np.ndarray, distance: int = DISTANCE,
           leaf: int = LEAF) -> np.ndarray:
    """For each home, then each guest, the place of the least one that links between homes or
    between a home and a guest lead to."""
    points = np.concatenate((homes, guests))
    forest = _Forest(len(points))
    work = [(np.arange(len(homes)), len(homes) + np.arange(len(guests)))]
    while work:
        home, guest = work.pop()
        if not len(home):
            continue
        chosen = home[::max(1, len(home) // 1024)]
        split = best_split(points[chosen], distance) if len(home) > leaf else None
        if split is None:
            _compared(points, home, guest, distance, forest)
            continue
        both = np.concatenate((home, guest))
        work += [(home[inside], both[near])
                 for inside, near in split.sides(points[home], points[guest], distance)]
    return forest.roots(np.arange(len(points)))


# ---- in Spark -----------------------------------------------------------------------------


def _dealing(tree: list[tuple]):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy().view(_U64)
            place, shard, guest = dealt(points, tree)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard.astype(np.int32)), pa.array(points[place].view(np.int64)),
                 pa.array(guest.astype(bool))], names=["shard", "fingerprint", "guest"])

    return deal


def _shard_links(shard: pa.Table) -> pa.Table:
    guest = shard["guest"].to_numpy(zero_copy_only=False).astype(bool)
    points = np.sort(shard["fingerprint"].to_numpy()[~guest]), shard["fingerprint"].to_numpy()[guest]
    root = linked(*(x.view(_U64) for x in points))
    both = np.concatenate(points)
    joined = np.flatnonzero(root != np.arange(len(both)))
    return pa.table({"a": both[joined], "b": both[root[joined]]})


def links(prints: DataFrame) -> DataFrame:
    """a, b: for distinct fingerprints, links that lead from each to all others that it reaches."""
    count = prints.count()
    shards = max(1, -(-count // SHARD))
    rate = min(1.0, SAMPLE * shards / max(count, 1), MOST_SAMPLED / max(count, 1))
    # A hash below a bound: about as many as asked for, whatever their order, the same in a rerun.
    drawn = prints.where(F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.lit(1 << 30)) < int(rate * (1 << 30)))
    sample = np.array([row[0] for row in drawn.select("fingerprint").collect()], dtype=np.int64)
    tree = grown(np.sort(sample).view(_U64), max(1, int(SHARD * rate)))
    return (prints.select("fingerprint")
            .mapInArrow(_dealing(tree), "shard int, fingerprint long, guest boolean")
            .groupBy("shard").applyInArrow(_shard_links, "a long, b long"))


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (a long), component_id: the least id that links lead to."""
    rows = stored(fingerprints(documents, key, text), "simhash")
    prints = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")),
                    "simhash-distinct")
    found = components(stored(links(prints), "simhash-links"))
    of = prints.join(found, prints["fingerprint"] == found["node"], "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component"))
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = of.join(least, "component").select("fingerprint", "component_id")
    return rows.join(ids, "fingerprint").select("doc_id", "fingerprint", "component_id")
