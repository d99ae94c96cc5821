"""Audit of how the sources of each language diverge, in whole numbers throughout.

Terms are runs of letters A-Z, a-z and characters beyond ASCII, with only A-Z lower-cased. A
language keeps the terms that occur in at least ``MIN_DOCUMENTS`` of its documents; of V such terms
one that a group of documents has ``count`` times among N has p = 1 + floor(10^9 (count + 2) /
(N + 2 V)). Two distributions differ in a term by floor((p - q)^2 / (p + q)).

1. Texts are split once, and terms are stored for many documents of a task together, as many as have
   ``HELD_ENTRIES`` different terms in their groups, without loss to what is asked. What a group (language, source) has there are rows that hold a term once and
   have powers of two as weights, those that its count is the sum of. Which documents have a term are
   as many rows with it as documents, but no more than ``MIN_DOCUMENTS``, as so many already keep it.
   Either has no more terms than the texts have.
2. CountVectorizer with minDF and the largest integer as vocabSize finds the terms of every language
   and gives each row of a group an exact sparse vector. One fit serves all languages, since a
   term carries its language in front and so is counted among documents of its own; another language
   costs no other pass. The vocabulary goes through the driver, as always with this method: one term
   in 256, picked by hash and counted in all documents, tells how many are kept, and if there are more
   than ``VOCABULARY``, terms are dealt by hash to several vectorizers, one after the other, so that
   what the driver holds stays bounded.
3. The vectors of a group, by their weights, are summed entry by entry, only entries that occur:
   within each task, and then over tasks by blocks of ``BLOCK_ENTRIES`` entries, however large the
   group. Sums of all groups of a language are those of the language.
4. Pairs of sources are evaluated on those sparse sums. A term that neither source has adds the same
   to each pair, so that only terms of one of them or of both are visited. Terms are dealt by hash to
   slices of about ``SLICE_TERMS``, sources to blocks of ``BLOCK_SOURCES``; a task has two blocks in one
   slice and returns a partial sum for each pair.

Null texts, languages and sources are empty ones. Repeated rows are documents of their own, ids are not
read, nor are other columns. A group without kept terms has N = 0; a language without any gives pairs
of 0. Very long texts are split like others. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from skyledger.llm.tables import partitions, prepared, stored
from skyledger.llm.words import Words, slices, text_bytes

MIN_DOCUMENTS, TOP = 10, 10
VOCABULARY = 1 << 20
BLOCK_ENTRIES = 4096
#: One term in 2 ** 8 tells how many there are.
_DRAWN_BITS = 8
SLICE_TERMS, BLOCK_SOURCES = 2048, 128
#: Documents counted at once, terms of groups that a task holds, and different terms in a row of theirs.
CHUNK_BYTES, HELD_ENTRIES, ROW_TERMS = 1 << 22, 1 << 21, 1024
_COLUMNS = ["lang", "source", "weight", "terms", "found", "drawn"]

#: Bytes between terms, all ASCII but the letters; those of other characters are parts of terms.
_BETWEEN = np.arange(256) < 0x80
_BETWEEN[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def _chunks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of several batches in one, of at most ``limit`` bytes, if it holds more than one row."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "text", limit):
            if held and size + part.nbytes > limit:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += part.nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins; there is one key at least."""
    return np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))


def _lengths(firsts: np.ndarray, size: int) -> np.ndarray:
    return np.diff(firsts, append=size)


def _cut(keys: np.ndarray, most: int) -> np.ndarray:
    """Where rows begin: with each run of equal keys, and again behind ``most`` of them."""
    firsts = _firsts(keys)
    within = np.arange(len(keys)) - np.repeat(firsts, _lengths(firsts, len(keys)))
    return np.flatnonzero(within % most == 0)


def _lists(values: pa.Array, starts: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)), pa.int32()),
                                    values.cast(pa.string()))


def _no_lists(rows: int) -> pa.ListArray:
    return _lists(pa.array([], pa.string()), np.zeros(rows, dtype=np.int64))


class _Counts(NamedTuple):
    """What some documents hold: terms behind their language, and for each the documents that have
    it and whether a hash picks it; groups, and the term, group and count of each entry."""
    terms: pa.Array
    documents: np.ndarray
    drawn: np.ndarray
    groups: list[tuple[str, str]]
    term: np.ndarray
    group: np.ndarray
    count: np.ndarray


def _counted(chunk: pa.RecordBatch) -> _Counts | None:
    words = Words(*text_bytes(chunk.column(2)), lower=True, between=_BETWEEN)
    if not len(words):
        return None
    inside = np.zeros(len(words.raw) + 1, dtype=np.int8)
    inside[words.starts] = 1
    inside[words.ends] -= 1
    raw = words.raw[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
    stops = np.concatenate(([0], np.cumsum(words.ends - words.starts)))
    encoded = pa.LargeStringArray.from_buffers(
        len(words), pa.py_buffer(stops.tobytes()), pa.py_buffer(raw.tobytes())).dictionary_encode()

    # Documents are numbered by group, so that those of a group or a language follow one another.
    pairs = list(zip(chunk.column(0).to_pylist(), chunk.column(1).to_pylist(), strict=True))
    groups = sorted(set(pairs))
    langs = {own: i for i, own in enumerate(sorted({lang for lang, _ in groups}))}
    number = {pair: i for i, pair in enumerate(groups)}
    group = np.array([number[pair] for pair in pairs])
    order = np.argsort(group, kind="stable")
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    group = group[order]
    lang = np.array([langs[own] for own, _ in groups])[group]

    bits = len(pairs).bit_length()
    keys = encoded.indices.to_numpy().astype(np.int64) << bits
    keys |= np.repeat(place, words.text_ends - words.text_starts)
    keys.sort()
    first = _firsts(keys)
    n = _lengths(first, len(keys))
    term, document = keys[first] >> bits, keys[first] & ((1 << bits) - 1)
    first = _firsts(term * len(langs) + lang[document])
    documents = _lengths(first, len(term))
    named = pc.binary_join_element_wise(
        pa.array(list(langs), pa.large_string()).take(pa.array(lang[document[first]])),
        encoded.dictionary.take(pa.array(term[first])), pa.scalar(" ", pa.large_string()))
    drawn = (Words(*text_bytes(encoded.dictionary), between=_BETWEEN).hashes()
             >> np.uint64(64 - _DRAWN_BITS) == 0)[term[first]]

    start = _firsts(term * len(groups) + group[document])
    return _Counts(named, documents, drawn, groups, np.searchsorted(first, start, side="right") - 1,
                   group[document[start]], np.add.reduceat(n, start))


def _together(parts: list[_Counts]) -> _Counts:
    if len(parts) == 1:
        return parts[0]
    encoded = pa.concat_arrays([part.terms for part in parts]).dictionary_encode()
    of = np.split(encoded.indices.to_numpy().astype(np.int64),
                  np.cumsum([len(part.terms) for part in parts])[:-1])
    documents = np.zeros(len(encoded.dictionary), dtype=np.int64)
    drawn = np.zeros(len(documents), dtype=bool)
    number: dict[tuple, int] = {}
    keys = []
    for part, own in zip(parts, of, strict=True):
        # A part has each of its terms once.
        documents[own] += part.documents
        drawn[own] = part.drawn
        group = np.array([number.setdefault(pair, len(number)) for pair in part.groups])[part.group]
        keys.append(own[part.term] << 32 | group)
    keys, count = np.concatenate(keys), np.concatenate([part.count for part in parts])
    order = np.argsort(keys)
    keys = keys[order]
    first = _firsts(keys)
    return _Counts(encoded.dictionary, documents, drawn, list(number), keys[first] >> 32,
                   keys[first] & ((1 << 32) - 1), np.add.reduceat(count[order], first))


def _rows(counts: _Counts, least: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_terms``, each of at most ``most`` different terms."""
    # Row i of a language stands for a document that has the terms of more than i documents.
    found = [np.flatnonzero(counts.documents > i) for i in range(max(1, least))]
    at = np.concatenate(found)
    cuts = _cut(np.repeat(np.arange(len(found)), [len(x) for x in found]), most)
    drawn = counts.drawn[at]
    few = np.concatenate(([0], np.cumsum(drawn)))[cuts]
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(len(cuts), pa.string()), pa.nulls(len(cuts), pa.string()),
         pa.nulls(len(cuts), pa.int64()), _no_lists(len(cuts)),
         _lists(counts.terms.take(pa.array(at)), cuts),
         _lists(counts.terms.take(pa.array(at[drawn])), few)], names=_COLUMNS)

    # A count is the sum of the powers of two in it; each is the weight of a row that has the term.
    order = np.argsort(counts.group, kind="stable")
    term, group, count = counts.term[order], counts.group[order], counts.count[order]
    for bit in range(int(count.max()).bit_length()):
        at = np.flatnonzero(count >> bit & 1)
        if not len(at):
            continue
        cuts = _cut(group[at], most)
        of = [counts.groups[i] for i in group[at[cuts]]]
        yield pa.RecordBatch.from_arrays(
            [*[pa.array(list(x), pa.string()) for x in zip(*of, strict=True)],
             pa.array(np.full(len(cuts), 1 << bit)),
             _lists(counts.terms.take(pa.array(term[at])), cuts),
             _no_lists(len(cuts)), _no_lists(len(cuts))], names=_COLUMNS)


def _terms(documents: DataFrame, least: int, text: str, lang: str, source: str) -> DataFrame:
    """The documents as fewer rows of terms, each behind its language and a space, which no term holds.

    lang, source, weight, terms: a group has each term as often as the weights of its rows with it say.
    found: the other rows; a term is in ``least`` of them if it is in as many documents, and in as many
    as in documents otherwise. drawn: those of them that a hash picks from all.
    """
    limit, entries, most = CHUNK_BYTES, HELD_ENTRIES, ROW_TERMS

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[_Counts] = []
        for chunk in _chunks(batches, limit):
            counts = _counted(chunk)
            if counts is not None:
                held.append(counts)
            if sum(len(part.count) for part in held) > entries:
                held = [_together(held)]
                if len(held[0].count) > entries // 2:
                    # Too many entries to hold any longer.
                    yield from _rows(held.pop(), least, most)
        if held:
            yield from _rows(_together(held), least, most)

    named = documents.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"),
                             F.coalesce(F.col(source), F.lit("")).alias("source"),
                             F.col(text).alias("text"))
    return named.mapInArrow(split, "lang string, source string, weight long, terms array<string>, "
                            "found array<string>, drawn array<string>")


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted sums of the vectors of each group in a task: a row for each block of entries, in
    which the entries that occur stand."""
    groups: dict[tuple, int] = {}
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def combined() -> tuple[np.ndarray, np.ndarray]:
        keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        sums = np.zeros(len(keys), dtype=np.int64)
        np.add.at(sums, place, np.concatenate([n for _, n in held]))
        return keys, sums

    def rows() -> pa.RecordBatch:
        keys, sums = combined()
        cuts = np.flatnonzero(np.concatenate(([True], np.diff(keys // BLOCK_ENTRIES) > 0, [True])))
        block = keys[cuts[:-1]] // BLOCK_ENTRIES
        per_group = (1 << 31) // BLOCK_ENTRIES
        group = pa.array(block // per_group)
        offsets = pa.array(cuts, pa.int32())
        return pa.RecordBatch.from_arrays(
            [*[pa.array(list(x), pa.string()).take(group) for x in zip(*groups, strict=True)],
             pa.array(block % per_group),
             pa.ListArray.from_arrays(offsets, pa.array(keys % BLOCK_ENTRIES, pa.int32())),
             pa.ListArray.from_arrays(offsets, pa.array(sums))],
            names=["lang", "source", "block", "entries", "sums"])

    for batch in batches:
        lang, source, weight, vector = batch.columns
        indices, values = vector.field("indices"), vector.field("values")
        group = np.array([groups.setdefault(pair, len(groups)) for pair in zip(
            lang.to_pylist(), source.to_pylist(), strict=True)], dtype=np.int64)
        sizes = indices.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        keys = (np.repeat(group, sizes) << 31) | indices.flatten().to_numpy()
        if len(keys):
            # Counts are whole doubles; as longs their sums stay exact beyond 2 ** 53, too.
            held.append((keys, values.flatten().to_numpy().astype(np.int64)
                         * np.repeat(weight.to_numpy(), sizes)))
        if sum(len(k) for k, _ in held) > 1 << 22:
            held = [combined()]
            if len(held[0][0]) > 1 << 21:
                # Too many entries to hold any longer.
                yield rows()
                held, groups = [], {}
    if held:
        yield rows()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries and sums over the rows of each block, which follow one another."""
    key, total = None, np.zeros(BLOCK_ENTRIES, dtype=np.int64)

    def rows() -> pa.RecordBatch:
        at = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * len(at), pa.string()), pa.array([key[1]] * len(at), pa.string()),
             pa.array(key[2] * BLOCK_ENTRIES + at), pa.array(total[at])],
            names=["lang", "source", "entry", "n"])

    for batch in batches:
        entries, sums = batch.column(3), batch.column(4)
        for i, own in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
            if own != key:
                if key is not None:
                    yield rows()
                key = own
                total[:] = 0
            total[entries[i].values.to_numpy()] += sums[i].values.to_numpy()
    if key is not None:
        yield rows()


def _vector_sums(terms: DataFrame, least: int, part: int) -> tuple[DataFrame, DataFrame]:
    """(lang, source, entry, n: exact sums of the rows' sparse vectors, entries that occur;
    entry, term: what the entries are)."""
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(least),
                            vocabSize=(1 << 31) - 1).fit(
        terms.where("weight is null").select(F.col("found").alias("terms")))
    spark = terms.sparkSession
    vectors = (model.transform(terms.where("weight > 0").select("lang", "source", "weight", "terms"))
               .select("lang", "source", "weight", F.unwrap_udt("vector").alias("vector")))
    key = ["lang", "source", "block"]
    sums = (vectors.mapInArrow(_partial_sums, "lang string, source string, block long, "
                               "entries array<int>, sums array<long>")
            .repartition(partitions(spark), *key).sortWithinPartitions(*key)
            .mapInArrow(_merged, "lang string, source string, entry long, n long"))
    names = spark.createDataFrame(
        [(i, name.rpartition(" ")[2]) for i, name in enumerate(model.vocabulary)],
        "entry long, term string")
    # Each vectorizer numbers its own entries.
    own = F.col("entry") + (part << 31)
    return sums.withColumn("entry", own), names.withColumn("entry", own)


def _vectorizers(drawn: int) -> int:
    """How many share the terms, if ``drawn`` of them were picked and are kept."""
    return max(1, -(-(drawn << _DRAWN_BITS) // VOCABULARY))


def group_sums(documents: DataFrame, least: int = MIN_DOCUMENTS, text: str = "text",
               lang: str = "lang", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """lang, source, entry, n: how often a source has each kept term that it has; and entry, term.
    An entry belongs to one language."""
    terms = stored(_terms(documents, least, text, lang, source), "divergence-terms")
    drawn = (terms.select(F.explode("drawn").alias("term"))
             .groupBy("term").count().where(F.col("count") >= least).count())
    parts = _vectorizers(drawn)
    found = [_vector_sums(terms if parts == 1 else terms.withColumns({name: F.filter(
        name, lambda term: F.pmod(F.xxhash64(term), F.lit(parts)) == part)  # noqa: B023
        for name in ("terms", "found")}), least, part) for part in range(parts)]
    return tuple(reduce(DataFrame.union, frames) for frames in zip(*found, strict=True))


def _share(count: Column | int, total: str, terms: str) -> Column:
    """p of a term, as a long; decimals hold every digit on the way."""
    count = F.lit(count) if isinstance(count, int) else count
    return F.call_function("div", F.lit(10 ** 9).cast("decimal(10,0)")
                           * (count.cast("decimal(20,0)") + 2),
                           (F.col(total).cast("decimal(20,0)")
                            + 2 * F.col(terms).cast("decimal(15,0)"))) + 1


def _difference(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _spread(total: np.ndarray, at: np.ndarray, p: np.ndarray, absent: np.ndarray,
            other: np.ndarray) -> None:
    """Adds, for each of its terms, what a source has against others that lack it."""
    keys, counts = np.unique((at.astype(np.int64) << 31) | p, return_counts=True)
    for start in range(0, len(keys), 8192):
        key, n = keys[start:start + 8192], counts[start:start + 8192]
        here, share = key >> 31, key & ((1 << 31) - 1)
        added = _far(share[:, None], other[None]) - _far(absent[here][:, None], other[None])
        np.add.at(total, here, added * n[:, None])


def slice_sums(left: tuple, right: tuple) -> np.ndarray:
    """For each source of one block and each of another, the differences over the terms of a slice
    that either has, less what a term that both lack would add.

    A block is (p of an absent term by source, place of the source, entry and p by row).
    """
    (absent_l, at_l, term_l, p_l), (absent_r, at_r, term_r, p_r) = left, right
    total = np.zeros((len(absent_l), len(absent_r)), dtype=np.int64)
    _spread(total, at_l, p_l, absent_l, absent_r)
    _spread(total.T, at_r, p_r, absent_r, absent_l)
    # Terms that both have were added on both sides, each time as if the other lacked them.
    order = np.argsort(term_r, kind="stable")
    term_r, at_r, p_r = term_r[order], at_r[order], p_r[order]
    low, high = (np.searchsorted(term_r, term_l, side=side) for side in ("left", "right"))
    ends = np.cumsum(high - low)
    begin = 0
    while begin < len(term_l):
        done = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + (1 << 20), side="right")))
        n = (high - low)[begin:stop]
        i = np.repeat(np.arange(begin, stop), n)
        j = np.repeat(low[begin:stop], n) + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        a, b, p, q = at_l[i], at_r[j], p_l[i], p_r[j]
        np.add.at(total, (a, b), _far(p, q) - _far(p, absent_r[b]) - _far(absent_l[a], q)
                  + _far(absent_l[a], absent_r[b]))
        begin = stop
    return total


def _block(rows: pa.Table, first: int, size: int) -> tuple:
    """Sources of a block in order, and the rows of its terms; those of entry -1 name sources."""
    number, p, absent, term = (rows[c].to_numpy() for c in ("number", "p", "absent", "entry"))
    low, high = np.searchsorted(number, [first, first + size])
    number, p, absent, term = (x[low:high] for x in (number, p, absent, term))
    sources, place = np.unique(number, return_inverse=True)
    of = np.zeros(len(sources), dtype=np.int64)
    of[place] = absent
    has = term >= 0
    return sources, (of, place[has], term[has], p[has])


def _pair_sums(size: int):
    """For a language, a slice of its terms and two blocks of ``size`` sources: a row a pair."""
    def summed(key: tuple, rows: pa.Table) -> pa.Table:
        lang, _, i, j = (k.as_py() for k in key)
        rows = rows.sort_by("number")
        (left, own), (right, other) = (_block(rows, b * size, size) for b in (i, j))
        total = slice_sums(own, other)
        a, b = np.nonzero(left[:, None] < right[None])
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()),
                         "a": left[a].astype(np.int64), "b": right[b].astype(np.int64),
                         "value": total[a, b]})

    return summed


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for each two sources of a language, in both orders."""
    # Every source stands in every slice, if without a term.
    present = groups.where("v > 0").select(
        "lang", "number", "blocks", "absent", F.lit(-1).cast("long").alias("entry"),
        F.lit(0).cast("long").alias("p"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    with_slice = rows.select("lang", "number", "blocks", "absent", "entry", "p", F.pmod(
        F.xxhash64("entry"), F.col("slices")).alias("slice"))
    own = F.expr(f"number div {BLOCK_SOURCES}")
    sent = with_slice.unionByName(present).withColumn("other", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("blocks") - 1))).select(
            "lang", "slice", F.least(own, "other").alias("i"), F.greatest(own, "other").alias("j"),
            "number", "absent", "entry", "p")
    sums = (sent.groupBy("lang", "slice", "i", "j")
            .applyInArrow(_pair_sums(BLOCK_SOURCES), "lang string, a long, b long, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    one = groups.select("lang", "v", F.col("number").alias("a"), F.col("source").alias("source_a"),
                        F.col("absent").alias("p0"))
    two = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("source_b"),
                        F.col("absent").alias("q0"))
    pairs = one.join(two, "lang").where("a < b").join(sums, ["lang", "a", "b"], "left")
    value = F.when(F.col("v") > 0, F.coalesce("value", F.lit(0)) + F.col("v") * _difference("p0", "q0"))
    both = F.explode(F.array(
        F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
        F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    return pairs.select("lang", F.coalesce(value, F.lit(0)).cast("long").alias("value"),
                        both.alias("x")).select("lang", "x.source", "x.item", "value")


def audited(documents: DataFrame, least: int = MIN_DOCUMENTS, top: int = TOP, text: str = "text",
            lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank: how far each other source of the language is (part
    ``pair``), and the terms in which a source exceeds its language most (part ``term``)."""
    prepared(documents.sparkSession)
    sums, terms = group_sums(documents, least, text, lang, source)
    sums = stored(sums, "divergence-sums")
    by_lang = stored(sums.groupBy("lang", "entry").agg(F.sum("n").alias("lang_n")),
                     "divergence-langs")
    langs = by_lang.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count("*").alias("v"))
    totals = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    names = documents.select(F.coalesce(F.col(lang), F.lit("")).alias("lang"),
                             F.coalesce(F.col(source), F.lit("")).alias("source")).distinct()
    in_lang = W.partitionBy("lang")
    groups = (names.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .withColumns({"total": F.coalesce("total", F.lit(0)), "v": F.coalesce("v", F.lit(0)),
                            "number": F.row_number().over(in_lang.orderBy("source")).cast("long") - 1,
                            "sources": F.count("*").over(in_lang)})
              .withColumns({"absent": F.when(F.col("v") > 0, _share(0, "total", "v")),
                            "slices": F.ceil(F.col("v") / SLICE_TERMS),
                            "blocks": F.ceil(F.col("sources") / BLOCK_SOURCES)}))
    groups = stored(groups, "divergence-groups")
    rows = sums.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), "total", "v"))

    pair = _pairs(rows, groups).withColumn("part", F.lit("pair"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.withColumn("rank", F.row_number().over(order))
    shares = by_lang.join(langs, "lang").select("entry", _share(
        F.col("lang_n"), "lang_total", "v").alias("q"))
    ahead = (rows.select("lang", "source", "entry", "p").join(shares, "entry").where("p > q")
             .withColumn("value", _difference("p", "q"))
             # Equal values stay together until their terms are there to tell them apart.
             .withColumn("rank", F.rank().over(W.partitionBy("lang", "source").orderBy(
                 F.desc("value")))).where(F.col("rank") <= top))
    term = (ahead.join(terms, "entry").select("lang", "source", F.lit("term").alias("part"),
                                              F.col("term").alias("item"), "value")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pair.select(*columns).union(term.select(*columns))
