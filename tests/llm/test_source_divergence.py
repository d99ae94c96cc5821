"""Source divergence against plain counting with Python's whole numbers."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest

from skyledger.llm import source_divergence, tables

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def session(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return tables.prepared(spark)


def plain(rows, least, top=10):
    """(lang, source, part, item, value, rank) of every row of the audit."""
    documents = [(lang or "", source or "", Counter(TERM.findall(
        re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in documents}:
        own = [d for d in documents if d[0] == lang]
        df = Counter(t for _, _, c in own for t in c)
        kept = {t for t, n in df.items() if n >= least}
        v = len(kept)

        def shares(counts, v=v, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 2) // (total + 2 * v) for t in kept}

        def far(p, q):
            return (p - q) ** 2 // (p + q)

        q = shares(sum((c for _, _, c in own), Counter()))
        sums = {s: sum((c for _, x, c in own if x == s), Counter()) for _, s, _ in own}
        ps = {s: shares(c) for s, c in sums.items()}
        for source, p in ps.items():
            pairs = [(-sum(far(p[t], ps[x][t]) for t in kept), x) for x in ps if x != source]
            terms = [(-far(p[t], q[t]), t) for t in kept if sums[source][t] and p[t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (x[0], x[1].encode()))[:most]
                out += [(lang, source, part, item, -value, rank + 1)
                        for rank, (value, item) in enumerate(ranked)]
    return sorted(out)


def corpus():
    rng = np.random.default_rng(9)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)] + ["École", "ß", "Ж日本", "UPPER"]
    rows = []
    for i in range(150):
        picked = rng.choice(len(words), 25, p=np.arange(1, 65) / 2080)
        text = " ".join(f"{words[x]}{x % 3}," for x in picked)
        rows.append((text, [None, "en", "fr", "f r"][i % 4], [None, "", "a", "b", "ü"][i % 5]))
    rows += rows[:3]
    rows += [(None, "en", "nothing"), ("", "xx", "one"), ("12 3\x00 .", "xx", None),
             ("rare terms only", "yy", "z"), ("z" * 70_000 + " UPPER upper", "en", "long")]
    return rows


SCHEMA = "text string, lang string, source string"


def audit(session, rows, **options):
    df = session.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", n int, entry string")
    return sorted(tuple(r) for r in source_divergence.audited(df.repartition(3), **options).collect())


def test_against_plain_counting(session):
    rows = corpus()
    assert audit(session, rows) == plain(rows, 10)


def test_small_blocks_slices_and_vocabularies(session, monkeypatch):
    monkeypatch.setattr(source_divergence, "BLOCK_SOURCES", 2)
    monkeypatch.setattr(source_divergence, "SLICE_TERMS", 8)
    monkeypatch.setattr(source_divergence, "_vectorizers", lambda drawn: 3)
    rows = corpus()
    assert audit(session, rows, least=3) == plain(rows, 3)


@pytest.mark.parametrize("entries", [0, 300, 1 << 20])
def test_small_chunks_and_rows_of_terms(session, monkeypatch, entries):
    monkeypatch.setattr(source_divergence, "CHUNK_BYTES", 700)
    monkeypatch.setattr(source_divergence, "HELD_ENTRIES", entries)
    monkeypatch.setattr(source_divergence, "ROW_TERMS", 3)
    rows = corpus()
    assert audit(session, rows, least=4) == plain(rows, 4)


def test_a_term_is_stored_less_often_than_texts_have_it(session, monkeypatch):
    sizes = []

    def stored(df, label):
        if label == "divergence-terms":
            lists = [f.name for f in df.schema if f.dataType.typeName() == "array"]
            sizes.append(sum(df.selectExpr(*[f"sum(size({name}))" for name in lists]).first()))
        return tables.stored(df, label)

    monkeypatch.setattr(source_divergence, "stored", stored)
    rows = [("one two two three three three " * 5 + "only" + "ab"[i % 2], "en", "ab"[i % 3 > 0])
            for i in range(400)] + [("last words", "en", "b")] * 9
    assert audit(session, rows) == plain(rows, 10)
    # A row for each power of two and ten rows for documents, of three parts of the table at most.
    assert sizes[0] < 3 * 7 * (2 * 12 + 10) < 400 * 31 / 15


def test_slices_of_terms_sum_to_all_pairs():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 3, (9, 40)) * rng.integers(0, 50, (9, 40))
    p = 1 + 10 ** 9 * (counts + 2) // (counts.sum(1, keepdims=True) + 80)
    absent = 1 + 2 * 10 ** 9 // (counts.sum(1) + 80)

    def block(low, high):
        at, term = np.nonzero(counts[low:high])
        return absent[low:high], at, term, p[low:high][at, term]

    found = source_divergence.slice_sums(block(0, 4), block(4, 9))
    for a in range(4):
        for b in range(5):
            q, other = p[4 + b], absent[4 + b]
            whole = ((p[a] - q) ** 2 // (p[a] + q)).sum()
            assert found[a, b] == whole - 40 * ((absent[a] - other) ** 2 // (absent[a] + other))


def test_no_rows_and_no_terms(session):
    assert audit(session, [(None, None, None)]) == []
    empty = session.createDataFrame([], SCHEMA)
    assert source_divergence.audited(empty).collect() == []
    assert audit(session, [(None, "en", "a"), ("one", "en", "b")]) == [
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_counts_beyond_64_bits_stay_exact(session):
    df = session.createDataFrame([(10 ** 14, 10 ** 15 + 7, 12345)], "n long, total long, v long")
    found, = df.select(source_divergence._share(df.n, "total", "v")).first()
    assert found == 1 + 10 ** 9 * (10 ** 14 + 2) // (10 ** 15 + 7 + 24690)
