"""Vector codes against plain Lloyd rounds over Python's whole numbers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from skyledger.llm import tables, vector_codes


@pytest.fixture(scope="module")
def session(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return tables.prepared(spark)


def plain(rows, parts=16, entries=64, rounds=2):
    """Codes, errors and codebooks with every entry compared in every round."""
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    step = -(-max(len(v) for _, _, v in kept) // parts)
    cut = [[(v + [0] * (step * parts))[p * step:(p + 1) * step] for p in range(parts)]
           for _, _, v in kept]
    books = [[row[p] for row in cut[:entries]] for p in range(parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry, strict=True)), e)
                   for e, entry in enumerate(books[p]))

    for turn in range(rounds + 1):
        found = [[nearest(p, row[p]) for p in range(parts)] for row in cut]
        if turn == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                own = [row[p] for row, near in zip(cut, found, strict=True) if near[p][1] == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    errors = [sum(d for d, _ in row) for row in found]
    labels = {}
    for (_, label, _), error in zip(kept, errors, strict=True):
        labels[label] = labels.get(label, 0) + error
    return sorted(((i, label, bytes(e for _, e in row), error, labels[label])
                   for (i, label, _), row, error in zip(kept, found, errors, strict=True)),
                  key=repr), books


def made(df, **options):
    codes = vector_codes.compressed(df, **options)
    rows = [(r.vec_id, r.label, bytes(r.codes), r.error, r.label_error)
            for r in vector_codes.with_errors(codes).collect()]
    return sorted(rows, key=repr), codes.codebooks.tolist()


SCHEMA = "vec_id long, embedding array<double>, label int, q int, codes string"


def table(session, rows):
    return session.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)


def test_against_plain_rounds(session):
    rng = random.Random(4)
    rows = [(i * 7 % 400, [rng.gauss(0, 0.3) for _ in range(32)],
             None if i % 5 == 0 else i % 3) for i in range(400)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(60)]
    rows += [(2000, None, 1), (2001, [float("nan")] * 32, 1), (2002, [None] + [0.1] * 31, 1),
             (2003, [float("-inf")] * 32, 1), (2004, [0.0] * 32, 2)]
    assert made(table(session, rows)) == plain(rows)
    assert made(table(session, rows), parts=4, entries=9, rounds=4) == plain(rows, 4, 9, 4)


def test_ids_widths_and_few_vectors(session):
    rows = [(3, [1.0] * 20, 1), (3, [-1.0] * 20, 1), (None, [0.5] * 5, 2), (1, [], None),
            (1, [2.0] * 33, 2), (1, [2.0] * 33, 2), (None, [0.25] * 40, 2)]
    assert made(table(session, rows)) == plain(rows)


def test_empty_and_left_out(session):
    df = table(session, [(1, [1.0], 1)])
    nulls = df.selectExpr("vec_id", "cast(null as array<double>) embedding", "label")
    for none in (df.limit(0), nulls):
        codes = vector_codes.compressed(none)
        assert vector_codes.with_errors(codes).collect() == []


def test_too_large_components(session):
    df = table(session, [(1, [1e30] * 16, 1)])
    with pytest.raises(Exception, match="reaches"):
        vector_codes.compressed(df)


def test_only_moved_entries_are_compared_again():
    rng = np.random.default_rng(2)
    x = rng.integers(-20, 20, (500, 3))
    before = rng.integers(-20, 20, (12, 3))
    codes, distances = vector_codes.nearest(x, before)
    for moving in ([], [4], [0, 3, 11], list(range(12))):
        after = before.copy()
        after[moving] = rng.integers(-20, 20, (len(moving), 3))
        moved = (after != before).any(1)
        found = vector_codes.nearest(x, after, moved, codes, distances)
        want = ((x[:, None] - after[None]) ** 2).sum(2)
        assert (found[0] == want.argmin(1)).all() and (found[1] == want.min(1)).all()


def test_large_numbers_stay_exact():
    x = np.array([[(1 << 25) - 1, -(1 << 25) + 1]] * 2)
    entries = np.array([[-(1 << 25) + 1, (1 << 25) - 1], [5, 6]])
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(row, e, strict=True)) for e in entries]
            for row in x]
    assert vector_codes._distances(x, entries).tolist() == want
