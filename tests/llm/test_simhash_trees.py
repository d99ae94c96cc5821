"""SimHash near-duplicates against brute force: fingerprints bit by bit, links pair by pair."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from skyledger.llm import simhash_trees, tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def session(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return tables.prepared(spark)


def fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, distance=2):
    """Least place of each place's component, by comparing all pairs."""
    found = list(range(len(prints)))

    def root(i):
        while found[i] != i:
            i = found[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (int(prints[i]) ^ int(prints[j])).bit_count() <= distance:
                a, b = sorted((root(i), root(j)))
                found[b] = a
    return [root(i) for i in range(len(prints))]


def planted(n, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 64, n, dtype=np.uint64, endpoint=False)
    flips = np.uint64(1) << rng.integers(0, 64, (3, n), dtype=np.uint64)
    hub = [base[0] ^ (np.uint64(1) << np.uint64(i)) for i in range(64)]
    every = np.unique(np.concatenate([base, base ^ flips[0], base ^ flips[0] ^ flips[1] ^ flips[2],
                                      np.array(hub)]))
    return rng.permutation(every)


def test_shard_links_equal_brute_force():
    points = planted(300)
    found = simhash_trees.linked(points, points[:0], leaf=16)
    assert found.tolist() == components(points)


def test_every_pair_meets_in_one_shard():
    points = planted(300, seed=1)
    tree = simhash_trees.grown(np.sort(points[::3]), 12)
    assert len(tree) > 8
    place, shard, guest = simhash_trees.dealt(points, tree)
    assert sorted(place[~guest].tolist()) == list(range(len(points)))
    met = set()
    for number in np.unique(shard):
        home, other = (place[(shard == number) & (guest == kind)] for kind in (False, True))
        assert not set(home.tolist()) & set(other.tolist())
        for i in home.tolist():
            for j in [*home.tolist(), *other.tolist()]:
                near = (int(points[i]) ^ int(points[j])).bit_count() <= 2
                if near and i != j and (j not in home or i < j):
                    pair = (min(i, j), max(i, j))
                    assert pair not in met
                    met.add(pair)
    want = {(i, j) for j in range(len(points)) for i in range(j)
            if (int(points[i]) ^ int(points[j])).bit_count() <= 2}
    assert met == want


def test_points_that_no_vantage_tells_apart():
    assert simhash_trees.best_split(np.zeros(5, np.uint64), 2) is None
    assert simhash_trees.grown(np.zeros(0, np.uint64), 1) == []
    two = np.array([0, 7], dtype=np.uint64)
    assert simhash_trees.best_split(two, 2) is not None


def corpus():
    rng = np.random.default_rng(5)
    base = [" ".join(f"W{x}" for x in rng.integers(0, 300, 60)) for _ in range(8)]
    texts = [None, "", " \n\t", "one two", "ONE\ttwo ", "\x0bthree", "x" * 70_000, *base, base[0],
             base[0].lower(), " ".join(["again and again"] * 400), "é É ß Σ Ж", "ÀB c D e"]
    for text in base[:4]:
        words = text.split()
        words[30] = "changed"
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("shard", [4, 1 << 14])
def test_documents_against_brute_force(session, monkeypatch, shard):
    monkeypatch.setattr(simhash_trees, "SHARD", shard)
    monkeypatch.setattr(simhash_trees, "SAMPLE", 4)
    texts = corpus()
    ids = [*range(100, 100 + len(texts))]
    ids[3], ids[8], ids[12] = None, 104, None
    rows = list(zip(ids, texts, ids, strict=True))
    df = session.createDataFrame(rows + rows[5:7], "doc_id long, text string, fingerprint long")
    found = simhash_trees.near_duplicates(df).collect()
    prints = [fingerprint(t) for t in texts]
    part = components(prints)
    least = {p: min((i for i, q in zip(ids, part, strict=True) if q == p and i is not None),
                    default=None) for p in part}
    want = [(i, f, least[p]) for i, f, p in zip(ids, prints, part, strict=True)]
    want += want[5:7]
    mine = [(r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in found]
    assert sorted(mine, key=repr) == sorted(want, key=repr)
    assert prints[0] == prints[1] == 0 and prints[3] == prints[4]


def test_majority_over_many_shingles():
    rng = np.random.default_rng(6)
    hashes = rng.integers(0, 1 << 64, 3000, dtype=np.uint64, endpoint=False)
    text = np.repeat([0, 2, 3], [1, 700, 2299])
    found = simhash_trees._majorities(hashes, text, 5)
    for t in range(5):
        own = [int(h) for h in hashes[text == t]]
        assert int(found[t]) == sum(1 << b for b in range(64)
                                    if 2 * sum(h >> b & 1 for h in own) > len(own))


def test_empty_table(session):
    df = session.createDataFrame([], "doc_id long, text string")
    assert simhash_trees.near_duplicates(df).collect() == []
