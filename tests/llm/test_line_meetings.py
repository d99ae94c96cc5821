"""Which lines meet, and what goes from task to task for it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from skyledger.llm import line_dedup, tables


@pytest.fixture(scope="module")
def session(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return tables.prepared(spark)


def words(rng, count):
    return [f"w{x}" for x in rng.choice(10**9, count, replace=False)]


def bucket(texts):
    """One bucket of documents, as it is dealt."""
    count = len(texts)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(count), pa.int64()), pa.array(texts, pa.string()),
         pa.array([0] * count, pa.int64()), pa.array([0] * count, pa.int32())],
        names=["doc_id", "text", "tie", "bucket"])
    return pa.Table.from_batches(list(line_dedup._dealt(iter([batch]))))


def test_long_lines_that_share_a_word_do_not_meet():
    rng = np.random.default_rng(2)
    lines = line_dedup.Lines(pa.array([" ".join(["same", *words(rng, 149)]) for _ in range(60)]))
    same = np.zeros(60, dtype=np.int64)
    met = line_dedup._meeting(same, lines.sizes, same, *lines.parities(), same)
    # With 64 bits for each line nearly all of them did.
    assert met.sum() <= 6


def test_copies_and_word_counts_are_narrow():
    rng = np.random.default_rng(4)
    texts = [" ".join(words(rng, 300)) for _ in range(400)]
    dealt = bucket(texts)
    assert dealt.nbytes < 0.7 * sum(map(len, texts))

    class Key:
        @staticmethod
        def as_py():
            return 0

    counted = line_dedup._word_counts(8)((Key,), dealt)
    assert counted.nbytes < 6 * 300 * 400
    levels = line_dedup._levels(counted.filter(pa.array(counted["part"].to_numpy() == 3)))
    assert set(levels["levels"][0].as_py()) <= {0, 4}


def test_narrow_values_come_back():
    values = np.array([0, 5, 0xFFFE, 0xFFFF, 0x10000, 7, 0xFFFFFFFF])
    assert line_dedup._widened(*line_dedup._narrow(values)).tolist() == values.tolist()


def test_lines_of_few_and_of_more_words_meet(session):
    rng = np.random.default_rng(6)
    texts = []
    for _ in range(12):
        base = words(rng, int(rng.integers(44, 56)))
        for _ in range(5):
            line = [w for w in base if rng.random() > 0.08]
            texts.append(" ".join([*line, *words(rng, int(rng.integers(0, 6)))]))
    sets = [set(t.split()) for t in texts]
    stays = [not any(10 * len(x & y) >= 8 * len(x | y) for y in sets[:i]) for i, x in enumerate(sets)]
    assert 12 < sum(stays) < 60
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r.doc_id: r.lines_left for r in line_dedup.deduplicated(docs).collect()}
    assert [left[i] == 1 for i in range(60)] == stays
