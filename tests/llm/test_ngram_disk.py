"""What the prefix-tree join keeps on disk: packed texts, short hashes, tables that go once read."""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest

from skyledger.llm import ngram_join, tables
from skyledger.llm.components import components
from skyledger.storage import matching_paths, shared_dir, shuffles_removed


@pytest.fixture(scope="module")
def session(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return tables.prepared(spark)


def test_texts_come_back_as_they_were():
    """null and empty texts go, as they have no words."""
    texts = ["one two", None, "", "drei vier\nfünf", "x" * 100, "one two"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0, 0, 1, 1, 0, 1], pa.int32()), pa.array(texts)], names=["bucket", "text"])
    packed = pa.Table.from_batches(ngram_join._packed(iter([batch, batch])))
    found = {b: ngram_join._unpacked(packed.filter(pa.compute.equal(packed["bucket"], b))["texts"])
             .to_pylist() for b in (0, 1)}
    assert found == {0: ["one two", "x" * 100] * 2, 1: ["drei vier\nfünf", "one two"] * 2}
    nothing = pa.chunked_array([], pa.binary())
    assert ngram_join._unpacked(nothing).to_pylist() == []


def test_a_hash_takes_few_bytes():
    """11 bytes of a shuffle before."""
    rng = np.random.default_rng(5)
    values = np.unique(ngram_join._offered(rng.integers(0, 1 << 64, 300_000, dtype=np.uint64)))
    marks = rng.random(len(values)) < 0.1
    raw = ngram_join._coded(values, marks)
    assert len(raw) < 4 * len(values)
    back, marked = ngram_join._decoded(raw)
    assert (back == values).all() and (marked == marks).all()
    none, marked = ngram_join._decoded(ngram_join._coded(values[:0], marks[:0]))
    assert not len(none) and not len(marked)


def test_shared_hashes_are_those_of_several_buckets_or_classes():
    """F1."""
    def offer(bucket, values, marks):
        return {"slice": 0, "bucket": bucket, "hashes": ngram_join._coded(
            np.array(values, np.uint64), np.array(marks, bool))}

    rows = pa.Table.from_pylist([offer(1, [3, 5, 9], [0, 0, 1]), offer(2, [4, 5], [0, 0]),
                                 offer(3, [7], [0])])
    found = ngram_join._shared((pa.scalar(0),), rows).to_pylist()
    assert {r["bucket"]: ngram_join._decoded(r["hashes"])[0].tolist() for r in found} \
        == {1: [5, 9], 2: [5]}


def near_copies(session):
    rng = np.random.default_rng(7)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 120)) for _ in range(6)]
    rows = [(10 * i + k, f"{text} edited {k}") for i, text in enumerate(base) for k in range(10)]
    return session.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("wave", [2, 0.25])
def test_tables_go_once_they_are_read(session, monkeypatch, wave):
    """also where blocks are cut into chunks, and pairs of chunks go in several waves."""
    monkeypatch.setattr(ngram_join, "CHUNK_SETS", 4)
    monkeypatch.setattr(ngram_join, "WAVE", wave)
    before = set(matching_paths(session, f"{shared_dir(session)}/skyledger/*"))
    found = {r.doc_id: r.component_id
             for r in ngram_join.near_duplicates(near_copies(session)).collect()}
    assert found == {doc: doc // 10 * 10 for doc in found} and len(found) == 60
    left = {path.rpartition("/")[2].rpartition("-")[0] for path, _ in set(matching_paths(
        session, f"{shared_dir(session)}/skyledger/*")) - before}
    assert not left & {"ngram-sets", "ngram-met", "ngram-members", "ngram-placed", "ngram-chunks",
                       "links"}


def test_rounds_of_components_leave_their_last_table(session):
    """F1."""
    before = set(matching_paths(session, f"{shared_dir(session)}/skyledger/*"))
    links = session.range(0, 3000, 1, 7).selectExpr("id a", "(id * 7 + 1) % 3000 b")
    assert components(links).select("component").distinct().count() < 3000
    left = set(matching_paths(session, f"{shared_dir(session)}/skyledger/*")) - before
    assert len(left) == 1


def test_a_write_leaves_no_shuffle_files(session, tmp_path):
    """F1 to F3: they stayed until the driver happened to collect its garbage."""
    manager = session.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()

    def shuffled():
        return {str(block) for block in manager.diskBlockManager().getAllBlocks().mkString(",")
                .split(",") if block.startswith("shuffle")}

    def remaining(before):
        # They are removed in the background.
        until = time.time() + 10
        while (left := shuffled() - before) and time.time() < until:
            time.sleep(0.1)
        return left

    rows, path = session.range(10_000).repartition(5, "id"), str(tmp_path / "kept")
    before = shuffled()
    with shuffles_removed(session):
        rows.write.parquet(path)
    assert not remaining(before)
    assert session.read.parquet(path).count() == 10_000
    before = shuffled()
    kept = tables.stored(rows, "kept")
    assert not remaining(before)
    assert kept.count() == 10_000
