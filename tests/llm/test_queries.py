"""The registered queries: their SQL on the small tables; recall, held-out accuracy and brute force
where SQL cannot express them; the pipeline stage by stage."""

from __future__ import annotations

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from checks.compare import connect, differences
from skyledger.llm import queries, tables
from tests.conftest import SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def session(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return tables.prepared(spark)


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries.oracles()))
def test_query_equals_sql(session, duck, name):
    assert differences(queries.queries()[name](session, SMALL), duck, queries.oracles()[name]) == ""


def test_recall_of_the_registered_search(session):
    rows = tables.table(session, MIDDLE, "embeddings", "vec_id", "embedding").collect()
    points = {r.vec_id: np.array(r.embedding) for r in rows
              if r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()
              and any(r.embedding)}
    ids, all_points = np.array(sorted(points)), np.stack([points[i] for i in sorted(points)])
    found: dict[int, list] = {}
    for r in queries.op2_ann(session, MIDDLE).collect():
        found.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for query in (i for i in points if i % 100 == 0):
        scores = np.sqrt(((all_points - points[query]) ** 2).sum(1))
        scores[ids == query] = np.inf
        want = set(ids[np.lexsort((ids, scores))[:10]].tolist())
        mine = sorted(found[query], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        by_id = dict(zip(ids.tolist(), scores.tolist(), strict=True))
        assert all(r.score == pytest.approx(by_id[r.vec_id], rel=1e-12) for r in mine)
        hits += len(want & {r.vec_id for r in mine})
        total += 10
    assert set(found) == {i for i in points if i % 100 == 0}
    assert hits >= 0.95 * total


# ---- a folder of tables with planted cases ------------------------------------------------------

TOXIC = ("nastyword", "horridly", "vilething")


def wrapped(words, width):
    return "".join(" ".join(words[i:i + width]) + "\n" for i in range(0, len(words), width))


@pytest.fixture(scope="module")
def planted(session, tmp_path_factory):
    """documents and labels: a fifth toxic, copies wrapped otherwise, repeated lines, odd texts."""
    rng = np.random.default_rng(17)
    rows, toxic, copies = [], set(), {}
    for i in range(500):
        words = [f"word{x}" for x in rng.integers(0, 900, 60)]
        if i % 5 == 0:
            toxic.add(i)
            for at in rng.choice(60, 4, replace=False):
                words[at] = TOXIC[rng.integers(3)]
        elif i % 5 == 1 and i > 100:
            of = i - 100 + 1
            copies[i] = of
            words = WORD.findall(rows[of][1])
            words[-1] = f"changed{i}"
        text = wrapped(words, 23 if i in copies else 12)
        if i % 5 == 3:
            text += "one line that many documents share here\n"
        rows.append((i, text))
    rows += [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "long " + "x" * 70_000)]
    sources = [None, "a", "b", "c"]
    table = [(i, t, "en", sources[n % 4], len(t or "")) for n, (i, t) in enumerate(rows)]
    folder = str(tmp_path_factory.mktemp("planted"))
    session.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars int") \
        .write.parquet(f"{folder}/documents.parquet")
    session.createDataFrame([(i, 1, int(i in toxic)) for i in range(500)],
                            "doc_id long, quality int, toxic int") \
        .write.parquet(f"{folder}/labels.parquet")
    return folder, dict(rows), toxic, copies


def test_toxicity_is_held_out(session, planted):
    folder, texts, toxic, _ = planted
    found = {r.doc_id: r for r in queries.op5_toxicity(session, folder).collect()}
    assert set(found) == set(texts)
    for i, r in found.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    unseen = [i for i in range(500) if found[i].held_out]
    assert len(unseen) > 60
    assert sum(found[i].predicted == (i in toxic) for i in unseen) >= 0.97 * len(unseen)
    again = {r.doc_id: r.score for r in queries.op5_toxicity(session, folder).collect()}
    assert again == {i: r.score for i, r in found.items()}


def test_pipeline_stage_by_stage(session, planted):
    folder, texts, toxic, copies = planted
    docs = session.read.parquet(f"{folder}/documents.parquet")
    columns, given = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = tables.stored(stage(session, docs, folder), name)
        assert docs.columns == columns
        given[name] = docs.collect()

    # Toxic documents go, clean ones stay as they are.
    left = {r.doc_id: r.text for r in given["toxicity"]}
    assert all(left[i] == t for i, t in texts.items() if i not in toxic)
    assert len(toxic & set(left)) <= 0.03 * len(toxic)

    # Every line against all earlier ones.
    earlier, want = [], {}
    for i in sorted(left):
        lines = re.findall(r"[^\n]*\n|[^\n]+$", left[i] or "")
        kept, words = [], 0
        for line in lines:
            own = set(WORD.findall(line))
            if not own or not any(9 * len(own & x) >= 4 * (len(own) + len(x)) for x in earlier):
                kept.append(line)
                words += bool(own)
            if own:
                earlier.append(own)
        if words or not WORD.search(left[i] or ""):
            want[i] = "".join(kept)
    found = {r.doc_id: r.text or "" for r in given["line_dedup"]}
    assert found == want
    assert all(r.n_chars == len(r.text or "") for r in given["line_dedup"])
    assert sum("many documents share" in t for t in found.values()) == 1

    # Every pair of sets of shingles.
    sets = {}
    for i, text in found.items():
        w = WORD.findall(text.lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least, order = {i: i for i in sets}, sorted(sets)
    changed = True
    links = [(i, j) for n, i in enumerate(order) for j in order[:n] if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    while changed:
        changed = False
        for i, j in links:
            low = min(least[i], least[j])
            changed |= least[i] != low or least[j] != low
            least[i] = least[j] = low
    unique = {r.doc_id: r for r in given["near_duplicates"]}
    assert len(unique) == len(given["near_duplicates"])
    assert set(unique) == {i for i in sets if least[i] == i}
    assert len(set(copies) - set(unique)) > 50

    # Sizes against targets, each source by itself.
    size = {i: len(WORD.findall(r.text or "")) for i, r in unique.items()}
    groups: dict = {}
    for i, r in unique.items():
        groups.setdefault(r.source, []).append(i)
    names = sorted((s for s in groups if s is not None)) + [s for s in groups if s is None]
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(names)}
    goal, open_, rest = {}, list(names), 1.5 * sum(size.values())
    while open_:
        share = rest / sum(weight[s] for s in open_)
        full = [s for s in open_ if share * weight[s] > 2 * sum(size[i] for i in groups[s])]
        for s in full or open_:
            goal[s] = 2 * sum(size[i] for i in groups[s]) if full else share * weight[s]
        rest -= sum(goal[s] for s in full)
        open_ = [s for s in open_ if full and s not in full]
    times: dict[int, int] = {}
    for r in given["mixing"]:
        assert r == unique[r.doc_id]
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    for s in names:
        whole = int(goal[s] // max(sum(size[i] for i in groups[s]), 1))
        counts = {times.get(i, 0) for i in groups[s]}
        assert counts <= {min(whole, 2), min(whole + 1, 2)}
        taken = sum(size[i] * times.get(i, 0) for i in groups[s])
        assert abs(taken - goal[s]) <= max(size[i] for i in groups[s]) / 2

    # Token ids against the library's; the run as a whole against its stages.
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = corpus_pipeline.run(session, folder).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == sorted(
        (r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids))
        for r in given["mixing"])
    for r in rows:
        assert list(r.ids) == library.encode(
            unique[r.doc_id].text or "", add_special_tokens=False).ids
