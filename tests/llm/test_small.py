"""Operators on small tables: nulls, empty texts, ties, repeated rows, extra columns; brute force."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from skyledger.llm import (ann, bpe, chat, line_dedup, mixing, ngram_join, substring_dedup, tables,
                           toxicity, url_filter, winnowing)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, features string, bucket int, source string"


@pytest.fixture(scope="module")
def session(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return tables.prepared(spark)


@pytest.fixture(scope="module")
def corpus(session):
    rng = np.random.default_rng(3)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 400, 80)) for _ in range(12)]
    texts = [None, "", " \n\t ", "one two", "one two", "x" * 70_000, *base, base[0]]
    for text in base[:6]:
        words = text.split()
        words[int(rng.integers(80))] = "changed"
        texts.append(" ".join(words) + "\nshared last line of words here")
    texts.append(" ".join(["again"] * 90) + "\n" + base[3] + "\n" + base[4])
    rows = [(i, t, "f", 1, None if i % 4 == 0 else f"s{i % 3}") for i, t in enumerate(texts)]
    return session.createDataFrame(rows, DOCS)


def texts_of(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_winnowing(session, corpus):
    found = {r.doc_id: r for r in winnowing.beside_next(corpus).collect()}
    texts = texts_of(corpus)
    order = sorted(texts, reverse=True)
    for here, after in zip(order, [*order[1:], order[0]], strict=True):
        text, following = texts[here], texts[after]
        n = len(text)
        edited = text[:n - n // 2] + following[:n // 2]
        row = found[here]
        assert row.n_chars == n
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        assert (row.near_next == 1) == (found[here].fingerprint == found[after].fingerprint) \
            or len(text) < 64
    assert winnowing.beside_next(corpus.limit(0)).count() == 0


def plain_fingerprint(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    """(hash, position) by a loop over the windows."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    if not len(points):
        return set()
    gram = min(gram, len(points))
    hashes = winnowing._gram_hashes(points, gram).tolist()
    window = min(window, len(hashes))
    kept = set()
    for start in range(len(hashes) - window + 1):
        least = min(hashes[start:start + window])
        at = max(i for i in range(start, start + window) if hashes[i] == least)
        kept.add((least, at))
    return kept


def test_likeness_against_loops_over_windows(session, corpus):
    texts = texts_of(corpus.where("length(text) < 1000 or text is null"))
    order = sorted(texts, reverse=True)
    found = {r.doc_id: r for r in winnowing.beside_next(
        corpus.where("length(text) < 1000 or text is null")).collect()}

    def alike(a, b):
        x, y = ({h for h, _ in plain_fingerprint(t)} for t in (a, b))
        return len(x & y) / len(x | y) if x or y else 1.0

    for here, after in zip(order, [*order[1:], order[0]], strict=True):
        text, following = texts[here], texts[after]
        n = len(text)
        edited = text[:n - n // 2] + following[:n // 2]
        row = found[here]
        assert row.near_next == pytest.approx(alike(text, following))
        assert row.near_edited == pytest.approx(alike(text, edited))
        for printed, source in ((row.fingerprint, text), (row.edited_fingerprint, edited)):
            want = sorted(plain_fingerprint(source), key=lambda x: x[1])
            assert printed == "".join(f"{h:016x}{at:08x}" for h, at in want)


@pytest.mark.parametrize("hot", [None, 77])
def test_rows_of_one_id_are_fingerprinted_by_several_tasks(session, hot):
    rng = np.random.default_rng(21)
    rows = [(hot, " ".join(f"w{x}" for x in rng.integers(0, 99, 12))) for _ in range(600)]
    rows += [(i, f"text number {i} of some length") for i in range(60)] + [(hot, None), (5, "x"), (5, "x")]
    docs = session.createDataFrame(rows, "doc_id long, text string").repartition(5)
    session.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        parts = winnowing._in_order(docs).rdd.glom().collect()
        found = winnowing.beside_next(docs).collect()
    finally:
        session.conf.set("spark.sql.shuffle.partitions", "4")
    parts = [part for part in parts if part]
    assert max(map(len, parts)) < 200
    own = [[r for r in part if not r.guest] for part in parts]
    order = [(r.doc_id, r.text) for part in own for r in part]
    assert sorted(order, key=repr) == sorted(rows, key=repr)
    ids = [-(1 << 63) if i is None else i for i, _ in order]
    assert ids == sorted(ids, reverse=True)
    for part, following in zip(parts, [*own[1:], own[0]], strict=True):
        assert [(r.doc_id, r.text) for r in part if r.guest][0] == \
            (following[0].doc_id, following[0].text)
    want = []
    for (doc_id, text), (_, following) in zip(order, [*order[1:], order[0]], strict=True):
        text, following = text or "", following or ""
        edited = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in found], key=repr) == \
        sorted(want, key=repr)


def test_winnowing_picks_the_rightmost_least():
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("ab"), 400))
    hashes = winnowing._gram_hashes(np.frombuffer(text.encode("utf-32-le"), "<u4"), 3)
    want = {max(j for j in range(i, i + 7) if hashes[j] == hashes[i:i + 7].min())
            for i in range(len(hashes) - 6)}
    kept, at = winnowing.fingerprint(text, 3, 7)
    assert sorted(want) == at.tolist() and (kept == hashes[at]).all()


def test_ann_against_brute_force(session):
    rng = np.random.default_rng(2)
    points = rng.standard_normal((300, 16))
    points[200:290] = points[7]
    rows = [(i, p.tolist(), i) for i, p in enumerate(points)]
    rows += [(400, None, 0), (401, [0.0] * 16, 0), (402, [float("nan")] * 16, 0),
             (403, [1.0, None] + [1.0] * 14, 0), (404, [1.0], 0), (405, [float("inf")] * 16, 0)]
    df = session.createDataFrame(rows, "vec_id long, embedding array<double>, list int")
    found = ann.nearest(df, lambda i: i % 100 == 0, probes=10_000, margin=1e9).collect()
    for query in (0, 100, 200):
        distances = np.sqrt(((points - points[query]) ** 2).sum(1))
        distances[query] = np.inf
        want = np.lexsort((np.arange(300), distances))[:10].tolist()
        mine = sorted((r for r in found if r.query_id == query), key=lambda r: r.rank)
        assert [r.vec_id for r in mine] == want
        assert np.allclose([r.score for r in mine], distances[want], rtol=1e-12)
    assert {r.query_id for r in found} == {0, 100, 200}


def test_ann_searches_each_width(session):
    rng = np.random.default_rng(12)
    rows = [(i, rng.standard_normal(6 if i % 3 else 9).tolist(), "x") for i in range(120)]
    df = session.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    found = ann.nearest(df, lambda i: i % 20 == 0, probes=10_000, margin=1e9).collect()
    points = {i: np.array(v) for i, v, _ in rows}
    for query in range(0, 120, 20):
        near = sorted((float(np.sqrt(((points[query] - p) ** 2).sum())), i) for i, p in points.items()
                      if i != query and len(p) == len(points[query]))[:10]
        mine = sorted((r for r in found if r.query_id == query), key=lambda r: r.rank)
        assert [(r.rank, r.vec_id) for r in mine] == [(n, i) for n, (_, i) in enumerate(near, 1)]
    assert ann.nearest(df.limit(0), lambda i: i % 20 == 0).count() == 0


def test_chat_spans_and_rewriting():
    turns = [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\l<turn x>\n"), ("", "")]
    made = chat.render(turns)
    assert chat.read_turns(made.output) == turns and not made.rewrites
    assert [chat.unescape(made.output[a:b]) for a, b in made.texts] == [t for _, t in turns]

    def last_only(turns):
        return "".join(f"[{r}:{t if i == len(turns) - 1 else '...'}]" for i, (r, t) in enumerate(turns))

    assert chat.render([("a", "x1"), ("b", "y1")], last_only).rewrites


def test_chat_table(session):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (None, 0, None, "x"), (2, 0, "u", "")]
    df = session.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.formatted(df).collect()}
    assert chat.read_turns(found[1].output) == [("user", "hi"), ("assistant", "")]
    assert set(found) == {1, 2, None}


def test_url_precedence():
    rules = [("org", "/", "allow"), ("a.org", "/x/", "block"), ("a.org", "/x/1", "allow"),
             ("a.org", "/", "block"), ("a.org", "/", "allow")]
    trie, = url_filter.tries(rules, 1 << 20)
    assert trie.find("b.org", "/x/")[2:] == ("org/", "allow")
    assert trie.find("w.a.org", "/x/12")[2:] == ("a.org/x/1", "allow")
    assert trie.find("a.org", "/x/2")[2:] == ("a.org/x/", "block")
    assert trie.find("a.org", "/y")[2:] == ("a.org/", "block")
    assert trie.find("aorg", "/y") is None and trie.find("a.org", "") is None


def test_url_table_in_several_tries(session):
    df = session.createDataFrame(
        [(1, "http://W.Example.org/es/1?q"), (2, None), (3, "nothing"), (4, "x://example.org/en/19")],
        "page_id long, url string")
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block")]
    whole, parts = ({tuple(r) for r in url_filter.judged(df, rules, max_bytes=m).collect()}
                    for m in (1 << 20, 10))
    assert whole == parts
    assert (1, "w.example.org", "/es/1", "example.org/es/", "block") in whole
    assert (2, "", "", None, "allow") in whole


def test_bpe_equals_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = bpe.WordBpe.from_file(path), Tokenizer.from_file(path)
    rng = np.random.default_rng(5)
    texts = ["", "  ", "I'm ΑΣ İ <|endoftext|> a<|startoftext|>", "a" * 5000, "ab" * 900, "naïve 漢字 1½"]
    texts += ["".join(rng.choice(list("etaoinsh ABC'.,!é\n"), 50)) for _ in range(500)]
    for text, ids in zip(texts, own.encode_batch([*texts]), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)
    assert own.encode_batch([None])[0].tolist() == []


def test_mixing_meets_targets(session, corpus):
    sized, limits = mixing.mixed(corpus)
    rows = mixing.takes(sized, limits).collect()
    assert len(rows) == corpus.count()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert all(0 <= r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2
    total = sum(r.size for r in rows)
    assert abs(sum({r.source: r.target for r in rows}.values()) - 1.5 * total) < 1e-6
    copies = mixing.mixture(corpus)
    assert copies.columns == corpus.columns
    assert sum(len(WORD.findall(r.text or "")) for r in copies.collect()) == sum(r.taken for r in rows)


def test_substring_dedup(session, corpus):
    found = {r.doc_id: r for r in substring_dedup.deduplicated(corpus).collect()}
    words = {i: WORD.findall(t) for i, t in texts_of(corpus).items()}
    seen: dict[tuple, list] = {}
    for i, w in words.items():
        for at in range(len(w) - 34):
            seen.setdefault(tuple(w[at:at + 35]), []).append((i, at))
    gone = {(i, at + k) for places in seen.values() if len(places) > 1
            for i, at in places for k in range(35)}
    assert gone
    for i, w in words.items():
        kept = [x for at, x in enumerate(w) if (i, at) not in gone]
        assert found[i].kept == " ".join(kept) and found[i].n_removed == len(w) - len(kept)
    assert substring_dedup.deduplicated(corpus.limit(0)).count() == 0


def test_ngram_join(session, corpus):
    found = {r.doc_id: r for r in ngram_join.near_duplicates(corpus).collect()}
    sets = {}
    for i, text in texts_of(corpus).items():
        w = WORD.findall(text.lower())
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    least = {i: i for i in sets}
    for _ in sets:
        for i, x in sets.items():
            for j, y in sets.items():
                if x and y and 100 * len(x & y) >= 80 * len(x | y):
                    least[i] = min(least[i], least[j])
    assert {i: r.component_id for i, r in found.items()} == least
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(x) for i, x in sets.items()}
    assert len(set(least.values())) < len(least) - 3


def test_rows_without_an_id_or_with_a_repeated_one_link_by_their_texts(session):
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 400, 60)) for _ in range(8)]
    near = [b + " end" for b in base]
    rows = [(None, base[0], "a"), (None, base[1], "b"), (None, near[1], "c"), (1, base[2], "d"),
            (None, near[2], "e"), (7, base[3], "f"), (7, base[4], "g"), (7, base[4], "g"),
            (5, near[4], "h"), (9, base[5], "i"), (8, base[5], "j"), (2, base[6], "k"),
            (None, None, "l"), (None, "", "m"), (3, " ", "n"), (3, " ", "n"), (None, base[0], "a")]
    docs = session.createDataFrame(rows, "doc_id long, text string, kept_id string").repartition(3)
    ids = sorted(((r.doc_id, r.component_id)
                  for r in ngram_join.near_duplicates(docs).collect()), key=repr)
    assert ids == sorted([(None, None)] * 6 + [(None, 1), (1, 1), (7, 7), (7, 5), (7, 5), (5, 5),
                                               (9, 8), (8, 8), (2, 2), (3, 3), (3, 3)], key=repr)
    left = corpus_pipeline.drop_near_duplicates(session, docs, "")
    assert left.columns == docs.columns
    marks = [r.kept_id for r in left.collect()]
    assert len([m for m in marks if m in "bc"]) == 1
    assert sorted(m for m in marks if m not in "bc") == list("adfhjklmn")


def test_prefix_tree_against_all_pairs():
    rng = np.random.default_rng(0)
    for _ in range(60):
        base = rng.integers(0, 1 << 62, int(rng.integers(3, 50))).astype(np.uint64)
        sets = []
        for _ in range(int(rng.integers(2, 40))):
            own = base[rng.random(len(base)) > rng.choice([0, 0.05, 0.1, 0.2])]
            more = rng.integers(0, 1 << 62, int(rng.integers(1, 6))).astype(np.uint64)
            sets.append(np.unique(np.concatenate([own, more])))
        links = [(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i])
                 if 9 * len(np.intersect1d(x, y)) >= 4 * (len(x) + len(y))]

        def classes(pairs, n=len(sets)):
            label = list(range(n))
            for _ in range(n):
                for a, b in pairs:
                    label[a] = label[b] = min(label[a], label[b])
            return label

        assert classes(links) == classes(ngram_join.linked(sets))


def test_line_dedup(session, corpus):
    found = {r.doc_id: r.text for r in line_dedup.deduplicated(corpus).collect()}
    earlier: list[set] = []
    for i, text in sorted(texts_of(corpus).items()):
        kept = []
        for line in re.findall(r"[^\n]*\n|[^\n]+$", text):
            own = set(WORD.findall(line))
            if not own or not any(9 * len(own & x) >= 4 * (len(own) + len(x)) for x in earlier):
                kept.append(line)
            if own:
                earlier.append(own)
        assert found[i] == "".join(kept)
    assert line_dedup.deduplicated(corpus.limit(0)).count() == 0


def test_line_dedup_of_short_lines(session):
    rng = np.random.default_rng(11)
    texts = ["a b c d\n", "d c b a e\n", "f g h i j\n", "j g f h\n", "k l m\n", "k l m n\n", "k l\n"]
    texts += ["".join(" ".join(f"x{x}" for x in rng.integers(0, 9, int(rng.integers(1, 9)))) + "\n"
                      for _ in range(3)) for _ in range(40)]
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.text for r in line_dedup.deduplicated(docs).collect()}
    earlier: list[set] = []
    for i, text in enumerate(texts):
        kept = ""
        for line in text.splitlines(keepends=True):
            own = set(WORD.findall(line))
            if not any(9 * len(own & x) >= 4 * (len(own) + len(x)) for x in earlier):
                kept += line
            earlier.append(own)
        assert found[i] == kept
    assert [found[i] for i in range(7)] == [texts[0], "", texts[2], "", *texts[4:7]]


def test_toxicity_learns_and_handles_missing_labels(session):
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(400):
        words = [f"word{x}" for x in rng.integers(0, 300, 60)]
        if i % 5 == 0:
            words[3], words[20] = "nastyword", "horridly"
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(1000, None), (1001, "")]
    docs = session.createDataFrame(rows, "doc_id long, text string")
    marks = session.createDataFrame(labels + [(7, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fitted(docs, marks)
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, model, ["doc_id"]).collect()}
    right = sum((scores[i] >= 0.5) == bool(toxic) for i, _, toxic in labels)
    assert right >= 396 and set(scores) == {r[0] for r in rows}
    assert all(0 <= s <= 1 for s in scores.values())
    none = toxicity.fitted(docs, marks.limit(0))
    assert {r.score for r in toxicity.scored(docs, none, ["doc_id"]).collect()} == {0.0}


def test_toxicity_sample_is_bounded_and_usable(session, monkeypatch):
    """Labels of other documents take no place in the sample, an id that repeats takes one, and
    one whose labels contradict each other none."""
    monkeypatch.setattr(toxicity, "POSITIVES", 40)
    monkeypatch.setattr(toxicity, "NEGATIVES", 80)
    single = session.range(300).selectExpr("id as doc_id", "concat('text ', id) as text")
    again = session.range(500).selectExpr("2L as doc_id", "concat('again ', id) as text")
    unknown = session.sql("SELECT CAST(NULL AS BIGINT) AS doc_id, 'no id' AS text")
    docs = single.union(again).union(unknown)
    marks = session.range(5000).selectExpr("id as doc_id", "int(id % 3 = 0) as toxic").union(
        session.sql("SELECT 4L, 0 UNION ALL SELECT 4L, 1 UNION ALL SELECT CAST(NULL AS BIGINT), 1"))
    usable = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 and i != 4]
    rows = toxicity.sampled(docs, marks).collect()
    ids = [r.doc_id for r in rows]
    assert len(set(ids)) == len(ids) == 120 and set(ids) <= set(usable)
    for label, most in ((1, 40), (0, 80)):
        kind = [i for i in usable if int(i % 3 == 0) == label]
        picked = [r for r in rows if r.label == label]
        assert len(picked) == most
        assert picked[0].weight == pytest.approx(len(kind) / most)
        assert all(r.doc_id in kind for r in picked)
    first, second = (toxicity.sampled(source, marks.limit(0)).count() for source in (docs, docs.limit(0)))
    assert first == second == 0


def test_toxicity_of_a_repeated_id_learns_one_text(session):
    texts = [f"again {i}" for i in range(50)] + [None]
    one = next(i for i in range(9) if zlib.crc32(str(i).encode()) % 5)
    docs = session.createDataFrame([(one, t) for t in texts], "doc_id long, text string")
    marks = session.createDataFrame([(one, 1), (one, 1)], "doc_id long, toxic int")
    (row,) = toxicity.sampled(docs, marks).collect()
    assert row.text == min(texts, key=lambda t: hashlib.sha256((t or "").encode()).hexdigest())
    assert (row.label, row.weight) == (1, 1.0)


def test_toxicity_scores_follow_the_rate_of_all_labels(session, monkeypatch):
    # One text in ten is toxic, and nothing in the texts says which.
    docs = session.range(2000).selectExpr("id as doc_id", "'some words of a doubtful kind' as text")
    marks = docs.selectExpr("doc_id", "int(doc_id % 10 = 0) as toxic")
    whole = toxicity.scored(docs, toxicity.fitted(docs, marks), ["doc_id"]).first().score
    monkeypatch.setattr(toxicity, "POSITIVES", 100)
    monkeypatch.setattr(toxicity, "NEGATIVES", 200)
    bounded = toxicity.fitted(docs, marks)
    assert 0.07 < whole < 0.13
    assert 0.07 < toxicity.scored(docs, bounded, ["doc_id"]).first().score < 0.13
    assert 0.08 < bounded.share < 0.12


def test_stages_carry_columns_of_any_name(session, tmp_path):
    rng = np.random.default_rng(4)
    names = ["lines", "lines_left", "kept_id", "copies", "threshold", "label", "weight",
             "calibrates", "rest", "row", "hash", "tie", "component", "limit_source", "a b"]
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 400, 30)), "s", 0, *[f"{n}{i}" for n in names])
            for i in range(20)]
    docs = session.createDataFrame(rows, ["doc_id", "text", "source", "n_chars", *names])
    session.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(session, docs, str(tmp_path))
        assert left.columns == docs.columns, name
        found = left.collect()
        assert found and all(r[n] == f"{n}{r.doc_id}" for r in found for n in names), name
        assert {(r.doc_id, r.text) for r in found} <= {(i, t) for i, t, *_ in rows}, name
        assert name == "mixing" or len(found) == 20, name
        assert all(r.n_chars == (len(r.text) if name == "line_dedup" else 0) for r in found), name


def test_ngram_join_of_blocks_that_need_chunks(session, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHUNK_MEMBERS", 1 << 10)
    monkeypatch.setattr(ngram_join, "CHUNK_SETS", 4)
    rng = np.random.default_rng(8)
    base = [f"w{x}" for x in rng.integers(0, 400, 70)]
    texts = []
    for _ in range(30):
        words = list(base)
        for at in rng.integers(0, 70, int(rng.integers(0, 3))):
            words[at] = f"v{rng.integers(9)}"
        texts.append(" ".join(words[:int(rng.integers(55, 71))]))
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [{tuple(w[k:k + 5]) for k in range(len(w) - 4)} for w in (t.split() for t in texts)]
    least = list(range(len(sets)))
    for _ in sets:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if 100 * len(x & y) >= 80 * len(x | y):
                    least[i] = min(least[i], least[j])
    found = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert [found[i] for i in range(len(sets))] == least


def test_stage_drops_documents_without_lines_left(session):
    docs = session.createDataFrame(
        [(0, "a b c\n", 0), (1, "c b a", 0), (2, " \n", 0), (3, None, 0), (4, "a b c\nd", 0)],
        "doc_id long, text string, n_chars long")
    left = corpus_pipeline.drop_repeated_lines(session, docs, "")
    assert sorted((r.doc_id, r.text or "", r.n_chars) for r in left.collect()) == [
        (0, "a b c\n", 6), (2, " \n", 2), (3, "", 0), (4, "d", 1)]
