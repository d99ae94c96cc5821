"""Components against a plain union of sets, and how often links are written."""

from __future__ import annotations

import numpy as np
import pytest

from skyledger.llm import components, tables


@pytest.fixture(scope="module")
def session(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return tables.prepared(spark)


def least(links):
    low = {x: x for link in links for x in link if link[0] != link[1]}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    return low


def found(session, links, tasks):
    rows = session.createDataFrame(links, "a long, b long").repartition(tasks)
    return {r.node: r.component for r in components.components(rows).collect()}


@pytest.mark.parametrize("piece", [5, 1 << 20])
def test_against_a_union_of_sets(session, monkeypatch, piece):
    monkeypatch.setattr(components, "PIECE", piece)
    rng = np.random.default_rng(piece)
    links = [tuple(map(int, x)) for x in rng.integers(-200, 200, (170, 2))]
    links += [(x, x + 1) for x in range(1000, 1030)] + [(7, 5000 + x) for x in range(40)] + links[:9]
    assert found(session, links, 3) == least(links)


def test_no_links(session):
    assert found(session, [], 1) == {} == found(session, [(4, 4)], 1)


def test_finished_stars_are_written_once(session, monkeypatch):
    written = []
    monkeypatch.setattr(components, "stored",
                        lambda df, label: written.append(label) or tables.stored(df, label))
    links = [(x % 5, 10 + x) for x in range(100)]
    assert found(session, links, 4) == least(links)
    assert written.count("links") == 1
