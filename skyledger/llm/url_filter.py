"""URL filter: a broadcast trie over reversed host labels and path segments.

A rule is (host, path, verdict). It fits a URL if the URL's host is the rule's host or one of its
subdomains and the URL's path starts with the rule's path. Of the rules that fit, the one with
the most host labels wins, then the one with the longest path, then ``block`` before ``allow``;
URLs that none fits get the default verdict.

Nulls and URLs without ``://`` have an empty host and path, which no rule fits. Repeated pages
are judged one by one; an empty table gives an empty result. Only the id and the URL are read, so
further columns cannot clash.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, str, str]

#: host, then path, of a URL; A to Z are lowered in the host, nothing else is changed.
_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


class Trie:
    """Host labels from the top level down lead to a node; its paths hang below it by segment."""

    __slots__ = ("labels", "paths")

    def __init__(self) -> None:
        self.labels: dict[str, Trie] = {}
        self.paths: _Path | None = None

    def add(self, host: str, path: str, verdict: str) -> None:
        node = self
        for label in reversed(host.split(".")):
            node = node.labels.setdefault(label, Trie())
        node.paths = node.paths or _Path()
        node.paths.add(path, f"{host}{path}", verdict)

    def find(self, host: str, path: str) -> tuple[int, int, str, str] | None:
        """(host labels, path length, rule, verdict) of the rule that wins."""
        node, best, depth = self, None, 0
        for label in reversed(host.split(".")):
            node = node.labels.get(label)
            if node is None:
                break
            depth += 1
            if node.paths is not None:
                found = node.paths.find(path)
                if found is not None:
                    best = (depth, *found)
        return best


class _Path:
    """Whole segments lead down; the last segment of a rule may be the beginning of one."""

    __slots__ = ("segments", "beginnings", "lengths")

    def __init__(self) -> None:
        self.segments: dict[str, _Path] = {}
        self.beginnings: dict[str, tuple[str, str]] = {}
        self.lengths: list[int] = []

    def add(self, path: str, rule: str, verdict: str) -> None:
        *whole, last = path.split("/")
        node = self
        for segment in whole:
            node = node.segments.setdefault(segment, _Path())
        if node.beginnings.get(last, ("", ""))[1] != "block":
            node.beginnings[last] = (rule, verdict)
        node.lengths = sorted({len(x) for x in node.beginnings}, reverse=True)

    def find(self, path: str) -> tuple[int, str, str] | None:
        node, best, at = self, None, 0
        for segment in path.split("/"):
            for length in node.lengths:
                hit = node.beginnings.get(segment[:length]) if length <= len(segment) else None
                if hit is not None:
                    best = (at + length, *hit)
                    break
            node = node.segments.get(segment)
            if node is None:
                break
            at += len(segment) + 1
        return best


def tries(rules: Iterable[Rule], max_bytes: int) -> list[Trie]:
    """One trie, or as many as it takes for each to stay below ``max_bytes`` when sent."""
    rules = list(rules)
    trie = Trie()
    for host, path, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"a rule allows or blocks: {verdict!r}")
        trie.add(host.translate(str.maketrans(_UPPER, _LOWER)), path, verdict)
    if len(rules) > 1 and len(pickle.dumps(trie)) > max_bytes:
        half = len(rules) // 2
        return tries(rules[:half], max_bytes) + tries(rules[half:], max_bytes)
    return [trie]


def judged(
    pages: DataFrame,
    rules: Sequence[Rule],
    page_id: str = "page_id",
    url: str = "url",
    default: str = "allow",
    max_bytes: int = 64 << 20,
) -> DataFrame:
    """page_id, host, path, rule (host and path of the one that decides, else null), verdict.

    The trie is broadcast after its size is measured. Rules beyond ``max_bytes`` are dealt to
    several tries; each is looked up in turn and the best of their finds wins, as in one trie.
    """
    spark = pages.sparkSession
    found = []
    for trie in tries(rules, max_bytes):
        shared = spark.sparkContext.broadcast(trie)

        @F.pandas_udf("labels int, length int, block boolean, rule string")
        def look_up(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            trie = shared.value
            for hosts, paths in parts:
                yield pd.DataFrame(
                    [(x[0], x[1], x[3] == "block", x[2]) if x else (-1, -1, False, None)
                     for x in map(trie.find, hosts, paths)],
                    columns=["labels", "length", "block", "rule"])

        found.append(look_up(F.col("host"), F.col("path")))
    parts = pages.select(
        F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"))
    best = F.greatest(*found) if len(found) > 1 else found[0]
    return parts.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.when(F.col("best.rule").isNull(), F.lit(default))
        .when(F.col("best.block"), "block").otherwise("allow").alias("verdict"))
