"""Chat formatting by incremental rendering of a black-box template.

A template is any function from turns to one string. It is never parsed: the prefixes of a
conversation are rendered one after the other, and the span of turn i is what the output of i
turns has beyond the output of i - 1. If a longer prefix does not begin with the output of the
shorter one, the template rewrites history; the conversation is marked, and only then the spans
are those of the whole rendering as far as both outputs agree. Inside a turn's span the text is
found by rendering the prefix twice more, with two different one-character texts in the turn's
place: what both outputs begin and end with is the template's own.

Rows of a conversation are taken by turn; ties go by role, then text; null turns come first. A
null role or text is empty, a null conversation id is a conversation like others. Empty tables
give no conversations. Columns beyond the four are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.tables import partitions

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

# ---- the template in use --------------------------------------------------------------------

_OPEN, _MIDDLE, _CLOSE = "<turn ", ">\n", "</turn>\n"
_ESCAPES = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
_BACK = {"\\\\": "\\", "\\l": "<", "\\g": ">"}
_TURN = re.compile(r"<turn ([^<>]*)>\n([^<>]*)</turn>\n")


def escape(text: str) -> str:
    """The text without the signs that control strings are made of, so that it holds none."""
    return text.replace("\\", "\\\\").replace("<", "\\l").replace(">", "\\g")


def unescape(text: str) -> str:
    return re.sub(r"\\[\\lg]", lambda m: _BACK[m[0]], text) if "\\" in text else text


def turn_template(turns: list[Turn]) -> str:
    """``<turn role>``, a line break, the text, ``</turn>`` and a line break for each turn."""
    return "".join(f"{_OPEN}{escape(role)}{_MIDDLE}{escape(text)}{_CLOSE}" for role, text in turns)


def read_turns(output: str) -> list[Turn]:
    """The turns of an output of ``turn_template``."""
    found, at = [], 0
    for m in _TURN.finditer(output):
        if m.start() != at:
            break
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(output):
        raise ValueError(f"no turn at {at}")
    return found


# ---- incremental rendering ------------------------------------------------------------------


@dataclass
class Rendered:
    """Output, span of each turn, span of each turn's text, and whether history was rewritten."""

    output: str
    turns: list[tuple[int, int]]
    texts: list[tuple[int, int]]
    rewrites: bool


_PROBES = "xy"


def _common_start(a: str, b: str) -> int:
    """Length of the longest common beginning, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def render(turns: list[Turn], template: Template = turn_template) -> Rendered:
    outputs, rewrites = [template([])], False
    turn_spans: list[tuple[int, int]] = []
    text_spans: list[tuple[int, int]] = []
    for i, (role, _) in enumerate(turns):
        output, last = template(turns[:i + 1]), outputs[-1]
        same = len(last) if output.startswith(last) else _common_start(last, output)
        rewrites |= same < len(last)
        turn_spans.append((same, len(output)))
        x, y = (template([*turns[:i], (role, probe)]) for probe in _PROBES)
        begin = _common_start(x, y)
        end = _common_start(x[begin:][::-1], y[begin:][::-1])
        text_spans.append((begin, max(begin, len(output) - end)))
        outputs = [output]
    return Rendered(outputs[-1], turn_spans, text_spans, rewrites)


SCHEMA = ("conv_id long, output string, turn_spans array<struct<begin:int,end:int>>, "
          "text_spans array<struct<begin:int,end:int>>, roles array<string>, rewrites boolean")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[Turn]]]:
    """Runs of rows with one id; only the run at hand is held."""
    key, turns, begun = None, [], False
    for batch in batches:
        for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if begun and conv_id != key:
                yield key, turns
                turns = []
            key, begun = conv_id, True
            turns.append((role or "", text or ""))
    if begun:
        yield key, turns


def each_conversation(conversations: DataFrame, function, schema: str) -> DataFrame:
    """``function(conv_id, turns) -> row`` for each conversation.

    Rows are dealt by conversation and sorted; a task streams through them and holds one
    conversation at a time. That is the unit of rendering: a template sees all its turns.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        rows, size = [], 0
        for key, turns in _conversations(batches):
            rows.append(function(key, turns))
            size += sum(len(text) for _, text in turns)
            if size > 1 << 20:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    ordered = conversations.select("conv_id", "turn", "role", "text").repartition(
        partitions(conversations.sparkSession), "conv_id").sortWithinPartitions(
        "conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, schema)


def formatted(conversations: DataFrame, template: Template = turn_template) -> DataFrame:
    """conv_id, output, spans of turns and of their texts in it, roles, rewrites."""

    def row(key, turns):
        r = render(turns, template)
        spans = [[{"begin": b, "end": e} for b, e in x] for x in (r.turns, r.texts)]
        return {"conv_id": key, "output": r.output, "turn_spans": spans[0],
                "text_spans": spans[1], "roles": [role for role, _ in turns],
                "rewrites": r.rewrites}

    return each_conversation(conversations, row, SCHEMA)
