"""CSV files in which quoted fields may hold line breaks, read by physical lines.

Every line of a file belongs to exactly one record. A record whose last field opens a quote that
its line does not close goes on in the lines behind it, up to the one that closes it. It does not if
a line of its own comes before that (all fields of the header, every quote in its place), if the
file ends, or if ``MAX_RECORD_LINES`` lines do not do: then the first line alone is a bad record, and
reading goes on behind it, so that an unclosed quote costs no other line.

A block of a file is put together where it is read: its first line that stands on its own begins a
record, whatever lies before. Only the lines before that one, and a record that the block's end leaves
open, go on to a task that puts them together file by file, so the bulk of the lines is not moved. In a
file of which no line stands on its own, that is all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.storage import materialise

MAX_RECORD_LINES, MAX_RECORD_CHARS = 256, 1 << 20
UNCLOSED = "quote:unclosed"

_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_ALONE = rf'^(?:{_QUOTED}|[^",]*+)(?:,(?:{_QUOTED}|[^",]*+))*+$'
_FIELD = rf'(?:{_QUOTED}(?=,|\Z)|[^",\n][^,\n]*+|)'
_WHOLE = re.compile(rf"{_FIELD}(?:,{_FIELD})*+\Z")
_OPEN = re.compile(rf'(?:{_FIELD},)*+"[^"]*+(?:""[^"]*+)*+\Z')

_RECORDS = "file_path string, file_size long, record string, lines int, reason string"
# Besides records: lines that are handed on (with a value), and where a block begins to stand on its
# own (without one).
_DECIDED = f"{_RECORDS}, block long, place long, value string"


def _quoted(line: Column) -> Column:
    return line.contains('"')


def _fields(line: Column) -> Column:
    """How many fields a line has in which every quote is in its place."""
    bare = F.when(_quoted(line), F.regexp_replace(line, _QUOTED, "")).otherwise(line)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file_path, file_size, block, place, value of all lines, as Spark reads them: ``block`` is where
    the block of the file begins, ``place`` rises with the lines of a block."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value")


def headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file_path, fields of the first line, number of lines: a row for each file, stored."""
    start = F.col("block") == 0
    fields = F.when(start, _fields(F.col("value")))
    return materialise(_lines(spark, paths).groupBy("file_path").agg(
        F.min_by(fields, F.when(start, F.col("place"))).alias("header_fields"),
        F.count(F.lit(1)).alias("file_lines")), "headers")


def known_lines(spark: SparkSession, paths: list[str], of_header: DataFrame) -> DataFrame:
    """The lines, and whether each stands on its own. The headers, a row for each file, are broadcast,
    which leaves the lines where they are read and in order."""
    value = F.col("value")
    tidy = ~_quoted(value) | value.rlike(_ALONE)
    alone = tidy & (_fields(value) == F.col("header_fields")) & (F.trim("value") != "")
    return (_lines(spark, paths).join(F.broadcast(of_header), "file_path")
            .select("file_path", "file_size", "block", "place", "value", alone.alias("alone")))


def _next_record(lines: list[tuple[str, bool]],
                 start: int) -> tuple[str, int, str | None, bool]:
    """``records_of`` and whether more lines behind the last could change it."""
    text, alone = lines[start]
    if alone or not _OPEN.match(text):
        return text, 1, None, False
    whole, ahead = text, lines[start + 1:start + MAX_RECORD_LINES]
    for used, (line, stands_alone) in enumerate(ahead, 2):
        whole += "\n" + line
        if stands_alone or len(whole) > MAX_RECORD_CHARS:
            return text, 1, UNCLOSED, False
        if _WHOLE.match(whole):
            return whole, used, None, False
    return text, 1, UNCLOSED, len(ahead) < MAX_RECORD_LINES - 1


def records_of(lines: list[tuple[str, bool]], start: int) -> tuple[str, int, str | None]:
    """(record, number of lines, reason why it is bad) at ``start`` of (line, stands alone)."""
    return _next_record(lines, start)[:3]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    made = pa.RecordBatch.from_arrays([pa.array(list(c), field.type) for c, field in
                                       zip(columns, schema, strict=True)], schema=schema)
    rows.clear()
    return made


_RECORD_SCHEMA = pa.schema([
    ("file_path", pa.string()), ("file_size", pa.int64()), ("record", pa.string()),
    ("lines", pa.int32()), ("reason", pa.string())])
_DECIDED_SCHEMA = pa.schema([*_RECORD_SCHEMA, ("block", pa.int64()), ("place", pa.int64()),
                             ("value", pa.string())])


def _taken(held: list, left: int, last: bool) -> Iterator[tuple[str | None, int, str | None]]:
    """(record, lines, reason) from the front of ``held``, lines that begin with (value, alone), which
    they leave, until ``left`` lines remain or, unless they are the ``last``, one that the lines behind
    could change. Blank lines have no record."""
    lines, start = [line[:2] for line in held], 0
    while len(lines) - start > left:
        record, used, reason, undecided = (
            _next_record(lines, start) if lines[start][0].strip() else (None, 1, None, False))
        if undecided and not last:
            break
        yield record, used, reason
        start += used
    del held[:start]


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lines by block and in order: the records that lie in one block, the lines of others."""
    key: tuple | None = None
    block, stands = None, False
    held: list[tuple[str, bool, int]] = []
    out: list[tuple] = []

    def drain(left: int) -> None:
        out.extend((*key, *record, None, None, None) for record in _taken(held, left, False))

    def hand_on() -> None:
        out.extend((*key, None, 0, None, block, place, value) for value, _, place in held)
        held.clear()

    for batch in batches:
        for path, size, own, place, value, alone in zip(
                *(c.to_pylist() for c in batch.columns), strict=True):
            if (path, size) != key or own != block:
                if held:
                    drain(0)
                    hand_on()
                key, block, stands = (path, size), own, False
                if own == 0:
                    # The header has no record; what follows it begins one.
                    stands = True
                    out += [(*key, None, 1, None, None, None, None),
                            (*key, None, 0, None, block, place, None)]
                    continue
            if alone and not stands:
                stands = True
                out.append((*key, None, 0, None, block, place, None))
            held.append((value, alone, place))
            if not stands:
                hand_on()
            elif len(held) >= 4 * MAX_RECORD_LINES:
                drain(MAX_RECORD_LINES)
        if out:
            yield _batch(out, _DECIDED_SCHEMA)
    if held:
        drain(0)
        hand_on()
    if out:
        yield _batch(out, _DECIDED_SCHEMA)


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the lines handed on, which lie by file and in order; nothing goes on beyond where a
    block begins to stand on its own."""
    key: tuple | None = None
    held: list[tuple[str, bool]] = []
    out: list[tuple] = []

    def drain(left: int) -> None:
        out.extend((*key, *record) for record in _taken(held, left, True))

    for batch in batches:
        for path, size, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if value is None or (path, size) != key:
                if held:
                    drain(0)
                key = (path, size)
            if value is None:
                continue
            held.append((value, False))
            if len(held) >= 4 * MAX_RECORD_LINES:
                drain(MAX_RECORD_LINES)
        if out:
            yield _batch(out, _RECORD_SCHEMA)
    if held:
        drain(0)
    if out:
        yield _batch(out, _RECORD_SCHEMA)


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file_path, file_size, record, lines, reason: the records of the files, stored; headers and
    blank lines count with their line but have no record."""
    of_header = headers(spark, paths)
    decided = materialise(known_lines(spark, paths, of_header.select("file_path", "header_fields"))
                          .mapInArrow(_decided, _DECIDED), "records")
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = materialise(
        decided.where("place IS NOT NULL").repartition(count, "file_path")
        .sortWithinPartitions("file_path", "block", "place")
        .select("file_path", "file_size", "value").mapInArrow(_put_together, _RECORDS), "records")
    names = [field.name for field in _RECORD_SCHEMA]
    records = decided.where("place IS NULL").select(*names).unionByName(others)
    # The account of lines: none is lost, none is read twice.
    read = of_header.agg(F.coalesce(F.sum("file_lines"), F.lit(0))).first()[0]
    used = records.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]
    if read != used:
        raise RuntimeError(f"{read} lines were read, the records account for {used}")
    return records
