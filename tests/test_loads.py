"""Records across lines, months replaced exactly, and batches that fail alone."""

from __future__ import annotations

import pytest

from skyledger import storage
from skyledger.plans import history, ledger
from skyledger.sources import spanning
from tests.conftest import rows
from tests.test_ingest import SCHEMA, line, loaded, write


def stage(spark, folder):
    return history.stage_csv(spark, str(folder), SCHEMA, required=["Year"])


def months(spark, target):
    return sorted(tuple(r) for r in spark.read.parquet(target).groupBy("Year", "Month").count()
                  .collect())


def test_an_unclosed_quote_costs_one_row(spark, tmp_path):
    good = [line(2001, 5, f"A{n}") for n in range(999)]
    write(tmp_path / "in", "2001_05.csv", *good[:500], '2001,5,"9,a,7', *good[500:])
    load = stage(spark, tmp_path / "in")
    assert load.good.count() == 999
    assert rows(load.bad, "_bad_reason") == [(spanning.UNCLOSED,)]


def test_an_unclosed_quote_before_quoted_lines(spark, tmp_path):
    """The next quote would close the field, but those lines stand on their own."""
    quoted = [f'2001,5,2001-05-01,"X{n}, Y",A,B,1.0' for n in range(50)]
    write(tmp_path / "in", "2001_05.csv", *quoted[:20], '2001,5,2001-05-01,"X, Y,A,B,1.0', *quoted[20:])
    load = stage(spark, tmp_path / "in")
    assert load.good.where("Reporting_Airline like 'X%, Y'").count() == 50 and load.bad.count() == 1


@pytest.mark.parametrize("split", ["128m", "2k"])
def test_breaks_in_the_last_column(spark, tmp_path, split):
    """A thousand records of two or three lines, whatever blocks the file is cut into."""
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([*SCHEMA.fields[:-1], StructField("Distance", StringType())])
    lines = []
    for n in range(1000):
        tail = ['"a\nb"', '"2001,5\n\n7"', "plain", '"x ""\n"" y"'][n % 4]
        lines.append(f"2001,5,2001-05-01,A{n},A,B,{tail}")
    write(tmp_path / "in", "2001_05.csv", *lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        load = history.stage_csv(spark, str(tmp_path / "in"), schema, required=["Year"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = {r.Reporting_Airline: r.Distance for r in load.good.collect()}
    want = ["a\nb", "2001,5\n\n7", "plain", 'x "\n" y']
    assert len(found) == 1000 and load.bad.count() == 0
    assert all(found[f"A{n}"] == want[n % 4] for n in range(1000))


def test_every_line_is_accounted_for():
    lines = [("1,2", True), ('3,"x', False), ("4,5", True), ('6,"y', False), ('z",', False),
             ('z"', False), ('7,"', False)]
    at, found = 0, []
    while at < len(lines):
        record, used, reason = spanning.records_of(lines, at)
        found.append((record, used, reason))
        at += used
    assert found == [("1,2", 1, None), ('3,"x', 1, spanning.UNCLOSED), ("4,5", 1, None),
                     ('6,"y\nz",', 2, None), ('z"', 1, None), ('7,"', 1, spanning.UNCLOSED)]


def test_blank_lines_and_files_without_tidy_lines(spark, tmp_path):
    write(tmp_path / "in", "2001_05.csv", "", '2001,5,,"B', "", 'C"', "", "2001,5", '2001,5,,"D\nE"')
    load = stage(spark, tmp_path / "in")
    assert rows(load.good, "Reporting_Airline") == [("B\n\nC",), ("D\nE",), (None,)]
    assert load.bad.count() == 0


def hundred(year, month, **other):
    return [line(year, month, f"A{n}") for n in range(100)]


@pytest.fixture
def two_months(spark, tmp_path):
    target = str(tmp_path / "out")
    for month in (5, 6):
        write(tmp_path / "in", f"2001_{month:02d}.csv", *hundred(2001, month))
    history.load_years(spark, str(tmp_path / "in"), target, 2001, 2001, schema=SCHEMA)
    return target


@pytest.mark.parametrize("all_files", [False, True])
def test_a_month_whose_file_is_absent_stays(spark, tmp_path, two_months, all_files):
    again = tmp_path / "again"
    write(again, "2001_05.csv", *hundred(2001, 5), line(2001, 6))
    if all_files:
        report = history.load_all(spark, str(again), two_months, "replace_months", schema=SCHEMA)
    else:
        report = history.load_years(spark, str(again), two_months, 2001, 2001, schema=SCHEMA)
    assert months(spark, two_months) == [(2001, 5, 100), (2001, 6, 100)]
    totals = history.load_totals(report).first()
    assert (totals["total_rows"], totals["total_bad_rows"]) == (100, 1)


def test_an_emptied_file_empties_its_month(spark, tmp_path, two_months):
    again = tmp_path / "again"
    write(again, "2001_05.csv")
    history.load_years(spark, str(again), two_months, 2001, 2001, schema=SCHEMA)
    assert months(spark, two_months) == [(2001, 6, 100)]


def test_months_need_a_name(spark, tmp_path, two_months):
    write(tmp_path / "again", "notes.csv", line(2001, 5))
    with pytest.raises(ValueError, match="notes.csv"):
        history.load_all(spark, str(tmp_path / "again"), two_months, "replace_months", schema=SCHEMA)
    assert months(spark, two_months) == [(2001, 5, 100), (2001, 6, 100)]


def test_rejected_rows_are_kept(spark, tmp_path):
    write(tmp_path / "in", "2001_05.csv", line(2001, 5, "B", "far"), line(2001, 6))
    kept = str(tmp_path / "rejected")
    with pytest.raises(history.TooManyBadRecords):
        history.load_month(spark, str(tmp_path / "in"), str(tmp_path / "out"), 2001, 5,
                           schema=SCHEMA, max_bad_records=0, rejected=kept)
    assert rows(spark.read.parquet(kept), "reason") == [("month:stray",), ("type:Distance",)]
    assert not storage.path_exists(spark, str(tmp_path / "out"))


def test_one_bad_file_among_many(spark, tmp_path):
    folder, target, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    for month in range(1, 6):
        write(folder, f"2001_{month:02d}.csv", *hundred(2001, month))
    write(folder, "2001_03.csv", line(2001, 3, "B", "far"), line(2001, 3, "C", "far"))
    options = {"batch_files": 4, "max_bad_records": 1, "schema": SCHEMA}
    run = ledger.load_batches(spark, f"{folder}/*.csv", target, log, **options)
    assert rows(run, "outcome", "output_rows") == [("failed", None), *[("loaded", 100)] * 4]
    assert loaded(spark, target) == sorted([(2001, m) for m in (1, 2, 4, 5) for _ in range(100)])
    assert ledger.rejected_rows(spark, log).where("reason = 'type:Distance'").count() == 4

    write(folder, "2001_03.csv", *hundred(2001, 3))
    run = ledger.load_batches(spark, f"{folder}/*.csv", target, log, **options)
    assert rows(run, "outcome", "output_rows", "bad_rows") == [("loaded", 100, 0)]
    assert ledger.load_batches(spark, f"{folder}/*.csv", target, log, **options).count() == 0
    assert rows(ledger.outcomes(spark, log), "outcome") == [("loaded",)] * 5
    with pytest.raises(ValueError, match="repeated"):
        ledger.load_batches(spark, f"{folder}/*.csv", target, log, mode="append")


def test_compaction_keeps_directories(spark, tmp_path):
    from skyledger.sinks import files as sinks
    from tests.conftest import plan_of

    path = str(tmp_path / "table")
    rows_of = spark.range(4000).selectExpr("id", "2000 + id % 2 AS Year", "1 + id % 3 AS Month")
    rows_of.repartition(6).write.partitionBy("Year", "Month").parquet(path)
    spark.range(10).selectExpr("id", "2005 AS Year", "7 AS Month").coalesce(1).write.mode(
        "append").partitionBy("Year", "Month").parquet(path)
    before = months(spark, path)
    kept = storage.matching_paths(spark, f"{path}/Year=2005/Month=7/*.parquet")
    done = sinks.compact_partitions(spark, path, ["id"])
    assert len(done) == 6 and "Year=2001/Month=2" in done
    assert months(spark, path) == before
    assert len(storage.matching_paths(spark, f"{path}/Year=*/Month=*/*.parquet")) == 7
    assert storage.matching_paths(spark, f"{path}/Year=2005/Month=7/*.parquet") == kept
    pruned = spark.read.parquet(path).where("Year = 2001 AND Month = 2")
    assert "PartitionFilters: [isnotnull(Year" in plan_of(pruned)
    assert sinks.compact_partitions(spark, path) == []
    assert sinks.compact_in_place(spark, path).count() == 4010
    assert storage.matching_paths(spark, f"{path}.compacting*") == []
