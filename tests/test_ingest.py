from __future__ import annotations

import datetime
import json
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from skyledger import storage
from skyledger.plans import history
from skyledger.sinks import files as sinks
from skyledger.sources import files as sources
from tests.conftest import plan_of, rows

SCHEMA = StructType([
    StructField("Year", LongType()), StructField("Month", LongType()),
    StructField("FlightDate", DateType()), StructField("Reporting_Airline", StringType()),
    StructField("Origin", StringType()), StructField("Dest", StringType()),
    StructField("Distance", DoubleType()),
])
HEADER = "Year,Month,FlightDate,Reporting_Airline,Origin,Dest,Distance"


def write(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def line(year, month, airline="AA", distance="100.0"):
    return f"{year},{month},{year}-{month:02d}-01,{airline},A,B,{distance}"


@pytest.fixture
def monthly(tmp_path):
    folder = tmp_path / "in"
    for year in (1999, 2000, 2001):
        for month in (1, 2, 11):
            write(folder, f"{year}_{month:02d}.csv", line(year, month))
    write(folder, "2000_3.csv", line(2000, 3))
    write(folder, "notes.csv", line(1900, 1))
    write(folder / "deeper", "2000_01.csv", line(2000, 1))
    return str(folder)


def loaded(spark, target):
    return rows(spark.read.parquet(target), "Year", "Month")


def test_listing_is_sorted_and_top_level(spark, monthly, tmp_path):
    names = [row["path"].rsplit("/", 1)[1]
             for row in sources.list_csv_files(spark, monthly).collect()]
    assert len(names) == 11 and names == sorted(names)
    assert sources.list_csv_files(spark, str(tmp_path / "in" / "deeper")).count() == 1
    assert sources.list_files(spark, f"{monthly}/*.nothing").count() == 0


def test_year_range(spark, monthly, tmp_path):
    target = str(tmp_path / "out")
    report = history.load_years(spark, monthly, target, 2000, 2001, schema=SCHEMA)
    assert loaded(spark, target) == [(2000, 1), (2000, 11), (2000, 2), (2000, 3), (2001, 1),
                                     (2001, 11), (2001, 2)]
    assert history.load_totals(report).first()["total_files"] == 7


def test_months_apply_to_every_year(spark, monthly, tmp_path):
    target = str(tmp_path / "out")
    history.load_years(spark, monthly, target, 1999, 2000, 2, 3, schema=SCHEMA)
    assert loaded(spark, target) == [(1999, 2), (2000, 2), (2000, 3)]


def test_repeating_a_month_changes_nothing(spark, monthly, tmp_path):
    target = str(tmp_path / "out")
    history.load_all(spark, monthly, target, "overwrite", schema=SCHEMA)
    before = loaded(spark, target)
    for _ in range(2):
        history.load_month(spark, monthly, target, "2000", "1", schema=SCHEMA)
    assert loaded(spark, target) == before and len(before) == 11


def test_append_and_overwrite(spark, monthly, tmp_path):
    target = str(tmp_path / "out")
    for mode, total in (("append", 11), ("append", 22), ("overwrite", 11)):
        history.load_all(spark, monthly, target, mode, schema=SCHEMA)
        assert spark.read.parquet(target).count() == total
    with pytest.raises(ValueError, match="mode"):
        history.load_all(spark, monthly, target, "merge", schema=SCHEMA)


def test_no_matching_file(spark, monthly, tmp_path):
    report = history.load_month(spark, monthly, str(tmp_path / "out"), 1950, 1, schema=SCHEMA)
    assert history.load_totals(report).first().asDict() == {
        "total_files": 0, "total_rows": 0, "total_bad_rows": 0, "total_bytes": 0}


def test_file_month(spark, monthly):
    df = sources.with_file_month(sources.read_csv(spark, f"{monthly}/*.csv", SCHEMA))
    assert df.filter("file_year <> Year OR file_month <> Month").count() == 0
    assert rows(df.filter("file_year IS NULL"), "Year") == [(1900,)]


def test_tolerant_rows(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "2000_01.csv",
          line(2000, 1),
          "2000,1,2000-01-02,BB",                       # short: rest is null
          line(2000, 1, "CC") + ",surplus,columns",
          line(2000, 1, "DD", "far"),                   # no number
          line(2000, 1, "EE", ""),                      # blank is null, not bad
          ",1,2000-01-03,FF,A,B,1.0",                   # required year missing
          "2000,1,someday,GG,A,B,1.0",
          '2000,1,2000-01-04,"",A,B,2.5')               # quoted empty stays empty text
    load = history.stage_csv(spark, str(folder), SCHEMA)
    assert rows(load.good, "Reporting_Airline", "Origin", "Distance") == [
        ("", "A", 2.5), ("AA", "A", 100.0), ("BB", None, None), ("CC", "A", 100.0),
        ("EE", "A", None)]
    assert rows(load.bad, "Reporting_Airline", "_bad_reason") == [
        ("DD", "type:Distance"), ("FF", "missing:Year"), ("GG", "type:FlightDate")]
    assert load.report().first()["bad_rows"] == 3


def test_line_breaks_inside_quotes(spark, tmp_path):
    """Only the file that has them is read as a whole; the rows of the others stay."""
    folder = tmp_path / "in"
    write(folder, "2000_01.csv", '2000,1,2000-01-01,"A\nA",A,"B\n\n, B",7', line(2000, 1, "X"))
    write(folder, "2000_02.csv", line(2000, 2, "Y"))
    load = history.stage_csv(spark, str(folder), SCHEMA)
    assert rows(load.good, "Reporting_Airline", "Dest", "Distance") == [
        ("A\nA", "B\n\n, B", 7.0), ("X", "B", 100.0), ("Y", "B", 100.0)]
    assert load.bad.count() == 0


def test_a_stray_quote_swallows_no_rows(spark, tmp_path):
    """A short row with a lone quote; then a genuine line break in quotes beside a lone quote."""
    folder, target = tmp_path / "in", str(tmp_path / "out")
    lines = [line(2001, 5, f"A{n}") for n in range(999)]
    write(folder, "2001_05.csv", *lines[:500], '2001,5,2001-05-01,a"b', *lines[500:])
    history.load_all(spark, str(folder), target, "overwrite", schema=SCHEMA, required=["Year"])
    assert spark.read.parquet(target).count() == 1000
    write(folder, "2001_05.csv", *lines[:500], line(2001, 5, '"B\nC"'),
          line(2001, 5, '5" pipe'), *lines[501:998])
    history.load_all(spark, str(folder), target, "overwrite", schema=SCHEMA, required=["Year"])
    assert spark.read.parquet(target).count() == 999


def test_bad_row_budget(spark, tmp_path):
    folder, target = tmp_path / "in", str(tmp_path / "out")
    write(folder, "2000_01.csv", line(2000, 1), line(2000, 1, "B", "x"), line(2000, 1, "C", "y"))
    with pytest.raises(history.TooManyBadRecords):
        history.load_all(spark, str(folder), target, schema=SCHEMA, max_bad_records=1)
    assert not storage.path_exists(spark, target)
    history.load_all(spark, str(folder), target, schema=SCHEMA, max_bad_records=2)
    assert spark.read.parquet(target).count() == 1


def test_raw_schema_loads(spark, tmp_path):
    from skyledger.schemas import RAW_FLIGHTS

    values = {"Year": "2020", "Quarter": "1", "Month": "2", "DayofMonth": "3", "DayOfWeek": "1",
              "FlightDate": "2020-02-03", "Reporting_Airline": "AA", "DepDelay": "-3.00"}
    names = RAW_FLIGHTS.fieldNames()
    (tmp_path / "2020_2.csv").write_text(
        ",".join(names) + "\n" + ",".join(values.get(name, "") for name in names) + "\n")
    target = str(tmp_path / "out")
    history.load_month(spark, str(tmp_path), target, 2020, 2)
    row = spark.read.parquet(target).first()
    assert row["FlightDate"] == datetime.date(2020, 2, 3) and row["DepDelay"] == -3.0
    assert len(row) == 109


def test_partitioned_layout_prunes_and_sorts(spark, flights, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_partitioned(flights, path, ["Year", "Month"], ["Reporting_Airline", "Origin"])
    table = spark.read.parquet(path)
    plan = plan_of(table.filter("Year = 1998").select("Origin"))
    assert "PartitionFilters: [isnotnull(Year" in plan and "ReadSchema: struct<Origin:string>" in plan
    assert table.count() == flights.count()


def test_a_hot_month_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100kb")
    try:
        df = spark.range(0, 200000, 1, 8).select(
            F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 12).alias("Month"),
            F.sha2(F.col("id").cast("string"), 256).alias("text"))
        sinks.write_partitioned(df, str(tmp_path / "out"), ["Month"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = list((tmp_path / "out" / "Month=1").glob("*.parquet"))
    assert len(hot) > 3


def test_write_modes(spark, tmp_path):
    df, path = spark.range(10), str(tmp_path / "out")
    sinks.write_parquet(df, path, dry_run=True)
    assert not storage.path_exists(spark, path)
    sinks.write_parquet(df, path, mode="errorifexists", files=3)
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 3
    with pytest.raises(AnalysisException):
        sinks.write_parquet(df, path, mode="errorifexists")
    sinks.write_parquet(df.limit(4), path)
    assert spark.read.parquet(path).count() == 4


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(100).repartition(9).write.parquet(path)
    with pytest.raises(ValueError):
        sinks.compact_parquet(spark, path, path + "/")
    compacted = sinks.compact_parquet(spark, path, str(tmp_path / "few"), files=2)
    assert compacted.count() == 100
    assert sinks.compact_in_place(spark, path, files=1).agg(F.sum("id")).first()[0] == 4950
    assert len(list((tmp_path / "many").glob("*.parquet"))) == 1


def test_csv_conversion(spark, tmp_path):
    write(tmp_path / "in", "a.csv", line(2000, 1), line(2000, 2))
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "a.csv").write_text(HEADER + "\n")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    assert not sinks.convert_csv(spark, str(tmp_path / "empty"), target, SCHEMA)
    assert not sinks.convert_csv(spark, source, target, SCHEMA, dry_run=True)
    assert not storage.path_exists(spark, target)
    assert sinks.convert_csv(spark, source, target, SCHEMA, partition_by=["Year", "Month"])
    assert (tmp_path / "out" / "Year=2000" / "Month=2").is_dir()
    inferred = sources.read_csv(spark, source, infer=True)
    assert inferred.schema["Distance"].dataType == DoubleType()
    assert sources.read_csv(spark, source).schema["Year"].dataType == StringType()


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", datetime.date(2020, 1, 2)), (2, None, None)],
                               "n int, s string, d date")
    for name, export in sinks.EXPORTS.items():
        export(df, str(tmp_path / name))
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2
    lines = [json.loads(row[0]) for row in spark.read.text(str(tmp_path / "json")).collect()]
    assert {"n": 1, "s": "a,b", "d": "2020-01-02"} in lines
    assert {"n": 2, "s": None, "d": None} in lines
    assert sources.read_csv(spark, str(tmp_path / "csv"), df.schema).exceptAll(df).count() == 0


def test_tables(spark, flights):
    names = sinks.create_tables(spark)
    sinks.create_tables(spark)
    assert sources.read_table(spark, "flights_analytics").count() == 0
    assert len(sources.read_table(spark, "flights_raw").columns) == 109
    from skyledger.operators.curate import daily_mart

    sinks.write_table(daily_mart(flights), "mart")
    assert sources.read_table(spark, "mart").count() > 0
    for name in [*names, "mart"]:
        spark.sql(f"DROP TABLE {name}")


def test_inventory(spark, flights, tmp_path):
    from skyledger.operators.curate import daily_mart

    mart = str(tmp_path / "mart")
    sinks.write_layout(daily_mart(flights), "flights_analytics", mart)
    (row,) = sinks.table_inventory(spark, {"flights_analytics": mart}).collect()
    assert row["num_rows"] == spark.read.parquet(mart).count() and row["num_bytes"] > 0
    assert row["partitioning"] == "year,month" and row["clustering"].startswith("airline")


def test_sql_with_bound_values(spark, flights):
    df = sources.run_sql(spark, "SELECT count(*) AS n FROM t WHERE Origin = :origin",
                         {"t": flights}, {"origin": "A01' OR '1'='1"})
    assert df.first()["n"] == 0


def session_stub(master, configured=None, checkpoint_dir=None):
    """What the choice of the shared folder looks at."""
    chosen = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint_dir,
                              setCheckpointDir=chosen.append)
    conf = SimpleNamespace(get=lambda key, default: configured)
    return SimpleNamespace(conf=conf, sparkContext=context), chosen


def test_shared_folder_is_the_one_the_cluster_names():
    cluster, _ = session_stub("yarn", configured="hdfs:///shared/")
    assert storage.shared_dir(cluster) == "hdfs:///shared"
    assert storage.scratch_path(cluster, "x").startswith("hdfs:///shared/skyledger/x-")
    nameless, _ = session_stub("yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(nameless)
    local, chosen = session_stub("local[2]")
    assert storage.shared_dir(local) == chosen[0]
