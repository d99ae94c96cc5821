"""Steps whose tasks, moved bytes or parses must not grow with the table."""

from __future__ import annotations

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from checks import registry, views
from skyledger.operators import fact
from skyledger.plans import bucketed
from skyledger.sinks import files as sink_files
from skyledger.sources import spanning
from skyledger.storage import matching_paths, materialise, size_in_bytes
from tests.conftest import SMALL, plan_of, rows
from tests.test_ingest import write


def quoted_file(folder):
    write(folder, "2001_05.csv", *[
        f'2001,5,2001-05-01,A{n},A,B,' + ('"a\nb"' if n % 4 == 0 else "plain") for n in range(1000)])
    return [str(folder)]


def test_lines_are_put_together_where_they_are_read(spark, tmp_path):
    """no exchange, and only the lines at the ends of blocks are handed on."""
    paths = quoted_file(tmp_path / "in")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        of_header = spanning.headers(spark, paths).select("file_path", "header_fields")
        decided = spanning.known_lines(spark, paths, of_header).mapInArrow(
            spanning._decided, spanning._DECIDED)
        assert "Exchange hashpartitioning" not in plan_of(decided)
        handed_on = decided.where("value IS NOT NULL").count()
        records = spanning.read_records(spark, paths)
        whole = [r.record for r in records.where("record IS NOT NULL").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert handed_on < 50
    assert len(whole) == 1000 and sum("\n" in record for record in whole) == 250


def test_a_number_of_files_is_raised_for_a_large_source(spark, tmp_path):
    """no task has to write more than the given share of the source."""
    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(50_000).select("id", F.xxhash64("id").alias("text")).repartition(9).write.parquet(source)
    share = size_in_bytes(spark, source) // 4
    found = sink_files.compact_parquet(spark, source, target, files=2, file_bytes=share)
    assert found.count() == 50_000
    assert len(matching_paths(spark, f"{target}/*.parquet")) >= 4


def test_parts_of_a_built_input_grow_with_its_table(spark):
    """F4, F8, F11 to F14: a part has a bounded share of the stored table, with a least number."""
    size = size_in_bytes(spark, f"{SMALL}/events.parquet")
    assert views.shares(spark, SMALL, "events", size // 10, least=4) >= 10
    assert views.shares(spark, SMALL, "events", 10 * size, least=4) == 4


def test_monthly_files_are_compressed_and_complete(spark, flights):
    """F5, F17 to F21."""
    folder, schema = registry._monthly_folder(spark, SMALL)
    files = matching_paths(spark, f"{folder}/*.csv/*.csv*")
    assert files and all(path.endswith(".csv.gz") for path, _ in files)
    months = flights.select("Year", "Month").distinct().count()
    assert len(matching_paths(spark, f"{folder}/*.csv")) == months
    read = spark.read.schema(schema).option("header", True).csv(f"{folder}/*.csv")
    assert read.count() == flights.count()


def test_stored_rows_are_zstd(spark):
    """F5, F9."""
    path = materialise(spark.range(10), "zstd").inputFiles()[0]
    assert ".zstd." in path


def test_the_fact_key_is_not_moved(spark, flights):
    """F9, F15, F16: the distinct goes without the key; the join carries its marked form alone."""
    facts = fact.distinct_facts(flights)
    moved = [line for line in plan_of(facts).split("\n") if "hashpartitioning(" in line]
    assert moved and not any("fact_key" in line for line in moved)
    assert rows(facts) == rows(fact.with_fact_key(flights).select(*fact.FACT_COLUMNS).distinct())
    # null keys match nothing, texts come back as they were.
    left = spark.createDataFrame([("a|b", 1), ("", 2), (None, 3)], "fact_key string, n int")
    right = spark.createDataFrame([("a|b", 7), ("", 8), (None, 9)], "fact_key string, id int")
    joined = fact._join_large(left, right, ["fact_key"])
    assert joined.columns == ["fact_key", "n", "id"]
    assert rows(joined, "n", "fact_key", "id") == [(1, "a|b", 7), (2, "", 8), (3, None, None)]


def test_hot_keys_are_found_without_a_shuffle_of_all_keys(spark):
    """as exact counting finds them."""
    keys = spark.range(20_000).select(
        F.when(F.col("id") % 5 == 0, "hot").when(F.col("id") % 9 == 0, "warm")
        .when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("fact_key"))
    assert rows(bucketed._hot_keys(keys, 16), "fact_key", "slices") == [("hot", 4), ("warm", 2)]
    assert "FrequentItems" in plan_of(bucketed._hot_keys(keys, 16)) or "frequent" in plan_of(
        bucketed._hot_keys(keys, 16)).lower()


def test_copies_of_hot_and_other_rows_collapse_in_buckets(spark, flights):
    """distinct rows, whether their key is hot, plain or missing."""
    one = flights.limit(1).crossJoin(spark.range(3000)).drop("id")
    keyless = one.withColumn("Origin", F.lit(None).cast("string"))
    source = flights.unionByName(flights).unionByName(one).unionByName(keyless)
    delay = spark.createDataFrame([], "fact_key string, delay_id long")
    cancel = spark.createDataFrame([], "fact_key string, cancellation_id long")
    bucketed.store_bucketed(source, delay, cancel, "copied_facts", "copied_events", buckets=8)
    stored = spark.table("copied_facts").select(*fact.FACT_COLUMNS)
    assert rows(stored) == rows(fact.distinct_facts(source))


def test_a_message_is_parsed_once(spark):
    """F10."""
    plan = plan_of(registry.ride_to_messages(spark, SMALL))
    assert plan.count("json_tuple(") <= 2 and "get_json_object" not in plan


def test_compaction_moves_no_rows(spark, tmp_path, monkeypatch):
    """a task reads the files whose rows it writes; shuffles of the wide rows filled the disk."""
    plans = []
    write, swap = DataFrameWriter.parquet, sink_files.swap_directory

    def recorded(self, path, *args, **options):
        plans.append(plan_of(self._df))
        return write(self, path, *args, **options)

    source, target = str(tmp_path / "many"), str(tmp_path / "few")
    made = spark.range(20_000).selectExpr("id", "uuid() AS text", "2000 + id % 2 AS Year",
                                          "1 + id % 3 AS Month")
    made.repartition(40).write.parquet(source)
    held = rows(spark.read.parquet(source))
    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    assert rows(sink_files.compact_parquet(spark, source, target, files=3)) == held
    assert len(matching_paths(spark, f"{target}/*.parquet")) == 3

    # Directories take the place of the old ones one by one, not all at the end.
    table, ready = str(tmp_path / "table"), []
    spark.read.parquet(source).repartition(5).write.partitionBy("Year", "Month").parquet(table)
    plans = plans[:1]
    monkeypatch.setattr(sink_files, "DIRECTORIES_AT_ONCE", 1)
    monkeypatch.setattr(sink_files, "swap_directory", lambda spark, staged, target: (
        ready.append(len(matching_paths(spark, f"{table}.compacting-*/Year=*/Month=*"))),
        swap(spark, staged, target)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert len(sink_files.compact_partitions(spark, table, ["text"])) == 6
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert ready == [1] * 6
    assert len(plans) == 7 and not any("Exchange" in plan for plan in plans)
    assert rows(spark.read.parquet(table), "id", "text", "Year", "Month") == held
    for path, _ in matching_paths(spark, f"{table}/Year=*/Month=*"):
        texts = [row.text for row in spark.read.parquet(path).collect()]
        assert texts == sorted(texts)
        assert len(matching_paths(spark, f"{path}/*")) == 1


def test_few_files_become_more_if_asked_for(spark, tmp_path):
    """with fewer parts than files, rows are moved as before."""
    source, target = str(tmp_path / "one"), str(tmp_path / "more")
    spark.range(1000).coalesce(1).write.parquet(source)
    assert sink_files.compact_parquet(spark, source, target, files=40).count() == 1000
    assert len(matching_paths(spark, f"{target}/*.parquet")) == 40


def test_compaction_keeps_key_values_as_they_are_spelled(spark, tmp_path):
    """01 is no number that has to come back; no key and several parts are kept, too."""
    table = str(tmp_path / "table")
    for folder in ("Year=01/kind=a b", "Year=02/kind=__HIVE_DEFAULT_PARTITION__"):
        spark.range(1000).repartition(9).write.parquet(f"{table}/{folder}")
    size = size_in_bytes(spark, f"{table}/Year=01") // 2
    done = sink_files.compact_partitions(spark, table, file_bytes=size)
    assert done == ["Year=01/kind=a b", "Year=02/kind=__HIVE_DEFAULT_PARTITION__"]
    read = spark.read.parquet(table)
    assert rows(read.groupBy("Year", "kind").count()) == [(1, "a b", 1000), (2, None, 1000)]
    assert 1 < len(matching_paths(spark, f"{table}/Year=01/kind=a b/*.parquet")) < 9


def test_built_inputs_are_not_moved_twice(spark, monkeypatch):
    """wide rows were dealt out by a shuffle of their own, above the joins."""
    plans, write = [], DataFrameWriter.parquet

    def recorded(self, path, *args, **options):
        plans.append(plan_of(self._df))
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    for query in (registry.compact_parquet, registry.compact_partitions):
        query(spark, SMALL)
    assert len(plans) > 2 and not any("RoundRobin" in plan for plan in plans)
    assert rows(views.flights_in_order(spark, SMALL, 8)) == rows(views.flights(spark, SMALL))
