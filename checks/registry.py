"""One entry per operator: (session, table folder) -> DataFrame."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from checks import views
from checks.sql import BAD_FLIGHT_NUMBER, CURATED
from skyledger.functions.flights import fact_key, hhmm_timestamp
from skyledger.functions.messages import flight_id, flight_id_by_number
from skyledger.operators import (
    analytics, cleaning, curate, dimensions, fact, profile, quality, sampling)
from skyledger.plans import bucketed, history, ledger
from skyledger.plans.report import report_results
from skyledger.schemas import FLAT_FLIGHT, RAW_FLIGHTS
from skyledger.sinks import files as sink_files
from skyledger.sinks.messages import flight_messages, normalise_payload, ride_messages
from skyledger.sources import files as source_files
from skyledger.sources import messages as source_messages
from skyledger.storage import (
    delete_path, matching_paths, materialise, move_path, scratch_path, shuffles_removed)
from skyledger.streaming import parse, sinks

Query = Callable[[SparkSession, str], DataFrame]

SAMPLED_YEAR = 1998
AS_OF = datetime.date(2001, 10, 15)


# ---- sources and sinks --------------------------------------------------------------------


def _csv_schema(df: DataFrame) -> StructType:
    calendar = {"Year", "Quarter", "Month", "DayofMonth", "DayOfWeek"}
    return StructType([df.schema[name] if name in calendar else RAW_FLIGHTS[name]
                       for name in df.columns])


def _write_csv(df: DataFrame) -> str:
    path = scratch_path(df.sparkSession, "csv")
    sink_files.export_csv(df, path)
    return path


def src_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = views.flights(spark, sf_dir)
    return source_files.read_csv(spark, _write_csv(flights), _csv_schema(flights),
                                 null_token=source_files.NO_NULL_TOKEN)


def sql_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_files.run_sql(
        spark,
        "SELECT Origin, count(*) AS flights FROM flights_raw WHERE Year = :year "
        "GROUP BY Origin ORDER BY Origin",
        {"flights_raw": views.flights(spark, sf_dir)}, {"year": SAMPLED_YEAR})


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "partitioned")
    flights = views.flights(spark, sf_dir)
    sink_files.write_partitioned(flights, path, ["Year", "Month"],
                                 ["Reporting_Airline", "Origin", "Dest"])
    return source_files.read_parquet(spark, path, flights.schema)


def compact_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = scratch_path(spark, "many-files")
    files = views.shares(spark, sf_dir, "lineitem", 16 << 20, least=32)
    # The wide rows are cut into files where they are made, not moved.
    share = -(-views.table(spark, sf_dir, "lineitem").count() // files)
    with shuffles_removed(spark):
        views.flights(spark, sf_dir).write.option("maxRecordsPerFile", max(share, 1)).option(
            "compression", "zstd").parquet(source)
    return sink_files.compact_parquet(spark, source, scratch_path(spark, "compact"), files=2)


def compact_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by year and month in many files, compacted: rows and one file for each directory,
    found by its key values."""
    path = scratch_path(spark, "many-files")
    files = views.shares(spark, sf_dir, "lineitem", 48 << 20, least=8)
    with shuffles_removed(spark):
        views.flights_in_order(spark, sf_dir, files).write.option("compression", "zstd").partitionBy(
            "Year", "Month").parquet(path)
    sink_files.compact_partitions(spark, path)
    return source_files.read_parquet(spark, path).filter(F.col("Year") == SAMPLED_YEAR).groupBy(
        "Year", "Month").agg(F.count("*").alias("rows"), F.sum("Distance").alias("distance"),
                             F.count_distinct(F.col("_metadata.file_path")).alias("files"))


def convert_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = views.flights(spark, sf_dir)
    target = scratch_path(spark, "converted")
    sink_files.convert_csv(spark, _write_csv(flights), target, _csv_schema(flights))
    return source_files.read_parquet(spark, target)


def _untyped_csv(spark: SparkSession, sf_dir: str) -> tuple[str, StructType]:
    flights = views.flights(spark, sf_dir)
    wrong = F.col("Flight_Number_Reporting_Airline") == BAD_FLIGHT_NUMBER
    text = flights.withColumn("Distance", F.when(wrong, "n/a").otherwise(
        F.col("Distance").cast("string")))
    return _write_csv(text), _csv_schema(flights)


def load_tolerant_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _untyped_csv(spark, sf_dir)
    return history.stage_csv(spark, path, schema).good


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _untyped_csv(spark, sf_dir)
    report = history.stage_csv(spark, path, schema).report()
    sizes = source_files.list_files(spark, f"{path}/*.csv").agg(F.sum("length").alias("listed_bytes"))
    files = source_files.list_files(spark, f"{path}/*.csv").count()
    return history.load_totals(report).crossJoin(sizes).select(
        (F.col("total_files") == files).alias("all_files"), "total_rows", "total_bad_rows",
        (F.col("total_bytes") == F.col("listed_bytes")).alias("all_bytes"))


def _written_lines(lines: DataFrame, header: list[str]) -> str:
    """``value`` as compressed CSV files, one for each task that has rows, with a header line."""
    path = scratch_path(lines.sparkSession, "lines")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    (lines.withColumn("first", first)
     .select(F.when(F.col("first"), F.concat(F.lit(",".join(header) + "\n"), "value"))
             .otherwise(F.col("value")).alias("value"))
     .write.option("compression", "gzip").text(path))
    return path


def _quoted_csv(spark: SparkSession, sf_dir: str, last: Column) -> tuple[str, StructType]:
    """Flights as CSV lines; ``last`` is the text of the last column, quotes and all."""
    flights = views.flights(spark, sf_dir)
    *others, end = flights.columns
    lines = flights.select(
        F.concat(F.to_csv(F.struct(*others)), F.lit(","), last).alias("value"))
    return _written_lines(lines, flights.columns), _csv_schema(flights)


def load_unclosed_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some lines open a quote in the last column that nothing closes: those are the bad rows."""
    end = views.flights(spark, sf_dir).columns[-1]
    wrong = F.col("Flight_Number_Reporting_Airline") == BAD_FLIGHT_NUMBER
    text = F.coalesce(F.col(end).cast("string"), F.lit(""))
    path, schema = _quoted_csv(spark, sf_dir, F.when(wrong, F.concat(F.lit('"9,a,'), text))
                               .otherwise(text))
    report = history.stage_csv(spark, path, schema).report()
    return history.load_totals(report).select("total_rows", "total_bad_rows")


def load_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some records have line breaks, a comma and a quote inside the quotes of the last column."""
    flights = views.flights(spark, sf_dir)
    broken = F.col("Flight_Number_Reporting_Airline") == BAD_FLIGHT_NUMBER
    text = F.coalesce(F.col(flights.columns[-1]).cast("string"), F.lit(""))
    path, schema = _quoted_csv(spark, sf_dir, F.when(broken, F.concat(
        F.lit('"a""'), text, F.lit(',\n2001,5\n'), text, F.lit('"'))).otherwise(text))
    as_text = StructType([*schema.fields[:-1], StructField(flights.columns[-1], StringType())])
    load = history.stage_csv(spark, path, as_text)
    tail = F.when(broken, F.col(flights.columns[-1]))
    return load.rows.groupBy(F.col("_bad_reason").isNull().alias("good")).agg(
        F.count("*").alias("rows"), F.sum("Distance").alias("distance"),
        F.count_if(tail.contains("\n2001,5\n")).alias("broken"))


def _monthly_folder(spark: SparkSession, sf_dir: str) -> tuple[str, StructType]:
    """Flights as compressed CSV below ``YYYY_MM.csv`` (a directory each, as a month may have several
    files)."""
    flights = views.flights_by_month(spark, sf_dir)
    root = scratch_path(spark, "monthly")
    name = F.format_string("%d_%02d.csv", "Year", "Month")
    (flights.withColumn("file", name).write.option("header", True).option("compression", "gzip")
     .partitionBy("file").csv(f"{root}/by-file"))
    folder = f"{root}/incoming"
    for month, _ in matching_paths(spark, f"{root}/by-file/file=*"):
        move_path(spark, month, f"{folder}/{month.rpartition('file=')[2]}")
    return folder, _csv_schema(flights)


def _loaded(spark: SparkSession, sf_dir: str, load: Callable, *period: int) -> DataFrame:
    folder, schema = _monthly_folder(spark, sf_dir)
    target = scratch_path(spark, "flights-raw")
    load(spark, folder, target, *period, schema=schema)
    return source_files.read_parquet(spark, target, schema)


def load_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, history.load_all)


def load_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, history.load_years, 1996, 1998, 6, 8)


def load_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir, history.load_month, SAMPLED_YEAR, 3)


def load_month_stray_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """May and June are loaded, then May once more from a file that also has some rows of June."""
    folder, schema = _monthly_folder(spark, sf_dir)
    target, again = scratch_path(spark, "flights-raw"), scratch_path(spark, "monthly")
    history.load_years(spark, folder, target, SAMPLED_YEAR, SAMPLED_YEAR, 5, 6, schema=schema)
    flights = sampling.year_filter(views.flights(spark, sf_dir), SAMPLED_YEAR)
    stray = (F.col("Month") == 6) & (F.col("Origin") == "A00")
    sink_files.export_csv(flights.filter((F.col("Month") == 5) | stray),
                          f"{again}/{SAMPLED_YEAR}_05.csv")
    strays = flights.filter(stray).count()
    history.load_month(spark, again, target, SAMPLED_YEAR, 5, schema=schema,
                       max_bad_records=strays)
    return source_files.read_parquet(spark, target, schema)


def _two_months(spark: SparkSession, sf_dir: str) -> tuple[str, str, StructType, DataFrame]:
    """(folder, table with May and June, schema, flights of the year)."""
    folder, schema = _monthly_folder(spark, sf_dir)
    target = scratch_path(spark, "flights-raw")
    history.load_years(spark, folder, target, SAMPLED_YEAR, SAMPLED_YEAR, 5, 6, schema=schema)
    return folder, target, schema, sampling.year_filter(views.flights(spark, sf_dir), SAMPLED_YEAR)


def _by_month(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    return source_files.read_parquet(spark, target, schema).groupBy("Year", "Month").agg(
        F.count("*").alias("rows"))


def load_years_missing_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year once more from a folder that has May alone, with some rows of June in it."""
    _, target, schema, flights = _two_months(spark, sf_dir)
    again = scratch_path(spark, "monthly")
    stray = (F.col("Month") == 6) & (F.col("Origin") == "A00")
    sink_files.export_csv(flights.filter((F.col("Month") == 5) | stray),
                          f"{again}/{SAMPLED_YEAR}_05.csv")
    report = history.load_years(spark, again, target, SAMPLED_YEAR, SAMPLED_YEAR, schema=schema,
                                max_bad_records=1 << 40)
    total = history.load_totals(report).select("total_rows", "total_bad_rows")
    return _by_month(spark, target, schema).crossJoin(total)


def load_month_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """May once more from a file that has a header and no rows."""
    _, target, schema, flights = _two_months(spark, sf_dir)
    again = scratch_path(spark, "monthly")
    sink_files.export_csv(flights.limit(0), f"{again}/{SAMPLED_YEAR}_05.csv")
    history.load_month(spark, again, target, SAMPLED_YEAR, 5, schema=schema)
    return _by_month(spark, target, schema)


def load_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three months in one batch, of which June is beyond the budget; then June is mended and the
    run repeated, which loads June alone."""
    folder, schema = _monthly_folder(spark, sf_dir)
    target, log = scratch_path(spark, "flights-raw"), scratch_path(spark, "ledger")
    june = f"{folder}/{SAMPLED_YEAR}_06.csv"
    aside = scratch_path(spark, "monthly")
    move_path(spark, june, aside)
    flights = sampling.year_filter(views.flights(spark, sf_dir), SAMPLED_YEAR)
    sink_files.export_csv(flights.where("Month = 6").withColumn("Distance", F.lit("far")), june)
    pattern = f"{folder}/{SAMPLED_YEAR}_0[567].csv"
    options = {"schema": schema, "max_bad_records": 0}
    ledger.load_batches(spark, pattern, target, log, **options)
    first = _by_month(spark, target, schema).withColumn("run", F.lit(1))
    first = materialise(first, "first-run")
    delete_path(spark, june)
    move_path(spark, aside, june)
    second = ledger.load_batches(spark, pattern, target, log, **options)
    rejected = ledger.rejected_rows(spark, log).agg(F.count("*").alias("rejected"))
    loaded = second.agg(F.count("*").alias("files"), F.sum("output_rows").alias("loaded"))
    return (first.unionByName(_by_month(spark, target, schema).withColumn("run", F.lit(2)))
            .crossJoin(rejected).crossJoin(loaded))


def dataset_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders", "events")}
    inventory = sink_files.table_inventory(spark, tables)
    return inventory.filter(F.col("num_bytes") > 0).select("table_name", "num_rows")


def catalog_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared tables, one filled in two loads, as the catalog and the files tell of them."""
    database = f"flights_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    tables = sink_files.create_tables(spark, database)
    flights = views.flights(spark, sf_dir).select(*[
        name for name in RAW_FLIGHTS.fieldNames() if name in CURATED])
    raw = f"{database}.flights_raw"
    for part in (F.col("Year") < SAMPLED_YEAR, F.col("Year") >= SAMPLED_YEAR):
        sink_files.append_to_table(flights.filter(part), raw)
    files = (spark.table(raw).select("_metadata.file_path", "_metadata.file_size").distinct()
             .agg(F.sum("file_size").alias("bytes")))
    distance = spark.table(raw).agg(F.sum("Distance").alias("distance"))
    inventory = sink_files.catalog_inventory(spark, tables)
    full = F.col("num_bytes") == F.col("bytes")
    return inventory.crossJoin(files).crossJoin(distance).select(
        F.substring_index("table_name", ".", -1).alias("table_name"), "num_rows", "partitioning",
        "clustering", F.when(F.col("num_rows") > 0, full).otherwise(F.col("num_bytes") == 0)
        .alias("all_bytes"), F.when(F.col("num_rows") > 0, F.col("distance")).alias("distance"))


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = analytics.delays_by_year(views.flights(spark, sf_dir))
    return source_files.read_csv(spark, _write_csv(result), result.schema)


def export_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = analytics.delays_by_year(views.flights(spark, sf_dir))
    path = scratch_path(spark, "json")
    sink_files.export_json(result, path)
    return spark.read.schema(result.schema).json(path)


def export_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    sink_files.export_parquet(analytics.delays_by_year(views.flights(spark, sf_dir)), path)
    return source_files.read_parquet(spark, path)


def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, observation = quality.counted(views.flights(spark, sf_dir), "written")
    sink_files.write_parquet(rows, scratch_path(spark, "observed"))
    return spark.createDataFrame([(observation.get["rows"],)], "rows long")


def to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = normalise_payload(views.status_flights(spark, sf_dir))
    return flight_messages(flights, keep_nulls=True).select("key", "value")


def payload_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = views.status_flights(spark, sf_dir)
    flight = F.struct(*[F.col(name) for name in status.columns])
    twice = F.col("flight.number").cast("int") % 3 == 0
    answers = status.select(F.when(twice, F.array(flight, flight)).otherwise(F.array(flight))
                            .alias("data"))
    path = scratch_path(spark, "payload")
    answers.write.json(path)
    return source_messages.read_payload(spark, path, multiline=False).select(
        "flight_date", "flight_status", F.col("departure.iata").alias("departure_iata"),
        F.col("departure.delay").alias("departure_delay"),
        F.col("flight.number").alias("flight_number"))


def payload_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_payload(views.status_flights(spark, sf_dir)).select(
        F.col("flight.number").alias("flight_number"),
        F.col("departure.delay").alias("departure_delay"),
        F.col("arrival.delay").alias("arrival_delay"),
        F.col("flight.codeshared").isNotNull().alias("has_codeshared"),
        F.col("flight.codeshared.flight_iata").alias("codeshared_iata"))


def _plain_numbers(rides: DataFrame) -> DataFrame:
    return rides.select(*[
        F.col(field.name).cast("double").alias(field.name)
        if field.dataType.typeName() == "decimal" else F.col(field.name)
        for field in rides.schema.fields])


def ride_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rides")
    (views.rides(spark, sf_dir).write.option("header", True)
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    return _plain_numbers(source_messages.read_rides(spark, path))


def ride_to_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One parse of a message for all of its fields.
    fields = F.json_tuple("value", "VendorID", "tpep_pickup_datetime", "DOLocationID", "total_amount")
    return ride_messages(views.rides(spark, sf_dir)).select("key", fields.alias(
        "vendor", "pickup", "dropoff_location", "total_amount")).withColumn(
            "total_amount", F.col("total_amount").cast("double"))


def ride_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_numbers(source_messages.decode_rides(ride_messages(views.rides(spark, sf_dir))))


# ---- star schema --------------------------------------------------------------------------


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_flights(views.flights(spark, sf_dir))


def _stored_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned flights as the star-schema jobs find them: a Parquet table."""
    return materialise(_cleaned(spark, sf_dir), "cleaned")


_JOINED_FLIGHT = ["fact_key", "Tail_Number", "CRSDepTime", "ArrTime"]


def _with_dim(name: str, join: Callable[[DataFrame, DataFrame], DataFrame],
              *keep: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        flights = _stored_flights(spark, sf_dir)
        dim = dimensions.DIMENSIONS[name](flights)
        keyed = fact.with_fact_key(flights)
        narrow = keyed.select(*dict.fromkeys(_JOINED_FLIGHT + list(keep)))
        return join(narrow, dim)

    return query


def _join_airline(flights: DataFrame, dim: DataFrame) -> DataFrame:
    return fact.join_airline(flights, dim).drop("DOT_ID_Reporting_Airline")


def _fact(build: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        flights = _stored_flights(spark, sf_dir)
        dims = {f"dim_{name}": dim for name, dim in dimensions.build_dims(flights).items()}
        return build(flights, **dims)

    return query


# ---- analyses and samples -----------------------------------------------------------------


def _on(view: Callable[[SparkSession, str], DataFrame],
        operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(view(spark, sf_dir))


def _on_flights(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _on(views.flights, operator)


def report_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for name, result in report_results(views.flights(spark, sf_dir)).items():
        total = {"table_info": "total_rows", "cancellation_analysis": "cancellation_count"}.get(
            name, "total_flights")
        parts.append(result.agg(F.count(F.lit(1)).alias("result_rows"),
                                F.sum(total).alias("flights"))
                     .select(F.lit(name).alias("analysis"), "result_rows", "flights"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def table_summary_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of the history without 1998, then 1998's with a third of June missing, then June
    again; merged by year. Aircraft, of which there are many, only as close enough or not."""
    flights, path = views.flights(spark, sf_dir), scratch_path(spark, "profiles")
    year = sampling.year_filter(flights, SAMPLED_YEAR)
    profile.update_profiles(flights.filter(F.col("Year") != SAMPLED_YEAR), path)
    profile.update_profiles(year.filter((F.col("Month") != 6) | (F.col("DayofMonth") > 10)), path)
    profile.update_profiles(year.filter(F.col("Month") == 6), path, [(SAMPLED_YEAR, 6)])
    merged = profile.merged_profile(profile.read_profiles(spark, path), "Year")
    exact = flights.groupBy("Year").agg(F.count_distinct("Tail_Number").alias("aircraft"))
    error = F.abs(F.col("unique_aircraft") / F.col("aircraft") - 1)
    return merged.join(exact, "Year").withColumn("aircraft_within_3_percent", error <= 0.03).drop(
        "unique_aircraft", "aircraft")


def block_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the directories of a table by year and month, drawn by their names."""
    path = scratch_path(spark, "partitioned")
    flights = views.flights(spark, sf_dir)
    sink_files.write_partitioned(flights, path, ["Year", "Month"])
    folder = F.regexp_extract("_metadata.file_path", "(Year=[^/]*/Month=[^/]*)/", 1)
    return sampling.block_sample(source_files.read_parquet(spark, path, flights.schema), 0.25,
                                 seed=7, block=folder)


def _null_profile(df: DataFrame) -> DataFrame:
    return quality.null_profile(df, [*quality.CHECKED_COLUMNS, "Dest", "DepTime", "ArrTime",
                                     "CancellationCode"])


def _draw() -> Column:
    """A draw that any engine can repeat: the hash of what identifies a flight."""
    parts = ["FlightDate", "Tail_Number", "Flight_Number_Reporting_Airline", "Origin", "Dest",
             "CRSDepTime"]
    return F.md5(F.concat_ws("|", *[F.col(name).cast("string") for name in parts]))


def _number_of(digest: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def _drawn_number() -> Column:
    return _number_of(_draw())


def _sampled_year(df: DataFrame) -> DataFrame:
    return sampling.random_sample(df, year=SAMPLED_YEAR, by=_draw())


def _clock(df: DataFrame) -> DataFrame:
    return df.select(
        "FlightDate", "CRSDepTime", "Tail_Number",
        hhmm_timestamp("FlightDate", "CRSDepTime").alias("departs"),
        hhmm_timestamp("FlightDate", "CRSDepTime", midnight_rollover=True)
        .alias("departs_rolled"))


# ---- messages and streams -----------------------------------------------------------------


def json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_messages(views.status_messages(spark, sf_dir)).select(
        "flight_id", "flight_date", "flight_status",
        F.col("departure.iata").alias("departure_iata"),
        F.col("arrival.iata").alias("arrival_iata"),
        F.col("arrival.baggage").alias("arrival_baggage"),
        F.col("flight.number").alias("flight_number"),
        F.col("flight.codeshared.flight_iata").alias("codeshared_flight_id"))


def _wide_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as the plain poller sends them: no key, nothing normalised."""
    texts = flight_messages(views.status_flights(spark, sf_dir))
    return texts.select(F.lit(None).cast("binary").alias("key"),
                        F.col("value").cast("binary").alias("value"))


def json_parse_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse.parse_wide_messages(_wide_messages(spark, sf_dir)).select(
        "flight_date", "flight_status", "dept_airport",
        F.col("departure.delay").alias("departure_delay"),
        F.col("flight.number").alias("flight_number"),
        F.col("flight.codeshared").alias("codeshared"))


def live_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = parse.flight_stream(views.status_messages(spark, sf_dir))
    return parse.live_flights(flat, received=F.col("departure_scheduled"))


# An archived file has the messages of so many bytes of stored events.
ARCHIVED_BYTES = 4 << 20


def _stream(spark: SparkSession, sf_dir: str, messages: DataFrame) -> DataFrame:
    """The messages through archived files, in two batches or, with many files, in batches of twice
    as many as there are cores."""
    files = views.shares(spark, sf_dir, "events", ARCHIVED_BYTES, least=4)
    path = scratch_path(spark, "topic")
    messages.repartition(files).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return source_messages.message_files(
        spark, path, max_files_per_trigger=min(-(-files // 2), 2 * max(cores, 1)))


def _through_files(spark: SparkSession, stream: DataFrame, **layout: str | None) -> DataFrame:
    out = scratch_path(spark, "stream")
    sinks.file_sink(stream, out, scratch_path(spark, "stream-log"), trigger="available",
                    **layout).start().awaitTermination()
    return spark.read.schema(FLAT_FLIGHT).parquet(out)


def stream_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.status_messages(spark, sf_dir)
    return _through_files(spark, parse.flight_stream(_stream(spark, sf_dir, messages)),
                          partition_by=None)


def stream_parquet_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.status_messages(spark, sf_dir)
    return _through_files(spark, parse.flight_stream(_stream(spark, sf_dir, messages)))


def _through_batches(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out = scratch_path(spark, "stream")
    sinks.batch_sink(stream, sinks.replayable_batch_writer(out),
                     scratch_path(spark, "stream-log"),
                     trigger="available").start().awaitTermination()
    return sinks.read_batches(spark, out)


def stream_foreach_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.status_messages(spark, sf_dir)
    return _through_batches(spark, parse.flight_stream(_stream(spark, sf_dir, messages)))


def stream_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = parse.parse_wide_messages(_stream(spark, sf_dir, _wide_messages(spark, sf_dir)))
    return _through_batches(spark, wide).select(
        "flight_date", "flight_status", "dept_airport",
        F.col("arrival.delay").alias("arrival_delay"))


def stream_dual_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = parse.flight_stream(_stream(spark, sf_dir, views.status_messages(spark, sf_dir)))
    files, copy = scratch_path(spark, "stream"), scratch_path(spark, "stream")
    for query in sinks.start_dual_sink(
            flat, files, scratch_path(spark, "stream-log"), copy,
            scratch_path(spark, "stream-log"), trigger="available"):
        query.awaitTermination()
    stored = (spark.read.schema(FLAT_FLIGHT).parquet(files).withColumn("sink", F.lit("files"))
              .unionByName(sinks.read_batches(spark, copy).withColumn("sink", F.lit("copy"))))
    return stored.groupBy("sink", "flight_date").agg(F.count(F.lit(1)).alias("rows"))


def stream_dual_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read for both sinks. The second sink fails once, in the second batch, after the first
    sink has committed it; the query is started again and both hold every row once."""
    stream = _stream(spark, sf_dir, views.status_messages(spark, sf_dir))
    files, copy, log, markers = (scratch_path(spark, label) for label in
                                 ("stream", "stream", "stream-log", "markers"))
    calls = []
    second = sinks.parquet_target(copy)

    def failing(batch: DataFrame, name: str) -> None:
        calls.append(name)
        if len(calls) == 2:
            raise OSError("the second sink is away")
        second(batch, name)

    write = sinks.dual_batch_writer(
        {"files": sinks.parquet_target(files, sinks.PARTITION_BY), "copy": failing}, markers)

    def drain() -> None:
        sinks.batch_sink(parse.flight_stream(stream), write, log,
                         trigger="available").start().awaitTermination()

    try:
        drain()
    except StreamingQueryException:
        drain()
    stored, copied = (sinks.read_batches(spark, path, FLAT_FLIGHT) for path in (files, copy))
    return stored.withColumn("sink", F.lit("files")).unionByName(
        copied.withColumn("sink", F.lit("copy")))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the messages, a stop, the other half, and one run with nothing new."""
    messages = materialise(views.status_messages(spark, sf_dir), "messages")
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    topic, out, log = (scratch_path(spark, label) for label in ("topic", "stream", "stream-log"))

    def drain() -> None:
        flat = parse.flight_stream(source_messages.message_files(spark, topic))
        sinks.file_sink(flat, out, log, trigger="available").start().awaitTermination()

    messages.filter(first).write.parquet(topic)
    drain()
    messages.filter(~first).write.mode("append").parquet(topic)
    drain()
    drain()
    return spark.read.schema(FLAT_FLIGHT).parquet(out).select("flight_id", "flight_status")


def stream_two_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the messages through one query, the others through a second one with a checkpoint
    of its own, into the same place."""
    messages = materialise(views.status_messages(spark, sf_dir), "messages")
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    out = scratch_path(spark, "stream")
    for half in (messages.filter(first), messages.filter(~first)):
        sinks.batch_sink(parse.flight_stream(_stream(spark, sf_dir, half)),
                         sinks.replayable_batch_writer(out), scratch_path(spark, "stream-log"),
                         trigger="available").start().awaitTermination()
    return sinks.read_batches(spark, out).select("flight_id", "flight_status")


# ---- registry -----------------------------------------------------------------------------


def queries() -> dict[str, Query]:
    untidy, copies = views.untidy_flights, views.flights_with_copies
    return {
        "src_csv_roundtrip": src_csv_roundtrip,
        "sql_passthrough": sql_passthrough,
        "partitioned_roundtrip": partitioned_roundtrip,
        "compact_parquet": compact_parquet,
        "compact_partitions": compact_partitions,
        "convert_csv": convert_csv,
        "load_tolerant_csv": load_tolerant_csv,
        "load_report": load_report,
        "load_all": load_all,
        "load_years": load_years,
        "load_month": load_month,
        "load_month_stray_rows": load_month_stray_rows,
        "load_unclosed_quote": load_unclosed_quote,
        "load_quoted_breaks": load_quoted_breaks,
        "load_years_missing_file": load_years_missing_file,
        "load_month_emptied": load_month_emptied,
        "load_batches": load_batches,
        "dataset_summary": dataset_summary,
        "catalog_summary": catalog_summary,
        "export_roundtrip": export_roundtrip,
        "export_json_roundtrip": export_json_roundtrip,
        "export_parquet_roundtrip": export_parquet_roundtrip,
        "observed_counts": observed_counts,
        "to_messages": to_messages,
        "payload_explode": payload_explode,
        "payload_normalise": payload_normalise,
        "ride_read": ride_read,
        "ride_to_messages": ride_to_messages,
        "ride_decode": ride_decode,

        "clean_flights": _cleaned,
        "cancellation_code_norm": _on_flights(cleaning.normalise_cancellation_code),
        "trim_strings": _on(untidy, cleaning.trim_strings),
        "dropna_critical": _on(untidy, cleaning.drop_missing_critical),
        "clean_flights_dedup": _on(untidy, cleaning.clean_flights_dedup),
        "distinct_rows": _on(copies, cleaning.distinct_rows),
        "data_quality": _on(untidy, _null_profile),
        "hhmm_timestamp": _on_flights(_clock),
        "bi_flights": _on_flights(curate.bi_flights),
        "fact_key": _on(untidy, lambda df: df.select("Tail_Number", "CRSDepTime",
                                                     fact_key().alias("fact_key"))),
        "fact_flights_projection": _on_flights(fact.fact_flights_projection),
        "daily_mart": _on_flights(curate.daily_mart),
        "route_frequency": _on_flights(curate.route_frequency),

        "dim_time": _on(_cleaned, dimensions.dim_time),
        "dim_airports": _on(_cleaned, dimensions.dim_airports),
        "dim_airlines": _on(_cleaned, dimensions.dim_airlines),
        "dim_delays": _on(_cleaned, dimensions.dim_delays),
        "dim_cancellations": _on(_cleaned, dimensions.dim_cancellations),
        "join_dim_time": _with_dim("time", fact.join_time, "FlightDate"),
        "join_airport_roles": _with_dim("airport", fact.join_airports, "OriginAirportID",
                                        "DestAirportID"),
        "join_dim_airline": _with_dim("airline", _join_airline, "IATA_CODE_Reporting_Airline",
                                      "DOT_ID_Reporting_Airline"),
        "join_dim_delay": _with_dim("delay", fact.join_delay),
        "join_dim_cancel": _with_dim("cancel", fact.join_cancellation),
        "fact_table": _fact(fact.fact_table),
        "fact_table_smj": _fact(fact.fact_table_hinted),
        "fact_table_with_ids": _fact(fact.fact_table_with_ids),
        "fact_table_bucketed": _fact(bucketed.fact_table_bucketed),

        "table_info": _on_flights(analytics.table_info),
        "table_summary": _on_flights(analytics.table_summary),
        "delays_by_year": _on_flights(analytics.delays_by_year),
        "top_airlines": _on_flights(analytics.top_airlines),
        "top_routes": _on_flights(analytics.top_routes),
        "monthly_trends": _on_flights(analytics.monthly_trends),
        "day_of_week": _on_flights(analytics.day_of_week),
        "cancellation_analysis": _on_flights(analytics.cancellation_analysis),
        "cancellation_rate_by_year": _on_flights(analytics.cancellation_rate_by_year),
        "cancellation_rate_by_month": _on_flights(analytics.cancellation_rate_by_month),
        "cancellation_rate_by_dow": _on_flights(analytics.cancellation_rate_by_dow),
        "dow_vs_mean": _on_flights(analytics.dow_vs_mean),
        "report_outputs": report_outputs,

        "table_summary_merged": table_summary_merged,
        "block_sample": block_sample,
        "year_filter": _on_flights(lambda df: sampling.year_filter(df, SAMPLED_YEAR)),
        "recent_data": _on_flights(lambda df: sampling.recent_data(df, as_of=AS_OF)),
        "specific_routes": _on_flights(
            lambda df: sampling.specific_routes(df, ["A00", "A03"], ["A01", "A07"])),
        "airlines_sample": _on_flights(
            lambda df: sampling.airlines_sample(df, ["C01", "C05", "C24"], by=_draw())),
        "random_sample_year": _on_flights(_sampled_year),
        "sample_stats": _on_flights(lambda df: sampling.sample_stats(_sampled_year(df))),
        "table_sample": _on_flights(lambda df: sampling.table_sample(df, seed=7)),
        "weighted_route_sample": _on_flights(
            lambda df: sampling.weighted_sample(curate.route_frequency(df), "count", 5, seed=7)),

        "table_sample_drawn": _on_flights(
            lambda df: sampling.table_sample(df, by=_drawn_number())),
        "weighted_route_sample_drawn": _on_flights(lambda df: sampling.weighted_sample(
            curate.route_frequency(df), "count", 5,
            by=_number_of(F.md5(F.concat_ws("|", F.lit("7"), "Origin", "Dest"))))),

        "rt_flight_id": _on(views.status_flights, lambda df: df.select(
            flight_id().alias("flight_id"), F.col("flight.number").alias("flight_number"))),
        "rt_flight_id_alt": _on(views.status_flights, lambda df: df.select(
            flight_id_by_number().alias("flight_id"))),
        "json_parse": json_parse,
        "json_parse_wide": json_parse_wide,
        "flatten_flight": _on(views.status_messages, parse.flight_stream),
        "live_flights": live_flights,
        "stream_flatten": stream_flatten,
        "stream_parquet_sink": stream_parquet_sink,
        "stream_foreach_batch": stream_foreach_batch,
        "stream_wide": stream_wide,
        "stream_dual_sink": stream_dual_sink,
        "stream_dual_replayed": stream_dual_replayed,
        "stream_restart": stream_restart,
        "stream_two_checkpoints": stream_two_checkpoints,
    }
