from __future__ import annotations

import datetime
import json

import pytest
from pyspark.sql import functions as F

from skyledger.functions.messages import flight_id, flight_id_by_number
from skyledger.schemas import FLAT_FLIGHT, LIVE_FLIGHTS
from skyledger.sinks import messages as out
from skyledger.sources import messages as source
from skyledger.streaming import parse, sinks
from tests.conftest import rows

FLIGHT = {
    "flight_date": "2024-11-22", "flight_status": "landed",
    "departure": {"iata": "LHR", "delay": 12, "scheduled": "2024-11-22T14:30:00Z"},
    "arrival": {"iata": "JFK", "delay": None, "baggage": "12",
                "scheduled": "2024-11-22T18:30:00+01:00", "actual": "soon"},
    "airline": {"name": "An Airline", "iata": "XX"},
    "flight": {"number": "123", "iata": "XX123", "codeshared": None},
}


def messages(spark, *pairs):
    df = spark.createDataFrame(list(pairs), "key string, value string")
    return df.select(F.col("key").cast("binary"), F.col("value").cast("binary"))


def text(**changes):
    return json.dumps({**FLIGHT, **changes})


@pytest.fixture
def payload(spark, tmp_path):
    bare = {"flight_date": None, "departure": None, "flight": {"number": None}}
    (tmp_path / "answer.json").write_text(json.dumps({"data": [FLIGHT, bare]}, indent=1))
    return source.read_payload(spark, str(tmp_path))


def test_payload_and_ids(payload):
    assert rows(payload.select(flight_id(), flight_id_by_number())) == [
        ("2024-11-22_XX123_LHR_JFK", "2024-11-22_123_2024-11-22T14:30:00Z"), ("___", "__")]


def test_normalised_payload(payload):
    done = out.normalise_payload(payload)
    assert done.filter("flight.codeshared IS NULL").count() == 0
    assert sorted(row[0] or "" for row in done.select("departure.delay").collect()) == ["", "12"]
    (message,) = [row for row in out.flight_messages(done).collect() if "LHR" in row["key"]]
    assert json.loads(message["key"]) == {"flight_id": "2024-11-22_XX123_LHR_JFK"}
    value = json.loads(message["value"])
    assert value["flight"]["codeshared"] == {} and value["departure"]["delay"] == "12"
    (header,) = message["headers"]
    assert header["key"] == "correlation_id" and len(header["value"]) == 36


def test_null_value_stays_null(spark):
    df = spark.sql("SELECT 1 AS k, CAST(NULL AS STRUCT<a: INT>) AS v")
    row = out.to_messages(df, F.col("k"), F.col("v")).first()
    assert row["key"] == "1" and row["value"] is None


def test_parsing_odd_messages(spark):
    df = messages(
        spark,
        (json.dumps({"flight_id": "good"}), text()),
        (str({"flight_id": "single quotes"}), text(flight={"number": "9", "codeshared": {}})),
        (json.dumps({"flight_id": "shared"}),
         text(flight={"codeshared": {"flight_iata": "YY9"}}, departure={"delay": "abc"})),
        (json.dumps({"flight_id": "broken"}), "{not json"),
        (json.dumps({"flight_id": "empty"}), None),
        (None, text(departure=None)),
    )
    flat = parse.flight_stream(df)
    assert [field.name for field in flat.schema] == FLAT_FLIGHT.fieldNames()
    assert [field.dataType for field in flat.schema] == [f.dataType for f in FLAT_FLIGHT]
    assert rows(flat, "flight_id", "departure_delay", "codeshared_flight_id", "arrival_iata") == [
        ("broken", None, None, None), ("empty", None, None, None), ("good", 12, None, "JFK"),
        ("shared", None, "YY9", "JFK"), ("single quotes", 12, None, "JFK"),
        (None, None, None, "JFK")]
    good = flat.filter("flight_id = 'good'").first()
    assert good["departure_scheduled"] == datetime.datetime(2024, 11, 22, 14, 30)
    assert good["arrival_scheduled"] == datetime.datetime(2024, 11, 22, 17, 30)
    assert good["arrival_actual"] is None
    assert rows(parse.dead_letters(df), "value") == [("{not json",)]


def test_live_rows(spark):
    df = messages(spark, (json.dumps({"flight_id": "a"}), text()), (None, text()))
    live = parse.live_flights(parse.flight_stream(df))
    assert [(f.name, f.dataType) for f in live.schema] == [
        (f.name, f.dataType) for f in LIVE_FLIGHTS]
    assert rows(live, "flight_id", "origin", "latitude") == [("a", "LHR", None)]


def test_wide_variant(spark):
    flight = {"codeshared": {"flight_iata": "YY9"}}
    df = messages(spark, (None, text(
        flight=flight, departure={"airport": "Home", "delay": 5}, aircraft={"icao24": "abc"},
        live={"altitude": 1000})), (None, "oops"))
    wide = parse.parse_wide_messages(df)
    row = wide.filter("flight_date IS NOT NULL").first()
    assert row["dept_airport"] == "Home" and row["departure"]["delay"] == 5
    assert json.loads(row["flight"]["codeshared"]) == flight["codeshared"]
    assert json.loads(row["live"]) == {"altitude": 1000}
    assert wide.count() == 2


def test_rides(spark, tmp_path):
    (tmp_path / "rides.csv").write_text(
        "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,"
        "RatecodeID,store_and_fwd_flag,PULocationID,DOLocationID,payment_type,fare_amount,extra,"
        "mta_tax,tip_amount,tolls_amount,improvement_surcharge,total_amount,"
        "congestion_surcharge\n"
        "2,2021-05-01 10:00:00,2021-05-01 10:20:30,1,2.50,1,N,42,7,2,8,0.5,0.5,0,0,0.3,9.3,0\n")
    rides = source.read_rides(spark, str(tmp_path / "rides.csv"))
    sent = out.ride_messages(rides)
    value = json.loads(sent.first()["value"])
    assert sent.first()["key"] == "42" and value["tpep_dropoff_datetime"] == "2021-05-01 10:20:30"
    back = source.decode_rides(sent)
    assert back.drop("key").exceptAll(rides).count() == 0 and back.first()["key"] == 42
    strange = source.decode_rides(messages(spark, ("x", "{}"), ("5", None)))
    assert rows(strange, "key", "VendorID") == [(5, None), (None, None)]


def test_decoded_text(spark):
    assert rows(source.decode_text(messages(spark, ("k", "v")))) == [("k", "v")]
    assert json.loads(out.unkeyed_messages(spark.range(1)).first()["value"]) == {"id": 0}


# ---- streams ------------------------------------------------------------------------------


@pytest.fixture
def topic(spark, tmp_path):
    path = str(tmp_path / "topic")

    def add(*names):
        pairs = [(json.dumps({"flight_id": name}), text(flight_date=f"2024-11-{day + 1:02d}"))
                 for day, name in enumerate(names)]
        messages(spark, *pairs).write.mode("append").parquet(path)

    add("a", "b", "c")
    return path, add


def drain(writer):
    writer.start().awaitTermination()


def test_restart_continues_where_it_stopped(spark, tmp_path, topic):
    path, add = topic
    stored, log = str(tmp_path / "out"), str(tmp_path / "log")

    def run():
        flat = parse.flight_stream(source.message_files(spark, path))
        assert flat.isStreaming
        drain(sinks.file_sink(flat, stored, log, trigger="available"))
        return [row[0] for row in rows(spark.read.parquet(stored), "flight_id")]

    assert run() == ["a", "b", "c"]
    assert run() == ["a", "b", "c"]
    add("d")
    assert run() == ["a", "b", "c", "d"]
    assert (tmp_path / "out" / "flight_date=2024-11-03").is_dir()


@pytest.fixture
def in_query(spark):
    """As within foreachBatch of a query."""
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    yield
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def test_replayed_batch_is_stored_once(spark, tmp_path, in_query):
    write = sinks.replayable_batch_writer(str(tmp_path / "out"))
    batch = spark.range(5)
    write(batch, 0)
    write(batch, 0)
    write(spark.range(2), 1)
    assert sinks.read_batches(spark, str(tmp_path / "out")).count() == 7


def test_a_batch_of_no_query_has_no_name(spark, tmp_path):
    with pytest.raises(RuntimeError, match="foreachBatch"):
        sinks.replayable_batch_writer(str(tmp_path / "out"))(spark.range(5), 0)


def test_dual_writer_repairs_the_target_that_failed(spark, tmp_path, in_query):
    """The second target breaks half-way; on replay it alone is written, and a third time none."""
    out, written = str(tmp_path / "second"), []
    store = sinks.parquet_target(out)

    def first(batch, name):
        written.append(("first", name, batch.count()))

    def second(batch, name):
        written.append(("second", name, batch.count()))
        store(batch.limit(2) if len(written) == 2 else batch, name)
        if len(written) == 2:
            raise OSError("away")

    write = sinks.dual_batch_writer({"first": first, "second": second}, str(tmp_path / "marks"))
    with pytest.raises(OSError, match="away"):
        write(spark.range(5), 0)
    write(spark.range(5), 0)
    write(spark.range(5), 0)
    write(spark.range(3), 1)
    assert written == [("first", "q-0", 5), ("second", "q-0", 5), ("second", "q-0", 5),
                       ("first", "q-1", 3), ("second", "q-1", 3)]
    assert sinks.read_batches(spark, out).count() == 8


def test_dual_sink_reads_the_stream_once(spark, tmp_path, topic):
    path, add = topic
    places = [str(tmp_path / name) for name in ("files", "copy", "markers", "log")]

    def run():
        flat = parse.flight_stream(source.message_files(spark, path))
        query = sinks.dual_sink(flat, *places, trigger="available").start()
        query.awaitTermination()
        files, copy = (sinks.read_batches(spark, place, FLAT_FLIGHT) for place in places[:2])
        assert files.exceptAll(copy.select(*files.columns)).count() == 0
        return files.count(), copy.count(), sum(p["numInputRows"] for p in query.recentProgress)

    assert run() == (3, 3, 3)
    add("d")
    assert run() == (4, 4, 1)


def test_a_second_checkpoint_keeps_stored_batches(spark, tmp_path):
    """100 rows stored, then a query with a checkpoint of its own adds 7."""
    out = str(tmp_path / "out")
    for name, rows in (("first", 100), ("second", 7)):
        spark.range(rows).write.parquet(str(tmp_path / name))
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / name))
        for _ in range(2):
            sinks.batch_sink(stream, sinks.replayable_batch_writer(out), str(tmp_path / f"log-{name}"),
                             trigger="available").start().awaitTermination()
    assert sinks.read_batches(spark, out).count() == 107


def test_dual_sink_has_two_checkpoints(spark, tmp_path, topic):
    path, _ = topic
    flat = parse.flight_stream(source.message_files(spark, path, max_files_per_trigger=1))
    places = [str(tmp_path / name) for name in ("files", "log1", "copy", "log2")]
    for query in sinks.start_dual_sink(flat, *places, trigger="available"):
        query.awaitTermination()
    files = spark.read.schema(FLAT_FLIGHT).parquet(places[0])
    copy = sinks.read_batches(spark, places[2])
    assert files.exceptAll(copy.select(*files.columns)).count() == 0 and files.count() == 3


def test_interval_trigger_and_table_sink(spark, tmp_path, topic):
    path, _ = topic
    flat = parse.flight_stream(source.message_files(spark, path))
    query = sinks.table_sink(flat, str(tmp_path / "log"), trigger="1 second",
                             path=str(tmp_path / "out")).start()
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_missing_connector_is_reported(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        source.topic_stream(spark, "nowhere:9092", "flights")
