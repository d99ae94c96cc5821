"""Flight-shaped views over the shared test tables.

Line items joined with their orders and suppliers play the flights; events play the
flight-status messages. ``checks.sql`` states the same views in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sinks.messages import flight_messages, normalise_payload
from skyledger.storage import size_in_bytes


# Below this size a table is spread over all cores after the scan: the test tables hold a single
# row group each, which one task reads however many cores there are. A task gets a bounded share.
SMALL_TABLE, TASK_BYTES = 1 << 30, 8 << 20


def shares(spark: SparkSession, sf_dir: str, name: str, share_bytes: int, least: int) -> int:
    """Into how many parts of ``share_bytes`` a stored table falls, ``least`` at least."""
    return max(least, -(-size_in_bytes(spark, f"{sf_dir}/{name}.parquet") // share_bytes))


def table(spark: SparkSession, sf_dir: str, name: str, key: str | None = None,
          least: int = 1) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    rows = spark.read.parquet(path)
    if key and size_in_bytes(spark, path) < SMALL_TABLE:
        least = max(least, spark.sparkContext.defaultParallelism)
        return rows.repartition(shares(spark, sf_dir, name, TASK_BYTES, least), key)
    return rows


def _line_items(spark: SparkSession, sf_dir: str, least: int = 1) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        table(spark, sf_dir, "lineitem", "l_orderkey", least)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    )


def _two_digits(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), 2, "0"))


def _airport(role: str, number: str) -> list[str]:
    return [
        f"10000 + {number} AS {role}AirportID",
        f"concat('A', lpad(string({number}), 2, '0')) AS {role}",
        f"concat('City', string({number})) AS {role}CityName",
        f"concat('S', string({number} % 5)) AS {role}State",
        f"{number} % 5 AS {role}StateFips",
        f"concat('State', string({number} % 5)) AS {role}StateName",
    ]


# Expressions in text form: Python builds a few column objects per query, not hundreds.
_MARKED = [
    "l_partkey AS part", "l_orderkey AS order", "l_linenumber AS line", "l_suppkey AS supplier",
    "o_custkey AS customer", "s_nationkey AS nation", "l_linestatus", "l_quantity",
    "date(l_shipdate) AS date",
    "l_returnflag = 'R' AND l_partkey % 10 = 0 AS cancelled",
    "concat('C', lpad(string(s_nationkey), 2, '0')) AS airline",
    "l_suppkey % 12 AS origin", "o_custkey % 12 AS dest",
]
_DELAYED = [
    "NOT cancelled AND l_linestatus = 'F' AND part % 50 = 1 AS diverted",
    "CASE WHEN NOT cancelled THEN l_quantity - 20 END AS delay",
]
_FLIGHT = [
    "date AS FlightDate",
    "year(date) AS Year", "quarter(date) AS Quarter", "month(date) AS Month",
    "day(date) AS DayofMonth", "weekday(date) + 1 AS DayOfWeek",
    "airline AS Reporting_Airline", "airline AS IATA_CODE_Reporting_Airline",
    "bigint(19000 + nation) AS DOT_ID_Reporting_Airline",
    "concat('N', string(part)) AS Tail_Number",
    "order % 1000 AS Flight_Number_Reporting_Airline",
    *_airport("Origin", "origin"),
    *_airport("Dest", "dest"),
    "part % 25 * 100 + order % 60 AS CRSDepTime",
    "CASE WHEN NOT cancelled THEN part % 24 * 100 + order % 60 END AS DepTime",
    "part % 22 * 100 + line AS CRSArrTime",
    "CASE WHEN NOT cancelled AND (diverted OR part % 97 <> 3) "
    "THEN part % 23 * 100 + line END AS ArrTime",
    "delay AS DepDelay",
    "CASE WHEN NOT diverted THEN delay + line - 4 END AS ArrDelay",
    "CASE WHEN NOT cancelled THEN CASE WHEN delay >= 15 THEN 1D ELSE 0D END END AS DepDel15",
    "CASE WHEN cancelled THEN 1D ELSE 0D END AS Cancelled",
    "CASE WHEN diverted THEN 1D ELSE 0D END AS Diverted",
    "CASE WHEN cancelled THEN get(array('', 'A', 'B', 'C', 'D'), int(supplier % 5)) END "
    "AS CancellationCode",
    "distance AS Distance", "round(distance / 8) AS AirTime",
    *[f"CASE WHEN late THEN double({minutes}) END AS {name}" for name, minutes in [
        ("CarrierDelay", "part % 30"), ("WeatherDelay", "supplier % 7"),
        ("NASDelay", "order % 13"), ("SecurityDelay", "line % 2"),
        ("LateAircraftDelay", "customer % 17")]],
]


def _flights_of(lines: DataFrame) -> DataFrame:
    return _flights_of_marked(lines.selectExpr(*_MARKED))


def _flights_of_marked(marked: DataFrame) -> DataFrame:
    return (
        marked.selectExpr("*", *_DELAYED)
        .selectExpr("*", "date >= DATE '1998-01-01' AND delay >= 15 AS late",
                    "double(200 + origin * 150 + dest * 10) AS distance")
        .selectExpr(*_FLIGHT)
    )


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flights_of(_line_items(spark, sf_dir))


def flights_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights, those of a month together: the narrow lines move, not the wide flights."""
    marked = _line_items(spark, sf_dir).selectExpr(*_MARKED)
    month = F.date_trunc("month", "date")
    return _flights_of_marked(marked.withColumn("month", month).hint("rebalance", F.col("month")))


def flights_in_order(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    """The flights in so many parts, each by year and month: the narrow lines are sorted, not the wide
    flights, and none is moved. A large table may come in fewer parts from its joins."""
    marked = _line_items(spark, sf_dir, parts).selectExpr(*_MARKED).coalesce(parts)
    return _flights_of_marked(marked.sortWithinPartitions(F.year("date"), F.month("date")))


def _with_copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = _line_items(spark, sf_dir)
    return _flights_of(lines), _flights_of(lines.filter(F.col("l_linenumber") == 1))


def flights_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flights, and those with line number 1 once more."""
    every, copies = _with_copies(spark, sf_dir)
    return every.unionByName(copies)


def untidy_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, but the copies have padded city names and some flights lack a destination."""
    every, copies = _with_copies(spark, sf_dir)
    padded = F.concat(F.lit("  "), F.col("OriginCityName"), F.lit(" "))
    both = every.unionByName(copies.withColumn("OriginCityName", padded))
    known = F.col("CRSDepTime") % 7 != 0
    return both.withColumn("Dest", F.when(known, F.col("Dest")))


def status_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as nested flight-status records (delays are numbers, as the service sends them)."""
    event, user = F.col("event_id"), F.col("user_id")
    clock = F.col("ts").cast("timestamp")
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    nothing = F.lit(None).cast("string")

    def stop(number: Column, delay: Column, scheduled: Column, arrival: bool) -> Column:
        code = _two_digits("A", number)
        return F.struct(
            F.concat(F.lit("Airport "), code).alias("airport"),
            F.lit("UTC").alias("timezone"),
            code.alias("iata"),
            F.concat(F.lit("K"), code).alias("icao"),
            (number % 4).cast("string").alias("terminal"),
            F.when(event % 3 != 0, F.concat(F.lit("G"), (event % 40).cast("string")))
            .alias("gate"),
            *([(event % 9).cast("string").alias("baggage")] if arrival else []),
            delay.alias("delay"),
            F.date_format(scheduled, iso).alias("scheduled"),
            F.date_format(scheduled, iso).alias("estimated"),
            F.when(event % 2 == 0, F.date_format(scheduled, iso)).alias("actual"),
            nothing.alias("estimated_runway"),
            nothing.alias("actual_runway"),
        )

    shared = F.when(event % 5 == 0, F.struct(
        F.lit("Partner").alias("airline_name"),
        F.lit("PX").alias("airline_iata"),
        F.lit("PXX").alias("airline_icao"),
        (event % 500).cast("string").alias("flight_number"),
        F.concat(F.lit("PX"), (event % 500).cast("string")).alias("flight_iata"),
        F.concat(F.lit("PXX"), (event % 500).cast("string")).alias("flight_icao"),
    ))
    number = (event % 900).cast("string")
    delay = F.col("value").cast("int")
    return table(spark, sf_dir, "events", "event_id").select(
        F.date_format(clock, "yyyy-MM-dd").alias("flight_date"),
        F.col("event_type").alias("flight_status"),
        stop(user % 12, F.when(event % 4 != 0, delay), clock, arrival=False).alias("departure"),
        stop(event % 12, F.when(event % 6 != 0, delay), clock + F.expr("INTERVAL 2 HOURS"),
             arrival=True).alias("arrival"),
        F.struct(F.concat(F.lit("Airline "), (user % 20).cast("string")).alias("name"),
                 _two_digits("C", user % 20).alias("iata"),
                 F.concat(F.lit("I"), _two_digits("C", user % 20)).alias("icao"))
        .alias("airline"),
        F.struct(number.alias("number"),
                 F.when(event % 11 != 0, F.concat(_two_digits("C", user % 20), number))
                 .alias("iata"),
                 F.concat(F.lit("I"), number).alias("icao"),
                 shared.alias("codeshared")).alias("flight"),
    )


def status_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, value) of those records as a topic would hand them out: binary JSON."""
    texts = flight_messages(normalise_payload(status_flights(spark, sf_dir)))
    return texts.select(F.col("key").cast("binary").alias("key"),
                        F.col("value").cast("binary").alias("value"))


def rides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their line items as taxi rides (amounts with two decimals)."""
    lines = _line_items(spark, sf_dir)
    pickup = F.col("l_shipdate").cast("timestamp")
    minutes = (F.col("l_partkey") % 50).cast("int")

    def money(column: Column) -> Column:
        return column.cast("decimal(10,2)")

    return lines.select(
        (F.col("l_suppkey") % 2 + 1).cast("string").alias("VendorID"),
        pickup.alias("tpep_pickup_datetime"),
        (pickup + F.make_dt_interval(mins=minutes)).alias("tpep_dropoff_datetime"),
        (F.col("l_linenumber") % 5).cast("int").alias("passenger_count"),
        money(F.col("l_quantity") / 4).alias("trip_distance"),
        F.lit(1).alias("RatecodeID"),
        F.when(F.col("l_returnflag") == "R", "Y").otherwise("N").alias("store_and_fwd_flag"),
        (F.col("l_partkey") % 260 + 1).cast("int").alias("PULocationID"),
        (F.col("o_custkey") % 260 + 1).cast("int").alias("DOLocationID"),
        (F.col("l_linenumber") % 4 + 1).cast("string").alias("payment_type"),
        money(F.col("l_quantity")).alias("fare_amount"),
        money(F.lit(0.5)).alias("extra"),
        money(F.lit(0.5)).alias("mta_tax"),
        money((F.col("l_partkey") % 800).cast("double") / 100).alias("tip_amount"),
        money(F.lit(0)).alias("tolls_amount"),
        money(F.lit(0.3)).alias("improvement_surcharge"),
        money(F.col("l_quantity") + 1.3).alias("total_amount"),
        money(F.lit(2.5)).alias("congestion_surcharge"),
    )
