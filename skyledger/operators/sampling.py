"""Reproducible samples and filtered extracts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------

SAMPLE_ROWS, SAMPLE_FRACTION = 1000, 0.01
RECENT_DAYS, RECENT_ROWS = 30, 1000
ROUTE_ROWS, AIRLINE_ROWS = 500, 200

# -------------------------------------------------------------------------------------------

_DRAW, _RANK, _SHARE, _TASK = "_draw", "_rank", "_share", "_task"


def _rest(df: DataFrame, *used: str) -> list[str]:
    """The other columns, as tie-break: a limit then always cuts at the same row."""
    return [name for name in df.columns if name not in used]


def _uniform(df: DataFrame, seed: int | None) -> Column:
    """A number in [0, 1) for each row; with a seed it is a hash of seed and row, which neither
    the partitioning nor the plan can change. Equal rows then have equal numbers."""
    if seed is None:
        return F.rand()
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *df.columns), 11) / float(1 << 53)


def _draw(df: DataFrame, by: Column | None, seed: int | None) -> Column:
    return by if by is not None else _uniform(df, seed)


def year_filter(flights: DataFrame, year: int) -> DataFrame:
    """Equality on the year; prunes directories of a table partitioned by it."""
    return flights.filter(F.col("Year") == year)


def random_sample(flights: DataFrame, rows: int = SAMPLE_ROWS, year: int | None = None,
                  seed: int | None = None, by: Column | None = None) -> DataFrame:
    """``rows`` uniformly drawn rows: each task keeps its smallest draws, nothing is sorted.

    Draws are random, or the values of ``by`` (a hash of the row, say) for a sample that any
    engine reproduces.
    """
    source = flights if year is None else year_filter(flights, year)
    return (source.withColumn(_DRAW, _draw(flights, by, seed))
            .orderBy(_DRAW, *(_rest(flights) if by is not None or seed is not None else []))
            .limit(rows).drop(_DRAW))


def table_sample(flights: DataFrame, fraction: float = SAMPLE_FRACTION, rows: int = SAMPLE_ROWS,
                 seed: int | None = None, by: Column | None = None) -> DataFrame:
    """Bernoulli sample of the rows; of more than ``rows`` those with the smallest draws, so that
    the sample is spread over the whole table. ``by``: numbers in [0, 1) in place of the draws."""
    settled = by is not None or seed is not None
    return (flights.withColumn(_DRAW, _draw(flights, by, seed)).filter(F.col(_DRAW) < fraction)
            .orderBy(_DRAW, *(_rest(flights) if settled else [])).limit(rows).drop(_DRAW))


def block_sample(table: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = 0,
                 block: Column | None = None) -> DataFrame:
    """All rows of a share of the table's files; ``table`` is read from files and not yet changed.

    A file is drawn by a hash of seed and path. The condition names nothing but the file, so that
    Spark settles it when it lists files, and no byte of the others is read. The layouts here keep
    files at about a storage block's size; a table in a few large files is better sampled by rows.
    ``block``: what to draw by in place of the path, an expression over ``_metadata``; files with
    equal values are drawn together.
    """
    name = F.col("_metadata.file_path") if block is None else block
    drawn = F.md5(F.concat_ws("|", F.lit(str(seed)), name))
    if fraction >= 1:
        return table
    # The first 64 bits of the digest, compared as text with those of the fraction.
    return table.filter(F.substring(drawn, 1, 16) < f"{int(fraction * (1 << 64)):016x}")


def recent_data(flights: DataFrame, days: int = RECENT_DAYS, limit: int = RECENT_ROWS,
                as_of: datetime.date | None = None) -> DataFrame:
    """Flights of the last ``days`` days before ``as_of`` (today), newest first."""
    today = F.lit(as_of) if as_of is not None else F.current_date()
    return (flights.filter(F.col("FlightDate") >= F.date_sub(today, days))
            .orderBy(F.desc("FlightDate"), *_rest(flights, "FlightDate")).limit(limit))


def specific_routes(flights: DataFrame, origins: list[str], destinations: list[str],
                    limit: int = ROUTE_ROWS) -> DataFrame:
    """Flights from any of the origins to any of the destinations, newest first."""
    on_route = F.col("Origin").isin(*origins) & F.col("Dest").isin(*destinations)
    return (flights.filter(on_route)
            .orderBy(F.desc("FlightDate"), *_rest(flights, "FlightDate")).limit(limit))


def airlines_sample(flights: DataFrame, airlines: list[str], rows_each: int = AIRLINE_ROWS,
                    seed: int | None = None, by: Column | None = None) -> DataFrame:
    """``rows_each`` random flights of each airline.

    An airline may own a third of the table, so no task ranks all of its rows. They are first
    cut to ``rows_each`` within the scan tasks, then within shares of them, as many as shuffle
    partitions, and only the survivors are ranked together: the smallest draws overall are among
    the smallest of their share, so the cut is exact.
    """
    tie_break = _rest(flights) if by is not None or seed is not None else []
    shares = int(flights.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = (
        flights.filter(F.col("Reporting_Airline").isin(*airlines))
        .select("*", _draw(flights, by, seed).alias(_DRAW), F.spark_partition_id().alias(_TASK))
        .withColumn(_SHARE, F.pmod(F.col(_TASK), F.lit(shares)))
    )
    for level in [[_TASK], [_SHARE], []]:
        window = Window.partitionBy("Reporting_Airline", *level).orderBy(_DRAW, *tie_break)
        sample = (sample.withColumn(_RANK, F.row_number().over(window))
                  .filter(F.col(_RANK) <= rows_each).drop(_RANK))
    return (sample.drop(_DRAW, _TASK, _SHARE)
            .orderBy("Reporting_Airline", F.desc("FlightDate"),
                     *_rest(flights, "Reporting_Airline", "FlightDate")))


def weighted_sample(df: DataFrame, weight: str, rows: int = 1, seed: int | None = None,
                    by: Column | None = None) -> DataFrame:
    """``rows`` rows without replacement, each draw proportional to ``weight``.

    The smallest exponential waiting times with rate ``weight`` win (Efraimidis and Spirakis);
    rows of zero or null weight never do. ``by``: numbers in [0, 1) in place of the draws.
    """
    waiting = -F.log(F.lit(1.0) - _draw(df, by, seed)) / F.col(weight)
    settled = by is not None or seed is not None
    return (df.filter(F.col(weight) > 0).withColumn(_DRAW, waiting)
            .orderBy(_DRAW, *(_rest(df) if settled else [])).limit(rows).drop(_DRAW))


def sample_stats(sample: DataFrame) -> DataFrame:
    """Rows, columns, distinct airlines and airports, and date range of an extract."""
    available = set(sample.columns)
    figures = [F.count(F.lit(1)).alias("total_rows"),
               F.lit(len(sample.columns)).alias("column_count")]
    for name, alias in (("Reporting_Airline", "unique_airlines"), ("Origin", "unique_origins"),
                        ("Dest", "unique_destinations")):
        if name in available:
            figures.append(F.count_distinct(name).alias(alias))
    if "FlightDate" in available:
        figures += [F.min("FlightDate").alias("earliest_date"),
                    F.max("FlightDate").alias("latest_date")]
    return sample.agg(*figures)
