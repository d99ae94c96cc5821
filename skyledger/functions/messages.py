"""Expressions over flight-status messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _part(path: str) -> Column:
    return F.coalesce(F.col(path).cast("string"), F.lit(""))


def flight_id() -> Column:
    """``{date}_{flight iata}_{departure iata}_{arrival iata}``, missing parts empty."""
    parts = ["flight_date", "flight.iata", "departure.iata", "arrival.iata"]
    return F.concat_ws("_", *[_part(path) for path in parts])


def flight_id_by_number() -> Column:
    """``{date}_{flight number}_{scheduled departure}``, missing parts empty."""
    parts = ["flight_date", "flight.number", "departure.scheduled"]
    return F.concat_ws("_", *[_part(path) for path in parts])
