"""Expressions over historical flight columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------

DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]

CANCELLATION_REASONS = {
    "A": "Carrier",
    "B": "Weather",
    "C": "National Air System",
    "D": "Security",
}
UNKNOWN_REASON = "Unknown"

ROUTE_SEPARATOR = " → "

# -------------------------------------------------------------------------------------------


def fact_key() -> Column:
    """``{date}_{airline}{number}_{origin}_{dest}``; null as soon as one part is null."""
    text = {name: F.col(name).cast("string") for name in (
        "FlightDate", "IATA_CODE_Reporting_Airline", "Flight_Number_Reporting_Airline",
        "Origin", "Dest")}
    flight = F.concat(text["IATA_CODE_Reporting_Airline"],
                      text["Flight_Number_Reporting_Airline"])
    underscore = F.lit("_")
    return F.concat(text["FlightDate"], underscore, flight, underscore, text["Origin"],
                    underscore, text["Dest"])


def hhmm_timestamp(date: str, hhmm: str, midnight_rollover: bool = False) -> Column:
    """Clock number such as 930 or 1430 on a date; unparsable values become null.

    2400 is no valid clock time and gives null, unless ``midnight_rollover`` asks for 00:00
    of the next day.
    """
    clock = F.col(hhmm)
    digits = F.lpad(clock.cast("string"), 4, "0")
    day = F.col(date).cast("date")
    if midnight_rollover:
        at_midnight = clock == 2400
        digits = F.when(at_midnight, F.lit("0000")).otherwise(digits)
        day = F.when(at_midnight, F.date_add(day, 1)).otherwise(day)
    return F.try_to_timestamp(F.concat_ws(" ", day.cast("string"), digits),
                              F.lit("yyyy-MM-dd HHmm"))


def flag(column: str) -> Column:
    """1 where the indicator column equals one, otherwise (also on null) 0."""
    return F.when(F.col(column) == 1, 1).otherwise(0)


def iso_weekday(date: str) -> Column:
    """Monday = 1 … Sunday = 7."""
    return F.weekday(date) + 1


def day_name(day_of_week: str) -> Column:
    """Name of a Monday-based weekday number; null outside 1..7."""
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    return F.get(names, F.col(day_of_week).cast("int") - 1)


def cancellation_reason(code: str) -> Column:
    reason = F.lit(None).cast("string")
    for letter, label in CANCELLATION_REASONS.items():
        reason = F.when(F.col(code) == letter, label).otherwise(reason)
    return F.coalesce(reason, F.lit(UNKNOWN_REASON))


def route_label() -> Column:
    return F.concat(F.col("Origin"), F.lit(ROUTE_SEPARATOR), F.col("Dest"))


def percentage(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``, two decimals, ties away from zero."""
    exact = (part * F.lit(100.0) / whole).cast("decimal(38,10)")
    return F.round(exact, 2).cast("double")
