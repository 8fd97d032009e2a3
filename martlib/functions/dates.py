"""Date and time expressions. Datetimes are UTC; sessions run with time zone UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ymd(col: Column) -> Column:
    """``yyyymmdd`` text to date; NULL when it does not parse."""
    return F.try_to_timestamp(col, F.lit("yyyyMMdd")).cast("date")


def format_ymd(col: Column) -> Column:
    return F.date_format(col, "yyyyMMdd")


def micros_to_dt(col: Column) -> Column:
    """Epoch microseconds to a UTC datetime without zone."""
    return F.timestamp_micros(col).cast("timestamp_ntz")


def first_of_month(year: Column, month: Column | None = None) -> Column:
    """First day of the month, or of the year when the month is unknown."""
    month = F.lit(1) if month is None else F.coalesce(month, F.lit(1))
    return F.make_date(year, month, F.lit(1))


def trunc_to(col: Column, unit: str) -> Column:
    """Datetime cut down to ``day``, ``hour`` or ``minute``, type kept."""
    return F.date_trunc(unit, col).cast("timestamp_ntz")


def week_start_sunday(col: Column) -> Column:
    """Sunday on or before the date."""
    d = col.cast("date")
    return F.date_sub(d, F.dayofweek(d) - 1)


def _micros(col: Column) -> Column:
    return F.unix_micros(col.cast("timestamp"))


def diff_seconds(later: Column, earlier: Column, mode: str = "elapsed") -> Column:
    """Seconds between two datetimes.

    ``elapsed`` counts whole seconds passed, toward zero; ``boundary`` counts
    second boundaries crossed, so 0.9 s can be 1.
    """
    if mode == "boundary":
        return F.unix_seconds(later.cast("timestamp")) - F.unix_seconds(earlier.cast("timestamp"))
    micros = _micros(later) - _micros(earlier)
    return (F.signum(micros) * F.floor(F.abs(micros) / F.lit(1_000_000))).cast("long")


def diff_days(later: Column, earlier: Column) -> Column:
    return F.date_diff(later.cast("date"), earlier.cast("date"))


def floor_bucket(col: Column, seconds: int) -> Column:
    """Datetime rounded down to a multiple of ``seconds``."""
    millis = F.floor(F.unix_millis(col.cast("timestamp")) / F.lit(seconds * 1000)) * F.lit(seconds * 1000)
    return F.timestamp_millis(millis).cast("timestamp_ntz")
