"""Event-volume monitoring."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlib.operators.aggregates import period_change, stack_grains
from martlib.operators.sets import order_final


def daily_volumes(long: DataFrame, event_keys: Sequence[str] = ("action", "label", "type"), max_value_length: int = 10) -> DataFrame:
    """Daily totals per event, and per event, key and short value.

    Values of ``max_value_length`` characters or more are free text and get no
    row of their own; they still count in the totals of their event.
    """
    c = F.col
    value = c("event__string_value")
    df = long.select(c("event_date").alias("analysis_date"), "event_name", "event_key", value.alias("event_value"), "user_pseudo_id", "session_id", "event_datetime_utc")
    short = c("event_key").isin(*event_keys) & (c("event_value") != "") & (F.length("event_value") < max_value_length)
    aggs = {
        "event_count": F.count(F.lit(1)),
        "unique_users": F.count_distinct("user_pseudo_id"),
        "unique_sessions": F.count_distinct("session_id"),
        "last_event_time": F.max("event_datetime_utc"),
    }
    return stack_grains(df, [(["analysis_date", "event_name"], None), (["analysis_date", "event_name", "event_key", "event_value"], short)], aggs)


def event_monitor(
    long: DataFrame, as_of: dt.date, lookback: int = 120, short: int = 7, event_keys: Sequence[str] = ("action", "label", "type"),
    max_value_length: int = 10, min_avg: float = 5, min_total: float = 5,
) -> DataFrame:
    """Events whose daily volume changed: recent days against the days before, smallest change first."""
    recent = F.lit(as_of - dt.timedelta(days=short))
    src = long.filter(F.col("event_date") >= F.lit(as_of - dt.timedelta(days=lookback)))
    daily = daily_volumes(src, event_keys, max_value_length)
    # distinct counts are not read here and are pruned from the plan
    out = period_change(daily, ["event_name", "event_key", "event_value"], "analysis_date", "event_count", recent, min_avg, min_total)
    return order_final(out, ["pct_change"])
