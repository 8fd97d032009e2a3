"""Sessions kept up to date load by load, from stored parts of sessions.

A load writes what its own rows say about each session: one row of mergeable
measures per (device, session, session date), and the session's distinct steps.
A session is then made from its parts of all loads, so a late event changes it
without reading the events of earlier loads, and loads may come in any order.

Two folders are kept, ``parts`` and ``steps``, each by load and session date,
beside the session table itself, which is partitioned by session date. Loading
again under the same name replaces that load's parts, and with them what it had
added. The sessions that lose parts so are noted in ``pending`` until the table
is written, so a load that died is repaired by running it again. One load runs at
a time.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlib.functions.rules import channel_group
from martlib.operators.aggregates import string_agg, summarize
from martlib.plans.common import EMPTY_SESSION_ID, EMPTY_USER_ID, EVENT_DIMENSIONS, MARKETING_DIMENSIONS
from martlib.plans.events import event_rows, finish_sessions, session_measures, session_metrics
from martlib.session import cut_lineage, small_side
from martlib.sources.writers import _delete, _path_exists, overwrite_partitions, write_partitioned

KEYS = ["user_pseudo_id", "session_id", "session_date"]
STEP = ["session_id", "session_date", "event_datetime_utc", "event_id", "event_name"]
TRAFFIC = "traffic"


def _traffic(dimensions: Sequence[str]) -> Column:
    """The dimensions of an event behind their rank: paid traffic first, then the latest, then the event id."""
    channel = channel_group(F.col("marketing_source"), F.col("marketing_medium"))
    latest = -F.unix_micros(F.col("event_datetime_utc").cast("timestamp"))
    return F.struct(
        F.when(F.lower(channel).contains("paid"), 1).otherwise(2).alias("unpaid"), F.coalesce(latest, F.lit(2**63 - 1)).alias("latest"), "event_id",
        *dimensions, channel.alias("channel_grouping"))


def session_rows(long: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """These long rows by event, with all that parts and steps of sessions read."""
    return event_rows(long, [*KEYS, *dimensions, "marketing_source", "marketing_medium"])


def session_parts(long: DataFrame, dimensions: Sequence[str], empty_user: str = EMPTY_USER_ID) -> DataFrame:
    """What these long rows say about each session, in one row that merges with other parts of it."""
    return _parts(session_rows(long, dimensions), dimensions, empty_user)


def _parts(events: DataFrame, dimensions: Sequence[str], empty_user: str) -> DataFrame:
    measures = {n: getattr(F, fn)(e) for n, (e, fn) in session_measures(empty_user).items()}
    return summarize(events, KEYS, {**measures, TRAFFIC: F.min(_traffic(dimensions))})


def merge_parts(parts: DataFrame) -> DataFrame:
    """One part per key of any number of parts; merging in any order or grouping gives the same."""
    measures = {n: getattr(F, fn)(n) for n, (_, fn) in session_measures().items()}
    return summarize(parts, KEYS, {**measures, TRAFFIC: F.min(TRAFFIC)})


def sessions_from_parts(
    parts: DataFrame, steps: DataFrame, bot_days: DataFrame, *, dimensions: Sequence[str], regions: Sequence[tuple[str, Sequence[str]]] = (),
    home: str = "Israel",
) -> DataFrame:
    """The rows of ``build_sessions`` from the parts and steps of whole sessions."""
    merged = merge_parts(parts)
    best = merged.groupBy("session_id").agg(F.min(TRAFFIC).alias(TRAFFIC))
    dims = best.select("session_id", *[F.col(f"{TRAFFIC}.{d}").alias(d) for d in [*dimensions, "channel_grouping"]])
    told = steps.select("session_id", "event_datetime_utc", "event_id", "event_name").distinct()
    funnel = string_agg(told, ["session_id"], "event_name", ["event_datetime_utc", "event_id"], "session_events")
    return finish_sessions(session_metrics(merged), dims, funnel, bot_days, regions, home)


def _near(days: Sequence[dt.date | None], span: int | None) -> Column:
    """Session dates at most ``span`` days away from the given ones; those without a date always."""
    date, known = F.col("session_date"), [d for d in days if d is not None]
    if span is None or len(known) < len(days):
        return F.lit(True)
    reach = {d + dt.timedelta(days=i) for d in known for i in range(-span, span + 1)}
    return date.isNull() | date.isin(sorted(reach))


def _read(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(f"{like.schema.toDDL()}, load string").parquet(path)


def load_sessions(
    long: DataFrame, folder: str, load: str, bot_days: DataFrame, *, dimensions: Sequence[str] = tuple(EVENT_DIMENSIONS),
    marketing: Sequence[str] = tuple(MARKETING_DIMENSIONS), regions: Sequence[tuple[str, Sequence[str]]] = (), home: str = "Israel",
    empty_user: str = EMPTY_USER_ID, empty_session: str = EMPTY_SESSION_ID, span: int | None = None,
) -> str:
    """Adds the rows of one load to the sessions kept in ``folder``; returns the path of the session table.

    Only sessions that the load (or an earlier run under its name) touches are made
    again, from their parts, and only the days that hold them are rewritten.
    ``span`` bounds how many days apart the session dates of one session id are,
    so that parts of other days need not be read; None reads the parts of all days.
    Bot days apply to the sessions made again, others keep their flag. The table
    exists from the first load that holds a session.
    """
    if not re.fullmatch(r"[\w.-]+", load):
        raise ValueError(f"the name of a load is part of a path: {load!r}")
    spark = long.sparkSession
    base = folder.rstrip("/")
    table = f"{base}/sessions"
    dimensions = [*dimensions, *marketing]
    # parts and steps read the events of the load, of which there are far fewer than long rows
    events = cut_lineage(session_rows(long.filter(F.col("session_id") != empty_session), dimensions))
    new = {"parts": _parts(events, dimensions, empty_user), "steps": events.select(*STEP).distinct()}

    key, pending = ["session_id", "session_date"], f"{base}/pending/load={load}"
    if _path_exists(long, f"{base}/parts/load={load}"):
        # what an earlier run said, which the new parts no longer tell
        before = _read(spark, f"{base}/parts", new["parts"]).filter(F.col("load") == load)
        before.select(*key).distinct().write.mode("append").parquet(pending)
    for name, df in new.items():
        write_partitioned(df, f"{base}/{name}/load={load}", "session_date", ["session_id"])
    parts, steps = (_read(spark, f"{base}/{n}", df) for n, df in new.items())
    touched = parts.filter(F.col("load") == load).select(*key)
    if _path_exists(long, pending):
        touched = touched.union(spark.read.schema(touched.schema).parquet(pending))
    touched = cut_lineage(touched.distinct())
    # days are bounded by the calendar, not by the data
    days = [r[0] for r in touched.select("session_date").distinct().collect()]
    if not days:
        _delete(spark, pending)
        return table

    ids = small_side(touched.select("session_id").distinct())
    mine = lambda df: df.filter(_near(days, span)).join(ids, "session_id", "left_semi")
    made = cut_lineage(sessions_from_parts(mine(parts), mine(steps), bot_days, dimensions=dimensions, regions=regions, home=home))
    if not _path_exists(long, table):
        write_partitioned(made, table, "session_date", ["session_id"])
        _delete(spark, pending)
        return table
    days = sorted({*days, *[r[0] for r in made.select("session_date").distinct().collect()]}, key=str)
    date = F.col("session_date")
    held = date.isin([d for d in days if d is not None])
    held = held | date.isNull() if None in days else held
    others = spark.read.schema(made.schema).parquet(table).filter(held).join(ids, "session_id", "left_anti")
    overwrite_partitions(others.unionByName(made), table, "session_date", ["session_id"], replaced=days)
    _delete(spark, pending)
    return table
