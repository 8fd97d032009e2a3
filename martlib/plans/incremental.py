"""Daily loads: a plan over a window of days, upserted into a partitioned table, and plans whose sessions go on from day to day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlib.operators.joins import scalar_bound
from martlib.session import cut_lineage, small_side
from martlib.sources.writers import _path_exists, lookback, overwrite_partitions, upsert_partitions, write_partitioned


def load_window(
    source: DataFrame, build: Callable[[DataFrame, DataFrame | None], DataFrame], path: str, *, date: str, key: Sequence[str], by: str, days: int,
    today: dt.date, order: Sequence[str] = (), cluster: Sequence[str] = (),
) -> None:
    """Loads the last ``days`` days, and all since the newest loaded day, into the table at ``path``.

    ``build(rows, prior)`` makes the table's rows from the source rows of the
    window; ``prior`` are the table's rows of the ``days`` before the window, so
    that a session that began there keeps its date, or None in the first load.
    Rows replace those of the same ``key``; the search for them goes back as far
    as ``prior`` does. What reaches further back than that is not carried on:
    a user id learned later does not change rows older than the window.
    """
    spark = source.sparkSession
    if not _path_exists(source, path):
        upsert_partitions(build(lookback(source, date, days, None, today), None), path, key, by, order, cluster)
        return
    target = spark.read.parquet(path)
    last = scalar_bound(target, F.max(by))
    start = min(last, today - dt.timedelta(days=days)) if last else today - dt.timedelta(days=days)
    since = start - dt.timedelta(days=days)
    prior = target.filter((F.col(by) >= F.lit(since)) & (F.col(by) < F.lit(start)))
    upsert_partitions(build(lookback(source, date, days, last, today), prior), path, key, by, order, cluster, since)


def load_continuing(
    events: DataFrame, build: Callable[[DataFrame], DataFrame], folder: str, *, by: str, since: dt.date | None = None, span: int | None = None,
    session: str = "session_id", date: str = "event_date", empty: str | None = None, cluster: Sequence[str] = (),
) -> str:
    """Loads the days from ``since`` on (None: all) into a table whose rows depend on their session; returns its path.

    ``build`` makes the table's rows from events, each from those of its own
    session; ``by`` is their day, which is that of an event of the session.
    ``events`` are the stored events: all from ``since`` on, and before it the last
    ``span`` days, which is how long a session may last (None: all days). Of these
    only the sessions with events in the loaded days are read, and their rows are
    made again as a whole. So a ranking, or a sum over a visit, that goes on after
    midnight changes rows of the day before; other sessions' rows stay.

    Rows without a session, or with the id ``empty``, belong to no session: they
    depend on themselves only. ``met`` beside the table keeps which sessions each
    day had, so that sessions which lose events are made again too. It is written
    last; a load that died is repaired by running it again.
    """
    spark = events.sparkSession
    base = folder.rstrip("/")
    table, met = f"{base}/table", f"{base}/met"
    day, own = F.col(date), F.col(by)
    named = F.col(session).isNotNull() if empty is None else F.col(session).isNotNull() & (F.col(session) != empty)
    later = F.lit(True) if since is None else day >= F.lit(since)
    new = events.filter(later)
    seen = new.filter(named).select(session, date).distinct()
    if not _path_exists(events, f"{met}/_SUCCESS"):
        write_partitioned(build(new), table, by, cluster)
        write_partitioned(seen, met, date)
        return table

    stored = spark.read.schema(seen.schema).parquet(met)
    ids = cut_lineage(seen.select(session).union(stored.filter(later).select(session)).distinct())
    side = small_side(ids)
    first = None if since is None or span is None else since - dt.timedelta(days=span)
    reach = lambda c: F.lit(True) if first is None else c >= F.lit(first)
    rows = new if since is None else new.unionByName(events.filter(~later & reach(day)).join(side, session, "left_semi"))
    made = cut_lineage(build(rows))

    held = spark.read.schema(made.schema).parquet(table).filter(reach(own))
    loaded = F.lit(True) if since is None else own >= F.lit(since)
    replaced = held.filter(loaded).select(by).union(held.filter(~loaded).join(side, session, "left_semi").select(by))
    # days are bounded by the calendar, not by the data
    days = [r[0] for r in replaced.union(made.select(by)).distinct().collect()]
    others = held.filter(own.isin(days) & ~loaded).join(side, session, "left_anti")
    overwrite_partitions(others.unionByName(made), table, by, cluster, replaced=days)
    overwrite_partitions(seen, met, date, replaced=[r[0] for r in stored.filter(later).select(date).distinct().collect()])
    return table
