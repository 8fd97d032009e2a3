"""Structured Streaming forms of the incremental operators."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martlib.operators.ordered import Total, ordered
from martlib.sources.writers import upsert_partitions


def stream_dedup(sdf: DataFrame, id: str | Sequence[str], ts: str, delay: str = "7 days") -> DataFrame:
    """First row per id; an id is remembered for ``delay`` of event time, so the state stays bounded.

    The price of the bound: a row that arrives more than ``delay`` behind the
    newest event time is dropped by the watermark, whether its id was seen or not.
    """
    ids = [id] if isinstance(id, str) else list(id)
    return sdf.withWatermark(ts, delay).dropDuplicatesWithinWatermark(ids)


def stream_upsert(
    sdf: DataFrame, path: str, checkpoint: str, key: Sequence[str], by: str, order: Sequence[str] = (), cluster: Sequence[str] = (),
    trigger: dict | None = None, lookback_days: int | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch into a partitioned folder.

    The upsert is idempotent per key, so a batch that is replayed after a
    failure leaves the same table. With ``lookback_days`` the search for rows to
    replace reads the target only from that many days before the oldest day of
    the batch, so its cost does not grow with the table; keys must then be no
    older than that. Late rows are upserted like others, none are dropped. The
    batch is computed once and held while it is merged.
    """
    def apply(batch: DataFrame, _epoch: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            rows, oldest = batch.agg(F.count(F.lit(1)), F.min(by)).first()
            since = oldest - dt.timedelta(days=lookback_days) if lookback_days is not None and oldest is not None else None
            if rows:
                upsert_partitions(batch, path, key, by, order, cluster, since)
        finally:
            batch.unpersist()

    return (
        sdf.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def carry_session_date(df: DataFrame, prior: DataFrame, session: str = "session_id", date: str = "event_date", split: bool = True) -> DataFrame:
    """``session_date``: the one already stored for the session, else the first date in this batch."""
    known = prior.groupBy(session).agg(F.min("session_date").alias("__known"))
    # the block number only spreads a hot session; any spread gives the same minimum
    first = ordered(df, [session], [], {"__min": Total("min", F.col(date))}, split=split)
    return first.join(known, session, "left").withColumn("session_date", F.coalesce("__known", "__min")).drop("__known", "__min")


def stream_session_dates(
    sdf: DataFrame, session: str = "session_id", ts: str = "ts", delay: str = "1 day", pause: str = "30 minutes", longest: str = "7 days"
) -> DataFrame:
    """``session_date`` on a stream: the day of the session's first event, without a table of earlier sessions.

    The first time of a session is kept in the state of a session window, which ends
    when the id rests for ``pause``; its events wait in the state of a join. Both are
    released when the watermark, ``delay`` behind the newest event, has passed the
    end of the session, so the state holds open sessions only, and the batches in which
    events come do not matter. An event more than ``longest`` before the end of its
    session has its own day, as do, at once, rows without a session; so have rows
    without a time, and theirs is NULL. ``ts`` must be a timestamp with time zone.
    Rows that come behind the watermark are dropped by it.
    """
    t, named = F.col(ts), F.col(session).isNotNull() & F.col(ts).isNotNull()
    events = sdf.filter(named).withWatermark(ts, delay)
    ends = events.groupBy(F.session_window(ts, pause).alias("__w"), F.col(session).alias("__session")).agg(F.min(ts).alias("__first"))
    ends = ends.select("__session", F.window_time("__w").alias("__end"), "__first")
    within = (t >= F.col("__first")) & (t <= F.col("__end")) & (F.col("__end") <= t + F.expr(f"interval {longest}"))
    dated = events.join(ends, (F.col(session) == F.col("__session")) & within, "left")
    dated = dated.select(*sdf.columns, F.coalesce("__first", ts).cast("date").alias("session_date"))
    return dated.unionByName(sdf.filter(~named).withColumn("session_date", t.cast("date")))
