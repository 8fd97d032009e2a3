"""The page flow kept up to date day by day, from stored ends of sessions.

A session may go on after midnight, so the first rows of a load need what came
before them (the page before, the rank reached), and the last rows before them
need what follows. For every session and day the state keeps the few rows that can
matter to later days: the last kept ones, the last page view, and the last kept page
view. A load runs the windows of ``page_flow`` over these and its own rows, adds its
own rows to the table, and states again the following pages of the last rows before.

State of a day depends on that day and those before only. So a load may start again
at any earlier day; everything from that day on is replaced.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlib.functions.text import mask_generated
from martlib.operators.ordered import Lag, LastValue, Lead, RunningCount, Total, chained
from martlib.operators.windows import flow_steps, spread_null_key
from martlib.plans.pages import flow_events, name_with_tab
from martlib.session import cut_lineage, small_side
from martlib.sources.writers import _path_exists, overwrite_partitions, write_partitioned

_ORDER = ["event_datetime_utc", "event_id"]
BEFORE = ["previous_page_view_location", "previous_grouped_page_path", "previous_grouped_page_name"]


def continued_flow(rows: DataFrame, n: int, with_tabs: bool) -> DataFrame:
    """``page_flow`` over new rows and stored ones, which keep what they were given then.

    ``rows`` were written and numbered by ``__row``. The windows move the few columns
    they read; the others are joined once, at the end. ``event_date`` follows the order
    of a session, so the row after one is of its day if any later row is.

    Stored rows have ``__was_kept``; their rank is the one they had, and new rows
    count on from the last. ``__kept``, ``__end`` (a later day may need the row) and
    ``__open`` (its following pages are not complete) tell what becomes of a row.
    """
    c = F.col
    old = c("__was_kept").isNotNull()
    prev = c("previous_page_view_location")
    steps = ["grouped_page_path", "grouped_page_name_with_tab" if with_tabs else "grouped_page_name"]
    told = [c for c in rows.columns if c.startswith("__was_")]
    read = ["__row", "event_id", "event_datetime_utc", "event_date", "session_id", "page_location", "grouped_page_path", "grouped_page_name", "tab", "__is_view"]
    found = ["previous_page_view_location", "grouped_page_name_with_tab", "session_event_rank", *BEFORE[1:], *[f"{s}_{i}" for s in steps for i in range(1, n + 1)]]
    on_its_day = lambda day: F.coalesce(c(day) == c("event_date"), F.lit(False))

    def judged(df: DataFrame) -> DataFrame:
        fresh = ~c("__is_view") | prev.isNull() | (c("page_location") != prev)
        return df.withColumns({
            "previous_page_view_location": F.when(c("__is_view"), prev),
            "__kept": F.coalesce("__was_kept", fresh, F.lit(False)),
            "grouped_page_name_with_tab": name_with_tab(),
        })

    def ranked(df: DataFrame) -> DataFrame:
        return df.withColumn("session_event_rank", F.coalesce("__reached", F.lit(0)) + c("__added"))

    leads, current = flow_steps(steps, n)
    df = spread_null_key(rows.select(*read, *told), "session_id", "event_id", "__s")
    df = chained(df, ["__s"], _ORDER, [
        (["__is_view"], {"previous_page_view_location": Lag(c("page_location")), "__view_day": Lead(c("event_date"))}),
        judged,
        (["__kept"], {
            "__reached": LastValue(c("__was_rank"), "rows"), "__added": RunningCount(~old), "__before": Total("max", c("__was_rank")),
            "__kept_day": Lead(c("event_date"), n - 1), **leads,
        }),
        current,
        ranked,
        (["__kept", "__is_view"], {
            "previous_grouped_page_path": Lag(c("grouped_page_path")),
            "previous_grouped_page_name": Lag(c("grouped_page_name_with_tab")),
            "__kept_view_day": Lead(c("event_date")),
        }),
    ])
    seen = {p: F.when(c("__is_view"), c(p)) for p in BEFORE[1:]}
    last, last_view = ~on_its_day("__kept_day"), c("__is_view") & ~on_its_day("__kept_view_day")
    df = df.withColumns(seen).withColumns({
        **{b: F.when(old, c(f"__was_{b}")).otherwise(c(b)) for b in BEFORE},
        "__end": (c("__kept") & (last | last_view)) | (c("__is_view") & ~on_its_day("__view_day")),
        "__open": c("__kept") & old & (c("__was_rank") > c("__before") - (n - 1)),
    })
    wide = rows.drop(*found).withColumn("user_id", mask_generated(c("user_id")))
    return wide.join(df.select("__row", *found, "__kept", "__end", "__open"), "__row")


def load_page_flow(
    events: DataFrame, folder: str, since: dt.date | None = None, *, n: int = 4, with_tabs: bool = False, span: int | None = None,
) -> str:
    """Loads all pivoted events from the day ``since`` on (None: all) into the flow kept in ``folder``; returns the path of its table.

    ``events`` are all events dated ``since`` or later; the table's rows of these
    days are replaced. ``span`` bounds how many days a session lasts, so that the
    state of older days need not be read; None reads that of all days. Table and
    state are partitioned by ``event_date``, which no event may lack and which
    follows the order of event times within a session. A load that died is repaired
    by running it again.
    """
    spark, date = events.sparkSession, F.col("event_date")
    base = folder.rstrip("/")
    table, ends = f"{base}/flow", f"{base}/ends"
    if n < 2:
        raise ValueError("a flow shows at least the next page")
    later = events if since is None else events.filter(date >= F.lit(since))
    new = flow_events(later)
    told = {"__was_kept": "boolean", "__was_rank": "long", **{f"__was_{b}": "string" for b in BEFORE}}
    # the events may be a long plan and are read several times; the number of a row is written with it
    fresh = new.withColumns({k: F.lit(None).cast(t) for k, t in told.items()})
    numbered = cut_lineage(fresh.withColumn("__row", F.monotonically_increasing_id()))
    exists, rows = _path_exists(events, f"{ends}/_SUCCESS"), numbered  # the state is written last
    if exists and since is not None:
        stored = spark.read.schema(fresh.schema).parquet(ends)
        # sessions with rows in the loaded days, now or in the load that is replaced
        goes_on = numbered.select("session_id").union(stored.filter(date >= F.lit(since)).select("session_id")).distinct()
        before = stored.filter(date < F.lit(since))
        if span is not None:
            before = before.filter(date >= F.lit(since - dt.timedelta(days=span)))
        before = before.join(small_side(goes_on), "session_id", "left_semi")
        rows = numbered.unionByName(cut_lineage(before.withColumn("__row", -1 - F.monotonically_increasing_id())))

    out = cut_lineage(continued_flow(rows, n, with_tabs))
    is_new = F.col("__was_kept").isNull()
    helpers = [c for c in out.columns if c.startswith("__")]
    shown = lambda df: df.drop(*helpers).withColumnRenamed("event_id", "record_id")
    added = shown(out.filter(is_new & F.col("__kept")))
    state = out.filter(is_new & F.col("__end")).withColumns({
        "__was_kept": F.col("__kept"), "__was_rank": F.when(F.col("__kept"), F.col("session_event_rank")), **{f"__was_{b}": F.col(b).cast("string") for b in BEFORE},
    }).select(*fresh.columns)

    if not exists:
        write_partitioned(added, table, "event_date", ["session_id"])
        write_partitioned(state, ends, "event_date", ["session_id"])
        return table
    again = shown(out.filter("__open"))
    days = lambda df: [r[0] for r in df.select("event_date").distinct().collect()]  # bounded by the calendar
    held = spark.read.schema(added.schema).parquet(table)
    touched = days(again)
    kept = held.filter(date.isin(touched)).join(small_side(again.select("record_id")), "record_id", "left_anti")
    from_since = F.lit(True) if since is None else date >= F.lit(since)
    gone = days(held.filter(from_since))
    overwrite_partitions(added.unionByName(again).unionByName(kept), table, "event_date", ["session_id"], replaced=[*gone, *touched])
    overwrite_partitions(state, ends, "event_date", ["session_id"], replaced=days(spark.read.schema(fresh.schema).parquet(ends).filter(from_since)))
    return table
