"""Long event rows kept up to date when events arrive late, also those that tell who a visitor of an old day was.

Three things reach from one event to the rows of others: a user id is filled
within a device and day, a visitor's dimensions and derived id are those of the
earliest row of the visitor key, and a session has one date, number and flag.
So a late login changes its own day, a late first row every day the visitor was
seen, and both the sessions that go on into the days beside.

Beside the table, two folders tell this without the old events: ``visitors`` holds
the earliest row per visitor key, ``seen`` the days on which a visitor key of a device
had events. Both only grow by appended rows and merge by minimum and distinct, so
rows that are appended again change nothing. They are written after the table: a
load that died is repaired by running it again. Appended files are not compacted.
One load runs at a time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.functions.dates import parse_ymd
from martlib.operators.ordered import join_null_safe
from martlib.operators.windows import keep_first
from martlib.plans.common import EVENT_DIMENSIONS
from martlib.plans.events import EARLIEST, first_seen, identity_columns, numbered_rows, prepare_events, unnest_prepared
from martlib.session import cut_lineage, free_unused, job_settings
from martlib.sources.writers import _path_exists, overwrite_partitions, staged, write_partitioned

DAY = "event_date"
SEEN = ["device", "merge_key", DAY]


def _identified(prepared: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Prepared events with visitor key, derived id and device; a row of no device has its derived id for one."""
    return prepared.withColumns(identity_columns(dimensions)).withColumn("device", F.coalesce("user_pseudo_id", "derived_id"))


def _around(marks: DataFrame, days: int) -> DataFrame:
    """The same devices on the days up to ``days`` before and after; a missing day stays missing."""
    near = F.explode(F.sequence(F.lit(-days), F.lit(days)))
    return marks.select("device", DAY, near.alias("__n")).select("device", F.date_add(DAY, F.col("__n")).alias(DAY)).distinct()


def _days(df: DataFrame) -> list[dt.date | None]:
    """Distinct days: their number is bounded by the calendar, not by the data."""
    return [r[0] for r in df.select(DAY).distinct().collect()]


def _on(col: Column, days: Sequence[dt.date | None]) -> Column:
    known = col.isin([d for d in days if d is not None])
    return known | col.isNull() if None in days else known


def _raw_on(days: Sequence[dt.date | None]) -> Column:
    """Raw events of these days, as a filter on their day text that reaches the scan."""
    known = F.col(DAY).isin([f"{d:%Y%m%d}" for d in days if d is not None])
    return known | parse_ymd(F.col(DAY)).isNull() if None in days else known


def changed_days(held: DataFrame, made: DataFrame, key: str) -> list[dt.date | None]:
    """Days on which the rows of some ``key`` differ between two tables, as multisets, by count and sum of row hashes."""
    names = [c for c, kind in made.dtypes if "map<" not in kind and "variant" not in kind]
    told = lambda df, sign: df.select(DAY, key, F.lit(sign).alias("__one"), (F.xxhash64(*names).cast("decimal(38,0)") * sign).alias("__hash"))
    sums = told(made, 1).unionAll(told(held, -1)).groupBy(DAY, key).agg(F.sum("__one").alias("__one"), F.sum("__hash").alias("__hash"))
    return _days(sums.filter((F.col("__one") != 0) | (F.col("__hash") != 0)))


def load_identities(
    events: DataFrame, arrived: DataFrame, folder: str, prior_sessions: DataFrame | None = None, objectives: DataFrame | None = None, *,
    dimensions: Sequence[str] = tuple(EVENT_DIMENSIONS), own_sites: Sequence[tuple[str, str]] = (), strict: bool = True, span: int = 1,
    cluster: Sequence[str] = (),
) -> str:
    """Brings the table of ``unnest_events`` in ``folder`` up to date with the events that arrived; returns its path.

    ``events`` are all stored raw events, those of ``arrived`` among them, best
    partitioned by ``event_date``; ``arrived`` may be of any days. A session lasts at
    most ``span`` days after its first. Of the stored events only those of touched devices,
    on days up to twice ``span`` from a touched one, are read, and only days whose
    rows differ are written. The first load takes all of ``events``.
    """
    spark, dimensions = events.sparkSession, list(dimensions)
    base = folder.rstrip("/")
    table, visitors, seen = f"{base}/table", f"{base}/visitors", f"{base}/seen"
    given = {"dimensions": dimensions, "own_sites": own_sites, "strict": strict}

    if not _path_exists(events, f"{visitors}/_SUCCESS"):
        with staged(numbered_rows(prepare_events(events)), table) as df, job_settings(spark):
            write_partitioned(unnest_prepared(df, prior_sessions, objectives, **given), table, DAY, cluster)
            df = _identified(df, dimensions)
            write_partitioned(df.select(*SEEN).distinct(), seen, DAY)
            first_seen(df, dimensions).write.mode("overwrite").parquet(visitors)
        free_unused(spark)
        return table
    with job_settings(spark):
        _load_arrived(events, arrived, table, visitors, seen, prior_sessions, objectives, given, span, cluster)
    free_unused(spark)
    return table


def _load_arrived(
    events: DataFrame, arrived: DataFrame, table: str, visitors: str, seen: str, prior_sessions: DataFrame | None, objectives: DataFrame | None,
    given: dict, span: int, cluster: Sequence[str],
) -> None:
    """Makes the rows near the arrived events again and replaces the days that differ. Wide rows are staged beside the table, not checkpointed."""
    spark, dimensions = events.sparkSession, given["dimensions"]

    new = _identified(prepare_events(arrived), dimensions)
    new = cut_lineage(new.select("user_pseudo_id", *SEEN, "derived_id", *dimensions, *EARLIEST))
    first = cut_lineage(first_seen(new, dimensions))
    stored = spark.read.schema(first.schema).parquet(visitors)
    known = keep_first(stored.join(first.select("merge_key"), "merge_key", "left_semi"), ["merge_key"], EARLIEST)
    was = known.select("merge_key", F.struct(*EARLIEST).alias("__was"))
    earlier = cut_lineage(first.join(was, "merge_key", "left").filter(F.col("__was").isNull() | (F.struct(*EARLIEST) < F.col("__was"))))
    restated = earlier.filter(F.col("__was").isNotNull()).select("merge_key")

    met = spark.read.schema(new.select(*SEEN).schema).parquet(seen)
    marks = new.select("device", DAY)
    if not restated.isEmpty():
        marks = marks.union(met.join(restated, "merge_key", "left_semi").select("device", DAY))
    marks = cut_lineage(marks.distinct())
    # sessions with a row near a mark lie whole within twice their length of it
    near, context = cut_lineage(_around(marks, span)), cut_lineage(_around(marks, 2 * span))
    around = _identified(prepare_events(events.filter(_raw_on(_days(context)))), dimensions)
    with staged(numbered_rows(join_null_safe(around, context, ["device", DAY], "left_semi")), table) as df:
        first_rows = stored.unionByName(earlier.drop("__was")).join(df.select("merge_key").distinct(), "merge_key", "left_semi")
        merged = keep_first(first_rows, ["merge_key"], EARLIEST)
        ours = near.withColumnRenamed("device", "user_pseudo_id")
        at = ["user_pseudo_id", DAY]
        again = unnest_prepared(df.drop("merge_key", "derived_id", "device"), prior_sessions, objectives, visitors=merged, **given)
        again = join_null_safe(again, ours, at, "left_semi")
        with staged(again, table) as made:
            del again
            _replace_changed(made, ours, table, cluster, _days(near))
    fresh, loaded = new.select(*SEEN).distinct(), met.filter(_on(F.col(DAY), _days(new)))
    write_partitioned(join_null_safe(fresh, loaded, SEEN, "left_anti"), seen, DAY, mode="append")
    earlier.drop("__was").write.mode("append").parquet(visitors)


def _replace_changed(made: DataFrame, ours: DataFrame, table: str, cluster: Sequence[str], near: Sequence[dt.date | None]) -> None:
    """Of the days ``near``, those on which the rows of the devices ``ours`` differ from the ones made again are written."""
    at = ["user_pseudo_id", DAY]
    held = made.sparkSession.read.schema(made.schema).parquet(table)
    days = changed_days(join_null_safe(held.filter(_on(F.col(DAY), near)), ours, at, "left_semi"), made, "user_pseudo_id")
    if days:
        of_days = _on(F.col(DAY), days)
        others = join_null_safe(held.filter(of_days), ours, at, "left_anti")
        overwrite_partitions(others.unionByName(made.filter(of_days)), table, DAY, cluster, replaced=days)
