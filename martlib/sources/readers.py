"""Sources. Bounds are turned into literals, so Spark prunes partitions and pushes filters to the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlib.functions.dates import week_start_sunday
from martlib.session import small_side


def read_shards(
    spark: SparkSession, path: str, lo: dt.date | str, hi: dt.date | str, date_col: str = "event_date"
) -> DataFrame:
    """Day shards between two dates; only matching partition folders are listed and read."""
    return spark.read.parquet(path).filter(F.col(date_col).between(F.lit(str(lo)).cast("date"), F.lit(str(hi)).cast("date")))


def shard_range(today: dt.date, days: int, last_loaded: dt.date | None) -> tuple[dt.date, dt.date]:
    """Shards to read again: from the earlier of (today - days, last loaded day) to today."""
    start = today - dt.timedelta(days=days)
    return (min(start, last_loaded) if last_loaded else start), today


def read_table(
    spark: SparkSession, name: str, *, folder: str | None = None, jdbc: Mapping[str, str] | None = None,
    partition: tuple[str, int, int, int] | None = None,
) -> DataFrame:
    """A relational table: a parquet snapshot under ``folder``, or JDBC read in parallel
    ranges of ``partition = (column, lower, upper, parts)``."""
    if folder is not None:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    reader = spark.read.format("jdbc").options(**jdbc, dbtable=name)
    if partition:
        col, lower, upper, parts = partition
        reader = reader.options(partitionColumn=col, lowerBound=lower, upperBound=upper, numPartitions=parts)
    return reader.load()


def read_pushed(
    spark: SparkSession, table: str, ts_col: str, since: dt.date | None, *, folder: str | None = None,
    jdbc: Mapping[str, str] | None = None,
) -> DataFrame:
    """Recent rows with the filter evaluated at the source, plus ``week_start_date`` (Sundays).

    A plain comparison on the raw column is pushed into parquet row groups as
    well as into a JDBC query.
    """
    df = read_table(spark, table, folder=folder, jdbc=jdbc)
    if since is not None:
        dtype = df.schema[ts_col].dataType
        df = df.filter(F.col(ts_col) >= F.lit(str(since)).cast(dtype))
    return df.withColumn("week_start_date", week_start_sunday(F.col(ts_col)))


def read_lookup(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct lookup rows, broadcast when their number proves small."""
    return small_side(df.select(*cols).distinct())
