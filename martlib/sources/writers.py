"""Sinks: partitioned writes, keyed upserts and recent-partition overwrites on plain parquet folders.

Partition overwrites are dynamic: Spark writes the new content in full to a staging
folder inside the table and moves it in when the job has ended, so a plan may read the
partitions that it replaces. The commit replaces one partition after the other; a job
that dies in between leaves days that are new and days that are old, each whole,
and running it again gives the same result.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlib.operators.ordered import join_null_safe, spec
from martlib.operators.sets import union_by_name
from martlib.operators.windows import keep_first
from martlib.session import cut_lineage, free_unused, job_settings, small_side


NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # Spark's folder name for a NULL partition value


def _path_exists(df: DataFrame, path: str) -> bool:
    jvm = df.sparkSession._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).exists(p)


def with_partition(df: DataFrame, by: str, grain: str = "day") -> tuple[DataFrame, str]:
    """The partition column for a grain: the date itself, or the first day of its month."""
    if grain == "day":
        return df, by
    if grain == "month":
        return df.withColumn(f"{by}_month", F.trunc(by, "month")), f"{by}_month"
    raise ValueError(f"unknown grain {grain}")


def write_partitioned(
    df: DataFrame, path: str, by: str, cluster: Sequence[str] = (), grain: str = "day", mode: str = "overwrite",
    max_records_per_file: int = 5_000_000,
) -> None:
    """Write partition folders, rows sorted by ``cluster`` so that row-group statistics prune.

    Rows are rebalanced by partition value: adaptive execution splits a value
    that holds too many rows over several writers and puts small ones together.
    """
    out, part = with_partition(df, by, grain)
    with job_settings(df.sparkSession):
        (
            out.hint("rebalance", part)
            .sortWithinPartitions(part, *cluster)
            .write.mode(mode)
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(part)
            .parquet(path)
        )


def curve_key(df: DataFrame, columns: Sequence[str], bits: int = 5) -> Column:
    """Position of a row on a space-filling curve over several columns: the bits of their quantile ranks, interleaved.

    The ranks come from approximate quantiles, one aggregate over ``df`` that holds
    at most ``2 ** bits`` values a column. Texts count by their first seven bytes; NULL and NaN go first.
    """
    kinds = {c: df.schema[c].dataType for c in columns}

    def number(c: str) -> Column:
        kind = kinds[c]
        if isinstance(kind, (T.StringType, T.BinaryType)):
            head = F.hex(F.substring(F.col(c).cast("binary"), 1, 7))
            return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("double")
        if isinstance(kind, T.DateType):
            return F.unix_date(c).cast("double")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
        return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))

    steps = 2**bits
    shares = [i / steps for i in range(1, steps)]
    cuts = df.agg(*[F.percentile_approx(number(c), shares, 10_000).alias(f"__q{i}") for i, c in enumerate(columns)]).first()
    key = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        value = number(c)
        bounds = F.lit(sorted(set(cuts[i] or []))).cast("array<double>") if cuts[i] else F.array().cast("array<double>")
        # NULL is no number, so no bound counts for it
        rank = F.size(F.filter(bounds, lambda b: b <= value))
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(1).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + i))
    return key


def write_curved(df: DataFrame, path: str, by: str, columns: Sequence[str], mode: str = "overwrite", max_records_per_file: int = 5_000_000, bits: int = 5) -> None:
    """Write partition folders whose files are cells of a space-filling curve over up to four columns.

    Sorting by several columns lets files prune on the first of them only, as each
    file of a large day spans all values of the others. Here rows are range-partitioned by
    day and curve, so a filter on any of the columns reads a part of a day's files.
    The rows are needed three times (quantiles, ranges, rows), so they are written to the checkpoint folder first.
    """
    if not 1 <= len(columns) <= 4:
        raise ValueError("between one and four columns are clustered")
    df = cut_lineage(df)
    out = df.withColumn("__curve", curve_key(df, columns, bits))
    (
        # rows of one cell are spread by a hash, so a cell that holds most rows is not one task
        out.repartitionByRange(by, "__curve", F.xxhash64(*columns))
        .sortWithinPartitions(by, "__curve")
        .drop("__curve")
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(by)
        .parquet(path)
    )


def materialize(df: DataFrame, name: str, kind: str = "view", path: str | None = None) -> DataFrame:
    """A view keeps the plan, a table writes it in full and reads it back."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind == "table":
        df.write.mode("overwrite").parquet(path)
        out = df.sparkSession.read.parquet(path)
        out.createOrReplaceTempView(name)
        return out
    raise ValueError(f"unknown kind {kind}")


def lookback(df: DataFrame, col: str, days: int, last_loaded: dt.date | None, today: dt.date) -> DataFrame:
    """Rows dated from the earlier of (last loaded day, today - days) to today.

    ``last_loaded`` is the target's newest date (see ``scalar_bound``); with an
    empty target everything up to today is loaded.
    """
    if last_loaded is None:
        return df.filter(F.col(col) <= F.lit(today))
    lo = min(last_loaded, today - dt.timedelta(days=days))
    return df.filter(F.col(col).between(F.lit(lo), F.lit(today)))


def merge_by_key(target: DataFrame, updates: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keyed upsert as a DataFrame: one row per key, updates before target rows, then by ``order``.

    Only the keys are compared with the target, which is not sorted: an anti
    join removes replaced rows. NULL is a key like any other: it matches NULL, so
    a batch that is loaded again leaves the same table.
    """
    newest = keep_first(updates, key, [*order, *[c for c in key if c not in order]])
    kept = join_null_safe(target, newest.select(*key), list(key), "left_anti")
    return union_by_name(kept, newest)


@contextmanager
def staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """``df`` evaluated once, into a Parquet folder beside ``path`` that is removed at the end.

    Packed columns take a fraction of the disk that a checkpoint of the same rows
    does, and branches read those they need. What the plan of ``df`` wrote is freed.
    """
    spark, schema = df.sparkSession, df.schema
    staging = f"{path.rstrip('/')}__staging_{uuid.uuid4().hex}"
    try:
        with job_settings(spark):
            df.write.parquet(staging)
        del df
        free_unused(spark)
        yield spark.read.schema(schema).parquet(staging)
    finally:
        _delete(spark, staging)


def _repeated_rows(updates: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame | None:
    """Row numbers of updates that come after another one of their key in ``order``; of equal ones the first row stays.

    Keys are told apart by a hash first, so that only rows of keys that may repeat are sorted.
    """
    sorts = list(dict.fromkeys([*key, *[o.lstrip("-") for o in order]]))
    narrow = updates.select(*sorts, "__row", F.xxhash64(*key).alias("__hash"))
    several = cut_lineage(narrow.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__hash"))
    if several.isEmpty():
        return None
    near = narrow.join(small_side(several), "__hash", "left_semi")
    place = F.row_number().over(spec(key, [*order, *[c for c in key if c not in order], "__row"]))
    return cut_lineage(near.withColumn("__place", place).filter("__place > 1").select("__row"))


def upsert_partitions(updates: DataFrame, path: str, key: Sequence[str], by: str, order: Sequence[str] = (), cluster: Sequence[str] = (), since: dt.date | None = None) -> None:
    """Upsert into a day-partitioned folder, rewriting only partitions that change.

    A key may move to another partition, so the partitions that hold any of the
    updated keys are rewritten along with those the updates fall into. Finding
    them reads the key column of the target; ``since`` limits the search to
    partitions from that day on and to rows without a day, for keys known to be
    no older. Rows without a day form a partition like any other.

    The updates are evaluated once, into a staging folder beside the table. Their
    keys are compared there, so whole rows are shuffled once, to be written by day.
    """
    spark = updates.sparkSession
    if not isinstance(updates.schema[by].dataType, T.DateType):
        raise ValueError(f"partition column {by} must be a date: the list of touched partitions is bounded by the calendar")
    with staged(updates.withColumn("__row", F.monotonically_increasing_id()), path) as rows, job_settings(spark):
        _upsert_staged(rows, path, key, by, order, cluster, since)


def _upsert_staged(updates: DataFrame, path: str, key: Sequence[str], by: str, order: Sequence[str], cluster: Sequence[str], since: dt.date | None) -> None:
    spark, key = updates.sparkSession, list(key)
    fresh = not _path_exists(updates, path)
    days: list = []
    if not fresh:
        target = spark.read.parquet(path)
        searched = target if since is None else target.filter(F.col(by).isNull() | (F.col(by) >= F.lit(since)))
        # days are found by a hash of the key: equal hashes of other keys name a day too many, whose rows stay as they are
        alike = [F.col(k).cast(updates.schema[k].dataType) for k in key]
        hashes = updates.select(F.xxhash64(*key).alias("__hash")).distinct()
        touched = searched.select(by, F.xxhash64(*alike).alias("__hash")).join(hashes, "__hash", "left_semi").select(by).union(updates.select(by)).distinct()
        # partition values are days: the list is bounded by the calendar, not by the data
        days = [r[0] for r in touched.collect()]
        if not days:
            return
    repeated = _repeated_rows(updates, key, order)
    newest = (updates if repeated is None else updates.join(small_side(repeated), "__row", "left_anti")).drop("__row")
    if fresh:
        write_partitioned(newest, path, by, cluster)
        return
    # the keys of all updates are those of the newest
    kept = join_null_safe(target.filter(_on_days(by, days)), updates.select(*key), key, "left_anti")
    overwrite_partitions(union_by_name(kept, newest), path, by, cluster, replaced=days)


def _replace_days(target: DataFrame, updates: DataFrame, path: str, key: Sequence[str], by: str, order: Sequence[str], cluster: Sequence[str], days: Sequence) -> None:
    """Merges the updates into the given days of the target."""
    merged = merge_by_key(target.filter(_on_days(by, days)), updates, key, order)
    overwrite_partitions(merged, path, by, cluster, replaced=days)


def _on_days(by: str, days: Sequence) -> Column:
    held = F.col(by).isin([x for x in days if x is not None])
    return held | F.col(by).isNull() if None in days else held


def upsert_indexed(
    updates: DataFrame, path: str, key: Sequence[str], by: str, order: Sequence[str] = (), cluster: Sequence[str] = (), buckets: int = 256
) -> None:
    """``upsert_partitions`` for keys of any age, without reading the target to find them.

    Beside the table an index holds the days of each key hash, in ``buckets``
    partitions by hash; only buckets of updated keys are read, 16 bytes a key, and of
    the target only the days that the index names. New entries are appended before
    the table is written and outdated ones removed after it, so a load that died
    leaves an index that names too many days, never too few. Keys of equal hash share
    their days. The index is made from the table where there is none; from then on
    the table must be written by this function alone.
    """
    spark = updates.sparkSession
    if not isinstance(updates.schema[by].dataType, T.DateType):
        raise ValueError(f"partition column {by} must be a date: the list of touched partitions is bounded by the calendar")
    index = f"{path.rstrip('/')}__keys"

    def entries(df: DataFrame) -> DataFrame:
        at = df.select(F.xxhash64(*key).alias("key_hash"), by).distinct()
        return at.withColumn("bucket", F.pmod("key_hash", F.lit(buckets)).cast("int"))

    def stored(days: Sequence | None = None) -> DataFrame:
        # the schema is given, so no file is opened to learn it
        target = spark.read.schema(updates.schema).parquet(path)
        return target if days is None else target.filter(_on_days(by, days))

    fresh = not _path_exists(updates, path)
    if fresh:
        write_partitioned(keep_first(updates, key, [*order, *key]), path, by, cluster)
    if not _path_exists(updates, f"{index}/_SUCCESS"):
        write_partitioned(entries(stored()), index, "bucket", ["key_hash"])
    if fresh:
        return
    new = cut_lineage(entries(updates))
    touched = [r[0] for r in new.select("bucket").distinct().collect()]
    if not touched:
        return
    at = ["key_hash", "bucket"]
    known = spark.read.schema(new.schema).parquet(index).filter(F.col("bucket").isin(touched))
    ours = known.join(new.select(*at).distinct(), at, "left_semi")
    days = [r[0] for r in ours.select(by).union(new.select(by)).distinct().collect()]
    write_partitioned(join_null_safe(new, ours, new.columns, "left_anti"), index, "bucket", ["key_hash"], mode="append")
    _replace_days(stored(), updates, path, key, by, order, cluster, days)

    now = entries(stored(days)).join(new.select(*at).distinct(), at, "left_semi")
    # a key that moved to another day, and a key's older row in the same batch, leave entries behind
    outdated = cut_lineage(join_null_safe(ours.unionByName(new).distinct(), now, new.columns, "left_anti"))
    dirty = [r[0] for r in outdated.select("bucket").distinct().collect()]
    if dirty:
        all_of = spark.read.schema(new.schema).parquet(index).filter(F.col("bucket").isin(dirty)).distinct()
        overwrite_partitions(join_null_safe(all_of, outdated, new.columns, "left_anti"), index, "bucket", ["key_hash"], replaced=dirty)


def _delete(spark, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _files(spark, folder: str) -> set[str]:
    """Names of the files in a folder; none where there is no such folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(p)} if fs.exists(p) else set()


def overwrite_partitions(df: DataFrame, path: str, by: str, cluster: Sequence[str] = (), replaced: Sequence = ()) -> None:
    """Replace the partitions that occur in ``df``; others stay untouched.

    Partitions listed in ``replaced`` that end up without rows are removed. The
    rows are computed in full before the first partition is touched, so ``df`` may read them.
    """
    spark = df.sparkSession
    folders = {f"{path.rstrip('/')}/{by}={NULL_FOLDER if v is None else v}" for v in replaced}
    held = {folder: _files(spark, folder) for folder in folders}
    with job_settings(spark):
        (
            df.hint("rebalance", by)
            .sortWithinPartitions(by, *cluster)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(by)
            .parquet(path)
        )
    for folder, names in held.items():
        # a partition that was written has other files
        if names and names == _files(spark, folder):
            _delete(spark, folder)
