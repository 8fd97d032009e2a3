"""Which files a write touches and a filter reads: key index and space-filling curve."""

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martlib.sources import writers

SCHEMA = "k string, v int, day date"


def day(n):
    return dt.date(2024, 1, n)


def files(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if "=" in d}


def read(spark, rows, path):
    return rows.sorted(spark.read.schema(SCHEMA).parquet(path), "k", "v", "day")


def test_indexed_upsert_reads_only_days_of_its_keys(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    data = [(f"k{i}", i, day(1 + i % 5)) for i in range(20)] + [(None, 100, day(2)), ("late", 101, None)]
    up = lambda d: writers.upsert_indexed(rows(SCHEMA, d), path, ["k"], "day", ["-v"], buckets=4)
    up(data)
    # the other days cannot be read: their files are no parquet
    for n in (4, 5):
        for f in glob.glob(f"{path}/day=2024-01-0{n}/*.parquet"):
            with open(f, "w") as out:
                out.write("not a table")
    before = files(path)
    # k0 moves to a new day, k1 stays, a NULL key and a key without a day are replaced, one key is new and given twice
    up([("k0", 500, day(9)), ("k1", 501, day(2)), (None, 502, day(3)), ("late", 503, day(1)), ("new", 1, day(3)), ("new", 504, day(9))])
    after = files(path)
    assert {d for d in before if before[d] == after.get(d)} == {"day=2024-01-04", "day=2024-01-05"}
    # moved keys are found again, and the days that they left are not named any more
    up([("k0", 600, day(9)), ("new", 601, day(9))])
    again = files(path)
    assert {d for d in again if again[d] != after.get(d)} == {"day=2024-01-09"}
    want = {r[0]: r for r in data} | {"k0": ("k0", 600, day(9)), "k1": ("k1", 501, day(2)), None: (None, 502, day(3)), "late": ("late", 503, day(1)), "new": ("new", 601, day(9))}
    readable = spark.read.schema(SCHEMA).parquet(path).filter(~F.coalesce(F.col("day").isin(day(4), day(5)), F.lit(False)))
    assert rows.sorted(readable, "k", "v", "day") == sorted((r for r in want.values() if r[2] not in (day(4), day(5))), key=repr)


def test_indexed_upsert_that_died_is_repaired(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    up = lambda d: writers.upsert_indexed(rows(SCHEMA, d), path, ["k"], "day", ["-v"], buckets=2)
    up([("a", 1, day(1)), ("b", 2, day(2))])
    real = writers.overwrite_partitions

    def dying(df, target, *a, **k):
        if target.endswith("__keys"):
            raise ZeroDivisionError
        return real(df, target, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(writers, "overwrite_partitions", dying)
        with pytest.raises(ZeroDivisionError):
            up([("a", 3, day(4))])
    assert read(spark, rows, path) == [("a", 3, day(4)), ("b", 2, day(2))]
    up([("a", 5, day(6))])
    up([])
    assert read(spark, rows, path) == [("a", 5, day(6)), ("b", 2, day(2))]


def test_a_filter_on_any_clustered_column_reads_few_files(spark, tmp_path):
    n, path = 20_000, str(tmp_path / "c")
    r = lambda seed, top: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(top))
    df = spark.range(n).select(F.lit(day(1)).alias("day"), r(1, 1000).alias("a"), r(2, 1000).cast("string").alias("b"), F.when(F.col("id") % 9 > 0, r(3, 1000) / 7).alias("c"))
    writers.write_curved(df, path, "day", ["a", "b", "c"], max_records_per_file=400)
    found = glob.glob(f"{path}/day=*/*.parquet")
    assert spark.read.parquet(path).select(*df.columns).exceptAll(df).count() == 0 and sum(pq.ParquetFile(f).metadata.num_rows for f in found) == n
    share = {}
    for i, (name, value) in enumerate((("a", 500), ("b", "500"), ("c", 70.0))):
        stats = [pq.ParquetFile(f).metadata.row_group(0).column(i).statistics for f in found]
        share[name] = sum(s.has_min_max and s.min <= value <= s.max for s in stats) / len(found)
    assert len(found) >= 50 and max(share.values()) < 0.5, share


def test_curve_of_any_values(spark, rows, tmp_path):
    schema = "day date, s string, d double, t timestamp_ntz, b boolean"
    data = [(day(1), "x" * 1000, float("nan"), dt.datetime(2024, 1, 1), True), (None, None, None, None, None), (day(2), "", float("-inf"), dt.datetime(1970, 1, 1), False)]
    for n, some in enumerate((data, [data[1]], [])):
        path = str(tmp_path / str(n))
        writers.write_curved(rows(schema, some), path, "day", ["s", "d", "t", "b"])
        # NaN is unequal to itself
        text = lambda df: rows.sorted(df.withColumn("d", F.col("d").cast("string")), "day", "s", "d", "t", "b")
        assert text(spark.read.schema(schema).parquet(path)) == text(rows(schema, some))
    with pytest.raises(ValueError):
        writers.write_curved(rows(schema, data), path, "day", [])
