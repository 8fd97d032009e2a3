"""Sinks and sources: pruning, upserts, overwrites, lookback, streams."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martlib.sources import readers, writers
from martlib.streaming import streams

DAY = dt.date(2024, 1, 1)
SCHEMA = "id int, day date, v int, at int"


def day(n):
    return DAY + dt.timedelta(days=n)


def test_shards_are_pruned(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(rows("id int, event_date date", [(i, day(i % 5)) for i in range(50)]), path, "event_date")
    df = readers.read_shards(spark, path, day(1), day(2))
    assert df.count() == 20
    assert len(df.inputFiles()) == 5  # the listing of the source; the scan itself is checked in the plan
    assert "PartitionFilters: [isnotnull(event_date" in df._jdf.queryExecution().executedPlan().toString()


def test_shard_range(spark):
    today = day(30)
    assert readers.shard_range(today, 3, day(28)) == (day(27), today)
    assert readers.shard_range(today, 3, day(10)) == (day(10), today)
    assert readers.shard_range(today, 3, None) == (day(27), today)


def test_month_partitions_and_hot_values(spark, rows, tmp_path):
    df = rows("id int, d date", [(i, day(i)) for i in range(60)])
    path = str(tmp_path / "m")
    writers.write_partitioned(df, path, "d", ["id"], grain="month")
    months = sorted(n for n in os.listdir(path) if n.startswith("d_month="))
    assert months == ["d_month=2024-01-01", "d_month=2024-02-01"]
    # one value with nearly all rows is written by several tasks
    hot, old = str(tmp_path / "hot"), spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
        big = spark.range(0, 100_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"), F.lit(day(0)).alias("d"))
        writers.write_partitioned(big, hot, "d", ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert sum(n.endswith(".parquet") for n in os.listdir(f"{hot}/d={day(0)}")) > 3
    assert spark.read.parquet(hot).count() == 100_000
    with pytest.raises(ValueError):
        writers.with_partition(df, "d", "year")


def test_upsert_is_idempotent_and_moves_keys(spark, rows, tmp_path):
    path = str(tmp_path / "u")
    first = rows(SCHEMA, [(1, day(0), 10, 1), (2, day(1), 20, 1), (3, day(2), 30, 1), (3, day(2), 31, 2)])
    writers.upsert_partitions(first, path, ["id"], "day", ["-at"])
    second = rows(SCHEMA, [(1, day(5), 11, 2), (4, day(1), 40, 2)])
    want = [(1, day(5), 11), (2, day(1), 20), (3, day(2), 31), (4, day(1), 40)]
    for _ in range(2):
        writers.upsert_partitions(second, path, ["id"], "day", ["-at"])
        assert rows.sorted(spark.read.parquet(path), "id", "day", "v") == want
    # the day that lost its only row is gone, the day nobody touched was not rewritten
    assert not os.path.exists(f"{path}/day={day(0)}")
    assert not [n for n in os.listdir(tmp_path) if "staging" in n]


def test_rows_without_a_day_are_a_partition_like_any_other(spark, rows, tmp_path):
    path = str(tmp_path / "n")
    writers.write_partitioned(rows(SCHEMA, [(1, day(0), 1, 1), (2, None, 2, 1), (3, None, 3, 1), (4, None, 4, 1)]), path, "day")
    writers.upsert_partitions(rows(SCHEMA, [(9, None, 9, 2), (3, day(1), 33, 2)]), path, ["id"], "day")
    assert rows.sorted(spark.read.parquet(path), "id", "day", "v") == [(1, day(0), 1), (2, None, 2), (3, day(1), 33), (4, None, 4), (9, None, 9)]
    writers.upsert_partitions(rows(SCHEMA, [(i, day(2), 7, 3) for i in (2, 4, 9)]), path, ["id"], "day", since=day(2))
    assert rows.sorted(spark.read.parquet(path), "id", "day") == [(1, day(0)), (2, day(2)), (3, day(1)), (4, day(2)), (9, day(2))]
    assert not os.path.exists(f"{path}/day={writers.NULL_FOLDER}")


def test_partitions_are_days(rows, tmp_path):
    with pytest.raises(ValueError):
        writers.upsert_partitions(rows("id int, kind string", [(1, "a")]), str(tmp_path / "x"), ["id"], "kind")


def test_since_leaves_older_partitions_unread(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    writers.write_partitioned(rows(SCHEMA, [(1, day(0), 1, 1), (2, day(5), 2, 1)]), path, "day")
    # key 1 also lies in an older day, which a search from day 4 on must not see
    writers.upsert_partitions(rows(SCHEMA, [(1, day(6), 11, 2), (2, day(6), 22, 2)]), path, ["id"], "day", since=day(4))
    assert rows.sorted(spark.read.parquet(path), "id", "day", "v") == [(1, day(0), 1), (1, day(6), 11), (2, day(6), 22)]


def test_untouched_partitions_keep_their_files(spark, rows, tmp_path):
    path = str(tmp_path / "k")
    writers.upsert_partitions(rows(SCHEMA, [(1, day(0), 1, 1), (2, day(1), 1, 1)]), path, ["id"], "day")
    before = sorted(os.listdir(f"{path}/day={day(0)}"))
    writers.upsert_partitions(rows(SCHEMA, [(2, day(1), 2, 2)]), path, ["id"], "day")
    assert sorted(os.listdir(f"{path}/day={day(0)}")) == before


def test_lookback_with_and_without_a_target(spark, rows):
    df = rows("d date", [(day(i),) for i in range(40)])
    assert writers.lookback(df, "d", 7, day(10), day(30)).count() == 21
    assert writers.lookback(df, "d", 7, day(29), day(30)).count() == 8
    assert writers.lookback(df, "d", 7, None, day(30)).count() == 31


def test_materialize(spark, rows, tmp_path):
    df = rows("a int", [(1,), (2,)])
    writers.materialize(df, "mv")
    assert spark.table("mv").count() == 2
    assert writers.materialize(df, "mt", "table", str(tmp_path / "mt")).count() == 2
    with pytest.raises(ValueError):
        writers.materialize(df, "x", "other")


def test_jdbc_reader_is_partitioned(monkeypatch):
    seen = {}

    class Reader:
        def format(self, f):
            seen["format"] = f
            return self

        def options(self, **kw):
            seen.update(kw)
            return self

        def load(self):
            return "df"

    class Session:
        read = Reader()

    assert readers.read_table(Session(), "orders", jdbc={"url": "u"}, partition=("id", 0, 100, 8)) == "df"
    assert seen == {"format": "jdbc", "url": "u", "dbtable": "orders", "partitionColumn": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 8}


def test_null_keys_are_replaced_like_others(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "a int, b string, v int, day date"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    batch = rows(schema, [(None, "x", 1, d1), (None, "x", 2, d1), (None, None, 3, d1), (1, None, 4, d2), (1, "x", 5, d2)])
    want = [(None, "x", 2, d1), (None, None, 3, d1), (1, None, 4, d2), (1, "x", 5, d2)]
    for _ in range(3):
        writers.upsert_partitions(batch, path, ["a", "b"], "day", ["-v"])
        assert rows.sorted(spark.read.parquet(path), "a", "b", "v", "day") == sorted(want, key=repr)
    # a key with NULL moves to another day
    writers.upsert_partitions(rows(schema, [(None, "x", 9, d2)]), path, ["a", "b"], "day", ["-v"])
    assert rows.sorted(spark.read.parquet(path), "a", "b", "v", "day") == sorted([(None, "x", 9, d2), *want[1:]], key=repr)


def test_stream_dedup_and_upsert(spark, rows, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    data = rows("id int, ts timestamp, day date, v int", [(i % 10, dt.datetime(2024, 1, 1, i), day(0), i) for i in range(20)])
    data.coalesce(1).write.parquet(src)
    sdf = spark.readStream.schema(data.schema).parquet(src)
    q = streams.stream_dedup(sdf, "id", "ts", "2 days").writeStream.format("memory").queryName("dedup").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("dedup").count() == 10
    for _ in range(2):  # a new checkpoint replays the same batch
        streams.stream_upsert(sdf, out, str(tmp_path / f"c{_}"), ["id"], "day", ["-v"], lookback_days=7).awaitTermination()
        assert rows.sorted(spark.read.parquet(out), "id", "v") == [(i, i + 10) for i in range(10)]


def test_session_date_is_carried_over(spark, rows):
    ev = rows("session_id string, event_date date, i int", [("a", day(3), 1), ("a", day(4), 2), ("b", day(5), 3), (None, day(1), 4)])
    prior = rows("session_id string, session_date date", [("a", day(1)), ("a", day(2))])
    for split in (False, True):
        out = streams.carry_session_date(ev, prior, split=split)
        assert rows.sorted(out, "i", "session_date") == [(1, day(1)), (2, day(1)), (3, day(5)), (4, day(1))]
    assert rows.sorted(streams.carry_session_date(ev, prior.filter(F.lit(False))), "i", "session_date")[0] == (1, day(3))


def test_streamed_session_dates_equal_those_of_one_batch(spark, rows, tmp_path):
    """Three batches by time, sessions over their borders, rows without a session or a time, and a last row that ends all sessions."""
    at = lambda d, h, m=0: dt.datetime(2024, 1, d, h, m)
    schema = "i int, session_id string, ts timestamp"
    batches = [
        [(1, "a", at(1, 23, 50)), (2, "b", at(1, 12)), (3, None, at(1, 13)), (4, "c", None)],
        [(5, "a", at(2, 0, 10)), (6, "b", at(2, 9)), (7, "a", at(2, 0, 10))],
        # a late event joins the session of the first batch, and one before it starts it a day earlier
        [(8, "a", at(2, 0, 30)), (9, "d", at(3, 0, 5)), (10, "d", at(2, 23, 55)), (11, None, None)],
        [(99, "z", at(20, 0))],
    ]
    for n, data in enumerate(batches):
        rows(schema, data).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    sdf = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = streams.stream_session_dates(sdf, delay="1 day", pause="30 minutes", longest="2 days")
    q = out.writeStream.format("memory").queryName("dated").trigger(availableNow=True).start()
    q.awaitTermination()
    want = {1: 1, 5: 1, 7: 1, 8: 1, 2: 1, 6: 2, 3: 1, 4: None, 9: 2, 10: 2, 11: None}
    assert dict(rows.sorted(spark.table("dated"), "i", "session_date")) == {i: d and dt.date(2024, 1, d) for i, d in want.items()}
    # only the open session of the last row is left
    assert sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"]) <= 2
