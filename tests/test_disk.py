"""Loads hold one copy of what they move: finished steps leave no shuffle files, and whole rows are shuffled once."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from martlib.catalog.stand_ins import nested_events
from martlib.plans import identity_state
from martlib.session import cut_lineage
from martlib.sources import writers

DAY = [dt.date(2024, 1, n + 1) for n in range(5)]
SCHEMA = "id int, day date, v int, at int"


@pytest.fixture()
def new_shuffle_files(spark):
    """Names of the shuffle files that were not there before the test; Spark removes files in the background, so some time is given."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def names():
        found = manager.getAllFiles()
        return {n for n in (found.apply(i).getName() for i in range(found.size())) if n.startswith("shuffle_")}

    before = names()

    def new():
        until = time.time() + 10
        while names() - before and time.time() < until:
            time.sleep(0.1)
        return names() - before

    return new


def test_written_frames_leave_no_shuffle_files(spark, new_shuffle_files):
    df = cut_lineage(spark.range(200).groupBy((F.col("id") % 7).alias("k")).count())
    assert not new_shuffle_files()
    assert sorted(r["count"] for r in df.collect()) == [28] * 3 + [29] * 4


def test_upserts_leave_no_shuffle_files_and_no_staging(spark, rows, tmp_path, new_shuffle_files):
    path = f"{tmp_path}/t"
    writers.upsert_partitions(rows(SCHEMA, [(i, DAY[i % 5], i, 1) for i in range(50)]), path, ["id"], "day", ["-at"])
    # keys that repeat among the updates, that move to another day, that are new, and one without a value
    more = [(i, DAY[(i + i % 2) % 5], -i, at) for i in (1, 2, 3, 60) for at in (2, 4, 3)] + [(None, DAY[0], 7, 1), (None, DAY[0], 8, 2)]
    writers.upsert_partitions(rows(SCHEMA, more), path, ["id"], "day", ["-at"])
    assert not new_shuffle_files()
    assert os.listdir(tmp_path) == ["t"]
    want = {i: (i, DAY[i % 5], i, 1) for i in range(50)} | {i: (i, DAY[(i + i % 2) % 5], -i, 4) for i in (1, 2, 3, 60)} | {None: (None, DAY[0], 8, 2)}
    assert rows.sorted(spark.read.parquet(path), "id", "day", "v", "at") == sorted(want.values(), key=repr)


def test_overwrite_reads_what_it_replaces_and_removes_emptied_days(spark, rows, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    writers.write_partitioned(rows(SCHEMA, [(i, DAY[i % 3], i, 1) for i in range(9)]), path, "day")
    held = {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("day=")}
    monkeypatch.setattr(writers, "write_partitioned", None)  # rows are written once, not staged and written again
    moved = spark.read.parquet(path).filter(F.col("day") < DAY[2]).withColumn("day", F.lit(DAY[1]))
    writers.overwrite_partitions(moved, path, "day", replaced=[DAY[0], DAY[1], DAY[4]])
    assert {d for d in os.listdir(path) if d.startswith("day=")} == {"day=2024-01-02", "day=2024-01-03"}
    assert sorted(os.listdir(f"{path}/day=2024-01-03")) == held["day=2024-01-03"]
    assert [r[0] for r in spark.read.parquet(path).filter(F.col("day") == DAY[1]).select("id").orderBy("id").collect()] == [0, 1, 3, 4, 6, 7]


def test_an_upsert_that_fails_leaves_the_table_and_no_staging(spark, rows, tmp_path):
    path = f"{tmp_path}/t"
    writers.upsert_partitions(rows(SCHEMA, [(1, DAY[0], 1, 1)]), path, ["id"], "day")
    broken = rows(SCHEMA, [(1, DAY[0], 2, 1)]).withColumn("v", F.raise_error(F.lit("no value")).cast("int"))
    with pytest.raises(Exception, match="no value"):
        writers.upsert_partitions(broken, path, ["id"], "day")
    assert os.listdir(tmp_path) == ["t"]
    assert rows.sorted(spark.read.parquet(path), "id", "day", "v", "at") == [(1, DAY[0], 1, 1)]


def test_identity_loads_checkpoint_no_wide_rows(spark, tmp_path, monkeypatch):
    data = [(i, dt.datetime(2024, 1, 1 + i % 3, i % 20), i % 4, "view", float(i), '{"k": %d}' % (i % 6)) for i in range(1, 30)]
    spark.createDataFrame(data, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    raw, seen = cut_lineage(nested_events(spark, str(tmp_path))), []

    def spied(df):
        seen.append(set(df.columns))
        return cut_lineage(df)

    monkeypatch.setattr(identity_state, "cut_lineage", spied)
    late = F.col("event_bundle_sequence_id") % 7 == 3
    for events, arrived in ((raw.filter(~late), raw.filter(~late)), (raw, raw.filter(late))):
        identity_state.load_identities(events, arrived, f"{tmp_path}/loaded", dimensions=["geo__country", "device__category"])
    assert seen and not any({"event_params", "event_params_key_id"} & columns for columns in seen)
    assert sorted(os.listdir(f"{tmp_path}/loaded")) == ["seen", "table", "visitors"]
    assert spark.read.parquet(f"{tmp_path}/loaded/table").count() == 29 * 6
