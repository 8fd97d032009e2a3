"""Long plans are evaluated once, and rows move through windows without the columns they do not need."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlib.catalog import stand_ins
from martlib.functions.text import surrogate_key
from martlib.operators.ordered import Lag, LastValue, RunningCount, chained
from martlib.plans.events import identified_sessions, rank_page_views
from martlib.plans.pages import page_flow
from martlib.sources.writers import upsert_partitions


@pytest.fixture()
def counted(spark):
    """``counted(df, column)`` counts how often rows are evaluated; ``counted.seen()`` is the number."""
    total = spark.sparkContext.accumulator(0)

    def make(df, column):
        def one(x):
            total.add(1)
            return x

        return df.withColumn(column, F.udf(one, df.schema[column].dataType).asNondeterministic()(column))

    make.seen = lambda: total.value
    return make


def test_events_are_dealt_over_all_tasks(spark, tmp_path):
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))
    events = spark.range(400).select(
        F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 9).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"),
        F.lit('{"k": 3}').alias("props"))
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    sizes = stand_ins.flat_events(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(r[1] for r in sizes) == 400


def test_upsert_evaluates_its_updates_once(spark, rows, tmp_path, counted):
    schema, day = "id int, day date, v int", dt.date(2024, 1, 1)
    path = f"{tmp_path}/t"
    upsert_partitions(rows(schema, [(i, day, 0) for i in range(20)]), path, ["id"], "day")
    upsert_partitions(counted(rows(schema, [(i, day, 1) for i in range(10, 40)]), "v"), path, ["id"], "day")
    assert rows.sorted(spark.read.parquet(path), "id", "v") == sorted([(i, 0) for i in range(10)] + [(i, 1) for i in range(10, 40)], key=repr)
    assert counted.seen() == 30


def test_each_of_many_window_steps_is_written(spark, rows):
    df = rows("k int, t int, v int", [(i % 3, i, i if i % 4 else None) for i in range(60)])
    steps = [{"a": Lag(F.col("v"))}, {"b": LastValue(F.col("a"), "rows")}, {"c": RunningCount(F.col("b") > 5)}, {"d": Lag(F.col("c"))}]
    got = chained(df, ["k"], ["t"], steps)
    # windows over the rows are behind the last writing; those over the summaries remain
    assert "row_number()" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert rows.sorted(got, "k", "t", "a", "b", "c", "d") == rows.sorted(chained(df, ["k"], ["t"], steps, split=False), "k", "t", "a", "b", "c", "d")


def pages(rows, counted=None):
    at = dt.datetime(2024, 1, 1)
    data = [
        (f"e{i}", ["page_view", "scroll"][i % 2], None if i % 11 == 0 else f"s{i % 3}", at + dt.timedelta(seconds=i // 2), i % 4, f"/p{i // 5 % 3}", f"url{i // 5 % 3}", i / 2, "Company Page", None, None, f"u{i}")
        for i in range(60)]
    df = rows(
        "event_id string, event_name string, session_id string, event_datetime_utc timestamp_ntz, batch_sort_key int, page_path string, page_location string, engagement_time_seconds double, "
        "grouped_page_name string, tab string, entity_type string, user_id string", data).withColumn("grouped_page_path", F.col("page_path"))
    return counted(df, "page_location") if counted else df


def test_page_ranks_evaluate_their_events_once(rows, counted):
    want, got = rank_page_views(pages(rows), False), rank_page_views(pages(rows, counted), True)
    assert sorted(want.columns) == sorted(got.columns)
    assert rows.sorted(got, *want.columns) == rows.sorted(want)
    assert counted.seen() == 60


def test_page_flow_evaluates_its_events_once(rows, counted):
    want, got = page_flow(pages(rows), 3, split=False), page_flow(pages(rows, counted), 3)
    assert rows.sorted(got, *want.columns) == rows.sorted(want)
    assert counted.seen() == 60


def test_stitching_moves_no_wide_columns(rows):
    at = dt.datetime(2024, 1, 3, 10)
    data = [(None if i % 3 else f"u{i % 2}", None if i % 7 == 0 else f"p{i % 4}", i % 2, at + dt.timedelta(minutes=i // 2), "session_start" if i % 5 == 0 else "view", "FR", i % 2, i % 2, [f"wide{i}"]) for i in range(50)]
    df = rows("user_id string, user_pseudo_id string, ga_session_id long, event_datetime_utc timestamp_ntz, event_name string, country string, ga_session_number long, session_engaged long, params array<string>", data)
    df = df.withColumns({
        "event_date": F.col("event_datetime_utc").cast("date"), "event_date_key": F.lit("20240103"), "event_timestamp": F.unix_micros(F.col("event_datetime_utc").cast("timestamp")),
        "event_id": surrogate_key("user_pseudo_id", "event_datetime_utc", "event_name")}).checkpoint()
    want, got = identified_sessions(df, None, ["country"], False), identified_sessions(df, None, ["country"], True)
    assert rows.sorted(got, *want.columns) == rows.sorted(want) and got.count() == 50
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # one join alone sees the parameters
    assert sum("params#" in line and "Project" in line for line in plan.splitlines()) <= 3
