"""Long rows are pivoted by plain maxima, and events are dealt over more tasks where there are many."""

import datetime as dt

from pyspark.sql import functions as F

from martlib.catalog import registry, stand_ins
from martlib.plans.events import pivot_long


def test_pivot_makes_no_struct_of_each_value(rows):
    at = dt.datetime(2024, 1, 1)
    schema = "event_id string, event_datetime_utc timestamp, event_key string, event__string_value string, event__int_value double, event__double_value double"
    data = [(e, t, k, v, 1000.0 if k == "engagement_time_msec" else None, None)
            for e, t in (("e1", at), ("e1", at + dt.timedelta(1)), ("e2", None), (None, at)) for k, v in (("action", "a"), ("action", "b"), ("label", None), ("engagement_time_msec", None))]
    got = pivot_long(rows(schema, data), ["action", "label"])
    assert "struct(o" not in got._jdf.queryExecution().optimizedPlan().toString()
    want = [(e, t, 1.0, "b", None) for e, t in (("e1", at), ("e1", at + dt.timedelta(1)), ("e2", None), (None, at))]
    assert rows.sorted(got, "event_id", "event_datetime_utc", "engagement_time_seconds", "action", "label") == sorted(want, key=repr)


def test_many_events_are_dealt_over_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "TASK_ROWS", 50)
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))
    events = spark.range(400).select(
        F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 9).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 3}').alias("props"))
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    sizes = [r[1] for r in stand_ins.flat_events(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and sum(sizes) == 400
