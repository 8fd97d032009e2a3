"""Loads of sessions and of the page flow: their rows are evaluated once, and sorted or moved when they are few or narrow."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlib.plans import flow_state
from martlib.plans.flow_state import load_page_flow
from martlib.plans.pages import page_flow
from martlib.plans.session_state import load_sessions, session_parts

LONG = (
    "event_id string, event_name string, event_datetime_utc timestamp, user_id string, user_pseudo_id string, session_id string, session_date date, "
    "marketing_source string, marketing_medium string, event_key string, event__string_value string, event__int_value long"
)
EVENTS = (
    "event_id string, event_name string, event_datetime_utc timestamp, event_date date, user_id string, session_id string, page_location string, "
    "grouped_page_path string, grouped_page_name string, tab string, entity_type string, wide string"
)
START = dt.datetime(2024, 1, 1)


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


def long_rows():
    out = []
    for i in range(24):
        t = START + dt.timedelta(hours=i)
        event = (f"e{i:02}", "session_start" if i % 4 == 0 else "page_view", t, f"u{i % 3}", "d", f"s{i % 2}", t.date(), "google", "cpc" if i % 5 else None)
        out += [(*event, "page_location", f"/p{i}", None), (*event, "engagement_time_msec", None, i)]
    return out


def test_session_parts_sort_events_and_not_long_rows(rows):
    parts = session_parts(rows(LONG, long_rows()), ["marketing_source"])
    plan = parts._jdf.queryExecution().executedPlan().toString()
    # operators are listed from the last to the first
    assert plan.rindex("SortAggregate(") < plan.index("HashAggregate(")
    got = parts.select("session_id", "engagement_msec", "first_landing.v").orderBy("session_id").collect()
    assert [tuple(r) for r in got] == [("s0", sum(range(0, 24, 2)), "/p0"), ("s1", sum(range(1, 24, 2)), None)]


def test_a_load_of_sessions_evaluates_its_rows_once(rows, tmp_path, counted):
    data = long_rows()
    bots = rows("date_day date, country string", [])
    df = counted(rows(LONG, data), "event_name").withColumn("geo__country", F.lit("France"))
    load_sessions(df, str(tmp_path), "one", bots, dimensions=["geo__country"], marketing=["marketing_source", "marketing_medium"])
    assert counted.seen() == len(data)


def flow_rows():
    """Pages of five days; sessions go on over midnight, and two events of one session may share their time."""
    out = []
    for i in range(120):
        t = START + dt.timedelta(hours=i // 2 * 2)
        page = f"/{'aabcd'[i * 7 % 5]}"
        out.append((f"e{i:03}", ["page_view", "page_view", "profile_interactions"][i % 3], t, t.date(), ["u", "_x"][i % 2], f"s{i % 3}" if i % 10 else None, page, page, page, "team", "Company Tabs", f"w{i}"))
    return out


def test_a_load_of_the_flow_evaluates_its_events_once(spark, rows, tmp_path, counted):
    data = flow_rows()
    path = load_page_flow(counted(rows(EVENTS, data), "wide"), str(tmp_path))
    assert counted.seen() == len(data)
    want = page_flow(rows(EVENTS, data), split=False).withColumn("session_event_rank", F.col("session_event_rank").cast("long"))
    assert rows.sorted(spark.read.parquet(path), *want.columns) == rows.sorted(want)


def test_windows_of_the_flow_move_no_other_columns(spark, rows, tmp_path, monkeypatch):
    seen, real = [], flow_state.chained

    def spied(df, *a, **k):
        seen.append(df.columns)
        return real(df, *a, **k)

    monkeypatch.setattr(flow_state, "chained", spied)
    for first, last in ((None, 2), (2, 3), (4, 5)):
        upto = [r for r in flow_rows() if r[3] <= dt.date(2024, 1, last)]
        path = load_page_flow(rows(EVENTS, upto), str(tmp_path), first and dt.date(2024, 1, first))
    assert len(seen) == 3 and not any({"wide", "user_id", "event_name", "entity_type"} & set(columns) for columns in seen)
    want = page_flow(rows(EVENTS, flow_rows()), split=False).withColumn("session_event_rank", F.col("session_event_rank").cast("long"))
    assert rows.sorted(spark.read.parquet(path), *want.columns) == rows.sorted(want)
