"""Sessions loaded in parts equal the sessions of all rows at once."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martlib.operators import quality as Q
from martlib.plans import events as E
from martlib.plans.session_state import load_sessions, merge_parts, session_parts

SCHEMA = (
    "event_id string, event_name string, event_datetime_utc timestamp, user_id string, user_pseudo_id string, session_id string, session_date date, "
    "geo__country string, marketing_source string, marketing_medium string, event_key string, event__string_value string, event__int_value long"
)
ARGS = dict(dimensions=["geo__country"], marketing=["marketing_source", "marketing_medium"], regions=[("Home", ["Israel"])])


def event(i, session, day, hour, name="page_view", user="empty_user_id", source="google", medium="organic", device="d", country="Israel", date=0):
    t = dt.datetime(2024, 1, day, hour, i % 60)
    common = (f"e{i:03}", name, t, user, device, session, dt.date(2024, 1, date or day), country, source, medium)
    return [(*common, "page_location", f"/p{i}", None), (*common, "engagement_time_msec", None, 1000 * i)]


def log():
    """Sessions of one day, one over midnight, one of two devices and dates, one without a date, and rows without a session."""
    out = []
    for i in range(40):
        day = i % 4 + 1
        out += event(i, f"s{i % 3}-{day}", day, i % 24, "session_start" if i % 5 == 0 else "page_view", user=f"u{i % 2}" if i % 3 else "empty_user_id")
    out += event(50, "night", 2, 23, "first_visit") + event(51, "night", 3, 0, date=2, medium="cpc") + event(52, "night", 3, 1, date=2, user="late")
    out += event(53, "two", 1, 5, device="a") + event(54, "two", 2, 6, device="b", country="France") + event(55, "two", 2, 7, device=None)
    out += [(*r[:6], None, *r[7:]) for r in event(56, "undated", 4, 8)]
    out += event(57, None, 1, 1) + event(58, "empty_session_id", 1, 1)
    return out


@pytest.fixture()
def bots(rows):
    return rows("date_day date, country string", [(dt.date(2024, 1, 2), "france"), (dt.date(2024, 1, 3), "israel")])


def loaded(spark, path, like):
    return sorted((tuple(r) for r in spark.read.parquet(path).select(*like.columns).collect()), key=repr)


def whole(spark, data, bots):
    df = E.build_sessions(spark.createDataFrame(data, SCHEMA), bots, **ARGS)
    return df, sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("span", [None, 1])
def test_loads_in_any_order_equal_one_load(spark, rows, bots, tmp_path, span):
    data = log()
    df, want = whole(spark, data, bots)
    # later days first, then parts of events (their long rows are dealt to different loads), one load twice and an empty one
    loads = {"b": [r for r in data if r[2].day >= 3], "a": [r for i, r in enumerate(data) if r[2].day < 3 and i % 2], "late": [r for i, r in enumerate(data) if r[2].day < 3 and not i % 2], "none": []}
    for name in ("b", "late", "none", "a", "late"):
        path = load_sessions(rows(SCHEMA, loads[name]), str(tmp_path), name, bots, span=span, **ARGS)
    assert loaded(spark, path, df) == want
    assert Q.unique(spark.read.parquet(path), ["user_pseudo_id", "session_id", "session_date"]).count() == 0
    assert not os.path.exists(tmp_path / "pending/load=late")


def test_a_load_replaces_what_it_said_before(spark, rows, bots, tmp_path):
    data = log()
    first, second = data[:60], data[60:]
    load_sessions(rows(SCHEMA, first), str(tmp_path), "x", bots, **ARGS)
    path = load_sessions(rows(SCHEMA, second), str(tmp_path), "y", bots, **ARGS)
    # the second run under the name lacks sessions of the first: they go, and their empty days with them
    df, want = whole(spark, first[:10] + second, bots)
    load_sessions(rows(SCHEMA, first[:10]), str(tmp_path), "x", bots, **ARGS)
    assert loaded(spark, path, df) == want
    load_sessions(rows(SCHEMA, []), str(tmp_path), "x", bots, **ARGS)
    load_sessions(rows(SCHEMA, data[:2]), str(tmp_path), "y", bots, **ARGS)
    df, want = whole(spark, data[:2], bots)
    assert loaded(spark, path, df) == want


def test_a_load_that_died_is_repaired(spark, rows, bots, tmp_path, monkeypatch):
    from martlib.plans import session_state

    data = log()
    load_sessions(rows(SCHEMA, data[:40]), str(tmp_path), "x", bots, **ARGS)
    path = load_sessions(rows(SCHEMA, data[40:]), str(tmp_path), "y", bots, **ARGS)
    with monkeypatch.context() as m:
        m.setattr(session_state, "overwrite_partitions", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_sessions(rows(SCHEMA, data[:4]), str(tmp_path), "x", bots, **ARGS)
    load_sessions(rows(SCHEMA, data[:4]), str(tmp_path), "x", bots, **ARGS)
    df, want = whole(spark, data[:4] + data[40:], bots)
    assert loaded(spark, path, df) == want


def test_only_touched_days_are_written(spark, rows, bots, tmp_path):
    data = log()
    path = load_sessions(rows(SCHEMA, data), str(tmp_path), "x", bots, **ARGS)
    files = lambda day: sorted(os.listdir(f"{path}/session_date=2024-01-0{day}"))
    before = {d: files(d) for d in (1, 2, 3, 4)}
    load_sessions(rows(SCHEMA, event(90, "s0-4", 4, 23)), str(tmp_path), "late", bots, span=1, **ARGS)
    assert [files(d) == before[d] for d in (1, 2, 3, 4)] == [True, True, True, False]


def test_parts_merge_in_any_grouping(spark, rows):
    df = rows(SCHEMA, log()).filter("session_id is not null")
    dims = [*ARGS["dimensions"], *ARGS["marketing"]]
    part = lambda i: session_parts(df.filter(F.abs(F.hash("event_id", "event_key")) % 3 == i), dims)
    once = rows.sorted(merge_parts(session_parts(df, dims)))
    assert rows.sorted(merge_parts(part(0).union(part(1)).union(part(2)))) == once
    assert rows.sorted(merge_parts(merge_parts(part(2).union(part(0))).union(part(1)))) == once


def test_names_of_loads_are_checked(rows, bots, tmp_path):
    with pytest.raises(ValueError):
        load_sessions(rows(SCHEMA, []), str(tmp_path), "a/b", bots, **ARGS)
