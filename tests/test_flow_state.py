"""The page flow loaded by days equals the flow of all events at once."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from martlib.plans.flow_state import load_page_flow
from martlib.plans.pages import page_flow

SCHEMA = (
    "event_id string, event_name string, event_datetime_utc timestamp, event_date date, user_id string, session_id string, page_location string, "
    "grouped_page_path string, grouped_page_name string, tab string, entity_type string"
)
START = dt.datetime(2024, 1, 1)


def log(seed=3, rows=160, days=6):
    """Events of few sessions over all days, with repeated and unknown locations, equal times and rows without a session."""
    rnd = random.Random(seed)
    out = []
    for i in range(rows):
        t = START + dt.timedelta(minutes=rnd.randrange(days * 48) * 30)
        place = rnd.choice(["/a", "/a", "/b", "/c", None])
        out.append((
            f"e{i:03}", rnd.choice(["page_view", "page_view", "profile_interactions", "scroll"]), t, t.date(), rnd.choice(["u1", "_made", None]),
            rnd.choice(["s1", "s2", "s3", "empty_session_id", None]), place, place, f"{place} Page", rnd.choice(["team", None]), rnd.choice(["Company Tabs", "x"])))
    return out


def day(n):
    return dt.date(2024, 1, n)


def tuples(df, like):
    return sorted((tuple(r) for r in df.select(*like.columns).collect()), key=repr)


def whole(spark, data, **kw):
    df = page_flow(spark.createDataFrame(data, SCHEMA), split=False, **kw)
    df = df.withColumn("session_event_rank", F.col("session_event_rank").cast("long"))
    return df, tuples(df, df)


def upto(data, last):
    return [r for r in data if r[3] <= day(last)]


@pytest.mark.parametrize("n,with_tabs,span", [(4, False, None), (2, True, 6)])
def test_daily_loads_equal_one_load(spark, rows, tmp_path, n, with_tabs, span):
    data = log()
    df, want = whole(spark, data, n=n, with_tabs=with_tabs)
    for first, last in ((None, 1), (2, 2), (2, 4), (3, 5), (6, 6)):
        path = load_page_flow(rows(SCHEMA, upto(data, last)), str(tmp_path), first and day(first), n=n, with_tabs=with_tabs, span=span)
    assert tuples(spark.read.parquet(path), df) == want


def test_days_loaded_again_replace_what_they_held(spark, rows, tmp_path):
    data = log(seed=5)
    load_page_flow(rows(SCHEMA, data), str(tmp_path))
    # from the fourth day on, sessions end earlier than they did: the pages before lose their following ones
    fewer = [r for r in data if r[3] < day(4) or (r[3] == day(4) and r[5] == "s2")]
    path = load_page_flow(rows(SCHEMA, fewer), str(tmp_path), day(4))
    df, want = whole(spark, fewer)
    assert tuples(spark.read.parquet(path), df) == want
    path = load_page_flow(rows(SCHEMA, upto(data, 3)), str(tmp_path), day(4))
    df, want = whole(spark, upto(data, 3))
    assert tuples(spark.read.parquet(path), df) == want
    load_page_flow(rows(SCHEMA, data), str(tmp_path))
    assert tuples(spark.read.parquet(path), df) == whole(spark, data)[1]


def test_a_load_that_died_is_repaired(spark, rows, tmp_path, monkeypatch):
    from martlib.plans import flow_state

    data = log(seed=7)
    path = load_page_flow(rows(SCHEMA, data), str(tmp_path))
    fewer = upto(data, 4)
    real = flow_state.overwrite_partitions
    for dies_at in ("flow", "ends"):
        def dying(df, target, *a, **k):
            return 1 / 0 if target.endswith(dies_at) else real(df, target, *a, **k)

        with monkeypatch.context() as m:
            m.setattr(flow_state, "overwrite_partitions", dying)
            with pytest.raises(ZeroDivisionError):
                load_page_flow(rows(SCHEMA, fewer), str(tmp_path), day(5))
    load_page_flow(rows(SCHEMA, fewer), str(tmp_path), day(5))
    df, want = whole(spark, fewer)
    assert tuples(spark.read.parquet(path), df) == want


def test_days_without_open_sessions_stay_as_they_are(spark, rows, tmp_path):
    data = [(*r[:5], f"{r[5]}-{r[3]}" if r[5] else None, *r[6:]) for r in log(days=5)]  # sessions end at midnight
    data += [("x1", "page_view", START + dt.timedelta(days=3, hours=23, minutes=59), day(4), "u", "night", "/a", "/a", "A Page", None, "x"),
             ("x2", "page_view", START + dt.timedelta(days=4), day(5), "u", "night", "/b", "/b", "B Page", None, "x")]
    path = load_page_flow(rows(SCHEMA, upto(data, 4)), str(tmp_path))
    files = lambda n: sorted(os.listdir(f"{path}/event_date=2024-01-0{n}"))
    before = [files(n) for n in range(1, 5)]
    load_page_flow(rows(SCHEMA, data), str(tmp_path), day(5), span=1)
    assert [files(n) == b for n, b in zip(range(1, 5), before)] == [True, True, True, False]
    df, want = whole(spark, data)
    assert tuples(spark.read.parquet(path), df) == want


def test_the_state_is_a_few_rows_a_session_and_day(spark, rows, tmp_path):
    load_page_flow(rows(SCHEMA, log(rows=600)), str(tmp_path))
    ends = spark.read.parquet(str(tmp_path / "ends")).filter("session_id is not null")
    assert ends.groupBy("session_id", "event_date").count().agg(F.max("count")).first()[0] <= 5
