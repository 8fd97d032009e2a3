"""Tables whose rows depend on sessions, loaded by days, equal one full load."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from martlib.plans import incremental
from martlib.plans.incremental import load_continuing

SCHEMA = "event_id int, event_date date, session_id string, value long"


def day(n):
    return dt.date(2024, 1, n)


def log(seed=1, rows=120, days=6):
    rnd = random.Random(seed)
    out = []
    for i in range(rows):
        n = rnd.randrange(days)
        # sessions of at most two days, rows without a session, and the id that stands for none
        out.append((i, day(n + 1), rnd.choice([f"a{n // 2}", f"b{(n + 1) // 2}", f"c{n}", "none", None]), rnd.randrange(5)))
    return out


def build(rows):
    """A rank, a total and the first day of each session; rows without a session stand alone."""
    key = F.when(F.col("session_id").isNull() | (F.col("session_id") == "none"), F.concat(F.lit("#"), "event_id")).otherwise(F.col("session_id"))
    w = Window.partitionBy("__key")
    return rows.withColumn("__key", key).select(
        "*", F.row_number().over(w.orderBy("event_date", "event_id")).alias("n"), F.sum("value").over(w).alias("total"),
        F.min("event_date").over(w).alias("first_day")).drop("__key")


def load(rows, data, folder, since=None, **kw):
    return load_continuing(rows(SCHEMA, data), build, str(folder), **{"by": "event_date", "since": since and day(since), "span": 1, "empty": "none", **kw})


def upto(data, last):
    return [r for r in data if r[1] <= day(last)]


def check(spark, rows, path, data):
    want = build(rows(SCHEMA, data))
    # an emptied table has no file that tells its columns
    assert rows.sorted(spark.read.schema(want.schema).parquet(path).select(*want.columns)) == rows.sorted(want)


@pytest.mark.parametrize("by", ["event_date", "first_day"])
@pytest.mark.parametrize("span", [1, None])
def test_daily_loads_equal_one_load(spark, rows, tmp_path, by, span):
    data = log()
    for first, last in ((None, 1), (2, 2), (2, 4), (3, 5), (6, 6)):
        path = load(rows, upto(data, last), tmp_path, first, by=by, span=span)
        check(spark, rows, path, upto(data, last))
    load(rows, data, tmp_path, by=by, span=span)
    check(spark, rows, path, data)


@pytest.mark.parametrize("by", ["event_date", "first_day"])
def test_days_loaded_again_replace_what_they_held(spark, rows, tmp_path, by):
    data = log(seed=2)
    path = load(rows, data, tmp_path, by=by)
    fewer = [r for r in data if r[1] < day(4) or r[2] == "b2"]
    load(rows, fewer, tmp_path, 4, by=by)
    check(spark, rows, path, fewer)
    load(rows, upto(data, 3), tmp_path, 4, by=by)
    check(spark, rows, path, upto(data, 3))
    load(rows, [], tmp_path, by=by)
    check(spark, rows, path, [])


@pytest.mark.parametrize("dies_at", ["table", "met"])
def test_a_load_that_died_is_repaired(spark, rows, tmp_path, monkeypatch, dies_at):
    data, real = log(seed=3), incremental.overwrite_partitions
    path = load(rows, data, tmp_path, by="first_day")

    def dying(df, target, *a, **k):
        return 1 / 0 if target.endswith(dies_at) else real(df, target, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(incremental, "overwrite_partitions", dying)
        with pytest.raises(ZeroDivisionError):
            load(rows, upto(data, 4), tmp_path, 5, by="first_day")
    load(rows, upto(data, 4), tmp_path, 5, by="first_day")
    check(spark, rows, path, upto(data, 4))


def test_only_days_of_open_sessions_are_written(spark, rows, tmp_path):
    data = [(i, day(n), f"s{n}", 1) for i, n in enumerate((1, 2, 3, 4) * 3)]
    path = load(rows, data, tmp_path)
    files = lambda n: sorted(os.listdir(f"{path}/event_date=2024-01-0{n}"))
    before = [files(n) for n in (1, 2, 3, 4)]
    more = [*data, (90, day(5), "s4", 1), (91, day(5), "new", 1)]
    load(rows, more, tmp_path, 5)
    assert [files(n) == b for n, b in zip((1, 2, 3, 4), before)] == [True, True, True, False]
    check(spark, rows, path, more)
