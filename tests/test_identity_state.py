"""Long event rows that late events change: the table equals a full load, and other days' files stay."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from martlib.catalog.stand_ins import nested_events
from martlib.plans import identity_state
from martlib.plans.events import unnest_events
from martlib.plans.identity_state import changed_days, load_identities

DIMS = ["geo__country", "device__category"]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Twelve days; devices p0 and p1 have no session number, so a visitor key goes over days."""
    folder, rnd = str(tmp_path_factory.mktemp("events")), random.Random(3)
    data = []
    for i in range(150):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randrange(12), seconds=rnd.randrange(86400))
        data.append((i, at, rnd.choice([0, 1, 2, 101, 102]), rnd.choice(["view", "click", "signup"]), float(i), '{"k": %d}' % rnd.randrange(9)))
    # the earliest row of device p1 without a login, from another kind of device than the rest
    data.append((159, dt.datetime(2024, 1, 1), 201, "view", 1.0, '{"k": 1}'))
    spark.createDataFrame(data, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    df = nested_events(spark, folder)
    kept = F.filter("event_params", lambda p: (p["key"] != "ga_session_id") | ~F.col("user_pseudo_id").isin("p0.", "p1."))
    path = f"{folder}/raw"
    df.withColumn("event_params", kept).write.partitionBy("event_date").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def check(spark, rows, path, events):
    want = unnest_events(events, dimensions=DIMS)
    got = spark.read.schema(want.schema).parquet(path).select(*want.columns)
    assert rows.sorted(got) == rows.sorted(want)


def files(path):
    return {d: sorted(os.listdir(f"{path}/{d}")) for d in os.listdir(path) if d.startswith("event_date=")}


def test_late_login_changes_its_day_only(spark, rows, raw, tmp_path, monkeypatch):
    # all logins of device p2 on the fourth day arrive after all else
    late = (F.col("event_date") == "20240104") & F.col("user_pseudo_id").eqNullSafe("p2.") & F.col("user_id").isNotNull()
    assert raw.filter(late).count() > 0
    path = load_identities(raw.filter(~late), raw.filter(~late), str(tmp_path), dimensions=DIMS)
    before = files(path)

    def dying(df, target, *a, **k):
        return 1 / 0

    with monkeypatch.context() as m:
        m.setattr(identity_state, "write_partitioned", dying)
        with pytest.raises(ZeroDivisionError):
            load_identities(raw, raw.filter(late), str(tmp_path), dimensions=DIMS)
    load_identities(raw, raw.filter(late), str(tmp_path), dimensions=DIMS)
    check(spark, rows, path, raw)
    after = files(path)
    assert {d for d in after if after[d] != before.get(d)} == {"event_date=2024-01-04"}
    # the same events again, and no events, change nothing
    for arrived in (raw.filter(late), raw.limit(0)):
        load_identities(raw, arrived, str(tmp_path), dimensions=DIMS)
        assert files(path) == after


def test_late_first_row_restates_the_days_of_its_visitor(spark, rows, raw, tmp_path):
    late = F.col("event_bundle_sequence_id") == 159
    path = load_identities(raw.filter(~late), raw.filter(~late), str(tmp_path), dimensions=DIMS)
    before = files(path)
    load_identities(raw, raw.filter(late), str(tmp_path), dimensions=DIMS)
    check(spark, rows, path, raw)
    after = files(path)
    restated = {f"event_date={d[:4]}-{d[4:6]}-{d[6:]}" for (d,) in raw.filter("user_pseudo_id = 'p1.' and user_id is null").select("event_date").distinct().collect()}
    changed = {d for d in after if after[d] != before.get(d)}
    assert changed == restated and len(changed) > 3


def test_changed_days_compare_multisets(rows):
    day = lambda n: dt.date(2024, 1, n)
    schema = "event_date date, k string, v int"
    held = rows(schema, [(day(1), "a", 1), (day(1), "a", 1), (day(2), "a", 1), (day(3), "a", 1), (None, "a", 1), (day(5), None, 1)])
    made = rows(schema, [(day(1), "a", 1), (day(2), "a", 1), (day(3), "a", 2), (day(4), "b", 1), (None, "a", 2), (day(5), None, 1)])
    assert sorted(changed_days(held, made, "k"), key=str) == [day(1), day(3), day(4), None]
    assert changed_days(held, held, "k") == []
    assert changed_days(held.limit(0), held.limit(0), "k") == []
