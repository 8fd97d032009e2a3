"""Long event rows: only events that repeat are compared as a whole, and arrays are opened by compiled code."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlib.catalog.stand_ins import nested_events
from martlib.plans.events import prepare_events, unnest_events
from martlib.session import cut_lineage, job_settings

DIMS = ["geo__country", "device__category"]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("events"))
    data = [(i, dt.datetime(2024, 1, 1 + i % 3, i % 20), i % 4, "view", float(i), '{"k": %d}' % (i % 6)) for i in range(1, 30)]
    spark.createDataFrame(data, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    return cut_lineage(nested_events(spark, folder))


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_events_that_do_not_repeat_are_not_grouped(raw):
    out = unnest_events(raw, dimensions=DIMS)
    assert not [line for line in plan(out) if "Aggregate [" in line and "event_params" in line]
    assert out.count() == 29 * 6


def test_arrays_are_opened_without_lambdas(raw):
    opened = [line for line in plan(unnest_events(raw, dimensions=DIMS)) if "Generate inline" in line]
    assert opened and not any("lambda" in line for line in opened)


def test_written_events_hold_no_copies_of_their_parameters(raw):
    assert not {"geo", "device", "event_params_json", "page_url", "param_source"} & set(prepare_events(raw).columns)


def test_wide_rows_are_written_by_compiled_code(spark):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    with job_settings(spark):
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before


def test_repeats_are_merged_once_all_their_columns_are_known(raw, rows):
    seq = F.col("event_bundle_sequence_id")
    msec = F.filter("event_params", lambda p: p["key"] == "engagement_time_msec")
    whole = raw.withColumn("event_params", F.when(seq == 5, F.concat("event_params", msec)).otherwise(F.col("event_params")))
    other = F.struct(F.lit("elsewhere").alias("name"), F.lit("none").alias("medium"), F.lit("unseen").alias("source"))
    # two events come again with another traffic source, which shows in the result where they name none themselves
    told = whole.filter(seq.isin(4, 6)).withColumn("traffic_source", other)
    # event 7 comes again without its user, who is filled from the first copy
    unknown = whole.filter(seq == 7).withColumn("user_id", F.lit(None).cast("string"))
    events = whole.unionByName(whole.filter(seq == 3)).unionByName(whole.filter(seq == 3)).unionByName(told).unionByName(unknown)
    names = ["event_bundle_sequence_id", "event_key", "user_id", "marketing_source", "marketing_campaign", "event__string_value", "event__int_value"]
    once = {(r[0], r[1]): tuple(r) for r in unnest_events(raw, dimensions=DIMS).select(*names).collect()}
    got = unnest_events(events, dimensions=DIMS).select(*names).collect()
    want = {k: list(v) for k, v in once.items()}
    # three copies of event 3, and the key twice in event 5
    want[3, "engagement_time_msec"][-1] *= 3
    want[5, "engagement_time_msec"][-1] *= 2
    kept = [r for r in got if r[0] not in (4, 6, 7)]
    assert sorted(map(tuple, kept), key=repr) == sorted((tuple(v) for k, v in want.items() if k[0] not in (4, 6, 7)), key=repr)
    by = lambda n: [r for r in got if r[0] == n and r[1] == "engagement_time_msec"]
    # copies with other marketing columns stay apart, those that end up equal are one row with the sum
    for n in (4, 6):
        apart = len({(r.marketing_source, r.marketing_campaign) for r in by(n)})
        assert len(by(n)) == apart and sum(r.event__int_value for r in by(n)) == 2 * once[n, "engagement_time_msec"][-1]
    assert sum(r.event__int_value for r in by(7)) == 2 * once[7, "engagement_time_msec"][-1]
