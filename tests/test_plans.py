"""Plan invariants and the catalogue against SQL."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from martlib.catalog import QUERIES, SQL
from martlib.catalog.product import engagement_gap
from martlib.catalog.stand_ins import long_events, nested_events
from martlib.operators import quality as Q
from martlib.plans import events as E
from martlib.plans import hierarchy as H
from tools.verify import TABLES, norm

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def long(spark):
    return E.unnest_events(nested_events(spark, FOLDER), dimensions=["geo__country", "device__category"], split=False).cache()


def test_long_rows_keep_every_parameter(spark, long):
    assert long.count() == spark.read.parquet(f"{FOLDER}/events.parquet").count() * 6
    assert Q.unique(long, ["event_params_key_id"]).count() == 0
    assert Q.not_null(long, "session_id").count() == 0 and Q.not_null(long, "user_id").count() == 0


def test_repeated_events_are_merged(spark, long):
    ne = nested_events(spark, FOLDER)
    twice = E.unnest_events(ne.union(ne), dimensions=["geo__country", "device__category"], split=False)
    # a repeated session start of a visitor without ids opens a session of its own
    known = "not is_user_pseudo_id_generated"
    assert twice.filter(known).count() == long.filter(known).count()
    total = lambda df: df.filter(known).filter("event_key = 'engagement_time_msec'").agg(F.sum("event__int_value")).first()[0]
    assert total(twice) == 2 * total(long)


def test_chain_from_raw_events_to_sessions(spark, long):
    bots = spark.createDataFrame([], "date_day date, country string")
    ses = E.build_sessions(long, bots, dimensions=["geo__country", "device__category"], marketing=["marketing_source", "marketing_medium"])
    assert Q.unique(ses, ["session_id", "session_date"]).count() == 0 and Q.unique(ses, ["record_id"]).count() == 0
    assert ses.count() == long.select("session_id", "session_date", "user_pseudo_id").distinct().count()
    piv = E.pivot_events(long, split=False)
    assert piv.count() == long.select("event_id").distinct().count()
    w = piv.groupBy("session_id").agg(F.max("page_view_rank").alias("m"), F.count_distinct("page_view_rank").alias("n"))
    assert w.filter("m > n + 1").count() == 0  # ranks leave no gaps but for session openers


def test_page_view_rank_never_falls(spark):
    piv = E.pivot_events(long_events(spark, FOLDER), split=False).filter("session_id is not null and event_name <> 'session_start'")
    from martlib.operators.ordered import Lag, ordered
    out = ordered(piv, ["session_id"], ["event_datetime_utc", "batch_sort_key", "event_id"], {"p": Lag(F.col("page_view_rank"))}, split=False)
    assert out.filter("p > page_view_rank").count() == 0


def test_hierarchy_infers_only_unambiguous_parents(spark, rows):
    nodes = rows("classification_id string, sector_name string, depth int, root_key string", [
        ("r", "Root", 0, "r"), ("m1", "Mid 1", 1, "r"), ("m2", "Mid 2", 1, "r"), ("x", "Leaf X", 2, "r"), ("y", "Leaf Y", 2, "r")])
    assign = rows("company_id int, classification_id string", [(1, "r"), (1, "m1"), (1, "x"), (2, "m1"), (2, "m2"), (2, "y"), (3, "r"), (4, "y")])
    edges = rows("parent_key string, child_key string", [("r", "m1"), ("r", "m2")])
    kind = F.lit("SectorClassificationModel")
    out = H.resolve_hierarchy(
        assign.withColumn("classification_category", kind), nodes.withColumn("classification_type", kind), edges.withColumn("classification_type", kind))
    assert rows.sorted(out, "company_id", "sector", "sub_sector", "sub_sub_sector") == [
        (1, "Root", "Mid 1", "Leaf X"), (2, "Root", "Leaf Y", None), (2, "Root", "Mid 1", None), (2, "Root", "Mid 2", None), (3, "Root", None, None), (4, "Root", "Leaf Y", None)]


def test_engagement_reconciles_between_plans(spark):
    assert engagement_gap(spark, FOLDER, only_profiles=True).count() == 0
    assert engagement_gap(spark, FOLDER, only_profiles=False).count() > 0


def test_reconcile_reports_one_sided_groups(rows):
    a = rows("d int, v double", [(1, 10.0), (2, 5.0)])
    b = rows("d int, v double", [(1, 10.005), (3, 1.0)])
    out = Q.reconcile(a, b, ["d"], F.sum("v"), F.sum("v"), 0.1)
    assert sorted(r["d"] for r in out.collect()) == [2, 3]


def test_freshness(rows):
    import datetime as dt
    df = rows("t date", [(dt.date(2024, 1, 5),)])
    day = lambda n: F.lit(dt.date(2024, 1, n))
    assert Q.freshness(df, "t", day(6)).count() == 0 and Q.freshness(df, "t", day(7)).count() == 1
    assert Q.freshness(df.filter(F.lit(False)), "t", day(6)).count() == 1


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "record_id" in df.columns
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) > 150
    assert set(QUERIES) <= set(qs) and set(QUERIES) == set(SQL)


def test_entry_works_without_the_training_data_part(tmp_path):
    """A copy without that subpackage still imports, registers and has the other queries."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/martlib", f"{tmp_path}/martlib", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; from martlib.catalog import QUERIES; assert set(e.queries()) == set(QUERIES); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


SAMPLE = [
    "flagship_sessions", "a8_merge_by_key", "b6_clean", "b11_surrogate_key", "c6_time_tolerant_full_join", "c9_not_in", "c18_link_by_name", "d4_string_agg", "d12_top_with_ties",
    "d16_period_change", "e7_fill_nulls_backward_split", "e9_running_count_range_split", "h4_url_parts", "h16_json_pairs", "h19_country", "l6_reconcile", "i3_carry_session_date",
    "p1_unnest_events", "p6_page_flow_split", "p8_search_sessions", "p15_resolve_hierarchy", "p17_private_funding", "p24_list_events",
]


@pytest.mark.parametrize("name", sorted(SQL) if os.environ.get("MARTLIB_FULL") else SAMPLE)
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted(tuple(norm(v) for v in r) for r in df.select(*cols).collect())
    cur = con.execute(SQL[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == cols
    pos = [names.index(c) for c in cols]
    assert got == sorted(tuple(norm(r[p]) for p in pos) for r in cur.fetchall())




def test_keys_repeated_inside_an_event_are_merged(spark):
    ne = nested_events(spark, FOLDER).withColumn("event_params", F.concat("event_params", F.slice("event_params", 3, 2)))
    out = E.unnest_events(ne, dimensions=["geo__country"], split=False)
    assert out.count() == ne.count() * 6
    one = E.unnest_events(nested_events(spark, FOLDER), dimensions=["geo__country"], split=False)
    total = lambda df: df.filter("event_key = 'engagement_time_msec'").agg(F.sum("event__int_value")).first()[0]
    assert total(out) == 2 * total(one)


def test_param_takes_the_first_value(spark, rows):
    from martlib.functions.json_text import param
    df = rows("p array<struct<key:string,value:struct<s:string>>>", [([("a", ("1",)), ("b", ("2",)), ("a", ("3",))],), ([],), (None,)])
    assert [tuple(r) for r in df.select(param(F.col("p"), "a", "s"), param(F.col("p"), "z", "s")).collect()] == [("1", None), (None, None), (None, None)]
