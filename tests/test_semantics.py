"""Decided semantics: missing values, precedence, ties and one-sided rules on hand-made rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from martlib.functions import dates as D
from martlib.functions import geo as G
from martlib.functions import json_text as JT
from martlib.functions import numbers as N
from martlib.functions import rules as R
from martlib.functions import text as X
from martlib.functions import urls as U
from martlib.operators import aggregates as A
from martlib.operators import joins as J
from martlib.plans import ecosystem as EC
from martlib.plans import staging as ST

T = dt.datetime


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def test_attribution_keeps_placeholders_unless_lenient(spark):
    l = lambda v: F.lit(v).cast("string")
    cand = [l("(direct)"), l("google"), l(None)]
    strict, lenient = one(spark, R.attribute(l(None), cand), R.attribute(l(None), cand, strict=False))
    assert (strict, lenient) == ("direct", "google")
    assert one(spark, R.attribute(l(None), [l("(none)"), l("google")])) == (None,)


def test_channel_rules_test_for_parentheses(spark):
    l = lambda v: F.lit(v).cast("string")
    assert one(spark, R.channel_group(l("(direct)"), l("none")), R.channel_group(l("direct"), l("none"))) == ("Direct", "Unassigned")
    assert one(spark, R.channel_group(l(None), l(None))) == ("Unassigned",)


def test_min_by_and_max_by_skip_nulls_at_ties(spark, rows):
    df = rows("k int, v string, t int", [(1, None, 1), (1, "a", 1), (1, None, 9), (1, "b", 9)])
    out = df.groupBy("k").agg(A.min_by_nn("v", "t"), A.max_by_nn("v", "t")).first()
    assert tuple(out)[1:] == ("a", "b")


def test_first_non_null_by_ignores_missing(spark, rows):
    df = rows("k int, v string, t int", [(1, None, 1), (1, "late", 3), (1, "early", 2), (2, None, 1)])
    assert rows.sorted(df.groupBy("k").agg(A.first_non_null_by("v", "t"))) == [(1, "early"), (2, None)]


def test_exits_share_a_day_but_have_an_order(spark, rows):
    ev = rows("id int, entity_id int, event_type string, event_date date, was_acquired int, amount_amount double, other_party_entity_key int", [
        (2, 1, "POEvent", dt.date(2020, 1, 1), 0, 1.0, None), (1, 1, "MNAEvent", dt.date(2020, 1, 1), 1, 1.0, 7), (3, 1, "MNAEvent", dt.date(2021, 1, 1), 1, 1.0, 7),
        (4, 1, "MNAEvent", dt.date(2019, 1, 1), 0, 1.0, 7),
    ])
    out = EC.exit_events(ev)
    assert rows.sorted(out, "event_id", "is_exit", "exit_order") == [(1, 1, 1), (2, 1, 2), (3, 0, 3)]


def test_acquired_company_has_no_listing(spark, rows):
    ev = rows("id int, entity_id int, event_type string, event_date date, was_acquired int", [
        (1, 1, "MNAEvent", dt.date(2019, 1, 1), 1), (2, 1, "POEvent", dt.date(2020, 1, 1), 0), (3, 2, "POEvent", dt.date(2020, 1, 1), 0), (4, 3, "POEvent", dt.date(2020, 1, 1), 0)])
    en = rows("entity_id int, entity_type string, is_israeli int", [(1, "Company", 1), (2, "Company", 1), (3, "Company", 0)])
    assert rows.sorted(EC.ipo_events(ev, en), "event_id", "is_first_ipo") == [(3, 1)]


def test_silent_filter_binds_to_placements_only(spark, rows):
    ev = rows("id int, entity_id int, event_type string, funding_type_funding_type string, is_silent_round int, event_date date, was_acquired int", [
        (1, 1, "POEvent", None, 1, dt.date(2020, 1, 1), 0), (2, 1, "FundingRoundEvent", "PIPE", 1, dt.date(2020, 1, 2), 0), (3, 1, "FundingRoundEvent", "PIPE", 0, dt.date(2020, 1, 3), 0)])
    ev = ev.withColumns({"other_party_entity_key": F.lit(1), "amount_amount": F.lit(1.0)})
    en = rows("entity_id int, entity_type string, is_israeli int", [(1, "Company", 1)])
    assert rows.sorted(EC.public_funding(ev, en), "event_id", "event_type_final", "is_ipo") == [(1, "Public Offering", 1), (3, "PIPE", 0)]


def test_time_tolerance_is_one_sided(spark, rows):
    l = rows("k int, lt timestamp_ntz", [(1, T(2024, 1, 1, 0, 0, 5)), (2, T(2024, 1, 1, 0, 0, 45))])
    r = rows("k int, rt timestamp_ntz", [(1, T(2024, 1, 1, 0, 0, 55)), (2, T(2024, 1, 1, 0, 0, 5))])
    got = lambda two: sorted(map(tuple, J.time_tolerant_full_join(l, r, ["k"], "lt", "rt", two_sided=two).select("l_k", "r_k").collect()), key=repr)
    assert got(False) == [(1, 1), (2, None), (None, 2)]
    assert got(True) == [(1, None), (2, None), (None, 1), (None, 2)]


def test_time_tolerance_forms_no_pairs_beyond_the_result(spark, rows):
    """100,000 rows a side in one minute, none of which match: all pairs would be ten thousand million."""
    many = lambda t, name: spark.range(100_000).select(F.lit(1).alias("k"), F.lit(t).cast("timestamp_ntz").alias(name), "id")
    l = many("2024-01-01 00:00:50", "lt").unionByName(rows("k int, lt timestamp_ntz, id long", [(1, T(2024, 1, 1, 0, 0, 5), -1), (1, None, -2), (None, T(2024, 1, 1), -3)]))
    r = many("2024-01-01 00:00:00", "rt").withColumnRenamed("id", "rid").unionByName(
        rows("k int, rt timestamp_ntz, rid long", [(1, T(2024, 1, 1, 0, 0, 30), -1), (1, None, -2), (None, T(2024, 1, 1), -3)]))
    l = l.filter("id < 100000")
    got = J.time_tolerant_full_join(l.filter("id <> -1"), r.filter("rid >= -3"), ["k"], "lt", "rt")
    assert got.count() == 100_002 + 100_003
    assert got.filter("id is not null and rid is not null").count() == 0
    pair = J.time_tolerant_full_join(l.filter("id < 0"), r.filter("rid < 0"), ["k"], "lt", "rt")
    assert rows.sorted(pair, "id", "rid") == sorted([(-1, -1), (-2, None), (-3, None), (None, -2), (None, -3)], key=repr)


def test_time_tolerance_equals_the_condition(spark, rows):
    rnd = random.Random(5)
    data = lambda n: [(rnd.choice([1, 2, None]), T(2024, 1, 1, 0, rnd.randrange(2), rnd.randrange(60)), i) for i in range(n)]
    a, b = data(60), data(50)
    l, r = rows("k int, lt timestamp_ntz, id long", a), rows("k int, rt timestamp_ntz, rid long", b)
    for two in (False, True):
        ok = lambda x, y: x[0] is not None and x[0] == y[0] and x[1].minute == y[1].minute and (abs if two else int)(x[1].second // 10 - y[1].second // 10) <= 1
        pairs = [(x[2], y[2]) for x in a for y in b if ok(x, y)]
        want = pairs + [(x[2], None) for x in a if x[2] not in {p for p, _ in pairs}] + [(None, y[2]) for y in b if y[2] not in {q for _, q in pairs}]
        assert rows.sorted(J.time_tolerant_full_join(l, r, ["k"], "lt", "rt", two_sided=two), "id", "rid") == sorted(want, key=repr)


def test_not_in_follows_sql(spark, rows):
    l = rows("k int", [(1,), (2,), (None,)])
    r = lambda *v: rows("id int", [(x,) for x in v])
    assert rows.sorted(J.not_in(l, "k", r(2), "id")) == [(1,)]
    assert rows.sorted(J.not_in(l, "k", r(2, None), "id")) == []
    assert rows.sorted(J.not_in(l, "k", rows("id int", []), "id")) == [(1,), (2,), (None,)]


def test_full_merge_is_a_full_join_on_nulls_and_duplicates(spark, rows):
    l = rows("k int, a string, s string", [(1, "x", "l"), (1, "y", None), (None, "n", "l"), (3, "z", None)])
    r = rows("k int, b string, s string", [(1, "p", "r"), (1, "q", "r"), (None, "m", "r"), (4, "w", "r")])
    full = l.join(r.withColumnRenamed("s", "rs"), "k", "full").withColumn("s", F.coalesce("s", "rs"))
    got = J.full_merge(l, r, ["k"], ["s"])
    assert rows.sorted(got, "k", "a", "b", "s") == rows.sorted(full, "k", "a", "b", "s")
    assert got.count() == 4 + 1 + 1 + 1 + 1


def test_self_join_deeper_forms_no_pairs(spark, rows):
    df = rows("c int, r int, depth int", [(1, 1, 0), (1, 1, 2), (1, 2, 0), (2, 1, 1), (2, None, 0), (2, None, 3)])
    assert rows.sorted(J.self_join_deeper(df, ["c", "r"], "depth"), "c", "r", "depth") == [(1, 1, 0)]


def test_seconds_elapsed_and_crossed(spark):
    a, b = F.lit(T(2024, 1, 1, 0, 0, 0, 900000)), F.lit(T(2024, 1, 1, 0, 0, 1, 100000))
    a, b = a.cast("timestamp_ntz"), b.cast("timestamp_ntz")
    assert one(spark, D.diff_seconds(b, a), D.diff_seconds(b, a, "boundary"), D.diff_seconds(a, b)) == (0, 1, 0)


def test_rounding_cast_and_strict_extremes(spark):
    l = lambda v: F.lit(v).cast("double")
    assert one(spark, N.to_int_round(l(1.5)), N.to_int_round(l(-1.5)), N.greatest_strict(l(1), l(None)), N.least_strict(l(1), l(2))) == (2, -2, None, 1.0)


def test_week_starts_on_sunday(spark):
    d = lambda s: F.lit(s).cast("date")
    assert one(spark, D.week_start_sunday(d("2024-01-07")), D.week_start_sunday(d("2024-01-06"))) == (dt.date(2024, 1, 7), dt.date(2023, 12, 31))


def test_initcap_breaks_on_punctuation(spark):
    assert one(spark, X.initcap_words(F.lit("a-b c_d/e f's 9x"))) == ("A-B C_D/E F's 9x",)


def test_json_pairs_edge_cases(spark):
    pairs = lambda v: F.to_json(JT.json_pairs(F.lit(v).cast("string")))
    assert one(spark, pairs("{oops"), pairs(None), pairs("")) == ("[]", "[]", "[]")
    assert one(spark, pairs('{"a":null,"b":{"c":1}}')) == ('[{"filter_name":"a"},{"filter_name":"b","filter_value":"{\\"c\\":1}"}]',)
    assert one(spark, JT.json_keys(F.lit("{oops"))) == (None,)


def test_first_region_wins_and_unlisted_is_null(spark):
    table = [("Africa", ["Djibouti"]), ("MENA", ["Djibouti", "Kuwait"]), ("Asia", ["Kuwait"])]
    r = lambda v: G.region_of(F.lit(v), table)
    assert one(spark, r("Djibouti"), r("Kuwait"), r("Mars")) == ("Africa", "MENA", None)


def test_excluded_names_also_drop_missing_names(spark, rows):
    raw = rows("id int, name string, type string, country string", [(1, "Ok", "Startup", None), (2, None, "Startup", None), (3, "Bad", "Investor", "uk")])
    assert rows.sorted(ST.stage_companies(raw, ("Bad",)), "company_id", "country", "is_israeli") == [(1, "Israel", 1)]


def test_url_query_also_behind_an_escaped_mark(spark):
    u = F.lit("https://h.example/p%3Fa=1%3Bb&amp;c=2&")
    assert one(spark, U.url_query(u)) == ("a=1;b&c=2",)


def test_cleaning_epoch_works_on_dates_and_datetimes(spark, rows):
    from martlib.operators.projection import clean
    df = rows("d date, t timestamp_ntz, s string", [(dt.date(1970, 1, 1), T(1970, 1, 1), " "), (dt.date(2020, 1, 1), T(1970, 1, 1, 5), "a ")])
    out = clean(df, {"d": "epoch", "t": "epoch", "s": "trim"})
    assert set(map(tuple, out.collect())) == {(None, None, None), (dt.date(2020, 1, 1), T(1970, 1, 1, 5), "a")}


def test_weighted_labels_are_stable_and_near_their_shares(spark):
    shares = [(0.4, "a"), (0.3, "b"), (0.3, "c")]
    df = spark.range(20000).select("id", R.weighted_label(F.col("id"), shares).alias("l"))
    assert df.exceptAll(spark.range(20000).select("id", R.weighted_label(F.col("id"), shares).alias("l"))).count() == 0
    got = {r["l"]: r["count"] / 20000 for r in df.groupBy("l").count().collect()}
    assert all(abs(got[label] - share) < 0.02 for share, label in shares)


def test_period_change_guards(spark, rows):
    df = rows("k string, d date, n int", [
        ("gone", dt.date(2024, 1, 1), 10), ("both", dt.date(2024, 1, 1), 10), ("both", dt.date(2024, 1, 9), 15), ("new", dt.date(2024, 1, 9), 50)])
    cut = F.lit(dt.date(2024, 1, 5))
    assert rows.sorted(A.period_change(df, ["k"], "d", "n", cut), "k", "pct_change") == [("both", 50.0), ("gone", -100.0)]
    assert ("new", 100.0) in rows.sorted(A.period_change(df, ["k"], "d", "n", cut, 0, 0), "k", "pct_change")


def test_string_agg_across_blocks(spark, rows):
    data = [("a", T(2024, 1, 1, h % 24) + dt.timedelta(days=h // 24), f"v{h}") for h in range(60)] + [("b", None, "z"), ("b", T(2024, 1, 1), None)]
    df = rows("k string, t timestamp_ntz, v string", data)
    out = dict(rows.sorted(A.string_agg(df, ["k"], "v", ["t"], "s")))
    assert out == {"a": ",".join(f"v{h}" for h in range(60)), "b": "z"}
