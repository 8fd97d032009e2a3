"""The blocked form for hot keys gives the same rows as plain windows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martlib.operators import windows as W
from martlib.operators.ordered import (
    DenseRank, FirstValue, Lag, LastValue, Lead, NextValue, Rank, RowNumber, RunningCount, RunningMin, Total, chained, ordered,
)
from martlib.session import fits_broadcast


def events(spark, seed, n=400):
    """One key holds more than a third of the rows; keys, values and times can be missing, times tie."""
    rnd = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    data = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "", None])
        t = None if rnd.random() < 0.03 else base + dt.timedelta(minutes=30 * rnd.randrange(0, 200))
        data.append((i, key, rnd.choice([1, None]), t, rnd.choice([None, "x", "y", "z"]), rnd.choice([None, 1, 5, 9])))
    return spark.createDataFrame(data, "id int, key string, part int, ts timestamp_ntz, label string, v int").repartition(4)


def all_outputs():
    return {
        "rn": RowNumber(), "rank": Rank(), "dense": DenseRank(), "cnt": RunningCount(F.col("label") == "x"), "mn": RunningMin(F.col("v")),
        "last": LastValue(F.col("label")), "first": FirstValue(F.col("label")), "lag": Lag(F.col("label")), "lead": Lead(F.col("label")),
        "lead3": Lead(F.col("v"), 3), "next": NextValue(F.col("label")), "total": Total("sum", F.col("v")), "n": Total("count", F.col("v")), "hi": Total("max", F.col("v")),
    }


@pytest.mark.parametrize("seed,order", [(1, ["ts", "id"]), (2, ["-ts", "-id"]), (3, ["-ts", "id"])])
def test_total_order(spark, seed, order):
    df = events(spark, seed)
    plain = ordered(df, ["key", "part"], order, all_outputs(), split=False)
    blocked = ordered(df, ["key", "part"], order, all_outputs())
    assert blocked.columns == plain.columns
    assert plain.exceptAll(blocked).count() == 0 and blocked.exceptAll(plain).count() == 0


@pytest.mark.parametrize("order", [["ts"], ["-ts"]])
def test_ties_share_a_frame(spark, order):
    df = events(spark, 4)
    outs = {"cnt": RunningCount(F.col("label") == "x", "range"), "mn": RunningMin(F.col("v")), "dense": DenseRank(), "rank": Rank()}
    plain = ordered(df, ["key"], order, outs, split=False)
    blocked = ordered(df, ["key"], order, outs)
    assert plain.exceptAll(blocked).count() == 0 and blocked.exceptAll(plain).count() == 0


@pytest.mark.parametrize("order", [["label", "v", "id"], ["-v", "id"], ["v", "-label", "id"], ["part", "id"]])
def test_any_sort_type_with_nulls(spark, order):
    df = events(spark, 5)
    plain = ordered(df, ["key"], order, all_outputs(), split=False)
    blocked = ordered(df, ["key"], order, all_outputs())
    assert plain.exceptAll(blocked).count() == 0 and blocked.exceptAll(plain).count() == 0


def test_blocks_are_bounded_whatever_the_key_and_the_values(spark, monkeypatch):
    """A third of the rows has one key, one day, counts under 1000 and missing sort values."""
    from martlib.operators import ordered as module

    laid = []
    monkeypatch.setattr(module, "cut_lineage", lambda df: laid.append(df.cache()) or laid[-1])
    n = 12_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string"))).alias("key"), F.lit(dt.date(2024, 1, 1)).alias("day"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 900).alias("n"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("label"), "id")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for order in (["n", "id"], ["label"], ["day", "id"]):
        ordered(df, ["key"], order, {"rn": RowNumber()}).count()
        assert laid[-1].groupBy("__b").count().agg(F.max("count")).first()[0] <= 1.5 * n / parts
    ordered(df, ["key"], [], {"s": Total("sum", F.col("n"))}).count()
    assert laid[-1].groupBy("__b").count().agg(F.max("count")).first()[0] <= 1.5 * n / parts


def test_a_run_of_equal_values_is_cut_and_its_rows_see_each_other(spark, monkeypatch):
    """Two thirds of the rows have one key and one of three days; the blocks are even all the same."""
    from martlib.operators import ordered as module

    laid = []
    monkeypatch.setattr(module, "cut_lineage", lambda df: laid.append(df.cache()) or laid[-1])
    n = 8_000
    day = F.when(F.col("id") < n // 2, F.lit(dt.date(2024, 1, 5))).otherwise(F.date_add(F.lit(dt.date(2024, 1, 4)), (F.col("id") % 3).cast("int")))
    df = spark.range(n).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"),
        F.when(F.col("id") % 11 != 0, day).alias("day"), (F.col("id") % 5).cast("int").alias("v"), F.lit("x").alias("same")).repartition(4)
    outs = {
        "cnt": RunningCount(F.col("v") == 3, "range"), "mn": RunningMin(F.col("v")), "last": LastValue(F.col("same")), "first": FirstValue(F.col("same")),
        "late": LastValue(F.when(F.col("day") == F.lit(dt.date(2024, 1, 5)), F.col("same"))), "dense": DenseRank(), "rank": Rank(),
        "next": NextValue(F.when(F.col("day") == F.lit(dt.date(2024, 1, 5)), F.col("same"))),
    }
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for order in (["day"], ["-day"]):
        plain = ordered(df, ["key"], order, outs, split=False)
        blocked = ordered(df, ["key"], order, outs)
        assert plain.exceptAll(blocked).count() == 0 and blocked.exceptAll(plain).count() == 0
        sizes = laid[-1].groupBy("__b").count()
        assert sizes.count() == parts and sizes.agg(F.max("count")).first()[0] <= 1.5 * n / parts
    numbered = ordered(df, ["key"], ["day"], {"rn": RowNumber()}).groupBy("key").agg(F.count_distinct("rn").alias("d"), F.max("rn").alias("m"), F.count("rn").alias("n"))
    assert numbered.where("d <> n or m <> n").count() == 0


@pytest.mark.parametrize("order", [["ts", "id"], ["-ts"]])
def test_chained_steps_see_each_other(spark, order):
    df = events(spark, 6)
    x = F.col("label") == "x"
    steps = [
        {"before": Lag(F.col("label"))} if len(order) > 1 else {"before": RunningMin(F.col("v"))},
        lambda d: d.filter(F.col("before").isNull() | (F.col("v") > 0)).withColumn("moved", F.col("before").isNull() | x),
        {"n": RunningCount(F.col("moved"), "range"), "rank": Rank()},
        (["n", "label"], {"inner": DenseRank(), "s": Total("count", F.col("v")), "f": FirstValue(F.col("v"))} if len(order) > 1 else {"inner": DenseRank(), "s": Total("count", F.col("v"))}),
        {"label": LastValue(F.col("inner"))} if len(order) > 1 else {"label": RunningMin(F.col("inner"))},
    ]
    plain = chained(df, ["key"], order, steps, split=False)
    blocked = chained(df, ["key"], order, steps)
    assert blocked.columns == plain.columns or sorted(blocked.columns) == sorted(plain.columns)
    plain = plain.select(*blocked.columns)
    assert plain.exceptAll(blocked).count() == 0 and blocked.exceptAll(plain).count() == 0


def test_later_steps_do_not_move_the_rows(spark, monkeypatch):
    """After the written first step there is no exchange of rows: only of summaries, which are aggregates."""
    from martlib.operators import ordered as module

    written = []
    real = module.cut_lineage
    monkeypatch.setattr(module, "cut_lineage", lambda df: written.append(1) or real(df))
    out = chained(events(spark, 7), ["key"], ["ts", "id"], [{"p": Lag(F.col("label"))}, lambda d: d.withColumn("m", F.col("p") == "x"), {"n": RunningCount(F.col("m"))}, {"l": Lead(F.col("n"))}])
    assert len(written) == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    detail = [line for line in plan.splitlines() if "Exchange" in line and "BroadcastExchange" not in line]
    assert all("hashpartitioning" in line for line in detail)
    # the rows' own branch: from the top down to the first broadcast no exchange
    top = plan[:plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in top


def test_group_limit_runs_before_the_shuffle(spark):
    plan = W.keep_first(events(spark, 8), ["key"], ["ts", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_rows_without_a_key_stand_alone(spark, rows):
    df = rows("id int, k string", [(1, None), (2, None), (3, "a"), (4, "none")])
    out = W.spread_null_key(df, "k", "id", "w", empty="none")
    assert [r[0] for r in out.orderBy("id").select("w").collect()] == ["~1", "~2", "a", "~4"]


def test_partition_stat_matches_in_both_forms(spark):
    df = events(spark, 9)
    a = W.partition_stat(df, "sum", "v", ["key"], "s", split=False)
    b = W.partition_stat(df, "sum", "v", ["key"], "s")
    assert a.exceptAll(b).count() == 0


def test_first_rank_flag_shares_ties_and_null_keys(spark, rows):
    df = rows("k string, d int, id int", [("a", 1, 1), ("a", 1, 2), ("a", 2, 3), (None, 5, 4), (None, None, 5)])
    out = W.first_rank_flag(df, ["k"], "d", "f").orderBy("id").select("f")
    assert [r[0] for r in out.collect()] == [1, 1, 0, 0, 1]


def test_broadcast_check_measures_bytes(spark):
    df = spark.range(1000).select(F.col("id"), F.repeat(F.lit("x"), 100).alias("t"))
    assert fits_broadcast(df, 1000 * 140) and not fits_broadcast(df, 1000 * 100)
    assert fits_broadcast(df.filter("id < 0"))
