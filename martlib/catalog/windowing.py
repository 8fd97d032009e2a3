"""Window operators on the driver tables, in the one form that serves groups of any size."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlib.catalog.registry import query, table
from martlib.operators import windows as W


def _events(spark, d):
    """Events with NULLs where the data has none, and with ties in time (minutes)."""
    return table(spark, d, "events").select(
        "event_id", "user_id", "event_type", "value", "ts", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hr"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("label"),
    )


def both(name: str, sql: str):
    """Register a query; the second name is an alias from when there were two forms."""
    def register(fn):
        query(name, sql)(lambda spark, d: fn(spark, d, True))
        query(f"{name}_split", sql)(lambda spark, d: fn(spark, d, True))
        return fn
    return register


_EV = "WITH ev AS (SELECT event_id, user_id, event_type, value, ts, date_trunc('hour', ts) AS hr, CASE WHEN event_id % 3 = 0 THEN event_type END AS label FROM events) "


@both("e1_sequence_no", "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS deal_no FROM orders")
def _(spark, d, split):
    df = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return W.sequence_no(df, ["o_custkey"], ["o_orderdate", "o_orderkey"], "deal_no", split=split).select("o_orderkey", "deal_no")


@query("e2_first_rank_flag", "SELECT o_orderkey, CASE WHEN dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) = 1 THEN 1 ELSE 0 END AS is_exit FROM orders")
def _(spark, d):
    return W.first_rank_flag(table(spark, d, "orders"), ["o_custkey"], "o_orderdate", "is_exit").select("o_orderkey", "is_exit")


@both("e3_rank_by_measure", """
WITH c AS (SELECT l_suppkey, l_returnflag, l_linestatus, COUNT(DISTINCT l_orderkey) AS measure FROM lineitem GROUP BY ALL)
SELECT *, CAST(rank() OVER (PARTITION BY l_suppkey ORDER BY measure DESC) AS INTEGER) AS rnk FROM c
""")
def _(spark, d, split):
    return W.rank_by_measure(table(spark, d, "lineitem"), ["l_suppkey"], ["l_returnflag", "l_linestatus"], F.count_distinct("l_orderkey"), split=split)


@both("e4_previous", """
SELECT o_orderkey, lag(o_orderdate) OVER w AS prior_date, lag(o_orderpriority) OVER w AS prior_type, lag(o_totalprice) OVER w AS prior_amount
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
""")
def _(spark, d, split):
    cols = {"prior_date": "o_orderdate", "prior_type": "o_orderpriority", "prior_amount": "o_totalprice"}
    out = W.previous(table(spark, d, "orders"), cols, ["o_custkey"], ["o_orderdate", "o_orderkey"], split=split)
    return out.select("o_orderkey", *cols)


@both("e4_previous_where", _EV + """
SELECT event_id, CASE WHEN event_type = 'view' THEN lag(value) OVER (PARTITION BY user_id, event_type = 'view' ORDER BY ts, event_id) END AS previous_view FROM ev
""")
def _(spark, d, split):
    out = W.previous(_events(spark, d), {"previous_view": "value"}, ["user_id"], ["ts", "event_id"], where=F.col("event_type") == "view", split=split)
    return out.select("event_id", "previous_view")


@both("e5_next_value", _EV + "SELECT event_id, lead(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS value_lead FROM ev")
def _(spark, d, split):
    return W.next_value(_events(spark, d), "value", ["user_id"], ["ts", "event_id"], "value_lead", split=split).select("event_id", "value_lead")


@both("e6_flow_columns", _EV + """
SELECT event_id, event_type AS event_type_1, lead(event_type, 1) OVER w AS event_type_2, lead(event_type, 2) OVER w AS event_type_3,
  lead(event_type, 3) OVER w AS event_type_4 FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def _(spark, d, split):
    out = W.flow_columns(_events(spark, d), ["event_type"], ["user_id"], ["ts", "event_id"], 4, split=split)
    return out.select("event_id", *[f"event_type_{i}" for i in range(1, 5)])


def _fill_sql(direction):
    return _EV + f"""
SELECT event_id, COALESCE(label,
  last_value(label IGNORE NULLS) OVER (PARTITION BY user_id, event_type ORDER BY ts {direction} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  last_value(label IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts {direction} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS label FROM ev
"""


@both("e7_fill_nulls_backward", _fill_sql("DESC"))
def _(spark, d, split):
    out = W.fill_nulls(_events(spark, d), "label", [["user_id", "event_type"], ["user_id"]], "ts", "backward", split=split)
    return out.select("event_id", "label")


@both("e7_fill_nulls_forward", _fill_sql("ASC"))
def _(spark, d, split):
    out = W.fill_nulls(_events(spark, d), "label", [["user_id", "event_type"], ["user_id"]], "ts", "forward", split=split)
    return out.select("event_id", "label")


@both("e8_running_count", _EV + """
SELECT event_id, CAST(COUNT(*) FILTER (WHERE event_type = 'view') OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS view_rank FROM ev
""")
def _(spark, d, split):
    return W.running_count(_events(spark, d), F.col("event_type") == "view", ["user_id"], ["ts", "event_id"], "view_rank", split=split).select("event_id", "view_rank")


@both("e9_running_count_range", _EV + """
SELECT event_id, CAST(COUNT(*) FILTER (WHERE event_type = 'view') OVER (PARTITION BY user_id % 10 ORDER BY hr RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS search_rank FROM ev
""")
def _(spark, d, split):
    df = W.with_derived_key(_events(spark, d), {"grp": F.col("user_id") % 10})
    return W.running_count(df, F.col("event_type") == "view", ["grp"], ["hr"], "search_rank", "range", split=split).select("event_id", "search_rank")


@both("e10_partition_stat", _EV + "SELECT event_id, MAX(value) OVER (PARTITION BY user_id, event_type) AS best FROM ev")
def _(spark, d, split):
    return W.partition_stat(_events(spark, d), "max", "value", ["user_id", "event_type"], "best", split=split).select("event_id", "best")


@both("e11_running_min", _EV + "SELECT event_id, MIN(value) OVER (PARTITION BY user_id ORDER BY ts) AS value_min FROM ev")
def _(spark, d, split):
    return W.running_min(_events(spark, d), "value", ["user_id"], ["ts"], "value_min", split=split).select("event_id", "value_min")


@query("e12_distinct_per", _EV + """
SELECT event_id, n >= 20 AS is_power FROM ev JOIN (SELECT user_id, COUNT(DISTINCT CAST(ts AS DATE)) AS n FROM ev GROUP BY 1) USING (user_id)
""")
def _(spark, d):
    df = W.with_derived_key(_events(spark, d), {"day": F.col("ts").cast("date")})
    return W.distinct_per(df, ["user_id"], "day", 20, "is_power").select("event_id", "is_power")


@query("e13_preferred_value", """
SELECT p_partkey, first_value(p_type) OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_type) AS preferred_type FROM part
""")
def _(spark, d):
    return W.preferred_value(table(spark, d, "part"), "p_type", ["p_brand"], ["-p_size"], "preferred_type").select("p_partkey", "preferred_type")


@query("e14_keep_first", """
SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) = 1
""")
def _(spark, d):
    return W.keep_first(table(spark, d, "events"), ["user_id"], ["-value", "event_id"]).select("user_id", "event_id", "event_type")


@query("e15_keep_any", "SELECT DISTINCT user_id, event_type FROM events")
def _(spark, d):
    return W.keep_any(table(spark, d, "events"), ["user_id", "event_type"]).select("user_id", "event_type")


@query("e16_with_derived_key", _EV + """
SELECT event_id, row_number() OVER (PARTITION BY user_id, hr, event_type = 'view' ORDER BY ts DESC, event_id) AS n_in_hour FROM ev
""")
def _(spark, d):
    df = W.with_derived_key(_events(spark, d), {"is_view": F.col("event_type") == "view"})
    return W.sequence_no(df, ["user_id", "hr", "is_view"], ["-ts", "event_id"], "n_in_hour").select("event_id", F.col("n_in_hour").cast("long").alias("n_in_hour"))


@query("e17_keep_rank_where", """
SELECT o_custkey, o_orderkey FROM orders QUALIFY dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) = 1 AND o_orderstatus = 'F'
""")
def _(spark, d):
    return W.keep_rank_where(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate"], F.col("o_orderstatus") == "F").select("o_custkey", "o_orderkey")
