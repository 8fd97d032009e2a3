"""Aggregation operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlib.catalog.registry import query, table
from martlib.operators import aggregates as A


@query("d1_summarize", """
SELECT o_custkey, COUNT(*) AS n, ROUND(SUM(o_totalprice), 2) AS total, MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi,
  ROUND(AVG(o_totalprice), 7) AS mean FROM orders GROUP BY 1
""")
def _(spark, d):
    p = "o_totalprice"
    return A.summarize(table(spark, d, "orders"), ["o_custkey"], {
        "n": F.count("*"), "total": F.round(F.sum(p), 2), "lo": F.min(p), "hi": F.max(p), "mean": F.round(F.avg(p), 7),
    })


@query("d2_count_distincts", """
SELECT l_suppkey, COUNT(DISTINCT l_orderkey) AS n_orders, COUNT(DISTINCT l_partkey) AS n_parts,
  COUNT(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS n_returned FROM lineitem GROUP BY 1
""")
def _(spark, d):
    return A.count_distincts(table(spark, d, "lineitem"), ["l_suppkey"], {
        "n_orders": "l_orderkey", "n_parts": "l_partkey",
        "n_returned": F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")),
    })


@query("d3_agg_if", """
SELECT l_suppkey, COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_r, ROUND(SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 2) AS qty_r,
  MIN(CASE WHEN l_linestatus = 'O' THEN l_shipdate END) AS first_open, MAX(CASE WHEN l_linestatus = 'O' THEN l_shipdate END) AS last_open,
  ROUND(AVG(CASE WHEN l_discount > 0.05 THEN l_extendedprice END), 2) AS mean_disc FROM lineitem GROUP BY 1
""")
def _(spark, d):
    r, o = F.col("l_returnflag") == "R", F.col("l_linestatus") == "O"
    return A.summarize(table(spark, d, "lineitem"), ["l_suppkey"], {
        "n_r": A.agg_if("count", F.lit(1), r), "qty_r": F.round(A.agg_if("sum", "l_quantity", r), 2),
        "first_open": A.agg_if("min", "l_shipdate", o), "last_open": A.agg_if("max", "l_shipdate", o),
        "mean_disc": F.round(A.agg_if("avg", "l_extendedprice", F.col("l_discount") > 0.05), 2),
    })


@query("d4_string_agg", """
SELECT user_id, CAST(ts AS DATE) AS day, string_agg(event_type, ',' ORDER BY ts, event_id) AS funnel FROM events GROUP BY ALL
""")
def _(spark, d):
    ev = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    return A.string_agg(ev, ["user_id", "day"], "event_type", ["ts", "event_id"], "funnel")


@query("d4_string_agg_desc", """
SELECT o_custkey, string_agg(o_orderpriority, ' > ' ORDER BY o_orderdate DESC, o_orderkey DESC) AS priorities FROM orders GROUP BY 1
""")
def _(spark, d):
    return A.string_agg(table(spark, d, "orders"), ["o_custkey"], "o_orderpriority", ["-o_orderdate", "-o_orderkey"], "priorities", " > ")


@query("d5_string_agg_distinct", """
SELECT p_brand, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS types FROM part GROUP BY 1
""")
def _(spark, d):
    return A.string_agg_distinct(table(spark, d, "part"), ["p_brand"], "p_type", "types", ", ")


@query("d6_first_and_array", """
SELECT user_id, arg_min(event_type, ts) FILTER (WHERE event_id % 4 <> 0) AS first_type, list_sort(list_distinct(list(event_type))) AS types
FROM events GROUP BY 1
""")
def _(spark, d):
    v = F.when(F.col("event_id") % 4 != 0, F.col("event_type"))
    return A.summarize(table(spark, d, "events"), ["user_id"], {
        "first_type": A.first_non_null_by(v, "ts"), "types": A.array_distinct_sorted("event_type"),
    })


@query("d7_min_max_by", """
SELECT user_id, arg_min(value, ts) FILTER (WHERE event_type = 'purchase') AS first_purchase,
  arg_max(value, ts) FILTER (WHERE event_type = 'purchase') AS last_purchase FROM events GROUP BY 1
""")
def _(spark, d):
    v = F.when(F.col("event_type") == "purchase", F.col("value"))
    return A.summarize(table(spark, d, "events"), ["user_id"], {"first_purchase": A.min_by_nn(v, "ts"), "last_purchase": A.max_by_nn(v, "ts")})


@query("d8_any_and_count", """
SELECT user_id, bool_or(event_type = 'signup') AS is_new, NOT bool_or(event_type = 'signup') AS is_returning,
  COUNT(*) FILTER (WHERE event_type = 'error') AS n_errors FROM events GROUP BY 1
""")
def _(spark, d):
    s = F.col("event_type") == "signup"
    return A.summarize(table(spark, d, "events"), ["user_id"], {
        "is_new": A.any_true(s), "is_returning": ~A.any_true(s), "n_errors": A.count_true(F.col("event_type") == "error"),
    })


@query("d9_group_by_all", """
SELECT user_id, event_type, CAST(ts AS DATE) AS day, ROUND(SUM(value), 2) AS total, MIN(ts) AS first_ts FROM events GROUP BY ALL
""")
def _(spark, d):
    ev = table(spark, d, "events").select("user_id", "event_type", F.col("ts").cast("date").alias("day"), "value", "ts")
    return A.group_by_all(ev, {"total": F.round(F.sum("value"), 2), "first_ts": F.min("ts")}, drop=["value", "ts"])


@query("d10_pivot_keys", """
SELECT user_id, MAX(CASE WHEN event_type = 'click' THEN value END) AS click, MAX(CASE WHEN event_type = 'view' THEN value END) AS view,
  MAX(CASE WHEN event_type = 'purchase' THEN value END) AS purchase FROM events GROUP BY 1
""")
def _(spark, d):
    return A.pivot_keys(table(spark, d, "events"), ["user_id"], "event_type", "value", ["click", "view", "purchase"])


@query("d10_pivot_keys_latest", """
SELECT user_id, arg_max(value, ts) FILTER (WHERE event_type = 'click') AS click, arg_max(value, ts) FILTER (WHERE event_type = 'error') AS error
FROM events GROUP BY 1
""")
def _(spark, d):
    return A.pivot_keys(table(spark, d, "events"), ["user_id"], "event_type", "value", ["click", "error"], by="ts")


@query("d11_pivot_steps", """
SELECT user_id, MIN(ts) FILTER (WHERE event_type = 'signup') AS started, MIN(ts) FILTER (WHERE event_type = 'view') AS viewed,
  MIN(ts) FILTER (WHERE event_type = 'purchase') AS bought FROM events GROUP BY 1
""")
def _(spark, d):
    return A.pivot_steps(table(spark, d, "events"), ["user_id"], "event_type", "ts", {"signup": "started", "view": "viewed", "purchase": "bought"})


@query("d12_top_with_ties", """
WITH c AS (SELECT o_custkey, o_orderpriority, COUNT(DISTINCT o_orderkey) AS m FROM orders GROUP BY ALL),
r AS (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY m DESC) AS rk FROM c)
SELECT o_custkey, string_agg(o_orderpriority, ', ' ORDER BY o_orderpriority) AS top_priorities FROM r WHERE rk = 1 GROUP BY 1
""")
def _(spark, d):
    return A.top_with_ties(table(spark, d, "orders"), "o_custkey", "o_orderpriority", F.count_distinct("o_orderkey"), "top_priorities")


@query("d13_visited_items", """
WITH f AS (SELECT user_id, event_type, MIN(ts) AS t, COUNT(*) AS c FROM events GROUP BY ALL)
SELECT user_id, string_agg(event_type, ',' ORDER BY t) AS items_list, list(event_type ORDER BY t) AS items_arr,
  COUNT(DISTINCT event_type) AS items_unique_count, CAST(SUM(c) AS BIGINT) AS items_total_count FROM f GROUP BY 1
""")
def _(spark, d):
    return A.visited_items(table(spark, d, "events"), "user_id", "event_type", "ts")


@query("d14_clamped_count", """
SELECT conv_id, GREATEST(COUNT(DISTINCT CASE WHEN role = 'user' THEN turn END) - 1, 0) AS user_messages,
  COUNT(DISTINCT CASE WHEN role = 'assistant' THEN turn END) AS assistant_messages FROM conversations GROUP BY 1
""")
def _(spark, d):
    return A.summarize(table(spark, d, "conversations"), ["conv_id"], {
        "user_messages": A.clamped_count("turn", F.col("role") == "user"),
        "assistant_messages": A.agg_if("count_distinct", "turn", F.col("role") == "assistant"),
    })


@query("d15_stack_grains", """
SELECT CAST(ts AS DATE) AS day, event_type, NULL AS k, COUNT(*) AS n, COUNT(DISTINCT user_id) AS users FROM events GROUP BY ALL
UNION ALL
SELECT CAST(ts AS DATE), event_type, json_extract_string(props, '$.k'), COUNT(*), COUNT(DISTINCT user_id) FROM events
WHERE length(json_extract_string(props, '$.k')) < 2 GROUP BY ALL
""")
def _(spark, d):
    ev = table(spark, d, "events").select(
        F.col("ts").cast("date").alias("day"), "event_type", F.get_json_object("props", "$.k").alias("k"), "user_id")
    aggs = {"n": F.count("*"), "users": F.count_distinct("user_id")}
    return A.stack_grains(ev, [(["day", "event_type"], None), (["day", "event_type", "k"], F.length("k") < 2)], aggs)


@query("d16_period_change", """
WITH m AS (SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS n FROM events GROUP BY ALL),
p AS (SELECT event_type, COALESCE(ROUND(AVG(CASE WHEN day < DATE '2024-01-24' THEN n END), 2), 0) AS hist_avg_daily_events,
  CAST(COALESCE(SUM(CASE WHEN day < DATE '2024-01-24' THEN n END), 0) AS BIGINT) AS hist_total_events,
  COALESCE(ROUND(AVG(CASE WHEN day >= DATE '2024-01-24' THEN n END), 2), 0) AS recent_avg_daily_events,
  CAST(COALESCE(SUM(CASE WHEN day >= DATE '2024-01-24' THEN n END), 0) AS BIGINT) AS recent_total_events FROM m GROUP BY 1)
SELECT *, CASE WHEN hist_avg_daily_events > 0 THEN ROUND((recent_avg_daily_events - hist_avg_daily_events) / hist_avg_daily_events * 100, 2)
  WHEN recent_avg_daily_events > 0 THEN 100.0 ELSE -100.0 END AS pct_change
FROM p WHERE hist_avg_daily_events >= 5 AND hist_total_events >= 5
""")
def _(spark, d):
    daily = table(spark, d, "events").groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count("*").alias("n"))
    return A.period_change(daily, ["event_type"], "day", "n", F.lit("2024-01-24").cast("date"))


@query("d17_first_event_flag", """
SELECT o_orderkey, CASE WHEN o_orderdate = MIN(o_orderdate) OVER (PARTITION BY o_custkey) THEN 1 ELSE 0 END AS is_first,
  MIN(o_orderdate) OVER (PARTITION BY o_custkey) AS first_date FROM orders
""")
def _(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return A.first_event_flag(df, "o_custkey", "o_orderdate", first_name="first_date").select("o_orderkey", "is_first", "first_date")


@query("d18_min_max_range", """
WITH f AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'price_min' WHEN 'O' THEN 'price_max' ELSE 'size_min' END AS name,
  CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS v FROM orders)
SELECT o_custkey, MIN(CASE WHEN name LIKE 'price\\_%' ESCAPE '\\' THEN v END) || '-' || MAX(CASE WHEN name LIKE 'price\\_%' ESCAPE '\\' THEN v END) AS price_range,
  MIN(CASE WHEN name LIKE 'size\\_%' ESCAPE '\\' THEN v END) || '-' || MAX(CASE WHEN name LIKE 'size\\_%' ESCAPE '\\' THEN v END) AS size_range FROM f GROUP BY 1
""")
def _(spark, d):
    s = F.col("o_orderstatus")
    df = table(spark, d, "orders").select(
        "o_custkey", F.when(s == "F", "price_min").when(s == "O", "price_max").otherwise("size_min").alias("name"),
        F.floor("o_totalprice").cast("string").alias("v"))
    return A.min_max_range(df, ["o_custkey"], "name", "v", ["price", "size"])
