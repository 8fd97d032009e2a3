"""Join operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlib.catalog.registry import query, table
from martlib.functions import json_text as JT
from martlib.operators import joins as J


@query("c1_inner", """
SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def _(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return J.inner(li, o, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


@query("c2_enrich", """
SELECT o_orderkey, o_orderstatus, c_name, n_name, r_name FROM orders
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def _(spark, d):
    fact = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    out = J.enrich(fact, [
        (table(spark, d, "customer"), {"o_custkey": "c_custkey"}, ["c_name", "c_nationkey"]),
        (table(spark, d, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"]),
        (table(spark, d, "region"), {"n_regionkey": "r_regionkey"}, ["r_name"]),
    ])
    return out.select("o_orderkey", "o_orderstatus", "c_name", "n_name", "r_name")


@query("c3_join_using", """
SELECT custkey, n_orders, c_name FROM (SELECT o_custkey AS custkey, COUNT(*) AS n_orders FROM orders GROUP BY 1)
LEFT JOIN (SELECT c_custkey AS custkey, c_name FROM customer WHERE c_acctbal > 0) USING (custkey)
""")
def _(spark, d):
    l = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("custkey")).agg(F.count("*").alias("n_orders"))
    r = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("custkey"), "c_name")
    return J.join_using(l, r, ["custkey"])


@query("c4_join_keys", """
WITH a AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY ALL),
b AS (SELECT user_id, CAST(ts AS DATE) AS day, ROUND(SUM(value), 2) AS spent FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT * FROM a LEFT JOIN b USING (user_id, day)
""")
def _(spark, d):
    ev = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    a = ev.filter("event_type = 'click'").groupBy("user_id", "day").agg(F.count("*").alias("clicks"))
    b = ev.filter("event_type = 'purchase'").groupBy("user_id", "day").agg(F.round(F.sum("value"), 2).alias("spent"))
    return J.join_keys(a, b, ["user_id", "day"])


_FULL = """
WITH crm AS (SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_acctbal > 2000),
seen AS (SELECT user_id, COUNT(*) AS n_events, 'tracked' AS segment FROM events GROUP BY user_id)
SELECT COALESCE(crm.user_id, seen.user_id) AS user_id, name, n_events, COALESCE(crm.segment, seen.segment) AS segment
FROM crm FULL OUTER JOIN seen ON crm.user_id = seen.user_id
"""


def _full(spark, d):
    crm = table(spark, d, "customer").filter("c_acctbal > 2000").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    seen = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n_events")).withColumn("segment", F.lit("tracked"))
    return J.full_merge(crm, seen, ["user_id"], ["segment"])


@query("c5_full_merge", _FULL)
def _(spark, d):
    return _full(spark, d)


@query("c5_full_merge_split", _FULL)
def _(spark, d):
    return _full(spark, d)


def _tolerant_sql(test):
    return f"""
WITH inv AS (SELECT event_id AS invite_id, user_id % 3 AS k, ts AS invite_ts FROM events WHERE event_type = 'purchase'),
clk AS (SELECT event_id AS click_id, user_id % 3 AS k, ts AS click_ts FROM events WHERE event_type = 'click'),
i AS (SELECT *, floor(epoch_ms(invite_ts) / 3600000) AS b, floor(epoch_ms(invite_ts) / 600000) * 600 AS f FROM inv),
c AS (SELECT *, floor(epoch_ms(click_ts) / 3600000) AS b, floor(epoch_ms(click_ts) / 600000) * 600 AS f FROM clk),
m AS (SELECT i.k AS l_k, i.invite_id, i.invite_ts, c.k AS r_k, c.click_id, c.click_ts FROM i JOIN c ON i.k = c.k AND i.b = c.b AND {test})
SELECT * FROM m
UNION ALL SELECT k, invite_id, invite_ts, NULL, NULL, NULL FROM i WHERE invite_id NOT IN (SELECT invite_id FROM m)
UNION ALL SELECT NULL, NULL, NULL, k, click_id, click_ts FROM c WHERE click_id NOT IN (SELECT click_id FROM m)
"""


def _tolerant(spark, d, two_sided):
    ev = table(spark, d, "events").withColumn("k", F.col("user_id") % 3)
    inv = ev.filter("event_type = 'purchase'").select(F.col("event_id").alias("invite_id"), "k", F.col("ts").alias("invite_ts"))
    clk = ev.filter("event_type = 'click'").select(F.col("event_id").alias("click_id"), "k", F.col("ts").alias("click_ts"))
    return J.time_tolerant_full_join(inv, clk, ["k"], "invite_ts", "click_ts", 3600, 600, 600, two_sided)


@query("c6_time_tolerant_full_join", _tolerant_sql("i.f - c.f <= 600"))
def _(spark, d):
    return _tolerant(spark, d, False)


@query("c6_time_tolerant_two_sided", _tolerant_sql("abs(i.f - c.f) <= 600"))
def _(spark, d):
    return _tolerant(spark, d, True)


@query("c7_self_join_deeper", """
SELECT DISTINCT a.l_orderkey, a.l_suppkey, a.l_linenumber FROM lineitem a JOIN lineitem b
ON a.l_orderkey = b.l_orderkey AND a.l_suppkey % 5 = b.l_suppkey % 5 AND b.l_linenumber > a.l_linenumber
""")
def _(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber").withColumn("grp", F.col("l_suppkey") % 5)
    return J.self_join_deeper(li, ["l_orderkey", "grp"], "l_linenumber").select("l_orderkey", "l_suppkey", "l_linenumber").distinct()


@query("c8_anti", """
SELECT c_custkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' AND o_totalprice > 400000 WHERE o_orderkey IS NULL
""")
def _(spark, d):
    o = table(spark, d, "orders").filter("o_orderstatus = 'P' and o_totalprice > 400000")
    return J.anti(table(spark, d, "customer"), o, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey")


@query("c9_not_in", """
SELECT o_orderkey FROM orders WHERE NULLIF(o_custkey % 50, 0) NOT IN (SELECT s_suppkey % 30 FROM supplier)
""")
def _(spark, d):
    o = table(spark, d, "orders").withColumn("k", F.nullif(F.col("o_custkey") % 50, F.lit(0)))
    s = table(spark, d, "supplier").select((F.col("s_suppkey") % 30).alias("id"))
    return J.not_in(o, "k", s, "id").select("o_orderkey")


@query("c9_not_in_with_null", """
SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT NULLIF(s_suppkey, 7) FROM supplier)
""")
def _(spark, d):
    s = table(spark, d, "supplier").select(F.nullif("s_suppkey", F.lit(7)).alias("id"))
    return J.not_in(table(spark, d, "orders"), "o_custkey", s, "id").select("o_orderkey")


@query("c10_exists_flag", """
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) THEN 1 ELSE 0 END AS is_big FROM customer
""")
def _(spark, d):
    o = table(spark, d, "orders").filter("o_totalprice > 400000")
    return J.exists_flag(table(spark, d, "customer"), "c_custkey", o, "o_custkey", "is_big").select("c_custkey", "is_big")


@query("c11_year_spine", """
SELECT c_custkey, CAST(y AS INTEGER) AS year FROM customer, generate_series(1995, 2001) AS g(y)
""")
def _(spark, d):
    return J.year_spine(table(spark, d, "customer").select("c_custkey"), 1995, 2001)


@query("c12_unnest", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part
""")
def _(spark, d):
    return J.unnest(table(spark, d, "part").select("p_partkey", "p_name"), F.split("p_name", " "), "word").drop("p_name")


@query("c12_unnest_outer", """
SELECT p_partkey, word FROM (SELECT p_partkey, unnest(CASE WHEN p_size % 2 = 0 THEN string_split(p_name, ' ') ELSE [NULL] END) AS word FROM part)
""")
def _(spark, d):
    arr = F.when(F.col("p_size") % 2 == 0, F.split("p_name", " "))
    return J.unnest(table(spark, d, "part"), arr, "word", outer=True).select("p_partkey", "word")


@query("c13_role_join", """
SELECT c_custkey, a.n_name AS home_n_name, a.n_regionkey AS home_n_regionkey, b.n_name AS other_n_name, b.n_regionkey AS other_n_regionkey
FROM customer LEFT JOIN nation a ON c_nationkey = a.n_nationkey LEFT JOIN nation b ON c_custkey % 40 = b.n_nationkey
""")
def _(spark, d):
    c = table(spark, d, "customer").withColumn("other_key", F.col("c_custkey") % 40)
    out = J.role_join(c, table(spark, d, "nation"), {"home": "c_nationkey", "other": "other_key"}, "n_nationkey", ["n_name", "n_regionkey"])
    return out.select("c_custkey", "home_n_name", "home_n_regionkey", "other_n_name", "other_n_regionkey")


@query("c14_left_where", """
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
""")
def _(spark, d):
    o = table(spark, d, "orders")
    pred = "o_orderstatus = 'F' and o_orderpriority = '1-URGENT'"
    return J.left_where(table(spark, d, "customer"), o, F.col("c_custkey") == F.col("o_custkey"), pred).select("c_custkey", "o_orderkey")


@query("c15_scalar_bound", """
SELECT o_orderkey FROM orders WHERE o_orderdate >= (SELECT MAX(o_orderdate) FROM orders) - INTERVAL 90 DAY
""")
def _(spark, d):
    o = table(spark, d, "orders")
    top = J.scalar_bound(o, F.max("o_orderdate"))
    return o.filter(F.col("o_orderdate") >= F.lit(top) - F.expr("interval 90 days")).select("o_orderkey")


@query("c16_param", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind, NULL::VARCHAR AS missing FROM events
""")
def _(spark, d):
    value = lambda s, i: F.struct(s.cast("string").alias("string_value"), i.cast("long").alias("int_value"))
    params = F.array(
        F.struct(F.lit("k").alias("key"), value(F.lit(None), F.get_json_object("props", "$.k")).alias("value")),
        F.struct(F.lit("kind").alias("key"), value(F.col("event_type"), F.lit(None)).alias("value")),
    )
    ev = table(spark, d, "events").withColumn("params", params)
    p = F.col("params")
    return ev.select(
        "event_id", JT.param(p, "k", "int_value").alias("k"), JT.param(p, "kind", "string_value").alias("kind"),
        JT.param(p, "none", "string_value").alias("missing"),
    )


@query("c17_lookup_flag", """
WITH bots AS (SELECT DISTINCT CAST(ts AS DATE) AS day, CASE WHEN user_id % 9 = 0 THEN 'unknown' ELSE lower(event_type) END AS kind
  FROM events WHERE event_type = 'error' AND value > 150)
SELECT event_id, EXISTS (SELECT 1 FROM bots b WHERE b.day = CAST(e.ts AS DATE)
  AND b.kind = COALESCE(lower(CASE WHEN e.user_id % 9 <> 0 THEN e.event_type END), 'unknown')) AS suspected FROM events e
""")
def _(spark, d):
    ev = table(spark, d, "events").withColumns({"day": F.col("ts").cast("date"), "kind": F.when(F.col("user_id") % 9 != 0, F.col("event_type"))})
    bots = ev.filter("event_type = 'error' and value > 150").select("day", F.coalesce(F.lower("kind"), F.lit("unknown")).alias("kind"))
    on = [(F.col("day"), "day"), (F.coalesce(F.lower("kind"), F.lit("unknown")), "kind")]
    return J.lookup_flag(ev, bots, on, "suspected").select("event_id", "suspected")


@query("c18_link_by_name", """
WITH src AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size > 25 THEN ' ' || upper(p_brand) || '-HQ ' END AS arm_of FROM part
  UNION ALL SELECT 100000 + p_partkey, p_brand || '-hq', NULL FROM part WHERE p_size = 50),
par AS (SELECT upper(trim(name)) AS k, MIN(id) AS parent_id, MIN(trim(name)) AS parent_name FROM src WHERE name <> '' GROUP BY 1),
arm AS (SELECT upper(trim(arm_of)) AS k, trim(name) AS arm_name, id AS arm_id FROM src WHERE arm_of <> '')
SELECT parent_name, parent_id, string_agg(DISTINCT arm_name, ' , ' ORDER BY arm_name) AS arms_list, COUNT(DISTINCT arm_id) AS arms_count
FROM arm LEFT JOIN par USING (k) GROUP BY 1, 2
""")
def _(spark, d):
    p = table(spark, d, "part")
    arm_of = F.when(F.col("p_size") > 25, F.concat(F.lit(" "), F.upper("p_brand"), F.lit("-HQ ")))
    a = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), arm_of.alias("arm_of"))
    b = p.filter("p_size = 50").select(
        (F.col("p_partkey") + 100000).alias("id"), F.concat("p_brand", F.lit("-hq")).alias("name"), F.lit(None).cast("string").alias("arm_of"))
    return J.link_by_name(a.union(b), "arm_of", "name", "id")
