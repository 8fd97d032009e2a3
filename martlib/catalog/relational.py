"""Projection, filter, set and ordering operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlib.catalog.registry import query, table
from martlib.functions import rules as R
from martlib.functions import text as X
from martlib.operators import projection as P
from martlib.operators import sets as S
from martlib.operators import windows as W


@query("b1_select_as", "SELECT o_orderkey AS event_id, o_custkey AS entity_id, CAST(o_orderdate AS DATE) AS event_date FROM orders")
def _(spark, d):
    return P.select_as(table(spark, d, "orders"), {
        "event_id": "o_orderkey", "entity_id": "o_custkey", "event_date": F.col("o_orderdate").cast("date"),
    })


@query("b2_replace_cols", """
SELECT * REPLACE (upper(c_name) AS c_name, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal) FROM customer
""")
def _(spark, d):
    return P.replace_cols(table(spark, d, "customer"), {
        "c_name": F.upper("c_name"), "c_acctbal": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
    })


@query("b3_column_list", """
SELECT c_custkey AS buyer_id_x, c_name AS buyer_c_name_x, c_mktsegment AS buyer_segment_x FROM customer
""")
def _(spark, d):
    df = table(spark, d, "customer")
    return df.alias("c").select(*P.column_list(
        df.columns, prefix="buyer_", suffix="_x", table="c", exclude=["c_acctbal", "c_nationkey"],
        rename={"c_custkey": "id", "c_mktsegment": "segment"},
    ))


@query("b4_where", """
SELECT o_orderkey FROM orders
WHERE (o_orderpriority = '1-URGENT' OR o_orderpriority LIKE '5%' AND o_orderstatus NOT IN ('F', 'P'))
  AND o_totalprice BETWEEN 1000 AND 300000
""")
def _(spark, d):
    c = F.col
    pred = (c("o_orderpriority") == "1-URGENT") | (c("o_orderpriority").like("5%") & ~c("o_orderstatus").isin("F", "P"))
    return P.where(table(spark, d, "orders"), pred & c("o_totalprice").between(1000, 300000)).select("o_orderkey")


@query("b5_case", """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_orderstatus = 'F' THEN 'done' ELSE 'other' END AS label,
  COALESCE(NULLIF(o_orderstatus, 'P'), substr(o_orderpriority, 3), 'none') AS first_known FROM orders
""")
def _(spark, d):
    label = R.case([(F.col("o_totalprice") > 300000, "large"), (F.col("o_orderstatus") == "F", "done")], "other")
    known = R.first_non_null(F.nullif("o_orderstatus", F.lit("P")), F.substr("o_orderpriority", F.lit(3)), F.lit("none"))
    return table(spark, d, "orders").select("o_orderkey", label.alias("label"), known.alias("first_known"))


@query("b6_clean", """
WITH raw AS (
  SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN ' ' || event_type || ' ' ELSE event_type END AS name,
    CASE WHEN event_id % 7 = 0 THEN DATE '1970-01-01' ELSE CAST(ts AS DATE) END AS day,
    CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS amount,
    CASE WHEN event_id % 4 = 0 THEN '--' ELSE event_type END AS dashed, NULLIF(event_id % 2, 0) AS silent FROM events)
SELECT event_id, NULLIF(trim(name), '') AS name, NULLIF(day, DATE '1970-01-01') AS day, NULLIF(amount, 0) AS amount,
  NULLIF(dashed, '--') AS dashed, COALESCE(silent, 0) AS silent FROM raw
""")
def _(spark, d):
    e = F.col("event_id")
    raw = table(spark, d, "events").select(
        "event_id",
        F.when(e % 5 == 0, "").when(e % 5 == 1, F.concat(F.lit(" "), "event_type", F.lit(" "))).otherwise(F.col("event_type")).alias("name"),
        F.when(e % 7 == 0, F.lit("1970-01-01").cast("date")).otherwise(F.col("ts").cast("date")).alias("day"),
        F.when(e % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("amount"),
        F.when(e % 4 == 0, "--").otherwise(F.col("event_type")).alias("dashed"),
        F.nullif(e % 2, F.lit(0)).alias("silent"),
    )
    return P.clean(raw, {"name": "trim", "day": "epoch", "amount": "zero", "dashed": "dashes", "silent": "flag"})


@query("b7_in_list", "SELECT p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#7', 'Brand#12')")
def _(spark, d):
    return table(spark, d, "part").filter(R.in_list(F.col("p_brand"), [1, 7, 12], prefix="Brand#")).select("p_partkey")


@query("b8_distinct_on", "SELECT DISTINCT p_brand, p_type FROM part")
def _(spark, d):
    return P.distinct_on(table(spark, d, "part"), ["p_brand", "p_type"])


@query("b9_recode", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 99 END AS sort_order,
  CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS status FROM orders
""")
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        R.recode(F.col("o_orderpriority"), {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}, 99).alias("sort_order"),
        R.recode(F.col("o_orderstatus"), {"F": "Finished", "O": "Open"}, F.col("o_orderstatus")).alias("status"),
    )


@query("b10_mask_generated", """
SELECT event_id, CASE WHEN user_id % 4 = 0 THEN NULL WHEN user_id % 4 = 1 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_key FROM events
""")
def _(spark, d):
    u = F.col("user_id")
    raw = F.when(u % 4 == 0, F.concat(F.lit("_"), u.cast("string"))).when(u % 4 != 1, u.cast("string"))
    return table(spark, d, "events").select("event_id", X.mask_generated(raw).alias("user_key"))


@query("b11_surrogate_key", """
SELECT event_id, md5(concat_ws('-', CAST(user_id AS VARCHAR), COALESCE(CAST(NULLIF(event_id % 3, 0) AS VARCHAR), '_null_'), event_type)) AS record_id
FROM events
""")
def _(spark, d):
    return table(spark, d, "events").select(
        "event_id", X.surrogate_key("user_id", F.nullif(F.col("event_id") % 3, F.lit(0)), "event_type").alias("record_id")
    )


@query("b12_exclude_rows", """
SELECT event_id FROM events WHERE NOT (NULLIF(user_id % 5, 0) = 1 AND event_type = 'click')
""")
def _(spark, d):
    pred = (F.nullif(F.col("user_id") % 5, F.lit(0)) == 1) & (F.col("event_type") == "click")
    return P.exclude_rows(table(spark, d, "events"), pred).select("event_id")


@query("b13_flag", """
SELECT o_orderkey, o_orderstatus = 'F' AND o_totalprice > 100000 AS is_large_done, NULLIF(o_orderstatus, 'P') = 'F' AS is_done FROM orders
""")
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        R.flag((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)).alias("is_large_done"),
        R.flag(F.nullif("o_orderstatus", F.lit("P")) == "F").alias("is_done"),
    )


@query("f1_order_final", """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date FROM orders ORDER BY order_date DESC NULLS LAST, o_orderkey NULLS FIRST
""")
def _(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return S.order_final(df, ["-order_date", "o_orderkey"])


@query("f2_top_k", """
SELECT c_nationkey, c_custkey, c_acctbal FROM customer
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 3
""")
def _(spark, d):
    return W.top_k(table(spark, d, "customer"), ["c_nationkey"], ["-c_acctbal", "c_custkey"], 3).select("c_nationkey", "c_custkey", "c_acctbal")


@query("f3_limit_in_aggregate", """
SELECT user_id, arg_min(event_type, ts) FILTER (WHERE event_id % 3 <> 0) AS first_type FROM events GROUP BY user_id
""")
def _(spark, d):
    from martlib.operators.aggregates import first_non_null_by
    v = F.when(F.col("event_id") % 3 != 0, F.col("event_type"))
    return table(spark, d, "events").groupBy("user_id").agg(first_non_null_by(v, "ts").alias("first_type"))


@query("g1_stack", """
SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT c_custkey FROM customer
""")
def _(spark, d):
    a = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"))
    return S.stack(a, table(spark, d, "customer").select("c_custkey"))


@query("g2_union_distinct", """
SELECT l_partkey AS parent_key, l_suppkey AS child_key FROM lineitem WHERE l_linenumber = 1
UNION SELECT l_partkey, l_suppkey FROM lineitem WHERE l_quantity > 40
""")
def _(spark, d):
    li = table(spark, d, "lineitem")
    pick = lambda c: li.filter(c).select(F.col("l_partkey").alias("parent_key"), F.col("l_suppkey").alias("child_key"))
    return S.union_distinct(pick("l_linenumber = 1"), pick("l_quantity > 40"))


@query("g3_union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def _(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return S.union_by_name(a, b)
