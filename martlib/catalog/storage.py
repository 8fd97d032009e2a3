"""Sources and sinks on the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martlib.catalog.registry import query, scratch, table
from martlib.operators.joins import scalar_bound
from martlib.sources import readers, writers


def _event_days(spark, d):
    """Events with their day, as a day-partitioned folder."""
    path = scratch(spark, "events")
    ev = table(spark, d, "events").withColumn("event_date", F.col("ts").cast("date"))
    writers.write_partitioned(ev, path, "event_date", ["user_id", "ts"])
    return path


@query("a1_read_shards", """
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_date FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'
""")
def _(spark, d):
    lo, hi = readers.shard_range(dt.date(2024, 1, 16), 6, dt.date(2024, 1, 14))
    return readers.read_shards(spark, _event_days(spark, d), lo, hi).select("event_id", "user_id", "event_type", "event_date")


@query("a2_read_table", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(spark, d):
    return readers.read_table(spark, "customer", folder=d).select("c_custkey", "c_name", "c_mktsegment")


@query("a3_read_pushed", """
SELECT o_orderkey, o_custkey, o_orderdate,
       CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INTEGER) AS week_start_date
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'
""")
def _(spark, d):
    df = readers.read_pushed(spark, "orders", "o_orderdate", dt.date(2000, 1, 1), folder=d)
    return df.select("o_orderkey", "o_custkey", "o_orderdate", "week_start_date")


@query("a4_read_lookup", "SELECT DISTINCT quality, toxic FROM labels")
def _(spark, d):
    return readers.read_lookup(table(spark, d, "labels"), ["quality", "toxic"])


@query("a5_write_partitioned", """
SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM events GROUP BY 1
""")
def _(spark, d):
    df = spark.read.parquet(_event_days(spark, d))
    return df.groupBy("event_date").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("a5_write_curved", """
SELECT CAST(ts AS DATE) AS event_date, COUNT(*) AS n, ROUND(SUM(value), 2) AS total FROM events WHERE value >= 50 AND event_type <> 'error' GROUP BY 1
""")
def _(spark, d):
    path = scratch(spark, "curved")
    ev = table(spark, d, "events").withColumn("event_date", F.col("ts").cast("date"))
    writers.write_curved(ev, path, "event_date", ["user_id", "value", "event_type", "ts"])
    df = spark.read.parquet(path).filter("value >= 50 and event_type <> 'error'")
    return df.groupBy("event_date").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query("a6_write_partitioned_month", """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_date_month, COUNT(*) AS n FROM orders GROUP BY 1
""")
def _(spark, d):
    path = scratch(spark, "orders_by_month")
    df = table(spark, d, "orders").withColumn("order_date", F.col("o_orderdate").cast("date"))
    writers.write_partitioned(df, path, "order_date", ["o_custkey"], grain="month")
    return spark.read.parquet(path).groupBy("order_date_month").agg(F.count("*").alias("n"))


@query("a7_materialize", """
SELECT c_mktsegment, COUNT(*) AS n, ROUND(SUM(c_acctbal), 2) AS balance FROM customer GROUP BY 1
""")
def _(spark, d):
    writers.materialize(table(spark, d, "customer").filter("c_custkey >= 0"), "customer_view", "view")
    df = spark.sql("select c_mktsegment, count(*) n, round(sum(c_acctbal), 2) balance from customer_view group by 1")
    return writers.materialize(df, "segment_totals", "table", scratch(spark, "segments"))


_UPSERT = """
WITH target AS (SELECT event_id, user_id, value, ts FROM events WHERE ts < TIMESTAMP '2024-01-20'),
upd AS (
  SELECT event_id, user_id, value + 1000 AS value, ts FROM events WHERE ts >= TIMESTAMP '2024-01-15'
  UNION ALL
  SELECT event_id, user_id, value + 2000, ts + INTERVAL 1 SECOND FROM events WHERE ts >= TIMESTAMP '2024-01-25'
),
newest AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS rn FROM upd)
SELECT event_id, user_id, value, ts FROM newest WHERE rn = 1
UNION ALL
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM newest n WHERE n.event_id = t.event_id)
"""


def _upsert_input(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "value", "ts")
    cut = lambda s: F.lit(s).cast("timestamp_ntz")
    target = ev.filter(F.col("ts") < cut("2024-01-20"))
    again = ev.filter(F.col("ts") >= cut("2024-01-15")).withColumn("value", F.col("value") + 1000)
    late = ev.filter(F.col("ts") >= cut("2024-01-25")).withColumns(
        {"value": F.col("value") + 2000, "ts": F.col("ts") + F.expr("interval 1 second")}
    )
    return target, again.unionByName(late)


@query("a8_merge_by_key", _UPSERT)
def _(spark, d):
    target, updates = _upsert_input(spark, d)
    return writers.merge_by_key(target, updates, ["event_id"], ["-ts"])


@query("a8_upsert_partitions", _UPSERT)
def _(spark, d):
    day = F.col("ts").cast("date")
    target, updates = _upsert_input(spark, d)
    path = scratch(spark, "upserted")
    writers.write_partitioned(target.withColumn("event_date", day), path, "event_date", ["user_id"])
    writers.upsert_partitions(updates.withColumn("event_date", day), path, ["event_id"], "event_date", ["-ts"], ["user_id"])
    return spark.read.parquet(path).drop("event_date")


_NULL_DAY = """CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS DATE) END"""


@query("a8_upsert_partitions_null_day", f"""
WITH target AS (SELECT event_id, value, {_NULL_DAY} AS event_date FROM events WHERE event_id % 3 <> 0),
upd AS (SELECT event_id, value + 1000 AS value, CASE WHEN event_id % 4 <> 0 THEN CAST(ts AS DATE) END AS event_date FROM events WHERE event_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-20')
SELECT * FROM upd UNION ALL SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.event_id = t.event_id)
""")
def _(spark, d):
    """Some rows of the target and of the updates have no day."""
    e, day = F.col("event_id"), F.col("ts").cast("date")
    ev = table(spark, d, "events")
    path = scratch(spark, "null-day")
    writers.write_partitioned(ev.filter(e % 3 != 0).select("event_id", "value", F.when(e % 5 != 0, day).alias("event_date")), path, "event_date")
    recent = ev.filter((e % 2 == 0) & (F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")))
    writers.upsert_partitions(recent.select("event_id", (F.col("value") + 1000).alias("value"), F.when(e % 4 != 0, day).alias("event_date")), path, ["event_id"], "event_date")
    return spark.read.parquet(path).select("event_id", "value", "event_date")


_NULL_KEY = "CASE WHEN event_id % 10 <> 0 THEN event_id END"


@query("a8_upsert_null_key", f"""
WITH target AS (SELECT {_NULL_KEY} AS k, value, CAST(ts AS DATE) AS event_date FROM events WHERE event_id % 3 <> 0
  QUALIFY row_number() OVER (PARTITION BY {_NULL_KEY} ORDER BY ts DESC, event_id) = 1),
upd AS (SELECT {_NULL_KEY} AS k, value + 1000 AS value, CAST(ts AS DATE) AS event_date FROM events WHERE event_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-20'
  QUALIFY row_number() OVER (PARTITION BY {_NULL_KEY} ORDER BY ts DESC, event_id) = 1)
SELECT * FROM upd UNION ALL SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.k IS NOT DISTINCT FROM t.k)
""")
def _(spark, d):
    """A tenth of the rows has no key; the same batch is loaded twice."""
    e = F.col("event_id")
    ev = table(spark, d, "events").select(F.when(e % 10 != 0, e).alias("k"), "value", "ts", F.col("ts").cast("date").alias("event_date"), "event_id")
    path = scratch(spark, "null-key")
    recent = ev.filter((e % 2 == 0) & (F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz"))).withColumn("value", F.col("value") + 1000)
    for rows in (ev.filter(e % 3 != 0), recent, recent):
        writers.upsert_partitions(rows, path, ["k"], "event_date", ["-ts", "event_id"])
    return spark.read.parquet(path).select("k", "value", "event_date")


@query("a8_upsert_indexed", """
SELECT event_id, value + CASE WHEN event_id % 40 = 0 THEN 2000 WHEN event_id % 20 = 0 THEN 1000 ELSE 0 END AS value,
  CAST(ts AS DATE) + CASE WHEN event_id % 40 = 0 THEN 1 WHEN event_id % 20 = 0 THEN 3 ELSE 0 END AS event_date FROM events
""")
def _(spark, d):
    """Keys move to another day, half of them twice; the days that hold them are found by the index."""
    e, day = F.col("event_id"), F.col("ts").cast("date")
    ev = table(spark, d, "events")
    path = scratch(spark, "indexed")
    for rows, days, more in ((ev, 0, 0), (ev.filter(e % 20 == 0), 3, 1000), (ev.filter(e % 40 == 0), 1, 2000)):
        moved = rows.select("event_id", (F.col("value") + more).alias("value"), F.date_add(day, days).alias("event_date"))
        writers.upsert_indexed(moved, path, ["event_id"], "event_date", buckets=8)
    return spark.read.parquet(path).select("event_id", "value", "event_date")


@query("a9_lookback", """
SELECT event_id, CAST(ts AS DATE) AS event_date FROM events
WHERE CAST(ts AS DATE) BETWEEN
  (SELECT LEAST(MAX(CAST(ts AS DATE)), DATE '2024-01-28' - 7) FROM events WHERE ts < TIMESTAMP '2024-01-19')
  AND DATE '2024-01-28'
""")
def _(spark, d):
    ev = table(spark, d, "events").select("event_id", F.col("ts").cast("date").alias("event_date"))
    last = scalar_bound(ev.filter(F.col("event_date") < F.lit(dt.date(2024, 1, 19))), F.max("event_date"))
    return writers.lookback(ev, "event_date", 7, last, dt.date(2024, 1, 28))


@query("a10_overwrite_partitions", """
SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-17' THEN value * 2 ELSE value END AS value FROM events
""")
def _(spark, d):
    path = _event_days(spark, d)
    recent = readers.read_shards(spark, path, "2024-01-17", "2024-01-30")
    writers.overwrite_partitions(recent.withColumn("value", F.col("value") * 2), path, "event_date", ["user_id", "ts"])
    return spark.read.parquet(path).select("event_id", "value")
