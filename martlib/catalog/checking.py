"""Data-quality operators and the batch form of session carry-over."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlib.catalog.registry import query, scratch, table
from martlib.operators import quality as Q
from martlib.sources import writers
from martlib.streaming import streams


@query("l1_not_null", "SELECT event_id FROM events WHERE NULLIF(user_id % 7, 0) IS NULL")
def _(spark, d):
    return Q.not_null(table(spark, d, "events").withColumn("k", F.nullif(F.col("user_id") % 7, F.lit(0))), "k").select("event_id")


@query("l2_unique", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n_records FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1")
def _(spark, d):
    return Q.unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("l3_relationships", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, d):
    return Q.relationships(table(spark, d, "documents"), "doc_id", table(spark, d, "labels"), "doc_id").select("doc_id")


@query("l4_relationships_where", "SELECT doc_id FROM documents WHERE lang = 'en' AND doc_id NOT IN (SELECT doc_id FROM labels)")
def _(spark, d):
    docs = table(spark, d, "documents")
    return Q.relationships_where(docs, "doc_id", table(spark, d, "labels"), "doc_id", F.col("lang") == "en").select("doc_id")


@query("l5_not_accepted", "SELECT event_id FROM events WHERE event_type IN ('error', 'signup')")
def _(spark, d):
    return Q.not_accepted(table(spark, d, "events"), "event_type", ["error", "signup"]).select("event_id")


@query("l6_reconcile", """
WITH a AS (SELECT CAST(ts AS DATE) AS day, SUM(value) AS va FROM events WHERE event_type <> 'error' OR value < 60 GROUP BY 1),
b AS (SELECT CAST(ts AS DATE) AS day, SUM(value) AS vb FROM events GROUP BY 1)
SELECT day, ROUND(va, 2) AS value_a, ROUND(vb, 2) AS value_b FROM a FULL JOIN b USING (day) WHERE abs(va - vb) / abs(vb) * 100 > 13
""")
def _(spark, d):
    ev = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    out = Q.reconcile(ev, ev, ["day"], F.sum("value"), F.sum("value"), 13.0, cond_a=(F.col("event_type") != "error") | (F.col("value") < 60))
    return out.select("day", F.round("value_a", 2).alias("value_a"), F.round("value_b", 2).alias("value_b"))


@query("l7_freshness", "SELECT 'events' AS table_name, MAX(CAST(ts AS DATE)) AS last_date FROM events HAVING MAX(CAST(ts AS DATE)) < DATE '2024-02-05' - 1")
def _(spark, d):
    return Q.freshness(table(spark, d, "events"), "ts", F.lit("2024-02-05").cast("date"), 1, "events")


@query("i3_carry_session_date", """
WITH s AS (SELECT *, user_id AS session_id, CAST(ts AS DATE) AS event_date FROM events),
prior AS (SELECT session_id, MIN(event_date) AS session_date FROM s WHERE ts < TIMESTAMP '2024-01-10' AND event_type = 'view' GROUP BY 1),
batch AS (SELECT * FROM s WHERE ts >= TIMESTAMP '2024-01-10')
SELECT event_id, COALESCE(p.session_date, MIN(event_date) OVER (PARTITION BY b.session_id)) AS session_date FROM batch b LEFT JOIN prior p ON b.session_id = p.session_id
""")
def _(spark, d):
    s = table(spark, d, "events").withColumns({"session_id": F.col("user_id"), "event_date": F.col("ts").cast("date")})
    cut = F.lit("2024-01-10").cast("timestamp_ntz")
    prior = s.filter((F.col("ts") < cut) & (F.col("event_type") == "view")).withColumn("session_date", F.col("event_date"))
    return streams.carry_session_date(s.filter(F.col("ts") >= cut), prior).select("event_id", "session_date")


@query("i3_stream_session_dates", """
WITH s AS (SELECT event_id, ts, CASE WHEN event_id % 50 <> 0 THEN user_id END AS session_id FROM events),
cut AS (SELECT *, COALESCE(ts - lag(ts) OVER w > INTERVAL 6 HOUR, TRUE) AS starts FROM s WHERE session_id IS NOT NULL WINDOW w AS (PARTITION BY session_id ORDER BY ts)),
numbered AS (SELECT *, COUNT(*) FILTER (WHERE starts) OVER (PARTITION BY session_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS n FROM cut)
SELECT event_id, CAST(MIN(ts) OVER (PARTITION BY session_id, n) AS DATE) AS session_date FROM numbered
UNION ALL SELECT event_id, CAST(ts AS DATE) FROM s WHERE session_id IS NULL
""")
def _(spark, d):
    """The events come in three batches by time; sessions go on from one batch to the next."""
    src, out = scratch(spark, "session-in"), scratch(spark, "session-out")
    e = F.col("event_id")
    ev = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.when(e % 50 != 0, F.col("user_id")).alias("session_id"))
    day = F.dayofmonth("ts")
    # a last row that only moves the watermark past the end of all sessions
    beat = ev.agg((F.max("ts") + F.expr("interval 30 days")).alias("ts")).select(F.lit(None).cast("long").alias("event_id"), "ts", F.lit(-1).cast("long").alias("session_id"))
    for part in (ev.filter(day <= 10), ev.filter((day > 10) & (day <= 20)), ev.filter(day > 20), beat):
        part.coalesce(1).write.mode("append").parquet(src)
    sdf = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (
        streams.stream_session_dates(sdf, delay="2 days", pause="6 hours", longest="40 days").writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch(spark, "session-state")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.parquet(out).filter("event_id is not null").select("event_id", "session_date")


@query("i1_stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def _(spark, d):
    """Every event sent twice; the stream keeps one of each."""
    src, out = scratch(spark, "dedup-in"), scratch(spark, "dedup-out")
    ev = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    ev.unionByName(ev).write.parquet(src)
    sdf = spark.readStream.schema(ev.schema).parquet(src)
    q = (
        streams.stream_dedup(sdf, "event_id", "ts", "40 days").writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch(spark, "dedup-state")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("i2_stream_upsert", """
SELECT event_id, arg_max(value, v) AS value FROM (SELECT event_id, value, 0 AS v FROM events
  UNION ALL SELECT event_id, value + 1000, 1 FROM events WHERE event_type = 'purchase') GROUP BY event_id
""")
def _(spark, d):
    """Two deliveries of the same keys; the second one corrects half of them."""
    src, out = scratch(spark, "upsert-in"), scratch(spark, "upsert-out")
    ev = table(spark, d, "events").select("event_id", "value", F.col("ts").cast("date").alias("event_date"), "user_id", "event_type", F.lit(0).alias("v"))
    state = scratch(spark, "upsert-state")
    for part in (ev, ev.filter("event_type = 'purchase'").withColumns({"value": F.col("value") + 1000, "v": F.lit(1)})):
        part.write.mode("append").parquet(src)
        sdf = spark.readStream.schema(ev.schema).parquet(src)
        streams.stream_upsert(sdf, out, state, ["event_id"], "event_date", ["-v"], ["user_id"]).awaitTermination()
    return spark.read.parquet(out).select("event_id", "value")
