"""The flagship query: sessions cut from an event stream at pauses, with metrics and customer attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlib.catalog.registry import query, table
from martlib.functions.text import surrogate_key
from martlib.operators import aggregates as A
from martlib.operators.joins import enrich
from martlib.operators.ordered import Lag, RunningCount, chained

PAUSE_SECONDS = 1800


def gap_sessions(spark, d):
    """Events with a session number per user; a pause of more than 30 minutes starts a new session."""
    ev = table(spark, d, "events")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("prev_ts").cast("timestamp"))
    starts = F.col("prev_ts").isNull() | (gap > PAUSE_SECONDS * 1_000_000)
    return chained(ev, ["user_id"], ["ts", "event_id"], [{"prev_ts": Lag(F.col("ts"))}, {"session_no": RunningCount(starts)}])


@query("flagship_sessions", """
WITH l AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts FROM events),
s AS (SELECT *, SUM(CASE WHEN prev_ts IS NULL OR epoch_us(ts) - epoch_us(prev_ts) > 1800000000 THEN 1 ELSE 0 END)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session_no FROM l),
m AS (SELECT user_id, CAST(session_no AS BIGINT) AS session_no, MIN(ts) AS session_start, MAX(ts) AS session_end, COUNT(*) AS n_events,
  date_sub('second', MIN(ts), MAX(ts)) AS duration_s, ROUND(SUM(value), 2) AS engagement, bool_or(event_type = 'signup') AS is_new_user,
  MAX(CASE WHEN event_type = 'purchase' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS purchase_k,
  MAX(CASE WHEN event_type = 'click' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS click_k,
  arg_min(event_type, (ts, event_id)) AS landing FROM s GROUP BY 1, 2)
SELECT md5(concat_ws('-', CAST(user_id AS VARCHAR), CAST(session_no AS VARCHAR))) AS record_id, m.*, c_name AS user_name, c_mktsegment AS user_segment
FROM m LEFT JOIN customer ON user_id = c_custkey
""")
def _(spark, d):
    t, k = F.col("event_type"), F.get_json_object("props", "$.k").cast("long")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    metrics = A.summarize(gap_sessions(spark, d), ["user_id", "session_no"], {
        "session_start": F.min("ts"), "session_end": F.max("ts"), "n_events": F.count("*"),
        "duration_s": F.floor((micros(F.max("ts")) - micros(F.min("ts"))) / 1_000_000),
        "engagement": F.round(F.sum("value"), 2), "is_new_user": A.any_true(t == "signup"),
        "purchase_k": A.agg_if("max", k, t == "purchase"), "click_k": A.agg_if("max", k, t == "click"),
        "landing": A.min_by_nn(t, F.struct("ts", "event_id")),
    })
    users = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("user_name"), F.col("c_mktsegment").alias("user_segment"))
    out = enrich(metrics, [(users, {"user_id": "c_custkey"}, ["user_name", "user_segment"])])
    return out.select(surrogate_key("user_id", "session_no").alias("record_id"), *out.columns)
