"""Product-analytics plans on stand-in inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from martlib.catalog.registry import query, scratch, table
from martlib.catalog.stand_ins import FLAT, LONG, flat_events, long_events, nested_events
from martlib.operators.quality import not_accepted, not_null, reconcile, relationships, unique
from martlib.plans import events as E
from martlib.plans import monitoring as M
from martlib.plans import pages as PG
from martlib.plans.flow_state import load_page_flow
from martlib.plans.identity_state import load_identities
from martlib.plans.incremental import load_continuing, load_window
from martlib.plans.session_state import load_sessions
from martlib.session import cut_lineage

_RANGE = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
_CANON = """CASE WHEN contains(lower(s), 'google') THEN 'google' ELSE s END"""

_P1 = "WITH " + FLAT + f""",
f1 AS (SELECT *, NULLIF(country, '') AS geo__country,
  CASE WHEN known_user IS NULL OR pseudo IS NULL THEN '_' || md5(concat_ws('-', COALESCE(NULLIF(country, ''), '_null_'), category)) END AS derived,
  NULLIF(COALESCE(known_user, '-') || COALESCE(pseudo, '-') || COALESCE(CAST(ga_session AS VARCHAR), '-'), '---') AS mk,
  CASE WHEN pseudo IS NOT NULL THEN COALESCE(
    last_value(known_user IGNORE NULLS) OVER (PARTITION BY pseudo, ga_session, event_date ORDER BY ts DESC {_RANGE}),
    last_value(known_user IGNORE NULLS) OVER (PARTITION BY pseudo, event_date ORDER BY ts DESC {_RANGE})) END AS u1 FROM flat),
f2 AS (SELECT *, COALESCE(u1, last_value(u1 IGNORE NULLS) OVER (PARTITION BY pseudo, ga_session, event_date ORDER BY ts {_RANGE}),
  last_value(u1 IGNORE NULLS) OVER (PARTITION BY pseudo, event_date ORDER BY ts {_RANGE})) AS u2 FROM f1),
fst AS (SELECT mk, derived AS rid, geo__country AS rc, category AS rcat FROM f2 WHERE u2 IS NOT NULL OR pseudo IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY mk ORDER BY ts) = 1),
ids AS (SELECT f2.* EXCLUDE (geo__country), COALESCE(u2, rid, derived) AS user_id, u2 IS NULL AND COALESCE(rid, derived) IS NOT NULL AS is_user_id_generated,
  COALESCE(pseudo, rid, derived) AS user_pseudo_id, pseudo IS NULL AND COALESCE(rid, derived) IS NOT NULL AS is_user_pseudo_id_generated,
  COALESCE(rc, geo__country) AS geo__country, COALESCE(rcat, category) AS device__category FROM f2 LEFT JOIN fst USING (mk)),
att AS (SELECT *, COALESCE(NULLIF(regexp_extract(url, '[?&]utm_source=([^&]+)', 1), ''), trim(NULLIF(COALESCE(src, 'partner'), '(none)'), '()')) AS s,
  COALESCE(NULLIF(regexp_extract(url, '[?&]utm_medium=([^&]+)', 1), ''), trim(NULLIF(COALESCE(med, 'referral'), '(none)'), '()')) AS marketing_medium,
  NULLIF(regexp_extract(url, '[?&]utm_campaign=([^&]+)', 1), '') AS marketing_campaign FROM ids),
ob AS (SELECT *, {_CANON} AS marketing_source, CASE marketing_campaign WHEN 'c0' THEN 'Awareness' WHEN 'c1' THEN 'Leads' END AS marketing_objective FROM att),
s1 AS (SELECT *, user_pseudo_id || COALESCE(CAST(ga_session AS VARCHAR), ymd) AS sid0 FROM ob),
s2 AS (SELECT *, CASE WHEN is_user_pseudo_id_generated THEN user_pseudo_id || '_' || event_date || '_' ||
  COUNT(*) FILTER (WHERE event_name = 'session_start') OVER (PARTITION BY sid0 ORDER BY ts, CASE WHEN event_name = 'session_start' THEN 0 ELSE 1 END ROWS UNBOUNDED PRECEDING)
  ELSE sid0 END AS session_id FROM s1),
prior AS (SELECT DISTINCT session_id, DATE '2023-12-31' AS pd FROM s2 WHERE pseudo = 'p5.'),
s3 AS (SELECT s2.*, COALESCE(pd, MIN(event_date) OVER (PARTITION BY s2.session_id)) AS session_date, CAST(MAX(engaged) OVER (PARTITION BY s2.session_id) AS BIGINT) AS session_engaged
  FROM s2 LEFT JOIN prior ON s2.session_id = prior.session_id),
u AS (SELECT *, unnest(['ga_session_id', 'session_engaged', 'engagement_time_msec', 'page_location', 'source', 'medium']) AS event_key FROM s3)
SELECT seq, event_key, user_id, is_user_id_generated, user_pseudo_id, is_user_pseudo_id_generated, session_id, session_date, 1 AS ga_session_number, session_engaged,
  geo__country, device__category, marketing_source, marketing_medium, marketing_campaign, marketing_objective, marketing_objective || ' ' || marketing_source AS marketing_campaign_group,
  CASE event_key WHEN 'page_location' THEN url WHEN 'source' THEN src WHEN 'medium' THEN med END AS event__string_value,
  CAST(CASE event_key WHEN 'ga_session_id' THEN ga_session WHEN 'session_engaged' THEN engaged WHEN 'engagement_time_msec' THEN msec END AS DOUBLE) AS event__int_value FROM u
"""
_DIMS = ["geo__country", "device__category"]
_P1_COLS = [
    "event_key", "user_id", "is_user_id_generated", "user_pseudo_id", "is_user_pseudo_id_generated", "session_id", "session_date", "ga_session_number", "session_engaged",
    *_DIMS, "marketing_source", "marketing_medium", "marketing_campaign", "marketing_objective", "marketing_campaign_group", "event__string_value", "event__int_value",
]


def _p1_lookups(spark, d):
    """Sessions known from before, and the objectives of campaigns."""
    flat = flat_events(spark, d)
    camp = F.col("k") % 3
    objectives = flat.filter(camp < 2).select(
        F.concat(F.lit("c"), camp.cast("string")).alias("campaign"), F.when(camp == 0, "Awareness").otherwise("Leads").alias("objective")).distinct()
    prior = flat.filter("pseudo = 'p5.'").select(
        F.concat("pseudo", F.col("ga_session").cast("string")).alias("session_id"), F.lit(dt.date(2023, 12, 31)).alias("session_date")).distinct()
    return prior, objectives


def _unnested(spark, d, split=True):
    return E.unnest_events(nested_events(spark, d), *_p1_lookups(spark, d), dimensions=_DIMS, split=split)


@query("p1_unnest_events", _P1)
def _(spark, d):
    return _unnested(spark, d).select(F.col("event_bundle_sequence_id").alias("seq"), *_P1_COLS)


@query("p1_unnest_events_split", _P1)
def _(spark, d):
    return _unnested(spark, d, True).select(F.col("event_bundle_sequence_id").alias("seq"), *_P1_COLS)


def _daily(spark, d, source, build, name, key, by, date="event_date"):
    """Three loads of seven days and what lies since the load before."""
    path = scratch(spark, name)
    for day in (9, 19, 31):
        load_window(source, build, path, date=date, key=key, by=by, days=7, today=dt.date(2024, 1, day))
    return spark.read.parquet(path)


@query("p1_incremental", "SELECT seq, event_key, user_pseudo_id, ga_session_number, session_id, session_date, geo__country, device__category, event__string_value, event__int_value FROM (" + _P1 + ")")
def _(spark, d):
    """Day-by-day loads give the rows of a full load, but for user ids that are filled from days outside the window."""
    flat = flat_events(spark, d)
    first = flat.filter("pseudo = 'p5.'").select(
        F.concat("pseudo", F.col("ga_session").cast("string")).alias("session_id"), F.lit(dt.date(2023, 12, 31)).alias("session_date")).distinct()

    def build(rows, prior):
        known = first if prior is None else first.unionByName(prior.select("session_id", "session_date").distinct())
        return E.unnest_events(rows, known, None, dimensions=_DIMS)

    out = _daily(spark, d, nested_events(spark, d).withColumn("event_day", F.to_date("event_date", "yyyyMMdd")), build, "p1-days", ["event_id", "event_key"], "event_date", "event_day")
    return out.select(
        F.col("event_bundle_sequence_id").alias("seq"), "event_key", "user_pseudo_id", "ga_session_number", "session_id", "session_date", *_DIMS, "event__string_value", "event__int_value")


@query("p1_late_identities", _P1)
def _(spark, d):
    """Half of the logins and of the morning events arrive after the days that they change."""
    raw = nested_events(spark, d)
    path = scratch(spark, "p1-raw")
    raw.write.partitionBy("event_date").parquet(path)
    raw = spark.read.schema(raw.schema).parquet(path)
    seq, day = F.col("event_bundle_sequence_id"), F.col("event_date")
    late = (F.pmod(F.xxhash64(seq), F.lit(2)) == 0) & (F.col("user_id").isNotNull() | (F.hour(F.timestamp_micros("event_timestamp")) < 6))
    loads = [~late & (day <= "20240119"), ~late & (day > "20240119"), late]
    folder, so_far = scratch(spark, "p1-late"), F.lit(False)
    prior, objectives = _p1_lookups(spark, d)
    for part in loads:
        so_far = so_far | part
        out = load_identities(raw.filter(so_far), raw.filter(part), folder, prior, objectives, dimensions=_DIMS)
    return spark.read.parquet(out).select(F.col("event_bundle_sequence_id").alias("seq"), *_P1_COLS)


def _initcap(x):
    return f"array_to_string(list_transform(regexp_extract_all(lower({x}), '[^\\s/_-]+|[\\s/_-]'), lambda p: upper(p[1]) || p[2:]), '')"


_GROUP = """CASE WHEN {p} LIKE '/company_page/%' THEN '/company_page' WHEN {p} LIKE '/startups/search%' THEN '/startups/search' WHEN {p} LIKE '/investor_page/%' THEN '/investor_page'
  WHEN {p} LIKE '/reports/%' THEN '/reports' WHEN {p} LIKE '/investors/search%' THEN '/investors/search' WHEN {p} LIKE '/hubs/search%' THEN '/hubs/search' ELSE '/' END"""
_GROUP_NAME = """CASE WHEN {p} LIKE '/company_page/%' THEN 'Company Page' WHEN {p} LIKE '/startups/search%' THEN 'Startups Search' WHEN {p} LIKE '/investor_page/%' THEN 'Investor Page'
  WHEN {p} LIKE '/reports/%' THEN 'Reports' WHEN {p} LIKE '/investors/search%' THEN 'Investors Search' WHEN {p} LIKE '/hubs/search%' THEN 'Hubs Search' ELSE 'Homepage' END"""
_PATH = "replace(lower(regexp_extract(url, 'https?://[^/]+(/[^?#]*)', 1)), '//', '/')"

# One pivoted event per row, as plan 2 leaves it.
PIVOTED = "WITH " + LONG + f""",
q0 AS (SELECT *, {_PATH} AS page_path, lower(NULLIF(regexp_extract(url, '[&?](?:section|tab)=([^?&=]+)', 1), '')) AS tab0,
  NULLIF(regexp_extract(url, '/\\w+_page/([^/#?]+)', 1), '') AS company_url_name FROM ev),
q1 AS (SELECT *, {_GROUP.format(p='page_path')} AS grouped_page_path, {_GROUP_NAME.format(p='page_path')} AS grouped_page_name FROM q0),
q2 AS (SELECT *, {_initcap("trim(replace(replace(CASE WHEN (event_name <> 'profile_interactions' OR lower(entity_type) LIKE '%tabs') AND grouped_page_path IN ('/company_page', '/investor_page') AND tab0 IS NULL THEN 'overview' ELSE tab0 END, '-', ' '), '_', ' '))")} AS tab,
  CASE section WHEN 'Description Cleantech More' THEN 'Description Read More' WHEN 'news' THEN 'News' WHEN 'team' THEN 'Team' ELSE section END AS section2,
  CASE entity_type WHEN 'Moltinational Tabs' THEN 'Multinational Tabs' ELSE entity_type END AS entity_type2, trim(string_split(title, '|')[1]) AS page_title,
  round(msec / 1000, 4) AS secs FROM q1),
q3 AS (SELECT *, CASE WHEN session_id IS NOT NULL THEN lag(page_path) OVER (PARTITION BY session_id ORDER BY ts, batch_sort_key, eid) END AS prev_path FROM q2),
q4 AS (SELECT *, CASE WHEN event_name = 'session_start' THEN 1 WHEN session_id IS NOT NULL THEN COUNT(*) FILTER (WHERE prev_path IS NULL OR page_path <> prev_path)
  OVER (PARTITION BY session_id ORDER BY ts, batch_sort_key, eid ROWS UNBOUNDED PRECEDING) END AS page_view_rank FROM q3),
q5 AS (SELECT *, CASE WHEN session_id IS NOT NULL THEN lead(secs) OVER (PARTITION BY session_id, page_view_rank ORDER BY batch_sort_key, ts, eid) END AS lead_secs,
  CASE WHEN session_id IS NOT NULL THEN round(SUM(secs) OVER (PARTITION BY session_id, page_view_rank), 4) END AS page_secs FROM q4)
"""


def pivoted(spark, d, split=True):
    return E.pivot_events(long_events(spark, d), split=split)


_P2 = PIVOTED + """
SELECT eid AS event_id, page_path, tab, section2 AS section, entity_type2 AS entity_type, page_title, grouped_page_path, grouped_page_name, company_url_name,
  round(secs, 4) AS engagement_time_seconds, prev_path AS previous_page_path, CAST(page_view_rank AS BIGINT) AS page_view_rank, lead_secs AS engagement_time_seconds_lead,
  page_secs AS page_view_engagement_time_seconds FROM q5
"""


def _p2(spark, d, split):
    return pivoted(spark, d, split).select(
        "event_id", "page_path", "tab", "section", "entity_type", "page_title", "grouped_page_path", "grouped_page_name", "company_url_name", "engagement_time_seconds",
        F.when(F.col("session_id").isNotNull(), F.col("previous_page_path")).alias("previous_page_path"), "page_view_rank", "engagement_time_seconds_lead",
        F.round("page_view_engagement_time_seconds", 4).alias("page_view_engagement_time_seconds"))


@query("p2_pivot_events", _P2)
def _(spark, d):
    return _p2(spark, d, True)


@query("p2_pivot_events_split", _P2)
def _(spark, d):
    return _p2(spark, d, True)


_CHANNEL = """CASE WHEN marketing_source = 'google' AND regexp_matches(marketing_medium, '^(.*cp.*|ppc|paid.*)$') THEN 'Paid Search'
  WHEN marketing_source = 'google' THEN 'Organic Search' WHEN marketing_medium = 'email' THEN 'Email' ELSE 'Unassigned' END"""
_SESSIONS = "WITH " + LONG + f""",
le AS (SELECT *, eid AS event_id, NULLIF(country, '') AS geo__country, src AS marketing_source, med AS marketing_medium FROM lv WHERE session_id IS NOT NULL),
m AS (SELECT user_pseudo_id, session_id, event_date AS session_date, arg_min(user_id, ts) AS user_id, MIN(ts) AS session_min_event_datetime, MAX(ts) AS session_max_event_datetime,
  date_sub('second', MIN(ts), MAX(ts)) AS session_duration, round(COALESCE(SUM(CASE WHEN event_key = 'engagement_time_msec' THEN ival END) / 1000, 0), 4) AS session_engagement_time,
  arg_min(sval, ts) FILTER (WHERE event_name = 'session_start' AND event_key = 'page_location') AS landing_page FROM le GROUP BY 1, 2, 3),
fu AS (SELECT session_id, string_agg(event_name, ',' ORDER BY ts, eid) AS session_events FROM (SELECT DISTINCT eid, session_id, ts, event_name FROM le) GROUP BY 1),
di AS (SELECT session_id, geo__country, category AS device__category, marketing_source, marketing_medium, {_CHANNEL} AS channel_grouping FROM le
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY CASE WHEN lower({_CHANNEL}) LIKE '%paid%' THEN 1 ELSE 2 END, ts DESC, eid) = 1),
bots AS (SELECT DISTINCT event_date AS date_day, lower(COALESCE(NULLIF(country, ''), 'unknown')) AS country FROM flat WHERE event_name = 'scroll' AND value > 200),
ses AS (SELECT md5(concat_ws('-', session_id, CAST(session_date AS VARCHAR))) AS record_id, m.*, FALSE AS is_new_user, session_events, geo__country, device__category, channel_grouping,
  CASE WHEN geo__country IS NULL THEN NULL WHEN geo__country = 'Israel' THEN 'Home' WHEN geo__country = 'France' THEN 'Europe' END AS market_region, 0 AS target_market,
  geo__country = 'Israel' AS is_home_country, EXISTS (SELECT 1 FROM bots b WHERE b.date_day = session_date AND b.country = COALESCE(lower(geo__country), 'unknown')) AS suspected_fraud
  FROM m LEFT JOIN fu USING (session_id) LEFT JOIN di USING (session_id))
"""
_SES_COLS = [
    "record_id", "user_pseudo_id", "session_id", "session_date", "user_id", "session_min_event_datetime", "session_max_event_datetime", "session_duration",
    "session_engagement_time", "landing_page", "is_new_user", "session_events", "geo__country", "device__category", "channel_grouping", "market_region", "target_market",
    "is_home_country", "suspected_fraud",
]


_SES_ARGS = dict(dimensions=_DIMS, marketing=["marketing_source", "marketing_medium"], regions=[("Home", ["Israel"]), ("Europe", ["France"])])


def _bots(spark, d):
    return flat_events(spark, d).filter("event_name = 'scroll' and value > 200").select(
        F.col("event_date").alias("date_day"), F.lower(F.coalesce(F.nullif("country", F.lit("")), F.lit("unknown"))).alias("country")).distinct()


def sessions(spark, d):
    out = E.build_sessions(long_events(spark, d), _bots(spark, d), **_SES_ARGS)
    return out.withColumn("session_engagement_time", F.round("session_engagement_time", 4))


@query("p3_build_sessions", _SESSIONS + "SELECT " + ", ".join(_SES_COLS) + " FROM ses")
def _(spark, d):
    return sessions(spark, d).select(*_SES_COLS)


@query("p3_incremental", _SESSIONS + "SELECT " + ", ".join(_SES_COLS) + " FROM ses")
def _(spark, d):
    """Days out of order, a third load of late events of all days, and one load that runs twice give the sessions of a full load."""
    long, bots, folder = long_events(spark, d), _bots(spark, d), scratch(spark, "p3-loads")
    late, early = F.hash("event_id") % 7 == 0, F.col("event_date") < F.lit(dt.date(2024, 1, 16))
    loads = {"second-half": ~late & ~early, "first-half": ~late & early, "late": late}
    for name in ("second-half", "late", "first-half", "late"):
        path = load_sessions(long.filter(loads[name]), folder, name, bots, span=1, **_SES_ARGS)
    out = spark.read.parquet(path)
    return out.withColumn("session_engagement_time", F.round("session_engagement_time", 4)).select(*_SES_COLS)


USERS_SQL = """,
users AS (SELECT CASE WHEN c_custkey % 10 = 9 THEN 'empty_user_id' ELSE 'u' || (c_custkey % 80) END AS user_id, 'd' || (c_custkey % 130) AS user_pseudo_id, c_custkey AS record_id,
  c_custkey % 3 = 0 AS is_user_registered, c_custkey % 6 = 0 AS is_user_confirmed, DATE '2023-01-01' + CAST(c_custkey % 200 AS INTEGER) AS user_signup_date,
  TIMESTAMP '2023-01-01' + INTERVAL (c_custkey) HOUR AS signup_start_datetime, c_mktsegment AS user_type, c_name AS user_name FROM customer)
"""


def user_records(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        F.when(k % 10 == 9, "empty_user_id").otherwise(F.concat(F.lit("u"), (k % 80).cast("string"))).alias("user_id"),
        F.concat(F.lit("d"), (k % 130).cast("string")).alias("user_pseudo_id"), k.alias("record_id"), (k % 3 == 0).alias("is_user_registered"),
        (k % 6 == 0).alias("is_user_confirmed"), F.date_add(F.lit("2023-01-01").cast("date"), (k % 200).cast("int")).alias("user_signup_date"),
        (F.lit("2023-01-01").cast("timestamp_ntz") + F.make_dt_interval(hours=k.cast("int"))).alias("signup_start_datetime"),
        F.col("c_mktsegment").alias("user_type"), F.col("c_name").alias("user_name"))


_ENRICHED = _SESSIONS + USERS_SQL + f""",
n1 AS (SELECT * REPLACE (CASE WHEN substr(session_id, 2, 1) IN ('1', '2', '3') THEN NULL ELSE user_id END AS user_id) FROM ses),
n2 AS (SELECT *, last_value(user_id IGNORE NULLS) OVER (PARTITION BY user_pseudo_id ORDER BY session_min_event_datetime DESC {_RANGE}) AS later FROM n1),
n3 AS (SELECT * REPLACE (COALESCE(user_id, later) AS user_id) FROM n2),
best AS (SELECT COALESCE(NULLIF(user_id, 'empty_user_id'), user_pseudo_id) AS mk, user_type, user_name FROM users
  QUALIFY row_number() OVER (PARTITION BY NULLIF(user_id, 'empty_user_id') ORDER BY is_user_registered DESC, is_user_confirmed DESC, user_signup_date, signup_start_datetime, user_pseudo_id, record_id) = 1),
n4 AS (SELECT n3.* REPLACE (CASE WHEN left(n3.user_id, 1) = '_' THEN NULL ELSE n3.user_id END AS user_id), user_type, user_name FROM n3 LEFT JOIN best ON COALESCE(n3.user_id, n3.user_pseudo_id) = mk),
n5 AS (SELECT *, COUNT(DISTINCT session_id) OVER (PARTITION BY user_id) AS n FROM n4)
SELECT record_id, user_id, user_type, user_name, CASE WHEN user_id IS NOT NULL AND year(session_date) >= 2024 THEN n >= 25 END AS is_power_user FROM n5
"""


def _enriched(spark, d, split):
    ses = sessions(spark, d).withColumn("user_id", F.when(~F.substring("session_id", 2, 1).isin("1", "2", "3"), F.col("user_id")))
    out = E.enrich_sessions(ses, user_records(spark, d), user_columns=["user_type", "user_name"], split=split)
    return out.select("record_id", "user_id", "user_type", "user_name", "is_power_user")


@query("p4_enrich_sessions", _ENRICHED)
def _(spark, d):
    return _enriched(spark, d, True)


@query("p4_enrich_sessions_split", _ENRICHED)
def _(spark, d):
    return _enriched(spark, d, True)


_FLOW = PIVOTED + """,
w0 AS (SELECT *, replace(grouped_page_name, ' Page', '') AS gname, event_name = 'page_view' AS is_view FROM q5
  WHERE event_name IN ('page_view', 'profile_interactions') AND (event_name <> 'profile_interactions' OR lower(entity_type2) LIKE '%tabs')),
w1 AS (SELECT *, CASE WHEN is_view AND session_id IS NOT NULL THEN lag(url) OVER (PARTITION BY session_id, is_view ORDER BY ts, eid) END AS prev_url FROM w0),
w2 AS (SELECT *, CASE WHEN tab IS NOT NULL THEN COALESCE(gname, '') || ' - ' || tab ELSE gname END AS gtab FROM w1 WHERE NOT is_view OR prev_url IS NULL OR url <> prev_url)
SELECT eid AS record_id, CASE WHEN left(user_id, 1) = '_' THEN NULL ELSE user_id END AS user_id,
  CASE WHEN session_id IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY session_id ORDER BY ts, eid) END AS session_event_rank, gtab AS grouped_page_name_with_tab,
  CASE WHEN is_view AND session_id IS NOT NULL THEN lag(grouped_page_path) OVER (PARTITION BY session_id, is_view ORDER BY ts, eid) END AS previous_grouped_page_path,
  CASE WHEN is_view AND session_id IS NOT NULL THEN lag(gtab) OVER (PARTITION BY session_id, is_view ORDER BY ts, eid) END AS previous_grouped_page_name,
  gname AS grouped_page_name_1, CASE WHEN session_id IS NOT NULL THEN lead(gname, 1) OVER (PARTITION BY session_id ORDER BY ts, eid) END AS grouped_page_name_2,
  CASE WHEN session_id IS NOT NULL THEN lead(gname, 2) OVER (PARTITION BY session_id ORDER BY ts, eid) END AS grouped_page_name_3,
  CASE WHEN session_id IS NOT NULL THEN lead(gname, 3) OVER (PARTITION BY session_id ORDER BY ts, eid) END AS grouped_page_name_4 FROM w2
"""


def _flow_columns(flow):
    return flow.select(
        "record_id", "user_id", F.col("session_event_rank").cast("long").alias("session_event_rank"), "grouped_page_name_with_tab", "previous_grouped_page_path",
        "previous_grouped_page_name", *[f"grouped_page_name_{i}" for i in range(1, 5)])


def _flow(spark, d, split):
    return _flow_columns(PG.page_flow(pivoted(spark, d, False), 4, split=split))


@query("p6_page_flow", _FLOW)
def _(spark, d):
    return _flow(spark, d, True)


@query("p6_page_flow_split", _FLOW)
def _(spark, d):
    return _flow(spark, d, True)


# Sessions of two days, so that half of the nights lie within one.
_TWO_DAYS = ("'_' || dayofyear(ts) END AS session_id", "'_' || (dayofyear(ts) // 2) END AS session_id")


def _over_midnight(spark, d):
    two = F.floor(F.dayofyear("event_datetime_utc") / 2).cast("string")
    long = long_events(spark, d).withColumn("session_id", F.concat(F.substring_index("session_id", "_", 1), F.lit("_"), two))
    return E.pivot_events(long, split=False)


def load_days(spark, events, build, name):
    folder = scratch(spark, name)
    for first, last in ((None, 10), (9, 16), (17, 31)):
        upto = events.filter(F.col("event_date") <= F.lit(dt.date(2024, 1, last)))
        path = load_continuing(upto, build, folder, by="date_day", since=first and dt.date(2024, 1, first), span=2, cluster=["session_id"])
    return spark.read.parquet(path)


@query("p6_incremental", _FLOW.replace(*_TWO_DAYS))
def _(spark, d):
    """Loads that start within a session, one of them over days loaded before, give the flow of a full load."""
    events, folder = cut_lineage(_over_midnight(spark, d)), scratch(spark, "p6-days")
    for first, last in ((None, 10), (9, 16), (17, 31)):
        upto = events.filter(F.col("event_date") <= F.lit(dt.date(2024, 1, last)))
        path = load_page_flow(upto, folder, first and dt.date(2024, 1, first), span=2)
    return _flow_columns(spark.read.parquet(path))


_INTERACTIONS = PIVOTED + f""",
co AS (SELECT 'acme-' || (c_custkey % 7) AS company_url_name, arg_min(c_custkey, (-c_nationkey, c_custkey)) AS company_id FROM customer GROUP BY 1),
i0 AS (SELECT *, CASE WHEN event_name = 'profile_interactions' THEN CASE WHEN lower(section2) = 'follow' THEN 'follow - ' || lower(entity_type2) ELSE lower(section2) END END AS act FROM q5 WHERE company_url_name IS NOT NULL),
i1 AS (SELECT i0.* EXCLUDE (tab), company_id, CASE WHEN session_id IS NOT NULL THEN CASE WHEN event_name IN ('session_start', 'page_view') THEN 'overview' ELSE tab END END AS tab
  FROM i0 LEFT JOIN co USING (company_url_name)),
i2 AS (SELECT *, lag(tab) OVER (PARTITION BY session_id, page_view_rank ORDER BY ts, batch_sort_key, eid) AS ptab FROM i1),
i3 AS (SELECT *, CASE WHEN session_id IS NOT NULL THEN COUNT(*) FILTER (WHERE tab IS NOT NULL AND (ptab IS NULL OR tab <> ptab))
  OVER (PARTITION BY session_id, page_view_rank ORDER BY ts, batch_sort_key, eid ROWS UNBOUNDED PRECEDING) END AS tab_rank FROM i2)
SELECT eid AS event_id, company_id, {_initcap('act')} AS action,
  {_initcap("CASE WHEN event_name = 'page_view' THEN 'page view' WHEN act IN ('news', 'team') THEN 'tabs' WHEN act LIKE 'follow%' THEN 'follow' ELSE act END")} AS action_category,
  CAST(tab_rank AS BIGINT) AS tab_rank,
  CASE WHEN session_id IS NOT NULL THEN last_value(tab IGNORE NULLS) OVER (PARTITION BY session_id, page_view_rank, tab_rank ORDER BY ts, batch_sort_key, eid {_RANGE.replace('RANGE', 'ROWS')}) END AS tab,
  CASE WHEN session_id IS NOT NULL THEN round(SUM(lead_secs) OVER (PARTITION BY session_id, page_view_rank, tab_rank), 4) END AS tab_engagement_time_seconds FROM i3
"""


def _interactions(spark, d):
    """Events to profile interactions, and the columns that are compared."""
    c = F.col
    companies = table(spark, d, "customer").select(
        c("c_custkey").alias("company_id"), F.concat(F.lit("acme-"), (c("c_custkey") % 7).cast("string")).alias("company_url_name"), c("c_nationkey").alias("updated_date"))
    shown = lambda out: out.select(
        "event_id", "company_id", "action", "action_category", "tab_rank", "tab", F.round("tab_engagement_time_seconds", 4).alias("tab_engagement_time_seconds"))
    return lambda events: PG.profile_interactions(events, companies), shown


@query("p7_profile_interactions", _INTERACTIONS)
def _(spark, d):
    build, shown = _interactions(spark, d)
    return shown(build(pivoted(spark, d, False)))


@query("p7_profile_interactions_split", _INTERACTIONS)
def _(spark, d):
    build, shown = _interactions(spark, d)
    return shown(build(pivoted(spark, d, False)))


@query("p7_incremental", _INTERACTIONS.replace(*_TWO_DAYS))
def _(spark, d):
    """Loads that start within a session, one of them over days loaded before, give the interactions of a full load."""
    build, shown = _interactions(spark, d)
    return shown(load_days(spark, cut_lineage(_over_midnight(spark, d)), build, "p7-days"))


@query("p12_event_monitor", "WITH " + LONG + """,
tot AS (SELECT event_date AS day, event_name, NULL AS event_key, NULL AS event_value, COUNT(*) AS n FROM lv WHERE event_date >= DATE '2024-01-05' GROUP BY ALL
  UNION ALL SELECT event_date, event_name, event_key, sval, COUNT(*) FROM lv
  WHERE event_date >= DATE '2024-01-05' AND event_key IN ('action', 'label', 'type') AND sval <> '' AND length(sval) < 7 GROUP BY ALL),
p AS (SELECT event_name, event_key, event_value, COALESCE(round(AVG(CASE WHEN day < DATE '2024-01-23' THEN n END), 2), 0) AS hist_avg_daily_events,
  CAST(SUM(CASE WHEN day < DATE '2024-01-23' THEN n ELSE 0 END) AS BIGINT) AS hist_total_events, COALESCE(round(AVG(CASE WHEN day >= DATE '2024-01-23' THEN n END), 2), 0) AS recent_avg_daily_events,
  CAST(SUM(CASE WHEN day >= DATE '2024-01-23' THEN n ELSE 0 END) AS BIGINT) AS recent_total_events FROM tot GROUP BY 1, 2, 3)
SELECT *, CASE WHEN hist_avg_daily_events > 0 THEN round((recent_avg_daily_events - hist_avg_daily_events) / hist_avg_daily_events * 100, 2) WHEN recent_avg_daily_events > 0 THEN 100.0 ELSE -100.0 END AS pct_change
FROM p WHERE hist_avg_daily_events >= 5 AND hist_total_events >= 5
""")
def _(spark, d):
    return M.event_monitor(long_events(spark, d), dt.date(2024, 1, 30), lookback=25, short=7, max_value_length=7)


@query("p13_page_view_events", "WITH " + LONG + f"""
SELECT eid AS event_id, {_PATH} AS page_path, {_GROUP.format(p=_PATH)} AS grouped_page_path, {_GROUP_NAME.format(p=_PATH)} AS grouped_page_name,
  '/hubs/search' AS referrer_path, 'Hubs Search' AS grouped_referrer_name, trim(string_split(title, '|')[1]) AS page_title FROM ev WHERE event_name = 'page_view'
""")
def _(spark, d):
    out = PG.page_view_events(long_events(spark, d), ["event_id", "event_datetime_utc", "user_id", "session_id"])
    return out.select("event_id", "page_path", "grouped_page_path", "grouped_page_name", "referrer_path", "grouped_referrer_name", "page_title")


@query("p13_page_views", _SESSIONS + """,
v AS (SELECT session_id, event_date AS date_day, title AS page_title, msec, ts FROM ev WHERE event_name = 'page_view' AND session_id IS NOT NULL),
g AS (SELECT session_id, date_day, page_title, CAST(SUM(1) AS BIGINT) AS page_view_count, MIN(ts) AS min_event_datetime_utc, MAX(msec / 10) AS engagement_time_seconds FROM v GROUP BY 1, 2, 3)
SELECT date_day AS session_date, date_day, g.session_id, page_title, page_view_count, min_event_datetime_utc, engagement_time_seconds, session_duration, suspected_fraud
FROM g LEFT JOIN (SELECT session_id, session_date AS date_day, session_duration, suspected_fraud FROM ses) s USING (session_id, date_day)
""")
def _(spark, d):
    c = F.col
    v = long_events(spark, d).filter("event_name = 'page_view' and session_id is not null")
    wide = v.groupBy("event_id", "session_id", c("event_date").alias("date_day"), "event_datetime_utc").agg(
        F.max(F.when(c("event_key") == "page_title", c("event__string_value"))).alias("page_title"), F.max("event__int_value").alias("ms"))
    rows = wide.select("session_id", "date_day", "page_title", F.lit(1).cast("long").alias("page_view_count"), c("event_datetime_utc").alias("min_event_datetime_utc"), (c("ms") / 10).alias("engagement_time_seconds"))
    return PG.page_views(rows, sessions(spark, d), ["session_duration", "suspected_fraud"])


_REPORTS = "WITH " + FLAT + """,
v AS (SELECT eid, title || (k % 4) AS page_title, CASE WHEN seq % 3 = 0 THEN replace(lower(url), 'https://www.example.com', '') || '/' WHEN seq % 3 = 1 THEN '/reports/plain' || (k % 5) ELSE '/reports/a-' || (k % 2) || '/' END AS page_path FROM flat),
r AS (SELECT * FROM v WHERE page_path LIKE '/reports/%'),
n AS (SELECT *, COUNT(*) OVER (PARTITION BY page_title, page_path) AS cnt, CASE WHEN page_path LIKE '%-%' THEN 1 ELSE 0 END AS hy FROM r)
SELECT eid, page_title, first_value(rtrim(page_path, '/')) OVER (PARTITION BY page_title ORDER BY hy DESC, cnt DESC, rtrim(page_path, '/')) AS page_path FROM n
"""


@query("p13_report_pages", _REPORTS)
def _(spark, d):
    c, m = F.col, F.col("seq") % 3
    path = (
        F.when(m == 0, F.concat(F.replace(F.lower("url"), F.lit("https://www.example.com"), F.lit("")), F.lit("/")))
        .when(m == 1, F.concat(F.lit("/reports/plain"), (c("k") % 5).cast("string"))).otherwise(F.concat(F.lit("/reports/a-"), (c("k") % 2).cast("string"), F.lit("/"))))
    views = flat_events(spark, d).select("eid", F.concat("title", (c("k") % 4).cast("string")).alias("page_title"), path.alias("page_path"))
    return PG.report_pages(views)


@query("p14_engagement", "WITH " + LONG + """
SELECT eid AS event_id, user_id, session_id, event_date AS date_day, url AS page_location, title AS page_title, round(msec / 1000, 4) AS engagement_time_seconds FROM ev WHERE session_id IS NOT NULL
""")
def _(spark, d):
    return PG.engagement(long_events(spark, d)).drop("user_pseudo_id").withColumn("engagement_time_seconds", F.round("engagement_time_seconds", 4))


def engagement_gap(spark, d, only_profiles: bool):
    """Days on which engagement seconds of profile events differ from those of the events they are taken from."""
    c = F.col
    pv = pivoted(spark, d, False)
    companies = table(spark, d, "customer").select(
        c("c_custkey").alias("company_id"), F.concat(F.lit("acme-"), (c("c_custkey") % 7).cast("string")).alias("company_url_name"), c("c_nationkey").alias("updated_date"))
    prof = PG.profile_interactions(pv, companies, split=False)
    total = F.sum("engagement_time_seconds")
    cond = c("company_url_name").isNotNull() if only_profiles else None
    return reconcile(prof.withColumn("day", c("date_day")), pv.withColumn("day", c("event_date")), ["day"], total, total, 0.1, cond_b=cond)


@query("l6_reconcile_engagement", PIVOTED + """,
a AS (SELECT event_date AS day, SUM(secs) AS va FROM q5 WHERE company_url_name IS NOT NULL GROUP BY 1), b AS (SELECT event_date AS day, SUM(secs) AS vb FROM q5 GROUP BY 1)
SELECT day, round(va, 3) AS value_a, round(vb, 3) AS value_b FROM a FULL JOIN b USING (day) WHERE abs(va - vb) / vb * 100 > 0.1
""")
def _(spark, d):
    out = engagement_gap(spark, d, only_profiles=False)
    return out.select("day", F.round("value_a", 3).alias("value_a"), F.round("value_b", 3).alias("value_b"))


_BOTH = PIVOTED + _SESSIONS[len("WITH " + LONG):]


@query("l1_not_null_sessions", _SESSIONS + "SELECT session_id FROM ses WHERE geo__country IS NULL")
def _(spark, d):
    return not_null(sessions(spark, d), "geo__country").select("session_id")


@query("l2_unique_sessions", _SESSIONS + "SELECT session_id, COUNT(*) AS n_records FROM ses GROUP BY ALL HAVING COUNT(*) > 1")
def _(spark, d):
    return unique(sessions(spark, d), ["session_id"])


@query("l2_unique_events", PIVOTED + "SELECT eid AS event_id, COUNT(*) AS n_records FROM q5 GROUP BY ALL HAVING COUNT(*) > 1")
def _(spark, d):
    return unique(pivoted(spark, d), ["event_id"])


@query("l2_unique_page_ranks", PIVOTED + "SELECT session_id, page_view_rank, COUNT(*) AS n_records FROM q5 WHERE session_id IS NOT NULL AND page_view_rank IS NOT NULL GROUP BY ALL HAVING COUNT(*) > 1")
def _(spark, d):
    """Page views span events, so ranks repeat: known violations."""
    return unique(pivoted(spark, d).select("session_id", F.col("page_view_rank").cast("long").alias("page_view_rank")), ["session_id", "page_view_rank"])


@query("l3_event_sessions", _BOTH + "SELECT eid AS event_id FROM q5 WHERE session_id IS NOT NULL AND session_id NOT IN (SELECT session_id FROM ses WHERE session_id IS NOT NULL)")
def _(spark, d):
    return relationships(pivoted(spark, d), "session_id", sessions(spark, d), "session_id").select("event_id")


@query("l5_not_accepted_groups", PIVOTED + "SELECT eid AS event_id FROM q5 WHERE grouped_page_name IN ('Homepage', 'Reports')")
def _(spark, d):
    return not_accepted(pivoted(spark, d), "grouped_page_name", ["Homepage", "Reports"]).select("event_id")
