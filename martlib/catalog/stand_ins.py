"""Product-analytics inputs derived from the driver's ``events`` table, each with the SQL that derives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlib.catalog.registry import spread_table

NAMES = {"signup": "session_start", "view": "page_view", "click": "profile_interactions", "purchase": "add_to_collection"}
URLS = [
    "https://www.example.com/company_page/acme-{}?utm_source=Google&utm_medium=cpc&utm_campaign=c{}",
    "https://www.example.com/startups/search?tab=News-Room&page={}&alltags=a%7Cb{}",
    "https://www.example.com//Investor_Page/fund-{}?section=team_{}",
    "https://www.example.com/reports/q-{}/part{}",
    "https://www.example.com/investors/search?sort=name{}&status=open{}",
    "https://www.example.com/?x={}&y={}",
]


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _sql_list(values):
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def _url_sql():
    parts = []
    for i, u in enumerate(URLS):
        a, b, c = u.split("{}")
        parts.append(f"WHEN {i} THEN '{a}' || (k % 7) || '{b}' || (k % 3) || '{c}'")
    return "CASE k % 6 " + " ".join(parts) + " END"


def _url():
    k = F.col("k")
    out = None
    for i, u in enumerate(URLS):
        a, b, c = u.split("{}")
        text = F.concat(F.lit(a), (k % 7).cast("string"), F.lit(b), (k % 3).cast("string"), F.lit(c))
        out = F.when(k % 6 == i, text) if out is None else out.when(k % 6 == i, text)
    return out


SOURCES = ["google", "(direct)", None, "News-Site"]
MEDIA = ["organic", "(none)", None, "email"]
COUNTRIES = ["Israel", "United States", "", "France"]
DEVICES = ["mobile", "desktop", "tablet"]
KINDS = ["Company Tabs", "Team", "Moltinational Tabs"]
SECTIONS = ["Follow", "news", "Description Cleantech More", None, "team"]

# One row per event with the fields of a tracked event.
FLAT = f"""
flat0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
flat AS (SELECT event_id AS seq, 'e' || event_id AS eid, ts, epoch_us(ts) AS event_timestamp, strftime(ts, '%Y%m%d') AS ymd, CAST(ts AS DATE) AS event_date, k, value,
  CASE event_type WHEN 'signup' THEN 'session_start' WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'profile_interactions' WHEN 'purchase' THEN 'add_to_collection' ELSE 'scroll' END AS event_name,
  CASE WHEN event_id % 5 < 2 THEN 'u' || user_id END AS known_user,
  CASE WHEN event_id % 11 <> 0 THEN 'p' || (user_id % 100) || '.' END AS pseudo,
  CASE WHEN event_id % 11 <> 0 THEN dayofyear(ts) * 10 + hour(ts) // 8 END AS ga_session,
  {_sql_list(COUNTRIES)}[user_id % 4 + 1] AS country, {_sql_list(DEVICES)}[user_id % 3 + 1] AS category,
  {_sql_list(SOURCES)}[event_id % 4 + 1] AS src, {_sql_list(MEDIA)}[(event_id // 4) % 4 + 1] AS med,
  {_sql_list(KINDS)}[k % 3 + 1] AS entity_type, {_sql_list(SECTIONS)}[k % 5 + 1] AS section,
  CAST(floor(value * 10) AS BIGINT) AS msec, event_id % 2 AS engaged, {_url_sql()} AS url, 'Page ' || (k % 6) || ' | Site' AS title, user_id AS person FROM flat0)
"""


def flat_events(spark, d):
    ts, e = F.col("ts"), F.col("event_id")
    df = spread_table(spark, d, "events", ["event_id", "ts"]).withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    name = F.coalesce(*[F.when(F.col("event_type") == t, n) for t, n in NAMES.items()], F.lit("scroll"))
    tracked = e % 11 != 0
    u = F.col("user_id")
    return df.select(
        e.alias("seq"), F.concat(F.lit("e"), e.cast("string")).alias("eid"), "ts", F.unix_micros(ts.cast("timestamp")).alias("event_timestamp"),
        F.date_format(ts, "yyyyMMdd").alias("ymd"), ts.cast("date").alias("event_date"), "k", "value", name.alias("event_name"),
        F.when(e % 5 < 2, F.concat(F.lit("u"), u.cast("string"))).alias("known_user"),
        F.when(tracked, F.concat(F.lit("p"), (u % 100).cast("string"), F.lit("."))).alias("pseudo"),
        F.when(tracked, F.dayofyear(ts) * 10 + F.floor(F.hour(ts) / 8)).cast("long").alias("ga_session"),
        _pick(COUNTRIES, u % 4).alias("country"), _pick(DEVICES, u % 3).alias("category"), _pick(SOURCES, e % 4).alias("src"),
        _pick(MEDIA, F.floor(e / 4) % 4).alias("med"), _pick(KINDS, F.col("k") % 3).alias("entity_type"), _pick(SECTIONS, F.col("k") % 5).alias("section"),
        F.floor(F.col("value") * 10).cast("long").alias("msec"), (e % 2).alias("engaged"), _url().alias("url"),
        F.concat(F.lit("Page "), (F.col("k") % 6).cast("string"), F.lit(" | Site")).alias("title"), u.alias("person"),
    )


def nested_events(spark, d):
    """Raw nested events with parameter arrays."""
    c = F.col
    null = lambda t: F.lit(None).cast(t)

    def p(key, s=None, i=None):
        v = F.struct(
            (null("string") if s is None else s).alias("string_value"), (null("long") if i is None else i).alias("int_value"),
            null("double").alias("float_value"), null("double").alias("double_value"))
        return F.struct(F.lit(key).alias("key"), v.alias("value"))

    params = F.array(
        p("ga_session_id", i=c("ga_session")), p("session_engaged", i=c("engaged")), p("engagement_time_msec", i=c("msec")),
        p("page_location", s=c("url")), p("source", s=c("src")), p("medium", s=c("med")),
    )
    web = F.struct(F.lit("Firefox").alias("browser"), F.lit("1").alias("browser_version"))
    return flat_events(spark, d).select(
        c("ymd").alias("event_date"), "event_timestamp", "event_name", params.alias("event_params"), c("known_user").alias("user_id"), c("pseudo").alias("user_pseudo_id"),
        c("seq").alias("event_bundle_sequence_id"), null("long").alias("batch_page_id"), null("long").alias("batch_ordering_id"), null("long").alias("batch_event_index"),
        F.struct(F.lit("").alias("city"), c("country").alias("country"), F.lit("x").alias("continent"), F.lit(None).cast("string").alias("region"), F.lit("y").alias("sub_continent")).alias("geo"),
        F.struct(c("category").alias("category"), F.lit("os").alias("operating_system"), F.lit("en").alias("language"), F.lit("old").alias("browser"), web.alias("web_info")).alias("device"),
        F.struct(null("string").alias("name"), F.lit("referral").alias("medium"), F.lit("partner").alias("source")).alias("traffic_source"),
        F.struct(F.lit("manual").alias("manual_source"), null("string").alias("manual_medium"), F.lit("(none)").alias("manual_campaign_name")).alias("collected_traffic_source"),
        F.struct(F.lit("Yes").alias("analytics_storage")).alias("privacy_info"), F.lit("WEB").alias("platform"),
    )


# Long rows: one per event and key, sessions cut by device and day.
LONG = FLAT + """,
ev AS (SELECT *, CASE WHEN seq % 5 = 4 THEN '_h' || person ELSE 'u' || (person % 60) END AS user_id, 'd' || (person % 100) AS user_pseudo_id,
  CASE WHEN seq % 13 <> 0 THEN 's' || (person % 100) || '_' || dayofyear(ts) END AS session_id, seq % 7 AS batch_sort_key FROM flat),
long AS (SELECT * FROM (SELECT *, unnest(['page_location', 'page_title', 'page_referrer', 'engagement_time_msec', 'action', 'section', 'entity_type', 'type']) AS event_key FROM ev)),
lv AS (SELECT *, CASE event_key WHEN 'page_location' THEN url WHEN 'page_title' THEN title WHEN 'page_referrer' THEN 'https://www.example.com/hubs/search'
  WHEN 'action' THEN CASE WHEN k % 4 = 0 THEN 'Sign Up' ELSE 'act' || (k % 4) END WHEN 'section' THEN section WHEN 'entity_type' THEN entity_type WHEN 'type' THEN 't' || (k % 2) END AS sval,
  CASE WHEN event_key = 'engagement_time_msec' THEN msec END AS ival FROM long)
"""


def long_events(spark, d, dims=True):
    c = F.col
    e = c("seq")
    df = flat_events(spark, d).withColumns({
        "user_id": F.when(e % 5 == 4, F.concat(F.lit("_h"), c("person").cast("string"))).otherwise(F.concat(F.lit("u"), (c("person") % 60).cast("string"))),
        "user_pseudo_id": F.concat(F.lit("d"), (c("person") % 100).cast("string")),
        "session_id": F.when(e % 13 != 0, F.concat(F.lit("s"), (c("person") % 100).cast("string"), F.lit("_"), F.dayofyear("ts").cast("string"))),
    })

    def p(key, s=None, i=None):
        return F.struct(
            F.lit(key).alias("event_key"), (F.lit(None).cast("string") if s is None else s).alias("event__string_value"),
            (F.lit(None).cast("double") if i is None else i.cast("double")).alias("event__int_value"), F.lit(None).cast("double").alias("event__double_value"))

    action = F.when(c("k") % 4 == 0, "Sign Up").otherwise(F.concat(F.lit("act"), (c("k") % 4).cast("string")))
    rows = F.array(
        p("page_location", c("url")), p("page_title", c("title")), p("page_referrer", F.lit("https://www.example.com/hubs/search")), p("engagement_time_msec", i=c("msec")),
        p("action", action), p("section", c("section")), p("entity_type", c("entity_type")), p("type", F.concat(F.lit("t"), (c("k") % 2).cast("string"))),
    )
    return df.select(
        c("eid").alias("event_id"), "event_name", "event_date", c("ts").alias("event_datetime_utc"), "user_id", "user_pseudo_id", "session_id",
        c("event_date").alias("session_date"), (e % 7).alias("batch_sort_key"), F.nullif("country", F.lit("")).alias("geo__country"), c("category").alias("device__category"),
        c("src").alias("marketing_source"), c("med").alias("marketing_medium"), F.inline(rows),
    )
