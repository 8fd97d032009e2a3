"""User, search, signup, connection and list plans on stand-in inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlib.catalog.product import USERS_SQL, load_days, user_records
from martlib.catalog.registry import query, table
from martlib.catalog.scalar import _lit_sql
from martlib.catalog.stand_ins import FLAT, flat_events
from martlib.plans import funnels as FN
from martlib.plans import lists as L
from martlib.plans import search as SR
from martlib.plans import users as U

_RANGE = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
STEPS = ["name", "primary usage", "business email", "complete skip", "complete submit", "email verification sent"]


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _sql_list(values):
    return "[" + ", ".join(_lit_sql(v) for v in values) + "]"


# --- signups and users -------------------------------------------------------
SIGNUP_FLAT = FLAT + f""",
sf AS (SELECT eid, ts, k, person, known_user AS user_id, 'd' || (person % 100) AS user_pseudo_id, 's' || (person % 100) || '_' || dayofyear(ts) AS session_id,
  CASE WHEN k % 5 = 0 THEN 'sign_up' ELSE 'profile_data' END AS event_name, url AS page_location, title AS page_title, ['web', 'app'][person % 2 + 1] AS platform,
  ['new', 'invited', NULL][k % 3 + 1] AS kind, {_sql_list(STEPS)}[k % 6 + 1] AS step, 'o' || (k % 2) AS origin, NULLIF(country, '') AS geo__country, src AS marketing_source, med AS marketing_medium FROM flat)
"""


def signup_long(spark, d):
    c = F.col
    s = lambda key, v: F.struct(F.lit(key).alias("event_key"), v.alias("event__string_value"))
    name = F.when(c("k") % 5 == 0, "sign_up").otherwise("profile_data")
    rows = F.array(
        s("page_location", c("url")), s("page_title", c("title")), s("platform", _pick(["web", "app"], c("person") % 2)), s("type", _pick(["new", "invited", None], c("k") % 3)),
        s("step", _pick(STEPS, c("k") % 6)), s("origin", F.concat(F.lit("o"), (c("k") % 2).cast("string"))), s("action", F.when(c("k") % 5 == 0, "Sign Up").otherwise("x")))
    return flat_events(spark, d).select(
        c("eid").alias("event_id"), name.alias("event_name"), c("ts").alias("event_datetime_utc"), "event_date", c("known_user").alias("user_id"),
        F.concat(F.lit("d"), (c("person") % 100).cast("string")).alias("user_pseudo_id"), F.concat(F.lit("s"), (c("person") % 100).cast("string"), F.lit("_"), F.dayofyear("ts").cast("string")).alias("session_id"),
        F.lit(False).alias("is_user_id_generated"), F.lit(False).alias("is_user_pseudo_id_generated"), F.nullif("country", F.lit("")).alias("geo__country"),
        c("src").alias("marketing_source"), c("med").alias("marketing_medium"), F.inline(rows))


_SIGNUPS = "WITH " + SIGNUP_FLAT + USERS_SQL + f""",
ex AS (SELECT *, CASE WHEN event_name = 'sign_up' THEN 'started' ELSE step END AS signup_step FROM sf),
kn AS (SELECT user_pseudo_id, arg_min(user_id, signup_start_datetime) FILTER (WHERE user_id <> 'empty_user_id') AS ku FROM users GROUP BY 1),
wu AS (SELECT ex.* REPLACE (COALESCE(user_id, ku) AS user_id) FROM ex LEFT JOIN kn USING (user_pseudo_id)),
ty AS (SELECT *, COALESCE(first_value(kind IGNORE NULLS) OVER (PARTITION BY user_id, platform, date_trunc('hour', ts) ORDER BY ts DESC {_RANGE}), 'new') AS signup_type FROM wu),
dd AS (SELECT * FROM ty QUALIFY row_number() OVER (PARTITION BY user_id, platform, signup_type, signup_step, date_trunc('minute', ts) ORDER BY ts, eid) = 1),
rk AS (SELECT *, CASE WHEN signup_step = 'started' THEN dense_rank() OVER (PARTITION BY user_id, platform, signup_step = 'started' ORDER BY ts) END AS rnk FROM dd),
att AS (SELECT *, CAST(COALESCE(CASE WHEN signup_step = 'email verification sent' THEN last_value(rnk IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts DESC {_RANGE})
  ELSE last_value(rnk IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts {_RANGE}) END, 1) AS INTEGER) AS signup_attempt FROM rk)
"""


def _signup_events(spark, d, split):
    return FN.signup_events(signup_long(spark, d), user_records(spark, d), split=split)


@query("p10_signup_events", _SIGNUPS + "SELECT eid AS event_id, user_id, signup_type, signup_step, signup_attempt FROM att")
def _(spark, d):
    return _signup_events(spark, d, True).select("event_id", "user_id", "signup_type", "signup_step", "signup_attempt")


@query("p10_signup_events_split", _SIGNUPS + "SELECT eid AS event_id, user_id, signup_type, signup_step, signup_attempt FROM att")
def _(spark, d):
    return _signup_events(spark, d, True).select("event_id", "user_id", "signup_type", "signup_step", "signup_attempt")


_ATTEMPTS = _SIGNUPS + """,
mm AS (SELECT *, MIN(ts) OVER (PARTITION BY user_id, session_id, platform, signup_type) AS mn FROM att),
pv AS (SELECT user_id, platform AS signup_platform, signup_type, signup_attempt, MIN(mn) AS signup_start_datetime, CAST(MIN(mn) AS DATE) AS signup_start_date, MAX(session_id) AS max_session_id,
  least(MIN(ts) FILTER (WHERE signup_step = 'complete submit'), MIN(ts) FILTER (WHERE signup_step = 'complete skip')) AS signup_complete_datetime,
  MIN(ts) FILTER (WHERE signup_step = 'started') AS signup_step__started__datetime_utc, MIN(ts) FILTER (WHERE signup_step = 'name') AS signup_step__name__datetime_utc,
  MIN(ts) FILTER (WHERE signup_step = 'email verification sent') AS signup_step__email_verification_sent__datetime_utc FROM mm GROUP BY ALL),
pvr AS (SELECT md5(concat_ws('-', COALESCE(user_id, '_null_'), signup_platform, signup_type, CAST(signup_attempt AS VARCHAR))) AS record_id, * FROM pv)
"""
_ATT_COLS = ["record_id", "user_id", "signup_platform", "signup_type", "signup_attempt", "signup_start_datetime", "signup_start_date", "max_session_id", "signup_complete_datetime",
             "signup_step__started__datetime_utc", "signup_step__name__datetime_utc", "signup_step__email_verification_sent__datetime_utc"]


@query("p10_signup_funnel", _ATTEMPTS + "SELECT * FROM pvr")
def _(spark, d):
    return FN.signup_funnel(signup_long(spark, d), user_records(spark, d)).select(*_ATT_COLS)


@query("p10_signups", _ATTEMPTS + """,
ses AS (SELECT DISTINCT user_id, session_id, 'seg' || (person % 3) AS user_type, MIN(event_date) OVER (PARTITION BY user_id, session_id) AS user_signup_date FROM (SELECT sf.*, CAST(ts AS DATE) AS event_date FROM sf) WHERE user_id IS NOT NULL),
la AS (SELECT * FROM pvr WHERE left(user_id, 1) <> '_' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY signup_attempt DESC, record_id) = 1),
bs AS (SELECT * FROM ses QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY user_signup_date DESC, session_id) = 1),
ut AS (SELECT 'u' || c_custkey AS user_id, c_mktsegment AS user_type FROM customer),
pe AS (SELECT COALESCE(bs.user_id, ut.user_id) AS user_id, bs.session_id, CASE WHEN bs.user_id IS NOT NULL THEN bs.user_type ELSE ut.user_type END AS user_type FROM bs FULL JOIN ut ON bs.user_id = ut.user_id)
SELECT COALESCE(la.record_id, md5(COALESCE(pe.user_id, '_null_'))) AS record_id, COALESCE(la.user_id, pe.user_id) AS user_id, COALESCE(la.max_session_id, pe.session_id) AS session_id, la.signup_attempt,
  CASE WHEN s.user_id IS NOT NULL THEN s.user_type ELSE pe.user_type END AS user_type FROM la LEFT JOIN ses s ON s.user_id = la.user_id AND s.session_id = la.max_session_id FULL JOIN pe ON pe.user_id = la.user_id
""")
def _(spark, d):
    c = F.col
    attempts = FN.signup_funnel(signup_long(spark, d), user_records(spark, d))
    ses = flat_events(spark, d).filter("known_user is not null").groupBy(
        c("known_user").alias("user_id"), F.concat(F.lit("s"), (c("person") % 100).cast("string"), F.lit("_"), F.dayofyear("ts").cast("string")).alias("session_id"),
        F.concat(F.lit("seg"), (c("person") % 3).cast("string")).alias("user_type")).agg(F.min("event_date").alias("user_signup_date"))
    none = F.lit(None).cast("timestamp_ntz")
    ses = ses.withColumns({"user_signup_start_datetime": none, "user_signup_complete_datetime": none})
    people = table(spark, d, "customer").select(F.concat(F.lit("u"), c("c_custkey").cast("string")).alias("user_id"), c("c_mktsegment").alias("user_type"))
    return FN.signups(attempts, ses, people, ["user_type"]).select("record_id", "user_id", "session_id", "signup_attempt", "user_type")


_CATS = ["Hub", "investment firm", " Other ", "", "Startup", "odd", None]
_USAGE = ["x search-investors", "job", "collaborate", "nothing", None]
_TYPES = ["Media", "VC", "Accelerator", "Odd"]
_USERS = "WITH " + SIGNUP_FLAT + f""",
tr AS (SELECT COALESCE(user_id, 'x') AS user_id, user_pseudo_id, MAX(ts) FILTER (WHERE event_name = 'sign_up') AS signup_start_datetime, arg_min(platform, ts) FILTER (WHERE event_name = 'profile_data') AS signup_platform,
  COALESCE(bool_or(step LIKE '%complete%') FILTER (WHERE event_name = 'profile_data'), FALSE) AS is_signup_complete, MAX(ts) FILTER (WHERE event_name = 'profile_data' AND step LIKE '%complete%') AS signup_complete_datetime,
  arg_max(geo__country, ts) FILTER (WHERE geo__country IS NOT NULL) AS geo__country, arg_min(marketing_source, ts) FILTER (WHERE marketing_source IS NOT NULL) AS marketing_source,
  arg_min(marketing_medium, ts) FILTER (WHERE marketing_medium IS NOT NULL) AS marketing_medium FROM sf GROUP BY 1, 2),
crm AS (SELECT 'u' || c_custkey AS user_id, DATE '2023-01-01' + CAST(c_custkey % 100 AS INTEGER) AS signup, c_custkey % 2 = 0 AS reg, c_custkey % 4 = 0 AS conf, {_sql_list(_CATS)}[c_custkey % 7 + 1] AS cat,
  {_sql_list(_USAGE)}[c_custkey % 5 + 1] AS usage, CASE WHEN c_custkey % 11 = 0 THEN 'Multinational' WHEN c_custkey % 6 = 0 THEN 'Investor' END AS company_type, c_custkey % 6 = 0 OR c_custkey % 11 = 0 AS member,
  CASE WHEN c_custkey % 8 < 4 THEN {_sql_list(_TYPES)}[c_custkey % 8 + 1] END AS analysis FROM customer),
m AS (SELECT COALESCE(crm.user_id, tr.user_id) AS user_id, COALESCE(user_pseudo_id, 'empty_user_pseudo_id') AS user_pseudo_id, COALESCE(reg, FALSE) AS is_user_registered, COALESCE(conf, FALSE) AS is_user_confirmed,
  COALESCE(signup, CAST(signup_complete_datetime AS DATE)) AS user_signup_date, signup_start_datetime, signup_platform, is_signup_complete, geo__country, marketing_source, COALESCE(member, FALSE) AS is_member,
  CASE WHEN company_type IS NOT NULL THEN CASE company_type WHEN 'Multinational' THEN 'Corporate' ELSE company_type END WHEN analysis = 'Media' THEN 'Media' WHEN analysis = 'VC' THEN 'Investor' WHEN analysis = 'Accelerator' THEN 'Innovation Hub'
    WHEN cat IN ('Hub') THEN 'Innovation Hub' WHEN cat = 'investment firm' THEN 'Investor' WHEN cat = 'Startup' THEN 'Startup' WHEN usage LIKE '%search-investors%' THEN 'Startup' WHEN usage LIKE '%job%' THEN 'Job Seeker'
    WHEN usage LIKE '%collaborate%' THEN CASE WHEN CAST('0x' || left(md5(md5(COALESCE(crm.user_id, tr.user_id) || '-' || COALESCE(user_pseudo_id, 'empty_user_pseudo_id')) || '-0'), 8) AS BIGINT) / 4294967296.0 < 0.4 THEN 'Service Provider' WHEN CAST('0x' || left(md5(md5(COALESCE(crm.user_id, tr.user_id) || '-' || COALESCE(user_pseudo_id, 'empty_user_pseudo_id')) || '-0'), 8) AS BIGINT) / 4294967296.0 < 0.7 THEN 'Corporate' ELSE 'Startup' END ELSE 'Other' END AS derived_user_type FROM crm FULL JOIN tr ON crm.user_id = tr.user_id)
SELECT * FROM m
"""


def _users(spark, d):
    c, k = F.col, F.col("c_custkey")
    long = signup_long(spark, d).withColumn("user_id", F.coalesce("user_id", F.lit("x")))
    cust = table(spark, d, "customer")
    uid = F.concat(F.lit("u"), k.cast("string"))
    raw = cust.select(
        uid.alias("user_id"), F.date_add(F.lit("2023-01-01").cast("date"), (k % 100).cast("int")).alias("signup_date"), _pick(_CATS, k % 7).alias("category_raw"), _pick(_USAGE, k % 5).alias("primary_usage"),
        (k % 2 == 0).cast("int").alias("email_validated"), F.lit("secret").alias("password"), F.lit("a@example.org").alias("email"), F.when(k % 4 == 0, 1).otherwise(0).alias("confirmed"),
        *[F.lit(None).cast("date").alias(n) for n in ("last_session_start", "last_session_end", "last_home_page_view_date", "updated_date")])
    member = cust.filter((k % 6 == 0) | (k % 11 == 0)).select(uid.alias("user_id"), F.when(k % 11 == 0, "co1").otherwise("co2").alias("company_id"), F.lit("2023-01-01").cast("date").alias("created_date"))
    companies = cust.select(F.when(c("c_mktsegment") == "BUILDING", "co1").otherwise("co2").alias("company_id")).distinct().select(
        "company_id", F.concat(F.lit("Name "), "company_id").alias("company_name"), F.when(c("company_id") == "co1", "Multinational").otherwise("Investor").alias("company_type"))
    found = cust.filter(k % 8 < 4).select(uid.alias("user_id"), k.alias("entity_analysis_id"))
    analysis = cust.select(k.alias("id"), c("c_name").alias("name"), _pick(_TYPES, k % 4).alias("type"), c("c_mktsegment").alias("sector"), F.lit("2023-01-01").cast("date").alias("created_date"))
    out = U.build_users(
        long, U.clean_users(raw), member, companies, U.latest_analysis(analysis, found), dimensions=["geo__country"], marketing=["marketing_source", "marketing_medium"])
    return out.select(
        "user_id", "user_pseudo_id", "is_user_registered", "is_user_confirmed", "user_signup_date", "signup_start_datetime", "signup_platform", "is_signup_complete", "geo__country", "marketing_source", "is_member", "derived_user_type")


@query("p5_build_users", _USERS)
def _(spark, d):
    return _users(spark, d)


@query("p5_build_users_split", _USERS)
def _(spark, d):
    return _users(spark, d)


# --- connections -------------------------------------------------------------
_CONNECT = "WITH " + FLAT + """,
inv AS (SELECT 'i' || seq AS invite_id, 'ch' || seq AS channel_id, 'u' || (person % 20) AS inviting_user_id, 'u' || (person % 31) AS invited_user_id, person AS invited_member_id, ts AS invitation_datetime,
  ['accepted', 'withdrawn', 'pending'][k % 3 + 1] AS status, ts + INTERVAL (k) HOUR AS status_datetime, CASE WHEN k % 4 <> 0 THEN k % 4 END AS reminders, seq FROM flat WHERE event_name = 'add_to_collection'),
ms AS (SELECT conv_id || '-' || turn AS message_id, 'ch' || conv_id AS channel_id, 'u' || (turn % 20) AS author, TIMESTAMP '2024-01-05' + INTERVAL (conv_id) MINUTE + INTERVAL (turn) SECOND AS message_datetime FROM conversations),
stt AS (SELECT channel_id, GREATEST(COUNT(DISTINCT CASE WHEN author = inviting_user_id THEN message_id END) - 1, 0) AS inviting_user_messages, COUNT(DISTINCT CASE WHEN author = invited_user_id THEN message_id END) AS invited_user_messages,
  MIN(message_datetime) AS first_message_datetime FROM inv LEFT JOIN ms USING (channel_id) GROUP BY 1),
iv AS (SELECT inv.*, 'co' || c_nationkey AS invited_company_id, inviting_user_messages, invited_user_messages, first_message_datetime FROM inv LEFT JOIN customer ON c_custkey = invited_member_id LEFT JOIN stt USING (channel_id))
"""


def _invites(spark, d):
    c = F.col
    flat = flat_events(spark, d).filter("event_name = 'add_to_collection'")
    s = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    inv = flat.select(
        s("i", c("seq")).alias("invite_id"), s("ch", c("seq")).alias("channel_id"), s("u", c("person") % 20).alias("inviting_user_id"), s("u", c("person") % 31).alias("invited_user_id"),
        c("person").alias("invited_member_id"), c("ts").alias("invitation_datetime"), _pick(["accepted", "withdrawn", "pending"], c("k") % 3).alias("status"),
        (c("ts") + F.make_dt_interval(hours=c("k").cast("int"))).alias("status_datetime"), F.when(c("k") % 4 != 0, c("k") % 4).alias("reminders"),
        F.lit(None).cast("timestamp_ntz").alias("last_reminder_datetime"), F.lit("meet").alias("purpose"))
    base = F.lit("2024-01-05").cast("timestamp_ntz")
    chats = table(spark, d, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("message_id"), s("ch", c("conv_id")).alias("channel_id"), s("chat", c("turn") % 20).alias("user_id"),
        (base + F.make_dt_interval(mins=c("conv_id").cast("int"), secs=c("turn").cast("decimal(18,6)"))).alias("message_datetime"))
    users = table(spark, d, "customer").select(s("chat", c("c_custkey")).alias("chat_id"), s("u", c("c_custkey")).alias("user_id"))
    members = table(spark, d, "customer").select(c("c_custkey").alias("member_id"), s("co", c("c_nationkey")).alias("company_id"))
    return FN.invitation_stats(inv, chats, users, members)


@query("p11_invitation_stats", _CONNECT + "SELECT channel_id AS record_id, invited_company_id, inviting_user_messages, invited_user_messages, first_message_datetime FROM iv")
def _(spark, d):
    return _invites(spark, d).select("record_id", "invited_company_id", "inviting_user_messages", "invited_user_messages", "first_message_datetime")


@query("p11_connection_funnel", _CONNECT + """,
ck0 AS (SELECT 'c' || seq AS event_id, 'u' || (person % 20) AS user_id, 'slug' || (k % 25) AS slug, ts, CASE WHEN seq % 3 = 0 THEN 'Button Clicked' ELSE 'Opened' END AS step FROM flat WHERE event_name = 'profile_interactions'
  UNION ALL SELECT 's' || flat.seq, 'u' || (person % 20), 'slug' || c_nationkey, ts - INTERVAL 4 SECOND, 'Success' FROM flat JOIN customer ON c_custkey = person WHERE event_name = 'add_to_collection'),
fl AS (SELECT user_id, slug, arg_min(event_id, ts) AS rid, MIN(ts) FILTER (WHERE step = 'Button Clicked') AS clicked, MIN(ts) FILTER (WHERE step = 'Success') AS sent, COUNT(*) FILTER (WHERE step = 'Button Clicked') AS n FROM ck0 GROUP BY 1, 2),
l AS (SELECT iv.*, 'slug' || substr(invited_company_id, 3) AS slug FROM iv),
j AS (SELECT l.seq, fl.rid FROM l JOIN fl ON l.inviting_user_id = fl.user_id AND l.slug = fl.slug AND date_trunc('minute', invitation_datetime) = date_trunc('minute', sent) AND epoch_us(invitation_datetime) // 10000000 - epoch_us(sent) // 10000000 <= 1),
a AS (SELECT l.channel_id AS record_id, l.invite_id, l.inviting_user_id, l.invited_user_id, l.slug AS invited_company_url_name, fl.n AS clicked_connect_counter, fl.clicked AS clicked_connect_datetime, l.invitation_datetime, l.status,
  CAST(COALESCE(l.reminders, 0) AS BIGINT) AS reminders, round(CASE WHEN l.status = 'accepted' THEN date_sub('second', l.invitation_datetime, l.status_datetime) END / 86400, 2) AS time_to_accept_days FROM l LEFT JOIN j ON j.seq = l.seq LEFT JOIN fl ON fl.rid = j.rid)
SELECT a.*, n_name AS invited_company_name, x.c_mktsegment AS inviting_user_c_mktsegment FROM a LEFT JOIN nation ON 'slug' || n_nationkey = invited_company_url_name LEFT JOIN customer x ON 'u' || x.c_custkey = a.inviting_user_id
UNION ALL
SELECT fl.rid, NULL, fl.user_id, NULL, fl.slug, n, clicked, sent, NULL, 0, NULL, n_name, x.c_mktsegment FROM fl LEFT JOIN nation ON 'slug' || n_nationkey = slug LEFT JOIN customer x ON 'u' || x.c_custkey = fl.user_id WHERE fl.rid NOT IN (SELECT rid FROM j)
""")
def _(spark, d):
    c = F.col
    s = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    flat = flat_events(spark, d)
    a = flat.filter("event_name = 'profile_interactions'").select(
        s("c", c("seq")).alias("event_id"), s("u", c("person") % 20).alias("user_id"), s("slug", c("k") % 25).alias("company_url_name"), c("ts").alias("event_datetime_utc"),
        F.when(c("seq") % 3 == 0, "Button Clicked").otherwise("Opened").alias("step"))
    b = flat.filter("event_name = 'add_to_collection'").join(table(spark, d, "customer"), c("c_custkey") == c("person")).select(
        s("s", c("seq")), s("u", c("person") % 20), s("slug", c("c_nationkey")), c("ts") - F.expr("interval 4 seconds"), F.lit("Success"))
    companies = table(spark, d, "nation").select(s("co", c("n_nationkey")).alias("company_id"), s("slug", c("n_nationkey")).alias("company_url_name"), c("n_name").alias("company_name"))
    users = table(spark, d, "customer").select(s("u", c("c_custkey")).alias("user_id"), "c_mktsegment")
    out = FN.connection_funnel(a.union(b), _invites(spark, d), companies, users, ["c_mktsegment"], company_fields=["company_name"])
    return out.select(
        "record_id", "invite_id", "inviting_user_id", "invited_user_id", "invited_company_url_name", "clicked_connect_counter", "clicked_connect_datetime", "invitation_datetime", "status",
        "reminders", "time_to_accept_days", "invited_company_name", "inviting_user_c_mktsegment")


# --- search ------------------------------------------------------------------
NODE = "classification-node-id-"
QUERIES = [f"alltags=a%7Cb&page=1&sectorclassification={NODE}3%7Cshort", "sort=by+name&bogus=1&page=x", "semantic=s{}&page=2", "totalraisedmin=5&anytag="]
_SEARCH = "WITH " + FLAT + f""",
se AS (SELECT eid AS event_id, ts, event_date, 's' || (person % 100) || '_' || dayofyear(ts) AS session_id, seq % 7 AS bk, k, CASE WHEN k % 9 = 0 THEN 'search_page_tabs' ELSE 'page_view' END AS event_name,
  'T' || (k % 4) AS page_title, CASE k % 5 WHEN 0 THEN NULL WHEN 1 THEN 'https://other.org/x' ELSE 'https://www.example.com/abc' END AS page_referrer, CASE WHEN k % 5 = 2 THEN '/' ELSE '/abc' END AS grouped_referrer_path,
  CASE k % 6 WHEN 4 THEN '/company_page' WHEN 5 THEN '/' WHEN 3 THEN '/investors/search' ELSE '/startups/search' END AS grouped_page_path,
  replace({_sql_list(QUERIES)}[seq % 4 + 1], '{{}}', CAST(k % 10 AS VARCHAR)) AS page_query, CASE WHEN k % 6 = 4 THEN 'acme-' || (k % 7) END AS company_url_name,
  ['Overview', 'News_Room', NULL][k % 3 + 1] AS tab0, 'In_The_news' AS element_clicked FROM flat),
s0 AS (SELECT *, 'https://www.example.com' || grouped_page_path || '?' || page_query AS page_location, grouped_page_path LIKE '%/search' AS is_search, page_query LIKE 'semantic=%' AS is_semantic,
  NULLIF(regexp_extract(page_query, 'semantic=([^?&=]+)', 1), '') AS sem_id, CASE WHEN event_name = 'search_page_tabs' THEN 'In The News' WHEN tab0 = 'News_Room' THEN 'News Room' END AS tab FROM se),
s1 AS (SELECT *, lag(page_title) OVER w AS pt, lag(page_location) OVER w AS pl FROM s0 WINDOW w AS (PARTITION BY session_id ORDER BY ts, bk, event_id)),
s2 AS (SELECT * FROM s1 WHERE pl IS NULL OR page_location <> pl OR page_title <> pt),
s3 AS (SELECT *, lag(is_search) OVER w AS prev_search, date_diff('second', lag(ts) OVER w, ts) AS since_event, CASE WHEN is_search THEN date_diff('second', lag(ts) OVER v, ts) END AS since_search,
  CASE WHEN is_search THEN lag(grouped_page_path) OVER v END AS lpath, CASE WHEN is_search THEN lag(page_title) OVER v END AS ltitle, CASE WHEN is_search THEN lag(is_semantic) OVER v END AS lsem, CASE WHEN is_search THEN lag(sem_id) OVER v END AS lid
  FROM s2 WINDOW w AS (PARTITION BY session_id ORDER BY ts, bk, event_id), v AS (PARTITION BY session_id, is_search ORDER BY ts, bk, event_id)),
s4 AS (SELECT *, CASE WHEN is_semantic THEN last_value(lid IGNORE NULLS) OVER (PARTITION BY session_id, is_semantic ORDER BY ts, bk, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS known FROM s3),
s5 AS (SELECT *, COUNT(*) FILTER (WHERE is_search AND (is_semantic <> lsem OR sem_id <> known OR (NOT is_semantic AND (since_search IS NULL OR grouped_page_path <> lpath OR (page_title <> ltitle AND page_location <> pl)
  OR since_search >= 180 OR (NOT prev_search AND since_event >= 180))))) OVER (PARTITION BY session_id ORDER BY ts, bk RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS search_rank FROM s4),
s6 AS (SELECT *, session_id || '_' || event_date || '_' || search_rank AS search_id FROM s5)
"""


def _search_events(spark, d):
    c = F.col
    k = c("k")
    s = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    path = F.when(k % 6 == 4, "/company_page").when(k % 6 == 5, "/").when(k % 6 == 3, "/investors/search").otherwise("/startups/search")
    df = flat_events(spark, d).select(
        c("eid").alias("event_id"), c("ts").alias("event_datetime_utc"), "event_date", c("event_date").alias("session_date"),
        F.concat(s("s", c("person") % 100), F.lit("_"), F.dayofyear("ts").cast("string")).alias("session_id"), (c("seq") % 7).alias("batch_sort_key"), s("d", c("person") % 100).alias("user_pseudo_id"),
        F.when(k % 9 == 0, "search_page_tabs").otherwise("page_view").alias("event_name"), s("T", k % 4).alias("page_title"),
        F.when(k % 5 == 1, "https://other.org/x").when(k % 5 != 0, "https://www.example.com/abc").alias("page_referrer"), F.when(k % 5 == 2, "/").otherwise("/abc").alias("grouped_referrer_path"),
        path.alias("grouped_page_path"), path.alias("page_path"), F.replace(_pick(QUERIES, c("seq") % 4), F.lit("{}"), (k % 10).cast("string")).alias("page_query"),
        F.when(k % 6 == 4, s("acme-", k % 7)).alias("company_url_name"), _pick(["Overview", "News_Room", None], k % 3).alias("tab"), F.lit("In_The_news").alias("element_clicked"))
    return df.withColumn("page_location", F.concat(F.lit("https://www.example.com"), "grouped_page_path", F.lit("?"), "page_query"))


def _ranked(spark, d, split):
    return SR.rank_searches(SR._search_columns(_search_events(spark, d), "example.com"), 180, split)


@query("p8_rank_searches", _SEARCH + "SELECT event_id, search_id FROM s6")
def _(spark, d):
    return _ranked(spark, d, True).select("event_id", "search_id")


@query("p8_rank_searches_split", _SEARCH + "SELECT event_id, search_id FROM s6")
def _(spark, d):
    return _ranked(spark, d, True).select("event_id", "search_id")


_SEARCH_ROWS = _SEARCH + f""",
sem AS (SELECT 's' || n_nationkey AS sid, n_name AS user_input FROM nation),
fp AS (SELECT event_id, string_split(qp, '=')[1] AS fname, trim(replace(replace(replace(replace(replace(string_split(qp, '=')[2], '%2B', '|'), '%7C', '|'), '%20', ' '), '+', ' '), '%2C', ','), '|') AS pv
  FROM (SELECT event_id, unnest(string_split(page_query, '&')) AS qp FROM s6 WHERE NOT is_semantic AND is_search)),
fv AS (SELECT DISTINCT event_id, fname, unnest(string_split(pv, '|')) AS fvalue FROM fp WHERE fname IN ('alltags', 'page', 'sectorclassification', 'sort', 'totalraisedmin', 'anytag', 'semantic')),
un AS (SELECT s6.*, NULL AS user_input, fname, fvalue FROM s6 LEFT JOIN fv USING (event_id) WHERE NOT is_semantic
  UNION ALL SELECT s6.*, user_input, fname, CASE fname WHEN 'sector' THEN 'bio' WHEN 'sectorclassification' THEN '{NODE}7' END FROM s6 JOIN sem ON sid = sem_id CROSS JOIN (SELECT unnest(['sector', 'location', 'sectorclassification']) AS fname) WHERE sem_id IS NOT NULL),
pr AS (SELECT search_id, string_agg(company_url_name, ',' ORDER BY t, company_url_name) AS profiles_viewed, COUNT(*) AS pu, CAST(SUM(c) AS BIGINT) AS profiles_total_count FROM (SELECT search_id, company_url_name, MIN(ts) AS t, COUNT(*) AS c FROM un WHERE company_url_name IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
tb AS (SELECT search_id, string_agg(tab, ',' ORDER BY t, tab) AS tabs_clicked, CAST(SUM(c) AS BIGINT) AS tabs_total_count FROM (SELECT search_id, tab, MIN(ts) AS t, COUNT(*) AS c FROM un WHERE tab IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
sr AS (SELECT event_id, search_id, CASE fname WHEN 'alltags' THEN 'all_tags' WHEN 'sectorclassification' THEN 'sector_classification' WHEN 'totalraisedmin' THEN 'total_raised_min' WHEN 'anytag' THEN 'any_tag' ELSE fname END AS filter_name, fvalue AS filter_value,
  CASE fname WHEN 'alltags' THEN 'All Tags' WHEN 'sectorclassification' THEN 'Sector Classification' WHEN 'totalraisedmin' THEN 'Total Raised' WHEN 'anytag' THEN 'Any Tag' WHEN 'page' THEN 'Page' WHEN 'sort' THEN 'Sort' WHEN 'sector' THEN 'Sector' WHEN 'location' THEN 'Location' END AS filter,
  n.n_name AS classification_name, r.r_name AS classification_parent_name, user_input AS semantic_user_input, profiles_viewed, pu AS profiles_unique_count, profiles_total_count, tabs_clicked, tabs_total_count,
  CASE WHEN grouped_page_path LIKE '/investors%' THEN 'Investor' ELSE 'Company' END AS profile, session_id, event_date, ts, is_semantic
  FROM un LEFT JOIN nation n ON fvalue = '{NODE}' || n.n_nationkey LEFT JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN pr USING (search_id) LEFT JOIN tb USING (search_id)
  WHERE is_search AND NOT (page_referrer IS NULL OR (page_referrer LIKE '%example.com%' AND grouped_referrer_path = '/')))
"""
_SR_COLS = ["event_id", "search_id", "filter_name", "filter_value", "filter", "classification_name", "classification_parent_name", "semantic_user_input", "profiles_viewed",
            "profiles_unique_count", "profiles_total_count", "tabs_clicked", "tabs_total_count", "profile"]


def _search_plan(spark, d):
    """Events to search sessions."""
    c = F.col
    s = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    js = F.lit(f'{{"sector": "bio", "type": "q", "location": null, "sectorclassification": "{NODE}7"}}')
    semantic = nation.select(s("s", c("n_nationkey")).alias("id"), c("n_name").alias("user_input"), F.lit("ok").alias("ai_analysis"), js.alias("filters"))
    root = "classification-root-id-"
    classes = nation.select(s(NODE, c("n_nationkey")).alias("classification_id"), c("n_name").alias("classification_name"), s(root, c("n_regionkey")).alias("root_key"))
    classes = classes.union(region.select(s(root, c("r_regionkey")), "r_name", s(root, c("r_regionkey"))))
    sessions = lambda ev: ev.select("session_id", "session_date").distinct().withColumn("user_id", F.lit("_h"))
    return lambda ev: SR.search_sessions(ev, semantic, classes, sessions(ev)), sessions


def _search(spark, d):
    build, sessions = _search_plan(spark, d)
    ev = _search_events(spark, d)
    return build(ev), sessions(ev)


@query("p8_search_sessions", _SEARCH_ROWS + "SELECT " + ", ".join(_SR_COLS) + " FROM sr")
def _(spark, d):
    return _search(spark, d)[0].select(*_SR_COLS)


# Sessions of two days, dated by their first.
_TWO_DAYS = {
    "dayofyear(ts) AS session_id": "(dayofyear(ts) // 2) AS session_id",
    "session_id || '_' || event_date || '_'": "session_id || '_' || (DATE '2023-12-31' + CAST(dayofyear(ts) // 2 * 2 AS INTEGER)) || '_'",
}


def _two_days(sql):
    for one, two in _TWO_DAYS.items():
        sql = sql.replace(one, two)
    return sql


@query("p8_incremental", _two_days(_SEARCH_ROWS) + "SELECT " + ", ".join(_SR_COLS) + " FROM sr")
def _(spark, d):
    """Loads that start within a session, one of them over days loaded before, give the searches of a full load."""
    half = F.floor(F.dayofyear("event_datetime_utc") / 2).cast("int")
    ev = _search_events(spark, d).withColumns({
        "session_id": F.concat(F.substring_index("session_id", "_", 1), F.lit("_"), half.cast("string")),
        "session_date": F.date_add(F.lit("2023-12-31").cast("date"), half * 2),
    })
    return load_days(spark, ev, _search_plan(spark, d)[0], "p8-days").select(*_SR_COLS)


@query("p9_search_summary", _SEARCH_ROWS + """
SELECT search_id, profile, is_semantic AS is_semantic_search, MIN(ts) AS search_started_datetime, arg_max(profiles_viewed, ts) AS profiles_viewed, MAX(profiles_total_count) AS profiles_total_count,
  (SELECT string_agg(DISTINCT TRY_CAST(filter_value AS BIGINT)::VARCHAR, ',' ORDER BY TRY_CAST(filter_value AS BIGINT)::VARCHAR) FROM sr p WHERE p.search_id = sr.search_id AND filter_name = 'page') AS search_pages,
  string_agg(DISTINCT CASE WHEN filter_name = 'all_tags' THEN filter_value END, ',' ORDER BY CASE WHEN filter_name = 'all_tags' THEN filter_value END) AS all_tags,
  COUNT(DISTINCT CASE WHEN filter_name = 'all_tags' THEN filter_value END) AS all_tags_count, COUNT(DISTINCT CASE WHEN filter_name = 'sort' THEN filter_value END) AS sort_count,
  string_agg(DISTINCT CASE WHEN filter_name = 'sector_classification' THEN classification_name END, ',') AS sector_classification,
  string_agg(DISTINCT CASE WHEN filter_name = 'sector_classification' THEN classification_parent_name END, ',') AS sector_classification_parent
FROM sr WHERE filter_name IS NOT NULL GROUP BY search_id, profile, is_semantic, session_id, event_date, semantic_user_input, CASE WHEN is_semantic THEN (SELECT any_value(sem_id) FROM s6 WHERE s6.event_id = sr.event_id) END
""")
def _(spark, d):
    rows, ses = _search(spark, d)
    out = SR.search_summary(rows, ses)
    return out.select(
        "search_id", "profile", "is_semantic_search", "search_started_datetime", "profiles_viewed", "profiles_total_count", "search_pages", "all_tags", "all_tags_count", "sort_count",
        "sector_classification", "sector_classification_parent")


# --- lists, saved searches, audiences ----------------------------------------
_EV = ["event_name", "page_location", "page_referrer", "grouped_page_path", "page_query", "type", "step", "section", "element_clicked", "action", "label"]
_W = "https://www.example.com/user/Watchlist/L1?x=1"
# inputs in the order of _EV, then list id, category, action, details
LIST_SAMPLES = [
    ("duplicate_smartlist", _W, "https://www.example.com/", "/user/watchlist", "utm_source=link_copied", None, "success", None, "E", None, None, "L1", "duplicate", "saved from homepage list", "E"),
    ("duplicate_smartlist", "https://www.example.com/smartlist/S2/", "https://o.org/", "/x", "a=1", None, "success", None, None, None, None, "S2", "duplicate", "saved from public list", None),
    ("duplicate_smartlist", _W, None, "/x", None, None, "opened", None, None, None, None, "L1", "duplicate_smartlist", "duplicate_smartlist", None),
    ("public_watchlists", "https://www.example.com/", None, "/", None, "Sector", None, "Filtering", "Bio", None, None, None, "filter", "sector", "Bio"),
    ("public_watchlists", "https://www.example.com/", None, "/", None, "T", None, "Click on Card", "C9", None, None, None, "public_watchlist", "card", "C9"),
    ("share_smartlist", _W, None, "/x", None, "Email", "link copied", None, None, None, None, "L1", "share", "email", None),
    ("share_smartlist", _W, None, "/x", None, None, "copy and add to my smarlist", None, None, None, None, "L1", "duplicate", "saved from copied link", None),
    ("export_search_results", _W, None, "/user/watchlist", None, "Success CSV", None, None, None, None, None, "L1", "export", "csv", None),
    ("smartlist_view", _W, None, "/x", None, None, None, None, "Landscape View", None, None, "L1", "view", "landscape view", None),
    ("smartlist_search_tabs", _W, None, "/x", None, None, None, None, "Odd", None, None, "L1", "tabs", "odd", "odd"),
    ("smartlist_manual_order", _W, None, "/x", None, "Drag and drop", None, None, "Row", None, None, "L1", "order", "drag and drop", None),
    ("watchlist_interactions", _W, None, "/x", None, None, None, "Sec", None, "button_click", "Delete_List", "L1", "dots_menu", "delete list", None),
    ("watchlist_interactions", _W, None, "/x", None, None, None, "Sec", None, "rename_it", "Lab", "L1", "rename it", "rename_it", "lab"),
    ("smartlists_notifications", _W, None, "/x", None, "Activated", None, None, None, None, None, "L1", "notifications", "activated", None),
    ("side_bar_clicks", "https://www.example.com/a", None, "/a", None, None, None, None, "Notifications", None, None, None, "notifications", "notification icon clicked", "Notifications"),
    ("add_to_collection", "https://www.example.com/s", None, "/startups/search", None, None, None, None, None, None, None, None, "add_to_collection", "search page", None),
    ("add_to_collection", "https://www.example.com/s", None, "/company_page", None, None, None, None, None, None, None, None, "add_to_collection", "profile page", None),
]


def _sample_events(spark, d, samples, names):
    c = F.col
    pick = lambda j: _pick([s[j] for s in samples], c("seq") % len(samples)).cast("string")
    return flat_events(spark, d).select(
        c("eid").alias("event_id"), c("ts").alias("event_datetime_utc"), F.concat(F.lit("u"), (c("person") % 50).cast("string")).alias("user_id"),
        F.concat(F.lit("s"), (c("person") % 100).cast("string"), F.lit("_"), F.dayofyear("ts").cast("string")).alias("session_id"), *[pick(j).alias(n) for j, n in enumerate(names)])


def _sample_expected(samples, width, names):
    n = len(samples)
    return ", ".join(f"{_sql_list([s[width + j] for s in samples])}[seq % {n} + 1] AS {name}" for j, name in enumerate(names))


def _day_sessions(spark, d):
    c = F.col
    return flat_events(spark, d).select(
        F.concat(F.lit("s"), (c("person") % 100).cast("string"), F.lit("_"), F.dayofyear("ts").cast("string")).alias("session_id"), c("event_date").alias("session_date")
    ).distinct().withColumn("suspected_fraud", c("session_id").endswith("7"))


@query("p24_list_events", "WITH " + FLAT + ", x AS (SELECT eid AS event_id, person, ts, event_date AS date_day, " + _sample_expected(LIST_SAMPLES, 11, ["list_id", "action_category", "action", "action_details"]) + """ FROM flat)
SELECT event_id, date_day, list_id, action_category, action, action_details, CASE list_id WHEN 'L1' THEN 'AFRICA' WHEN 'S2' THEN 'AMERICA' END AS list_name, dayofyear(ts) % 10 = 7 AS suspected_fraud FROM x
""")
def _(spark, d):
    lists = table(spark, d, "region").filter("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "L1").otherwise("S2").alias("list_id"), F.col("r_name").alias("list_name"))
    out = L.list_events(_sample_events(spark, d, LIST_SAMPLES, _EV), lists, _day_sessions(spark, d), session_columns=["suspected_fraud"])
    return out.select("event_id", "date_day", "list_id", "action_category", "action", "action_details", "list_name", "suspected_fraud")


_SV = ["event_name", "page_location", "page_referrer", "page_path", "grouped_page_name", "type", "step"]
_Q = "https://www.example.com/startups/search?savedsearchid=Q1&x=2"
# inputs in the order of _SV, then kept, id, category, action, type
SAVED_SAMPLES = [
    ("saved_searches", _Q, None, "/user/savedsearches", "User Saved Searches", "New saved search", None, 1, None, "create", None, "Saved Search Page"),
    ("saved_searches", _Q, None, "/startups/search", "Startups Search", "Delete search", None, 0, None, "delete", None, "Startups"),
    ("saved_searches_notifications", "https://www.example.com/a", _Q, "/a", "Investors Search", "Activated", "Save changes", 1, "Q1", "notification", "activated", "Investors"),
    ("saved_searches_notifications", _Q, None, "/a", "Multinational Search", "Daily", "Save changes", 1, "Q1", None, None, "Multinationals"),
    ("export_search_results", _Q, None, "/a", "Hubs Search", "Success XLS", None, 1, "Q1", "export", "xls", "Hubs"),
    ("export_search_results", "https://www.example.com/a", None, "/a", "Hubs Search", "Success XLS", None, 0, None, "export", "xls", "Hubs"),
    ("page_view", _Q, None, "/user/savedsearches", "Hubs Search", None, None, 0, None, None, None, None),
]


@query("p24_saved_search_events", "WITH " + FLAT + ", x AS (SELECT eid AS event_id, person, " + _sample_expected(SAVED_SAMPLES, 7, ["kept", "saved_search_id", "action_category", "action", "saved_type"]) + """ FROM flat)
SELECT event_id, saved_search_id, action_category, action, CASE WHEN saved_search_id = 'Q1' AND person % 50 < 5 THEN 'Own' ELSE saved_type END AS saved_search_type FROM x WHERE kept = 1
""")
def _(spark, d):
    saved = table(spark, d, "region").select(F.concat(F.lit("u"), F.col("r_regionkey").cast("string")).alias("user_id"), F.lit("Q1").alias("saved_search_id"), F.lit("Own").alias("saved_search_type"))
    out = L.saved_search_events(_sample_events(spark, d, SAVED_SAMPLES, _SV), saved, _day_sessions(spark, d))
    return out.select("event_id", "saved_search_id", "action_category", "action", "saved_search_type")


@query("p24_explode_fields", """
WITH n AS (SELECT p_partkey AS notification_id, p_size AS list_id, CASE WHEN p_size % 7 = 0 THEN NULL ELSE trim(p_name, ' ') END AS f FROM part),
x AS (SELECT notification_id, list_id, unnest(CASE WHEN f IS NULL THEN [NULL] ELSE string_split(f, ' ') END) AS notification_field FROM n)
SELECT md5(concat_ws('-', notification_id, list_id, COALESCE(notification_field, '_null_'))) AS record_id, notification_id, list_id, notification_field, n_name AS list_name FROM x JOIN nation ON n_nationkey = list_id
""")
def _(spark, d):
    c = F.col
    fields = F.when(c("p_size") % 7 != 0, F.concat(F.lit(","), F.replace("p_name", F.lit(" "), F.lit(",")), F.lit(",")))
    n = table(spark, d, "part").select(c("p_partkey").alias("notification_id"), c("p_size").alias("list_id"), fields.alias("notification_fields"))
    owners = table(spark, d, "nation").select(c("n_nationkey").alias("list_id"), c("n_name").alias("list_name"))
    return L.explode_fields(n, owners, "list_id")


@query("p24_list_companies", """
SELECT l_orderkey AS list_id, l_linenumber AS group_id, l_suppkey AS company_id, o_orderpriority AS list_name, p.p_brand AS group_name, s_name AS company_name FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F'
LEFT JOIN part p ON p_partkey = l_orderkey AND p_size % 8 = l_linenumber LEFT JOIN supplier ON s_suppkey = l_suppkey
""")
def _(spark, d):
    c = F.col
    relation = table(spark, d, "lineitem").select(c("l_orderkey").alias("list_id"), c("l_linenumber").alias("group_id"), c("l_suppkey").alias("company_id"))
    lists = table(spark, d, "orders").filter("o_orderstatus = 'F'").select(c("o_orderkey").alias("list_id"), c("o_orderpriority").alias("list_name"))
    groups = table(spark, d, "part").select(c("p_partkey").alias("list_id"), (c("p_size") % 8).alias("group_id"), c("p_brand").alias("group_name"))
    companies = table(spark, d, "supplier").select(c("s_suppkey").alias("company_id"), c("s_name").alias("company_name"))
    return L.list_companies(relation, lists, groups, companies)


@query("p24_with_owner", "WITH " + FLAT + """,
b AS (SELECT 'u' || person AS owner_id, country AS geo__country FROM flat QUALIFY row_number() OVER (PARTITION BY person ORDER BY event_date DESC, eid) = 1)
SELECT md5(concat_ws('-', 'u' || o_custkey, o_orderkey)) AS record_id, o_orderkey AS list_id, 'u' || o_custkey AS owner_id, CAST(o_orderdate AS DATE) AS list_created_date, NULLIF(o_orderdate + INTERVAL (o_orderkey % 2) DAY, o_orderdate) AS list_last_modified_datetime, geo__country
FROM orders LEFT JOIN b ON b.owner_id = 'u' || o_custkey
""")
def _(spark, d):
    c = F.col
    s = lambda x: F.concat(F.lit("u"), x.cast("string"))
    raw = table(spark, d, "orders").select(
        c("o_orderkey").alias("collection_id"), s(c("o_custkey")).alias("owner_id"), s(c("o_custkey")).alias("creator_id"), c("o_orderpriority").alias("collection_name"), F.lit(None).cast("string").alias("collection_description"),
        F.lit("list").alias("collection_type"), c("o_orderdate").alias("created_datetime"), (c("o_orderdate") + F.make_dt_interval(days=(c("o_orderkey") % 2).cast("int"))).alias("last_modified_datetime"))
    ses = flat_events(spark, d).select(s(c("person")).alias("user_id"), c("event_date").alias("session_date"), c("eid").alias("session_id"), c("country").alias("geo__country"))
    out = L.with_owner(L.list_dimension(raw), ses, "owner_id", ["geo__country"], ["owner_id", "list_id"])
    return out.select("record_id", "list_id", "owner_id", "list_created_date", "list_last_modified_datetime", "geo__country")


@query("p25_audiences", "WITH " + FLAT + """,
x AS (SELECT *, unnest([k, k + 1]) AS aid FROM flat)
SELECT md5(concat_ws('-', ymd, eid, aid)) AS audience_membership_id, event_date AS occurrence_date, eid AS user_id, aid AS audience__id, make_timestamp(least(event_timestamp, event_timestamp + (50 - aid) * 1000000)) AS audience__membership_start,
  make_timestamp(greatest(event_timestamp, event_timestamp + (50 - aid) * 1000000)) AS audience__membership_expiry FROM x
""")
def _(spark, d):
    c = F.col
    ad = lambda i: F.struct(
        (c("k") + i).alias("id"), F.lit("n").alias("name"), c("event_timestamp").alias("membership_start_timestamp_micros"), (c("event_timestamp") + (50 - c("k") - i) * 1000000).alias("membership_expiry_timestamp_micros"), F.lit(False).alias("npa"))
    rows = flat_events(spark, d).select(c("ymd").alias("occurrence_date"), c("eid").alias("user_id"), F.array(ad(0), ad(1)).alias("audiences"), c("ymd").alias("last_updated_date"))
    return L.audiences(rows).select("audience_membership_id", "occurrence_date", "user_id", "audience__id", "audience__membership_start", "audience__membership_expiry")


@query("p25_user_ltv", "WITH " + FLAT + """,
b AS (SELECT * FROM flat QUALIFY row_number() OVER (PARTITION BY person ORDER BY event_timestamp DESC) = 1)
SELECT person AS user_id, ts AS user_info__last_active_datetime, CASE WHEN k % 2 = 1 THEN ts END AS user_info__first_touch_datetime, country AS geo__country, 'cat' || k AS user_properties__user_category, ts AS user_properties__user_category_set_datetime,
  NULL::VARCHAR AS user_properties__user_type, k AS user_ltv__sessions, msec / 1000 AS user_ltv__engagement_time_seconds FROM b
""")
def _(spark, d):
    c = F.col
    none = F.lit(None).cast("string")
    t = c("event_timestamp")
    value = F.struct(F.concat(F.lit("cat"), c("k").cast("string")).alias("string_value"), t.alias("set_timestamp_micros"))
    rows = flat_events(spark, d).select(
        c("person").alias("user_id"), F.struct(t.alias("last_active_timestamp_micros"), F.when(c("k") % 2 == 1, t).otherwise(0).alias("user_first_touch_timestamp_micros")).alias("user_info"),
        F.struct(none.alias("operating_system"), c("category"), none.alias("mobile_brand_name"), none.alias("unified_screen_name")).alias("device"),
        F.struct(none.alias("continent"), none.alias("region"), c("country"), none.alias("city")).alias("geo"), F.array(F.struct(F.lit("slot_01").alias("key"), value.alias("value"))).alias("user_properties"),
        F.struct(c("k").alias("sessions"), c("msec").alias("engagement_time_millis"), c("k").alias("purchases"), c("k").alias("engaged_sessions"), c("msec").alias("session_duration_micros")).alias("user_ltv"),
        F.struct(F.lit("no").alias("is_limited_ad_tracking")).alias("privacy_info"), F.date_format("ts", "yyyyMMddHHmmssSSSSSS").alias("__order"), c("ymd").alias("last_updated_date"))
    # one row per user and day reaches the operator, as in a daily export
    from martlib.operators.windows import keep_first
    daily = keep_first(rows, ["user_id", "last_updated_date"], ["-__order"]).drop("__order")
    return L.user_ltv(daily).select(
        "user_id", "user_info__last_active_datetime", "user_info__first_touch_datetime", "geo__country", "user_properties__user_category", "user_properties__user_category_set_datetime",
        "user_properties__user_type", "user_ltv__sessions", "user_ltv__engagement_time_seconds")


@query("p26_user_properties", "WITH " + FLAT + """
SELECT eid, event_date, key AS user_property__key, CASE key WHEN 'plan' THEN category ELSE CAST(k AS VARCHAR) END AS user_property__value FROM (SELECT *, unnest(['plan', 'level']) AS key FROM flat)
""")
def _(spark, d):
    c = F.col
    none = lambda t: F.lit(None).cast(t)
    up = lambda key, s, i: F.struct(F.lit(key).alias("key"), F.struct(s.alias("string_value"), i.alias("int_value"), none("double").alias("float_value"), none("double").alias("double_value")).alias("value"))
    rows = flat_events(spark, d).select(
        c("ymd").alias("event_date"), "event_timestamp", c("eid").alias("user_id"), c("pseudo").alias("user_pseudo_id"), F.array(up("plan", c("category"), none("long")), up("level", none("string"), c("k"))).alias("user_properties"))
    return L.user_properties(rows).select(c("user_id").alias("eid"), "event_date", "user_property__key", "user_property__value")
