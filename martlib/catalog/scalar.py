"""Scalar functions on the driver tables; the SQL computes every answer from the same columns."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from martlib.catalog.registry import query, table
from martlib.functions import dates as D
from martlib.functions import geo as G
from martlib.functions import json_text as JT
from martlib.functions import numbers as N
from martlib.functions import rules as R
from martlib.functions import text as X
from martlib.functions import urls as U


def _lit_sql(v):
    if v is None:
        return "NULL"
    return str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


_LOCATED = """
WITH loc AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '?tab=Team-A&amp;view=List&utm_medium=cpc'
  WHEN page_id % 5 = 1 THEN 'https://Site.example.com//Company_Page/x_page/Slug-' || page_id || '?section=News%3Bmore&campID=c' || page_id
  ELSE url END AS page_location, CASE WHEN page_id % 4 <> 0 THEN url END AS page_referrer FROM pages)
"""


def _located(spark, d):
    p = F.col("page_id")
    loc = (
        F.when(p % 3 == 0, F.concat("url", F.lit("?tab=Team-A&amp;view=List&utm_medium=cpc")))
        .when(p % 5 == 1, F.concat(F.lit("https://Site.example.com//Company_Page/x_page/Slug-"), p.cast("string"), F.lit("?section=News%3Bmore&campID=c"), p.cast("string")))
        .otherwise(F.col("url"))
    )
    return table(spark, d, "pages").select("page_id", loc.alias("page_location"), F.when(p % 4 != 0, F.col("url")).alias("page_referrer"))


@query("h1_string_functions", """
SELECT p_partkey, lower(p_brand) || '/' || upper(p_type) AS joined, left(p_name, 4) AS l4, right(p_name, 3) AS r3, length(p_name) AS n,
  replace(p_name, ' ', '_') AS replaced, trim('(' || p_name || ')', '()') AS trimmed, rtrim(p_name || '//', '/') AS rtrimmed,
  p_name LIKE '%ring%' AS has_ring, CASE WHEN p_size > 25 THEN NULL ELSE p_brand END || '-x' AS null_concat,
  upper(trim(' ' || p_name)) AS name_key FROM part
""")
def _(spark, d):
    c = F.col("p_name")
    return table(spark, d, "part").select(
        "p_partkey", F.concat(F.lower("p_brand"), F.lit("/"), F.upper("p_type")).alias("joined"), F.left(c, F.lit(4)).alias("l4"),
        F.right(c, F.lit(3)).alias("r3"), F.length(c).cast("long").alias("n"), X.replace_all(c, [(" ", "_")]).alias("replaced"),
        X.trim_chars(F.concat(F.lit("("), c, F.lit(")")), "()").alias("trimmed"), X.rtrim_chars(F.concat(c, F.lit("//")), "/").alias("rtrimmed"),
        c.like("%ring%").alias("has_ring"), F.concat(F.when(F.col("p_size") <= 25, F.col("p_brand")), F.lit("-x")).alias("null_concat"),
        X.name_key(F.concat(F.lit(" "), c)).alias("name_key"),
    )


@query("h2_initcap_words", r"""
SELECT page_id, array_to_string(list_transform(regexp_extract_all(lower(url), '[^\s\[\](){}/|<>!?@"^#$&~_,.:;*%+-]+|[\s\[\](){}/|<>!?@"^#$&~_,.:;*%+-]'),
  lambda x: upper(x[1]) || x[2:]), '') AS capitalised FROM pages
""")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", X.initcap_words(F.col("url")).alias("capitalised"))


@query("h3_extract_contains", """
SELECT page_id, NULLIF(regexp_extract(url, '/([a-z]{2})/', 1), '') AS lang, regexp_matches(url, 'blog|spam') AS is_blog,
  NULLIF(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title FROM pages
""")
def _(spark, d):
    u = F.col("url")
    title = F.nullif(X.extract(F.col("html"), "<title>([^<]*)</title>"), F.lit(""))
    return table(spark, d, "pages").select("page_id", X.extract(u, "/([a-z]{2})/").alias("lang"), X.contains(u, "blog|spam").alias("is_blog"), title.alias("title"))


@query("h4_url_parts", _LOCATED + r"""
SELECT page_id, lower(NULLIF(regexp_extract(page_referrer, 'https?://[^/]+(/[^?#]*)', 1), '')) AS referrer_path,
  replace(lower(NULLIF(regexp_extract(page_location, 'https?://[^/]+(/[^?#]*)', 1), '')), '//', '/') AS page_path,
  trim(replace(replace(string_split(replace(page_location, '%3F', '?'), '?')[2], '%3B', ';'), '&amp;', '&'), '&') AS page_query,
  lower(NULLIF(regexp_extract(page_location, '[&?](?:section|tab)=([^?&=]+)', 1), '')) AS tab,
  lower(NULLIF(regexp_extract(page_location, '[&?]?view=([^?&=]+)', 1), '')) AS view,
  NULLIF(regexp_extract(page_location, '/\w+_page/([^/#?]+)', 1), '') AS company_url_name FROM loc
""")
def _(spark, d):
    return U.url_parts(_located(spark, d)).drop("page_location", "page_referrer")


@query("h5_campaign_params", _LOCATED + """
SELECT page_id, NULLIF(regexp_extract(page_location, '[?&]utm_source=([^&]+)', 1), '') AS utm_source,
  NULLIF(regexp_extract(page_location, '[?&]utm_medium=([^&]+)', 1), '') AS utm_medium,
  NULLIF(regexp_extract(page_location, '[?&]campID=([^&]+)', 1), '') AS marketing_campaignid FROM loc
""")
def _(spark, d):
    names = {k: U.CAMPAIGN_PARAMS[k] for k in ("utm_source", "utm_medium", "campID")}
    return _located(spark, d).select("page_id", *U.campaign_params(F.col("page_location"), names))


@query("h6_url_host", "SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", U.url_host(F.col("url")).alias("host"))


@query("h7_decode_partial", """
SELECT p_partkey, trim(replace(replace(replace(replace(replace('|' || replace(p_name, ' ', '%20') || '%7C' || p_brand || '+x%2By%2Cz|',
  '%2B', '|'), '%7C', '|'), '%20', ' '), '+', ' '), '%2C', ','), '|') AS decoded FROM part
""")
def _(spark, d):
    raw = F.concat(F.lit("|"), F.replace("p_name", F.lit(" "), F.lit("%20")), F.lit("%7C"), "p_brand", F.lit("+x%2By%2Cz|"))
    return table(spark, d, "part").select("p_partkey", X.decode_partial(raw).alias("decoded"))


@query("h8_split_at", "SELECT page_id, string_split(url, '/')[4] AS part_3, string_split(url, '.')[2] AS dot_1, string_split(url, '/')[31] AS part_30 FROM pages")
def _(spark, d):
    u = F.col("url")
    return table(spark, d, "pages").select("page_id", X.split_at(u, "/", 3).alias("part_3"), X.split_at(u, ".", 1).alias("dot_1"), X.split_at(u, "/", 30).alias("part_30"))


_HOSTS = """
WITH p AS (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, NULLIF(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1), '') AS utm,
  regexp_extract(url, '^https?://[^/]+(/[^?#]*)', 1) AS path, NULLIF(regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1), '') AS lang,
  regexp_extract(html, 'lang="([a-z]*)"', 1) AS page_lang FROM pages)
"""


def _hosts(spark, d):
    """Hosts, paths, campaign tags and languages of the pages."""
    u = F.col("url")
    return table(spark, d, "pages").select(
        "page_id", "url", U.url_host(u).alias("host"), *U.campaign_params(F.regexp_replace(u, "#.*", ""), {"utm_source": "utm"}),
        X.extract(u, U.PATH).alias("path"), X.extract(u, "^https?://[^/]+/([a-z]{2})/").alias("lang"), X.extract(F.col("html"), 'lang="([a-z]*)"').alias("page_lang"))


@query("h9_canonical", _HOSTS + """
SELECT page_id, CASE WHEN lower(host) LIKE '%casino%' THEN 'casino' WHEN lower(host) LIKE '%the%' THEN 'the' WHEN lower(host) LIKE '%er.%' THEN 'er' ELSE host END AS named,
  CASE """ + " ".join(f"WHEN lower(host) LIKE '%{x}%' THEN '{x}'" for x in R.KNOWN_SOURCES) + " " + " ".join(f"WHEN lower(host) LIKE '%{k}%' THEN '{v}'" for k, v in R.UNIVERSITY_SOURCES.items()) + """
  WHEN host IN ('chatgpt.com', 'chat.openai.com') THEN 'chatgpt.com' WHEN lang = 'de' THEN 'german pages' ELSE host END AS known FROM p
""")
def _(spark, d):
    h = F.col("host")
    return _hosts(spark, d).select(
        "page_id", R.canonical(h, [("casino", "casino"), ("the", "the"), ("er.", "er")]).alias("named"), R.canonical(h, extra=[(F.col("lang") == "de", "german pages")]).alias("known"))


@query("h10_dates", """
SELECT event_id, CAST(strptime(strftime(ts, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed, strftime(ts, '%Y%m%d') AS formatted,
  make_timestamp(epoch_us(ts)) AS from_micros, make_date(year(ts), CASE WHEN event_id % 2 = 0 THEN month(ts) ELSE 1 END, 1) AS first_day,
  year(ts) AS yr, month(ts) AS mon, date_trunc('hour', ts) AS hr, date_trunc('minute', ts) AS mi,
  CAST(ts AS DATE) - CAST(dayofweek(ts) AS INTEGER) AS week_start, CAST(ts AS DATE) - 7 AS week_ago FROM events
""")
def _(spark, d):
    ts = F.col("ts")
    month = F.when(F.col("event_id") % 2 == 0, F.month(ts))
    return table(spark, d, "events").select(
        "event_id", D.parse_ymd(D.format_ymd(ts)).alias("parsed"), D.format_ymd(ts).alias("formatted"),
        D.micros_to_dt(F.unix_micros(ts.cast("timestamp"))).alias("from_micros"), D.first_of_month(F.year(ts), month).alias("first_day"),
        F.year(ts).cast("long").alias("yr"), F.month(ts).cast("long").alias("mon"), D.trunc_to(ts, "hour").alias("hr"), D.trunc_to(ts, "minute").alias("mi"),
        D.week_start_sunday(ts).alias("week_start"), F.date_sub(ts.cast("date"), 7).alias("week_ago"),
    )


@query("h11_diff_seconds", """
SELECT event_id, date_sub('second', date_trunc('minute', ts) + INTERVAL 500 MILLISECOND, ts) AS elapsed,
  date_diff('second', date_trunc('minute', ts) + INTERVAL 500 MILLISECOND, ts) AS crossed,
  date_diff('day', TIMESTAMP '2024-01-01', ts) AS days FROM events
""")
def _(spark, d):
    base = D.trunc_to(F.col("ts"), "minute") + F.expr("interval 0.5 seconds")
    return table(spark, d, "events").select(
        "event_id", D.diff_seconds(F.col("ts"), base).alias("elapsed"), D.diff_seconds(F.col("ts"), base, "boundary").alias("crossed"),
        D.diff_days(F.col("ts"), F.lit("2024-01-01").cast("date")).cast("long").alias("days"),
    )


@query("h12_floor_bucket", """
SELECT event_id, make_timestamp(epoch_us(ts) // 10000000 * 10000000) AS t10, make_timestamp(epoch_us(ts) // 60000000 * 60000000) AS t60 FROM events
""")
def _(spark, d):
    return table(spark, d, "events").select("event_id", D.floor_bucket(F.col("ts"), 10).alias("t10"), D.floor_bucket(F.col("ts"), 60).alias("t60"))


@query("h13_numbers", """
SELECT event_id, CAST(round(value) AS BIGINT) AS rounded, round(value / 1000, 6) AS secs, floor(value) AS floored,
  CASE WHEN user_id % 3 = 0 THEN NULL ELSE round(value / (user_id % 3), 6) END AS ratio, TRY_CAST(CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE event_type END AS BIGINT) AS as_int FROM events
""")
def _(spark, d):
    v, raw = F.col("value"), F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.col("event_type"))
    return table(spark, d, "events").select(
        "event_id", N.to_int_round(v).alias("rounded"), F.round(v / 1000, 6).alias("secs"), F.floor(v).cast("double").alias("floored"),
        F.round(N.try_div(v, F.col("user_id") % 3), 6).alias("ratio"), N.try_int(raw).alias("as_int"),
    )


@query("h14_strict_extremes", """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE greatest(value, event_id % 3 * 50) END AS hi,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE least(value, event_id % 3 * 50) END AS lo FROM events
""")
def _(spark, d):
    other = F.nullif(F.col("event_id") % 3, F.lit(0)) * 50.0
    return table(spark, d, "events").select("event_id", N.greatest_strict(F.col("value"), other).alias("hi"), N.least_strict(F.col("value"), other).alias("lo"))


@query("h15_arrays", """
SELECT c_custkey, array_to_string(generate_series(1998, 1996 + c_custkey % 6), ',') AS years_raw, len(generate_series(1998, 1996 + c_custkey % 6)) AS n_years,
  NULLIF(array_to_string(list_sort(list_distinct(string_split(c_mktsegment, 'I'))), '|'), '') AS pieces FROM customer
""")
def _(spark, d):
    years = N.year_array(1998, (F.lit(1996) + F.col("c_custkey") % 6).cast("int"))
    return table(spark, d, "customer").select(
        "c_custkey", F.coalesce(N.array_text(years), F.lit("")).alias("years_raw"), F.size(years).cast("long").alias("n_years"),
        N.array_text(F.array_sort(F.array_distinct(F.split("c_mktsegment", "I"))), "|").alias("pieces"),
    )


_JSON = """
WITH j AS (SELECT event_id, CASE WHEN event_id % 10 = 9 THEN '{broken' WHEN event_id % 10 = 8 THEN NULL
  ELSE '{"k":' || json_extract_string(props, '$.k') || ',"name":"' || event_type || '","none":null,"deep":{"a":' || user_id || '}}' END AS js FROM events)
"""


def _json(spark, d):
    e = F.col("event_id")
    js = F.when(e % 10 == 9, "{broken").when(
        e % 10 != 8,
        F.concat(F.lit('{"k":'), F.get_json_object("props", "$.k"), F.lit(',"name":"'), "event_type", F.lit('","none":null,"deep":{"a":'), F.col("user_id").cast("string"), F.lit("}}")),
    )
    return table(spark, d, "events").select("event_id", js.alias("js"))


_PAIRS = _JSON + """
SELECT event_id, k AS filter_name, json_extract_string(js, '$.' || k) AS filter_value
FROM (SELECT event_id, js, unnest(['k', 'name', 'none', 'deep']) AS k FROM j WHERE event_id % 10 < 8)
"""


@query("h16_json_pairs", _PAIRS)
def _(spark, d):
    df = _json(spark, d).select("event_id", F.explode(JT.json_pairs(F.col("js"))).alias("p"))
    return df.select("event_id", "p.filter_name", "p.filter_value")


@query("j1_json_keys", _JSON + "SELECT event_id, CASE WHEN json_valid(js) THEN array_to_string(json_keys(js), ',') END AS keys FROM j")
def _(spark, d):
    return _json(spark, d).select("event_id", F.array_join(JT.json_keys(F.col("js")), ",").alias("keys"))


@query("j2_json_values", _JSON + """
SELECT event_id, CASE WHEN event_id % 10 < 8 THEN json_extract_string(js, '$.k') || ',' || json_extract_string(js, '$.name') || ',~,' || json_extract_string(js, '$.deep') END AS vals FROM j
""")
def _(spark, d):
    return _json(spark, d).select("event_id", F.array_join(JT.json_values(F.col("js")), ",", "~").alias("vals"))


@query("j3_json_pairs_count", _JSON + "SELECT event_id, CAST(CASE WHEN json_valid(js) THEN len(json_keys(js)) ELSE 0 END AS INTEGER) AS n_pairs FROM j")
def _(spark, d):
    return _json(spark, d).select("event_id", F.size(JT.json_pairs(F.col("js"))).alias("n_pairs"))


@query("h17_to_json_text", """
SELECT event_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '","list":[' || event_id % 3 || ',' || user_id % 2 || ']}' AS js FROM events
""")
def _(spark, d):
    s = F.struct("user_id", "event_type", F.array(F.col("event_id") % 3, F.col("user_id") % 2).alias("list"))
    return table(spark, d, "events").select("event_id", JT.to_json_text(s).alias("js"))


@query("h18_weighted_label", """
WITH d AS (SELECT c_custkey, CAST('0x' || left(md5(c_custkey || '-0'), 8) AS BIGINT) / 4294967296.0 AS r FROM customer)
SELECT c_custkey, CASE WHEN r < 0.4 THEN 'Consultant or service provider' WHEN r < 0.7 THEN 'Corporation' ELSE 'Startup' END AS label FROM d
""")
def _(spark, d):
    label = R.weighted_label(F.col("c_custkey"), [(0.4, "Consultant or service provider"), (0.3, "Corporation"), (0.3, "Startup")])
    return table(spark, d, "customer").select("c_custkey", label.alias("label"))


def _spellings_sql(column):
    """The fixed spellings as a lookup in SQL."""
    arms = " ".join(f"WHEN lower(trim({column})) IN ({', '.join(_lit_sql(x) for x in spelled)}) THEN '{name}'" for name, spelled in G.COUNTRY_SPELLINGS.items())
    return f"CASE {arms} ELSE array_to_string(list_transform(string_split(lower(trim({column})), ' '), lambda x: upper(x[1]) || x[2:]), ' ') END"


@query("h19_country", f"""
SELECT c_custkey, {_spellings_sql('n_name')} AS country, iso.code AS iso, CASE WHEN lower(n_name) IN ({', '.join(_lit_sql(x) for x in G.NOT_COUNTRIES)}) THEN 0 ELSE 1 END AS is_valid,
  {_spellings_sql('r_name')} AS region_name,
  CASE WHEN lower(r_name) IN ({', '.join(_lit_sql(x) for x in G.NOT_COUNTRIES)}) THEN 0 ELSE 1 END AS region_is_valid
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (VALUES {', '.join(f"('{k}', '{v}')" for k, v in G.COUNTRY_ISO.items())}) iso(name, code) ON iso.name = {_spellings_sql('n_name')}
""")
def _(spark, d):
    n, r = F.col("n_name"), F.col("r_name")
    df = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return df.select(
        "c_custkey", G.country_name(n).alias("country"), G.country_iso(n).alias("iso"), G.country_valid(n).alias("is_valid"),
        G.country_name(r).alias("region_name"), G.country_valid(r).alias("region_is_valid"))


@query("h20_region_target", f"""
SELECT c_custkey, r_name AS region, CASE WHEN {_spellings_sql('n_name')} IN ({', '.join(_lit_sql(x) for x in G.TARGET_COUNTRIES)}) THEN 1 ELSE 0 END AS is_target
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def _(spark, d):
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    # the region table of the deployment, read from a table: one row a country
    listed = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.sort_array(F.collect_list("n_name")).alias("countries")).orderBy("r_name").collect()
    df = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return df.select("c_custkey", G.region_of(F.col("n_name"), [(r[0], r[1]) for r in listed]).alias("region"), G.target_flag(G.country_name(F.col("n_name"))).alias("is_target"))


_CHANNEL_SQL = """CASE WHEN {s} = '(direct)' AND {m} IN ('not set', 'none') THEN 'Direct'
  WHEN regexp_matches({s}, 'baidu|bing|duckduckgo|ecosia|google|yahoo|yandex') AND regexp_matches({m}, '^(.*cp.*|ppc|paid.*)$') THEN 'Paid Search'
  WHEN regexp_matches({s}, 'facebook|fb|linkedin|twitter|lin|tw') AND regexp_matches({m}, '^(.*cp.*|ppc|paid.*)$') THEN 'Paid Social'
  WHEN regexp_matches({s}, 'youtube|vimeo') AND regexp_matches({m}, '^(.*cp.*|ppc|paid.*)$') THEN 'Paid Video'
  WHEN {m} IN ('display', 'banner', 'expandable', 'interstitial', 'cpm') THEN 'Display'
  WHEN regexp_matches({s}, 'facebook|fb|linkedin|twitter|lin|tw|social') OR {m} IN ('social', 'social-network', 'social-media', 'sm', 'social network', 'social media', 'linkedin') THEN 'Organic Social'
  WHEN regexp_matches({s}, 'youtube|vimeo') OR regexp_matches({m}, '^(.*video.*)$') THEN 'Organic Video'
  WHEN regexp_matches({s}, 'baidu|bing|duckduckgo|ecosia|google|yahoo|yandex|goog') OR {m} = '(organic)' THEN 'Organic Search'
  WHEN regexp_matches({s}, 'email|e-mail|e_mail|e mail') OR regexp_matches({m}, 'email|e-mail|e_mail|e mail') THEN 'Email'
  WHEN {m} = '(referral)' THEN 'Referral' ELSE 'Unassigned' END"""
_MEDIUM_SQL = "CASE WHEN utm IS NOT NULL THEN 'cpc' WHEN lang = 'fr' THEN '(referral)' WHEN lang = 'es' THEN '(organic)' ELSE lang END"


@query("h21_channel_group", _HOSTS + f"SELECT page_id, {_CHANNEL_SQL.format(s='host', m='(' + _MEDIUM_SQL + ')')} AS channel FROM p")
def _(spark, d):
    lang = F.col("lang")
    medium = F.when(F.col("utm").isNotNull(), "cpc").when(lang == "fr", "(referral)").when(lang == "es", "(organic)").otherwise(lang)
    return _hosts(spark, d).select("page_id", R.channel_group(F.col("host"), medium).alias("channel"))


# sections of another site in place of the languages, so that the rules meet real paths
_SECTIONS = [("/en/", "/company-page/"), ("/de/", "/reports/"), ("/fr/", "/user/watchlist/"), ("/es/", "/investor_page/")]
_SITE_PATH = "path"
for _old, _new in _SECTIONS:
    _SITE_PATH = f"replace({_SITE_PATH}, '{_old}', '{_new}')"


@query("h22_page_group", _HOSTS + f"""
, q AS (SELECT page_id, {_SITE_PATH} AS path FROM p)
SELECT page_id, CASE {" ".join(f"WHEN path LIKE '{k}' THEN '{g}'" for k, g, _ in U.PAGE_GROUPS)} WHEN path IS NULL OR path IN ('', '/') THEN '/' ELSE '/' || string_split(path, '/')[2] END AS page_group,
  CASE {" ".join(f"WHEN path LIKE '{k}' THEN '{n}'" for k, _, n in U.PAGE_GROUPS if n)} WHEN path IS NULL OR path = '' OR trim(path) = '/' THEN 'Homepage'
  ELSE array_to_string(list_transform(regexp_extract_all(lower(string_split(path, '/')[2]), '[^-]+|-'), lambda x: upper(x[1]) || x[2:]), '') END AS page_name FROM q
""")
def _(spark, d):
    path = X.replace_all(F.col("path"), _SECTIONS)
    return _hosts(spark, d).select("page_id", U.page_group(path).alias("page_group"), U.page_group_name(path).alias("page_name"))


_CITY_SPELLINGS = {"Brand#11": "First Town", "Brand#23": "Second Town", "Brand#35": "First Town"}
_CITY_WORDS = [("ring", "Ringwood"), ("a", "Alton")]
_AREAS = {"North": ["First Town", "Ringwood"], "South": ["Alton", "Brand#45", "First Town"]}


@query("h23_city", """
WITH p AS (SELECT p_partkey, p_name, CASE WHEN p_size <= 25 THEN p_brand WHEN p_size > 40 THEN p_size || p_brand END AS city FROM part),
f AS (SELECT p_partkey, CASE WHEN city IS NULL OR NOT regexp_matches(city, '^[a-zA-Z]{2}') THEN CASE WHEN p_name LIKE '%ring%' THEN 'Ringwood' WHEN p_name LIKE '%a%' THEN 'Alton' END
  WHEN city IN ('Brand#11', 'Brand#35') THEN 'First Town' WHEN city = 'Brand#23' THEN 'Second Town' ELSE city END AS city_fixed FROM p)
SELECT p_partkey, city_fixed, CASE WHEN city_fixed IN ('First Town', 'Ringwood') THEN 'North' WHEN city_fixed IN ('Alton', 'Brand#45') THEN 'South' ELSE 'Other' END AS area FROM f
""")
def _(spark, d):
    size = F.col("p_size")
    city = F.when(size <= 25, F.col("p_brand")).when(size > 40, F.concat(size.cast("string"), "p_brand"))
    df = table(spark, d, "part").withColumn("city_fixed", G.fix_city(city, F.col("p_name"), _CITY_SPELLINGS, _CITY_WORDS))
    return df.select("p_partkey", "city_fixed", G.area_of(F.col("city_fixed"), _AREAS, "Other").alias("area"))


@query("h23_plain_list_text", """
SELECT p_partkey, replace(p_brand || ',' || p_type, ',', ', ') AS items FROM part
""")
def _(spark, d):
    raw = F.concat(F.lit('["'), "p_brand", F.lit('","'), "p_type", F.lit('"]'))
    return table(spark, d, "part").select("p_partkey", G.plain_list_text(raw).alias("items"))


@query("h24_bucket", """
SELECT o_orderkey, CASE WHEN o_custkey % 9 = 0 THEN 'Undisclosed' WHEN o_totalprice < 100000 THEN 'Small' WHEN o_totalprice < 300000 THEN 'Medium' ELSE 'Large' END AS size FROM orders
""")
def _(spark, d):
    amount = F.when(F.col("o_custkey") % 9 != 0, F.col("o_totalprice"))
    return table(spark, d, "orders").select("o_orderkey", N.bucket(amount, [100000, 300000], ["Small", "Medium", "Large"], "Undisclosed").alias("size"))


@query("h25_derive_label", """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'Company' WHEN c_acctbal < 0 THEN 'Debtor' WHEN c_nationkey IN (1, 2, 3) THEN 'Near' ELSE c_mktsegment END AS kind FROM customer
""")
def _(spark, d):
    c = F.col
    rules = [(c("c_mktsegment") == "BUILDING", "Company"), (c("c_acctbal") < 0, "Debtor"), (c("c_nationkey").isin(1, 2, 3), "Near")]
    return table(spark, d, "customer").select("c_custkey", R.derive_label(rules, c("c_mktsegment")).alias("kind"))


_ATTR_SQL = """
, c AS (SELECT page_id, utm, CASE WHEN page_lang = 'fr' THEN '(direct)' WHEN page_lang = 'es' THEN NULL ELSE '(' || page_lang || ')' END AS a, CASE WHEN lang = 'es' THEN '(none)' ELSE lang END AS b, host AS c FROM p)
"""


def _candidates(df):
    page, lang = F.col("page_lang"), F.col("lang")
    return [F.when(page == "fr", "(direct)").when(page != "es", F.concat(F.lit("("), page, F.lit(")"))), F.when(lang == "es", "(none)").otherwise(lang), F.col("host")]


@query("h26_attribution", _HOSTS + _ATTR_SQL + """
SELECT page_id, CASE WHEN utm IS NOT NULL THEN utm ELSE trim(NULLIF(coalesce(a, b, c), '(none)'), '()') END AS strict,
  CASE WHEN utm IS NOT NULL THEN utm WHEN a NOT IN ('(direct)', '(organic)', '(referral)') THEN a WHEN b NOT IN ('(direct)', '(organic)', '(referral)') THEN b
    WHEN c NOT IN ('(direct)', '(organic)', '(referral)') THEN c ELSE trim(NULLIF(coalesce(a, b, c), '(none)'), '()') END AS lenient FROM c
""")
def _(spark, d):
    df = _hosts(spark, d)
    cand = _candidates(df)
    return df.select("page_id", R.attribute(F.col("utm"), cand).alias("strict"), R.attribute(F.col("utm"), cand, strict=False).alias("lenient"))


@query("j4_column_rules", _HOSTS + f"""
, q AS (SELECT page_id, host, utm, lang, {_SITE_PATH} AS path FROM p)
SELECT page_id, {_CHANNEL_SQL.format(s='host', m='(' + _MEDIUM_SQL + ')')} AS channel,
  CASE {" ".join(f"WHEN path LIKE '{k}' THEN '{g}'" for k, g, _ in U.PAGE_GROUPS)} WHEN path IS NULL OR path IN ('', '/') THEN '/' ELSE '/' || string_split(path, '/')[2] END AS page_group,
  lower(path) AS lower_path FROM q
""")
def _(spark, d):
    """Several rule columns added to one table in one projection."""
    lang, path = F.col("lang"), X.replace_all(F.col("path"), _SECTIONS)
    medium = F.when(F.col("utm").isNotNull(), "cpc").when(lang == "fr", "(referral)").when(lang == "es", "(organic)").otherwise(lang)
    return _hosts(spark, d).select("page_id", R.channel_group(F.col("host"), medium).alias("channel"), U.page_group(path).alias("page_group"), F.lower(path).alias("lower_path"))


@query("h27_classify_event", """
SELECT event_id, CASE WHEN event_type = 'click' AND value > 50 THEN 'engaged click' WHEN event_type IN ('view', 'click') THEN 'browse'
  WHEN event_type LIKE 's%' THEN 'signup' END AS action_category FROM events
""")
def _(spark, d):
    t = F.col("event_type")
    rules = [((t == "click") & (F.col("value") > 50), "engaged click"), (t.isin("view", "click"), "browse"), (t.startswith("s"), "signup")]
    return table(spark, d, "events").select("event_id", R.classify_event(rules).alias("action_category"))
