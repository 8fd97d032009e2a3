"""Page plans: page views, page flow, profile interactions, engagement, report pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.functions.rules import case, in_list, recode
from martlib.functions.text import initcap_words, mask_generated, rtrim_chars
from martlib.functions.urls import add_page_groups, url_parts
from martlib.operators.aggregates import group_by_all, min_by_nn, pivot_keys
from martlib.operators.joins import join_using
from martlib.operators.ordered import Lag, LastValue, RowNumber, RunningCount, Total, chained
from martlib.operators.windows import flow_steps, keep_first, partition_stat, preferred_value, spread_null_key
from martlib.plans.common import EMPTY_SESSION_ID, SESSION_OPENERS
from martlib.plans.events import cut_title
from martlib.session import cut_lineage, small_side


def engagement(long: DataFrame, empty_session: str = EMPTY_SESSION_ID) -> DataFrame:
    """Location, title and engagement seconds per event."""
    c = F.col
    keys = ["page_location", "page_title", "engagement_time_msec"]
    src = long.filter(in_list(c("event_key"), keys) & (c("session_id") != empty_session))
    value = lambda k: F.when(c("event_key") == k, c("event__string_value"))
    msec = F.when(c("event_key") == "engagement_time_msec", F.coalesce("event__double_value", "event__int_value"))
    out = src.groupBy("user_id", "user_pseudo_id", "session_id", F.col("event_date").alias("date_day"), "event_id").agg(
        F.coalesce(min_by_nn(value("page_location"), "event_date"), F.lit("/")).alias("page_location"),
        F.coalesce(min_by_nn(value("page_title"), "event_date"), F.lit("")).alias("page_title"),
        F.coalesce(F.sum(msec) / 1000, F.lit(0.0)).alias("engagement_time_seconds"),
    )
    return keep_first(out, ["event_id"], ["-user_id", "session_id", "date_day"])


def page_view_events(long: DataFrame, ids: Sequence[str]) -> DataFrame:
    """One row per page-view event with URL parts and page groups; ``ids`` are the columns kept from the long rows."""
    keys = {k: k for k in ("page_referrer", "page_location", "page_title")}
    src = long.filter((F.col("event_name") == "page_view") & F.col("event_key").isin(*keys))
    value = F.when(F.col("event_key") == "page_title", cut_title(F.col("event__string_value"))).otherwise(F.col("event__string_value"))
    wide = pivot_keys(src.withColumn("__value", value), ids, "event_key", "__value", keys)
    one = keep_first(url_parts(wide), ["event_id"], ["-event_datetime_utc", *[c for c in ids if c not in ("event_id", "event_datetime_utc")]])
    return add_page_groups(one)


def page_views(views: DataFrame, sessions: DataFrame, session_columns: Sequence[str]) -> DataFrame:
    """Daily page views per session and page, with session attributes.

    ``views`` has one row per page and day with ``page_view_count``,
    ``engagement_time_seconds`` and ``min_event_datetime_utc``; rows that agree
    on everything else are added up.
    """
    measures = {
        "page_view_count": F.sum("page_view_count"),
        "min_event_datetime_utc": F.min("min_event_datetime_utc"),
        "engagement_time_seconds": F.max("engagement_time_seconds"),
    }
    grouped = group_by_all(views, measures, drop=list(measures))
    side = sessions.select("session_id", F.col("session_date").alias("date_day"), *session_columns)
    out = join_using(grouped, side, ["session_id", "date_day"])
    return out.select(F.col("date_day").alias("session_date"), *out.columns)


def report_pages(views: DataFrame, prefix: str = "/reports/", overview: str = "/reports/reports and resources", split: bool = True) -> DataFrame:
    """Report page views under one path per title: hyphenated paths first, then the most viewed."""
    c = F.col
    src = views.filter(c("page_path").startswith(prefix) & (c("page_path") != overview))
    src = src.withColumn("__has_hyphen", F.when(c("page_path").contains("-"), 1).otherwise(0))
    counted = partition_stat(src.withColumn("__one", F.lit(1)), "count", "__one", ["page_title", "page_path"], "__views", split=split)
    counted = counted.withColumn("__path", rtrim_chars(c("page_path"), "/"))
    out = preferred_value(counted, "__path", ["page_title"], ["-__has_hyphen", "-__views"], "page_path")
    return out.drop("__has_hyphen", "__one", "__views", "__path")


# Events of the page flow.
FLOW_EVENTS = ["page_view", "profile_interactions"]
_ORDER = ["event_datetime_utc", "event_id"]


def flow_events(events: DataFrame) -> DataFrame:
    """Page views and tab changes, with the page name as the flow shows it."""
    is_tab = (F.col("event_name") != "profile_interactions") | F.lower("entity_type").like("%tabs")
    return events.filter(in_list(F.col("event_name"), FLOW_EVENTS) & is_tab).withColumns({
        "grouped_page_name": F.replace("grouped_page_name", F.lit(" Page"), F.lit("")),
        "__is_view": F.col("event_name") == "page_view",
    })


def name_with_tab() -> Column:
    named = F.concat(F.coalesce("grouped_page_name", F.lit("")), F.lit(" - "), F.col("tab"))
    return F.when(F.col("tab").isNotNull(), named).otherwise(F.col("grouped_page_name"))


def page_flow(events: DataFrame, n: int = 4, split: bool = True, with_tabs: bool = False) -> DataFrame:
    """Pages in order per session, without repeats, with the previous page and the next ``n - 1``.

    Page views equal to the page view before are dropped. ``with_tabs`` uses
    page names with tabs for the following steps.
    """
    c = F.col
    # the range shuffle reads its rows twice, and the events may be a long plan
    df = cut_lineage(flow_events(events)) if split else flow_events(events)
    df = spread_null_key(df, "session_id", "event_id", "__s")
    prev = c("previous_page_view_location")

    def without_repeats(df: DataFrame) -> DataFrame:
        df = df.withColumn("previous_page_view_location", F.when(c("__is_view"), prev))
        return df.filter(~c("__is_view") | prev.isNull() | (c("page_location") != prev)).withColumns({
            "user_id": mask_generated(c("user_id")),
            "grouped_page_name_with_tab": name_with_tab(),
        })

    def of_views(df: DataFrame) -> DataFrame:
        return df.withColumns({p: F.when(c("__is_view"), c(p)) for p in ("previous_grouped_page_path", "previous_grouped_page_name")})

    steps = ["grouped_page_path", "grouped_page_name_with_tab" if with_tabs else "grouped_page_name"]
    df = chained(df, ["__s"], _ORDER, [
        (["__is_view"], {"previous_page_view_location": Lag(c("page_location"))}),
        without_repeats,
        {"session_event_rank": RowNumber()},
        (["__is_view"], {
            "previous_grouped_page_path": Lag(c("grouped_page_path")),
            "previous_grouped_page_name": Lag(c("grouped_page_name_with_tab")),
        }),
        of_views,
        *flow_steps(steps, n),
    ], split=split)
    return df.drop("__s", "__is_view").withColumnRenamed("event_id", "record_id")


# Action -> category of profile interactions.
TAB_ACTIONS = [
    "similar-companies", "portfolio", "extensions", "overview", "funds", "financials", "exits", "about", "team", "news", "lifecycle",
    "israeli portfolio", "investments", "gallery", "suggested-companies", "business", "internal",
]
LINK_ACTIONS = [
    "website", "careerspage", "youtube", "facebook", "instagram", "linkedin", "twitter", "google-play", "app-store", "clicks on team members",
]
ACTION_CATEGORIES = {
    "read article popup news click": "news click",
    "news click": "news click",
    "funding rounds": "funding rounds",
    "video in profile": "videos and photos",
    "show_others_banner_click": "show others - banner click",
}
HYPHENATED_ACTIONS = ["similar-companies", "suggested-companies", "google-play", "app-store"]


def profile_action(c=F.col):
    """Action of a profile event."""
    name, section, entity = c("event_name"), F.lower("section"), F.lower("entity_type")
    inside = case([(section == "follow", F.concat(F.lit("follow - "), entity)), (entity.like("claim profile %"), entity)], section)
    return case([
        (name == "page view", name),
        (name == "profile_interactions", inside),
        ((name == "add_to_collection") & (F.lower("type") == "profile"), "profile added to list"),
        (name.isin("export_profile", "profile_external_links"), F.lower("type")),
        (name == "connect_request", F.concat(F.lit("connect request - "), F.lower("step"))),
    ])


def action_label(c=F.col):
    a = c("action")
    return initcap_words(case([
        (a == "clicks on team members", "click on member's linkedin"),
        (a == "careerspage", "careers page"),
        (a.startswith("success"), F.replace(a, F.lit(" "), F.lit(" - "))),
        ((c("type") == "Connect to Team") & (a == "team"), "connect to team"),
        (a.isin(*HYPHENATED_ACTIONS), F.replace(a, F.lit("-"), F.lit(" "))),
    ], a))


def action_category(c=F.col):
    a, low = c("action"), F.lower("action")
    return initcap_words(case([
        (c("event_name") == "page_view", "page view"),
        (c("event_name") == "connect_request", "connect request"),
        (a.isin(*TAB_ACTIONS), "tabs"),
        (a.isin(*LINK_ACTIONS), "external links"),
        (a.isin(*ACTION_CATEGORIES), recode(a, ACTION_CATEGORIES)),
        ((low == "export profile") | low.startswith("success"), "export profile"),
        (low.startswith("claim profile"), "claim profile"),
        (low.startswith("overview"), "overview"),
        (low.startswith("follow"), "follow"),
    ], a))


def profile_interactions(
    events: DataFrame, companies: DataFrame, *, default_tab: str = "overview", split: bool = True, empty_session: str = EMPTY_SESSION_ID
) -> DataFrame:
    """Events on profile pages with action, category, tab and engagement per tab.

    Within a page view the tab changes whenever a different tab is named; its
    engagement is the time until the next event, added up per tab.
    """
    c = F.col
    df = events.filter(c("company_url_name").isNotNull())
    one = keep_first(companies.select("company_id", "company_url_name", "updated_date"), ["company_url_name"], ["-updated_date", "company_id"])
    df = df.join(small_side(one.drop("updated_date")), "company_url_name", "left")
    real = c("session_id") != empty_session
    df = df.withColumn("action", profile_action())
    tab = F.when(c("event_name").isin(*SESSION_OPENERS, "page_view"), default_tab).otherwise(c("tab"))
    df = df.withColumns({
        "date_day": c("event_date"),
        "user_id": mask_generated(c("user_id")),
        "action": action_label(),
        "action_category": action_category(),
        "tab": F.when(real, tab),
    }).drop("event_date", "page_view_engagement_time_seconds")
    order = ["event_datetime_utc", "batch_sort_key", "event_id"]
    # the range shuffle reads its rows twice, and the events may be a long plan
    df = cut_lineage(df) if split else df
    df = spread_null_key(df, "session_id", "event_id", "__s", empty=empty_session)
    page = ["__s", "page_view_rank"]
    changed = c("tab").isNotNull() & (c("__previous_tab").isNull() | (c("tab") != c("__previous_tab")))
    df = chained(df, page, order, [
        {"__previous_tab": Lag(c("tab"))},
        {"__tab_rank": RunningCount(changed), "__page_seconds": Total("sum", c("engagement_time_seconds"))},
        (["__tab_rank"], {"__tab": LastValue(c("tab")), "tab_engagement_time_seconds": Total("sum", c("engagement_time_seconds_lead"))}),
    ], split=split)
    return df.withColumns({
        "tab_rank": F.when(real, c("__tab_rank")), "tab": c("__tab"), "page_view_ranked_engagement_time_seconds": c("__page_seconds"),
    }).drop("__s", "__previous_tab", "__tab_rank", "__page_seconds", "__tab")


def with_session_columns(df: DataFrame, sessions: DataFrame, session_columns: Sequence[str], date: str = "session_date") -> DataFrame:
    """Session attributes by session id and date, as the page and profile marts show them."""
    side = sessions.select("session_id", F.col("session_date").alias(date), *session_columns)
    return join_using(df, side, ["session_id", date])


def connect_requests(events: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    """The connection-request slice of the events."""
    out = events.filter(F.col("event_name") == "connect_request")
    return out.withColumnsRenamed(columns) if columns else out
