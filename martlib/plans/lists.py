"""List, saved-search, notification, audience and user-property plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.functions.dates import micros_to_dt, parse_ymd
from martlib.functions.json_text import param
from martlib.functions.rules import case, recode
from martlib.functions.text import extract, mask_generated, split_at, surrogate_key, trim_chars
from martlib.functions.urls import url_host
from martlib.operators.joins import unnest
from martlib.operators.windows import keep_first

# Events about lists.
LIST_EVENTS = [
    "duplicate_smartlist", "public_watchlists", "share_smartlist", "smartlist_view", "smartlist_search_tabs", "smartlist_manual_order",
    "smartlists_notifications", "add_to_collection", "watchlist_interactions",
]
COPY_STEP = "copy and add to my smarlist"  # as the tracker spells it
# Tabs of a list page.
KNOWN_TABS = ["companies", "hubs", "in the news", "investors", "multinationals", "recently updated"]


def _names(c=F.col):
    return c("event_name"), F.lower("section"), F.lower("type"), F.lower("action"), F.lower("element_clicked")


def list_id(location: Column) -> Column:
    """Id of the list a page shows."""
    low = F.lower(location)
    return case([
        (low.contains("/watchlist/"), extract(location, "/[Ww]atchlist/([^/?&]+)")),
        (low.contains("/smartlist/"), extract(location, "/[Ss]martlist/([^/?&]+)")),
    ])


def is_list_event(c=F.col) -> Column:
    name = c("event_name")
    return (
        name.isin(*LIST_EVENTS)
        | ((name == "export_search_results") & c("grouped_page_path").contains("/watchlist"))
        | ((name == "side_bar_clicks") & (c("element_clicked") == "Notifications"))
    )


def list_action_category(c=F.col) -> Column:
    name, section, _, action, _ = _names(c)
    bell = (name == "side_bar_clicks") & (c("element_clicked") == "Notifications")
    menu = case([(action == "button_click", "dots_menu"), (action == "add_to_collection", "add_to_collection")], F.replace(action, F.lit("_"), F.lit(" ")))
    return case([
        ((name == "duplicate_smartlist") & (c("step") == "success"), "duplicate"),
        (name == "public_watchlists", F.when(section == "filtering", "filter").otherwise("public_watchlist")),
        (name == "share_smartlist", F.when(c("step") == COPY_STEP, "duplicate").otherwise("share")),
        (name == "export_search_results", "export"),
        (name == "smartlist_notifications", "notification"),
        (name == "smartlist_view", "view"),
        (name == "smartlist_search_tabs", "tabs"),
        (name == "smartlist_manual_order", "order"),
        (name == "watchlist_interactions", menu),
        ((name == "smartlists_notifications") | bell, "notifications"),
    ], F.lower(name))


def list_action(home_host: str, c=F.col) -> Column:
    """What the user did; ``home_host`` tells the own site from others."""
    name, section, kind, action, element = _names(c)
    host = url_host(c("page_referrer"))
    copied = F.when(host == home_host, "saved from homepage list").otherwise("saved from copied link")
    saved = case([
        (c("page_query").contains("utm_source=link_copied"), copied),
        (c("page_referrer").isNotNull() & (host != home_host), "saved from public list"),
    ], "duplicated by user")
    place = case([
        (c("grouped_page_path").contains("/search"), "search page"), (c("grouped_page_path").rlike(".*_page.*"), "profile page"),
    ], F.concat(F.lower(F.replace("grouped_page_path", F.lit("/"), F.lit(""))), F.lit(" page")))
    public = case([(section == "filtering", kind), (section.startswith("click on"), F.replace(section, F.lit("click on "), F.lit("")))], name)
    menu = F.when(action.isin("button_click", "add_to_collection"), F.lower(F.replace("label", F.lit("_"), F.lit(" ")))).otherwise(action)
    return case([
        (name == "duplicate_smartlist", F.when(c("step") == "success", saved).otherwise(name)),
        (name == "public_watchlists", public),
        (name == "add_to_collection", place),
        (name == "watchlist_interactions", menu),
        (name == "smartlist_manual_order", F.when(element == "button", "button").otherwise(F.coalesce(kind, element))),
        (name == "share_smartlist", case([(c("step") == COPY_STEP, "saved from copied link"), (kind.isNotNull(), kind)], "watchlist")),
        (name == "smartlists_notifications", F.coalesce(kind, F.lit("notifications"))),
        (name == "export_search_results", F.lower(split_at(c("type"), " ", 1))),
        (name == "smartlist_view", F.lower(F.replace("element_clicked", F.lit(" view"), F.lit("")))),
        (name == "smartlist_search_tabs", element),
        ((name == "side_bar_clicks") & (c("element_clicked") == "Notifications"), "notification icon clicked"),
    ], F.lower(name))


def list_action_details(c=F.col) -> Column:
    name, section, kind, action, element = _names(c)
    unless = lambda hidden, value: F.when(F.coalesce(hidden, F.lit(False)), None).otherwise(value)
    public = F.when((section == "filtering") | section.startswith("click on"), c("element_clicked")).otherwise(c("type"))
    menu = unless(action.isin("add_to_collection", "button_click"), F.lower(F.coalesce("element_clicked", "label", "section")))
    return case([
        (name == "public_watchlists", public),
        (name == "watchlist_interactions", menu),
        (name == "export_search_results", unless(c("type").startswith("Success"), kind)),
        (name == "smartlists_notifications", unless(kind.isin("activated", "deactivated"), kind)),
        (name == "smartlist_manual_order", unless(kind == "drag and drop", kind)),
        (name == "smartlist_view", unless(element.isin("list view", "landscape view"), element)),
        (name == "smartlist_search_tabs", unless(element.isin(*KNOWN_TABS), element)),
    ], c("element_clicked"))


def _with_sessions(df: DataFrame, sessions: DataFrame, columns: Sequence[str]) -> DataFrame:
    side = sessions.select("session_id", F.col("session_date").alias("action_date"), F.col("session_date").alias("__date"), *columns)
    out = df.join(side, ["session_id", "action_date"], "left")
    return out.withColumn("date_day", F.coalesce("action_date", "__date")).drop("__date")


def list_events(events: DataFrame, lists: DataFrame, sessions: DataFrame, *, home_host: str = "www.example.com", session_columns: Sequence[str] = ()) -> DataFrame:
    """Events on lists with list attributes, action category, action and details."""
    c = F.col
    df = events.filter(is_list_event())
    df = df.withColumns({
        "action_date": c("event_datetime_utc").cast("date"), "action_datetime": c("event_datetime_utc"), "list_id": list_id(c("page_location")),
        "action_category": list_action_category(), "__action": list_action(home_host), "action_details": list_action_details(),
    })
    df = df.drop("event_name", "type", "step", "section", "element_clicked", "action", "label", "event_datetime_utc").withColumnRenamed("__action", "action")
    df = _with_sessions(df.join(lists, "list_id", "left"), sessions, session_columns)
    return df.withColumns({
        "record_id": surrogate_key("user_id", "list_id", "action", "action_datetime", "event_id"), "user_id": mask_generated(c("user_id")),
    })


# Type of a saved-search event -> action category.
SAVED_SEARCH_ACTIONS = {
    "new saved search": "create", "delete search": "delete", "rename search": "rename", "copy link to share": "share", "export": "export",
}


def saved_search_events(events: DataFrame, saved: DataFrame, sessions: DataFrame, *, session_columns: Sequence[str] = ()) -> DataFrame:
    """Events on saved searches; ``saved`` holds saved_search_id, user_id, saved_search_type and more."""
    c = F.col
    name, kind = c("event_name"), c("type")
    bell = name == "saved_searches_notifications"
    switched = kind.isin("Activated", "Deactivated")
    of = lambda col: extract(c(col), "[?&]savedsearchid=([^&]+)")
    df = events.filter(name.isin("saved_searches", "saved_searches_notifications", "export_search_results"))
    df = df.withColumns({
        "action_date": c("event_datetime_utc").cast("date"), "action_datetime": c("event_datetime_utc"),
        "saved_search_id": case([(bell, F.coalesce(of("page_location"), of("page_referrer"))), (name == "export_search_results", of("page_location"))]),
        "action_category": case([
            (name == "saved_searches", recode(F.lower("type"), SAVED_SEARCH_ACTIONS)), (bell & (c("step") == "Save changes") & switched, "notification"),
            (name == "export_search_results", "export"),
        ]),
        "action": case([
            (bell & switched, F.lower("type")), ((name == "export_search_results") & kind.startswith("Success"), F.lower(split_at(kind, " ", 1))),
        ]),
    })
    df = df.filter(c("saved_search_id").isNotNull() | c("page_path").contains("/savedsearch")).drop("event_datetime_utc")
    df = df.join(saved, ["saved_search_id", "user_id"], "left")
    page = c("grouped_page_name")
    shown = case([(page.contains("Multinational"), "Multinationals"), (page.endswith(" Search"), split_at(page, " ", 0))], "Saved Search Page")
    df = _with_sessions(df, sessions, session_columns)
    return df.withColumns({
        "record_id": surrogate_key("user_id", "saved_search_id", "action", "action_datetime", "event_id"), "user_id": mask_generated(c("user_id")),
        "saved_search_type": F.coalesce("saved_search_type", shown),
    })


def explode_fields(notifications: DataFrame, owners: DataFrame, key: str, *, trim: bool = True) -> DataFrame:
    """One row per notification field (comma-separated in ``notification_fields``) with the owning list or search.

    A notification without fields keeps one row.
    """
    fields = F.col("notification_fields")
    df = unnest(notifications, F.split(trim_chars(fields, ",") if trim else fields, ","), "notification_field", outer=True)
    df = df.drop("notification_fields").join(owners, key)
    return df.withColumn("record_id", surrogate_key("notification_id", key, "notification_field"))


def list_companies(relation: DataFrame, lists: DataFrame, groups: DataFrame, companies: DataFrame) -> DataFrame:
    """Companies of lists with list, group and company attributes."""
    return relation.join(lists, "list_id", "left").join(groups, ["list_id", "group_id"], "left").join(companies, "company_id", "left")


def with_owner(items: DataFrame, sessions: DataFrame, owner: str, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Lists or saved searches with the attributes of the owner's latest session."""
    c = F.col
    latest = keep_first(sessions.filter(c("user_id").isNotNull()), ["user_id"], ["-session_date", "session_id"])
    side = latest.select(c("user_id").alias(owner), *columns)
    return items.join(side, owner, "left").withColumn("record_id", surrogate_key(*keys))


def list_dimension(collections: DataFrame) -> DataFrame:
    """Lists under their mart names; a change date equal to the creation date is unknown."""
    c = F.col
    return collections.select(
        c("collection_id").alias("list_id"), "owner_id", "creator_id", c("collection_name").alias("list_name"),
        c("collection_description").alias("list_description"), c("collection_type").alias("list_type"),
        c("created_datetime").cast("date").alias("list_created_date"), c("created_datetime").alias("list_created_datetime"),
        F.nullif("last_modified_datetime", c("created_datetime")).alias("list_last_modified_datetime"))


def audiences(rows: DataFrame, id: str = "user_id") -> DataFrame:
    """One row per user, day and audience; membership start and expiry put in order."""
    c = F.col
    df = unnest(rows, "audiences", "ad")
    start, end = c("ad.membership_start_timestamp_micros"), c("ad.membership_expiry_timestamp_micros")
    return df.select(
        surrogate_key("occurrence_date", id, "ad.id").alias("audience_membership_id"), parse_ymd(c("occurrence_date")).alias("occurrence_date"), id,
        c("ad.id").alias("audience__id"), c("ad.name").alias("audience__name"),
        micros_to_dt(F.when(start < end, start).otherwise(end)).alias("audience__membership_start"),
        micros_to_dt(F.when(end > start, end).otherwise(start)).alias("audience__membership_expiry"),
        c("ad.npa").alias("audience__npa"), parse_ymd(c("last_updated_date")).alias("last_updated_date"))


def user_ltv(rows: DataFrame, id: str = "user_id", properties: Mapping[str, str] | None = None) -> DataFrame:
    """Latest row per user, flattened, with lifetime values in seconds and minutes.

    ``properties`` maps property keys to column names.
    """
    c = F.col
    properties = {"slot_01": "user_category", "slot_02": "user_type"} if properties is None else properties
    ltv = lambda f: c(f"user_ltv.{f}")
    props = []
    for key, name in properties.items():
        props.append(param(c("user_properties"), key, "string_value").alias(f"user_properties__{name}"))
        props.append(micros_to_dt(param(c("user_properties"), key, "set_timestamp_micros")).alias(f"user_properties__{name}_set_datetime"))
    # rows of one day are told apart by their content, so the choice is the same on every run
    last = keep_first(rows.withColumn("__tie", F.to_json(F.struct(*rows.columns))), [id], ["-last_updated_date", "__tie"])
    return last.select(
        id, micros_to_dt(c("user_info.last_active_timestamp_micros")).alias("user_info__last_active_datetime"),
        micros_to_dt(F.nullif("user_info.user_first_touch_timestamp_micros", F.lit(0))).alias("user_info__first_touch_datetime"),
        *[c(f"device.{f}").alias(f"device__{f}") for f in ("operating_system", "category", "mobile_brand_name", "unified_screen_name")],
        *[c(f"geo.{f}").alias(f"geo__{f}") for f in ("continent", "region", "country", "city")],
        *props,
        ltv("sessions").alias("user_ltv__sessions"), (ltv("engagement_time_millis") / 1000).alias("user_ltv__engagement_time_seconds"),
        (ltv("engagement_time_millis") / 60000).alias("user_ltv__engagement_time_minutes"), ltv("purchases").alias("user_ltv__purchases"),
        ltv("engaged_sessions").alias("user_ltv__engaged_sessions"), (ltv("session_duration_micros") / 1000000).alias("user_ltv__session_duration_seconds"),
        (ltv("session_duration_micros") / 60000000).alias("user_ltv__session_duration_minutes"),
        c("privacy_info.is_limited_ad_tracking").alias("privacy_info__is_limited_ad_tracking"), parse_ymd(c("last_updated_date")).alias("last_updated_date"))


def user_properties(rows: DataFrame) -> DataFrame:
    """User properties as (key, value) rows; the typed value becomes text."""
    c = F.col
    df = unnest(rows, "user_properties", "up")
    value = F.coalesce(*[c(f"up.value.{f}_value").cast("string") for f in ("string", "int", "float", "double")])
    return df.select(
        parse_ymd(c("event_date")).alias("event_date"), F.timestamp_micros("event_timestamp").alias("event_timestamp"), "user_id", "user_pseudo_id",
        c("up.key").alias("user_property__key"), value.alias("user_property__value"))
