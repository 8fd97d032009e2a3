"""Event stream plans: identity stitching, pivoting, sessions, session enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.functions.dates import diff_seconds, micros_to_dt, parse_ymd
from martlib.functions.geo import region_of, target_flag
from martlib.functions.json_text import param, to_json_text
from martlib.functions.rules import attribute, canonical, channel_group
from martlib.functions.text import contains_text, initcap_words, mask_generated, split_at, surrogate_key
from martlib.functions.urls import CAMPAIGN_PARAMS, add_page_groups, campaign_params, url_parts
from martlib.operators.aggregates import group_by_all, string_agg, summarize
from martlib.operators.joins import lookup_flag
from martlib.operators.ordered import Lag, LastValue, Lead, RunningCount, Total, chained, join_null_safe, ordered
from martlib.operators.windows import fill_nulls, keep_first, spread_null_key
from martlib.plans.common import (
    EMPTY_SESSION_ID, EMPTY_USER_ID, EMPTY_USER_PSEUDO_ID, EVENT_DIMENSIONS, EVENT_KEYS, FIRST_EVENTS, MARKETING_DIMENSIONS,
    PROFILE_PATHS, SESSION_OPENERS,
)
from martlib.session import cut_lineage, small_side

# Event fields that make up an event id, next to the text of its parameters.
EVENT_ID_FIELDS = [
    "user_pseudo_id", "ga_session_id", "event_name", "event_timestamp", "event_bundle_sequence_id", "batch_page_id",
    "batch_ordering_id", "batch_event_index",
]


def flatten_event(raw: DataFrame) -> DataFrame:
    """Struct leaves as ``parent__child`` columns and the parameters that stitching and sessions need.

    These rows are written and moved, so they hold no copy of what follows from the parameters alone.
    """
    p = F.col("event_params")
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    geo = {f"geo__{c}": blank(f"geo.{c}") for c in ("city", "country", "continent", "region", "sub_continent")}
    device = {f"device__{c}": F.col(f"device.{c}") for c in ("category", "operating_system", "language")}
    device["device__browser"] = F.coalesce("device.web_info.browser", "device.browser")
    return raw.withColumns({
        "ga_session_id": param(p, "ga_session_id", "int_value"),
        "ga_session_number": param(p, "ga_session_number", "int_value"),
        "session_engaged": param(p, "session_engaged", "int_value"),
        "batch_ordering_id": F.coalesce(F.col("batch_ordering_id"), param(p, "batch_ordering_id", "int_value")),
        "batch_page_id": F.coalesce(F.col("batch_page_id"), param(p, "batch_page_id", "int_value")),
        "engagement_time_msec": F.coalesce(
            param(p, "engagement_time_msec", "float_value"), param(p, "engagement_time_msec", "int_value").cast("double")
        ),
        **geo,
        **device,
        "event_date_key": F.col("event_date"),
        "event_date": parse_ymd(F.col("event_date")),
    }).drop("geo", "device", "user_properties")


def identity_columns(dimensions: Sequence[str]) -> dict[str, Column]:
    """The id derived for visitors without one, and the key under which a visitor's rows share their earliest one."""
    hashed = F.concat(F.lit("_"), surrogate_key(*[c for c in dimensions if c not in ("geo__region", "geo__city")]))
    known = F.concat(
        F.coalesce("user_id", F.lit("-")), F.coalesce("user_pseudo_id", F.lit("-")), F.coalesce(F.col("ga_session_id").cast("string"), F.lit("-"))
    )
    return {
        "derived_id": F.when(F.col("user_id").isNull() | F.col("user_pseudo_id").isNull(), hashed),
        "merge_key": F.nullif(known, F.lit("---")),
    }


EARLIEST = ["event_timestamp", "event_id"]


def first_seen(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Derived id and dimensions of the earliest row of each visitor key, among rows of a device.

    Mergeable: the earliest of several such tables is that of all their rows.
    """
    seen = df.filter(F.col("user_pseudo_id").isNotNull())
    return keep_first(seen.select("merge_key", "derived_id", *dimensions, *EARLIEST), ["merge_key"], EARLIEST)


def stitch_identity(df: DataFrame, dimensions: Sequence[str], split: bool, visitors: DataFrame | None = None) -> DataFrame:
    """Fill user ids within a device, derive ids for visitors without any, take dimensions from a visitor's earliest row.

    ``visitors`` are the earliest rows known (see ``first_seen``), where ``df`` does not hold all rows of a visitor.
    """
    df = df.withColumns({**identity_columns(dimensions), "user_id": F.when(F.col("user_pseudo_id").isNotNull(), F.col("user_id"))})
    # Only rows of a device can get a user id, so a visitor's earliest row is
    # chosen among them before anything is filled.
    first = first_seen(df, dimensions) if visitors is None else visitors
    first = first.select("merge_key", F.col("derived_id").alias("__id"), *[F.col(c).alias(f"__{c}") for c in dimensions])
    # rows of no device cannot be filled and are kept out of each other's group
    df = spread_null_key(df, "user_pseudo_id", "event_id", "__device")
    # the filled id depends on these columns alone, so the windows run on their distinct rows and the events are joined once
    at = ["__device", "ga_session_id", "event_date", "event_datetime_utc", "__own"]
    df = df.withColumnRenamed("user_id", "__own")
    filled = df.select(*at).distinct().withColumn("user_id", F.col("__own"))
    scopes = [["__device", "ga_session_id", "event_date"], ["__device", "event_date"]]
    filled = fill_nulls(filled, "user_id", scopes, "event_datetime_utc", "both", split=split)
    df = join_null_safe(df, filled, at).drop("__own")
    out = df.drop("__device").join(first, "merge_key", "left")
    own = F.coalesce("__id", "derived_id")
    out = out.withColumns({
        "is_user_id_generated": F.col("user_id").isNull() & own.isNotNull(),
        "is_user_pseudo_id_generated": F.col("user_pseudo_id").isNull() & own.isNotNull(),
        "user_id": F.coalesce("user_id", own),
        "user_pseudo_id": F.coalesce("user_pseudo_id", own),
        **{c: F.coalesce(F.col(f"__{c}").cast("string"), F.col(c).cast("string")) for c in dimensions},
    })
    return out.drop("__id", "derived_id", "merge_key", *[f"__{c}" for c in dimensions])


def add_attribution(df: DataFrame, objectives: DataFrame, own_sites: Sequence[tuple[str, str]] = (), strict: bool = True) -> DataFrame:
    """Marketing columns from campaign tags, event parameters and traffic sources.

    ``own_sites`` are (substring, name) pairs for the deployment's own referrers.
    """
    c, p = F.col, F.col("event_params")
    told = {"param_source": "source", "param_medium": "medium", "param_campaign": "campaign", "page_url": "page_location"}
    df = df.withColumns({name: param(p, key, "string_value") for name, key in told.items()})
    df = df.select("*", *campaign_params(c("page_url"), CAMPAIGN_PARAMS))
    fields = {
        "source": [c("param_source"), c("traffic_source.source"), c("collected_traffic_source.manual_source")],
        "medium": [c("param_medium"), c("traffic_source.medium"), c("collected_traffic_source.manual_medium")],
        "campaign": [c("param_campaign"), c("traffic_source.name"), c("collected_traffic_source.manual_campaign_name")],
    }
    df = df.withColumns({f"marketing_{f}": attribute(c(f"utm_{f}"), cand, strict) for f, cand in fields.items()})
    extra = [(contains_text(c("marketing_source"), part), name) for part, name in own_sites]
    df = df.withColumn("marketing_source", canonical(c("marketing_source"), extra=extra))
    lookup = small_side(objectives.select(c("campaign").alias("__campaign"), c("objective").alias("__objective")).distinct())
    df = df.join(lookup, c("marketing_campaign") == c("__campaign"), "left")
    df = df.withColumn("marketing_objective", F.coalesce("marketing_objective", "__objective"))
    df = df.withColumn("marketing_campaign_group", F.concat("marketing_objective", F.lit(" "), "marketing_source"))
    return df.drop("__campaign", "__objective", "utm_source", "utm_medium", "utm_campaign", "param_source", "param_medium", "param_campaign", "page_url")


def assign_sessions(df: DataFrame, prior_sessions: DataFrame | None, split: bool) -> DataFrame:
    """Session ids, the session date (kept from earlier loads), number and engaged flag."""
    c = F.col
    generated = c("is_user_pseudo_id_generated")
    df = df.withColumns({
        "session_id": F.concat("user_pseudo_id", F.coalesce(c("ga_session_id").cast("string"), c("event_date_key"))),
        "__opens": F.when(c("event_name") == "session_start", 0).otherwise(1),
    })
    # only visitors with derived ids need a numbered session; the number depends on these columns alone, an event that repeats counts once
    at = ["session_id", "event_datetime_utc", "__opens", "event_id"]
    starts = df.where(generated).select(*at, "event_name").distinct()
    starts = ordered(starts, ["session_id"], at[1:], {"__n": RunningCount(c("event_name") == "session_start")}, split=split)
    df = join_null_safe(df, starts.select(*at, "__n"), at)
    numbered = F.concat_ws("_", "user_pseudo_id", c("event_date").cast("string"), c("__n").cast("string"))
    df = df.withColumn("session_id", F.when(generated, numbered).otherwise(c("session_id"))).drop("__n", "__opens")
    df = spread_null_key(df, "session_id", "event_id", "__s")
    df = ordered(df, ["__s"], [], {
        "session_date": Total("min", c("event_date")),
        "ga_session_number": Total("min", c("ga_session_number")),
        "session_engaged": Total("max", c("session_engaged")),
    }, split=split).drop("__s")
    if prior_sessions is not None:
        known = prior_sessions.groupBy("session_id").agg(F.min("session_date").alias("__known"))
        df = df.join(known, "session_id", "left")
        df = df.withColumn("session_date", F.coalesce("__known", "session_date")).drop("__known")
    return df.withColumns({
        "ga_session_number": F.coalesce("ga_session_number", F.lit(1)),
        "session_engaged": F.coalesce("session_engaged", F.lit(0)),
    })


def identified_sessions(
    df: DataFrame, prior_sessions: DataFrame | None, dimensions: Sequence[str], split: bool, visitors: DataFrame | None = None,
) -> DataFrame:
    """Stitched identities and sessions of prepared events that were written (see ``cut_lineage``).

    Both need a few columns only, so the many shuffles of stitching and numbering
    move these and the number of the row; parameters and structs are joined once, at the end.
    """
    df = numbered_rows(df)
    found, thin = _identities(df, prior_sessions, dimensions, split, visitors)
    return df.drop(*found).join(thin, "__row").drop("__row")


def numbered_rows(df: DataFrame) -> DataFrame:
    """Rows with a number of their own, by which narrow results are joined; they have been or are about to be written."""
    return df if "__row" in df.columns else df.withColumn("__row", F.monotonically_increasing_id())


def _identities(
    df: DataFrame, prior_sessions: DataFrame | None, dimensions: Sequence[str], split: bool, visitors: DataFrame | None,
) -> tuple[list[str], DataFrame]:
    """The columns of ``df`` that stitching and numbering replace, and what they found for each ``__row``."""
    found = ["user_id", "user_pseudo_id", *dimensions, "ga_session_number", "session_engaged"]
    read = ["event_id", "event_name", "event_timestamp", "event_datetime_utc", "event_date", "event_date_key", "ga_session_id"]
    thin = df.select(*dict.fromkeys(["__row", *read, *found]))
    # numbering reads the stitched rows several times
    thin = assign_sessions(cut_lineage(stitch_identity(thin, dimensions, split, visitors)), prior_sessions, split)
    added = ["is_user_id_generated", "is_user_pseudo_id_generated", "session_id", "session_date"]
    return found, thin.select("__row", *found, *added)


def merge_repeats(df: DataFrame) -> DataFrame:
    """Rows that are equal in all columns as one, with their number in ``__copies``."""
    return group_by_all(df, {"__copies": F.count(F.lit(1))})


def explode_params(merged: DataFrame) -> DataFrame:
    """One row per event and parameter key, of events that were merged (see ``merge_repeats``).

    Repeated events are merged before the arrays are opened, so their shuffle
    moves events and not their parameters; keys repeated inside an event are
    merged in place.
    """
    params, keys = F.col("event_params"), F.col("event_params.key")
    fields = merged.schema["event_params"].dataType.elementType["value"].dataType.fieldNames()

    def combined(k: Column) -> Column:
        same = F.filter(params, lambda p: p["key"].eqNullSafe(k))
        largest = lambda f: F.array_max(F.transform(same, lambda p: p["value"][f])).alias(f)
        return F.struct(k.alias("key"), F.struct(*[largest(f) for f in fields]).alias("value"))

    # lambdas are evaluated only for the rare event in which a key repeats
    distinct = F.array_distinct(keys)
    opened = F.when(F.size(distinct) < F.size(keys), F.transform(distinct, combined)).otherwise(params)
    # all that depends on the event alone is computed beside the array, so that the opening itself is compiled and copies no array
    timed = F.size(keys) - F.size(F.array_remove(keys, F.lit("engagement_time_msec")))
    rows = merged.withColumns({"__opened": opened, "__repeats": timed, "__json": to_json_text(params)}).drop("event_params")
    rows = rows.select("*", F.inline("__opened").alias("event_key", "__value"))
    value, msec = F.col("__value"), F.col("engagement_time_msec") * F.col("__copies") * F.col("__repeats")
    rows = rows.withColumns({
        "event__string_value": value["string_value"],
        "event__int_value": F.when(F.col("event_key") == "engagement_time_msec", msec).otherwise(value["int_value"].cast("double")),
        "event__double_value": F.coalesce(value["double_value"], value["float_value"]),
    })
    key_fields = ["user_id", *EVENT_ID_FIELDS, "__json", "event_key"]
    return rows.withColumn("event_params_key_id", surrogate_key(*key_fields)).drop(
        "__copies", "__value", "__opened", "__repeats", "__json", "engagement_time_msec", "event_date_key"
    )


def prepare_events(events: DataFrame) -> DataFrame:
    """Flattened events with their id, time and sort key."""
    return flatten_event(events).withColumns({
        "event_id": surrogate_key(*EVENT_ID_FIELDS, to_json_text(F.col("event_params"))),
        "event_datetime_utc": micros_to_dt(F.col("event_timestamp")),
        "batch_sort_key": F.col("batch_page_id") * 100 + F.col("batch_ordering_id") * 10 + F.col("batch_event_index"),
    })


def unnest_events(
    events: DataFrame, prior_sessions: DataFrame | None = None, objectives: DataFrame | None = None, *,
    dimensions: Sequence[str] = tuple(EVENT_DIMENSIONS), own_sites: Sequence[tuple[str, str]] = (), strict: bool = True,
    split: bool = True,
) -> DataFrame:
    """Nested raw events to long rows with stitched identities, sessions and attribution.

    ``split=False`` gives plain windows, for devices that are known to be small.
    """
    # the flattened events are read by every step of stitching and numbering
    return unnest_prepared(
        cut_lineage(prepare_events(events)), prior_sessions, objectives, dimensions=dimensions, own_sites=own_sites, strict=strict, split=split)


def unnest_prepared(
    df: DataFrame, prior_sessions: DataFrame | None = None, objectives: DataFrame | None = None, *,
    dimensions: Sequence[str] = tuple(EVENT_DIMENSIONS), own_sites: Sequence[tuple[str, str]] = (), strict: bool = True,
    split: bool = True, visitors: DataFrame | None = None,
) -> DataFrame:
    """``unnest_events`` from prepared events that were written; ``visitors`` as for ``stitch_identity``."""
    dimensions = list(dimensions)
    if objectives is None:
        objectives = df.sparkSession.createDataFrame([], "campaign string, objective string")
    df = numbered_rows(df)
    found, thin = _identities(df, prior_sessions, dimensions, split, visitors)
    lookups = cut_lineage(objectives.select("campaign", "objective").distinct())

    def finished(events: DataFrame) -> DataFrame:
        out = add_attribution(events.drop(*found).join(thin, "__row").drop("__row"), lookups, own_sites, strict)
        structs = [c for c in ("traffic_source", "collected_traffic_source") if c in out.columns]
        if "privacy_info" in out.columns:
            out = out.select("*", *[F.col(f"privacy_info.{f}").alias(f"privacy_info__{f}") for f in out.schema["privacy_info"].dataType.fieldNames()])
            structs.append("privacy_info")
        return out.drop(*structs)

    # Rows that are equal in the end have one event id, so only events whose id occurs several times are compared as a whole.
    # A hash tells them: where ids of one hash differ, their rows are compared and stay apart.
    alike = F.xxhash64("event_id")
    several = cut_lineage(df.groupBy(alike.alias("__alike")).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__alike"))
    alone = F.lit(1).cast("long").alias("__copies")
    if several.isEmpty():
        return explode_params(finished(df).select("*", alone))
    side = small_side(several)
    once = finished(df.join(side, alike == F.col("__alike"), "left_anti")).select("*", alone)
    merged = merge_repeats(finished(df.join(side, alike == F.col("__alike"), "left_semi")))
    return explode_params(once.unionByName(merged))


def _clean_tab(tab: Column) -> Column:
    return initcap_words(F.trim(F.replace(F.replace(tab, F.lit("-"), F.lit(" ")), F.lit("_"), F.lit(" "))))


def cut_title(title: Column) -> Column:
    """Page title up to the first pipe."""
    return F.when(title.contains("|"), F.trim(split_at(title, "|", 0))).otherwise(title)


def pivot_long(long: DataFrame, keys: Sequence[str] = tuple(EVENT_KEYS)) -> DataFrame:
    """Long rows to one row per event: one column per key, engagement seconds summed."""
    msec = F.when(F.col("event_key") == "engagement_time_msec", F.coalesce("event__double_value", "event__int_value"))
    src = long.withColumn("engagement_time_seconds", F.round(msec / 1000, 4))
    dropped = ["event_key", "event__string_value", "event__int_value", "event__double_value", "event_params_key_id", "engagement_time_seconds"]
    aggs = {"engagement_time_seconds": F.sum("engagement_time_seconds")}
    # rows that meet have one event time, so the latest value is the largest, and no struct is made of each long row and key
    for k in keys:
        aggs[k] = F.max(F.when(F.col("event_key") == k, F.col("event__string_value")))
    return group_by_all(src, aggs, drop=dropped)


def fix_page_values(df: DataFrame) -> DataFrame:
    """Default tabs of profile pages, known misspellings, plain page titles."""
    c = F.col
    no_tab_event = (c("event_name") != "profile_interactions") | F.lower("entity_type").like("%tabs")
    tab = F.when(no_tab_event & c("grouped_page_path").isin(*PROFILE_PATHS) & c("tab").isNull(), "overview").otherwise(c("tab"))
    section = F.when(c("section") == "Description Cleantech More", "Description Read More").otherwise(c("section"))
    entity = F.when(c("entity_type") == "Moltinational Tabs", "Multinational Tabs").otherwise(c("entity_type"))
    return df.withColumns({
        "tab": _clean_tab(tab), "section": initcap_words(section), "entity_type": initcap_words(entity), "page_title": cut_title(c("page_title")),
    })


def rank_page_views(df: DataFrame, split: bool, empty_session: str = EMPTY_SESSION_ID) -> DataFrame:
    """Page-view rank inside a session and engagement per page view.

    Ranks need a few columns only: the events are written once, and what is found is joined by the number of the row.
    """
    if not split:
        return _with_ranks(df, split, empty_session)
    df = cut_lineage(df).withColumn("__row", F.monotonically_increasing_id())
    read = ["event_id", "event_name", "session_id", "event_datetime_utc", "batch_sort_key", "page_path", "engagement_time_seconds"]
    found = ["previous_page_path", "page_view_rank", "engagement_time_seconds_lead", "page_view_engagement_time_seconds"]
    thin = _with_ranks(df.select("__row", *read), split, empty_session)
    return df.drop(*found).join(thin.select("__row", *found), "__row").drop("__row")


def _with_ranks(df: DataFrame, split: bool, empty_session: str) -> DataFrame:
    c = F.col
    order = ["event_datetime_utc", "batch_sort_key", "event_id"]
    df = spread_null_key(df, "session_id", "event_id", "__s")
    moved = c("page_path").isNotNull() & (c("previous_page_path").isNull() | (c("page_path") != c("previous_page_path")))
    df = chained(df, ["__s"], order, [{"previous_page_path": Lag(c("page_path"))}, {"page_view_rank": RunningCount(moved)}], split=split)
    rank = F.when(c("event_name").isin(*SESSION_OPENERS), 1).when(c("session_id").isNotNull(), c("page_view_rank"))
    df = df.withColumn("page_view_rank", rank.cast("long"))

    real = c("session_id").isNotNull() & (c("session_id") != empty_session)
    # sessions without an id do not take part, so their rows need not meet
    df = spread_null_key(df, "session_id", "event_id", "__s", empty=empty_session)
    df = ordered(df, ["__s", "page_view_rank"], ["batch_sort_key", "event_datetime_utc", "event_id"], {
        "engagement_time_seconds_lead": Lead(c("engagement_time_seconds")),
        "page_view_engagement_time_seconds": Total("sum", c("engagement_time_seconds")),
    }, split=split)
    return df.withColumns({
        n: F.when(real, c(n)) for n in ("engagement_time_seconds_lead", "page_view_engagement_time_seconds")
    }).drop("__s")


def pivot_events(long: DataFrame, *, split: bool = True, empty_session: str = EMPTY_SESSION_ID) -> DataFrame:
    """One row per event with page fields, page-view rank and engagement."""
    df = fix_page_values(add_page_groups(url_parts(pivot_long(long))))
    return keep_first(rank_page_views(df, split, empty_session), ["event_id"], ["-user_id"])


def event_rows(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long rows of sessions merged to one row per event: its ``keys``, landing page and engagement.

    Least values of texts and structs are found by sorting; sums are not, so here a
    hash aggregate leaves few rows to be sorted. An event that landed has a second row.
    """
    c = F.col
    landing = F.when((c("event_name") == "session_start") & (c("event_key") == "page_location"), c("event__string_value"))
    msec = F.when(c("event_key") == "engagement_time_msec", c("event__int_value"))
    read = dict.fromkeys([*keys, "event_id", "event_name", "event_datetime_utc", "user_id"])
    return long.groupBy(*read, landing.alias("landing_page")).agg(F.sum(msec).alias("engagement_msec"))


def session_measures(empty_user: str = EMPTY_USER_ID) -> dict[str, tuple[Column, str]]:
    """Measures of a session: the expression over its rows from ``event_rows``, and the aggregate that also merges finished parts.

    ``first`` keeps the value with the smallest time as a (time, value) struct.
    """
    c = F.col
    t = c("event_datetime_utc")
    timed = lambda v: F.when(v.isNotNull(), F.struct(t.alias("o"), v.alias("v")))
    return {
        "first_user": (timed(F.nullif("user_id", F.lit(empty_user))), "min"),
        "has_first_event": (c("event_name").isin(*FIRST_EVENTS), "bool_or"),
        "session_min_event_datetime": (t, "min"),
        "session_max_event_datetime": (t, "max"),
        "engagement_msec": (c("engagement_msec"), "sum"),
        "first_landing": (timed(c("landing_page")), "min"),
    }


def session_metrics(measured: DataFrame) -> DataFrame:
    """Metric columns from the aggregated measures."""
    c = F.col
    return measured.select(
        "user_pseudo_id", "session_id", "session_date", c("first_user.v").alias("user_id"), c("has_first_event").alias("is_new_user"),
        (~c("has_first_event")).alias("is_returning_user"), "session_min_event_datetime", "session_max_event_datetime",
        diff_seconds(c("session_max_event_datetime"), c("session_min_event_datetime")).alias("session_duration"),
        F.coalesce(c("engagement_msec") / 1000, F.lit(0.0)).alias("session_engagement_time"), c("first_landing.v").alias("landing_page"),
    )


def finish_sessions(
    metrics: DataFrame, dims: DataFrame, funnel: DataFrame, bot_days: DataFrame, regions: Sequence[tuple[str, Sequence[str]]], home: str,
) -> DataFrame:
    """Metrics, dimensions and event funnel of each session, joined, with market columns and the suspected-bot flag."""
    c = F.col
    country = c("geo__country")
    dims = dims.withColumns({
        "market_region": region_of(country, regions) if regions else F.lit(None).cast("string"),
        "target_market": target_flag(country),
        "is_home_country": country == home,
    })
    out = metrics.join(dims, "session_id", "left").join(funnel, "session_id", "left")
    on = [(c("session_date"), "date_day"), (F.coalesce(F.lower("geo__country"), F.lit("unknown")), "country")]
    out = lookup_flag(out, bot_days, on, "suspected_fraud")
    return out.select(surrogate_key("session_id", "session_date").alias("record_id"), *out.columns)


def build_sessions(
    long: DataFrame, bot_days: DataFrame, *, dimensions: Sequence[str] = tuple(EVENT_DIMENSIONS),
    marketing: Sequence[str] = tuple(MARKETING_DIMENSIONS), regions: Sequence[tuple[str, Sequence[str]]] = (), home: str = "Israel",
    empty_user: str = EMPTY_USER_ID, empty_session: str = EMPTY_SESSION_ID,
) -> DataFrame:
    """One row per (device, session, session date) with metrics, event funnel, dimensions and the suspected-bot flag.

    ``bot_days`` holds (date_day, country) with the country in lower case.
    """
    c = F.col
    ev = long.filter(c("session_id") != empty_session)
    t = "event_datetime_utc"
    measures = {n: getattr(F, fn)(e) for n, (e, fn) in session_measures(empty_user).items()}
    key = ["user_pseudo_id", "session_id", "session_date"]
    metrics = session_metrics(summarize(event_rows(ev, key), key, measures))
    steps = ev.select("event_id", "session_id", t, "event_name").distinct()
    funnel = string_agg(steps, ["session_id"], "event_name", [t, "event_id"], "session_events")

    # Every event of a session meets every metrics row of it, so the longest
    # duration cannot tell its events apart: paid traffic first, then the latest.
    dims = ev.select("session_id", t, "event_id", *dimensions, *marketing)
    dims = dims.withColumn("channel_grouping", channel_group(c("marketing_source"), c("marketing_medium")))
    dims = dims.withColumn("__unpaid", F.when(F.lower("channel_grouping").contains("paid"), 1).otherwise(2))
    dims = keep_first(dims, ["session_id"], ["__unpaid", f"-{t}", "event_id"]).drop("__unpaid", t, "event_id")
    return finish_sessions(metrics, dims, funnel, bot_days, regions, home)


def best_user_record(users: DataFrame, key: str = "user_id") -> DataFrame:
    """The registered, confirmed, earliest record per user."""
    order = ["-is_user_registered", "-is_user_confirmed", "user_signup_date", "signup_start_datetime"]
    rest = [c for c in ("user_pseudo_id", "record_id") if c in users.columns]
    return keep_first(users, [key], [*order, *rest])


def enrich_sessions(
    sessions: DataFrame, users: DataFrame, *, user_columns: Sequence[str], power_sessions: int = 25, power_since: int = 2024,
    split: bool = True, empty_user: str = EMPTY_USER_ID, empty_pseudo: str = EMPTY_USER_PSEUDO_ID, empty_session: str = EMPTY_SESSION_ID,
) -> DataFrame:
    """Sessions with the user of a later session of the same device, user attributes and the power-user flag."""
    c = F.col
    ids = {"user_id": F.nullif("user_id", F.lit(empty_user)), "user_pseudo_id": F.nullif("user_pseudo_id", F.lit(empty_pseudo))}
    df = sessions.withColumns(ids)
    df = ordered(df, ["user_pseudo_id"], ["-session_min_event_datetime"], {"__later": LastValue(c("user_id"))}, split=split)
    fill = F.when(c("user_id").isNull() & (c("session_id") != empty_session), c("__later"))
    df = df.withColumn("user_id", F.coalesce("user_id", fill)).drop("__later")
    df = df.withColumn("__merge", F.coalesce("user_id", "user_pseudo_id"))

    best = best_user_record(users.withColumns(ids))
    best = best.select(F.coalesce("user_id", "user_pseudo_id").alias("__merge"), *user_columns)
    df = df.join(best, "__merge", "left").drop("__merge").withColumn("user_id", mask_generated(c("user_id")))

    counts = df.filter(c("user_id").isNotNull()).groupBy("user_id").agg(F.count_distinct("session_id").alias("__n"))
    df = df.join(counts, "user_id", "left")
    power = F.when(c("user_id").isNotNull() & (F.year("session_date") >= power_since), c("__n") >= power_sessions)
    return df.withColumn("is_power_user", power).drop("__n")
