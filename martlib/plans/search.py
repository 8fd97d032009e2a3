"""Search plans: search sessions with filters, and the per-search summary."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlib.functions.dates import diff_seconds
from martlib.functions.json_text import json_pairs
from martlib.functions.numbers import array_text, try_int
from martlib.functions.rules import case, recode
from martlib.functions.text import decode_partial, drop_last, extract, initcap_words, mask_generated, split_at, surrogate_key
from martlib.operators.aggregates import array_distinct_sorted, max_by_nn, summarize, visited_items
from martlib.operators.ordered import Lag, LastValue, RunningCount, chained, ordered
from martlib.operators.sets import union_by_name
from martlib.operators.windows import keep_any, spread_null_key
from martlib.plans.common import EVENT_DIMENSIONS  # noqa: F401 - re-exported for callers building session sides
from martlib.session import cut_lineage, small_side

# Filter parameter in a search URL -> filter name.
SEARCH_FILTERS = {
    "semantic": "semantic", "page": "page", "status": "status", "sort": "sort", "searchname": "search_name", "alltags": "all_tags",
    "anytag": "any_tag", "excludetags": "exclude_tags", "sectorclassification": "sector_classification",
    "primarysectorclassification": "primary_sector_classification", "targetcustomer": "target_customer",
    "coretechnology": "core_technology", "fundingstages": "funding_stages", "lowerFoundedYear": "founded_year_min",
    "upperFoundedYear": "founded_year_max", "totalraisedmin": "total_raised_min", "totalraisedmax": "total_raised_max",
    "marketcapmin": "market_cap_min", "marketcapmax": "market_cap_max", "businessmodels": "business_models",
    "productstage": "product_stage", "employees": "employees", "location": "location", "fundingtype": "funding_type",
    "investmentstage": "investment_stage", "investmentrangemin": "investment_range_min", "investmentrangemax": "investment_range_max",
    "managedassetsmin": "managed_assets_min", "managedassetsmax": "managed_assets_max", "portfoliosizemin": "portfolio_size_min",
    "portfoliosizemax": "portfolio_size_max", "nationality": "nationality", "hubtype": "hub_type", "batchsize": "batch_size",
    "officetype": "office_type", "acquisitionsmin": "acquisitions_min", "acquisitionsmax": "acquisitions_max",
    "employeesworldwide": "employees_worldwide", "otheractivities": "other_activities", "forbesrankmin": "forbes_rank_min",
    "forbesrankmax": "forbes_rank_max",
}
# Parts of a semantic search that are no filters.
NOT_FILTERS = ["explain", "prompt_id", "type"]
# Longer values are ids of classification nodes.
ID_LENGTH = 20
_ORDER = ["event_datetime_utc", "batch_sort_key", "event_id"]


def _search_columns(events: DataFrame, home_site: str) -> DataFrame:
    c = F.col
    own = c("page_referrer").contains(home_site)
    search = c("page_path").endswith("/search")
    tab = case([(c("event_name") == "search_page_tabs", c("element_clicked")), (c("tab") == "Overview", None)], c("tab"))
    return events.withColumns({
        "is_from_main_page": c("page_referrer").isNull() | (own & (c("grouped_referrer_path") == "/")),
        "is_from_referrer": c("page_referrer").isNull() | ~own,
        "grouped_referrer_path": F.when(own, c("grouped_referrer_path")),
        "tab": initcap_words(F.replace(tab, F.lit("_"), F.lit(" "))),
        "is_search": search,
        "profile": F.when(search, split_at(c("grouped_page_path"), "/", 1)),
        "is_semantic_search": c("page_location").contains("semantic="),
        "semantic_search_id": extract(c("page_query"), r"[&\?]?semantic=([^\?&=]+)"),
    })


def rank_searches(events: DataFrame, gap_s: int = 180, split: bool = True) -> DataFrame:
    """Number the searches of a session.

    Repeats of the same page are dropped first. A search starts when the kind
    of search flips, the semantic search changes, or a filter search follows
    none, another path, another page, or a pause. Comparisons with unknown
    values do not start one.
    """
    c = F.col
    df = spread_null_key(events, "session_id", "event_id", "__s")
    last = {"__last_ts": "event_datetime_utc", "__last_path": "grouped_page_path", "__last_title": "page_title",
            "__last_semantic": "is_semantic_search", "__last_id": "semantic_search_id"}
    df = chained(df, ["__s"], _ORDER, [
        {"previous_page_title": Lag(c("page_title")), "previous_page_location": Lag(c("page_location"))},
        lambda d: d.filter(
            c("previous_page_location").isNull() | (c("page_location") != c("previous_page_location")) | (c("page_title") != c("previous_page_title"))
        ),
        {"__prev_search": Lag(c("is_search")), "__prev_ts": Lag(c("event_datetime_utc"))},
        (["is_search"], {n: Lag(c(v)) for n, v in last.items()}),
        lambda d: d.withColumns({n: F.when(c("is_search"), c(n)) for n in last}),
        (["is_semantic_search"], {"__known_id": LastValue(c("__last_id"), "rows")}),
        lambda d: d.withColumn("__known_id", F.when(c("is_semantic_search"), c("__known_id"))),
    ], split=split)

    t = c("event_datetime_utc")
    since_event = diff_seconds(t, c("__prev_ts"), "boundary")
    since_search = F.when(c("is_search"), diff_seconds(t, c("__last_ts"), "boundary"))
    plain = (
        since_search.isNull()
        | (c("grouped_page_path") != c("__last_path"))
        | ((c("page_title") != c("__last_title")) & (c("page_location") != c("previous_page_location")))
        | (since_search >= gap_s)
        | (~c("__prev_search") & (since_event >= gap_s))
    )
    starts = c("is_search") & (
        (c("is_semantic_search") != c("__last_semantic")) | (c("semantic_search_id") != c("__known_id")) | (~c("is_semantic_search") & plain)
    )
    # the range shuffle reads its rows twice
    df = cut_lineage(df.withColumn("__starts", starts).drop(*last, "__prev_search", "__prev_ts", "__known_id")) if split else df.withColumn("__starts", starts)
    df = ordered(df, ["__s"], _ORDER[:2], {"search_rank": RunningCount(c("__starts"), "range")}, split=split)
    df = df.withColumn("search_id", F.concat(c("session_id"), F.lit("_"), c("session_date").cast("string"), F.lit("_"), c("search_rank").cast("string")))
    helpers = [*last, "__s", "__starts", "__prev_search", "__prev_ts", "__known_id", "search_rank", "previous_page_title", "previous_page_location"]
    return df.drop(*helpers)


def url_filters(searches: DataFrame, filters: Sequence[str] = tuple(SEARCH_FILTERS)) -> DataFrame:
    """(event_id, filter_name, filter_value) from the query text; each pair once per event."""
    c = F.col
    parts = searches.select("event_id", F.explode_outer(F.split("page_query", "&")).alias("qp"))
    named = parts.select("event_id", split_at(c("qp"), "=", 0).alias("filter_name"), decode_partial(split_at(c("qp"), "=", 1)).alias("v"))
    kept = named.filter(c("filter_name").isNull() | c("filter_name").isin(*filters))
    values = kept.select("event_id", "filter_name", F.explode_outer(F.split("v", r"\|")).alias("filter_value"))
    return keep_any(values, ["event_id", "filter_name", "filter_value"])


def search_sessions(
    events: DataFrame, semantic: DataFrame, classes: DataFrame, sessions: DataFrame, *, session_columns: Sequence[str] = (),
    home_site: str = "example.com", gap_s: int = 180, filters: Mapping[str, str] | None = None, split: bool = True, id_length: int = ID_LENGTH,
) -> DataFrame:
    """One row per search event and filter, with the profiles and tabs seen during the search.

    ``semantic`` holds (id, user_input, ai_analysis, filters as JSON), ``classes``
    (classification_id, classification_name, root_key).
    """
    c = F.col
    filters = dict(SEARCH_FILTERS if filters is None else filters)
    # three branches read the ranked events, so they are written once
    ranked = cut_lineage(rank_searches(_search_columns(events, home_site), gap_s, split))

    plain = ranked.filter(~c("is_semantic_search"))
    pairs = url_filters(plain.filter("is_search"), list(filters))
    plain = plain.join(pairs, "event_id", "left")
    # values and JSON objects are opened only for semantic searches
    side = semantic.select(c("id").alias("__sid"), c("user_input").alias("semantic_user_input"), c("ai_analysis").alias("semantic_ai_analysis"), json_pairs(c("filters")).alias("__pairs"))
    ai = ranked.filter(c("semantic_search_id").isNotNull()).join(side, c("semantic_search_id") == c("__sid"), "left")
    ai = ai.select("*", F.inline("__pairs")).drop("__sid", "__pairs").filter(~c("filter_name").isin(*NOT_FILTERS))
    both = union_by_name(ai, plain)
    both = both.withColumn("__class", F.when(F.length("filter_value") > id_length, c("filter_value")))

    nodes = classes.select(c("classification_id").alias("__class"), "classification_name", c("root_key").alias("__root"))
    nodes = nodes.withColumn("__root", F.nullif("__root", c("__class")))
    roots = classes.select(c("classification_id").alias("__root"), c("classification_name").alias("classification_parent_name"))
    named = both.join(small_side(nodes), "__class", "left").join(small_side(roots), "__root", "left").drop("__class", "__root")

    seen = visited_items(both, "search_id", "company_url_name", "event_datetime_utc", "profiles")
    tabs = visited_items(both, "search_id", "tab", "event_datetime_utc", "tabs")
    seen = seen.withColumnRenamed("profiles_list", "profiles_viewed")
    tabs = tabs.withColumnRenamed("tabs_list", "tabs_clicked")
    # only searches are kept; filtering here leaves fewer rows for the joins
    shown = named.filter(c("is_search") & ~c("is_from_main_page") & c("grouped_page_path").like("%/search"))
    extra = sessions.select("session_id", "session_date", c("user_id").alias("__user"), c("session_date").alias("__date"), *session_columns)
    out = shown.drop("company_url_name", "tab", *(["user_id"] if "user_id" in shown.columns else []))
    out = out.join(seen, "search_id", "left").join(tabs, "search_id", "left").join(extra, ["session_id", "session_date"], "left")

    key = surrogate_key("event_date", "session_id", "event_id", "filter_name", "filter_value")
    profile = case([
        (c("profile") == "startups", "company"), (c("profile").endswith("s"), drop_last(c("profile"), 1)),
    ], c("profile"))
    out = out.withColumns({"record_id": key, "profile": initcap_words(profile), "filter_name": recode(c("filter_name"), filters, c("filter_name"))})
    targets = list(filters.values())
    short = F.when(c("filter_name").rlike("_(min|max)$") & c("filter_name").isin(*targets), drop_last(c("filter_name"), 4)).otherwise(c("filter_name"))
    return out.withColumns({
        "date_day": F.coalesce("__date", "event_date"),
        "user_id": mask_generated(c("__user")),
        "filter": initcap_words(F.replace(short, F.lit("_"), F.lit(" "))),
    }).drop("__user", "__date", "is_search", "event_date")


# Filters shown per search as value lists and counts.
CATEGORY_FILTERS = [
    "sort", "search_name", "all_tags", "any_tag", "exclude_tags", "funding_stage", "business_models", "product_stage", "employees",
    "funding_type", "investment_stage", "nationality", "hub_type", "batch_size", "office_type", "employees_worldwide",
]
CLASS_FILTERS = ["sector_classification", "primary_sector_classification", "target_customer", "core_technology"]


def search_summary(
    filters: DataFrame, sessions: DataFrame, *, session_columns: Sequence[str] = (),
    category_filters: Sequence[str] = tuple(CATEGORY_FILTERS), class_filters: Sequence[str] = tuple(CLASS_FILTERS),
) -> DataFrame:
    """One row per search: pages seen, profiles and tabs, distinct values and counts per filter.

    Distinct values come as sorted texts. Rows of one search are reduced to
    distinct (filter, value) pairs by the set aggregates before the shuffle.
    """
    c = F.col
    src = filters.filter(c("filter_name").isNotNull())
    keys = [
        "date_day", "user_id", "user_pseudo_id", "session_id", "search_id", "profile", "is_semantic_search", "semantic_search_id",
        "semantic_user_input", "semantic_ai_analysis",
    ]
    t = "event_datetime_utc"
    aggs = {
        "search_started_datetime": F.min(t),
        **{n: max_by_nn(n, t) for n in ("profiles_viewed", "profiles_arr", "tabs_clicked", "tabs_arr")},
        **{n: F.max(n) for n in ("profiles_unique_count", "profiles_total_count", "tabs_unique_count", "tabs_total_count")},
    }
    shown = [(f, f, "filter_value") for f in category_filters]
    for f in class_filters:
        shown += [(f, f, "classification_name"), (f"{f}_parent", f, "classification_parent_name")]
    for name, f, value in shown:
        aggs[f"__{name}"] = array_distinct_sorted(F.when(c("filter_name") == f, c(value)))
    page = F.when(c("filter_name") == "page", try_int(c("filter_value")))
    pages = summarize(src, ["search_id"], {"__pages": array_distinct_sorted(page)})
    out = summarize(src, keys, aggs).join(pages, "search_id", "left")
    lists = {}
    for name, _, _ in shown:
        lists[name] = array_text(c(f"__{name}"))
        lists[f"{name}_count"] = F.size(f"__{name}").cast("long")
    out = out.withColumns({**lists, "search_pages": array_text(c("__pages")), "search_page_count": F.size("__pages").cast("long")})
    out = out.drop("__pages", *[f"__{name}" for name, _, _ in shown])
    extra = sessions.select("session_id", c("session_date").alias("date_day"), *session_columns)
    out = out.join(extra, ["session_id", "date_day"], "left")
    return out.withColumn("record_id", surrogate_key("date_day", "search_id"))
