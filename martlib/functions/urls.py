"""URL parsing and page grouping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.functions.rules import case
from martlib.functions.text import extract, initcap_words, replace_all, split_at, trim_chars

# Patterns of the parts of a page address.
PATH = r"https?://[^/]+(/[^?#]*)"
TAB = r"[&\?](?:section|tab)=([^\?&=]+)"
VIEW = r"[&\?]?view=([^\?&=]+)"
COMPANY = r"/\w+_page/([^/#?]+)"


def url_path(url: Column) -> Column:
    """Lower-cased path with doubled slashes reduced."""
    return F.replace(F.lower(extract(url, PATH)), F.lit("//"), F.lit("/"))


def url_query(url: Column) -> Column:
    """Query text after the first question mark (also an escaped one), separators cleaned."""
    raw = split_at(F.replace(url, F.lit("%3F"), F.lit("?")), "?", 1)
    return trim_chars(replace_all(raw, [("%3B", ";"), ("&amp;", "&")]), "&")


def url_parts(df: DataFrame, url: str = "page_location", referrer: str = "page_referrer") -> DataFrame:
    """Add referrer_path, page_path, page_query, tab, view and company_url_name."""
    u = F.col(url)
    return df.withColumns({
        "referrer_path": F.lower(extract(F.col(referrer), PATH)),
        "page_path": url_path(u),
        "page_query": url_query(u),
        "tab": F.lower(extract(u, TAB)),
        "view": F.lower(extract(u, VIEW)),
        "company_url_name": extract(u, COMPANY),
    })


def campaign_params(url: Column, names: Sequence[str] | dict[str, str]) -> list[Column]:
    """One column per query parameter; a dict renames parameter -> column."""
    pairs = names.items() if isinstance(names, dict) else [(n, n) for n in names]
    return [extract(url, f"[?&]{param}=([^&]+)").alias(name) for param, name in pairs]


# Query parameter -> column of the campaign fields.
CAMPAIGN_PARAMS = {
    "utm_source": "utm_source",
    "utm_medium": "utm_medium",
    "utm_campaign": "utm_campaign",
    "campID": "marketing_campaignid",
    "date": "marketing_date",
    "cmp": "marketing_company",
    "rgn": "marketing_region",
    "chn": "marketing_channel",
    "obj": "marketing_objective",
    "dtl": "marketing_details",
}


def url_host(url: Column) -> Column:
    """Host name, NULL when the text is no URL."""
    return F.try_parse_url(url, F.lit("HOST"))


# LIKE pattern of a path -> (group path, group name). As in LIKE, ``_``
# stands for any one character. Where a name is missing it follows from the path.
PAGE_GROUPS: list[tuple[str, str, str | None]] = [
    ("/reports/%", "/reports", "Reports"),
    ("/messaging%", "/messaging", "Messaging"),
    ("/startups/search%", "/startups/search", "Startups Search"),
    ("/company/search%", "/startups/search", "Startups Search"),
    ("/company_page/%", "/company_page", "Company Page"),
    ("/company/%", "/company_page", None),
    ("/user/savedsearches", "/user/savedsearches", "User Saved Searches"),
    ("/about-us", "/about/about-us", "About Us"),
    ("/investors/search%", "/investors/search", "Investors Search"),
    ("/investor_page/%", "/investor_page", "Investor Page"),
    ("/investor/%", "/investor_page", None),
    ("/program_page/%", "/program_page", "Program Page"),
    ("/mnc_page/%", "/mnc_page", "MNC Page"),
    ("/user/profile%", "/user/profile", "User Profile"),
    ("/user/smartlist/%", "/user/smartlist", "Smart List (User)"),
    ("/user/watchlist/%", "/user/watchlist", "Watchlist (User)"),
    ("/watchlist/%", "/watchlist", "Watchlist"),
    ("/hubs/search%", "/hubs/search", "Hubs Search"),
    ("/multinationals/search%", "/multinationals/search", "Multinational Search"),
    ("/multinational/search%", "/multinationals/search", "Multinational Search"),
    ("/centralhub/%", "/centralhub", "Central Hub"),
]


def _matches(path: Column, pattern: str) -> Column:
    return path.like(pattern) if "%" in pattern or "_" in pattern else path == pattern


def page_group(path: Column, groups: Sequence[tuple[str, str, str | None]] = tuple(PAGE_GROUPS)) -> Column:
    """Grouped path: first matching rule, home for empty paths, else the first segment."""
    rules = [(_matches(path, p), group) for p, group, _ in groups]
    rules.append((path.isNull() | path.isin("", "/"), "/"))
    return case(rules, F.concat(F.lit("/"), split_at(path, "/", 1)))


def page_group_name(path: Column, groups: Sequence[tuple[str, str, str | None]] = tuple(PAGE_GROUPS)) -> Column:
    """Readable page group; rules without a name fall back to the capitalised first segment."""
    rules = [(_matches(path, p), name) for p, _, name in groups if name]
    rules.append((path.isNull() | (path == "") | (F.trim(path) == "/"), "Homepage"))
    return case(rules, initcap_words(split_at(path, "/", 1)))


def add_page_groups(df: DataFrame, columns: Sequence[str] = ("referrer_path", "page_path")) -> DataFrame:
    """Add ``grouped_<column>`` and ``grouped_<column without _path>_name``."""
    new = {}
    for c in columns:
        new[f"grouped_{c}"] = page_group(F.col(c))
        new[f"grouped_{c.removesuffix('_path')}_name"] = page_group_name(F.col(c))
    return df.withColumns(new)
