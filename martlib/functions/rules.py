"""Ordered label rules: recoding, channel grouping, attribution, event taxonomies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlib.functions.text import contains, contains_text, trim_chars


def case(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """First rule whose condition is true wins; ``default`` otherwise."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    out = None
    for cond, label in rules:
        out = F.when(cond, as_col(label)) if out is None else out.when(cond, as_col(label))
    return as_col(default) if out is None else out.otherwise(as_col(default))


derive_label = case


def first_non_null(*cols: Column) -> Column:
    return F.coalesce(*cols)


def recode(col: Column, mapping: Mapping, default: Column | object = None) -> Column:
    """Constant lookup. Pass ``default=col`` to keep values without an entry."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    default = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), default)


def in_list(col: Column, values: Sequence, prefix: str = "", suffix: str = "") -> Column:
    """Membership in a constant list, each value with an optional prefix and suffix."""
    if prefix or suffix:
        values = [f"{prefix}{v}{suffix}" for v in values]
    return col.isin(*values)


def flag(cond: Column) -> Column:
    """A condition as data; unknown stays NULL."""
    return cond


def weighted_label(key: Column, weights: Sequence[tuple[float, str]], seed: int = 0) -> Column:
    """Label drawn by cumulative weight from a hash of ``key``: the same key always gets the same label.

    The last label takes what is left, so its weight only documents the share.
    """
    digits = F.left(F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}"))), F.lit(8))
    draw = F.conv(digits, 16, 10).cast("long") / F.lit(4294967296.0)
    rules, upto = [], 0.0
    for share, label in weights[:-1]:
        upto += share
        rules.append((draw < round(upto, 9), label))
    return case(rules, weights[-1][1])


# --- channel grouping -------------------------------------------------------
# Search engines, networks, media and labels of the channel rules.
SEARCH_SITES = "baidu|bing|duckduckgo|ecosia|google|yahoo|yandex"
SOCIAL_SITES = "facebook|fb|linkedin|twitter|lin|tw"
VIDEO_SITES = "youtube|vimeo"
PAID_MEDIUM = "^(.*cp.*|ppc|paid.*)$"
VIDEO_MEDIUM = "^(.*video.*)$"
MAIL_WORDS = "email|e-mail|e_mail|e mail"
DISPLAY_MEDIA = ["display", "banner", "expandable", "interstitial", "cpm"]
SOCIAL_MEDIA = ["social", "social-network", "social-media", "sm", "social network", "social media", "linkedin"]


def channel_rules(source: Column, medium: Column) -> list[tuple[Column, str]]:
    """Channel rules in order of precedence, for callers who want to extend them."""
    paid = contains(medium, PAID_MEDIUM)
    return [
        ((source == "(direct)") & medium.isin("not set", "none"), "Direct"),
        (contains(source, SEARCH_SITES) & paid, "Paid Search"),
        (contains(source, SOCIAL_SITES) & paid, "Paid Social"),
        (contains(source, VIDEO_SITES) & paid, "Paid Video"),
        (medium.isin(*DISPLAY_MEDIA), "Display"),
        (contains(source, SOCIAL_SITES + "|social") | medium.isin(*SOCIAL_MEDIA), "Organic Social"),
        (contains(source, VIDEO_SITES) | contains(medium, VIDEO_MEDIUM), "Organic Video"),
        (contains(source, SEARCH_SITES + "|goog") | (medium == "(organic)"), "Organic Search"),
        (contains(source, MAIL_WORDS) | contains(medium, MAIL_WORDS), "Email"),
        (medium == "(referral)", "Referral"),
    ]


def channel_group(source: Column, medium: Column) -> Column:
    return case(channel_rules(source, medium), "Unassigned")


# --- attribution ------------------------------------------------------------
# Names that stand for a missing source.
PLACEHOLDERS = ["(direct)", "(organic)", "(referral)"]


def attribute(utm: Column, candidates: Sequence[Column], strict: bool = True) -> Column:
    """One attribution field from the campaign tag and fallback candidates.

    ``strict`` keeps the established results: the tag, else the first known
    candidate without ``(none)`` and without parentheses. With
    ``strict=False`` a candidate that is no placeholder goes first.
    """
    fallback = trim_chars(F.nullif(F.coalesce(*candidates), F.lit("(none)")), "()")
    rules = [(utm.isNotNull(), utm)]
    if not strict:
        rules += [(~c.isin(*PLACEHOLDERS), c) for c in candidates]
    return case(rules, fallback)


# Referrers that are known under one short name.
KNOWN_SOURCES = [
    "baidu", "bing", "calcalist", "facebook", "forbes", "google", "wikipedia", "yahoo", "yandex",
]
UNIVERSITY_SOURCES = {"huji.ac.il": "huji", "tau.ac.il": "tau"}
CHAT_SOURCES = ["chatgpt.com", "chat.openai.com"]


def canonical(col: Column, rules: Sequence[tuple[str, str]] | None = None, extra: Sequence[tuple[Column, str]] = ()) -> Column:
    """Canonical source name by case-insensitive substring, else the value itself.

    ``rules`` are (substring, name) pairs; ``extra`` are site-specific
    (condition, name) rules that come after them.
    """
    if rules is None:
        rules = [(s, s) for s in KNOWN_SOURCES] + list(UNIVERSITY_SOURCES.items())
    ordered = [(contains_text(col, part), name) for part, name in rules]
    return case([*ordered, (col.isin(*CHAT_SOURCES), CHAT_SOURCES[0]), *extra], col)


def classify_event(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Event taxonomy: the same rule engine under the name users look for."""
    return case(rules, default)
