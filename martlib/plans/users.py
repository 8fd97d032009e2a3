"""User master: tracked visitors merged with registered users."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.functions.geo import region_of, target_flag
from martlib.functions.numbers import greatest_strict
from martlib.functions.rules import case, channel_group, recode, weighted_label
from martlib.functions.text import surrogate_key
from martlib.operators.aggregates import max_by_nn, min_by_nn, summarize
from martlib.operators.joins import full_merge
from martlib.operators.windows import keep_first
from martlib.plans.common import EMPTY_USER_ID, EMPTY_USER_PSEUDO_ID, EVENT_DIMENSIONS, MARKETING_DIMENSIONS

# Spelling of a declared category -> user type.
CATEGORY_TYPES = {
    "hub": "Hub", "hub (accelerator, community or similar)": "Hub", "investor": "Investor", "investment firm": "Investor",
    "consultant or service provider": "Consultant or service provider", "consulting firm": "Consultant or service provider",
    "sme (small and medium-sized enterprises)": "SME", "sme": "SME",
}
# Text in the declared usage -> primary usage.
USAGE_WORDS = [
    ("search-investors", "Search Investors"), ("job", "Search Job"), ("research-and-analysis", "Research and Analysis"),
    ("collaborate", "Collaborate"), ("tech-solution", "Search Tech Solution"), ("find-startups-to-invest", "Find Startups To Invest"),
]
# Analysed organisation type -> user type.
ANALYSIS_TYPES = {
    "Media": "Media", "Government": "Government", "Startup": "Startup", "Software Development": "Startup", "Corporate": "Corporation",
    "Consulting Firm": "Consultant or service provider", "Law Firm": "Consultant or service provider", "Academia": "Academia",
    "VC": "Investor", "Investor": "Investor", "Private Equity": "Investor", "Crowdfunding": "Investor", "Corporate VC": "Investor",
    "Venture Capital": "Investor", "Angel": "Investor", "Communities": "Media", "Government-led": "Government", "Non-Profit": "NGO",
    "Nonprofit": "NGO", "Non-profit": "NGO", "Nonprofit organization": "NGO", "Accelerator": "Hub", "Incubator": "Hub", "Grant Providers": "Hub",
}
# The types a user can declare.
DECLARED_TYPES = [
    "Startup", "Consultant or service provider", "Investor", "Corporation", "Government", "NGO", "Academia", "Hub", "Media", "SME", "Job seeker",
]
# Shares of the user types behind a primary usage.
USAGE_SHARES = {
    "Collaborate": [(0.4, "Consultant or service provider"), (0.3, "Corporation"), (0.3, "Startup")],
    "Research and Analysis": [(0.6, "Consultant or service provider"), (0.4, "Investor")],
    "Search Tech Solution": [(0.28, "Corporation"), (0.26, "Consultant or service provider"), (0.25, "Investor"), (0.21, "Government")],
}
# Stated usage -> type.
USAGE_TYPES = {"Search Investors": "Startup", "Find Startups To Invest": "Investor", "Search Job": "Job seeker"}
# User type -> name shown.
SHOWN_TYPES = {
    "Job seeker": "Job Seeker", "Consultant or service provider": "Service Provider", "Corporation": "Corporate", "Government": "Public Sector",
    "Hub": "Innovation Hub", "SME": "Corporate", "Multinational": "Corporate", "NGO": "Public Sector",
}


def user_type(raw: Column) -> Column:
    """User type from the declared category; unknown categories are kept trimmed."""
    return recode(F.lower(raw), CATEGORY_TYPES, F.nullif(F.trim(raw), F.lit("")))


def primary_usage(raw: Column) -> Column:
    return case([(raw.contains(word), usage) for word, usage in USAGE_WORDS])


def clean_users(raw: DataFrame, staff_domain: str = "@example.org") -> DataFrame:
    """Registered users: derived type, usage and registration flags; one row per id, the latest active."""
    c = F.col
    epoch = F.lit("1970-01-01").cast("date")
    day = lambda n: F.coalesce(c(n).cast("date"), epoch)
    df = raw.withColumns({
        "original_signup_date": c("signup_date"),
        "signup_date": F.when(c("signup_date").cast("date") != epoch, c("signup_date")),
        "user_type": user_type(c("category_raw")),
        "category_raw": F.nullif(F.trim("category_raw"), F.lit("")),
        "primary_usage": primary_usage(c("primary_usage")),
        "is_email_validated": c("email_validated") == 1,
        "is_password_empty": c("password").isNull() | (c("password") == ""),
        "is_staff": c("email").endswith(staff_domain),
        "is_confirmed": c("confirmed").isNotNull() & (c("confirmed") == 1),
        "__active": greatest_strict(day("last_session_start"), day("last_session_end"), day("last_home_page_view_date"), day("updated_date")),
        "__key": F.lower("user_id"),
    })
    known = c("is_password_empty") | c("is_email_validated")
    df = df.withColumn("is_registered", c("original_signup_date").isNotNull() & known)
    return keep_first(df, ["__key"], ["-__active", "user_id"]).drop("__active", "__key")


def derived_user_type() -> Column:
    """Company type, analysed type, declared type, then usage; spread over types by share where usage does not tell."""
    c = F.col
    usage = c("user_primary_usage")
    rules = [
        (c("company_type").isNotNull(), c("company_type")),
        (c("entity_analysis_type").isin(*ANALYSIS_TYPES), recode(c("entity_analysis_type"), ANALYSIS_TYPES)),
        (c("user_type").isin(*DECLARED_TYPES), c("user_type")),
        (usage.isin(*USAGE_TYPES), recode(usage, USAGE_TYPES)),
    ]
    rules += [(usage == u, weighted_label(c("record_id"), shares)) for u, shares in USAGE_SHARES.items()]
    label = case(rules, "Other")
    return recode(label, SHOWN_TYPES, label)


def tracked_users(long: DataFrame, dimensions: Sequence[str], marketing: Sequence[str]) -> DataFrame:
    """One row per tracked (user, device): signup progress, latest dimensions, first marketing touch."""
    c, t = F.col, "event_datetime_utc"
    v = c("event__string_value")
    profile = c("event_name") == "profile_data"
    step = profile & (c("event_key") == "step")
    done = v.contains("complete")
    return summarize(long, ["user_id", "is_user_id_generated", "user_pseudo_id", "is_user_pseudo_id_generated"], {
        "signup_start_datetime": F.max(F.when((c("event_key") == "action") & (v == "Sign Up"), c(t))),
        "signup_platform": min_by_nn(F.when(profile & (c("event_key") == "platform"), v), t),
        "is_signup_complete": F.coalesce(F.bool_or(F.when(step, done)), F.lit(False)),
        "signup_complete_datetime": F.max(F.when(step & done, c(t))),
        **{d: max_by_nn(d, t) for d in dimensions},
        **{m: min_by_nn(m, t) for m in marketing},
    })


def latest_analysis(analysis: DataFrame, links: DataFrame) -> DataFrame:
    """Latest analysed organisation per user."""
    c = F.col
    joined = analysis.join(links.withColumnRenamed("entity_analysis_id", "id"), "id")
    one = keep_first(joined, ["user_id"], ["-created_date", "id"])
    return one.select(
        "user_id", c("name").alias("entity_analysis_name"), c("sector").alias("entity_analysis_sector"), c("type").alias("entity_analysis_type"))


def build_users(
    long: DataFrame, crm_users: DataFrame, members: DataFrame, companies: DataFrame, analysis: DataFrame, *,
    crm_columns: Mapping[str, str] | None = None, company_columns: Sequence[str] = ("company_name", "company_type"),
    dimensions: Sequence[str] = tuple(EVENT_DIMENSIONS), marketing: Sequence[str] = tuple(MARKETING_DIMENSIONS),
    regions: Sequence[tuple[str, Sequence[str]]] = (), home: str = "Israel", empty_user: str = EMPTY_USER_ID,
    empty_pseudo: str = EMPTY_USER_PSEUDO_ID,
) -> DataFrame:
    """Registered users merged with tracked visitors: one row per (user, device).

    ``crm_columns`` maps columns of ``crm_users`` to output names; user_id,
    signup_date, is_registered, is_confirmed, user_type and primary_usage are
    always used. ``analysis`` comes from ``latest_analysis``.
    """
    c = F.col
    tracked = tracked_users(long, dimensions, marketing)
    member = members.withColumn("__no_company", F.when(c("company_id").isNotNull(), 0).otherwise(1))
    member = keep_first(member.select("user_id", "company_id", "created_date", "__no_company"), ["user_id"], ["__no_company", "-created_date", "company_id"])
    crm = crm_users.select(
        "user_id", c("signup_date").alias("__signup"), "is_registered", "is_confirmed", "user_type", c("primary_usage").alias("user_primary_usage"),
        *[c(o).alias(n) for o, n in (crm_columns or {}).items()],
    )
    crm = crm.join(member.select("user_id", "company_id", F.lit(True).alias("is_member")), "user_id", "left")
    crm = crm.join(companies.select("company_id", *company_columns), "company_id", "left")
    df = full_merge(crm, tracked, ["user_id"])
    signup = F.coalesce(c("__signup").cast("timestamp_ntz"), "signup_complete_datetime")
    df = df.withColumns({
        "user_id": F.coalesce("user_id", F.lit(empty_user)),
        "user_pseudo_id": F.coalesce("user_pseudo_id", F.lit(empty_pseudo)),
        "is_user_id_generated": F.coalesce("is_user_id_generated", F.lit(False)),
        "is_user_pseudo_id_generated": F.coalesce("is_user_pseudo_id_generated", F.lit(False)),
        "is_user_registered": F.coalesce("is_registered", F.lit(False)),
        "is_user_confirmed": F.coalesce("is_confirmed", F.lit(False)),
        "user_signup_datetime": signup,
        "user_signup_date": signup.cast("date"),
    }).drop("__signup", "is_registered", "is_confirmed")
    df = df.filter(~((c("user_id") == empty_user) & (c("user_pseudo_id") == empty_pseudo)))
    df = keep_first(df, ["user_id", "user_pseudo_id"], ["-is_user_registered", "-is_user_confirmed", "user_signup_datetime", "is_user_id_generated", "is_user_pseudo_id_generated", "signup_start_datetime"])
    df = df.join(analysis.select("user_id", "entity_analysis_type", "entity_analysis_sector"), "user_id", "left")
    country = c("geo__country")
    df = df.withColumns({
        "record_id": surrogate_key("user_id", "user_pseudo_id"),
        "is_member": F.coalesce("is_member", F.lit(False)),
        "channel_grouping": channel_group(c("marketing_source"), c("marketing_medium")),
        "market_region": region_of(country, regions) if regions else F.lit(None).cast("string"),
        "target_market": target_flag(country),
        "is_home_country": country == home,
    })
    return df.withColumn("derived_user_type", derived_user_type())


def user_dimension(users: DataFrame) -> DataFrame:
    """Users with a real id, one row each: the registered, confirmed, earliest record."""
    c = F.col
    df = users.filter(~c("is_user_id_generated"))
    df = keep_first(df, ["user_id"], ["-is_user_registered", "-is_user_confirmed", "user_signup_date", "signup_start_datetime", "user_pseudo_id"])
    return df.withColumn("user_signup_date", F.coalesce(c("signup_complete_datetime").cast("date"), "user_signup_date"))
