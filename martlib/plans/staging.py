"""Relational snapshots under their model names, with missing-value conventions applied.

Each table is described by renames, cleaning rules and an optional row
condition; ``stage`` applies the description in one projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.functions.geo import area_of, country_iso, country_name, country_valid, fix_city, plain_list_text
from martlib.functions.numbers import try_int
from martlib.functions.text import initcap_words, trim_chars
from martlib.operators.projection import CLEANING, clean


@dataclass(frozen=True)
class Table:
    rename: Mapping[str, str] = field(default_factory=dict)
    rules: Mapping[str, str] = field(default_factory=dict)
    where: str | None = None


def _rules(**groups: Sequence[str]) -> dict[str, str]:
    """``blank=["a", "b"]`` gives both columns the rule ``blank``."""
    return {c: rule for rule, cols in groups.items() for c in cols}


# Renames and the columns of each cleaning rule, under the names after renaming.
TABLES = {
    "base_event": Table(
        {"company_key": "entity_id", "date": "event_date", "updator_key": "updater_key"},
        _rules(epoch=["created_date", "updated_date", "event_date"], blank=["funding_type_funding_type"], flag=["is_silent_round"], zero=["amount_amount"]),
    ),
    "base_event_investors": Table(
        {"id": "investment_id", "origin_entity_id": "round_id", "investors_is_lead": "is_lead", "investors_amount_amount": "investor_amount",
         "investors_is_follow_on": "is_follow_on", "investors_entity_entity_key": "investor_id",
         "investors_entity_visibility_visibility_type": "disclosure_investor_investment_level", "investors_amount_visibility_visibility_type": "disclosure_amount_level"},
        _rules(flag=["is_lead", "is_follow_on"], zero=["investor_amount"], public=["disclosure_investor_investment_level", "disclosure_amount_level"]),
    ),
    "chat_history": Table({"id": "message_id", "message_time": "message_datetime"}, _rules(blank=["channel_id", "user_id", "status", "message"])),
    "chat_invitations": Table(
        {"id": "invite_id", "invitation_date": "invitation_datetime", "last_reminder": "last_reminder_datetime", "reminders_num": "reminders", "status_date": "status_datetime"},
        _rules(blank=["channel_id", "inviting_user_id", "invited_user_id", "invited_member_id", "status", "status_message", "purpose"]),
    ),
    "collection": Table(
        {"id": "collection_id", "name": "collection_name", "description": "collection_description", "type": "collection_type", "url_name": "collection_url_name",
         "created_date": "created_datetime", "owen_date": "own_datetime", "ready_date": "ready_datetime", "last_modified_date": "last_modified_datetime"},
        _rules(blank=["collection_name", "collection_description", "collection_type", "collection_url_name", "creator_id", "owner_id"],
               epoch=["created_datetime", "own_datetime", "ready_datetime", "last_modified_datetime"]),
    ),
    "collection_company_relation": Table(
        {"collection_key": "collection_id", "company_key": "company_id", "custom_order": "collection_order", "added_date": "added_datetime",
         "note_last_modified_datetime": "note_modified_datetime"},
        _rules(blank=["collection_id", "company_id", "note", "group_id"], epoch=["added_datetime", "note_modified_datetime"]),
        where="company_id is not null",
    ),
    "collection_groups": Table(
        {"id": "group_id", "watchlist_id": "collection_id", "entity_type": "group_entity_type", "last_update": "group_modified_datetime"},
        _rules(blank=["owner_id", "collection_id", "group_entity_type", "group_name", "group_description"], epoch=["group_modified_datetime"]),
    ),
    "saved_searches": Table(
        {"id": "search_id", "created_date": "created_datetime", "last_modified_date": "last_modified_datetime", "last_notification": "last_notification_datetime",
         "interval_days": "notification_interval_days"},
        _rules(blank=["user_id", "name", "description", "url", "type"], epoch=["created_datetime", "last_modified_datetime", "last_notification_datetime"]),
    ),
    "smartlist_notifications": Table(
        {"id": "notification_id", "modification_updates": "fields", "last_notification": "last_notification_datetime", "created_date": "created_datetime"},
        _rules(int=["interval_days"], epoch=["last_notification_datetime", "created_datetime"]),
    ),
    "semantic_search": Table({}, _rules(quotes=["ai_analysis"], blank=["recognized", "unrecognized"])),
    "entity_analysis": Table({}, _rules(blank=["name", "email_domain", "type", "description", "sector"]), where="type is not null"),
    "user_analysis": Table({}, _rules(blank=["user_id", "entity_analysis_id", "title_analysis_id"])),
    "company_tag": Table(
        {"id": "tag_id", "old_key": "old_tag_id", "company": "company_id"}, _rules(trim=["old_tag_id", "tag_name", "tag", "company_type", "report_tag"])),
    "company_investment_stages": Table(
        {"id": "investment_stage_id", "origin_entity_id": "entity_id", "investment_stages": "investment_stage"}, _rules(blank=["investment_stage"])),
    "company_markets": Table({"id": "market_id", "origin_entity_id": "company_id", "markets": "market"}),
    "company_business_model": Table({"origin_entity_id": "company_id"}),
    "company_alternative_names": Table({"id": "alternative_name_id", "origin_entity_id": "entity_id", "alternative_names": "alternative_name"}),
    "member": Table({"id": "member_id", "user": "user_id", "company": "company_id"}),
    "classification": Table({"id": "classification_id", "type": "classification_type", "name": "sector_name"}),
    "classification_relation": Table({"type": "classification_type"}),
    "classification_company": Table({"classification_key": "classification_id", "company_key": "company_id"}),
    "hide_profile_reason": Table({"id": "hide_reason_id", "reason": "reason_description", "visible": "is_visible"}),
    "bot_tracking": Table({"date": "date_day"}, _rules(ymd=["date_day"], lower=["country"])),
}

_EXTRA = {
    "public": lambda c: F.coalesce(c, F.lit("Public")),
    "int": try_int,
    "quotes": lambda c: trim_chars(c, '"'),
    "lower": F.lower,
    "ymd": lambda c: F.to_date(c.cast("string"), "yyyyMMdd"),
    "one": lambda c: F.coalesce(c, F.lit(1)),
    "initcap": initcap_words,
    "code": lambda c: F.nullif(F.nullif(c, F.lit("")), F.lit(" ")),
    "ids": lambda c: F.nullif(F.nullif(c, F.lit("")), F.lit("--")),
}


def stage(df: DataFrame, table: str | Table) -> DataFrame:
    """Apply a table description; rules for columns the snapshot lacks are skipped."""
    t = TABLES[table] if isinstance(table, str) else table
    df = df.withColumnsRenamed(dict(t.rename))
    rules: dict[str, str | Column] = {}
    for c, rule in t.rules.items():
        if c in df.columns:
            rules[c] = rule if rule in CLEANING else _EXTRA[rule](F.col(c))
    df = clean(df, rules) if rules else df
    return df.filter(t.where) if t.where else df


COMPANY = Table(
    {"id": "company_id", "name": "company_name", "description": "company_description", "url_name": "company_url_name", "type": "company_type",
     "sub_type": "company_subtype", "sector": "company_sector", "update_date": "updated_date", "last_modification_date": "modified_at",
     "in_israel_since": "in_israel_since_year", "bi_verify": "bi_verify_key", "sector_verify": "sector_verify_key", "class_size": "batch_size",
     "provides_office": "office_space", "number_of_classes": "batches_year"},
    _rules(
        blank=["company_name", "company_description", "tag_line", "homepage", "careerspage", "teamspage", "phone", "company_sector", "stage", "public_stage",
            "product_stage", "stage_of_development_text", "employees", "employees_overall", "acquired_by", "acquired_country", "status", "full_status", "supporting_arm", "academic_institution", "funding_type", "external_events_url", "program_type", "supporting_arm_name", "applications", "company_subtype"],
        epoch=["created_date", "updated_date", "modified_at", "member_verified_data_date", "bi_verify_date", "sector_verify_date", "market_cap_date",
            "acquired_added_date", "exposure_date", "university_founded_date", "claimed_date", "card_photo_created_date", "cover_photo_created_date"],
        zero=["founded_month", "investment_upper_amount", "investment_lower_amount"],
        flag=["tag_line_edited", "claimed", "minimal_profile", "dont_publish", "takes_equity", "academia_supported", "dont_publish_reasons_not_israeli",
            "dont_publish_reasons_founder_request_to_remove", "dont_publish_reasons_service_provider", "dont_publish_reasons_stealth_mode"],
        one=["visible"], initcap=["membership_type"], code=["technology_code"], ids=["crunchbase_id"],
    ),
)


def stage_companies(raw: DataFrame, excluded_names: tuple[str, ...] = (), home: str = "Israel") -> DataFrame:
    """Company master: cleaned columns, standard country, home flag.

    Rows with an excluded name go, and with any exclusion also rows without a
    name, as ``NOT IN`` does in SQL.
    """
    c = F.col
    if excluded_names:
        raw = raw.filter(~c("name").isin(*excluded_names))
    place = F.when(c("type") == "Startup", home).otherwise(c("country"))
    df = raw.withColumns({
        "old_country": place, "is_israeli": F.when((c("country") == home) | (c("type") == "Startup"), 1).otherwise(0),
        "country_iso_code": country_iso(place), "is_valid_country": country_valid(place), "country": country_name(place),
    })
    if "headquarter_address" in df.columns:
        # the city of the head office is kept in the address field
        df = df.withColumn("headquarter_city", F.nullif("headquarter_address", F.lit("")))
    if "acquired_year" in df.columns:
        df = df.withColumn("acquired_year", F.when(c("acquired_year") >= 1980, c("acquired_year")))
    return stage(df, COMPANY)


def stage_addresses(
    raw: DataFrame, spellings: Mapping[str, str], address_words, areas: Mapping[str, list[str]], large_cities: Mapping[str, list[str]], districts: Mapping[str, list[str]]
) -> DataFrame:
    """Addresses with a standard city, its metropolis, large-city name and district.

    The city tables are the caller's. The metropolis looks at the city as
    written, large city and district at the corrected one.
    """
    c = F.col
    city = F.when(c("city").rlike("^[a-zA-Z]{2}"), c("city"))
    df = raw.withColumns({"city": city, "fixed_city": fix_city(c("city"), c("address"), spellings, address_words), "office_type": plain_list_text(c("office_type"))})
    return df.withColumns({
        "metropolis": area_of(c("city"), areas), "large_city": area_of(c("fixed_city"), large_cities), "district": area_of(c("fixed_city"), districts),
    })
