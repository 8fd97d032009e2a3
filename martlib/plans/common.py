"""Names and column lists shared by the plans.

Column lists are parameters of a deployment; these defaults follow the data
model described in the README.
"""

from __future__ import annotations

# Sentinels for unknown ids; every plan takes its own value as an argument too.
EMPTY_USER_ID = "empty_user_id"
EMPTY_USER_PSEUDO_ID = "empty_user_pseudo_id"
EMPTY_SESSION_ID = "empty_session_id"

EVENT_DIMENSIONS = [
    "geo__city", "geo__country", "geo__continent", "geo__region", "geo__sub_continent",
    "device__category", "device__operating_system", "device__language", "device__browser",
]
MARKETING_DIMENSIONS = [
    "marketing_source", "marketing_medium", "marketing_campaign", "marketing_campaignid", "marketing_date", "marketing_company",
    "marketing_region", "marketing_channel", "marketing_details", "marketing_objective", "marketing_campaign_group",
]
# Parameters that become columns of a pivoted event.
EVENT_KEYS = [
    "page_title", "page_referrer", "page_location", "section", "entity_type", "entity_name", "type", "step",
    "filters", "element_clicked", "search_term", "action", "label",
]
FIRST_EVENTS = ["first_visit", "first_open"]
SESSION_OPENERS = ["session_start", *FIRST_EVENTS]
PROFILE_PATHS = ["/company_page", "/investor_page"]
