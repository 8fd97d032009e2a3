"""Country, region and city normalisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlib.functions.rules import case, recode
from martlib.functions.text import contains, initcap_words, replace_all

# Country name -> other spellings found in the data.
COUNTRY_SPELLINGS = {
    "United States": ["united states", "us", "usa", "u.s.", "u.s.a.", "america", "kentucky"],
    "United Kingdom": ["united kingdom", "uk", "u.k.", "great britain", "britain", "england"],
    "China": ["china", "caina", "prc"],
    "Russia": ["russia", "russian federation", "moscow"],
    "South Korea": ["south korea", "korea", "republic of korea", "rok"],
    "Ireland": ["ireland", "republic of ireland", "eire"],
    "Czech Republic": ["czech republic", "czechia", "czech"],
    "Iceland": ["iceland", "island"],
    "Eswatini": ["swaziland", "eswatini"],
    "Belgium": ["eu, brussels", "eu brussels", "brussels"],
    "United Arab Emirates": ["united arab emirates", "uae", "u.a.e.", "dubai", "abu dhabi"],
    "Hong Kong": ["hong kong", "hongkong", "hk"],
    "Taiwan": ["taiwan", "republic of china", "roc"],
    "Isle of Man": ["isle of man"],
}

# ISO 3166-1 alpha-2 codes of the countries that get one.
COUNTRY_ISO = {
    "United States": "US", "United Kingdom": "GB", "China": "CN", "Russia": "RU", "South Korea": "KR",
    "Ireland": "IE", "Czech Republic": "CZ", "Iceland": "IS", "Eswatini": "SZ", "Belgium": "BE",
    "Singapore": "SG", "United Arab Emirates": "AE", "Hong Kong": "HK", "Taiwan": "TW", "Israel": "IL",
    "Germany": "DE", "France": "FR", "Switzerland": "CH", "Japan": "JP", "Canada": "CA", "Australia": "AU",
    "India": "IN", "Netherlands": "NL", "Spain": "ES", "Italy": "IT", "Sweden": "SE", "Austria": "AT",
    "Denmark": "DK", "Norway": "NO", "Finland": "FI", "Poland": "PL", "Portugal": "PT", "Greece": "GR",
    "Hungary": "HU", "Romania": "RO", "Bulgaria": "BG", "Croatia": "HR", "Slovakia": "SK", "Slovenia": "SI",
    "Estonia": "EE", "Latvia": "LV", "Lithuania": "LT", "Ukraine": "UA", "Turkey": "TR", "Vietnam": "VN",
    "Thailand": "TH", "Indonesia": "ID", "Malaysia": "MY", "Philippines": "PH", "Pakistan": "PK",
    "Bangladesh": "BD", "Sri Lanka": "LK", "Brazil": "BR", "Argentina": "AR", "Chile": "CL", "Colombia": "CO",
    "Mexico": "MX", "Peru": "PE", "South Africa": "ZA", "Nigeria": "NG", "Kenya": "KE", "Egypt": "EG",
    "Saudi Arabia": "SA", "Qatar": "QA", "Bahrain": "BH", "Jordan": "JO", "Lebanon": "LB", "Iran": "IR",
    "Palestine": "PS", "Luxembourg": "LU", "Malta": "MT", "Cyprus": "CY", "New Zealand": "NZ", "Georgia": "GE",
}

# Region words that are no country.
NOT_COUNTRIES = [
    "americas", "north america", "south america", "europe", "asia", "global", "oceania",
    "eastern europe", "western europe", "northern europe", "southern africa", "eu",
]

# Target markets.
TARGET_COUNTRIES = [
    "Morocco", "Saudi Arabia", "United Arab Emirates", "Bahrain", "Indonesia", "Azerbaijan", "Libya",
]


def _key(col: Column) -> Column:
    return F.lower(F.trim(col))


def country_name(col: Column) -> Column:
    """Standard country name; unknown names are trimmed and capitalised, blanks and 'none' are NULL."""
    spelled = {s: name for name, spellings in COUNTRY_SPELLINGS.items() for s in spellings}
    blank = col.isNull() | _key(col).isin("", "none")
    return F.when(~blank, recode(_key(col), spelled, initcap_words(F.trim(col))))


def country_iso(col: Column) -> Column:
    """ISO code, NULL for regions and countries without an entry."""
    codes = {}
    for name, iso in COUNTRY_ISO.items():
        for spelling in {name.lower(), *COUNTRY_SPELLINGS.get(name, [])}:
            codes[spelling] = iso
    return recode(_key(col), codes)


def country_valid(col: Column) -> Column:
    """1 for a country, 0 for regions, blanks and 'none'."""
    return F.when(col.isNull() | _key(col).isin("", "none", *NOT_COUNTRIES), 0).otherwise(1)


def region_of(col: Column, regions: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Region of a country from ordered (region, countries) pairs; the first that lists it wins.

    The table is the caller's (it is long and changes with the business); see
    ``lookup_flag``/``enrich`` for a version read from a table.
    """
    first: dict[str, str] = {}
    for region, countries in regions:
        for country in countries:
            first.setdefault(country, region)
    return recode(col, first)


def target_flag(col: Column, targets: Sequence[str] = tuple(TARGET_COUNTRIES)) -> Column:
    """1 for target markets, else 0."""
    return F.when(col.isin(*targets), 1).otherwise(0)


def plain_city(city: Column) -> Column:
    """City only when it starts with two Latin letters."""
    return F.when(contains(city, "^[a-zA-Z]{2}"), city)


def fix_city(
    city: Column,
    address: Column,
    spellings: Mapping[str, str],
    address_words: Sequence[tuple[str, str]],
) -> Column:
    """City with spelling fixes; a missing city is looked for in the address text.

    ``spellings`` maps a city as written to the standard one, ``address_words``
    are (text in address, city) pairs tried in order.
    """
    clean = plain_city(city)
    found = case([(address.contains(word), name) for word, name in address_words])
    fixed = recode(clean, spellings, clean) if spellings else clean
    return F.when(clean.isNull() | (clean == ""), F.coalesce(found, clean)).otherwise(fixed)


def area_of(city: Column, areas: Mapping[str, Sequence[str]], default: str | None = None) -> Column:
    """Area (metropolis, district, ...) whose city list holds the city; the first wins."""
    first: dict[str, str] = {}
    for area, cities in areas.items():
        for c in cities:
            first.setdefault(c, area)
    return recode(city, first, default)


def plain_list_text(col: Column) -> Column:
    """Bracketed, quoted list text as plain text with ', ' between items."""
    return replace_all(col, [("[", ""), ("]", ""), ('"', ""), (",", ", ")])
