"""Company and investor plans: exits, rounds, acquisitions, profiles, yearly activity, entity master.

Business events share one table (columns ``id, entity_id, event_type,
event_date, amount_amount, ...``); entities come from ``entity_master``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.functions.dates import first_of_month
from martlib.functions.numbers import bucket
from martlib.functions.rules import case, recode
from martlib.functions.text import initcap_words, surrogate_key
from martlib.operators.aggregates import string_agg_distinct, summarize, top_with_ties
from martlib.operators.joins import exists_flag, link_by_name, not_in, role_join, year_spine
from martlib.operators.ordered import Lag, RowNumber, ordered
from martlib.operators.sets import order_final, stack
from martlib.operators.windows import first_rank_flag, keep_first, keep_rank_where, sequence_no

# Event types.
LISTING_EVENTS = ["POEvent", "SpacEvent", "ReverseMergerEvent"]
MERGER_EVENT, ROUND_EVENT, FUND_EVENT, CLOSING_EVENT = "MNAEvent", "FundingRoundEvent", "InvestmentFirmFundingEvent", "ClosingEvent"
PRIVATE_ROUNDS = [
    "A Round", "SAFE", "Pre-Seed", "Undisclosed Round", "Seed", "B Round", "E Round", "C Round", "Convertible Debt", "D Round", "G Round",
    "Equity crowdfunding", "F Round",
]
PUBLIC_ROUNDS = ["PIPE", "Convertible Bond"]
# Public event type -> label.
PUBLIC_LABELS = {"POEvent": "Public Offering", "ReverseMergerEvent": "Reverse Merger", "SpacEvent": "SPAC"}
ROUND_SIZES = ([100e6, 500e6, 1e9], ["Small Round (<100M)", "Medium Round (100M-500M)", "Large Round (500M-1B)", "Mega Round (1B+)"])
DEAL_SIZES = ([100e6, 1e9], ["Small (<100M)", "Medium (100M-1B)", "Large (1B+)"])
UNDISCLOSED = "Undisclosed"
# Organisation types that are hubs.
HUB_TYPES = ["Accelerator", "Corporate Accelerator", "Entrepreneurship Program", "Community", "Co-Working Space"]
SHOWN_LEVELS = ["all", "aggregation"]
# Sector name -> short name.
SECTOR_SHORT_NAMES = {
    "Health Tech & Life Sciences": "Health Tech", "Media & Entertainment Technologies": "Media & Entertainment", "Industrial Technologies": "Industrial Tech",
    "Automotive & Mobility Technologies": "Automotive & Mobility", "Cyber Security": "Cybersecurity", "Aerospace, Defense & HLS": "Aerospace & Defense",
    "Agriculture & Food Technologies": "Agri-Food Tech", "Education & Knowledge Technologies": "Ed Tech", "Ag Tech": "Agri-Food Tech",
    "Climate Tech": "Climate Tech", "Operations Solutions": "Operations",
}
# Investment stage -> (category, sort order).
STAGES = {
    "Pre-Funding": ("Early Stage", 1), "Pre-Seed": ("Early Stage", 2), "Seed": ("Early Stage", 3), "A Round": ("Early Stage", 4),
    "B Round": ("Early Growth", 5), "C Round": ("Early Growth", 6), "D Round": ("Late Growth", 7), "E Round": ("Late Growth", 8),
    "F Round": ("Late Growth", 9), "G Round": ("Late Growth", 10), "Mature": ("Mature", 11), "Public": ("Public", 12), "Acquired": ("Acquired", 13),
}
# Event type -> category of the residual events.
OTHER_EVENTS = {
    "ClosingEvent": "Company Closure", "GrantEvent": "Grant", "GraduationEvent": "Accelerator Graduation",
    "CommunityInvolvementEvent": "Community Involvement", "DelistingEvent": "Stock Delisting", "ICOEvent": "ICO/Token Sale", "MNAEvent": "Acquisition Made",
}


def sector_short_name(col: Column) -> Column:
    return recode(col, SECTOR_SHORT_NAMES, col)


def investment_stages(stages: DataFrame) -> DataFrame:
    """Stage category and order."""
    s = F.col("investment_stage")
    return stages.filter(s.isNotNull()).withColumns({
        "stage_category": recode(s, {k: v[0] for k, v in STAGES.items()}, "Other"),
        "stage_sort_order": recode(s, {k: v[1] for k, v in STAGES.items()}, 99),
    })


def add_people(df: DataFrame, users: DataFrame | None) -> DataFrame:
    """Mail and names of creator and updater; without ``users`` the rows stay as they are."""
    if users is None:
        return df
    who = users.select("user_id", "email", "first_name", "last_name", F.concat("first_name", F.lit(" "), "last_name").alias("name"))
    return role_join(df, who, {"event_creator": "creator_key", "event_updater": "updater_key"}, "user_id", ["email", "first_name", "last_name", "name"])


def _is_exit() -> Column:
    c = F.col
    return ((c("event_type") == MERGER_EVENT) & (c("was_acquired") == 1)) | c("event_type").isin(*LISTING_EVENTS)


def exit_events(events: DataFrame, split: bool = True) -> DataFrame:
    """Acquisitions and listings; all events on the first date of an entity are its exit."""
    renames = {"id": "event_id", "entity_id": "acquired_id", "amount_amount": "amount", "other_party_entity_key": "acquirer_id"}
    df = events.filter(_is_exit()).withColumnsRenamed(renames)
    df = first_rank_flag(df, ["acquired_id"], "event_date", "is_exit")
    return sequence_no(df, ["acquired_id"], ["event_date", "event_id"], "exit_order", split=split)


def ipo_events(events: DataFrame, entities: DataFrame) -> DataFrame:
    """Listings that are the first exit event of an Israeli company; a company acquired before has none."""
    c = F.col
    df = events.filter(_is_exit()).withColumnRenamed("id", "event_id")
    df = df.join(entities.select("entity_id", "entity_type", "is_israeli"), "entity_id")
    listed = c("event_type").isin(*LISTING_EVENTS) & (c("is_israeli") == 1) & (c("entity_type") == "Company")
    first = keep_rank_where(df, ["entity_id"], ["event_date"], listed)
    return first.drop("entity_type", "is_israeli").withColumns({
        "is_ipo": F.lit(1), "is_first_ipo": F.when(c("event_type") == "POEvent", 1).otherwise(0),
    })


def acquisitions(events: DataFrame, users: DataFrame | None = None, split: bool = True) -> DataFrame:
    """Acquisition events with exit and first-acquisition flags and people."""
    df = exit_events(events, split).filter((F.col("event_type") == MERGER_EVENT) & (F.col("was_acquired") == 1)).drop("exit_order")
    df = first_rank_flag(df, ["acquired_id"], "event_date", "is_first_mna")
    return add_people(df, users).withColumnsRenamed({"created_date": "event_created_date", "updated_date": "event_updated_date"})


def acquirer_tier(n: Column) -> Column:
    return F.when(n == 1, "First Acquisition").when(n.between(2, 5), "2-5 Acquisition").otherwise("6+ Acquisition")


def acquisition_facts(acq: DataFrame, entities: DataFrame, split: bool = True) -> DataFrame:
    """Acquisitions with both parties, deal size and the acquirer's experience and category."""
    c = F.col
    df = acq.withColumn("__when", F.coalesce("event_date", "event_created_date"))
    df = sequence_no(df, ["acquirer_id"], ["__when", "event_id"], "__no", split=split).drop("__when")
    first = acq.groupBy("acquirer_id").agg(F.min("event_date").alias("first_acquirer_acquisition_date"))
    target = entities.filter((c("entity_type") == "Company") & c("disclosure_level").isin(*SHOWN_LEVELS)).select(
        c("entity_id").alias("acquired_id"), c("entity_name").alias("acquired_name"), c("is_active").alias("acquired_is_active"),
        c("primary_sector_name").alias("acquired_primary_sector"), c("disclosure_level").alias("disclosure_acquired_level"))
    buyer = entities.select(
        c("entity_id").alias("acquirer_id"), c("entity_name").alias("acquirer_name"), c("entity_type").alias("acquirer_type"),
        c("entity_sub_type").alias("acquirer_sub_type"), c("is_active").alias("acquirer_is_active"), c("entity_country").alias("acquirer_country"),
        c("is_israeli").alias("acquirer_is_israeli"), c("disclosure_level").alias("disclosure_acquirer_level"))
    df = df.join(target, "acquired_id").join(buyer, "acquirer_id").join(first, "acquirer_id")
    t = c("acquirer_type")
    category = case([
        (t == "Investor", "Financial Acquirer"), (t.isin("Multinational", "Foreign Startup"), "Strategic Acquirer"),
        ((t == "Company") & (c("acquirer_is_israeli") == 1), "Israeli Company"),
    ], "Other")
    df = df.withColumns({
        "event_year": F.year("event_date"), "deal_size_category": bucket(c("amount"), *DEAL_SIZES, UNDISCLOSED),
        "acquirer_experience_tier": acquirer_tier(c("__no")), "acquirer_category": category,
    }).drop("__no")
    return order_final(df, ["-event_date", "-event_updated_date", "event_id"])


def private_rounds(events: DataFrame, companies: DataFrame, users: DataFrame | None = None, split: bool = True) -> DataFrame:
    """Private funding rounds of Israeli companies with size class, rank and the round before.

    Convertible debt raised after a company went public is no private round.
    """
    c = F.col
    home = companies.filter((c("is_israeli") == 1) & (c("company_type") != "Foreign Startup")).select("company_id", "company_name")
    public = events.filter(c("event_type").isin(*LISTING_EVENTS) & c("event_date").isNotNull())
    public = public.groupBy(c("entity_id").alias("company_id")).agg(F.min("event_date").alias("__public"))
    kind = c("funding_type_funding_type")
    df = events.filter((c("event_type") == ROUND_EVENT) & (kind.isin(*PRIVATE_ROUNDS) | kind.isNull()) & (c("is_silent_round") == 0))
    df = df.withColumnsRenamed({
        "id": "round_id", "entity_id": "company_id", "event_date": "round_date", "funding_type_funding_type": "round_type", "amount_amount": "amount",
    })
    df = df.join(home, "company_id").join(public, "company_id", "left")
    after = (c("round_type") == "Convertible Debt") & c("__public").isNotNull() & (c("round_date") > c("__public"))
    df = df.filter(~F.coalesce(after, F.lit(False))).drop("__public").withColumn("__when", F.coalesce("round_date", "created_date"))
    df = ordered(df, ["company_id"], ["round_date", "round_id"], {
        "prior_round_date": Lag(c("round_date")), "prior_round_type": Lag(c("round_type")), "prior_round_amount": Lag(c("amount")),
    }, split=split)
    df = ordered(df, ["company_id"], ["__when", "round_id"], {"round_rank": RowNumber()}, split=split)
    df = df.drop("__when").withColumns({
        "round_year": F.year("round_date"), "round_category": F.lit("private_funding"),
        "round_size_category": bucket(c("amount"), *ROUND_SIZES, UNDISCLOSED),
    })
    return add_people(df, users).withColumnsRenamed({"created_date": "event_created_date", "updated_date": "event_updated_date"})


def round_participation(investor_rows: DataFrame, home: str = "Israel") -> DataFrame:
    """Investors per round and where they come from."""
    c = F.col
    local = c("investor_country") == home
    who = lambda cond: F.count_distinct(F.when(cond, c("investor_id")))
    foreign = ~F.coalesce(local, F.lit(False))
    out = summarize(investor_rows, ["round_id"], {
        "num_israeli_investors": who(local), "num_global_investors": who(foreign), "num_investors": F.count_distinct("investor_id"),
        "num_angels": who(c("investor_sub_type") == "Angel"),
    })
    origin = case([(c("num_global_investors") == 0, "Israeli Only"), (c("num_israeli_investors") == 0, "Global Only")], "Both")
    return out.withColumn("investors_origin", origin)


def private_funding(rounds: DataFrame, entities: DataFrame, investor_rows: DataFrame) -> DataFrame:
    """Private rounds of shown companies with participation."""
    c = F.col
    shown = entities.filter(c("disclosure_level").isin(*SHOWN_LEVELS)).select(
        c("entity_id").alias("company_id"), c("primary_sector_name").alias("company_primary_sector_name"), c("disclosure_level").alias("disclosure_company_level"))
    df = rounds.join(shown, "company_id").join(round_participation(investor_rows), "round_id", "left")
    return order_final(df, ["-round_date", "-event_updated_date", "round_id"])


def _rounds(events: DataFrame, cond: Column) -> DataFrame:
    return events.filter(cond).withColumnsRenamed({
        "id": "round_id", "entity_id": "company_id", "event_date": "round_date", "funding_type_funding_type": "round_type", "amount_amount": "amount",
        "created_date": "event_created_date", "updated_date": "event_updated_date",
    })


def investor_rounds(events: DataFrame, participation: DataFrame, entities: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Investor × round with the investor's first investment date; silent rounds left out.

    ``entities``: company_id, country, company_type, company_subtype.
    """
    c = F.col
    rounds = _rounds(events, (c("event_type") == ROUND_EVENT) & (c("is_silent_round") == 0))
    rounds = rounds.select("round_id", "company_id", "round_date", "round_type", "amount", "is_silent_round", "source", "event_created_date", "event_updated_date", "creator_key", "updater_key")
    rounds = add_people(rounds, users)
    who = entities.select(
        c("company_id").alias("investor_id"), c("country").alias("investor_country"), c("company_type").alias("investor_type"), c("company_subtype").alias("investor_sub_type"))
    df = participation.join(rounds, "round_id")
    # the first date counts all rounds of the investor, also before the entity join
    first = df.filter(c("round_date").isNotNull()).groupBy("investor_id").agg(F.min("round_date").alias("first_investment_date"))
    df = df.join(who, "investor_id").join(first, "investor_id", "left")
    return df.withColumn("is_first_investment_ever", F.when(c("first_investment_date") == c("round_date"), 1).otherwise(0)).drop("creator_key", "updater_key")


def silent_rounds(events: DataFrame, participation: DataFrame, users: DataFrame) -> DataFrame:
    """Investors of silent rounds."""
    rounds = _rounds(events, F.col("is_silent_round") == 1)
    rounds = rounds.select("round_id", "company_id", "round_date", "round_type", "source", "event_created_date", "event_updated_date", "creator_key", "updater_key")
    return participation.select("investment_id", "round_id", "investor_id").join(add_people(rounds, users), "round_id")


def both_parties(facts: DataFrame, entities: DataFrame, roles: Mapping[str, str], columns: Mapping[str, str]) -> DataFrame:
    """Facts with the entity attributes of each party, e.g. company and investor; rows need both parties.

    ``roles``: {prefix: key column}, ``columns``: {entity column: name}.
    """
    for prefix, key in roles.items():
        side = entities.select(F.col("entity_id").alias(key), *[F.col(e).alias(f"{prefix}_{n}") for e, n in columns.items()])
        facts = facts.join(side, key)
    return facts


def investor_funds(events: DataFrame, entities: DataFrame, split: bool = True) -> DataFrame:
    """Fund raisings of shown investors, numbered per investor."""
    c = F.col
    df = events.filter(c("event_type") == FUND_EVENT).withColumnsRenamed({
        "id": "fund_id", "entity_id": "investor_id", "event_date": "fund_date", "name": "fund_name", "amount_amount": "invested_amount"})
    shown = entities.filter(c("disclosure_level").isin(*SHOWN_LEVELS)).select(c("entity_id").alias("investor_id"), c("entity_name").alias("investor_name"))
    df = df.join(shown, "investor_id")
    df = sequence_no(df, ["investor_id"], ["fund_date", "fund_id"], "fund_rank", split=split)
    return order_final(df.withColumn("fund_year", F.year("fund_date")), ["-fund_date", "fund_id"])


def public_funding(events: DataFrame, entities: DataFrame, users: DataFrame | None = None, split: bool = True) -> DataFrame:
    """Listings, private placements and bonds of public companies with exit and listing flags.

    Silent rounds are left out among placements and bonds only.
    """
    c = F.col
    placed = (c("event_type") == ROUND_EVENT) & c("funding_type_funding_type").isin(*PUBLIC_ROUNDS) & (c("is_silent_round") == 0)
    df = events.filter(c("event_type").isin(*LISTING_EVENTS) | placed)
    df = df.withColumnsRenamed({"id": "event_id", "entity_id": "company_id"})
    exits = exit_events(events, split).select("event_id", "is_exit")
    ipos = ipo_events(events, entities)
    df = df.join(exits, "event_id", "left").withColumn("is_exit", F.coalesce("is_exit", F.lit(0)))
    df = exists_flag(df, "event_id", ipos, "event_id", "is_ipo")
    kind = F.when(c("event_type") == ROUND_EVENT, c("funding_type_funding_type")).otherwise(c("event_type"))
    df = df.withColumn("event_type", kind)
    df = df.withColumns({"event_type_final": recode(c("event_type"), PUBLIC_LABELS, c("event_type")), "event_year": F.year("event_date")})
    return add_people(df, users).withColumnsRenamed({"created_date": "event_created_date", "updated_date": "event_updated_date"})


def public_funding_mart(funding: DataFrame, entities: DataFrame, only_ipo: bool = False) -> DataFrame:
    """Public funding of shown Israeli companies with the exchange; ``only_ipo`` gives the listing mart."""
    c = F.col
    shown = entities.filter(c("disclosure_level").isin(*SHOWN_LEVELS))
    company = shown.filter((c("is_israeli") == 1) & (c("entity_type") == "Company")).select(
        c("entity_id").alias("company_id"), c("entity_name").alias("company_name"), c("primary_sector_name").alias("company_primary_sector_name"))
    exchange = shown.select(
        c("entity_id").alias("stock_exchange_key"), c("entity_name").alias("stock_exchange_name"), c("entity_country").alias("stock_exchange_country"))
    df = funding.filter(c("is_ipo") == 1) if only_ipo else funding
    df = df.join(company, "company_id").join(exchange, "stock_exchange_key", "left")
    return order_final(df, ["-event_date", "-event_updated_date", "event_id"]) if only_ipo else df


def company_profile(
    entities: DataFrame, sectors: DataFrame, rounds: DataFrame, funding: DataFrame, acq: DataFrame, exits: DataFrame
) -> DataFrame:
    """Companies with sectors, funding totals, exit state and acquisitions on both sides."""
    c = F.col
    base = entities.filter(c("entity_type").isin("Foreign Startup", "Company"))
    levels = sectors.select("company_id", "sector", "sub_sector", "sub_sub_sector").distinct()
    quoted = lambda n: F.concat(F.lit('"'), c(n), F.lit('"'))
    # one text per level, in level order; NULL levels are skipped. Rows of a company are bounded by the tree.
    texts = summarize(levels, ["company_id"], {
        f"{n}s": F.nullif(F.array_join(F.array_sort(F.collect_list(quoted(n))), ", "), F.lit("")) for n in ("sector", "sub_sector", "sub_sub_sector")})
    private = summarize(rounds, ["company_id"], {
        "private_funding_amount": F.sum("amount"), "total_private_rounds": F.count_distinct("round_id"), "last_private_funding_date": F.max("round_date")})
    public = summarize(funding.filter(c("event_type_final").isin("PIPE", "Public Offering")), ["company_id"], {
        "public_funding_amount": F.sum("capital_raised"), "total_public_rounds": F.count_distinct("event_id")})
    bought = summarize(acq, [c("acquired_id")], {"was_acquired_count": F.count("event_id")})
    buys = summarize(acq, [c("acquirer_id")], {"acquired_other_count": F.count("event_id")})
    buyer = entities.select(c("entity_id").alias("acquirer_id"), c("entity_name").alias("last_acquirer_name"), c("entity_country").alias("last_acquirer_country"))
    last = keep_first(acq.select("acquired_id", "acquirer_id", "event_date", "event_id", "amount").join(buyer, "acquirer_id"), ["acquired_id"], ["-event_date", "event_id"])
    last = last.select(
        "acquired_id", c("event_date").alias("last_acquisition_date"), c("acquirer_id").alias("last_acquirer_id"), "last_acquirer_name",
        c("amount").alias("last_acquired_amount"), "last_acquirer_country")
    out_of = exits.filter((c("is_exit") == 1) & (c("exit_order") == 1)).select(c("acquired_id").alias("entity_id"), c("event_date").alias("exited_date"))

    key = "entity_id"
    df = base
    for side, k in ((texts, "company_id"), (last, "acquired_id"), (bought, "acquired_id"), (buys, "acquirer_id"), (private, "company_id"), (public, "company_id"), (out_of, key)):
        df = df.join(side.withColumnRenamed(k, key), key, "left")
    df = exists_flag(df, key, acq, "acquired_id", "is_acquired")
    df = exists_flag(df, key, exits.filter(c("is_exit") == 1), "acquired_id", "is_exited")
    zero = lambda n: F.coalesce(n, F.lit(0))
    return df.withColumns({
        "total_funding_amount": zero("private_funding_amount") + zero("public_funding_amount"),
        "total_rounds": zero("total_private_rounds") + zero("total_public_rounds"),
    }).drop("public_funding_amount", "total_public_rounds").withColumnsRenamed({"entity_id": "company_id", "entity_name": "company_name"})


def investor_profile(entities: DataFrame, rows: DataFrame, exits: DataFrame, tags: DataFrame, stages: DataFrame) -> DataFrame:
    """Investors with activity, exits, most frequent sector and stage, and stated preferences."""
    c = F.col
    base = entities.filter(c("entity_type") == "Investor").withColumnRenamed("entity_id", "investor_id")
    activity = summarize(rows, ["investor_id"], {
        "num_investments": F.count_distinct("round_id"), "last_investment_date": F.max("round_date"), "num_startups_invested": F.count_distinct("company_id")})
    gone = rows.join(exits.select(c("acquired_id").alias("company_id")).distinct(), "company_id")
    exited = summarize(gone, ["investor_id"], {"exited_startups": F.count_distinct("company_id")})
    of_company = entities.select(c("entity_id").alias("company_id"), "primary_sector_name")
    sector = top_with_ties(rows.join(of_company, "company_id"), "investor_id", "primary_sector_name", F.count_distinct("company_id"), "actual_sector")
    stage = top_with_ties(rows, "investor_id", "round_type", F.count_distinct("round_id"), "actual_stage")
    wishes = summarize(tags, [c("entity_id").alias("investor_id")], {
        "industry_preferences": F.array_join(F.array_sort(F.collect_list("tag_name")), ", ")})
    aims = string_agg_distinct(investment_stages(stages), ["entity_id"], "stage_category", "target_investment_stages", ", ").withColumnRenamed("entity_id", "investor_id")
    df = base
    for side in (activity, exited, sector, stage, wishes, aims):
        df = df.join(side, "investor_id", "left")
    return df.withColumn("actual_sector", sector_short_name(c("actual_sector"))).withColumnRenamed("entity_name", "investor_name")


def multinational_profile(entities: DataFrame, acq: DataFrame) -> DataFrame:
    """Multinationals with their acquisitions."""
    c = F.col
    totals = summarize(acq, [c("acquirer_id").alias("entity_id")], {
        "last_acquisition_date": F.max("event_date"), "total_acquisitions": F.count_distinct("event_id"), "total_acquisition_amount": F.sum("amount")})
    out = entities.filter(c("entity_type") == "Multinational").join(totals, "entity_id", "left")
    return out.withColumnsRenamed({"entity_id": "mnc_id", "entity_name": "mnc_name"})


def hub_profile(entities: DataFrame, rows: DataFrame) -> DataFrame:
    """Accelerators, programs, communities and co-working spaces with their investments."""
    c = F.col
    totals = summarize(rows, [c("investor_id").alias("entity_id")], {"last_investment": F.max("round_date"), "total_investments": F.count_distinct("round_id")})
    out = entities.filter(c("entity_type").isin(*HUB_TYPES)).join(totals, "entity_id", "left")
    return out.withColumnsRenamed({"entity_id": "hub_id", "entity_name": "hub_name"})


def profile(entities: DataFrame, kind: str, **facts: DataFrame) -> DataFrame:
    """Profile of one kind of entity: company, investor, multinational or hub."""
    makers = {"company": company_profile, "investor": investor_profile, "multinational": multinational_profile, "hub": hub_profile}
    return makers[kind](entities, **facts)


def yearly_activity(entities: DataFrame, hi: int, lo: int = 2000) -> DataFrame:
    """Entity × year from founding to closing with active, opened and closed flags.

    The years are generated per row and only within the entity's life.
    """
    c = F.col
    kinds = ["Company", "Multinational", "Investor", *HUB_TYPES]
    df = entities.filter(c("entity_type").isin(*kinds) & c("disclosure_level").isin(*SHOWN_LEVELS))
    df = df.withColumn("entity_type", F.when(c("entity_type").isin(*HUB_TYPES), "Hub").otherwise(c("entity_type")))
    df = year_spine(df, lo, hi)
    y, born, gone = c("year"), c("founded_year"), c("closed_year")
    df = df.filter((born.isNull() | (y >= born)) & (gone.isNull() | (y <= gone)))
    flag = lambda cond: F.when(cond, 1).otherwise(0)
    # rows outside the life span are gone, so activity only asks for a known founding year
    return df.withColumns({
        "activity_id": surrogate_key("entity_id", "year"), "was_active": flag(born.isNotNull()), "was_opened_in_the_year": flag(born == y),
        "was_closed_in_the_year": flag(gone == y), "is_active_today": flag(c("is_active") == 1),
    }).drop("is_active")


def residual_events(events: DataFrame, claimed: Sequence[DataFrame], entities: DataFrame | None = None) -> DataFrame:
    """Events no other fact table claims. ``claimed`` are DataFrames with ``event_id``; closings are left out."""
    c = F.col
    df = events.filter(c("event_type") != CLOSING_EVENT)
    df = not_in(df, "id", stack(*[d.select("event_id") for d in claimed]), "event_id").withColumnRenamed("id", "event_id")
    df = df.withColumns({"event_category": recode(c("event_type"), OTHER_EVENTS, c("event_type")), "event_year": F.year("event_date")})
    if entities is not None:
        df = df.join(entities.select("entity_id").distinct(), "entity_id")
        parties = {"institution": "institution_entity_key", "target": "other_party_entity_key"}
        roles = {r: k for r, k in parties.items() if k in df.columns}
        names = entities.select("entity_id", F.col("entity_name").alias("name"), F.col("entity_type").alias("type"))
        df = role_join(df, names, roles, "entity_id", ["name", "type"])
    return df


def closing_dates(events: DataFrame) -> DataFrame:
    """Last closing event per entity."""
    c = F.col
    df = events.filter((c("event_type") == CLOSING_EVENT) & c("event_date").isNotNull())
    df = keep_first(df.select("entity_id", "event_date", "created_date", "reason", "id"), ["entity_id"], ["-event_date", "-created_date", "id"])
    return df.select("entity_id", c("event_date").alias("closed_date"), initcap_words(F.replace("reason", F.lit("_"), F.lit(" "))).alias("closed_reason"))


def _text_list(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    rows = df.filter(F.col(value).isNotNull())
    return rows.groupBy(F.col(key).alias("company_id")).agg(F.array_join(F.array_sort(F.collect_list(value)), ", ").alias(name))


def entity_master(
    company: DataFrame, classes: DataFrame, users: DataFrame, events: DataFrame, *, list_members: DataFrame, lists: DataFrame, members: DataFrame,
    business_models: DataFrame | None = None, markets: DataFrame | None = None, alternative_names: DataFrame | None = None,
    hide_reasons: DataFrame | None = None, aggregation_reasons: Sequence[str] = (), site: str = "", logo_site: str = "",
) -> DataFrame:
    """Entities with sector names, closing, followers, members, corporate arms and disclosure level.

    ``classes``: classification_id, sector_name, root_key. ``aggregation_reasons``
    are the hide reasons that still allow the entity to be counted.
    """
    c = F.col
    nodes = classes.select(c("classification_id").alias("primary_sector_key"), c("sector_name").alias("primary_sector_name"), c("root_key").alias("__root"))
    roots = classes.select(c("classification_id").alias("__root"), c("sector_name").alias("__root_name"))
    followers = list_members.select("collection_id", "company_id").join(lists.filter(c("owner_id").isNotNull()).select("collection_id", "owner_id"), "collection_id")
    followers = summarize(followers, ["company_id"], {"num_followers": F.count_distinct("owner_id")})
    staff = summarize(members.filter(c("delete_reason").isNull()), ["company_id"], {
        "num_members": F.count_distinct("member_id"), "num_claimed_members": F.count_distinct(F.when(c("claimed") == 1, c("member_id")))})
    arms = link_by_name(company.select("company_id", "company_name", "supporting_arm_name"), "supporting_arm_name", "company_name", "company_id")
    arms = arms.filter(c("parent_id").isNotNull()).select(c("parent_id").alias("company_id"), c("arms_list").alias("arms"))

    df = company.join(nodes, "primary_sector_key", "left").join(roots, "__root", "left").drop("__root")
    sides = [followers, staff, arms, closing_dates(events).withColumnRenamed("entity_id", "company_id")]
    for extra, value, name in ((business_models, "business_model", "business_model"), (markets, "market", "geographic_markets")):
        if extra is not None:
            sides.append(_text_list(extra, "company_id", value, name))
    if alternative_names is not None:
        sides.append(_text_list(alternative_names, "entity_id", "alternative_name", "common_misspellings"))
    for side in sides:
        df = df.join(side, "company_id", "left")
    who = users.select("user_id", "email", F.concat("first_name", F.lit(" "), "last_name").alias("name"))
    roles = {r: k for r, k in {"creator": "creator_id", "bi_verify": "bi_verify_key", "angel_user": "user_key"}.items() if k in df.columns}
    df = role_join(df, who, roles, "user_id", ["email", "name"])
    if hide_reasons is not None:
        why = hide_reasons.select(c("hide_reason_id").alias("hide_reason"), "reason_description")
        df = df.join(why, "hide_reason", "left")
    reason = c("hide_reason")
    closed = F.when(c("active") == 0, c("closed_date"))
    level = F.when(reason.isNull(), "all").when(reason.isin(*aggregation_reasons) if aggregation_reasons else F.lit(False), "aggregation").otherwise("none")
    df = df.withColumns({
        "entity_type": F.when(c("company_type") == "Startup", "Company").otherwise(c("company_type")),
        "primary_sector_short_name": sector_short_name(c("primary_sector_name")),
        "primary_sector_parent": F.nullif("__root_name", c("primary_sector_name")),
        "founded_date": F.when(c("founded_year").isNotNull(), first_of_month(c("founded_year"), c("founded_month"))),
        "closed_year": F.year(closed), "closed_month": F.month(closed),
        "num_followers": F.coalesce("num_followers", F.lit(0)),
        "disclosure_level": level,
        "hide_reason_id": reason,
        "hide_reason": F.coalesce("reason_description", reason) if hide_reasons is not None else reason,
    }).drop("__root_name", "reason_description")
    if "full_url" in df.columns:
        df = df.withColumn("entity_site_url", F.concat(F.lit(site), "full_url"))
    if "logo_file_name" in df.columns:
        df = df.withColumn("entity_logo_url", F.concat(F.lit(logo_site), "logo_file_name"))
    renames = {
        "company_id": "entity_id", "company_name": "entity_name", "company_subtype": "entity_sub_type", "country": "entity_country", "active": "is_active",
        "claimed": "is_claimed", "supporting_arm_name": "representing_of_name",
    }
    return df.withColumnsRenamed(renames).drop("company_type")


def companies_with_sector(companies: DataFrame, classes: DataFrame) -> DataFrame:
    """Companies with the name of their primary sector and of its root, where that differs."""
    c = F.col
    nodes = classes.select(c("classification_id").alias("primary_sector_key"), c("sector_name").alias("company_primary_sector"), c("root_key").alias("__root"))
    roots = classes.select(c("classification_id").alias("__root"), c("sector_name").alias("__root_name"))
    df = companies.join(nodes, "primary_sector_key", "left").join(roots, "__root", "left")
    return df.withColumn("company_primary_sector_parent", F.nullif("__root_name", c("company_primary_sector"))).drop("__root", "__root_name")


def entity_tags(tags: DataFrame, entities: DataFrame) -> DataFrame:
    """Named tags with the entity's name and type."""
    named = tags.filter(F.col("tag_name").isNotNull()).select("tag_id", F.col("company_id").alias("entity_id"), "tag_name")
    return named.join(entities.select("entity_id", "entity_name", "entity_type"), "entity_id")
