"""Ecosystem plans on stand-in inputs: customers and suppliers are entities, orders are business events, lineitems are participations."""

from __future__ import annotations

from pyspark.sql import functions as F

from martlib.catalog.registry import query, table
from martlib.plans import ecosystem as X
from martlib.plans import hierarchy as H
from martlib.plans import staging as ST

TYPES = ["MNAEvent", "POEvent", "FundingRoundEvent", "FundingRoundEvent", "SpacEvent", "GrantEvent", "ClosingEvent", "FundingRoundEvent", "InvestmentFirmFundingEvent", "ReverseMergerEvent"]
ROUNDS = ["A Round", "Seed", "Convertible Debt", "PIPE", None, "B Round", "Convertible Bond", "Odd Round"]


def _sql_list(values):
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


# Business events as delivered (before cleaning) and cleaned.
EVENTS = f"""
raw AS (SELECT o_orderkey AS id, o_custkey AS entity_id, {_sql_list(TYPES)}[(o_orderkey + o_custkey) % 10 + 1] AS event_type,
  CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS event_date, CAST(o_orderdate AS DATE) + 1 AS created_date, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 90 AS INTEGER) AS updated_date,
  CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice * 3000 END AS amount, {_sql_list(ROUNDS)}[o_orderkey % 8 + 1] AS kind,
  CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS silent, CASE WHEN o_orderkey % 4 <> 0 THEN 1 ELSE 0 END AS was_acquired, o_custkey * 7 % 1500 AS other_party, o_orderkey % 100 AS creator_key,
  o_custkey % 100 AS updater_key, 'src' || (o_orderkey % 3) AS source, o_totalprice AS capital_raised, 'Fund ' || (o_orderkey % 50) AS fund_name FROM orders)
"""


def raw_events(spark, d):
    """Rows as delivered: epoch dates, empty texts and zero amounts stand for missing values."""
    c = F.col
    k, e = c("o_orderkey"), c("o_custkey")
    pick = lambda vals, i: F.element_at(F.array(*[F.lit(v) for v in vals]), (i + 1).cast("int"))
    day = c("o_orderdate").cast("date")
    return table(spark, d, "orders").select(
        k.alias("id"), e.alias("company_key"), pick(TYPES, (k + e) % 10).alias("event_type"),
        F.when(k % 40 == 0, F.lit("1970-01-01").cast("date")).otherwise(day).alias("date"), F.date_add(day, 1).alias("created_date"),
        F.date_add(day, (k % 90).cast("int")).alias("updated_date"), F.when(k % 6 == 0, 0.0).otherwise(c("o_totalprice") * 3000).alias("amount_amount"),
        F.coalesce(pick(ROUNDS, k % 8), F.lit("")).alias("funding_type_funding_type"), F.when(k % 9 == 0, 1).alias("is_silent_round"),
        F.when(k % 4 != 0, 1).otherwise(0).alias("was_acquired"), (e * 7 % 1500).alias("other_party_entity_key"), (k % 100).alias("creator_key"),
        (e % 100).alias("updator_key"), F.concat(F.lit("src"), (k % 3).cast("string")).alias("source"), c("o_totalprice").alias("capital_raised"),
        F.concat(F.lit("Fund "), (k % 50).cast("string")).alias("name"), (k * 3 % 1500).alias("stock_exchange_key"), (e * 11 % 1500).alias("institution_entity_key"),
    )


def events(spark, d):
    return ST.stage(raw_events(spark, d), "base_event")


ENTITIES = """
ent AS (SELECT c_custkey AS entity_id, c_name AS entity_name, ['Company', 'Company', 'Investor', 'Multinational', 'Accelerator', 'Foreign Startup'][c_custkey % 6 + 1] AS entity_type,
  CASE WHEN c_custkey % 12 = 2 THEN 'Angel' ELSE 'VC' END AS entity_sub_type, c_custkey % 5 <> 0 AS home, CASE WHEN c_custkey % 5 <> 0 THEN 1 ELSE 0 END AS is_israeli, CASE WHEN c_custkey % 5 <> 0 THEN 'Israel' ELSE 'France' END AS entity_country,
  ['all', 'aggregation', 'none'][c_custkey % 3 + 1] AS disclosure_level, c_mktsegment AS primary_sector_name, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END AS is_active,
  CASE WHEN c_custkey % 8 <> 0 THEN CAST(1990 + c_custkey % 30 AS INTEGER) END AS founded_year, CASE WHEN c_custkey % 7 = 0 THEN CAST(2000 + c_custkey % 20 AS INTEGER) END AS closed_year FROM customer)
"""


def entities(spark, d):
    c, k = F.col, F.col("c_custkey")
    pick = lambda vals, i: F.element_at(F.array(*[F.lit(v) for v in vals]), (i + 1).cast("int"))
    return table(spark, d, "customer").select(
        k.alias("entity_id"), c("c_name").alias("entity_name"), pick(["Company", "Company", "Investor", "Multinational", "Accelerator", "Foreign Startup"], k % 6).alias("entity_type"),
        F.when(k % 12 == 2, "Angel").otherwise("VC").alias("entity_sub_type"), F.when(k % 5 != 0, 1).otherwise(0).alias("is_israeli"),
        F.when(k % 5 != 0, "Israel").otherwise("France").alias("entity_country"), pick(["all", "aggregation", "none"], k % 3).alias("disclosure_level"),
        c("c_mktsegment").alias("primary_sector_name"), F.when(k % 7 == 0, 0).otherwise(1).alias("is_active"),
        F.when(k % 8 != 0, (1990 + k % 30).cast("int")).alias("founded_year"), F.when(k % 7 == 0, (2000 + k % 20).cast("int")).alias("closed_year"),
    )


def companies(spark, d):
    c = F.col
    return entities(spark, d).select(
        c("entity_id").alias("company_id"), c("entity_name").alias("company_name"), "is_israeli", c("entity_type").alias("company_type"),
        c("entity_sub_type").alias("company_subtype"), c("entity_country").alias("country"))


USERS = "usr AS (SELECT s_suppkey AS user_id, s_name || '@x.org' AS email, 'F' || (s_suppkey % 10) AS first_name, CASE WHEN s_suppkey % 9 <> 0 THEN s_name END AS last_name FROM supplier)"


def users(spark, d):
    k = F.col("s_suppkey")
    return table(spark, d, "supplier").select(
        k.alias("user_id"), F.concat("s_name", F.lit("@x.org")).alias("email"), F.concat(F.lit("F"), (k % 10).cast("string")).alias("first_name"),
        F.when(k % 9 != 0, F.col("s_name")).alias("last_name"))


def participation(spark, d):
    c = F.col
    return table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("investment_id"), c("l_orderkey").alias("round_id"), c("l_suppkey").alias("investor_id"),
        F.when(c("l_linenumber") == 1, 1).otherwise(0).alias("is_lead"), c("l_extendedprice").alias("investor_amount"))


PART = "part_ AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS investment_id, l_orderkey AS round_id, l_suppkey AS investor_id, CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS is_lead FROM lineitem)"
_EXITS = """
ex0 AS (SELECT * FROM raw WHERE (event_type = 'MNAEvent' AND was_acquired = 1) OR event_type IN ('POEvent', 'SpacEvent', 'ReverseMergerEvent')),
ex AS (SELECT *, CASE WHEN dense_rank() OVER (PARTITION BY entity_id ORDER BY event_date NULLS FIRST) = 1 THEN 1 ELSE 0 END AS is_exit,
  CAST(row_number() OVER (PARTITION BY entity_id ORDER BY event_date NULLS FIRST, id) AS INTEGER) AS exit_order FROM ex0)
"""


@query("b6_stage_base_event", "WITH " + EVENTS + """
SELECT id, entity_id, event_type, event_date, amount AS amount_amount, kind AS funding_type_funding_type, silent AS is_silent_round FROM raw
""")
def _(spark, d):
    return events(spark, d).select("id", "entity_id", "event_type", "event_date", "amount_amount", "funding_type_funding_type", "is_silent_round")


@query("b6_stage_companies", """
SELECT c_custkey AS company_id, c_name AS company_name, CASE WHEN c_custkey % 3 = 0 THEN 'Israel' WHEN c_custkey % 3 = 1 THEN 'United States' ELSE 'Bad Island' END AS country,
  CASE WHEN c_custkey % 3 = 0 THEN 'IL' WHEN c_custkey % 3 = 1 THEN 'US' END AS country_iso_code, 1 AS is_valid_country, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS is_israeli,
  CASE WHEN c_custkey % 4 <> 0 THEN 'tag' END AS tag_line, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 5 AS INTEGER) END AS founded_month, 0 AS claimed FROM customer WHERE c_name <> 'Customer#000000003'
""")
def _(spark, d):
    c, k = F.col, F.col("c_custkey")
    raw = table(spark, d, "customer").select(
        k.alias("id"), c("c_name").alias("name"), F.when(k % 3 == 0, "Startup").otherwise("Investor").alias("type"),
        F.when(k % 3 == 1, " usa").otherwise("BAD island").alias("country"), F.when(k % 4 != 0, "tag").otherwise("").alias("tag_line"), (k % 5).cast("int").alias("founded_month"),
        F.lit(None).cast("int").alias("claimed"))
    out = ST.stage_companies(raw, ("Customer#000000003",))
    return out.select("company_id", "company_name", "country", "country_iso_code", "is_valid_country", "is_israeli", "tag_line", "founded_month", "claimed")


@query("p16_exit_events", "WITH " + EVENTS + "," + _EXITS + "SELECT id AS event_id, entity_id AS acquired_id, is_exit, exit_order FROM ex")
def _(spark, d):
    return X.exit_events(events(spark, d)).select("event_id", "acquired_id", "is_exit", "exit_order")


_IPO = """
ip AS (SELECT ex0.*, dense_rank() OVER (PARTITION BY ex0.entity_id ORDER BY event_date NULLS FIRST) AS rk, e.is_israeli, e.entity_type FROM ex0 JOIN ent e USING (entity_id)),
ipo AS (SELECT * FROM ip WHERE rk = 1 AND event_type IN ('POEvent', 'SpacEvent', 'ReverseMergerEvent') AND is_israeli = 1 AND entity_type = 'Company')
"""


@query("p16_ipo_events", "WITH " + EVENTS + "," + _EXITS + "," + ENTITIES + "," + _IPO + """
SELECT id AS event_id, entity_id, 1 AS is_ipo, CASE WHEN event_type = 'POEvent' THEN 1 ELSE 0 END AS is_first_ipo FROM ipo
""")
def _(spark, d):
    return X.ipo_events(events(spark, d), entities(spark, d)).select("event_id", "entity_id", "is_ipo", "is_first_ipo")


@query("j5_relation_functions", "WITH " + EVENTS + "," + _EXITS + "," + ENTITIES + "," + _IPO + "SELECT 'exit' AS kind, id AS event_id FROM ex UNION ALL SELECT 'ipo', id FROM ipo")
def _(spark, d):
    ev = events(spark, d)
    a = X.exit_events(ev, split=False).select(F.lit("exit").alias("kind"), "event_id")
    return a.union(X.ipo_events(ev, entities(spark, d)).select(F.lit("ipo"), "event_id"))


_PRIVATE = """
pub AS (SELECT entity_id, MIN(event_date) AS first_public FROM raw WHERE event_type IN ('POEvent', 'SpacEvent', 'ReverseMergerEvent') AND event_date IS NOT NULL GROUP BY 1),
pr0 AS (SELECT raw.*, first_public FROM raw LEFT JOIN pub USING (entity_id) WHERE event_type = 'FundingRoundEvent' AND (kind IN ('A Round', 'Seed', 'Convertible Debt', 'B Round') OR kind IS NULL) AND silent = 0),
pr1 AS (SELECT pr0.* FROM pr0 JOIN ent e USING (entity_id) WHERE is_israeli = 1 AND entity_type <> 'Foreign Startup' AND NOT COALESCE(kind = 'Convertible Debt' AND first_public IS NOT NULL AND event_date > first_public, FALSE)),
pr AS (SELECT *, lag(event_date) OVER w AS prior_round_date, lag(kind) OVER w AS prior_round_type, lag(amount) OVER w AS prior_round_amount,
  CAST(row_number() OVER (PARTITION BY entity_id ORDER BY COALESCE(event_date, created_date), id) AS INTEGER) AS round_rank,
  CASE WHEN amount IS NULL THEN 'Undisclosed' WHEN amount < 1e8 THEN 'Small Round (<100M)' WHEN amount < 5e8 THEN 'Medium Round (100M-500M)' WHEN amount < 1e9 THEN 'Large Round (500M-1B)' ELSE 'Mega Round (1B+)' END AS round_size_category
  FROM pr1 WINDOW w AS (PARTITION BY entity_id ORDER BY event_date NULLS FIRST, id))
"""
_PRIVATE_COLS = ["round_id", "company_id", "round_date", "round_type", "round_rank", "round_size_category", "prior_round_date", "prior_round_type", "prior_round_amount", "event_creator_name", "event_updater_email"]


def rounds(spark, d, split=True):
    return X.private_rounds(events(spark, d), companies(spark, d), users(spark, d), split)


_P17 = "WITH " + EVENTS + "," + ENTITIES + "," + USERS + "," + _PRIVATE + """
SELECT id AS round_id, entity_id AS company_id, event_date AS round_date, kind AS round_type, round_rank, round_size_category, prior_round_date, prior_round_type, prior_round_amount,
  a.first_name || ' ' || a.last_name AS event_creator_name, b.email AS event_updater_email FROM pr LEFT JOIN usr a ON creator_key = a.user_id LEFT JOIN usr b ON updater_key = b.user_id
"""


@query("p17_private_rounds", _P17)
def _(spark, d):
    return rounds(spark, d).select(*_PRIVATE_COLS)


@query("p17_private_rounds_split", _P17)
def _(spark, d):
    return rounds(spark, d, True).select(*_PRIVATE_COLS)


_INV = """
ir0 AS (SELECT p.*, r.entity_id AS company_id, r.event_date AS round_date, r.kind AS round_type, r.amount FROM part_ p JOIN raw r ON r.id = p.round_id WHERE event_type = 'FundingRoundEvent' AND silent = 0),
fi AS (SELECT investor_id, MIN(round_date) AS first_investment_date FROM ir0 GROUP BY 1),
ir AS (SELECT ir0.*, e.entity_country AS investor_country, e.entity_type AS investor_type, e.entity_sub_type AS investor_sub_type, first_investment_date,
  CASE WHEN first_investment_date = round_date THEN 1 ELSE 0 END AS is_first_investment_ever FROM ir0 JOIN ent e ON e.entity_id = ir0.investor_id LEFT JOIN fi USING (investor_id))
"""


def investor_rows(spark, d):
    return X.investor_rounds(events(spark, d), participation(spark, d), companies(spark, d), users(spark, d))


@query("p17_private_funding", "WITH " + EVENTS + "," + ENTITIES + "," + PART + "," + _PRIVATE + "," + _INV + """,
rp AS (SELECT round_id, COUNT(DISTINCT CASE WHEN investor_country = 'Israel' THEN investor_id END) AS num_israeli_investors, COUNT(DISTINCT CASE WHEN investor_country <> 'Israel' THEN investor_id END) AS num_global_investors,
  COUNT(DISTINCT investor_id) AS num_investors, COUNT(DISTINCT CASE WHEN investor_sub_type = 'Angel' THEN investor_id END) AS num_angels FROM ir GROUP BY 1)
SELECT id AS round_id, e.primary_sector_name AS company_primary_sector_name, round_rank, num_israeli_investors, num_global_investors, num_investors, num_angels,
  CASE WHEN rp.round_id IS NULL THEN NULL WHEN num_global_investors = 0 THEN 'Israeli Only' WHEN num_israeli_investors = 0 THEN 'Global Only' ELSE 'Both' END AS investors_origin
FROM pr JOIN ent e USING (entity_id) LEFT JOIN rp ON rp.round_id = pr.id WHERE e.disclosure_level IN ('all', 'aggregation')
""")
def _(spark, d):
    out = X.private_funding(rounds(spark, d), entities(spark, d), investor_rows(spark, d))
    return out.select("round_id", "company_primary_sector_name", "round_rank", "num_israeli_investors", "num_global_investors", "num_investors", "num_angels", "investors_origin")


_ACQ = """
ac AS (SELECT *, CASE WHEN dense_rank() OVER (PARTITION BY entity_id ORDER BY event_date NULLS FIRST) = 1 THEN 1 ELSE 0 END AS is_first_mna FROM ex WHERE event_type = 'MNAEvent'),
an AS (SELECT *, row_number() OVER (PARTITION BY other_party ORDER BY COALESCE(event_date, created_date), id) AS no, MIN(event_date) OVER (PARTITION BY other_party) AS first_date FROM ac)
"""


def acquired(spark, d):
    return X.acquisitions(events(spark, d), users(spark, d))


@query("p18_acquisition_facts", "WITH " + EVENTS + "," + _EXITS + "," + ENTITIES + "," + _ACQ + """
SELECT id AS event_id, a.entity_id AS acquired_id, t.entity_name AS acquired_name, b.entity_name AS acquirer_name, is_exit, is_first_mna, CAST(year(event_date) AS INTEGER) AS event_year, first_date AS first_acquirer_acquisition_date,
  CASE WHEN amount IS NULL THEN 'Undisclosed' WHEN amount < 1e8 THEN 'Small (<100M)' WHEN amount < 1e9 THEN 'Medium (100M-1B)' ELSE 'Large (1B+)' END AS deal_size_category,
  CASE WHEN no = 1 THEN 'First Acquisition' WHEN no <= 5 THEN '2-5 Acquisition' ELSE '6+ Acquisition' END AS acquirer_experience_tier,
  CASE WHEN b.entity_type = 'Investor' THEN 'Financial Acquirer' WHEN b.entity_type IN ('Multinational', 'Foreign Startup') THEN 'Strategic Acquirer' WHEN b.entity_type = 'Company' AND b.is_israeli = 1 THEN 'Israeli Company' ELSE 'Other' END AS acquirer_category
FROM an a JOIN ent t ON t.entity_id = a.entity_id JOIN ent b ON b.entity_id = other_party WHERE t.entity_type = 'Company' AND t.disclosure_level IN ('all', 'aggregation')
""")
def _(spark, d):
    out = X.acquisition_facts(acquired(spark, d), entities(spark, d))
    return out.select("event_id", "acquired_id", "acquired_name", "acquirer_name", "is_exit", "is_first_mna", "event_year", "first_acquirer_acquisition_date", "deal_size_category", "acquirer_experience_tier", "acquirer_category")


_PUBLIC = """
pf AS (SELECT r.id, r.entity_id, r.event_date, r.capital_raised, CASE WHEN r.event_type = 'FundingRoundEvent' THEN r.kind ELSE r.event_type END AS et, COALESCE(ex.is_exit, 0) AS is_exit,
  CASE WHEN r.id IN (SELECT id FROM ipo) THEN 1 ELSE 0 END AS is_ipo FROM raw r LEFT JOIN ex USING (id)
  WHERE r.event_type IN ('POEvent', 'SpacEvent', 'ReverseMergerEvent') OR r.event_type = 'FundingRoundEvent' AND r.kind IN ('PIPE', 'Convertible Bond') AND r.silent = 0),
pfl AS (SELECT *, CASE et WHEN 'POEvent' THEN 'Public Offering' WHEN 'ReverseMergerEvent' THEN 'Reverse Merger' WHEN 'SpacEvent' THEN 'SPAC' ELSE et END AS event_type_final FROM pf)
"""


def public(spark, d):
    return X.public_funding(events(spark, d), entities(spark, d), users(spark, d))


_PUBLIC_WITH = "WITH " + EVENTS + "," + _EXITS + "," + ENTITIES + "," + _IPO + "," + _PUBLIC


@query("p16_public_funding", _PUBLIC_WITH + "SELECT id AS event_id, event_type_final, is_exit, is_ipo, capital_raised FROM pfl")
def _(spark, d):
    return public(spark, d).select("event_id", "event_type_final", "is_exit", "is_ipo", "capital_raised")


@query("p16_ipo_mart", _PUBLIC_WITH + """
SELECT id AS event_id, e.entity_name AS company_name, CASE WHEN s.disclosure_level IN ('all', 'aggregation') THEN s.entity_name END AS stock_exchange_name FROM pfl JOIN ent e USING (entity_id)
LEFT JOIN ent s ON s.entity_id = pfl.id * 3 % 1500 WHERE is_ipo = 1 AND e.disclosure_level IN ('all', 'aggregation')
""")
def _(spark, d):
    return X.public_funding_mart(public(spark, d), entities(spark, d), only_ipo=True).select("event_id", "company_name", "stock_exchange_name")


_TREE = """
nodes AS (SELECT 'r' || r_regionkey AS classification_id, r_name AS sector_name, 0 AS depth, 'r' || r_regionkey AS root_key FROM region
  UNION ALL SELECT 'n' || n_nationkey, n_name, 1, 'r' || n_regionkey FROM nation
  UNION ALL SELECT 'c' || k, 'Leaf ' || k, 2, 'r' || (k % 5) FROM (SELECT DISTINCT p_size AS k FROM part)),
edges AS (SELECT 'r' || n_regionkey AS parent_key, 'n' || n_nationkey AS child_key FROM nation UNION ALL SELECT DISTINCT 'n' || (p_size % 25), 'c' || p_size FROM part WHERE p_size % 3 <> 0),
asg AS (SELECT DISTINCT c_custkey AS company_id, 'n' || c_nationkey AS classification_id FROM customer
  UNION SELECT DISTINCT o_custkey, 'c' || (o_orderkey % 50 + 1) FROM orders WHERE o_orderstatus = 'F' UNION SELECT DISTINCT o_custkey, 'r' || (o_orderkey % 5) FROM orders WHERE o_orderstatus = 'P'
  UNION SELECT DISTINCT o_custkey, 'n' || (o_orderkey % 25) FROM orders WHERE o_orderpriority = '1-URGENT'),
cc AS (SELECT company_id, n.* FROM asg JOIN nodes n USING (classification_id)),
d1 AS (SELECT company_id, root_key, COUNT(*) AS n1, MAX(classification_id) AS p FROM cc WHERE depth = 1 GROUP BY 1, 2),
rel AS (SELECT * FROM edges UNION SELECT p, classification_id FROM cc JOIN d1 USING (company_id, root_key) WHERE depth = 2 AND n1 = 1 AND classification_id NOT IN (SELECT child_key FROM edges)),
leaves AS (SELECT * FROM cc WHERE NOT EXISTS (SELECT 1 FROM rel JOIN cc ch ON ch.classification_id = rel.child_key WHERE rel.parent_key = cc.classification_id AND ch.company_id = cc.company_id)
  AND NOT (depth = 0 AND EXISTS (SELECT 1 FROM cc o WHERE o.company_id = cc.company_id AND o.root_key = cc.root_key AND o.depth > cc.depth))),
tree AS (SELECT DISTINCT l.company_id, s.sector_name AS sector, CASE WHEN l.depth = 0 THEN NULL WHEN l.depth = 2 AND pn.sector_name IS NOT NULL THEN pn.sector_name ELSE l.sector_name END AS sub_sector,
  CASE WHEN l.depth = 2 AND pn.sector_name IS NOT NULL THEN l.sector_name END AS sub_sub_sector FROM leaves l LEFT JOIN nodes s ON s.depth = 0 AND s.root_key = l.root_key
  LEFT JOIN rel ON rel.child_key = l.classification_id AND l.depth = 2 LEFT JOIN nodes pn ON pn.classification_id = rel.parent_key)
"""


def sector_rows(spark, d):
    c, lit = F.col, F.lit
    kind = "SectorClassificationModel"
    s = lambda prefix, k: F.concat(lit(prefix), k.cast("string"))
    part = table(spark, d, "part")
    leaf = part.select(c("p_size").alias("k")).distinct()
    nodes = table(spark, d, "region").select(s("r", c("r_regionkey")).alias("classification_id"), c("r_name").alias("sector_name"), lit(0).alias("depth"), s("r", c("r_regionkey")).alias("root_key"))
    nodes = nodes.union(table(spark, d, "nation").select(s("n", c("n_nationkey")), "n_name", lit(1), s("r", c("n_regionkey"))))
    nodes = nodes.union(leaf.select(s("c", c("k")), F.concat(lit("Leaf "), c("k").cast("string")), lit(2), s("r", c("k") % 5)))
    edges = table(spark, d, "nation").select(s("r", c("n_regionkey")).alias("parent_key"), s("n", c("n_nationkey")).alias("child_key"))
    edges = edges.union(part.filter("p_size % 3 <> 0").select(s("n", c("p_size") % 25), s("c", c("p_size"))).distinct())
    o, k = table(spark, d, "orders"), c("o_orderkey")
    assign = table(spark, d, "customer").select(c("c_custkey").alias("company_id"), s("n", c("c_nationkey")).alias("classification_id"))
    assign = assign.union(o.filter("o_orderstatus = 'F'").select("o_custkey", s("c", k % 50 + 1))).union(o.filter("o_orderstatus = 'P'").select("o_custkey", s("r", k % 5)))
    assign = assign.union(o.filter("o_orderpriority = '1-URGENT'").select("o_custkey", s("n", k % 25))).distinct()
    return H.resolve_hierarchy(
        assign.withColumn("classification_category", lit(kind)), nodes.withColumn("classification_type", lit(kind)), edges.withColumn("classification_type", lit(kind)), "sector")


@query("p15_resolve_hierarchy", "WITH " + _TREE + "SELECT company_id, sector, sub_sector, sub_sub_sector FROM tree")
def _(spark, d):
    return sector_rows(spark, d).drop("company_sector_id")


@query("p15_classification_mart", "WITH " + ENTITIES + "," + _TREE + """
SELECT company_id, entity_name AS company_name, sector, sub_sector, sub_sub_sector FROM tree JOIN ent ON entity_id = company_id WHERE entity_type = 'Company'
""")
def _(spark, d):
    return H.classification_mart(sector_rows(spark, d), entities(spark, d)).drop("company_sector_id")


@query("p19_company_profile", _PUBLIC_WITH + "," + _PRIVATE + "," + _ACQ + "," + _TREE + """,
tx AS (SELECT company_id, string_agg('"' || sector || '"', ', ' ORDER BY sector) AS sectors, string_agg('"' || sub_sector || '"', ', ' ORDER BY sub_sector) AS sub_sectors,
  string_agg('"' || sub_sub_sector || '"', ', ' ORDER BY sub_sub_sector) AS sub_sub_sectors FROM tree GROUP BY 1),
pa AS (SELECT entity_id, SUM(amount) AS amt, COUNT(DISTINCT id) AS n, MAX(event_date) AS last_private_funding_date FROM pr GROUP BY 1),
pu AS (SELECT entity_id, SUM(capital_raised) AS amt2, COUNT(DISTINCT id) AS n2 FROM pfl WHERE event_type_final IN ('PIPE', 'Public Offering') GROUP BY 1),
la AS (SELECT a.entity_id, a.event_date AS last_acquisition_date, b.entity_name AS last_acquirer_name, a.amount AS last_acquired_amount FROM ac a JOIN ent b ON b.entity_id = other_party
  QUALIFY row_number() OVER (PARTITION BY a.entity_id ORDER BY a.event_date DESC NULLS LAST, a.id) = 1),
wa AS (SELECT entity_id, COUNT(*) AS was_acquired_count FROM ac GROUP BY 1), ao AS (SELECT other_party AS entity_id, COUNT(*) AS acquired_other_count FROM ac GROUP BY 1)
SELECT e.entity_id AS company_id, e.entity_name AS company_name, sectors, sub_sectors, sub_sub_sectors, round(amt, 1) AS private_funding_amount, n AS total_private_rounds, last_private_funding_date,
  round(COALESCE(amt, 0) + COALESCE(amt2, 0), 1) AS total_funding_amount, COALESCE(n, 0) + COALESCE(n2, 0) AS total_rounds, CASE WHEN was_acquired_count IS NOT NULL THEN 1 ELSE 0 END AS is_acquired,
  CASE WHEN x.entity_id IS NOT NULL THEN 1 ELSE 0 END AS is_exited, x.event_date AS exited_date, last_acquisition_date, last_acquirer_name, last_acquired_amount, was_acquired_count, acquired_other_count
FROM ent e LEFT JOIN tx ON tx.company_id = e.entity_id LEFT JOIN pa USING (entity_id) LEFT JOIN pu USING (entity_id) LEFT JOIN la USING (entity_id) LEFT JOIN wa USING (entity_id) LEFT JOIN ao USING (entity_id)
LEFT JOIN (SELECT * FROM ex WHERE exit_order = 1) x USING (entity_id) WHERE e.entity_type IN ('Company', 'Foreign Startup')
""")
def _(spark, d):
    ev = events(spark, d)
    en = entities(spark, d)
    out = X.profile(
        en, "company", sectors=sector_rows(spark, d), rounds=X.private_rounds(ev, companies(spark, d), split=False), funding=X.public_funding(ev, en, split=False),
        acq=X.acquisitions(ev, split=False), exits=X.exit_events(ev, False))
    out = out.withColumns({a: F.round(a, 1) for a in ("private_funding_amount", "total_funding_amount")})
    return out.select(
        "company_id", "company_name", "sectors", "sub_sectors", "sub_sub_sectors", "private_funding_amount", "total_private_rounds", "last_private_funding_date", "total_funding_amount",
        "total_rounds", "is_acquired", "is_exited", "exited_date", "last_acquisition_date", "last_acquirer_name", "last_acquired_amount", "was_acquired_count", "acquired_other_count")


@query("p19_investor_profile", "WITH " + EVENTS + "," + _EXITS + "," + ENTITIES + "," + PART + "," + _INV + """,
a AS (SELECT investor_id, COUNT(DISTINCT round_id) AS num_investments, MAX(round_date) AS last_investment_date, COUNT(DISTINCT company_id) AS num_startups_invested FROM ir GROUP BY 1),
g AS (SELECT investor_id, COUNT(DISTINCT company_id) AS exited_startups FROM ir WHERE company_id IN (SELECT entity_id FROM ex) GROUP BY 1),
sc AS (SELECT investor_id, primary_sector_name AS v, COUNT(DISTINCT company_id) AS m FROM ir JOIN ent ON entity_id = company_id GROUP BY 1, 2),
st AS (SELECT investor_id, round_type AS v, COUNT(DISTINCT round_id) AS m FROM ir WHERE round_type IS NOT NULL GROUP BY 1, 2),
ts AS (SELECT investor_id, string_agg(v, ', ' ORDER BY v) AS actual_sector FROM (SELECT *, rank() OVER (PARTITION BY investor_id ORDER BY m DESC) rk FROM sc) WHERE rk = 1 GROUP BY 1),
tg AS (SELECT investor_id, string_agg(v, ', ' ORDER BY v) AS actual_stage FROM (SELECT *, rank() OVER (PARTITION BY investor_id ORDER BY m DESC) rk FROM st) WHERE rk = 1 GROUP BY 1)
SELECT entity_id AS investor_id, num_investments, last_investment_date, num_startups_invested, exited_startups, actual_sector, actual_stage,
  CASE WHEN entity_id % 4 = 0 THEN 'Early Growth, Early Stage' WHEN entity_id % 4 = 2 THEN 'Late Growth' END AS target_investment_stages, CASE WHEN primary_sector_name = 'BUILDING' THEN 'ai, bio' END AS industry_preferences
FROM ent LEFT JOIN a ON a.investor_id = entity_id LEFT JOIN g ON g.investor_id = entity_id LEFT JOIN ts ON ts.investor_id = entity_id LEFT JOIN tg ON tg.investor_id = entity_id WHERE entity_type = 'Investor'
""")
def _(spark, d):
    c = F.col
    en = entities(spark, d)
    pick = F.when(c("entity_id") % 4 == 0, F.array(F.lit("Seed"), F.lit("B Round"), F.lit("A Round"))).when(c("entity_id") % 4 == 2, F.array(F.lit("E Round")))
    stages = en.select("entity_id", F.explode(pick).alias("investment_stage"))
    tags = en.filter("primary_sector_name = 'BUILDING'").select("entity_id", F.explode(F.array(F.lit("bio"), F.lit("ai"))).alias("tag_name"))
    out = X.profile(en, "investor", rows=investor_rows(spark, d), exits=X.exit_events(events(spark, d), False), tags=tags, stages=stages)
    return out.select("investor_id", "num_investments", "last_investment_date", "num_startups_invested", "exited_startups", "actual_sector", "actual_stage", "target_investment_stages", "industry_preferences")


@query("p19_multinational_profile", "WITH " + EVENTS + "," + _EXITS + "," + ENTITIES + "," + _ACQ + """
SELECT e.entity_id AS mnc_id, e.entity_name AS mnc_name, MAX(a.event_date) AS last_acquisition_date, CASE WHEN COUNT(a.id) > 0 THEN COUNT(DISTINCT a.id) END AS total_acquisitions, round(SUM(a.amount), 1) AS total_acquisition_amount
FROM ent e LEFT JOIN ac a ON a.other_party = e.entity_id WHERE e.entity_type = 'Multinational' GROUP BY 1, 2
""")
def _(spark, d):
    out = X.profile(entities(spark, d), "multinational", acq=X.acquisitions(events(spark, d), split=False))
    return out.select("mnc_id", "mnc_name", "last_acquisition_date", "total_acquisitions", F.round("total_acquisition_amount", 1).alias("total_acquisition_amount"))


@query("p19_hub_profile", "WITH " + EVENTS + "," + ENTITIES + "," + PART + "," + _INV + """
SELECT e.entity_id AS hub_id, e.entity_name AS hub_name, MAX(round_date) AS last_investment, CASE WHEN COUNT(round_id) > 0 THEN COUNT(DISTINCT round_id) END AS total_investments
FROM ent e LEFT JOIN ir ON ir.investor_id = e.entity_id WHERE e.entity_type = 'Accelerator' GROUP BY 1, 2
""")
def _(spark, d):
    return X.profile(entities(spark, d), "hub", rows=investor_rows(spark, d)).select("hub_id", "hub_name", "last_investment", "total_investments")


_IR_COLS = ["investment_id", "round_id", "investor_id", "investor_country", "round_date", "is_first_investment_ever", "first_investment_date", "company_id"]


@query("p20_investor_rounds", "WITH " + EVENTS + "," + ENTITIES + "," + PART + "," + _INV + "SELECT " + ", ".join(_IR_COLS) + " FROM ir")
def _(spark, d):
    return investor_rows(spark, d).select(*_IR_COLS)


@query("p20_investor_investments", "WITH " + EVENTS + "," + ENTITIES + "," + PART + "," + _INV + """
SELECT investment_id, round_id, c.entity_name AS company_name, c.entity_type AS company_type, i.entity_name AS investor_name, i.entity_type AS investor_type FROM ir
JOIN ent c ON c.entity_id = company_id JOIN ent i ON i.entity_id = investor_id WHERE c.disclosure_level <> 'none' AND i.disclosure_level <> 'none'
""")
def _(spark, d):
    shown = entities(spark, d).filter("disclosure_level <> 'none'")
    rows = investor_rows(spark, d).select("investment_id", "round_id", "company_id", "investor_id")
    out = X.both_parties(rows, shown, {"company": "company_id", "investor": "investor_id"}, {"entity_name": "name", "entity_type": "type"})
    return out.drop("company_id", "investor_id")


@query("p20_silent_rounds", "WITH " + EVENTS + "," + USERS + "," + PART + """
SELECT investment_id, round_id, investor_id, event_date AS round_date, entity_id AS company_id, a.email AS event_creator_email FROM part_ JOIN raw ON raw.id = round_id LEFT JOIN usr a ON creator_key = a.user_id WHERE silent = 1
""")
def _(spark, d):
    return X.silent_rounds(events(spark, d), participation(spark, d), users(spark, d)).select("investment_id", "round_id", "investor_id", "round_date", "company_id", "event_creator_email")


@query("p20_investor_funds", "WITH " + EVENTS + "," + ENTITIES + """
SELECT id AS fund_id, entity_id AS investor_id, fund_name, CAST(row_number() OVER (PARTITION BY entity_id ORDER BY event_date NULLS FIRST, id) AS INTEGER) AS fund_rank, CAST(year(event_date) AS INTEGER) AS fund_year
FROM raw JOIN ent USING (entity_id) WHERE event_type = 'InvestmentFirmFundingEvent' AND disclosure_level <> 'none'
""")
def _(spark, d):
    return X.investor_funds(events(spark, d), entities(spark, d)).select("fund_id", "investor_id", "fund_name", "fund_rank", "fund_year")


@query("p21_yearly_activity", "WITH " + ENTITIES + """
SELECT md5(entity_id || '-' || y) AS activity_id, entity_id, CAST(y AS INTEGER) AS year, CASE WHEN entity_type = 'Accelerator' THEN 'Hub' ELSE entity_type END AS entity_type,
  CASE WHEN founded_year IS NULL OR founded_year > y OR closed_year < y THEN 0 ELSE 1 END AS was_active, CASE WHEN founded_year = y THEN 1 ELSE 0 END AS was_opened_in_the_year,
  CASE WHEN closed_year = y THEN 1 ELSE 0 END AS was_closed_in_the_year, is_active AS is_active_today FROM ent, generate_series(2000, 2024) g(y)
WHERE entity_type <> 'Foreign Startup' AND disclosure_level <> 'none' AND (founded_year IS NULL OR y >= founded_year) AND (closed_year IS NULL OR y <= closed_year)
""")
def _(spark, d):
    out = X.yearly_activity(entities(spark, d), 2024)
    return out.select("activity_id", "entity_id", "year", "entity_type", "was_active", "was_opened_in_the_year", "was_closed_in_the_year", "is_active_today")


@query("p22_residual_events", _PUBLIC_WITH + "," + _PRIVATE + "," + _ACQ + """,
claimed AS (SELECT id FROM pr UNION ALL SELECT id FROM ac UNION ALL SELECT id FROM pfl UNION ALL SELECT id FROM raw WHERE event_type = 'InvestmentFirmFundingEvent')
SELECT r.id AS event_id, CASE event_type WHEN 'GrantEvent' THEN 'Grant' WHEN 'MNAEvent' THEN 'Acquisition Made' ELSE event_type END AS event_category, CAST(year(event_date) AS INTEGER) AS event_year, t.entity_name AS target_name, i.entity_type AS institution_type
FROM raw r JOIN ent e USING (entity_id) LEFT JOIN ent t ON t.entity_id = other_party LEFT JOIN ent i ON i.entity_id = r.entity_id * 11 % 1500 WHERE event_type <> 'ClosingEvent' AND r.id NOT IN (SELECT id FROM claimed)
""")
def _(spark, d):
    ev, c = events(spark, d), F.col
    funds = ev.filter(c("event_type") == X.FUND_EVENT).select(c("id").alias("event_id"))
    en = entities(spark, d)
    private = X.private_rounds(ev, companies(spark, d), split=False).select(c("round_id").alias("event_id"))
    claimed = [private, X.acquisitions(ev, split=False), X.public_funding(ev, en, split=False), funds]
    out = X.residual_events(ev, claimed, en)
    return out.select("event_id", "event_category", "event_year", "target_name", "institution_type")


_MASTER = "WITH " + EVENTS + "," + USERS + """,
co AS (SELECT c_custkey AS company_id, c_name AS company_name, ['Startup', 'Investor', 'Multinational'][c_custkey % 3 + 1] AS company_type, c_nationkey AS psk, CASE WHEN c_custkey % 9 = 0 THEN ' ' || lower('CUSTOMER#' || lpad(CAST(c_custkey // 9 AS VARCHAR), 9, '0')) || ' ' END AS arm_of,
  CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END AS active, CASE WHEN c_custkey % 4 <> 0 THEN CAST(1990 + c_custkey % 25 AS INTEGER) END AS founded_year, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey % 12 + 1 AS INTEGER) END AS founded_month,
  CASE WHEN c_custkey % 6 = 0 THEN 'h' || (c_custkey % 4) END AS hide_reason, c_custkey % 100 AS creator_id FROM customer),
cl AS (SELECT entity_id, event_date AS closed_date FROM raw WHERE event_type = 'ClosingEvent' AND event_date IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY event_date DESC, created_date DESC, id) = 1),
fo AS (SELECT o_custkey AS company_id, COUNT(DISTINCT l_suppkey % 60) AS num_followers FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_suppkey % 60 <> 7 GROUP BY 1),
me AS (SELECT o_custkey AS company_id, COUNT(DISTINCT o_orderkey) AS num_members, COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS num_claimed_members FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1),
ar AS (SELECT p.company_id, string_agg(DISTINCT trim(a.company_name), ' , ' ORDER BY trim(a.company_name)) AS arms FROM co a JOIN co p ON upper(trim(a.arm_of)) = upper(trim(p.company_name)) GROUP BY 1)
SELECT co.company_id AS entity_id, company_name AS entity_name, CASE WHEN company_type = 'Startup' THEN 'Company' ELSE company_type END AS entity_type, n.n_name AS primary_sector_name, NULLIF(r.r_name, n.n_name) AS primary_sector_parent,
  CASE WHEN founded_year IS NOT NULL THEN make_date(founded_year, COALESCE(founded_month, 1), 1) END AS founded_date, closed_date, CAST(CASE WHEN active = 0 THEN year(closed_date) END AS INTEGER) AS closed_year,
  COALESCE(num_followers, 0) AS num_followers, num_members, num_claimed_members, arms, u.email AS creator_email, COALESCE(CASE hide_reason WHEN 'h0' THEN 'Reason 0' END, hide_reason) AS hide_reason,
  CASE WHEN hide_reason IS NULL THEN 'all' WHEN hide_reason IN ('h0', 'h2') THEN 'aggregation' ELSE 'none' END AS disclosure_level
FROM co LEFT JOIN nation n ON n.n_nationkey = psk LEFT JOIN region r ON r.r_regionkey = n.n_regionkey LEFT JOIN cl ON cl.entity_id = co.company_id LEFT JOIN fo USING (company_id) LEFT JOIN me USING (company_id) LEFT JOIN ar USING (company_id) LEFT JOIN usr u ON u.user_id = creator_id
"""


@query("p23_entity_master", _MASTER.replace("WHEN 'h0' THEN 'Reason 0'", "WHEN 'h0' THEN 'Reason AFRICA'"))
def _(spark, d):
    c, k = F.col, F.col("c_custkey")
    pick = F.element_at(F.array(F.lit("Startup"), F.lit("Investor"), F.lit("Multinational")), (k % 3 + 1).cast("int"))
    arm = F.concat(F.lit(" customer#"), F.lpad(F.floor(k / 9).cast("string"), 9, "0"), F.lit(" "))
    co = table(spark, d, "customer").select(
        k.alias("company_id"), c("c_name").alias("company_name"), pick.alias("company_type"), F.concat(F.lit("n"), c("c_nationkey").cast("string")).alias("primary_sector_key"),
        F.when(k % 9 == 0, arm).alias("supporting_arm_name"), F.when(k % 7 == 0, 0).otherwise(1).alias("active"), F.when(k % 4 != 0, (1990 + k % 25).cast("int")).alias("founded_year"),
        F.when(k % 5 != 0, (k % 12 + 1).cast("int")).alias("founded_month"), F.when(k % 6 == 0, F.concat(F.lit("h"), (k % 4).cast("string"))).alias("hide_reason"), (k % 100).alias("creator_id"))
    s = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    nodes = table(spark, d, "region").select(s("r", c("r_regionkey")).alias("classification_id"), c("r_name").alias("sector_name"), s("r", c("r_regionkey")).alias("root_key"))
    nodes = nodes.union(table(spark, d, "nation").select(s("n", c("n_nationkey")), "n_name", s("r", c("n_regionkey"))))
    orders = table(spark, d, "orders")
    listed = orders.select(c("o_orderkey").alias("collection_id"), c("o_custkey").alias("company_id"))
    lists = table(spark, d, "lineitem").select(c("l_orderkey").alias("collection_id"), F.nullif(c("l_suppkey") % 60, F.lit(7)).alias("owner_id"))
    members = orders.select(
        c("o_custkey").alias("company_id"), c("o_orderkey").alias("member_id"), F.when(c("o_orderstatus") == "F", 1).otherwise(0).alias("claimed"),
        F.when(c("o_orderpriority") == "5-LOW", "left").alias("delete_reason"))
    reasons = table(spark, d, "region").filter("r_regionkey = 0").select(s("h", c("r_regionkey")).alias("hide_reason_id"), F.concat(F.lit("Reason "), c("r_name")).alias("reason_description"))
    out = X.entity_master(
        co, nodes, users(spark, d), events(spark, d).withColumn("reason", F.lit("out_of business")), list_members=listed, lists=lists, members=members,
        hide_reasons=reasons, aggregation_reasons=["h0", "h2"])
    return out.select(
        "entity_id", "entity_name", "entity_type", "primary_sector_name", "primary_sector_parent", "founded_date", "closed_date", "closed_year", "num_followers", "num_members", "num_claimed_members",
        "arms", "creator_email", "hide_reason", "disclosure_level")
