"""Classification trees per company: missing parents inferred, leaves placed in level columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlib.functions.text import surrogate_key
from martlib.operators.sets import order_final, union_distinct
from martlib.session import cut_lineage, small_side

# Classification types of the two trees.
TREES = {
    "sector": ["SectorClassificationModel", "SectorClassificationRelationModel"],
    "technology": ["TechnologyClassificationModel"],
}


def infer_parents(assigned: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges (parent_key, child_key) with missing ones added.

    A depth-2 node without any edge gets the depth-1 node of the same root in
    a company that has exactly one there.
    """
    c = F.col
    single = (
        assigned.filter(c("depth") == 1).groupBy("company_id", "root_key")
        .agg(F.count(F.lit(1)).alias("__n"), F.max("classification_id").alias("parent_key")).filter(c("__n") == 1).drop("__n")
    )
    deep = assigned.filter(c("depth") == 2).select("company_id", "root_key", c("classification_id").alias("child_key"))
    orphans = deep.join(edges.select("child_key").distinct(), "child_key", "left_anti")
    found = orphans.join(single, ["company_id", "root_key"]).select("parent_key", "child_key")
    return union_distinct(edges.select("parent_key", "child_key"), found)


def assigned_leaves(assigned: DataFrame, edges: DataFrame) -> DataFrame:
    """Assignments that have no assigned child, and no deeper node under the same root if they are roots.

    Children name their parents, and the deepest level per root is aggregated,
    so no pairs of assignments are formed.
    """
    c = F.col
    parents = (
        assigned.select("company_id", c("classification_id").alias("child_key")).join(edges, "child_key")
        .select("company_id", c("parent_key").alias("classification_id")).distinct()
    )
    deepest = assigned.groupBy("company_id", "root_key").agg(F.max("depth").alias("__deepest"))
    leaves = assigned.join(parents, ["company_id", "classification_id"], "left_anti").join(deepest, ["company_id", "root_key"], "left")
    return leaves.filter(~((c("depth") == 0) & F.coalesce(c("__deepest") > 0, F.lit(False)))).drop("__deepest")


def resolve_hierarchy(assign: DataFrame, nodes: DataFrame, edges: DataFrame, kind: str | Sequence[str] = "sector") -> DataFrame:
    """Distinct (company, sector, sub_sector, sub_sub_sector).

    ``assign``: company_id, classification_id, classification_category;
    ``nodes``: classification_id, sector_name, depth, root_key, classification_type;
    ``edges``: parent_key, child_key, classification_type.
    """
    c = F.col
    types = TREES[kind] if isinstance(kind, str) else list(kind)
    tree = nodes.filter(c("classification_type").isin(*types)).select("classification_id", "sector_name", "depth", "root_key")
    known = edges.filter(c("classification_type").isin(*types)).select("parent_key", "child_key")
    chosen = assign.filter(c("classification_category").isin(*types)).select("company_id", "classification_id")
    tree = small_side(tree)
    assigned = chosen.join(tree, "classification_id")
    # edges are read by two branches and are bounded by the tree, so they are written once
    links = cut_lineage(infer_parents(assigned, known))
    leaves = assigned_leaves(assigned, links)

    roots = small_side(tree.filter(c("depth") == 0).select("root_key", c("sector_name").alias("sector")))
    up = links.join(tree.select(c("classification_id").alias("parent_key"), c("sector_name").alias("__parent")), "parent_key", "left")
    up = small_side(up.select(c("child_key").alias("classification_id"), "__parent").withColumn("depth", F.lit(2).cast(tree.schema["depth"].dataType)))
    df = leaves.join(roots, "root_key", "left").join(up, ["classification_id", "depth"], "left")
    depth, name, parent = c("depth"), c("sector_name"), c("__parent")
    under = (depth == 2) & parent.isNotNull()
    out = df.select(
        "company_id", "sector",
        F.when(under, parent).when(depth.isin(1, 2), name).alias("sub_sector"),
        F.when(under, name).alias("sub_sub_sector"),
    ).distinct()
    return out.select(surrogate_key("company_id", "sector", "sub_sector", "sub_sub_sector").alias("company_sector_id"), *out.columns)


def classification_mart(resolved: DataFrame, entities: DataFrame) -> DataFrame:
    """Tree rows of companies with their names, in company and level order."""
    companies = entities.filter(F.col("entity_type") == "Company").select(
        F.col("entity_id").alias("company_id"), F.col("entity_name").alias("company_name"))
    out = resolved.join(companies, "company_id").select(
        "company_sector_id", "company_id", "company_name", "sector", "sub_sector", "sub_sub_sector")
    return order_final(out, ["company_id", "sector", "sub_sector", "sub_sub_sector"])
