"""Data-quality checks. Each returns the violating rows or groups as a DataFrame, so only counts need to leave the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count; NULL keys are not checked."""
    known = df.dropna(subset=list(cols))
    return known.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")


def relationships(child: DataFrame, col: str, parent: DataFrame, pcol: str) -> DataFrame:
    """Child rows whose non-NULL key is missing in the parent."""
    ids = parent.select(F.col(pcol).alias("__pid")).distinct()
    return child.filter(F.col(col).isNotNull()).join(ids, F.col(col) == F.col("__pid"), "left_anti")


def relationships_where(child: DataFrame, col: str, parent: DataFrame, pcol: str, cond: Column) -> DataFrame:
    return relationships(child.filter(cond), col, parent, pcol)


def not_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows that hold one of the forbidden values."""
    return df.filter(F.col(col).isin(*values))


def reconcile(
    a: DataFrame, b: DataFrame, keys: Sequence[str], expr_a: Column, expr_b: Column, tol_pct: float = 0.0,
    cond_a: Column | None = None, cond_b: Column | None = None,
) -> DataFrame:
    """Groups whose aggregates differ by more than ``tol_pct`` percent of the second, or exist on one side only."""
    left = (a if cond_a is None else a.filter(cond_a)).groupBy(*keys).agg(expr_a.alias("value_a"))
    right = (b if cond_b is None else b.filter(cond_b)).groupBy(*keys).agg(expr_b.alias("value_b"))
    both = left.join(right, list(keys), "full").withColumn(
        "diff_pct", F.try_divide(F.abs(F.col("value_a") - F.col("value_b")), F.abs("value_b")) * 100
    )
    va, vb, d = F.col("value_a"), F.col("value_b"), F.col("diff_pct")
    missing = va.isNull() != vb.isNull()
    return both.filter(missing | (d > tol_pct) | (d.isNull() & (va != vb)))


def freshness(df: DataFrame, ts: str, as_of: Column, max_age_days: int = 1, name: str = "table") -> DataFrame:
    """One row when the newest date lies more than ``max_age_days`` before ``as_of``, or when there is none."""
    last = df.agg(F.max(F.col(ts).cast("date")).alias("last_date"))
    stale = F.col("last_date").isNull() | (F.col("last_date") < F.date_sub(as_of, max_age_days))
    return last.filter(stale).select(F.lit(name).alias("table_name"), "last_date")
