"""Join operators.

Plain equi joins are left to Catalyst and adaptive execution, which split
skewed partitions of inner, left, semi and anti joins. A side is broadcast
only behind ``small_side``, which proves its size first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.functions.dates import floor_bucket
from martlib.functions.text import name_key
from martlib.session import cut_lineage, small_side


def inner(l: DataFrame, r: DataFrame, on: Column | Sequence[str]) -> DataFrame:
    return l.join(r, on, "inner")


def join_using(l: DataFrame, r: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join with one merged key column per key."""
    return l.join(r, list(keys), how)


join_keys = join_using


def enrich(fact: DataFrame, dims: Sequence[tuple[DataFrame, Mapping[str, str], Sequence[str]]], broadcast: bool = True) -> DataFrame:
    """Star enrichment by left joins.

    Each entry is (dimension, {fact column: dimension key}, columns to add).
    """
    for i, (dim, on, cols) in enumerate(dims):
        keys = {f"__d{i}_{j}": dk for j, dk in enumerate(on.values())}
        side = dim.select(*[F.col(dk).alias(n) for n, dk in keys.items()], *cols)
        side = small_side(side) if broadcast else side
        cond = [F.col(fk) == F.col(n) for fk, n in zip(on, keys)]
        fact = fact.join(side, cond, "left").drop(*keys)
    return fact


def full_merge(l: DataFrame, r: DataFrame, on: Sequence[str], coalesce_cols: Sequence[str] = ()) -> DataFrame:
    """Full outer join with merged keys; shared ``coalesce_cols`` take the left value first.

    Written as a left join plus the unmatched right rows: adaptive execution can
    split a skewed key there, which it cannot in a full outer join.
    """
    keys = list(on)
    ren = r.withColumnsRenamed({c: f"__r_{c}" for c in coalesce_cols})
    right_only = ren.join(l.select(*keys).distinct(), keys, "left_anti")
    out = l.join(ren, keys, "left").unionByName(right_only, allowMissingColumns=True)
    merged = {c: F.coalesce(c, f"__r_{c}") for c in coalesce_cols}
    return out.withColumns(merged).drop(*[f"__r_{c}" for c in coalesce_cols]) if merged else out


def time_tolerant_full_join(
    l: DataFrame,
    r: DataFrame,
    keys: Sequence[str],
    lt: str,
    rt: str,
    bucket_s: int = 60,
    fine_s: int = 10,
    tol_s: int = 10,
    two_sided: bool = False,
) -> DataFrame:
    """Full outer join of rows with equal keys in the same coarse time bucket whose fine buckets are close.

    One-sided by default: left minus right must not exceed ``tol_s``, however
    far left lies before right within the bucket. Key columns of the two sides
    come back as ``l_<key>`` and ``r_<key>``; rows with a NULL key or time match none.

    Only fine buckets are compared, of which a key has ``bucket_s / fine_s`` in a
    coarse one. Rows then meet on keys and fine bucket alone, so no pair is formed
    that is not in the result, and adaptive execution can split a hot key.
    """
    left = l.withColumnsRenamed({k: f"l_{k}" for k in keys}).withColumns(
        {"__lb": floor_bucket(F.col(lt), bucket_s), "__lf": floor_bucket(F.col(lt), fine_s)}
    )
    right = r.withColumnsRenamed({k: f"r_{k}" for k in keys}).withColumns(
        {"__rb": floor_bucket(F.col(rt), bucket_s), "__rf": floor_bucket(F.col(rt), fine_s)}
    )
    at_left, at_right = [*[f"l_{k}" for k in keys], "__lb", "__lf"], [*[f"r_{k}" for k in keys], "__rb", "__rf"]
    gap = F.unix_seconds(F.col("__lf").cast("timestamp")) - F.unix_seconds(F.col("__rf").cast("timestamp"))
    same = [F.col(a) == F.col(b) for a, b in zip(at_left[:-1], at_right[:-1])]
    close = left.select(*at_left).distinct().join(
        right.select(*at_right).distinct(), [*same, (F.abs(gap) if two_sided else gap) <= tol_s]
    )
    close = cut_lineage(close.select(*[F.col(c).alias(f"__c_{c}") for c in [*at_left, "__rf"]]))
    met = [F.col(c) == F.col(f"__c_{c}") for c in at_left]
    partners = [F.col(f"__c_{a}") == F.col(b) for a, b in zip([*at_left[:-1], "__rf"], at_right)]
    out = left.join(close, met, "left").join(right, partners, "left")
    alone = right.join(close, partners, "left_anti")
    helpers = ["__lb", "__lf", "__rb", "__rf", *close.columns]
    return out.drop(*helpers).unionByName(alone.drop(*helpers), allowMissingColumns=True)


def self_join_deeper(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Distinct rows for which a row with the same keys and a larger ``order_col`` exists.

    The largest value per key answers this; no pairs are formed.
    """
    top = df.groupBy(*keys).agg(F.max(order_col).alias("__top"))
    return df.join(top, list(keys), "inner").filter(F.col("__top") > F.col(order_col)).drop("__top").distinct()


def anti(l: DataFrame, r: DataFrame, on: Column | Sequence[str]) -> DataFrame:
    """Rows of ``l`` without a match in ``r``."""
    return l.join(r, on, "left_anti")


def not_in(l: DataFrame, col: str, r: DataFrame, rcol: str) -> DataFrame:
    """SQL ``NOT IN``: nothing is kept when ``r`` holds a NULL; NULL values of ``l`` are dropped unless ``r`` is empty.

    Written as an ordinary anti join plus one global aggregate, since Spark's
    null-aware form has to broadcast the whole right side.
    """
    state = r.agg(F.count(F.lit(1)).alias("__n"), F.count_if(F.col(rcol).isNull()).alias("__nulls"))
    ids = r.select(F.col(rcol).alias("__id")).filter("__id is not null").distinct()
    # a single row, so the broadcast is bounded
    kept = l.join(ids, F.col(col) == F.col("__id"), "left_anti").join(F.broadcast(state))
    return kept.filter((F.col("__n") == 0) | ((F.col("__nulls") == 0) & F.col(col).isNotNull())).drop("__n", "__nulls")


def exists_flag(l: DataFrame, col: str, r: DataFrame, rcol: str, name: str) -> DataFrame:
    """``1`` when the value occurs in ``r``, else ``0``."""
    ids = r.select(F.col(rcol).alias("__id")).filter("__id is not null").distinct().withColumn("__hit", F.lit(1))
    return l.join(ids, F.col(col) == F.col("__id"), "left").withColumn(name, F.coalesce("__hit", F.lit(0))).drop("__id", "__hit")


def year_spine(df: DataFrame, lo: int, hi: int, name: str = "year") -> DataFrame:
    """Each row once per year; generated per row, no join."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(lo), F.lit(hi))))


def unnest(df: DataFrame, arr: str | Column, name: str = "item", outer: bool = False) -> DataFrame:
    """One row per array element; ``outer`` keeps rows with an empty or NULL array."""
    return df.withColumn(name, (F.explode_outer if outer else F.explode)(arr))


def role_join(df: DataFrame, dim: DataFrame, roles: Mapping[str, str], key: str, cols: Sequence[str]) -> DataFrame:
    """The same dimension in several roles: ``{role: foreign key}`` adds ``<role>_<col>``."""
    for role, fk in roles.items():
        side = dim.select(F.col(key).alias(f"__{role}"), *[F.col(c).alias(f"{role}_{c}") for c in cols])
        df = df.join(side, F.col(fk) == F.col(f"__{role}"), "left").drop(f"__{role}")
    return df


def left_where(l: DataFrame, r: DataFrame, on: Column | Sequence[str], right_predicate: Column | str) -> DataFrame:
    """Left join to the rows of ``r`` that meet a condition; all rows of ``l`` stay."""
    return l.join(r.filter(right_predicate), on, "left")


def scalar_bound(df: DataFrame, agg: Column):
    """One aggregate value as a Python literal, to be used as a prunable bound."""
    return df.agg(agg).first()[0]


def lookup_flag(df: DataFrame, lookup: DataFrame, on: Mapping[str, str] | Sequence[tuple[Column, str]], name: str) -> DataFrame:
    """True when the lookup holds a row for the key, else false; one output row per input row."""
    pairs = list(on.items()) if isinstance(on, Mapping) else list(on)
    keys = [f"__l{i}" for i in range(len(pairs))]
    side = lookup.select(*[F.col(r).alias(k) for k, (_, r) in zip(keys, pairs)]).distinct().withColumn("__hit", F.lit(True))
    cond = [(F.col(l) if isinstance(l, str) else l) == F.col(k) for k, (l, _) in zip(keys, pairs)]
    return df.join(small_side(side), cond, "left").withColumn(name, F.col("__hit").isNotNull()).drop(*keys, "__hit")


def link_by_name(df: DataFrame, child_name: str, parent_name: str, id: str) -> DataFrame:
    """Match rows that name a parent to the row of that name; children are listed per parent.

    Names match trimmed and upper-cased; of several parents with one name the
    smallest id stands for it.
    """
    parents = (
        df.filter(F.col(parent_name).isNotNull() & (F.col(parent_name) != ""))
        .groupBy(name_key(F.col(parent_name)).alias("__key"))
        .agg(F.min(id).alias("parent_id"), F.min(F.trim(parent_name)).alias("parent_name"))
    )
    arms = df.filter(F.col(child_name).isNotNull() & (F.col(child_name) != "")).select(
        name_key(F.col(child_name)).alias("__key"), F.trim(parent_name).alias("arm_name"), F.col(id).alias("arm_id")
    )
    # distinct pairs first, so the lists are built from bounded input
    pairs = arms.join(parents, "__key", "left").select("parent_name", "parent_id", "arm_name", "arm_id").distinct()
    return pairs.groupBy("parent_name", "parent_id").agg(
        F.array_join(F.array_sort(F.collect_set("arm_name")), " , ").alias("arms_list"),
        F.count_distinct("arm_id").alias("arms_count"),
    )
