"""Window operators by name; the ordered ones run on ``ordered`` and so take groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.operators.ordered import (
    Lag, LastValue, Lead, NextValue, Rank, RowNumber, RunningCount, RunningMin, Total, chained, join_null_safe, ordered, spec,
)


def sequence_no(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, **kw) -> DataFrame:
    """Running number 1, 2, ... per key."""
    return ordered(df, keys, order, {name: RowNumber()}, **kw)


def first_rank_flag(df: DataFrame, keys: Sequence[str], order: str, name: str) -> DataFrame:
    """1 on all rows at the first value of ``order`` per key (ties share it), else 0.

    NULL sorts first, so a key with a NULL value has its NULL rows flagged.
    The first value is aggregated and joined back; nothing is sorted.
    """
    lead = F.min(F.struct(F.col(order).isNotNull().alias("known"), F.col(order).alias("v")))
    first = df.groupBy(*keys).agg(lead.alias("__first"))
    hit = F.col("__first.v").eqNullSafe(F.col(order))
    return join_null_safe(df, first, keys).withColumn(name, F.when(hit, 1).otherwise(0)).drop("__first")


def rank_by_measure(df: DataFrame, keys: Sequence[str], by: Sequence[str], measure: Column, name: str = "rnk", **kw) -> DataFrame:
    """Aggregate per (keys, by), then rank the groups of a key by the measure, largest first."""
    counted = df.groupBy(*keys, *by).agg(measure.alias("measure"))
    return ordered(counted, keys, ["-measure"], {name: Rank()}, **kw)


def previous(df: DataFrame, cols: Mapping[str, str], keys: Sequence[str], order: Sequence[str], where: Column | None = None, **kw) -> DataFrame:
    """Value of the row before: ``{new: column}``. With ``where`` only matching rows count and receive one."""
    if where is None:
        return ordered(df, keys, order, {n: Lag(F.col(c)) for n, c in cols.items()}, **kw)
    flagged = df.withColumn("__w", F.coalesce(where, F.lit(False)))
    out = ordered(flagged, [*keys, "__w"], order, {n: Lag(F.col(c)) for n, c in cols.items()}, **kw)
    return out.withColumns({n: F.when(F.col("__w"), F.col(n)) for n in cols}).drop("__w")


def next_value(df: DataFrame, col: str, keys: Sequence[str], order: Sequence[str], name: str, **kw) -> DataFrame:
    return ordered(df, keys, order, {name: Lead(F.col(col))}, **kw)


def flow_columns(df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str], n: int = 4, **kw) -> DataFrame:
    """``<col>_1`` is the current value, ``<col>_2 .. _n`` the following ones."""
    return chained(df, keys, order, flow_steps(cols, n), **kw)


def flow_steps(cols: Sequence[str], n: int = 4) -> list:
    """``flow_columns`` as steps of ``chained``."""
    leads = {f"{c}_{i + 1}": Lead(F.col(c), i) for i in range(1, n) for c in cols}
    return [leads, lambda df: df.withColumns({f"{c}_1": F.col(c) for c in cols})]


def fill_nulls(df: DataFrame, col: str, scopes: Sequence[Sequence[str]], order: str, direction: str = "backward", **kw) -> DataFrame:
    """Fill NULLs from the nearest row of the narrowest scope that has one.

    ``backward`` takes values from later rows, ``forward`` from earlier ones, and
    ``both`` first from later and then from earlier rows; rows at the same time
    count as current. Scopes that lie within the widest one share its partitioning.
    """
    base = list(min(scopes, key=len))
    nested = all(set(base) <= set(s) for s in scopes)
    kinds = {"backward": [NextValue], "forward": [LastValue], "both": [NextValue, LastValue]}[direction]
    fills = [f"__fill{i}" for i in range(len(scopes))]
    filled = lambda d: d.withColumn(col, F.coalesce(F.col(col), *fills)).drop(*fills)
    steps = []
    for kind in kinds:
        if not nested:
            for f, s in zip(fills, scopes):
                df = ordered(df, list(s), [order], {f: kind(F.col(col))}, **kw)
            df = filled(df)
        for f, s in zip(fills, scopes):
            within, outputs = [c for c in s if c not in base], {f: kind(F.col(col))}
            steps.append((within, outputs) if within else outputs)
        steps.append(filled)
    return chained(df, base, [order], steps, **kw) if nested else df


def running_count(df: DataFrame, cond: Column, keys: Sequence[str], order: Sequence[str], name: str, frame: str = "rows", **kw) -> DataFrame:
    """Number of rows so far that meet ``cond``; with ``frame='range'`` ties count together."""
    return ordered(df, keys, order, {name: RunningCount(cond, frame)}, **kw)


def partition_stat(df: DataFrame, fn: str, col: str, keys: Sequence[str], name: str, **kw) -> DataFrame:
    """sum, min, max or count of the whole group on each row."""
    return ordered(df, keys, [], {name: Total(fn, F.col(col))}, **kw)


def running_min(df: DataFrame, col: str, keys: Sequence[str], order: Sequence[str], name: str, **kw) -> DataFrame:
    return ordered(df, keys, order, {name: RunningMin(F.col(col))}, **kw)


def distinct_per(df: DataFrame, keys: Sequence[str], col: str, threshold: int | None = None, name: str = "n_distinct") -> DataFrame:
    """Distinct count per key on each row, or with ``threshold`` whether it is reached."""
    counts = df.groupBy(*keys).agg(F.count_distinct(col).alias(name))
    if threshold is not None:
        counts = counts.withColumn(name, F.col(name) >= threshold)
    return join_null_safe(df, counts, keys)


def preferred_value(df: DataFrame, col: str, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Value of the first row in ``order``, given to every row of the key.

    The candidates are reduced to distinct ones before the best is chosen.
    """
    cols = list(dict.fromkeys([*keys, col, *[o.lstrip("-") for o in order]]))
    best = keep_first(df.select(*cols).distinct(), keys, [*order, col]).select(*keys, F.col(col).alias("__best"))
    out = join_null_safe(df, best, keys)
    return out.select(*[c for c in df.columns if c != name], F.col("__best").alias(name))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[str], k: int = 1, ties: bool = False) -> DataFrame:
    """The first ``k`` rows per key. Spark limits the groups before the shuffle, so a hot
    key costs ``k`` rows per input task."""
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("__rk", fn.over(spec(keys, order))).filter(F.col("__rk") <= k).drop("__rk")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order``. Add a unique column as last sort key for a fixed choice."""
    return top_k(df, keys, order, 1)


def keep_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(keys))


def with_derived_key(df: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Expressions as columns, so that a window can partition by them."""
    return df.withColumns(dict(keys))


def keep_rank_where(df: DataFrame, keys: Sequence[str], order: Sequence[str], predicate: Column) -> DataFrame:
    """Rows at rank 1 (ties included) that also meet a condition; the rank sees all rows."""
    return top_k(df, keys, order, 1, ties=True).filter(predicate)


def spread_null_key(df: DataFrame, key: str, unique: str, name: str, empty: str | None = None) -> DataFrame:
    """A window key in which rows without a key (NULL or the ``empty`` sentinel) each stand alone.

    Rows that belong to no group would otherwise all meet in one task.
    """
    own = F.concat(F.lit("~"), F.col(unique).cast("string"))
    missing = F.col(key).isNull() if empty is None else F.col(key).isNull() | (F.col(key) == empty)
    return df.withColumn(name, F.when(missing, own).otherwise(F.col(key)))
