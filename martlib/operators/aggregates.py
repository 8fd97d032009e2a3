"""Aggregation operators.

All of them aggregate partially before the shuffle. List-valued results are
built from distinct or pre-grouped input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlib.operators.ordered import sort_columns
from martlib.operators.windows import top_k


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def summarize(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def count_distincts(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str | Column]) -> DataFrame:
    """Exact distinct counts of several expressions in one pass."""
    return summarize(df, keys, {n: F.count_distinct(_col(c)) for n, c in cols.items()})


def agg_if(fn: str, value: str | Column, cond: Column) -> Column:
    """Aggregate (``sum``, ``count``, ``min``, ``max``, ``avg``, ``count_distinct``) over rows meeting ``cond``."""
    return getattr(F, fn)(F.when(cond, _col(value)))


def string_agg(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str],
    name: str,
    sep: str = ",",
) -> DataFrame:
    """Non-NULL values joined in ``order``, one text per key; sort columns of any type.

    Works in two steps: rows are range-partitioned by keys and order and joined
    within the partition, then the parts of a key are joined. Rows of a hot key
    are thus sorted in many tasks; only the finished texts meet.
    """
    down = [o.startswith("-") for o in order]
    if any(down) and not all(down):
        raise ValueError("order columns must all ascend or all descend")
    cols = [F.col(o.lstrip("-")) for o in order]
    item = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(cols)], F.col(value).alias("v"))

    def joined(items: Column, field: str) -> Column:
        return F.array_join(F.transform(F.sort_array(items, asc=not down[0]), lambda x: x[field]), sep)

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = df.filter(F.col(value).isNotNull()).repartitionByRange(n, *keys, *sort_columns(order)).withColumn("__b", F.spark_partition_id())
    parts = laid.groupBy(*keys, "__b").agg(joined(F.collect_list(item), "v").alias("__part"))
    part = F.array_sort(F.collect_list(F.struct(F.col("__b").alias("b"), F.col("__part").alias("p"))))
    return parts.groupBy(*keys).agg(F.array_join(F.transform(part, lambda x: x["p"]), sep).alias(name))


def string_agg_distinct(df: DataFrame, keys: Sequence[str], value: str, name: str, sep: str = ",") -> DataFrame:
    """Distinct values joined in value order; duplicates are removed before anything is collected."""
    pairs = df.select(*keys, value).filter(F.col(value).isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(value)), sep).alias(name))


def first_non_null_by(value: str | Column, order: str | Column) -> Column:
    """Value with the smallest order among the non-NULL values."""
    return min_by_nn(value, order)


def array_distinct_sorted(value: str | Column) -> Column:
    """Distinct non-NULL values, sorted."""
    return F.array_sort(F.collect_set(_col(value)))


def min_by_nn(value: str | Column, order: str | Column) -> Column:
    """``min_by`` in which NULL values never win; ties go to the smaller value."""
    v = _col(value)
    return F.min(F.when(v.isNotNull(), F.struct(_col(order).alias("o"), v.alias("v"))))["v"]


def max_by_nn(value: str | Column, order: str | Column) -> Column:
    """``max_by`` in which NULL values never win; ties go to the larger value."""
    v = _col(value)
    return F.max(F.when(v.isNotNull(), F.struct(_col(order).alias("o"), v.alias("v"))))["v"]


def any_true(cond: Column) -> Column:
    return F.bool_or(cond)


def count_true(cond: Column) -> Column:
    return F.count_if(cond)


def group_by_all(df: DataFrame, aggs: Mapping[str, Column], drop: Sequence[str] = ()) -> DataFrame:
    """Group by every column except ``drop``."""
    return summarize(df, [c for c in df.columns if c not in drop], aggs)


def pivot_keys(
    df: DataFrame, ids: Sequence[str], key: str, value: str, keys: Sequence[str] | Mapping[str, str], by: str | None = None
) -> DataFrame:
    """Key/value rows to one column per key in a single aggregation.

    With ``by`` the value of the latest row wins, else the largest value.
    """
    named = keys if isinstance(keys, Mapping) else {k: k for k in keys}
    pick = (lambda v: max_by_nn(v, by)) if by else F.max
    return summarize(df, ids, {n: pick(F.when(F.col(key) == k, F.col(value))) for k, n in named.items()})


def pivot_steps(df: DataFrame, ids: Sequence[str], step: str, value: str, steps: Mapping[str, str], agg: str = "min") -> DataFrame:
    """Pivot of a fixed list of step values ``{value: column}``; other values count for no column."""
    fn = getattr(F, agg)
    return summarize(df, ids, {n: fn(F.when(F.col(step) == s, F.col(value))) for s, n in steps.items()})


def top_with_ties(df: DataFrame, key: str, category: str, measure: Column, name: str = "top_categories", sep: str = ", ") -> DataFrame:
    """Most frequent categories per key, ties joined in category order."""
    counted = df.filter(F.col(category).isNotNull()).groupBy(key, category).agg(measure.alias("__m"))
    best = top_k(counted, [key], ["-__m"], 1, ties=True)
    return string_agg_distinct(best, [key], category, name, sep)


def visited_items(df: DataFrame, group: str, item: str, ts: str, prefix: str = "items") -> DataFrame:
    """Items per group in order of first visit: text, array, distinct and total count."""
    first = df.filter(F.col(item).isNotNull()).groupBy(group, item).agg(F.min(ts).alias("t"), F.count(F.lit(1)).alias("c"))
    arr = F.transform(F.array_sort(F.collect_list(F.struct("t", F.col(item).alias("i")))), lambda x: x["i"])
    out = first.groupBy(group).agg(arr.alias(f"{prefix}_arr"), F.sum("c").alias(f"{prefix}_total_count"))
    return out.withColumns({
        f"{prefix}_list": F.array_join(f"{prefix}_arr", ","),
        f"{prefix}_unique_count": F.size(f"{prefix}_arr").cast("long"),
    })


def clamped_count(value: str | Column, cond: Column, minus: int = 1, floor: int = 0) -> Column:
    """Distinct count under a condition, less a constant, not below ``floor``."""
    return F.greatest(F.count_distinct(F.when(cond, _col(value))) - minus, F.lit(floor).cast("long"))


def stack_grains(df: DataFrame, grains: Sequence[tuple[Sequence[str], Column | None]], aggs: Mapping[str, Column]) -> DataFrame:
    """Several groupings of one table on top of each other; keys a grain lacks are NULL."""
    out = None
    for keys, cond in grains:
        part = summarize(df if cond is None else df.filter(cond), keys, aggs)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def period_change(
    df: DataFrame, keys: Sequence[str], date: str, value: str, cutoff: Column, min_avg: float = 5, min_total: float = 5
) -> DataFrame:
    """Average and total before and since ``cutoff`` with the percent change.

    100 when there was nothing before, -100 when nothing came since; groups
    below the minimum earlier average or total are left out.
    """
    old, new = F.col(date) < cutoff, F.col(date) >= cutoff
    out = summarize(df, keys, {
        "hist_avg_daily_events": F.coalesce(F.round(agg_if("avg", value, old), 2), F.lit(0.0)),
        "hist_total_events": F.coalesce(agg_if("sum", value, old), F.lit(0)),
        "recent_avg_daily_events": F.coalesce(F.round(agg_if("avg", value, new), 2), F.lit(0.0)),
        "recent_total_events": F.coalesce(agg_if("sum", value, new), F.lit(0)),
    })
    h, r = F.col("hist_avg_daily_events"), F.col("recent_avg_daily_events")
    change = F.when(h > 0, F.round(F.try_divide(r - h, h) * 100, 2)).when((h == 0) & (r > 0), 100.0).otherwise(-100.0)
    return out.withColumn("pct_change", change).filter((h >= min_avg) & (F.col("hist_total_events") >= min_total))


def first_event_flag(df: DataFrame, key: str, date: str, name: str = "is_first", first_name: str | None = None) -> DataFrame:
    """1 on rows dated at the first date of their key; the first date is aggregated, then joined back."""
    first = df.filter(F.col(date).isNotNull()).groupBy(key).agg(F.min(date).alias("__first"))
    out = df.join(first, key, "left").withColumn(name, F.when(F.col("__first") == F.col(date), 1).otherwise(0))
    return out.withColumnRenamed("__first", first_name) if first_name else out.drop("__first")


def min_max_range(df: DataFrame, ids: Sequence[str], name: str, value: str, prefixes: Sequence[str]) -> DataFrame:
    """``min-max`` text of the values named ``<prefix>_...``; NULL when there are none."""
    def text(p: str) -> Column:
        v = F.when(F.col(name).startswith(f"{p}_"), F.col(value))
        return F.concat(F.min(v), F.lit("-"), F.max(v))

    return summarize(df, ids, {f"{p}_range": text(p) for p in prefixes})
