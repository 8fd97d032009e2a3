"""Set operations and final ordering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from martlib.operators.ordered import sort_columns


def stack(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by position."""
    return reduce(DataFrame.union, dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return stack(*dfs).distinct()


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by name; columns missing on a side are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def order_final(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Total order of a result; ``-col`` is descending. Ascending puts NULLs first, descending last."""
    return df.orderBy(*sort_columns(order))
