"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int_round(col: Column) -> Column:
    """Float to integer by rounding half away from zero (a plain cast truncates)."""
    return F.round(col, 0).cast("long")


def try_int(col: Column) -> Column:
    return col.try_cast("long")


def try_div(num: Column, den: Column) -> Column:
    """NULL instead of an error for a zero divisor."""
    return F.try_divide(num, den)


def _any_null(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [c.isNull() for c in cols])


def greatest_strict(*cols: Column) -> Column:
    """Largest value, NULL when any argument is NULL."""
    return F.when(~_any_null(cols), F.greatest(*cols))


def least_strict(*cols: Column) -> Column:
    """Smallest value, NULL when any argument is NULL."""
    return F.when(~_any_null(cols), F.least(*cols))


def bucket(col: Column, edges: Sequence[float], labels: Sequence[str], null_label: str | None = None) -> Column:
    """Label of the half-open range ``[edge i-1, edge i)`` the value falls in."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    out = F.when(col.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        out = out.when(col < edge, label)
    return out.otherwise(labels[-1])


def year_array(lo: int | Column, hi: int | Column) -> Column:
    """All years from ``lo`` to ``hi`` as an array; empty when ``hi`` is before ``lo``."""
    lo, hi = (F.lit(x) if isinstance(x, int) else x for x in (lo, hi))
    return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))


def array_text(col: Column, sep: str = ",") -> Column:
    """Array elements as one text; NULL when there are none."""
    return F.nullif(F.array_join(col.cast("array<string>"), sep), F.lit(""))
