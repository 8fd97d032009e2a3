"""Projection, cleaning and filtering operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_as(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select ``{new name: old name or expression}``."""
    return df.select(*[(F.col(e) if isinstance(e, str) else e).alias(n) for n, e in columns.items()])


def replace_cols(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Replace or add columns; all expressions see the input columns."""
    return df.withColumns(dict(columns))


def column_list(
    cols: Sequence[str],
    prefix: str = "",
    suffix: str = "",
    table: str = "",
    exclude: Sequence[str] = (),
    rename: Mapping[str, str] | None = None,
) -> list[Column]:
    """Column list with optional table alias, exclusions, renames and name affixes."""
    rename = rename or {}
    out = []
    for c in cols:
        if c not in exclude:
            out.append(F.col(f"{table}.{c}" if table else c).alias(f"{prefix}{rename.get(c, c)}{suffix}"))
    return out


def where(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Keep rows for which the predicate is true (not false, not unknown)."""
    return df.filter(predicate)


def exclude_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop rows for which the predicate is true; rows where it is unknown go too, as with NOT in SQL."""
    return df.filter(~predicate)


def distinct_on(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct projection of the columns."""
    return df.select(*cols).distinct()


# Cleaning rules by name; each maps a column to its cleaned form.
def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def trimmed(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def epoch_to_null(c: Column) -> Column:
    return F.when(c != F.lit("1970-01-01").cast("date"), c)


def dashes_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit("--"))


def null_to_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


CLEANING = {
    "blank": blank_to_null,
    "trim": trimmed,
    "zero": zero_to_null,
    "epoch": epoch_to_null,
    "dashes": dashes_to_null,
    "flag": null_to_zero,
}


def clean(df: DataFrame, rules: Mapping[str, str | Column]) -> DataFrame:
    """Apply named cleaning rules (``blank``, ``trim``, ``zero``, ``epoch``, ``dashes``,
    ``flag``) or own expressions per column; other columns pass through."""
    return df.withColumns({
        c: CLEANING[rule](F.col(c)) if isinstance(rule, str) else rule for c, rule in rules.items()
    })
