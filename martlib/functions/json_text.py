"""JSON object text to arrays and rows, all with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_map(col: Column) -> Column:
    return F.from_json(col, "map<string,string>")


def json_keys(col: Column) -> Column:
    """Keys of a JSON object; NULL for text that is not one."""
    return F.json_object_keys(col)


def json_values(col: Column) -> Column:
    """Values of a JSON object as text; NULL for text that is not one."""
    return F.map_values(_as_map(col))


def json_pairs(col: Column) -> Column:
    """Array of (filter_name, filter_value); empty for missing or broken JSON."""
    entries = F.map_entries(_as_map(col))
    named = F.transform(entries, lambda e: F.struct(e["key"].alias("filter_name"), e["value"].alias("filter_value")))
    return F.coalesce(named, F.array().cast("array<struct<filter_name:string,filter_value:string>>"))


def to_json_text(col: Column) -> Column:
    """Struct, map or array as JSON text, e.g. as hash input."""
    return F.to_json(col)


def param(params: Column, key: str, field: str) -> Column:
    """Value of ``key`` in an array of (key, value{string, int, float, double}); the first one if the key repeats.

    Looks the position of the key up instead of filtering with a lambda, so the
    expression stays in generated code; no shuffle, no explode.
    """
    at = F.array_position(params["key"], key).cast("int") - 1
    return F.get(params["value"][field], at)
