"""Registry of runnable queries, each with the SQL that checks it where SQL can."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlib.session import checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]
TASK_ROWS = 100_000  # rows of a spread table in one task, at most
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str, by: list[str]) -> DataFrame:
    """``table`` dealt over all tasks by a hash of ``by``.

    A file is read by no more tasks than it has row groups, and plans that open every
    row into many would go on in these few tasks. There are more of them where the table
    is large, so that a task sorts its opened rows in memory; rows are counted from the
    files' footers.
    """
    rows = table(spark, folder, name)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // TASK_ROWS))
    return rows.repartition(parts, *by)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder next to the checkpoints, which every executor can reach."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
