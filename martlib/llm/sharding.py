"""Sharding by longest-processing-time scheduling.

Rows of one group (equal texts) must stay together. Groups, largest first, go to
the least-loaded shard, which a heap finds. One heap over all groups would be one
task, so there are two levels, each with its heap:

1. Groups are summed up (before the shuffle, so a hot one is a row a task) and
   dealt to tasks by hash. A task sorts its groups by size and puts each into the
   least-loaded of its bundles. It holds its bundles' loads only.
2. The bundles of all tasks, largest first, go to the least-loaded shard. There are
   about ``BUNDLES`` of them, or one a shard and task if that is more, whatever the
   number of rows; a group larger than the other bundles of its task has one for itself.

While the groups are fewer than the bundles, this is the plain schedule. The order
in a shard is that of the id. Groups are named by a 64-bit hash; should two
collide, they stay together.

Cases: a null text counts as the empty text. Repeated rows are a group. Rows with
a null id come first in their shard. Among equal ids the order is that of the
group. Columns named like the results are replaced; no other name can clash. An
empty table gives an empty result. A group larger than a shard's share makes its shard larger: it is
never split.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlib.llm.registry import free_name, query, table
from martlib.operators.ordered import RunningCount, ordered
from martlib.session import cut_lineage

SHARDS = 24
BUNDLES = 1 << 15  # bundles of all tasks together
ROW_BYTES = 8  # what a row takes besides its text
HOT = 4  # a group with more rows than a quarter of a task's share is joined by broadcast; there are at most 4 a task


def least_loaded(sizes: list[int], heap: list[tuple[int, int]]) -> list[int]:
    """The place each size goes to; ``heap`` holds (load, place) and is changed."""
    out = []
    for s in sizes:
        load, place = heap[0]
        heapq.heapreplace(heap, (load + s, place))
        out.append(place)
    return out


def schedule(rows: DataFrame, group: str, size: str, shards: int = SHARDS) -> DataFrame:
    """``group, rows, size, shard`` of every group; ``group`` names it by a long."""
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bundles = shards * -(-BUNDLES // (shards * tasks))  # a multiple of the shards: equal bundles give equal shards
    sums = rows.groupBy(F.col(group).alias("group")).agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("size"))
    dealt = sums.repartition(tasks, "group").sortWithinPartitions(F.desc("size"), "group")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() * bundles
        heap = [(0, first + i) for i in range(bundles)]
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(least_loaded(b.column(2).to_pylist(), heap), pa.int64())], ["group", "rows", "size", "bundle"])

    bundled = cut_lineage(dealt.mapInArrow(bundle, "group long, rows long, size long, bundle long"))
    loads = sorted(((r["size"], r["bundle"]) for r in bundled.groupBy("bundle").agg(F.sum("size").alias("size")).collect()), key=lambda x: (-x[0], x[1]))
    places = least_loaded([s for s, _ in loads], [(0, i) for i in range(shards)])
    to = spark.createDataFrame(pa.table({"bundle": pa.array([b for _, b in loads], pa.int64()), "shard": pa.array(places, pa.int32())}))
    return bundled.join(F.broadcast(to), "bundle").select("group", "rows", "size", "shard")


def assign(rows: DataFrame, group: str, size: str, shards: int = SHARDS, order: tuple[str, ...] = (), shard: str = "shard", slot: str = "slot") -> DataFrame:
    """``rows`` with their ``shard`` and their ``slot`` in it (from 0, without gaps, by ``order``).

    ``rows`` are read several times and written once; pass what is needed only.
    """
    rows = rows.drop(*[c for c in (shard, slot) if c not in (group, size, *order)])
    spark = rows.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row, own, name = (free_name(rows.columns, x) for x in ("_shard_row", "_shard_own", "_shard_group"))
    laid = cut_lineage(rows.withColumns({row: F.monotonically_increasing_id(), own: F.xxhash64(group)}))
    plan = cut_lineage(schedule(laid, own, size, shards).select(F.col("group").alias(name), F.col("rows").alias(f"{name}_rows"), F.col("shard").alias(f"{name}_shard")))
    total = plan.agg(F.sum(f"{name}_rows")).first()[0] or 0
    is_hot = F.col(f"{name}_rows") * F.lit(HOT * tasks) > total
    hot, rest = F.broadcast(plan.where(is_hot)), plan.where(~is_hot)
    same = F.col(own) == F.col(name)
    placed = laid.join(hot, same).unionByName(laid.join(hot, same, "left_anti").join(rest, same))
    placed = placed.withColumn(shard, F.col(f"{name}_shard")).drop(name, f"{name}_rows", f"{name}_shard")
    numbered = ordered(placed, [shard], [*order, own, row], {slot: RunningCount(F.lit(True))})
    return numbered.withColumn(slot, F.col(slot) - 1).drop(row, own)


def text_group(text: str = "text"):
    """Name of the group of equal texts."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: the place of every document."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + F.lit(ROW_BYTES)).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), text_group(text).alias("group"))
    return assign(rows, "group", "size", shards, order=("doc_id",)).drop("group")


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, text: str = "text") -> None:
    """Writes ``docs`` as Parquet, one folder ``shard=N`` for each shard; equal texts lie in one."""
    group, shard = (free_name(docs.columns, x) for x in ("_shard_of", "shard"))
    named = docs.withColumn(group, text_group(text))
    sizes = named.select(F.col(group).alias("group"), (F.octet_length(F.coalesce(F.col(text), F.lit(""))) + F.lit(ROW_BYTES)).cast("long").alias("size"))
    plan = schedule(sizes, "group", "size", shards).select(F.col("group").alias(group), F.col("shard").alias(shard))
    named.join(plan, group).drop(group).write.partitionBy(shard).parquet(folder)


@query("op12_sharding")
def op12_sharding(spark, folder):
    found = shard_documents(table(spark, folder, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
