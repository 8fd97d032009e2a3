"""Mixing sources to target weights along a time-varying curriculum.

* **Targets.** Sources in the order of their code points (null last) get the
  weights 5, 2, 1, repeating, and share all words by weight. No target exceeds
  three times its source; the excess is shared again by weight. In closed form:
  with sources sorted by size / weight, a prefix is full and the others get
  ``level * weight``.
* **Taken documents.** The documents of a source have a fixed order by hash.
  ``target / size`` gives full passes over all of them and a rest, which takes
  documents from the front; then, ``CHANGES`` times, the one document is taken in
  or out whose change brings the sum nearest to the target. Documents are taken whole.
* **Curriculum.** Each source has a schedule, a piecewise linear weight over the
  training time 0 to 1. Its integral is the share of the source's words due by
  then; inverting it at a copy's place in the source's word count gives the
  training position of the copy. Documents are range-sorted by position.

The order within a source is cut into blocks by the leading bits of the hash.
Windows run per (source, block) and the blocks' sums are carried on, so that a
source with a third of all rows is spread over many tasks.

Cases: a null text has size 0 and is never taken, like one without words. Rows
that repeat are separate documents. Rows with a null source form a source. If no
row has words, all targets are 0. Every row of the input comes back once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlib.llm.registry import query, table
from martlib.session import cut_lineage, small_side

WEIGHTS = (5, 2, 1)
MOST = 3  # times a document is taken, at most
# (time, weight) corners of the schedules, dealt to the sources like the weights
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)), ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)))
CHANGES = 3  # documents taken in or out of a source's rest, at most, to meet its target
BLOCK_BITS = 12  # a source is cut into 2**12 blocks by hash
WORD = r"[^\x20\x09-\x0D]+"
ROW = ["_mix_hash", "_mix_copy"]


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes(source, source_size)`` with ``source_no`` and ``target``. One row a source: windows over all of them are small."""
    number = Window.orderBy(F.col("source").asc_nulls_last())
    df = sizes.withColumn("source_no", F.row_number().over(number) - 1)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("source_no", F.lit(len(weights))))
    df = df.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(MOST)))
    full_first = Window.orderBy(F.col("limit") / F.col("weight"), "source_no")
    up_to = full_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = full_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    df = df.withColumn("rank", F.row_number().over(full_first))
    df = df.withColumn("level", (F.sum("source_size").over(every) - F.sum("limit").over(up_to) + F.col("limit")) / F.sum("weight").over(rest))
    df = df.withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    level = F.min_by(F.when(~F.col("full"), F.col("level")), F.when(~F.col("full"), F.col("rank"))).over(every)
    target = F.when(F.col("full") | level.isNull(), F.col("limit")).otherwise(level * F.col("weight"))
    return df.select("source", "source_size", "source_no", target.alias("target"))


def position(share: Column, corners: tuple[tuple[float, float], ...]) -> Column:
    """Time by which a schedule has dealt out ``share`` of its integral."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(corners[:-1], corners[1:], strict=True)]
    total, before = sum(areas), 0.0
    out = F.lit(corners[-1][0])
    parts = []
    for ((t0, w0), (t1, w1)), area in zip(zip(corners[:-1], corners[1:], strict=True), areas, strict=True):
        due = F.greatest(F.lit(0.0), share * total - before)
        slope = (w1 - w0) / (t1 - t0)
        step = due / w0 if slope == 0 else (F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * due)) - w0) / slope
        parts.append((share * total <= before + area, t0 + step))
        before += area
    for holds, value in reversed(parts):
        out = F.when(holds, value).otherwise(out)
    return F.least(F.lit(corners[-1][0]), F.greatest(F.lit(corners[0][0]), out))


def nearest_change(rows: DataFrame) -> DataFrame:
    """Takes the one document of each source in or out of the rest that brings the sum nearest to the target; none, if each is worse."""
    gap = rows.groupBy("source_no").agg((F.first("rest") - F.sum(F.col("size") * F.col("extra"))).alias("gap"))
    change = F.when(F.col("extra") == 1, -F.col("size")).otherwise(F.col("size"))
    left = F.abs(F.col("gap") - change)
    tried = rows.where((F.col("size") > 0) & (F.col("passes") < MOST)).join(small_side(gap), "source_no").where(left < F.abs("gap"))
    best = tried.groupBy("source_no").agg(F.min(F.struct(left.alias("left"), "block", "place")).alias("best")).select(F.col("source_no").alias("no"), F.col("best.block").alias("at_block"), F.col("best.place").alias("at_place"))
    same = (F.col("source_no") == F.col("no")) & (F.col("block") == F.col("at_block")) & (F.col("place") == F.col("at_place"))
    changed = rows.join(small_side(best), same, "left").withColumn("extra", F.when(F.col("no").isNotNull(), 1 - F.col("extra")).otherwise(F.col("extra")))
    return cut_lineage(changed.select(*rows.columns))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, schedules: tuple = SCHEDULES, seed: int = 0) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken, copies, positions`` and the row's hash and number among equal rows."""
    identity = F.xxhash64(F.lit(seed), "doc_id", "source", "text")
    sized = cut_lineage(docs.select("doc_id", "source", word_count("text").alias("size"), identity.alias("h")))
    sources = cut_lineage(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights))
    named = small_side(sources.withColumnRenamed("source", "name"))
    rows = sized.join(named, F.col("source").eqNullSafe(F.col("name"))).drop("name", "source")
    rows = rows.withColumn("block", F.shiftright("h", 64 - BLOCK_BITS))

    blocks = rows.groupBy("source_no", "block").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source_no").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("source_no", "block", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("skipped"))
    inside = Window.partitionBy("source_no", "block").orderBy("h", "doc_id")
    rows = rows.withColumn("place", F.row_number().over(inside)).withColumn("run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.join(blocks, ["source_no", "block"]).withColumn("start", F.col("skipped") + F.col("run") - F.col("size"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    rows = rows.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
    rows = rows.withColumn("more", ((F.col("size") > 0) & (F.col("start") + F.col("size") / 2 <= F.col("rest")) & (F.col("passes") < MOST)).cast("int"))
    rows = cut_lineage(rows.select("doc_id", "h", "size", "source_no", "source_size", "target", "block", "place", "start", "passes", "rest", "more"))

    rows = rows.withColumn("extra", F.col("more"))
    for _ in range(CHANGES):
        rows = nearest_change(rows)

    sums = rows.groupBy("source_no").agg(F.sum(F.col("size") * (F.col("passes") + F.col("extra"))).alias("all_taken"))
    rows = rows.join(small_side(sums), "source_no")
    copies = F.when(F.col("size") > 0, F.col("passes") + F.col("extra")).otherwise(F.lit(0))
    shape = F.pmod("source_no", F.lit(len(schedules)))

    def at(i):
        share = (i * F.col("source_size") + F.col("start") + F.col("size") / 2) / F.col("all_taken")
        out = position(share, schedules[-1])
        for k in range(len(schedules) - 1):
            out = F.when(shape == k, position(share, schedules[k])).otherwise(out)
        return out

    rows = rows.withColumn("copies", copies)
    positions = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), at)).otherwise(F.array().cast("array<double>"))
    alike = Window.partitionBy("source_no", "block", "h").orderBy("place")
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", positions.alias("positions"),
        F.col("h").alias(ROW[0]), F.row_number().over(alike).alias(ROW[1]),
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, schedules: tuple = SCHEDULES, seed: int = 0) -> DataFrame:
    """The documents of the mix in training order, as often as the mix takes them.

    Rows are matched by a hash of id, source and text, and by their number
    among equal rows, so nulls and repeated rows keep their own copies.
    """
    taken = plan(docs, weights, schedules, seed).where("copies > 0").select(*ROW, F.explode("positions").alias("_mix_position"))
    keyed = docs.withColumn(ROW[0], F.xxhash64(F.lit(seed), "doc_id", "source", "text"))
    keyed = keyed.withColumn(ROW[1], F.row_number().over(Window.partitionBy(ROW[0]).orderBy("doc_id")))
    return keyed.join(taken, ROW).orderBy("_mix_position", ROW[0]).select(*docs.columns)


@query("op10_mixing")
def op10_mixing(spark, folder):
    rows = plan(table(spark, folder, "documents"))
    first = F.array_min("positions").alias("position")
    return rows.select("doc_id", "size", "source_size", "target", "taken", "copies", first).orderBy(F.col("position").asc_nulls_last(), "doc_id")
