"""Hard negatives by vertical scans of vectors (BOND).

An anchor's positives are the best rows of its own label; the negatives of a
positive are the best rows of other labels whose score lies in a window under the
positive's. Scores are inner products of integer components, so they are exact.

* **Vertical blocks.** Rows are written once in blocks of columns: each dimension
  is an array of its own, with its least and largest value in the block.
* **Scan.** For an anchor, a block's dimensions are read in descending magnitude
  of the anchor's component. What the dimensions not yet read can still add lies
  between the sums of their least and largest products; partial scores with these
  bounds clear bits of the candidate bitmap. Columns are read for set bits alone.
  The bound to beat is the ``top``-th best score the task has seen so far, or the
  ``top``-th best lower bound in the block. When all dimensions are read the few
  remaining scores are exact.
* **Windows.** A candidate of a window ``[least, most]`` stays while its bounds
  meet the window and can still beat the ``top``-th best candidate that is surely
  in it. One scan resolves all windows of an anchor.
* Anchors are broadcast in groups of at most ``ANCHOR_BYTES``; a group scans all
  blocks, once for the positives and once for the negatives. A task sends at most
  ``top`` rows for an anchor or window, which are ranked per anchor.

Cases: rows with a null id, label or vector, or with a null or non-finite
component take no part. Vectors of different length never meet, as do empty ones.
An id that repeats counts once for an anchor, with its best score (in the window);
it is one anchor, the first by label and vector. Ties go to the smaller id. A
component beyond ``component_limit`` takes the limit, so that every score fits a
long. Anchors without positives, and positives without negatives, have no rows.
Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlib.llm.registry import query, table
from martlib.session import cut_lineage

SCALE = 256
TOP = 5  # positives of an anchor, and negatives of a positive
WINDOW = (80, 100)  # percent of the positive's score
BLOCK_ROWS = 8_192  # rows of a vertical block
STEP = 8  # dimensions read between two looks at the bounds
ANCHOR_BYTES = 16 << 20  # vectors of the anchors that are scanned for together
BLOCK = "dim int, ids binary, labels binary, columns binary"


class Block(NamedTuple):
    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray  # dimension by row
    least: np.ndarray
    most: np.ndarray


def component_limit(dim: int) -> int:
    """Largest magnitude of a component, for vectors of ``dim`` components."""
    return math.isqrt((1 << 61) // max(1, dim))


def to_integers(values: np.ndarray, scale: int) -> np.ndarray:
    limit = component_limit(values.shape[-1])
    return np.clip(np.floor(values.astype(np.float64) * scale), -limit, limit).astype(np.int64)


def narrow(x: np.ndarray) -> np.ndarray:
    most = int(np.abs(x).max(initial=0))
    return x.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def _block_pass(scale: int):
    """Rows of ``(vec_id, label, embedding)`` as vertical blocks, by dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}

        def out(d):
            ids, labels, x = (np.concatenate(c) for c in zip(*held.pop(d), strict=True))
            rows = [(ids[lo:lo + BLOCK_ROWS], labels[lo:lo + BLOCK_ROWS], narrow(x[lo:lo + BLOCK_ROWS].T)) for lo in range(0, len(ids), BLOCK_ROWS)]
            return pa.RecordBatch.from_arrays([pa.array([d] * len(rows), pa.int32()), *[pa.array([np.ascontiguousarray(r[i]).tobytes() for r in rows], pa.binary()) for i in range(3)]], ["dim", "ids", "labels", "columns"])

        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == d))
                x = to_integers(np.asarray(part.column("embedding").flatten()).reshape(-1, d), scale)
                held.setdefault(d, []).append((part.column("vec_id").to_numpy(), part.column("label").to_numpy(), x))
                if sum(len(r[0]) for r in held[d]) >= BLOCK_ROWS:
                    yield out(d)
        for d in list(held):
            yield out(d)
    return run


def read_block(d: int, ids: bytes, labels: bytes, columns: bytes) -> Block:
    n = len(ids) // 8
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(columns) // (n * d)]
    x = np.frombuffer(columns, kind).reshape(d, n).astype(np.int64)
    return Block(np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), x, x.min(axis=1), x.max(axis=1))


class Scan:
    """Partial scores of an anchor in a block, its dimensions read largest magnitude first."""

    def __init__(self, block: Block, anchor: np.ndarray, bitmap: np.ndarray) -> None:
        self.block, self.anchor, self.bitmap = block, anchor, bitmap
        self.order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * block.least, anchor * block.most])[:, self.order]
        # what the dimensions from place i on add, at least and at most
        self.low = np.concatenate([np.cumsum(ends.min(axis=0)[::-1])[::-1], [0]])
        self.high = np.concatenate([np.cumsum(ends.max(axis=0)[::-1])[::-1], [0]])
        self.rows = np.flatnonzero(bitmap)
        self.score = np.zeros(len(self.rows), np.int64)

    def __iter__(self) -> Iterator[tuple[np.ndarray, int, int]]:
        """After every few dimensions: the partial scores and what may be added to them."""
        dim = len(self.order)
        for at in range(0, dim, STEP):
            d = self.order[at:at + STEP]
            columns = self.block.columns[d] if len(self.rows) == self.block.columns.shape[1] else self.block.columns[d[:, None], self.rows]
            self.score += self.anchor[d] @ columns
            done = min(dim, at + STEP)
            yield self.score, int(self.low[done]), int(self.high[done])
            if not len(self.rows):
                return

    def keep(self, which: np.ndarray) -> None:
        if not which.all():
            self.bitmap[self.rows[~which]] = False
            self.rows, self.score = self.rows[which], self.score[which]


def kth(values: np.ndarray, k: int, floor: int) -> int:
    """The ``k``-th largest value, not under ``floor``."""
    if len(values) < k:
        return floor
    return max(floor, int(np.partition(values, len(values) - k)[len(values) - k]))


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` ids by score and id, each once."""
    by = np.lexsort((ids, -scores))
    ids, scores = ids[by], scores[by]
    _, first = np.unique(ids, return_index=True)
    first = np.sort(first)[:k]
    return ids[first], scores[first]


NONE = -(1 << 63)


def scan_top(block: Block, anchor: np.ndarray, bitmap: np.ndarray, k: int, floor: int, distinct: bool) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best rows of the bitmap that score ``floor`` or more. Where ids repeat, the bounds of rows say nothing about the ``k``-th id."""
    scan = Scan(block, anchor, bitmap)
    for score, low, high in scan:
        bound = kth(score + low, k, floor) if distinct else floor
        if bound > NONE:
            scan.keep(score + high >= bound)
    return best(block.ids[scan.rows], scan.score, k)


def scan_windows(block: Block, anchor: np.ndarray, bitmap: np.ndarray, least: np.ndarray, most: np.ndarray, floor: np.ndarray, k: int, distinct: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window the ``k`` best rows of the bitmap that score in it, ``floor`` or more."""
    bound = np.maximum(least, floor)
    scan = Scan(block, anchor, bitmap)
    for score, low, high in scan:
        down, up = score + low, score + high
        stay = np.zeros(len(score), bool)
        for w in range(len(bound)):
            if distinct:
                sure = down[(down >= bound[w]) & (up <= most[w])]
                bound[w] = kth(sure, k, int(bound[w]))
            stay |= (up >= bound[w]) & (down <= most[w])
        scan.keep(stay)
    out = []
    for w in range(len(bound)):
        hit = (scan.score >= bound[w]) & (scan.score <= most[w])
        out.append(best(block.ids[scan.rows[hit]], scan.score[hit], k))
    return out


class Found:
    """The best rows a task has seen for every anchor or window."""

    def __init__(self, k: int) -> None:
        self.k, self.rows = k, {}

    def floor(self, key) -> int:
        got = self.rows.get(key)
        return int(got[1][-1]) if got is not None and len(got[0]) == self.k else NONE

    def add(self, key, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(ids):
            old = self.rows.get(key)
            self.rows[key] = (ids, scores) if old is None else best(np.concatenate([old[0], ids]), np.concatenate([old[1], scores]), self.k)

    def batches(self) -> Iterator[pa.RecordBatch]:
        items = list(self.rows.items())
        for lo in range(0, len(items), 4096):
            part = items[lo:lo + 4096]
            n = [len(ids) for _, (ids, _) in part]
            key = [np.repeat(np.array([k[i] for k, _ in part], np.int64), n) for i in range(2)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, key), pa.array(np.concatenate([r[0] for _, r in part])), pa.array(np.concatenate([r[1] for _, r in part]))], ["anchor", "window", "id", "score"])


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, bool]]:
    """Blocks, and whether their ids are distinct."""
    for b in batches:
        for d, ids, labels, columns in zip(*(b.column(c) for c in ("dim", "ids", "labels", "columns")), strict=True):
            block = read_block(d.as_py(), ids.as_py(), labels.as_py(), columns.as_py())
            yield block, len(np.unique(block.ids)) == len(block.ids)


FOUND = "anchor long, window long, id long, score long"
Anchors = dict[int, list[tuple[int, int, np.ndarray]]]  # by dimension: id, label, components


def _positive_pass(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Found(k)
        for block, distinct in read_blocks(batches):
            same = {x: block.labels == x for x in np.unique(block.labels).tolist()}
            for i, label, x in sent.value.get(len(block.columns), ()):
                if label in same:
                    bitmap = same[label] & (block.ids != i)
                    if bitmap.any():
                        found.add((i, 0), *scan_top(block, x, bitmap, k, found.floor((i, 0)), distinct))
        yield from found.batches()
    return run


def _negative_pass(sent, windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Found(k)
        for block, distinct in read_blocks(batches):
            other = {x: block.labels != x for x in np.unique(block.labels).tolist()}
            for i, label, x in sent.value.get(len(block.columns), ()):
                if i in windows.value:
                    names, least, most = windows.value[i]
                    bitmap = (other[label] if label in other else np.ones(len(block.ids), bool)) & (block.ids != i)
                    if bitmap.any():
                        floor = np.array([found.floor((i, w)) for w in names.tolist()], np.int64)
                        for w, got in zip(names.tolist(), scan_windows(block, x, bitmap, least, most, floor, k, distinct), strict=True):
                            found.add((i, w), *got)
        yield from found.batches()
    return run


def first_rows(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` ids of each anchor and window, ranked; an id that several tasks sent counts once."""
    once = found.groupBy("anchor", "window", "id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    return once.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: Column | None = None, scale: int = SCALE, top: int = TOP, window: tuple[int, int] = WINDOW) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on ``vectors``; every row that meets it is compared
    with all rows. ``window`` bounds a negative's score, in percent of the positive's.
    """
    spark = vectors.sparkSession
    e, given = F.col("embedding"), label if label is not None else F.col("label")
    good = e.isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), given.alias("label"), F.col(embedding).alias("embedding"), F.coalesce(anchors, F.lit(False)).alias("anchor")).where(good)
    if rows.schema["label"].dataType.typeName() in ("byte", "short", "integer", "long"):
        rows = rows.withColumn("label", F.col("label").cast("long"))
    else:
        rows = rows.withColumn("label", F.xxhash64("label"))
    rows = rows.withColumn("dim", F.size("embedding")).where("dim > 0")
    blocks = cut_lineage(rows.select("vec_id", "label", "embedding", "dim").mapInArrow(_block_pass(scale), BLOCK))
    asked = rows.where("anchor").groupBy("vec_id").agg(F.min(F.struct("label", "embedding", "dim")).alias("r")).select("vec_id", "r.*")
    asked = cut_lineage(asked)
    size = asked.agg(F.sum(8 * F.col("dim"))).first()[0] or 0
    groups = max(1, math.ceil(1.25 * size / ANCHOR_BYTES))
    out = []
    for g in range(groups):
        mine = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).collect()
        if not mine:
            continue
        told: Anchors = {}
        for r in mine:
            told.setdefault(r["dim"], []).append((r["vec_id"], r["label"], to_integers(np.array(r["embedding"], np.float64), scale)))
        sent = spark.sparkContext.broadcast(told)
        positives = cut_lineage(first_rows(blocks.mapInArrow(_positive_pass(sent, top), FOUND), top).select(F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
        scores: dict[int, set[int]] = {}
        for r in positives.select("anchor_id", "positive_score").collect():  # at most ``top`` an anchor of the group
            scores.setdefault(r[0], set()).add(r[1])
        windows = {}
        for i, held in scores.items():
            # 100 * s is between the two percentages of the positive's score; none where that is negative
            p = [s for s in sorted(held, reverse=True) if window[0] * s <= window[1] * s]
            if p:
                windows[i] = (np.array(p, np.int64), np.array([-(-window[0] * s // 100) for s in p], np.int64), np.array([window[1] * s // 100 for s in p], np.int64))
        found = blocks.mapInArrow(_negative_pass(sent, spark.sparkContext.broadcast(windows), top), FOUND)
        negatives = first_rows(found, top).select(F.col("anchor").alias("anchor_id"), F.col("window").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        # a group has a bounded number of anchors, and so of positives
        out.append(cut_lineage(negatives.join(F.broadcast(positives), ["anchor_id", "positive_score"])))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if not out:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    result = out[0].select(*names)
    for x in out[1:]:
        result = result.unionByName(x.select(*names))
    return result


ORACLE = """
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 5"""


@query("op13_bond_negatives", ORACLE)
def op13_bond_negatives(spark, folder):
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label)
