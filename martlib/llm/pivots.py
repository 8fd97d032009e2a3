"""Near-duplicate vectors by a pivot-permutation index.

1. Equal vectors become one class with a weight.
2. **Pivots** are a sample of the classes, ``4 * sqrt(classes)`` rounded up to a power
   of two between ``PIVOTS`` bounds, so that lists stay short as the data grow.
   A drawn vector near an earlier pivot is passed over; otherwise a large group
   of near copies would hold many pivots and its members different ones. A vector is described by its ``PREFIX`` nearest pivots in order.
3. **Inverted lists**: each vector is sent to the list of each of its pivots, with
   its description. Two vectors are candidates when they share at least
   ``SHARED`` pivots. In the list of pivot p, the vectors that also hold q form a
   sub-list; a pair is taken where p and q are the two smallest pivots it shares,
   so it is retrieved once however many it shares. A long list is cut into
   blocks, and every pair of blocks is a task of its own.
4. Candidates are **verified** by the cosine in double precision. A task gives
   each vector's number of links and a spanning forest of the links, never the
   pairs of a group.

The index holds every vector; only the pivots are a sample. Recall against brute
force is measured in the tests (0.998 for random pairs at exactly 0.9).

Cases: null and zero vectors, and vectors with a null, infinite or NaN component,
link with nothing. Vectors of different length never link. Rows that repeat are
vectors of their own and link with each other. A row with a null id has no links
and a null component. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlib.llm.components import components
from martlib.llm.ngram_join import forest, runs_of
from martlib.llm.registry import query, table
from martlib.session import cut_lineage

PIVOTS = (256, 65_536)  # fewest and most pivots
APART = 0.5  # cosine of two pivots, at most
PREFIX = 10  # pivots that describe a vector
SHARED = 2  # pivots that candidates share
LIST_ROWS = 8_192  # vectors in a block of an inverted list
ROWS = 1_024  # vectors compared with others at a time


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def apart(rows: np.ndarray, most: int) -> np.ndarray:
    """The first rows of a sample that are not near an earlier one."""
    taken: list[int] = []
    near = np.zeros(len(rows), bool)
    for i in range(len(rows)):
        if not near[i] and len(taken) < most:
            taken.append(i)
            near |= rows @ rows[i] > APART
    return rows[taken]


def describe(rows: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each row, nearest first."""
    out = []
    k = min(prefix, len(pivots))
    for lo in range(0, len(rows), ROWS):
        near = rows[lo:lo + ROWS] @ pivots.T
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        out.append(np.take_along_axis(top, np.argsort(-np.take_along_axis(near, top, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out).astype(np.int32)


def list_links(pivot: int, rows: np.ndarray, near: np.ndarray, weight: np.ndarray, left: np.ndarray, right: np.ndarray, least: float, shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links in one list between vectors of the left and the right block.

    Returns each vector's weight of links, and the ends of links that connect the linked vectors.
    """
    n = len(rows)
    held = np.where(near > pivot, near, -1) if shared > 1 else np.where(near == pivot, near, -1)
    who, at = np.nonzero(held >= 0)
    second = held[who, at]
    by = np.argsort(second, kind="stable")
    who, second = who[by], second[by]
    cuts = np.flatnonzero(np.diff(second)) + 1
    degree, ends_a, ends_b = np.zeros(n, np.int64), [], []
    for q, members in zip(second[np.concatenate([[0], cuts])] if len(who) else [], np.split(who, cuts), strict=True) if len(who) else []:
        a, b = members[left[members]], members[right[members]]
        if not len(a) or not len(b):
            continue
        for lo in range(0, len(a), ROWS):
            i, j = np.nonzero(rows[a[lo:lo + ROWS]] @ rows[b].T >= least)
            i, j = a[lo:lo + ROWS][i], b[j]
            once = (i != j) & ((i < j) | ~(left[j] & right[i]))
            i, j = i[once], j[once]
            if not len(i):
                continue
            if shared > 1:
                # taken here only if p and q are the two smallest pivots the pair shares
                fresh = np.zeros(len(i), bool)
                for c in range(0, len(i), 65_536):
                    x, y = near[i[c:c + 65_536]], near[j[c:c + 65_536]]
                    common = (x[:, :, None] == y[:, None, :]).any(axis=2)
                    fresh[c:c + 65_536] = ~(common & ((x < pivot) | ((x > pivot) & (x < q)))).any(axis=1)
                i, j = i[fresh], j[fresh]
            np.add.at(degree, i, weight[j])
            np.add.at(degree, j, weight[i])
            root = forest(i, j, n)
            moved = np.flatnonzero(root != np.arange(n))
            ends_a.append(moved)
            ends_b.append(root[moved])
    if not ends_a:
        return degree, np.zeros(0, np.int64), np.zeros(0, np.int64)
    root = forest(np.concatenate(ends_a), np.concatenate(ends_b), n)
    moved = np.flatnonzero(root != np.arange(n))
    return degree, moved, root[moved]


def vector_links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.9, prefix: int = PREFIX, shared: int = SHARED) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row."""
    spark = vectors.sparkSession
    kind = np.dtype("<f4") if "float" in vectors.schema[embedding].dataType.simpleString() else np.dtype("<f8")
    e = F.col("embedding")
    good = F.col("vec_id").isNotNull() & e.isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding")).withColumn("good", F.coalesce(good, F.lit(False)))
    named = cut_lineage(rows.select("vec_id", F.when(F.col("good"), F.xxhash64(F.lit(1), "embedding")).alias("h"), F.when(F.col("good"), F.xxhash64(F.lit(2), "embedding")).alias("g")))
    sized = named.where("h is not null").groupBy("h", "g").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    classes = cut_lineage(sized)
    heads = rows.where("good").withColumn("h", F.xxhash64(F.lit(1), "embedding")).withColumn("g", F.xxhash64(F.lit(2), "embedding"))
    heads = heads.join(classes, (heads["h"] == classes["h"]) & (heads["g"] == classes["g"]) & (heads["vec_id"] == classes["rep"])).select("rep", "weight", "embedding", F.size("embedding").alias("dim"), classes["h"]).dropDuplicates(["rep", "h"])
    heads = cut_lineage(heads)

    number = classes.count()
    most = min(PIVOTS[1], max(PIVOTS[0], 1 << math.ceil(math.log2(4 * math.sqrt(max(1, number))))))
    ranked = heads.withColumn("rank", F.row_number().over(Window.partitionBy("dim").orderBy("h", "rep"))).where(F.col("rank") <= 2 * most)
    pivots: dict[int, list] = {}
    for r in ranked.select("dim", "rank", "embedding").collect():
        pivots.setdefault(r["dim"], []).append((r["rank"], r["embedding"]))
    tables = {d: apart(unit(np.array([v for _, v in sorted(p)], np.float64)), most) for d, p in pivots.items()}
    sent = spark.sparkContext.broadcast(tables)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            for d in np.unique(dims).tolist():
                part = b.filter(pa.array(dims == d))
                x = np.asarray(part.column("embedding").flatten()).astype(kind).reshape(-1, d)
                near = describe(unit(x.astype(np.float64)), sent.value[d], prefix)
                yield pa.RecordBatch.from_arrays([part.column("rep"), part.column("weight"), part.column("dim"), pa.array(list(map(bytes, near)), pa.binary()), pa.array(list(near), pa.list_(pa.int32())), pa.array([v.tobytes() for v in x], pa.binary())], ["rep", "weight", "dim", "near", "pivots", "vector"])

    indexed = cut_lineage(heads.select("rep", "weight", "dim", "embedding").mapInArrow(index, "rep long, weight long, dim int, near binary, pivots array<int>, vector binary"))
    lists = indexed.select("dim", F.explode("pivots").alias("pivot")).groupBy("dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / LIST_ROWS).cast("int").alias("blocks"))
    posted = indexed.select("*", F.explode("pivots").alias("pivot")).drop("pivots").join(lists, ["dim", "pivot"])
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    # block pairs (a, b) with a <= b; a vector goes to every pair that holds its block
    posted = posted.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    posted = posted.select("dim", "pivot", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "rep", "weight", "near", "vector")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["dim", "pivot", "a", "b"]
    dealt = posted.repartition(parts, *keys).sortWithinPartitions(*keys)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs_of(batches, keys):
            if t.num_rows < 2:
                continue
            d, pivot, a, b = (t.column(k)[0].as_py() for k in keys)
            near = np.stack([np.frombuffer(x.as_buffer(), np.int32) for c in t.column("near").chunks for x in c])
            x = unit(np.stack([np.frombuffer(x.as_buffer(), kind) for c in t.column("vector").chunks for x in c]).astype(np.float64))
            own, rep, weight = t.column("own").to_numpy(), t.column("rep").to_numpy(), t.column("weight").to_numpy()
            degree, i, j = list_links(pivot, x, near, weight, own == a, own == b, least, min(shared, near.shape[1]))
            some = np.flatnonzero(degree)
            if len(some):
                yield pa.RecordBatch.from_arrays([pa.array(rep[some]), pa.nulls(len(some), pa.int64()), pa.array(degree[some])], ["a", "b", "links"])
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(rep[i]), pa.array(rep[j]), pa.nulls(len(i), pa.int64())], ["a", "b", "links"])

    found = cut_lineage(dealt.mapInArrow(verify, "a long, b long, links long"))
    degrees = found.where("links is not null").groupBy("a").agg(F.sum("links").alias("links"))
    groups = components(found.where("b is not null"))
    by_class = classes.join(degrees, F.col("rep") == F.col("a"), "left").join(groups, F.col("rep") == F.col("node"), "left")
    by_class = by_class.select("h", "g", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = named.join(by_class, ["h", "g"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


@query("op8_pivots")
def op8_pivots(spark, folder):
    return vector_links(table(spark, folder, "embeddings"))
