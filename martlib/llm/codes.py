"""Vector codes by product quantisation, with active-entry Lloyd rounds.

A vector is cut into equal parts; each part position has a codebook, and a part's
code is its nearest entry. All arithmetic is in integers, so results are exact and
the same on any partitioning.

* A row keeps, for each part, its entry and the **exact squared distance** to it.
* After an update only the entries that moved are **active**. A part whose own
  entry stayed fixed has a distance that still holds, and no fixed entry can have
  come nearer: it is compared with the active entries alone. Where its own entry
  moved, the part is compared with the whole codebook. In both cases the smallest
  distance wins, and the lower index among equal ones.
* One pass a round writes the new codes and, for every task, one row of sums and
  counts for each entry; an entry is moved to the floor of sum / count. Only the
  codebooks (``entries * dimension`` integers) reach the driver.

Cases: rows whose vector is null or holds a null or non-finite component are
dropped. The dimension is that of the smallest id whose vector can be cut into
equal parts; vectors of another length are dropped too. A component beyond
``component_limit`` takes the limit, so that every distance fits a long.
Rows that repeat are rows of their own; one without an id is coded, but no first
entry. With fewer rows than entries the codebook has that many. Where all are
dropped, the result is empty. Only id, vector and the columns asked for are read,
under names that cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlib.llm.registry import query, table
from martlib.operators.ordered import join_null_safe
from martlib.session import cut_lineage, small_side

PARTS = 4
ENTRIES = 256  # of a codebook; a code is one byte
ROUNDS = 4
SCALE = 1024
ROWS = 2_048  # rows compared with a codebook at a time
STATE = "vec_id long, label {label}, vector binary, code binary, near binary, part int, entry int, n long, sums array<long>"


def component_limit(width: int) -> int:
    """Largest magnitude of a component, for parts of ``width`` components."""
    return math.isqrt((1 << 58) // max(1, width))


def to_integers(values: np.ndarray, scale: int, limit: int) -> np.ndarray:
    return np.clip(np.floor(values.astype(np.float64) * scale), -limit, limit).astype(np.int64)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all ``entries``, exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * x.shape[1] * most * most < 1 << 53:
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        out += (x[:, i, None] - entries[None, :, i]) ** 2
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and distance of the nearest entry of each row; the lower index among equal ones."""
    at, near = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for lo in range(0, len(x), ROWS):
        d = distances(x[lo:lo + ROWS], entries)
        k = d.argmin(axis=1)
        at[lo:lo + ROWS], near[lo:lo + ROWS] = k, d[np.arange(len(d)), k]
    return at, near


def reassign(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, at: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New index and distance of each row, where ``at`` and ``near`` held before the entries of ``moved`` did."""
    at, near = at.copy(), near.copy()
    lost = moved[at]
    if lost.any():
        at[lost], near[lost] = nearest(x[lost], entries)
    active = np.flatnonzero(moved)
    stay = np.flatnonzero(~lost)
    if len(active) and len(stay):
        k, d = nearest(x[stay], entries[active])
        k = active[k]
        better = (d < near[stay]) | ((d == near[stay]) & (k < at[stay]))
        at[stay[better]], near[stay[better]] = k[better], d[better]
    return at, near


def entry_sums(at: np.ndarray, x: np.ndarray, n: np.ndarray, sums: np.ndarray) -> None:
    """Adds rows to the counts and sums of their entries."""
    by = np.argsort(at, kind="stable")
    cut = np.flatnonzero(np.diff(at[by], prepend=-1))
    sums[at[by][cut]] += np.add.reduceat(x[by], cut, axis=0)
    n += np.bincount(at, minlength=len(n))


def pack(x: np.ndarray) -> list[bytes]:
    """Rows of integers as bytes, in the narrowest type that holds all of them."""
    most = int(np.abs(x).max(initial=0))
    return [r.tobytes() for r in x.astype(np.int16 if most < 1 << 15 else np.int32)]


def unpack(column: pa.Array, size: int) -> np.ndarray:
    kinds = {2 * size: np.int16, 4 * size: np.int32}
    return np.stack([np.frombuffer(v.as_buffer(), kinds[len(v.as_buffer())]).astype(np.int64) for v in column])


def round_pass(books: np.ndarray, moved: np.ndarray | None, scale: int, last: bool):
    """One assignment of all parts; ``books`` is (parts, entries, width), without ``moved`` rows hold raw vectors."""
    parts, entries, width = books.shape
    limit = component_limit(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            if moved is None:
                x = to_integers(np.asarray(b.column("embedding").flatten()).reshape(b.num_rows, -1), scale, limit)
                packed = pa.array(pack(x), pa.binary())
            else:
                x, packed = unpack(b.column("vector"), parts * width), b.column("vector")
                was = np.stack([np.frombuffer(v.as_buffer(), np.uint8) for v in b.column("code")]).astype(np.int64)
                held = np.stack([np.frombuffer(v.as_buffer(), np.int64) for v in b.column("near")])
            at, near = np.zeros((b.num_rows, parts), np.int64), np.zeros((b.num_rows, parts), np.int64)
            for p in range(parts):
                part = x[:, p * width:(p + 1) * width]
                at[:, p], near[:, p] = nearest(part, books[p]) if moved is None else reassign(part, books[p], moved[p], was[:, p], held[:, p])
                if not last:
                    entry_sums(at[:, p], part, n[p], sums[p])
            codes = pa.array([r.tobytes() for r in at.astype(np.uint8)], pa.binary())
            if last:
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), codes, pa.array(near.sum(axis=1))], ["vec_id", "label", "code", "error"])
                continue
            none = [pa.nulls(b.num_rows, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), packed, codes, pa.array([r.tobytes() for r in near], pa.binary()), *none], ["vec_id", "label", "vector", "code", "near", "part", "entry", "n", "sums"])
        p, k = np.nonzero(n)
        if len(p):
            label = pa.nulls(len(p), b.schema.field("label").type)
            none = [pa.nulls(len(p), pa.binary())] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(p), pa.int64()), label, *none, pa.array(p, pa.int32()), pa.array(k, pa.int32()), pa.array(n[p, k]), pa.array(list(sums[p, k]), pa.list_(pa.int64()))],
                ["vec_id", "label", "vector", "code", "near", "part", "entry", "n", "sums"])
    return run


def updated(books: np.ndarray, state: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The next codebooks and which of their entries differ from the last ones; entries without a part stay."""
    width = books.shape[2]
    sums = state.where("part is not null").groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)])
    new = books.copy()
    for r in sums.collect():
        new[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return new, (new != books).any(axis=2)


def lloyd_codes(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str | None = None, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` of every kept row, and the codebooks as (parts, entries, width).

    ``code`` has one byte a part, ``error`` is the squared distance to the vector that the code stands for.
    """
    e = F.col("embedding")
    good = e.isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label_of = F.col(label) if label else F.lit(None).cast("int")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), label_of.alias("label"), F.col(embedding).alias("embedding")).where(good)
    kind = rows.schema["label"].dataType
    result = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", kind), T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])
    cut = rows.where((F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    dim = cut.agg(F.min_by(F.size("embedding"), F.struct("vec_id", "embedding"))).first()[0]
    if dim is None:
        return rows.sparkSession.createDataFrame([], result), np.zeros((parts, 0, 0), np.int64)
    rows = rows.where(F.size("embedding") == dim)
    width = dim // parts
    # the first entries: a top-k of bounded size
    first = rows.where("vec_id is not null").orderBy("vec_id", "embedding").limit(entries).select("embedding").collect()
    if not first:
        first = rows.orderBy("embedding").limit(entries).select("embedding").collect()
    start = to_integers(np.array([r[0] for r in first], np.float64), scale, component_limit(width))
    books = np.ascontiguousarray(start.reshape(len(start), parts, width).transpose(1, 0, 2))

    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", kind), *[T.StructField(c, T.BinaryType()) for c in ("vector", "code", "near")],
                           T.StructField("part", T.IntegerType()), T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(T.LongType()))])
    state, moved = rows, None
    for _ in range(rounds):
        state = cut_lineage(state.mapInArrow(round_pass(books, moved, scale, False), schema))
        books, moved = updated(books, state)
        state = state.where("part is null")
    return state.mapInArrow(round_pass(books, moved, scale, True), result), books


def book_digest(books: np.ndarray) -> str:
    """Hash of all entries' components in order of part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def code_report(vectors: DataFrame) -> DataFrame:
    coded, books = lloyd_codes(vectors, label="label")
    coded = cut_lineage(coded)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    out = join_null_safe(coded, small_side(by_label), ["label"], "inner")
    return out.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(book_digest(books)).alias("codebooks_sha256"))


def oracle() -> str:
    """The same rounds without any shortcut; a part's nearest entry is the minimum of ``distance * 256 + index``."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, p, list_slice(v, CAST(p * len(v) / {PARTS} + 1 AS BIGINT), CAST((p + 1) * len(v) / {PARTS} AS BIGINT)) AS x FROM kept, range({PARTS}) AS r(p)),
b0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS c FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES}))"""]
    for i in range(ROUNDS + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT s.vec_id, s.p, min(CAST(list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS BIGINT) * {ENTRIES} + k) AS m
  FROM parts s JOIN b{i} b ON s.p = b.p GROUP BY ALL)""")
        if i < ROUNDS:
            steps.append(f"""m{i} AS MATERIALIZED (
  SELECT p, k, list(CAST(floor(total / n) AS DOUBLE) ORDER BY pos) AS c FROM (
    SELECT p, k, pos, sum(x[pos]) AS total, count(*) AS n FROM (
      SELECT s.p, m % {ENTRIES} AS k, x, unnest(range(1, len(x) + 1)) AS pos FROM a{i} a JOIN parts s ON s.vec_id = a.vec_id AND s.p = a.p) GROUP BY ALL)
  GROUP BY ALL),
b{i + 1} AS MATERIALIZED (SELECT b.p, b.k, coalesce(m.c, b.c) AS c FROM b{i} b LEFT JOIN m{i} m ON b.p = m.p AND b.k = m.k)""")
    last = ROUNDS
    steps.append(f"""books AS (
  SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY p, k, pos)) AS h FROM (
    SELECT p, k, unnest(c) AS y, unnest(range(1, len(c) + 1)) AS pos FROM b{last})),
coded AS (
  SELECT vec_id, string_agg(printf('%02x', m % {ENTRIES}), '' ORDER BY p) AS code, CAST(sum(m // {ENTRIES}) AS BIGINT) AS error FROM a{last} GROUP BY ALL)
SELECT c.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded c JOIN kept k ON c.vec_id = k.vec_id, books""")
    return ",\n".join(steps)


@query("op11_active_lloyd", oracle())
def op11_active_lloyd(spark, folder):
    return code_report(table(spark, folder, "embeddings"))
