import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlib.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=100, top=5, scale=256):
    """All scores of all anchors."""
    good = [(i, [math.floor(scale * float(x)) for x in v], lab) for i, v, lab in rows if i is not None and lab is not None and v and None not in v and all(map(math.isfinite, v))]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))

    def first(hits):
        """The best score of every id, in order."""
        best = {}
        for s, i in hits:
            best[i] = max(s, best.get(i, s))
        return sorted(best.items(), key=lambda r: (-r[1], r[0]))[:top]

    anchors, out = {}, set()
    for a, v, lab in sorted(good, key=lambda r: (r[2], r[1])):
        if a % every == 0:
            anchors.setdefault(a, (v, lab))
    for a, (v, lab) in anchors.items():
        found = [(score(v, w), i, x) for i, w, x in good if i != a and len(w) == len(v)]
        for i, p in first((s, i) for s, i, x in found if x == lab):
            hits = first((s, j) for s, j, x in found if x != lab and 80 * p <= 100 * s <= 100 * p)
            out |= {(a, i, k + 1, j, p, s) for k, (j, s) in enumerate(hits)}
    return out


def run(spark, rows, every=100, schema=SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = [tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % every == 0).collect()]
    assert len(got) == len(set(got))
    return set(got)


def corpus(seed, n, dim=12, unit=False):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = base[rng.integers(6)] + rng.normal(size=dim) * rng.choice([0.05, 0.5])
        v = v / np.linalg.norm(v) if unit else np.round(v * 4) / 4
        rows.append((i * 5, [float(np.float32(x)) for x in v], int(rng.integers(4))))
    return rows


@pytest.mark.parametrize("seed,unit", [(1, False), (2, True)])
def test_equals_all_scores(spark, monkeypatch, seed, unit):
    # rounded components give many equal scores
    rows = corpus(seed, 900, unit=unit)
    want = plain(rows)
    assert len(want) > 500
    assert run(spark, rows) == want
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 1000)
    assert run(spark, rows) == want


def test_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = negatives.op13_bond_negatives(spark, folder)
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == ["anchor_id bigint", "positive_id bigint", "rank int", "negative_id bigint", "positive_score bigint", "negative_score bigint"]
    assert {tuple(r) for r in got.collect()} == plain(rows)


def test_blocks_carry_their_bounds_and_scans_shrink_the_bitmap():
    rng = np.random.default_rng(4)
    x = rng.integers(-60, 60, (500, 32))
    x[:20] *= 5
    block = negatives.Block(np.arange(500), np.zeros(500, np.int64), np.ascontiguousarray(x.T), x.min(axis=0), x.max(axis=0))
    anchor = x[3] + rng.integers(-3, 4, 32)
    scores = x @ anchor
    scan = negatives.Scan(block, anchor, np.ones(500, bool))
    assert (np.diff(np.abs(anchor)[scan.order]) <= 0).all()
    for part, low, high in scan:
        assert (part + low <= scores).all() and (scores <= part + high).all()
    bitmap = np.ones(500, bool)
    ids, got = negatives.scan_top(block, anchor, bitmap, 5, negatives.NONE, True)
    assert sorted(got.tolist(), reverse=True) == sorted(scores.tolist(), reverse=True)[:5] and bitmap.sum() < 20
    assert (scores[ids] == got).all()
    most = np.array([int(np.sort(scores)[-30]), int(np.sort(scores)[-100])])
    bitmap = np.ones(500, bool)
    for (ids, got), hi in zip(negatives.scan_windows(block, anchor, bitmap, -(-80 * most // 100), most, np.full(2, negatives.NONE), 5, True), most.tolist(), strict=True):
        assert got.tolist() == sorted([s for s in scores.tolist() if 80 * hi <= 100 * s <= 100 * hi], reverse=True)[:5]
        assert (scores[ids] == got).all()
    assert bitmap.sum() < 100


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    v, near, far = [1.0, 0.5], [1.0, 0.25], [-1.0, 0.0]
    rows = [
        (0, v, 1), (0, v, 1), (0, near, 2),  # an anchor id that repeats: the first by label
        (1, v, 1), (1, v, 1), (2, near, 1), (3, near, 2), (3, near, 2), (3, [1.0, 0.375], 2), (4, near, 3), (5, far, 1), (6, far, 2),
        (7, None, 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 2), (10, [None, 1.0], 2), (11, v, None), (None, v, 2), (12, [], 1), (13, [1.0, 0.5, 0.0], 1), (100, [1.0, 0.5, 0.5], 1), (14, [1.0, 0.5, 0.25], 5),
        (200, far, 9), (300, [0.0, 0.0], 1),
    ]
    assert run(spark, rows) == plain(rows)
    assert run(spark, rows[12:19]) == set() and run(spark, []) == set()
    named = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 dim", "2 score", "true anchor", "4 ids", "5 window", "6 id")
    assert {tuple(r) for r in negatives.hard_negatives(named, F.col("vec_id") % 100 == 0).collect()} == run(spark, rows)
    text = spark.createDataFrame([(i, e, None if x is None else f"label {x}") for i, e, x in rows if (i, x) != (0, 2)], "vec_id long, embedding array<float>, label string")
    assert {tuple(r) for r in negatives.hard_negatives(text, F.col("vec_id") % 100 == 0).collect()} == run(spark, [r for r in rows if (r[0], r[2]) != (0, 2)])
    big = [(0, [1e30, 1.0], 1), (1, [1e30, 1.0], 1), (2, [1e30, 0.0], 2)]
    assert {r[:4] for r in run(spark, big)} == {(0, 1, 1, 2)}


def test_a_hot_vector(spark):
    rows = corpus(7, 300) + [(10_000 + i, [1.0] * 12, 1) for i in range(400)] + [(20_001 + 2 * i, [1.0] * 12, 2) for i in range(400)]
    assert run(spark, rows) == plain(rows)
