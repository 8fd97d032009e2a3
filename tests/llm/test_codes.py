import hashlib
import math
from collections import Counter

import numpy as np
import pytest

from martlib.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, entries=256, rounds=4, scale=1024, parts=4):
    """Full rescans in Python integers: ``(rows, codebooks)``."""
    good = [(i, v, lab) for i, v, lab in rows if v is not None and None not in v and all(map(math.isfinite, v))]
    good.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    w = len(good[0][1]) // parts
    cut = [[[math.floor(scale * float(x)) for x in v[p * w:(p + 1) * w]] for p in range(parts)] for _, v, _ in good]
    first = [c for (i, _, _), c in zip(good, cut, strict=True) if i is not None][:entries]
    books = [[list(c[p]) for c in first] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(c[p], e, strict=True)), k) for k, e in enumerate(books[p])) for p in range(parts)] for c in cut]

    for _ in range(rounds):
        got = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                held = [c[p] for c, g in zip(cut, got, strict=True) if g[p][1] == k]
                if held:
                    books[p][k] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    got = assign()
    error = Counter()
    for (_, _, lab), g in zip(good, got, strict=True):
        error[lab] += sum(d for d, _ in g)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, "".join(f"{k:02x}" for _, k in g), sum(d for d, _ in g), error[lab], sha) for (i, _, lab), g in zip(good, got, strict=True)), key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, v, lab) for i, v, lab in rows], SCHEMA)
    return sorted((tuple(r) for r in codes.code_report(df.repartition(3)).collect()), key=str)


@pytest.mark.parametrize("seed,n,spread", [(1, 700, 1.0), (2, 400, 0.004), (3, 60, 1.0)])
def test_equals_full_rescans(spark, seed, n, spread):
    # a spread of a few units makes many ties and equal entries
    rng = np.random.default_rng(seed)
    rows = [(int(i) * 3 - 50, [float(np.float32(x)) for x in rng.normal(size=8) * spread], int(rng.integers(3)) if rng.random() < 0.8 else None) for i in rng.permutation(n)]
    rows += [(rows[0][0], rows[0][1], 1)] * 5
    assert run(spark, rows) == plain(rows)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    got = sorted((tuple(r) for r in codes.op11_active_lloyd(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == plain(rows)


def test_fixed_entries_are_skipped_and_ties_go_to_the_lower_index():
    rng = np.random.default_rng(5)
    for _ in range(50):
        x, old = rng.integers(-3, 4, (200, 2)), rng.integers(-3, 4, (12, 2))
        at, near = codes.nearest(x, old)
        moved = rng.random(12) < 0.4
        new = np.where(moved[:, None], rng.integers(-3, 4, (12, 2)), old)
        got = codes.reassign(x, new, moved, at, near)
        want = codes.nearest(x, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
        seen = []
        real = codes.nearest
        try:
            codes.nearest = lambda a, b: seen.append((len(a), len(b))) or real(a, b)
            codes.reassign(x, new, moved, at, near)
        finally:
            codes.nearest = real
        # whole codebook only for rows whose entry moved, active entries for the others
        lost = int(moved[at].sum())
        assert sorted(seen) == sorted([(lost, 12)] * (lost > 0) + [(200 - lost, int(moved.sum()))] * bool(moved.any() and lost < 200))


def test_large_components_are_exact():
    rng = np.random.default_rng(6)
    x, e = rng.integers(-1 << 28, 1 << 28, (40, 4)), rng.integers(-1 << 28, 1 << 28, (7, 4))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, s, strict=True)) for s in e] for r in x]
    assert codes.distances(x, e).tolist() == want
    assert codes.to_integers(np.array([1e300, -1e300, -0.0001]), 1024, codes.component_limit(4)).tolist() == [codes.component_limit(4), -codes.component_limit(4), -1]


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.1, 0.2, 0.3, 0.4]
    rows = [(1, None, 1), (2, [nan, 1.0, 1.0, 1.0], 1), (3, [inf, 1.0, 1.0, 1.0], 1), (4, [None, 1.0, 1.0, 1.0], 1), (5, v, None), (5, v, None), (None, [0.5, 0.5, 0.5, 0.5], 2), (6, [0.0, 0.0, 0.0, 0.0], 2)]
    assert run(spark, rows) == plain(rows)
    # other lengths: those that cannot be cut, and those unlike the smallest id's
    more = [*rows, (7, [], 1), (8, [1.0, 2.0], 1), (0, [1.0, 2.0, 3.0], 1), (9, [1.0] * 8, 1)]
    assert run(spark, more) == plain(rows)
    assert run(spark, []) == [] and run(spark, rows[:4]) == []
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 part", "2 code", "3 near", "4 n", "5 error", "6 vector")
    assert sorted((tuple(r) for r in codes.code_report(df).collect()), key=str) == plain(rows)
    big = spark.createDataFrame([(1, [1e38] * 4, 1), (2, [-1e38] * 4, 1), (3, [0.0] * 4, 1)], SCHEMA)
    assert [r["error"] for r in codes.code_report(big).collect()] == [0, 0, 0]
    only = spark.createDataFrame([(None, v, 1), (None, [0.0] * 4, 1)], SCHEMA)
    assert [r["error"] for r in codes.code_report(only).collect()] == [0, 0]
