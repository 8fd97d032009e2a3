import numpy as np
import pytest
from brute import reach

from martlib.llm import pivots

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, least=0.9):
    """Links of every row: ``vec_id -> (n_links, component)``, for distinct ids."""
    good = {i: np.array(v, np.float64) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)}
    ids = sorted(good)
    x = np.stack([good[i] / np.linalg.norm(good[i]) for i in ids])
    hit = x @ x.T >= least
    np.fill_diagonal(hit, False)
    comp = reach(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(hit), strict=True)])
    return {i: (int(hit[k].sum()), comp[i]) for k, i in enumerate(ids)} | {i: (0, i) for i, _ in rows if i not in good}


def run(spark, rows, schema=SCHEMA, **kw):
    return pivots.vector_links(spark.createDataFrame(rows, schema), **kw).collect()


@pytest.mark.parametrize("block", [pivots.LIST_ROWS, 5])
def test_groups_of_near_copies(spark, monkeypatch, block):
    rng = np.random.default_rng(3)
    rows = []
    for size in [1] * 150 + [2] * 20 + [5] * 10 + [60, 90]:
        base = rng.normal(size=32)
        for _ in range(size):
            rows.append((len(rows), [float(np.float32(v)) for v in (base if rng.random() < 0.3 else base + rng.normal(size=32) * 0.1) * rng.uniform(0.1, 9)]))
    monkeypatch.setattr(pivots, "LIST_ROWS", block)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in run(spark, rows)}
    assert got == plain(rows)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    want = plain([tuple(r) for r in df.select("vec_id", "embedding").collect()])
    got = {r["vec_id"]: r for r in pivots.vector_links(df.withColumn("rep", df["label"]).withColumn("near", df["label"])).collect()}
    links = sum(w[0] for w in want.values())
    assert sum(r["n_links"] for r in got.values()) >= 0.9 * links
    assert all(r["n_links"] <= want[i][0] for i, r in got.items())
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    x = pivots.unit(rng.normal(size=(4000, 64)))
    e = rng.normal(size=x.shape)
    e = pivots.unit(e - (e * x).sum(1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * e
    p = x[rng.choice(4000, 1024, replace=False)]
    a, b = (pivots.describe(z, p, pivots.PREFIX) for z in (x, y))
    assert ((a[:, :, None] == b[:, None, :]).any(2).sum(1) >= pivots.SHARED).mean() >= 0.98


def test_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, None), (2, [0.0, 0.0, 0.0]), (3, [1.0, None, 2.0]), (4, [float("nan"), 1.0, 1.0]), (5, [float("inf"), 1.0, 1.0]), (6, v), (7, v), (8, [2.0, 4.0, 6.0]), (9, [1.0, 2.0]), (10, [2.0, 4.0]), (None, v), (11, []), (12, [1e-30, 2e-30, 3e-30])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in run(spark, rows)}
    assert len(got) == len(rows)
    assert all(got[i] == (0, i, True) for i in (1, 2, 3, 4, 5, 11))
    assert all(got[i][:2] == (3, 6) for i in (6, 7, 8, 12)) and got[6][2] and not got[7][2]
    assert got[9][:2] == (1, 9) and got[10][:2] == (1, 9)
    assert got[None] == (0, None, False)
    twice = run(spark, [(1, v), (1, v), (2, [-1.0, 0.0, 0.0])])
    assert sorted((r["vec_id"], r["n_links"]) for r in twice) == [(1, 1), (1, 1), (2, 0)]
    assert run(spark, []) == []
    big = run(spark, [(1, [1e300, 1e300]), (2, [1e-300, 1e-300])], "vec_id long, embedding array<double>")
    assert [r["n_links"] for r in big] == [1, 1]
