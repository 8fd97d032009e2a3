import random

import numpy as np
import pytest
from brute import near_components, reach, shingle_set

from martlib.llm import ngram_join
from martlib.llm.components import components

SF = "/root/testdata/sf0.001"


def run(spark, data, **kw):
    df = ngram_join.near_components(spark.createDataFrame(data, "doc_id long, text string"), **kw)
    return [tuple(r) for r in df.collect()]


def near_corpus(seed=1, groups=30, copies=12, size=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for g in range(groups):
        base = [word() for _ in range(rng.randint(5, size))]
        for _ in range(rng.randint(1, copies)):
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = word()
            text = " ".join(w)
            rows.append((len(rows), text.upper() if rng.random() < 0.2 else text + (" " + passage if rng.random() < 0.3 else "")))
    rng.shuffle(rows)
    return rows


def test_equals_all_pairs(spark):
    rows = near_corpus()
    assert {r[0]: r[1:] for r in run(spark, rows)} == near_components(rows)


def test_equals_all_pairs_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r[0]: r[1:] for r in run(spark, rows)}
    assert got == near_components(rows)
    assert any(i != c for i, (_, c) in got.items())


@pytest.mark.parametrize("tile", [200, 2000])
def test_blocks_hubs_and_chained_cells_give_the_same(spark, monkeypatch, tile):
    rows = near_corpus(seed=2, groups=6, copies=60)
    whole = near_components(rows)
    monkeypatch.setattr(ngram_join, "TILE_SHINGLES", tile)
    monkeypatch.setattr(ngram_join, "HUBS", 2)
    assert {r[0]: r[1:] for r in run(spark, rows)} == whole
    # the order of shingles and the form of large cells cannot change links
    members = [np.unique(np.random.default_rng(i % 7).integers(0, 1 << 60, 40 + i % 3, dtype=np.uint64)) for i in range(40)]
    keys = []
    for i, s in enumerate(members):
        k = len(s) - ngram_join.least_overlap(len(s), 85) + 1
        r = np.zeros(k, ngram_join.KEY)
        r["key"], r["node"], r["n"], r["pos"] = s[:k], i, len(s), np.arange(k)
        keys.append(r)
    fine = ngram_join.bucket_links(np.concatenate(keys), 85)
    monkeypatch.setattr(ngram_join, "CELL", 2)
    coarse = ngram_join.bucket_links(np.concatenate(keys), 85)
    fine, coarse = (reach(range(40), zip(*(x.tolist() for x in y), strict=True)) for y in (fine, coarse))
    assert all(coarse[i] == coarse[j] for i, j in fine.items())


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  b"), (6, "a b c"), (7, long), (8, long + " x"), (7, long), (None, "a b"), (9, " "), (10, "b a")]
    got = run(spark, rows)
    assert len(got) == len(rows)
    by = {r[0]: r[1:] for r in got}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3)
    assert by[4] == (1, 4) and by[5] == (1, 4) and by[6] == (1, 6) and by[10] == (1, 10)
    assert by[7] == (29_997, 7) and by[8] == (29_998, 7)
    assert by[None] == (1, None) and by[9] == (1, 9)
    assert run(spark, []) == []


def test_the_boundary_is_exact(spark):
    # 85 of 100 united shingles link, 84 do not
    a = [f"a{i}" for i in range(95)]
    rows = [(1, " ".join(a)), (2, " ".join([*a[:88], *[f"b{i}" for i in range(8)]])), (3, " ".join([*a[:87], *[f"c{i}" for i in range(9)]]))]
    sets = {i: shingle_set(t) for i, t in rows}
    assert {r[0]: r[2] for r in run(spark, rows)} == {k: v[1] for k, v in near_components(rows).items()}
    assert len(sets[1] & sets[2]) == 85


def test_keep_first_leaves_other_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e", "x", 1), (2, "a b c d e", "y", 2), (3, None, None, 3), (None, "a b c d e", "z", 4)], "doc_id long, text string, node string, n int")
    got = ngram_join.keep_first(df)
    assert got.columns == df.columns
    assert sorted(got.collect(), key=str) == sorted([r for r in df.collect() if r["n"] != 2], key=str)


def test_components(spark):
    rng = random.Random(0)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = reach({x for e in real for x in e}, real)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_first_of_repeated_rows_and_ids(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    near = a + " more"
    rows = [
        (1, a, "x"), (1, a, "x"), (1, a, "y"),  # a repeated row
        (2, near, "x"), (2, b, "x"),  # an id with a copy and a clean text
        (None, a, "x"), (None, a, "x"),  # without an id
        (6, c, "x"), (5, c + " more", "z"), (5, c + " more", "z"),
        (7, "", "x"), (7, "", "x"), (8, None, "x"), (8, None, "x"), (None, None, "x"),  # without words
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, _near_row string")
    got = ngram_join.keep_first(df)
    assert got.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    want = [(1, a), (2, b), (None, a), (None, a), (5, c + " more"), (7, ""), (7, ""), (8, None), (8, None), (None, None)]
    assert sorted(map(str, kept)) == sorted(map(str, want))
