import random

import pytest
from brute import WORD, targets
from pyspark.sql import functions as F

from martlib.llm import mixing

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, source string"


def check(rows, data):
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows) == sorted((d[0] is None, d[0] or 0) for d in data)
    sizes: dict = {}
    for _, text, source in data:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = targets(sizes)
    of = {}
    for i, text, source in data:
        of.setdefault(i, (len(WORD.findall(text or "")), source))
    taken: dict = {}
    for r in rows:
        size, source = of[r["doc_id"]]
        assert r["size"] == size and r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source])
        assert r["taken"] <= 3 * size and r["taken"] == r["size"] * r["copies"] and len(r["positions"]) == r["copies"]
        assert all(0 <= p <= 1 for p in r["positions"])
        taken[source] = taken.get(source, 0) + r["taken"]
    return taken, want


def test_given_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    rows = mixing.plan(df).collect()
    taken, want = check(rows, [tuple(r) for r in df.collect()])
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] for s in want)
    again = mixing.plan(df.repartition(5)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_targets_equal_repeated_sharing(spark):
    rng = random.Random(1)
    for _ in range(3):
        data = [(i, " ".join(["w"] * rng.randint(0, 50)), rng.choice(["a", "B", "é", "z", "😀", None, ""])) for i in range(rng.randint(1, 40))]
        check(mixing.plan(spark.createDataFrame(data, SCHEMA)).collect(), data)


def test_edge_cases(spark):
    data = [(1, None, "a"), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "q", None), (4, "w " * 50_000, "b"), (5, "   ", "c")]
    check(mixing.plan(spark.createDataFrame(data, SCHEMA)).collect(), data)
    assert mixing.plan(spark.createDataFrame([], SCHEMA)).count() == 0
    none = mixing.plan(spark.createDataFrame([(1, None, "a"), (2, " ", None)], SCHEMA)).collect()
    assert {(r["taken"], r["target"]) for r in none} == {(0, 0.0)}


def test_mixed_rows_are_the_taken_copies_in_order(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("copies", F.lit("own")).withColumn("h", F.col("doc_id"))
    got = mixing.mixed(df)
    assert got.columns == df.columns
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts == {r["doc_id"]: r["copies"] for r in mixing.plan(df).collect() if r["copies"]}
    twice = df.where("doc_id < 9").unionByName(df.where("doc_id < 9"))
    assert mixing.mixed(twice).count() == sum(r["copies"] for r in mixing.plan(twice).collect())


def test_positions_follow_the_schedule(spark):
    n = 4000
    df = spark.range(n).select("id", (F.col("id") / n).alias("share"))
    for corners in mixing.SCHEDULES:
        times = [r[0] for r in df.select(mixing.position(F.col("share"), corners)).collect()]
        assert times == sorted(times)
        area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(corners[:-1], corners[1:], strict=True))
        half = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(corners[:-1], corners[1:], strict=True) if b[0] <= 0.5) / area if len(corners) > 2 else 0.5
        assert sum(t < 0.5 for t in times) / n == pytest.approx(half, abs=0.002)
