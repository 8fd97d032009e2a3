import heapq
from collections import Counter, defaultdict
from zlib import crc32

import pytest

from martlib.llm import sharding

SCHEMA = "doc_id long, text string"


def loads_of(sizes, shards):
    """The plain schedule, with one heap."""
    heap = [(0, i) for i in range(shards)]
    for s in sorted(sizes, reverse=True):
        load, i = heapq.heappop(heap)
        heapq.heappush(heap, (load + s, i))
    return sorted(load for load, _ in heap)


def checked(rows, got, shards):
    """Groups whole, sizes and checksums right, slots without gaps; returns the shards' loads."""
    assert len(got) == len(rows)
    where, slots, loads = defaultdict(set), defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append((r["slot"], r["doc_id"]))
        loads[r["shard"]] += r["size"]
    assert set(slots) <= set(range(shards))
    for s in slots.values():
        s.sort()
        assert [x for x, _ in s] == list(range(len(s)))
        ids = [i for _, i in s]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    body = {(i, crc32((t or "").encode())): (t or "") for i, t in rows}
    for r in got:
        t = body[r["doc_id"], r["text_crc32"]]
        assert r["size"] == len(t.encode()) + 8
        where[t].add(r["shard"])
    assert all(len(s) == 1 for s in where.values())
    return sorted([loads[i] for i in range(shards)])


def groups_of(rows):
    sizes = Counter()
    for _, t in rows:
        sizes[t or ""] += len((t or "").encode()) + 8
    return sizes.values()


def test_given_table_has_the_loads_of_one_heap(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got = sharding.shard_documents(df).collect()
    assert checked(rows, got, 24) == loads_of(groups_of(rows), 24)


@pytest.mark.parametrize("bundles", [1, 200, 1 << 15])
def test_near_equal_with_fewer_bundles_than_groups(spark, monkeypatch, bundles):
    monkeypatch.setattr(sharding, "BUNDLES", bundles)
    rows = [(i, "x" * (i * 7919 % 997) + str(i)) for i in range(6_000)]
    loads = checked(rows, sharding.shard_documents(spark.createDataFrame(rows, SCHEMA), 6).collect(), 6)
    assert loads[-1] - loads[0] <= 0.001 * loads[-1]


def test_hot_group_stays_together(spark):
    rows = [(i, "the same text") for i in range(1000)] + [(i, f"text {i}") for i in range(1000, 3000)]
    got = sharding.shard_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    loads = checked(rows, got, 24)
    assert loads[-1] == 1000 * 21 and loads[-2] - loads[0] <= 17  # one text


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "a"), (None, "a"), (3, "é😀"), (4, "x" * 200_000), (5, "b"), (5, "c"), (5, "c")]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.selectExpr("*", "1 shard", "2 slot", "3 `group`", "4 rows", "5 size", "6 bundle")
    got = sharding.shard_documents(extra, 3).collect()
    assert max(checked(rows, got, 3)) == 200_008
    assert {r["text_crc32"] for r in got if r["doc_id"] in (1, 2)} == {0}
    assert sharding.shard_documents(df.limit(0)).count() == 0
    wide = sharding.assign(extra.selectExpr("*", "hash(text) _shard_group", "0 _shard_row"), "text", "size", 2)
    assert wide.columns == ["doc_id", "text", "group", "rows", "size", "bundle", "_shard_group", "_shard_row", "shard", "slot"] and wide.count() == 9
    again = sharding.shard_documents(extra, 3).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_query_and_files(spark, tmp_path):
    got = sharding.op12_sharding(spark, "/root/testdata/sf0.001")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in got.schema] == ["doc_id bigint", "size bigint", "text_crc32 bigint", "law string", "shard int", "slot bigint", "grown_shard int"]
    assert {(r["law"], r["grown_shard"]) for r in got.collect()} == {("bytes", None)}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    sharding.write_shards(docs, f"{tmp_path}/out", 5)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 5
    assert back.groupBy("text").agg({"shard": "approx_count_distinct"}).where("`approx_count_distinct(shard)` > 1").count() == 0
