"""N-gram Jaccard join: which documents share at least 85 % of their word shingles.

1. **Sets.** A pass over the texts makes of every document's shingle set a digest
   and a hashed bitmap of two to four bits a shingle. Documents with equal sets
   become one node, so copies never meet again. The same pass notes four bytes
   for each shingle that can become a key, which are counted by hash bucket.
2. **Keys.** With shingles in one global order, two sets that link must share
   one of their first ``n - ceil(0.85 n) + 1`` shingles. A second pass sends
   these to buckets by hash. The order puts shingles counted ``FREQUENT`` times
   or more last, so that a passage in some documents makes no keys and does not
   chain them into one cluster; any order gives the same links.
   Nodes that meet under a key, have sizes within the bound and positions that
   still allow the overlap, are joined into clusters of possible partners.
3. **Size-banded tiles of bitmaps.** A cluster is laid out in bands of set size; a
   tile holds a band and the next one, since a link cannot reach further. Bit
   counts of two bitmaps bound the overlap from above, which splits the clusters
   into those of pairs that pass.
4. **Exact tiles.** The sets of these are made again from the texts and laid out
   the same way. Pairs that pass the bit counts are decided by intersection of
   the sorted arrays.

Only what is connected matters, so pairs already connected are skipped. A large
tile is cut into blocks that share a few hubs; what the hubs leave apart is
compared with every block in a second round, a bounded block of them with one
block at a time.

Shingles are 64-bit hashes of words. Cases: a document without words (null,
empty or blank text) has an empty set and is linked with nothing; one with
fewer words than a shingle has its whole sequence as only member. Rows that
repeat an id count as separate rows, each with the component of its own text;
rows with a null id are linked with nothing and have a null component. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlib.llm.components import components
from martlib.llm.registry import free_name, query, table
from martlib.llm.texts import MASK, MIX_A, WEIGHTS, column_bytes, mix, shingles, slices, window_sums, words
from martlib.session import arrow_batches, cut_lineage, small_side

FREQUENT = 8  # a shingle counted so often goes to the end of the order
FREQUENT_LIST = 1 << 22  # shingles moved to the end, at most (32 MB), the most frequent ones; others keep their place and only cost more
TILE_SHINGLES = 1 << 21  # set members in one block of a tile of sets: 16 MB
BITS_TILE = 16  # a block of a tile of bitmaps has so many times the members
TILE_ROWS = 1 << 13  # nodes in one block of a tile
HUBS = 16  # sets of a tile that every block of it holds
KEY = np.dtype([("key", "<u8"), ("node", "<u8"), ("n", "<u4"), ("pos", "<u4")])
PIECE = 1 << 22  # bytes of text from which the passes over the texts make one piece of output; a longer text is a piece of its own
HELD = 1 << 18  # shingles that such a pass holds before it sends them on, beside those of one document
BATCH = 1 << 22  # bytes of an Arrow batch that Spark hands to a pass, about
SEEN = 1 << 16  # nodes a pass over the texts remembers, so that copies near each other send nothing again
SPREAD = 4  # buckets of shingles in each shuffle partition, so that one is a small part of a task's rows
CELL = 512  # nodes under one key that are compared one by one; more are chained by size, which keeps every partner


def document_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted shingle set of each document."""
    w = words(data, offsets, lower=True)
    if len(w.hashes) >= width:
        every = mix(window_sums(w.hashes, width))
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        out.append(np.unique(every[a:b - width + 1]) if b - a >= width else shingles(w.hashes[a:b], width))
    return out


def digest(members: np.ndarray) -> int:
    """Names a set; equal sets have equal names."""
    total = int(np.add.reduce(mix(members ^ WEIGHTS[7]))) + len(members) * int(MIX_A)
    return int(mix(np.array([total & MASK], np.uint64)).view(np.int64)[0])


def batch_sets(texts: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and set of every text, a slice of the batch at a time."""
    data, offsets = column_bytes(texts)
    for lo, hi in slices(offsets):
        yield from enumerate(document_sets(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], width), lo)


def pieces(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``PIECE`` bytes of text, so that memory does not follow the batch."""
    _, offsets = column_bytes(batch.column(text))
    for lo, hi in slices(offsets, PIECE):
        yield batch.slice(lo, hi - lo)


def shingle_names(members: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit name of each shingle. Shingles that share both count as one, which moves their place in the order only."""
    m = mix(members ^ WEIGHTS[6])
    return m % np.uint64(buckets), (m >> np.uint64(32)).astype(np.uint32)


def by_bucket(to: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """The rows of each bucket as bytes."""
    by = np.argsort(to, kind="stable")
    rows, to = rows[by], to[by]
    edges = np.flatnonzero(np.diff(to)) + 1
    return to[np.concatenate([[0], edges])].astype(np.int32), [r.tobytes() for r in np.split(rows, edges)]


def key_reach(n: int, percent: int) -> int:
    """How far into a set of ``n`` its keys reach, by hash, where some shingles in between are frequent."""
    k = n - least_overlap(n, percent) + 1
    return min(n, max(k + k // 2, k + 64))


def _set_pass(width: int, percent: int, buckets: int) -> Callable:
    names = ["doc_id", "n", "node", "bits", "bucket", "counted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(pending):
            to, rows = by_bucket(*shingle_names(np.concatenate(pending), buckets))
            k = len(rows)
            return pa.RecordBatch.from_arrays([*[pa.nulls(k, pa.int64())] * 3, pa.nulls(k, pa.binary()), pa.array(to), pa.array(rows, pa.binary())], names)

        first: set[int] = set()
        for b in (b for whole in batches for b in pieces(whole, 1)):
            sizes, nodes, held = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64), 0
            maps: list[bytes | None] = [None] * b.num_rows
            pending: list[np.ndarray] = []
            for i, s in batch_sets(b.column(1), width):
                sizes[i], nodes[i] = len(s), digest(s) if len(s) else 0
                if len(s) and int(nodes[i]) not in first:
                    if len(first) >= SEEN:
                        first.clear()
                    first.add(int(nodes[i]))
                    maps[i] = bitmap(s).tobytes()
                    pending.append(s[:key_reach(len(s), percent)])
                    held += len(pending[-1])
                    if held > HELD:
                        yield counted(pending)
                        pending, held = [], 0
            if pending:
                yield counted(pending)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(nodes, mask=sizes == 0), pa.array(maps, pa.binary()), pa.nulls(b.num_rows, pa.int32()), pa.nulls(b.num_rows, pa.binary())], names)
    return run


def _count_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names that occur ``FREQUENT`` times or more, by the power of two of their count."""
    for t in runs_of(batches, ["bucket"]):
        bucket = t.column("bucket")[0].as_py()
        names, hits = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for c in t.column("counted").chunks for x in c]), return_counts=True)
        names, level = names[hits >= FREQUENT], np.log2(hits[hits >= FREQUENT]).astype(np.int32)
        found = np.unique(level)
        if len(found):
            full = [names[level == x].astype(np.uint64) | np.uint64(bucket << 32) for x in found]
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array([len(x) for x in full], pa.int64()), pa.array([x.tobytes() for x in full], pa.binary())], ["level", "n", "names"])


def frequent_names(first: DataFrame, parts: int) -> np.ndarray:
    """The sorted names of frequent shingles: at most ``FREQUENT_LIST``, those of the highest counts."""
    dealt = first.where("bucket is not null").select("bucket", "counted").repartition(parts, "bucket").sortWithinPartitions("bucket")
    found = cut_lineage(dealt.mapInArrow(_count_pass, "level int, n bigint, names binary"))
    least, held = 64, 0
    for level, n in sorted(((r["level"], r["n"]) for r in found.groupBy("level").agg(F.sum("n").alias("n")).collect()), reverse=True):
        held += n
        if held > FREQUENT_LIST:
            break
        least = level
    rows = found.where(F.col("level") >= least).select("names").collect()
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(bytes(r[0]), np.uint64) for r in rows]]))


def order(members: np.ndarray, frequent: np.ndarray, buckets: int) -> np.ndarray:
    """The set in the global order: by hash, frequent shingles last."""
    if not len(frequent):
        return members
    bucket, name = shingle_names(members, buckets)
    full = (bucket << np.uint64(32)) | name
    late = frequent[np.minimum(np.searchsorted(frequent, full), len(frequent) - 1)] == full
    return np.concatenate([members[~late], members[late]]) if late.any() else members


def least_overlap(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Members a set of ``n`` shares with any set it links to, at least."""
    return -(-percent * n // 100)


def _key_pass(width: int, percent: int, buckets: int, frequent: np.ndarray) -> Callable:
    def sent(parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(parts)
        to, runs = by_bucket(shingle_names(rows["key"], buckets)[0], rows)
        return pa.RecordBatch.from_arrays([pa.array(to), pa.array(runs, pa.binary())], ["bucket", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in (b for whole in batches for b in pieces(whole, 0)):
            parts, held = [], 0
            for _, s in batch_sets(b.column(0), width):
                n = len(s)
                node = digest(s) if n else 0
                if not n or node in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(node)
                k = n - least_overlap(n, percent) + 1
                rows = np.zeros(k, KEY)
                rows["key"], rows["node"], rows["n"], rows["pos"] = order(s, frequent, buckets)[:k], np.int64(node).view(np.uint64), n, np.arange(k)
                parts.append(rows)
                held += k
                if held > HELD:
                    yield sent(parts)
                    parts, held = [], 0
            if parts:
                yield sent(parts)
    return run


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest index each of ``n`` nodes is connected with."""
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    while (up := root[root]).tolist() != root.tolist():
        root = up
    return root


def bucket_links(rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all nodes of a bucket that may be partners."""
    rows = rows[np.lexsort((rows["node"], rows["n"], rows["key"]))]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows["key"][1:] != rows["key"][:-1]) | (rows["node"][1:] != rows["node"][:-1])
    rows = rows[fresh]
    _, start, size = np.unique(rows["key"], return_index=True, return_counts=True)
    end = np.repeat(start + size, size)
    large = np.repeat(size > CELL, size)
    n, pos = rows["n"].astype(np.int64), rows["pos"].astype(np.int64)
    names, at = np.unique(rows["node"], return_inverse=True)
    found: list[np.ndarray] = []
    live = np.flatnonzero(np.repeat(size > 1, size))
    d = 0
    while len(live):
        d += 1
        live = live[live + d < end[live]]
        live = live[100 * n[live] >= percent * n[live + d]]
        i, j = live, live + d
        ok = 1 + np.minimum(n[i] - pos[i] - 1, n[j] - pos[j] - 1) >= -(-percent * (n[i] + n[j]) // (100 + percent))
        ok |= large[i]
        found.append(np.unique(np.minimum(at[i[ok]], at[j[ok]]) * len(names) + np.maximum(at[i[ok]], at[j[ok]])))
        live = live[~large[live]]
    code = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    code = code[code // max(1, len(names)) != code % max(1, len(names))]
    root = forest(code // max(1, len(names)), code % max(1, len(names)), len(names))
    moved = np.flatnonzero(root != np.arange(len(names)))
    return names[moved].view(np.int64), names[root[moved]].view(np.int64)


def runs_of(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key together, from batches that are sorted by key."""
    held: list[pa.Table] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        cols = [t.column(k).to_numpy() for k in keys]
        new = np.zeros(t.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), t.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[lo] for c in cols)
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            held.append(t.slice(lo, hi - lo))
            last = key
    if held:
        yield pa.concat_tables(held)


def _bucket_pass(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs_of(batches, ["bucket"]):
            rows = np.concatenate([np.frombuffer(x.as_buffer(), KEY) for c in t.column("keys").chunks for x in c])
            a, b = bucket_links(rows, percent)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
    return run


def bitmap(members: np.ndarray) -> np.ndarray:
    """Hashed bitmap of a set, of two to four bits a member."""
    bits = 1 << max(6, (2 * len(members) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(members & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").view(np.uint64)


def fold(maps: list[np.ndarray]) -> np.ndarray:
    """Bitmaps of one size: longer ones are laid over themselves."""
    size = min(map(len, maps))
    out = np.zeros((len(maps), size), np.uint64)
    for i, m in enumerate(maps):
        out[i] = np.bitwise_or.reduce(m.reshape(-1, size), axis=0)
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Members two sorted sets share."""
    return int(np.count_nonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a))


def tile_links(n: np.ndarray, maps: list[np.ndarray], sets: list[np.ndarray] | None, label: np.ndarray, low: np.ndarray, probe: np.ndarray, home: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of a tile that pass the bit counts, or link if there are sets, and connect what was apart.

    A pair needs one end in the low band, one that is a probe and one at home.
    """
    by = np.argsort(n, kind="stable")
    n, label, low, probe, home = n[by], label[by].copy(), low[by], probe[by], home[by]
    folded = fold([maps[i] for i in by])
    lost = n - np.bitwise_count(folded).sum(axis=1, dtype=np.int64)  # members that share a bit with another
    reach = np.searchsorted(n, 100 * n // percent, "right")
    out = []
    for i in range(len(n)):
        j = np.flatnonzero(label[i + 1:reach[i]] != label[i]) + i + 1
        if len(j):
            j = j[(low[i] | low[j]) & (probe[i] | probe[j]) & (home[i] | home[j])]
        for c in range(0, len(j), 1024):
            part = j[c:c + 1024]
            part = part[label[part] != label[i]]
            bound = np.bitwise_count(folded[i] & folded[part]).sum(axis=1, dtype=np.int64) + np.minimum(lost[i], lost[part])
            for k in part[(100 + percent) * bound >= percent * (n[i] + n[part])].tolist():
                if label[k] != label[i] and (sets is None or (100 + percent) * overlap(sets[by[i]], sets[by[k]]) >= percent * (n[i] + n[k])):
                    out.append((int(by[i]), int(by[k])))
                    label[label == label[k]] = label[i]
    return out


def _tile_pass(percent: int, exact: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs_of(batches, ["cluster", "tile", "block"]):
            if t.num_rows < 2:
                continue
            _, one = np.unique(t.column("node").to_numpy(), return_index=True)  # rows of one id with different texts can repeat a node
            t = t.take(pa.array(one))
            data = [np.frombuffer(x.as_buffer(), np.uint64) for c in t.column("data").chunks for x in c]
            flag = {k: t.column(k).to_numpy() for k in ("n", "label", "low", "probe", "home", "node")}
            maps = [bitmap(s) for s in data] if exact else data
            got = tile_links(flag["n"], maps, data if exact else None, flag["label"], flag["low"], flag["probe"], flag["home"], percent)
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(flag["node"][[a for a, _ in got]]), pa.array(flag["node"][[b for _, b in got]])], ["a", "b"])
    return run


def _member_pass(width: int) -> Callable:
    """Adds the set to rows of ``(text, node, places)``; a row whose text is another than the node's goes, as does one whose node is there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            node = b.column(1).to_numpy()
            kept, sets, size = [], [], 0

            def out(kept=kept, sets=sets, b=b):
                return pa.RecordBatch.from_arrays([b.column(1).take(pa.array(kept)), b.column(2).take(pa.array(kept)), pa.array(sets, pa.binary())], ["node", "places", "data"])

            for i, s in batch_sets(b.column(0), width):
                if len(s) and node[i] not in seen and digest(s) == node[i]:
                    seen.add(int(node[i]))
                    kept.append(i)
                    sets.append(s.tobytes())
                    size += 8 * len(s)
                    if size > 32 << 20:
                        yield out()
                        kept.clear()
                        sets.clear()
                        size = 0
            if kept:
                yield out()
    return run


PLACE = "struct<cluster:bigint,tile:int,block:int,label:bigint,low:boolean,probe:boolean,home:boolean,n:bigint>"


def place(label: Column, probe: Column, home: Column, block: Column) -> Column:
    return F.struct("cluster", "tile", block.cast("int").alias("block"), label.alias("label"), "low", probe.alias("probe"), home.alias("home"), "n")


def block_count(shingles: int) -> Column:
    return F.greatest(F.ceil(F.sum("n") / shingles), F.ceil(F.count(F.lit(1)) / TILE_ROWS)).cast("int")


def lay_out(nodes: DataFrame, clusters: DataFrame, percent: int, shingles: int) -> DataFrame:
    """Nodes in the tiles of their cluster, and in the blocks of at most ``shingles`` members of their tile."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / (percent - 1)))).cast("int")
    spread = nodes.join(clusters.withColumnRenamed("component", "cluster"), "node").withColumn("band", band)
    spread = spread.select("*", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("tile")).withColumn("low", F.col("band") == F.col("tile"))
    weight = cut_lineage(spread.groupBy("cluster", "tile").agg(block_count(shingles).alias("blocks"), F.count(F.lit(1)).alias("rows"), F.count_if("low").alias("lows")).where("rows > 1 and lows > 0"))
    laid = spread.join(small_side(weight), ["cluster", "tile"]).withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int"))
    return cut_lineage(laid.select("node", "doc_id", "n", "cluster", "tile", "rows", "blocks", "own", "low"))


def connect(laid: DataFrame, shingles: int, links_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Components of the links that ``links_of`` finds in the tiles.

    In the second round of a tile with several blocks, what the first left apart
    is cut into blocks too, and each of these meets each block of the tile in a
    task of its own, which holds the two.
    """
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    hub = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("node", F.lit(2)), F.ceil(F.col("rows") / HUBS)) == 0)
    once = laid.withColumn("places", F.transform(F.when(hub, everywhere).otherwise(F.array("own")), lambda x: place(F.col("node"), F.lit(True), x == F.col("own"), x)))
    links = cut_lineage(links_of(once))
    found = components(links)
    split = laid.where("blocks > 1")
    if not split.take(1):
        return found
    named = split.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    main = named.groupBy("cluster", "tile", "component").count().groupBy("cluster", "tile").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    named = cut_lineage(named.join(main, ["cluster", "tile"]).withColumn("apart", F.col("component") != F.col("main")))
    left = named.where("apart").groupBy("cluster", "tile").agg(block_count(shingles).alias("lefts"))
    named = named.join(small_side(cut_lineage(left)), ["cluster", "tile"]).withColumn("left", F.pmod(F.xxhash64("node", F.lit(3)), F.col("lefts")).cast("int"))
    at_home = F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda x: F.col("own") * F.col("lefts") + x)
    as_probe = F.when(F.col("apart"), F.transform(everywhere, lambda y: y * F.col("lefts") + F.col("left"))).otherwise(F.array().cast("array<int>"))

    def second(code):
        return place(F.col("component"), F.col("apart") & (code % F.col("lefts") == F.col("left")), F.floor(code / F.col("lefts")) == F.col("own"), code)

    twice = named.withColumn("places", F.transform(F.array_distinct(F.concat(at_home, as_probe)), second))
    return components(links.unionByName(links_of(twice)))


def in_tiles(rows: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Links in the tiles of ``rows(node, places, data)``."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.select("node", "data", F.explode("places").alias("p")).select("p.*", "node", "data")
    dealt = placed.repartition(parts, "cluster", "tile", "block").sortWithinPartitions("cluster", "tile", "block")
    return dealt.mapInArrow(_tile_pass(percent, exact), "a bigint, b bigint")


def near_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of each document.

    Two documents link when ``100 * shared >= percent * united`` of their sets
    of ``width``-word shingles; the component is the smallest id reachable by links.
    """
    spark = docs.sparkSession
    with arrow_batches(spark, BATCH):
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = SPREAD * parts
        first = cut_lineage(rows.mapInArrow(_set_pass(width, percent, buckets), "doc_id bigint, n bigint, node bigint, bits binary, bucket int, counted binary"))
        sets = first.where("bucket is null").select("doc_id", "n", "node")
        frequent = frequent_names(first, parts)
        keyed = rows.where("doc_id is not null and text is not null").select("text")
        keys = keyed.mapInArrow(_key_pass(width, percent, buckets, frequent), "bucket int, keys binary")
        near = keys.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_bucket_pass(percent), "a bigint, b bigint")
        clusters = components(near)

        named = sets.where("node is not null and doc_id is not null")
        nodes = named.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"))
        bits = first.where("bits is not null").select("node", "bits").join(clusters.select("node"), "node", "left_semi").groupBy("node").agg(F.first("bits").alias("data"))
        many = BITS_TILE * TILE_SHINGLES
        by_bits = connect(lay_out(nodes, clusters, percent, many), many, lambda placed: in_tiles(placed.groupBy("node").agg(F.flatten(F.collect_list("places")).alias("places")).join(bits, "node"), percent, False))

        def by_sets(placed: DataFrame) -> DataFrame:
            placed = placed.groupBy("doc_id", "node").agg(F.flatten(F.collect_list("places")).alias("places"))
            # where the ids are measured to be few, other texts are left out before they are shuffled
            named = rows.join(small_side(placed.select("doc_id").distinct()), "doc_id", "left_semi")
            made = named.join(placed, "doc_id").select("text", "node", "places").mapInArrow(_member_pass(width), f"node bigint, places array<{PLACE}>, data binary")
            return in_tiles(made, percent, True)

        found = connect(lay_out(nodes, by_bits, percent, TILE_SHINGLES), TILE_SHINGLES, by_sets)
        groups = nodes.join(found, "node", "left").withColumn("group", F.coalesce("component", "node"))
        smallest = groups.groupBy("group").agg(F.min("doc_id").alias("component_id"))
        by_node = groups.join(smallest, "group").select("node", "component_id")
        component = F.when(F.col("node").isNull() | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return sets.join(by_node, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_first(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """One row of each group of near copies stays, that of the smallest id; rows without an id stay.

    Rows are named by a hash of id and text, so rows that share an id but not
    the text are apart. Of rows that share both, one stays. Rows without words
    are copies of nothing and all stay.
    """
    row, alike = (free_name(docs.columns, x) for x in ("_near_row", "_near_alike"))
    keyed = docs.withColumn(row, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    found = near_components(keyed.select(F.col(row).alias("doc_id"), "text"), width=width, percent=percent)
    groups = cut_lineage(found.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.first("component_id").alias("component"), F.count(F.lit(1)).alias("rows")).withColumnRenamed("doc_id", row))
    many = groups.groupBy("component").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("component")
    linked = groups.join(small_side(many), "component", "left_semi").select(row, "component")
    ids = keyed.groupBy(row).agg(F.min("doc_id").alias("id"))
    ranked = cut_lineage(ids.join(linked, row).select("component", row, F.struct("id", row).alias("rank")))
    first = ranked.groupBy("component").agg(F.min("rank").alias("first"))
    gone = cut_lineage(ranked.join(small_side(first), "component").where(F.col(row) != F.col(f"first.{row}")).select(row))
    kept = keyed.join(small_side(gone), row, "left_anti")  # where few rows go, the texts of the others stay where they are
    again = groups.where("rows > 1").select(row)
    if not again.take(1):
        return kept.select(*docs.columns)
    # the limit on row_number is applied before the shuffle, so a row repeated very often costs a few rows a task
    hashed = [F.col(c) for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    one = kept.join(small_side(again), row, "left_semi").withColumn(alike, F.row_number().over(Window.partitionBy(row).orderBy(F.xxhash64(*hashed)))).where(F.col(alike) == 1)
    return kept.join(small_side(again), row, "left_anti").select(*docs.columns).unionByName(one.select(*docs.columns))


@query("op4_ngram_join")
def op4_ngram_join(spark, folder):
    return near_components(table(spark, folder, "documents"))
