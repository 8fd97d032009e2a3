"""The passes over the texts send what they make in pieces, so that memory does not follow the batch."""

import numpy as np
import pyarrow as pa

from martlib.llm import ngram_join as N

NONE = np.zeros(0, np.uint64)


def batch():
    rnd = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rnd.integers(0, 500, 120)) for _ in range(30)]
    return pa.RecordBatch.from_arrays([pa.array(range(62), pa.int64()), pa.array([*texts, *texts, None, "one two"])], ["doc_id", "text"])


def keys(monkeypatch, held, piece):
    monkeypatch.setattr(N, "HELD", held)
    monkeypatch.setattr(N, "PIECE", piece)
    out = [b for b in N._key_pass(5, 80, 12, NONE)(iter([batch().select(["text"])]))]
    sizes = [sum(len(np.frombuffer(x.as_buffer(), N.KEY)) for x in b.column(1)) for b in out]
    found = sorted((to.as_py(), *k) for b in out for to, x in zip(b.column(0), b.column(1)) for k in np.frombuffer(x.as_buffer(), N.KEY).tolist())
    return sizes, found


def test_keys_are_sent_in_pieces(monkeypatch):
    one, want = keys(monkeypatch, 1 << 30, 1 << 30)
    sizes, found = keys(monkeypatch, 50, 2000)
    assert len(one) == 1 and found == want  # a copy in another piece makes no keys
    assert len(sizes) > 10 and max(sizes) <= 50 + 25


def test_sets_are_sent_in_pieces(monkeypatch):
    def run(held, piece):
        monkeypatch.setattr(N, "HELD", held)
        monkeypatch.setattr(N, "PIECE", piece)
        out = list(N._set_pass(5, 80, 12)(iter([batch()])))
        rows = [r for b in out for r in b.to_pylist()]
        docs = [(r["doc_id"], r["n"], r["node"], r["bits"]) for r in rows if r["bucket"] is None]
        names = sorted((r["bucket"], n) for r in rows if r["bucket"] is not None for n in np.frombuffer(r["counted"], np.uint32).tolist())
        return docs, names, max(len(r["counted"]) for r in rows if r["counted"])

    docs, names, most = run(1 << 30, 1 << 30)
    small_docs, small_names, least = run(100, 2000)
    assert small_docs == docs and small_names == names and least < most


def test_passes_get_small_batches(spark, monkeypatch):
    """Long texts come a few at a time, and the caller's setting is as it was."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    texts = [" ".join(f"w{i}x{j}" for j in range(300)) for i in range(200)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts])], "doc_id long, text string").coalesce(1)
    limit = 1 << 15

    def watched(real):
        def made(*args):
            inner = real(*args)

            def run(batches):
                def small():
                    for b in batches:
                        assert b.nbytes < 2 * limit, b.nbytes
                        yield b
                yield from inner(small())
            return run
        return made

    monkeypatch.setattr(N, "BATCH", limit)
    for name in ("_set_pass", "_key_pass", "_member_pass"):
        monkeypatch.setattr(N, name, watched(getattr(N, name)))
    got = {(r["doc_id"], r["component_id"]) for r in N.near_components(docs).collect()}
    assert got == {(i, i % 200) for i in range(400)}
    assert spark.conf.get(key) == before


def test_copies_in_later_batches_send_nothing(monkeypatch):
    """Nodes are remembered over batches, up to ``SEEN`` of them; one that is forgotten is sent again."""
    def sent():
        two = lambda: iter([batch(), batch()])
        maps = [x for b in N._set_pass(5, 80, 12)(two()) for x in b.column(3) if x.is_valid]
        runs = [x for b in N._key_pass(5, 80, 12, NONE)(b.select(["text"]) for b in two()) for x in b.column(1)]
        return len(maps), sum(len(np.frombuffer(x.as_buffer(), N.KEY)) for x in runs)

    maps, rows = sent()
    monkeypatch.setattr(N, "SEEN", 10)
    more_maps, more_rows = sent()
    assert maps == 31 and more_maps == 4 * 30 + 2 and more_rows > 3 * rows


def test_texts_that_stay_are_not_shuffled(spark):
    """The few copies that go are broadcast, whatever Spark would choose by itself."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    texts = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(9)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0], texts[1]])], "doc_id long, text string")
    spark.conf.set(key, "-1")
    try:
        kept = N.keep_first(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert {r["doc_id"] for r in kept.collect()} == set(range(9))
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan
