import base64
from collections import Counter

import brute
import corpus_pipeline as pipeline
import public_tokenizers as P
import tiktoken

from martlib.llm import mixing, ngram_join

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame([(-1, None), (-2, "12 34"), (-3, "xqzj wkvq zzxj qqkw vxxq")], "doc_id long, text string").selectExpr("doc_id", "text", "null lang", "'src0' source", "0L n_chars")
    planted = docs.limit(1).selectExpr("doc_id - 100 doc_id", "text", "lang", "source", "n_chars")
    state = docs.unionByName(junk).unionByName(planted)
    inputs, outputs = [], []
    for i, (_, stage) in enumerate(pipeline.STAGES):
        inputs.append(state)
        out = stage(spark, state, SF)
        if i < 4:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        state = spark.read.parquet(f"{tmp_path}/{i}")
        outputs.append([r.asDict() for r in state.collect()])
    rows = [[r.asDict() for r in x.collect()] for x in inputs]

    def ids(rs):
        return {r["doc_id"] for r in rs}

    # languages: what is no text goes, every document stays
    assert ids(rows[0]) - ids(outputs[0]) == {-1, -2, -3}
    # near copies: the smallest id of each component of plain all-pairs links
    sets = {r["doc_id"]: brute.shingle_set(r["text"], 5) for r in rows[1]}
    links = [(a, b) for a, b in brute.pairs(sorted(sets)) if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert ids(outputs[1]) == set(brute.reach(sets, links).values())
    assert planted.first()["doc_id"] in ids(outputs[1]) and docs.first()["doc_id"] not in ids(outputs[1])
    # secrets: base spans are replaced, other texts are untouched
    clean = {r["doc_id"]: r["text"] for r in outputs[2]}
    assert clean.keys() == ids(rows[2])
    for r in rows[2]:
        text, at, want = r["text"], 0, ""
        for start, _, end in brute.base_spans(text):
            want += text[at:start] + ("[SECRET]" if start >= at else "")
            at = max(at, end)
        assert clean[r["doc_id"]] == want + text[at:]
        assert all(x["n_chars"] == len(x["text"]) for x in outputs[2] if x["text"] != text or x["doc_id"] != r["doc_id"])
    # the mix: words of each source near its target, no document over three times
    sizes, taken = Counter(), Counter()
    for r in rows[3]:
        sizes[r["source"]] += len(brute.WORD.findall(r["text"]))
    for r in outputs[3]:
        taken[r["source"]] += len(brute.WORD.findall(r["text"]))
    want = brute.targets(dict(sizes))
    largest = max(len(brute.WORD.findall(r["text"])) for r in rows[3])
    assert all(abs(taken[s] - want[s]) <= largest / 2 for s in want)
    assert max(Counter(r["doc_id"] for r in outputs[3]).values()) <= mixing.MOST
    # tokens: as the library has them, with an exact way back
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for r in rows[4]:
        i = library.encode_ordinary(r["text"])
        expected[(r["doc_id"], len(i), brute.sha(",".join(map(str, i))), brute.sha(r["text"]))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in outputs[4]) == expected


def test_run_on_given_table(spark):
    assert len(pipeline.STAGES) == 5 and pipeline.ORACLE_SQL is None
    got = pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_near_copies_of_other_width(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text, "x"), (2, text + " more", "y"), (3, "w1 w2", "z")], "doc_id long, text string, band string")
    assert {r["doc_id"] for r in ngram_join.keep_first(df, width=5, percent=80).collect()} == {1, 3}
