import random
from collections import Counter

import numpy as np
from brute import WORD

from martlib.llm import repetition

SF = "/root/testdata/sf0.001"
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def plain(text, least):
    text = text or ""
    w = WORD.findall(text)
    n = len(w)
    windows = Counter(tuple(w[i:i + 3]) for i in range(n - 2))
    repeat = {i + d for i in range(n - 2) if windows[tuple(w[i:i + 3])] > 1 for d in range(3)}
    order = sorted(range(n), key=lambda i: w[i:])
    lcp = [0] * (n + 1)
    for k, (a, b) in enumerate(zip(order[:-1], order[1:], strict=True), 1):
        while max(a, b) + lcp[k] < n and w[a + lcp[k]] == w[b + lcp[k]]:
            lcp[k] += 1
    span, top = set(), 0
    for k, i in enumerate(order):
        m = max(lcp[k], lcp[k + 1])
        if m >= least:
            span |= set(range(i, i + m))
            top = max(top, m)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"), "n_dup_lines": dup, "n_repeat_words": len(repeat), "covered_words": len(span), "longest_repeat": top}


def random_texts(count=250, seed=4):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "a", "a a", "a a a", "a b a b a b a b", "x\nx\n x\nx \n\nx", "é😀 #é|"]
    for _ in range(count):
        vocabulary = [rng.choice("abcdé#*😀") * rng.randint(1, 3) for _ in range(rng.randint(1, 30))]
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 120))]
        if w and rng.random() < 0.5:
            a = rng.randrange(len(w))
            w += w[a:a + rng.randint(1, 40)] * rng.randint(1, 3)
        texts.append("".join(x + rng.choice([" ", "\n", "  ", "\t"]) for x in w))
    return texts


def test_equals_plain_suffix_arrays(spark):
    texts = random_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for least in (1, 2, 6):
        got = {r["doc_id"]: r for r in repetition.repetition(df, least=least).collect()}
        for i, t in enumerate(texts):
            assert {k: got[i][k] for k in NAMES} == plain(t, least), t


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in repetition.repetition(docs).collect()}
    for r in docs.collect():
        want = plain(r["text"], repetition.LEAST)
        assert {k: got[r["doc_id"]][k] for k in NAMES} == want
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert got[r["doc_id"]]["base_failed"] == failed
        assert got[r["doc_id"]]["kept"] == (not failed and want["covered_words"] <= repetition.COVERED * want["n_words"] and want["longest_repeat"] <= repetition.LONGEST)


def test_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(1, None, "a"), (2, long, None), (2, long, None), (None, long + " " + long, "c"), (3, "same " * 50_000, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string")
    got = repetition.repetition(df).collect()
    assert [r["kept"] for r in got] == [False, True, True, False, False]
    assert got[3]["longest_repeat"] == 40_000 and got[3]["covered_words"] == 80_000 and got[4]["longest_repeat"] == 49_999
    assert [r["note"] for r in got] == ["a", None, None, "c", "d"]
    assert repetition.repetition(df.limit(0)).count() == 0


def test_order_is_that_of_the_suffixes():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 3, 300).astype(np.uint64)
    sa = repetition.SuffixArray(keys, np.full(300, 300))
    order = np.argsort(sa.ranks[-1])
    assert order.tolist() == sorted(range(300), key=lambda i: keys[i:].tolist())
