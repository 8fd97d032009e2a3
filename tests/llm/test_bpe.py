import base64
import random

import public_tokenizers as P
import pytest
import tiktoken
from brute import sha

from martlib.llm import bpe

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(bpe.RANKS), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def replay():
    return bpe.MergeReplay(bpe.load_ranks())


def ids(part):
    return [int.from_bytes(part[i:i + 4], "little") for i in range(0, len(part), 4)]


def test_equals_the_library_on_random_texts(library, replay):
    rng = random.Random(1)
    alphabets = ["abcdefghij ", "aaab ", "éèçñü äöß ", "0123456789 ", " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 　᠎​", "日本語한국어 العربية ", "'sdtlmrevy ", "😀👍🏽é ", "".join(map(chr, range(33, 127)))]
    texts = ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    texts += ["".join(rng.choice(a) for _ in range(200)) for a in alphabets for _ in range(40)]
    assert [ids(x) for x in replay.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_words_are_cut_like_the_library_for_every_character(library, replay):
    for lo in range(0, 0x30000, 512):
        text = "".join(f"a{chr(c)}1{chr(c)}  {chr(c)}" for c in range(lo, lo + 512) if not 0xD800 <= c < 0xE000)
        assert ids(replay.encode([text])[0]) == library.encode_ordinary(text), hex(lo)


def test_replay_merges_the_lowest_pair_first():
    # a made vocabulary in which a merge makes a pair of lower rank than its own
    base = [bytes([i]) for i in range(256)]
    for extra in ([b"bc", b"abc", b"cd", b"abcd"], [b"abcd", b"bc", b"abc", b"ab"], [b"aaa", b"aa", b"aaaa"], [b"xab", b"ab", b"abab", b"ba"]):
        ranks = {t: i for i, t in enumerate([*base, *extra])}
        made = bpe.MergeReplay(b"\n".join(base64.b64encode(t) + b" " + str(i).encode() for t, i in ranks.items()))

        def plain(word, ranks=ranks):
            parts = [bytes([c]) for c in word]
            while True:
                found = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
                if not found:
                    return [ranks[p] for p in parts]
                _, i = min(found)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]

        rng = random.Random(2)
        words = [bytes(rng.choice(b"abcdx") for _ in range(rng.randint(0, 12))) for _ in range(500)]
        assert made.replay(words) == [plain(w) for w in words]


def test_given_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r for r in bpe.token_report(docs).collect()}
    for r in docs.collect():
        want = library.encode_ordinary(r["text"])
        assert got[r["doc_id"]]["n_tokens"] == len(want)
        assert got[r["doc_id"]]["ids_sha256"] == sha(",".join(map(str, want)))
        assert got[r["doc_id"]]["decoded_sha256"] == sha(r["text"])


def test_edge_cases(spark, library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 50)  # the long texts go piece by piece
    long = "word " * 200_000
    rows = [(1, None, "a"), (2, "", None), (3, "x", "b"), (3, "x", "b"), (None, "null id", "c"), (4, long, "d"), (5, "a" * 20_000, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, token string")
    got = bpe.encode(df).collect()
    assert [r["ids"] for r in got] == [library.encode_ordinary(r[1] or "") for r in rows]
    assert [r["token"] for r in got] == [r[2] for r in rows]
    assert bpe.token_report(df.limit(0)).count() == 0
    back = bpe.decode(spark.createDataFrame([(1, None), (2, []), (3, library.encode_ordinary("é!"))], "k int, ids array<int>")).collect()
    assert [r["decoded"] for r in back] == [None, b"", "é!".encode()]
    with pytest.raises(ValueError):
        bpe.encode(df.withColumnRenamed("token", "ids"))
