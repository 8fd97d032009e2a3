from zlib import crc32

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from martlib.llm import token_files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(P.path(token_files.VOCABULARY))


def plain(library, texts):
    return [[*library.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


def check(rows, order, ids):
    assert [r["doc_id"] for r in rows] == order
    before = 0
    for r, want in zip(rows, ids, strict=True):
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (before, len(want), crc32(np.array(want, "<u4").tobytes()))
        before += len(want)


def test_given_table(spark, library, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    files = token_files.write(docs, str(tmp_path))
    rows = sorted(token_files.read_documents(spark, str(tmp_path), files).collect(), key=lambda r: r["start"])
    plain_rows = sorted(docs.select("doc_id", "text").collect())
    check(rows, [r[0] for r in plain_rows], plain(library, [r[1] for r in plain_rows]))


def test_sequences_are_views_of_equal_length(spark, library, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    files = token_files.write(docs, str(tmp_path), length=128, sequences=4)
    want = [i for d in plain(library, [r[0] for r in docs.orderBy("doc_id").select("text").collect()]) for i in d]
    got = []
    for f in files:
        t = token_files.TokenFile(str(tmp_path), f["name"])
        total = sum(t.batches.get_batch(i).num_rows for i in range(t.batches.num_record_batches))
        for i in range(total):
            ids, mask = t.sequence(i)
            assert len(ids) == len(mask) == 128 and not ids.flags.owndata
            got += ids[mask].tolist()
        assert not mask.all() or f["ids"] % 128 == 0
    assert got == want
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_words_alone_give_the_ids_of_the_text(library):
    texts = ["", " ", "A b\tc\nd", "é é  ǅ Σας ΟΔΟΣ", "x<|endoftext|>y <|startoftext|>", "a\x1cb\x85c d　e", "ﬁ ́a À ÅB", "don't WE'LL 1234 $$$ a_b", "\x0b\x0c\r", "日本語 テキスト", "İstanbul ẞ"]
    texts += [f"{a}{c}{b}" for c in map(chr, [*range(1, 128), *range(0xC0, 0x250)]) for a, b in (("x", "y "), (" ", "1"), ("'", "s!"))]
    texts += ["".join(map(chr, range(lo, lo + 100))) + " x" for lo in range(1, 0x3000, 100)]
    got = token_files.WordIds(library.to_str(), np.dtype("<u2")).encode(texts)
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_edge_cases(spark, library, tmp_path):
    rows = [(3, "c d", "k"), (1, None, None), (2, "", "x"), (5, "word " * 60_000, ""), (3, "c d", "k"), (3, "other", "k"), (None, "null id", "n"), (-7, " ", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, h string")
    files = token_files.write(df, str(tmp_path / "a"), length=64, sequences=2)
    got = sorted(token_files.read_documents(spark, str(tmp_path / "a"), files).collect(), key=lambda r: r["start"])
    texts = {"c d": (3, 2), "other": (3, 1)}
    assert [r["doc_id"] for r in got] == [None, -7, 1, 2, 3, 3, 3, 5]
    count = dict(zip([None, -7, 1, 2, 5], [len(x) for x in plain(library, ["null id", " ", None, "", "word " * 60_000])], strict=True))
    assert all(r["n_tokens"] == count[r["doc_id"]] for r in got if r["doc_id"] != 3) and len(texts) == 2
    assert sum(r["n_tokens"] for r in got) == sum(f["ids"] for f in files)
    none = token_files.write(df.limit(0), str(tmp_path / "b"))
    assert none == [] and token_files.read_documents(spark, str(tmp_path / "b"), none).count() == 0
    # a second run of a task replaces the file of the first
    assert token_files.write(df, str(tmp_path / "a"), length=64, sequences=2) == files
