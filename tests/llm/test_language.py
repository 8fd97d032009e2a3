from zlib import crc32

import numpy as np

from martlib.llm import language

SF = "/root/testdata/sf0.01"
LEARNED = {"en": "the cat and the dog are with the man of the house and this is that ", "de": "der hund und die katze sind mit dem mann in das haus und ich bin nicht "}


def test_phrases_are_longest_matches():
    p = language.Parser(LEARNED)
    text = "the hund and katze xx this"
    codes = language.letter_codes(np.frombuffer(text.encode(), np.uint8))
    rates, sizes = p.rates(codes, np.array([0, len(codes)]))
    for k, name in enumerate(p.languages):
        used = "".join(LEARNED.values())
        seq, ref = "".join(c if c in used else "\0" for c in text), LEARNED[name]
        n = i = 0
        while i < len(seq):
            j = i + 1
            while j <= len(seq) and seq[i:j] in ref:
                j += 1
            i = max(i + 1, j - 1)
            n += 1
        # a symbol the reference lacks ends a phrase and starts the next one
        assert abs(round(rates[k][0] * sizes[0]) - n) <= 3
    assert p.languages[rates[:, 0].argmin()] in LEARNED


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = language.learn(docs)
    assert sorted(learned) == ["de", "en", "es", "fr"] and all(len(v) <= language.SAMPLE_SYMBOLS for v in learned.values())
    rows = language.identify(docs.withColumn("held_out", language.is_held_out()), learned).collect()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "der hund und die katze"), (4, "der hund und die katze"), (None, "the cat and the dog"), (5, "日本語"), (6, "the dog " * 40_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = language.identify(df, LEARNED).collect()
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "de", "de", "en", got[6]["lang_pred"], "en"]
    assert got[6]["lang_pred"] in LEARNED and got[0]["score"] == 0
    assert {r["lang_pred"] for r in language.identify(df, {}).collect()} == {"und"}
    assert language.identify(df.limit(0), LEARNED).count() == 0
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert language.learn(empty) == {}


def test_rejects_only_what_is_no_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    junk = spark.createDataFrame([(-1, None), (-2, "#### 123"), (-3, "xqzj wkvq zzxj qqkw")], "doc_id long, text string").selectExpr("doc_id", "text", "null lang", "null source", "0L n_chars")
    kept = language.keep_known(docs.unionByName(junk))
    assert kept.columns == docs.columns
    assert {r[0] for r in docs.select("doc_id").collect()} - {r[0] for r in kept.select("doc_id").collect()} == set()
    assert not {r[0] for r in kept.select("doc_id").collect()} & {-1, -2, -3}


def test_other_languages_go_and_short_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").limit(4000)
    # noisy short texts of a learned language need as many phrases as a sentence of a related one; three sentences are told apart
    foreign = [
        "La ricerca della felicità è una delle grandi domande della filosofia occidentale e molti autori ne hanno scritto negli ultimi secoli. Oggi il mercato apre presto e gli abitanti del quartiere comprano pesce fresco e verdura. Quando piove i bambini restano a casa e leggono vecchi libri di viaggio",
        "De regering heeft vandaag besloten dat de nieuwe wet volgend jaar in werking zal treden voor alle inwoners van het koninkrijk. Gisteravond keken duizenden mensen naar het vuurwerk boven de rivier. Volgens de burgemeester blijft de oude brug nog jaren gesloten omdat het onderzoek naar de scheuren traag verloopt",
        "Rząd postanowił dzisiaj że nowa ustawa wejdzie w życie w przyszłym roku dla wszystkich mieszkańców naszego pięknego kraju. Wczoraj wieczorem dzieci bawiły się nad rzeką a ich rodzice przygotowali kolację. Pociąg do Krakowa odjeżdża codziennie o siódmej rano",
    ]
    rows = [(-1 - i, t) for i, t in enumerate(foreign)] + [(-10 - i, t) for i, t in enumerate(["Ok", "a", "the", "Nein!", "12 I"])]
    more = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "null lang", "null source", "0L n_chars")
    kept = {r[0] for r in language.keep_known(docs.unionByName(more)).select("doc_id").collect()}
    assert not kept & {-1, -2, -3}
    assert {-10, -11, -12, -13, -14} <= kept
    assert {r[0] for r in docs.select("doc_id").collect()} <= kept


def test_a_repeated_id_is_one_text_of_the_sample(spark):
    rows = [(7, f"the same id has many texts number {i}", "en") for i in range(3000)] + [(i, f"der text {i}", "de") for i in range(100, 160)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = language.draw(df, 48)
    assert len(drawn) == 1 + 48 and [x for x in drawn if x[0] == "en"][0][2].startswith("the same id has many texts number")


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "der hund und die katze", "de", "x", 5, 6.0, "r"), (2, "123", "de", "y", 5, 6.0, "r")], "doc_id long, text string, lang string, Lang_pred string, score int, phrase_rate double, _lang_rate string")
    got = language.identify(df, LEARNED)
    assert got.columns == ["doc_id", "text", "lang", "_lang_rate", "lang_pred", "score", "phrase_rate"] and got.collect()[0]["lang_pred"] == "de"
    kept = language.keep_known(df)
    assert kept.columns == df.columns and [tuple(r) for r in kept.collect()] == [tuple(df.collect()[0])]


def test_many_letters_stay_small_and_give_the_same(monkeypatch):
    import random
    rng = random.Random(2)
    many = {k: "".join(chr(0x4E00 + rng.randrange(2500)) for _ in range(12_000)) for k in ("x", "y")}
    p = language.Parser(many)
    assert not p.dense and p.edge.nbytes + p.to.nbytes + p.start.nbytes < 50 << 20
    text = many["x"][100:400] + many["y"][50:90] + "abc"
    codes = np.array([ord(c) for c in text])
    rates, _ = p.rates(codes, np.array([0, len(codes)]))
    assert rates[0, 0] < rates[1, 0]
    dense = language.Parser(LEARNED)
    monkeypatch.setattr(language, "DENSE_CELLS", 0)
    sparse = language.Parser(LEARNED)
    codes = language.letter_codes(np.frombuffer("the hund und katze xx this 日 man".encode(), np.uint8))
    assert dense.dense and not sparse.dense
    assert (dense.rates(codes, np.array([0, 5, len(codes)]))[0] == sparse.rates(codes, np.array([0, 5, len(codes)]))[0]).all()


def test_every_labelled_text_counts(spark):
    # one document in 400 has the words and the many phrases that tell
    rows = [(i, "der hund und die katze " * 40, "de") for i in range(400)] + [(400 + i, "zwölf boxkämpfer jagen viktor quer " * 40, "de") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = language.references(df)
    assert set(learned["de"].split()) == {"der", "hund", "und", "die", "katze", "zwölf", "boxkämpfer", "jagen", "viktor", "quer"}
    assert learned["de"].startswith("der die hund katze und ")
    # a text that only one labelled document is like is known by the limits of all
    odd = spark.createDataFrame([(9000, "wxyz " * 100, "de")], "doc_id long, text string, lang string")
    base = {"de": "der hund und die katze "}
    without, with_odd = language.rate_limits(df.where("doc_id < 400"), base), language.rate_limits(df.where("doc_id < 400").union(odd), base)
    assert all(b > a for a, b in zip(without[5:], with_odd[5:]))


def test_scripts_without_spaces_count_by_pieces(spark):
    df = spark.createDataFrame([(1, "日本語の文章" * 10, "ja"), (2, None, "ja"), (None, "x", "ja"), (3, "ab cd", "ja")], "doc_id long, text string, lang string")
    words = language.references(df)["ja"].split()
    assert "ab" in words and "x" not in words and max(map(len, words)) == language.PIECE
