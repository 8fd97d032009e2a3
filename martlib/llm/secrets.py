"""Secret scan with SQL functions only: fixed patterns, and a battery of randomness tests with false-discovery control.

Fixed patterns give the base spans (assign, access, hex). The battery looks at
every run of at least ``TOKEN_LENGTH`` token characters, and at the parts of that
length between '/' or '+' and between '_' or '-', as in paths and prefixed keys.
A '=' is only part of a token as its padding, so the value of ``NAME=value`` is one.

* An **encoding** is inferred: hex, base32, base36, base62 or base64, each with
  its alphabet of ``m`` symbols.
* Three tests of the hypothesis that the symbols are drawn at random from that
  alphabet: chi-squared of the symbol counts, runs above and below the middle of
  the alphabet, and serial correlation. A token is *random-looking* when none
  rejects at ``ALPHA`` after Bonferroni's correction.
* Short random-looking tokens can be plain text, so a second p-value bounds how
  often text has such a mix of lower case, upper case, digits and signs: Chernoff's
  bound of the chi-squared tail (3 degrees of freedom) at ``2 * length * KL(mix || text)``,
  which falls with the length by itself.
* **False discoveries** are controlled by the Benjamini-Hochberg rule at ``RATE``
  in every band of length over all tokens of the corpus, short and long ones
  apart. The counts by band and p-value class are a bounded table.

The battery's hypothesis is that a token is random, the discovery's that it is
text: a small p-value of the tests speaks against a secret and cannot be put under
a rule that looks for small ones. So the tests admit a token, and the rule controls
the share of text among those admitted, by the p-value of text.

A token is added as ``random`` if it is random-looking, discovered, holds a digit
and a letter, and does not lie within a base span; a part, if it also does not lie
within a larger one that was added.

Positions are code points, ends exclusive. Cases: a null text is treated as
empty and has no spans; repeated rows get equal answers; other columns are kept
or ignored as the caller selects, names never clash as helper columns carry a
prefix that is checked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlib.llm.registry import query, table

# The base patterns and the least length of their matches.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ["assign", "access", "hex", "random"]

TOKEN_LENGTH = 20
PAD = "(?:={1,6}+(?![A-Za-z0-9+/_=-]))?+"  # '=' ends a token as padding; elsewhere it parts a name from its value
TOKEN = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{TOKEN_LENGTH},}}+{PAD}"
# parts of a token between '/' or '+', and between '_' or '-'; a match of one pattern is never a match of another
SEGMENT = rf"(?:(?<=[+/])[A-Za-z0-9_-]{{{TOKEN_LENGTH},}}+{PAD}|(?<![A-Za-z0-9+/_-])[A-Za-z0-9_-]{{{TOKEN_LENGTH},}}+(?=[+/]))"
WORD = rf"(?:(?<=[_-])[A-Za-z0-9]{{{TOKEN_LENGTH},}}+{PAD}|(?<![A-Za-z0-9_-])[A-Za-z0-9]{{{TOKEN_LENGTH},}}+(?=[_-]))"
TESTED = {"token": TOKEN, "segment": SEGMENT, "word": WORD}
# a run of shorter matches is skipped inside the expression; the result is the same as filtering the base matches
ACCESS_LONG = r"AKIA[A-Z0-9]{16,}+"
HEX_LONG = r"(?<![0-9a-f])[0-9a-f]{24,}+"

ALPHA = 0.001  # level of the three tests together
RATE = 0.01  # share of false discoveries allowed among the discoveries of a band
CLASSES = 200  # p-values are counted in classes of one natural logarithm
# shares of lower case, upper case, digits and signs in text, and in text in capitals
TEXT_MIX = (0.90, 0.06, 0.03, 0.01)
CAPITALS_MIX = (0.06, 0.90, 0.03, 0.01)
# encoding: (what it looks like, its alphabet)
ENCODINGS = {
    "hex": (r"^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": (r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36": (r"^([0-9a-z]+|[0-9A-Z]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "base62": (r"^[0-9A-Za-z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    "base64": (r"^[A-Za-z0-9+/_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
}
P = "_secret_"
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def between(text: Column, pattern: str, matches: Column) -> Column:
    """The text around the matches; only looked up where there are any."""
    return F.when(F.size(matches) > 0, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>"))


def let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


CHUNK = 64  # elements scanned at a time; an array of n costs n * CHUNK + (n / CHUNK) ** 2


def running(values: Column, merge) -> Column:
    """Running sums or maxima of an array of longs, by chunks: those of the chunks first, then inside each."""
    def scan(part: Column, start: Column) -> Column:
        zero = F.struct(start.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
        step = lambda acc, x: let(merge(acc["at"], x), lambda v: F.struct(v.alias("at"), F.concat(acc["out"], F.array(v)).alias("out")))
        return F.aggregate(part, zero, step, lambda acc: acc["out"])

    def chunks(held: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(held) - 1) / CHUNK).cast("int")), lambda c: F.slice(held, c * CHUNK + 1, F.lit(CHUNK)))
        return let(parts, placed)

    def placed(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, F.lit(0).cast("bigint"), merge))
        before = F.concat(F.array(F.lit(0).cast("bigint")), F.slice(scan(totals, F.lit(0)), F.lit(1), F.size(parts) - 1))
        return F.flatten(F.zip_with(parts, before, scan))

    return let(values, lambda held: F.when(F.size(held) > 0, chunks(held)).otherwise(held))


def places(matches: Column, pieces: Column) -> Column:
    """``(start, end, match)`` of each match, from the lengths of the matches and of the text between them."""
    steps = F.zip_with(matches, F.slice(pieces, F.lit(1), F.size(matches)), lambda m, before: (F.length(m) + F.length(before)).cast("bigint"))
    ends = running(steps, lambda a, b: a + b)
    one = lambda m, end: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"))
    return F.when(F.size(matches) > 0, F.zip_with(matches, ends, one)).otherwise(F.array().cast("array<struct<start:bigint,end:bigint,match:string>>"))


def not_within(found_places: Column, spans: Column) -> Column:
    """The places that lie in none of the spans: no span that starts before or at one reaches its end."""
    marks = F.transform(spans, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("kind"), b["end"].alias("end"), F.lit(None).cast("string").alias("match")))
    asked = F.transform(found_places, lambda x: F.struct(x["start"].alias("start"), F.lit(1).alias("kind"), x["end"].alias("end"), x["match"].alias("match")))

    def swept(line: Column) -> Column:
        reach = running(F.transform(line, lambda x: F.when(x["kind"] == 0, x["end"]).otherwise(F.lit(0)).cast("bigint")), lambda a, b: F.greatest(a, b))
        free = F.zip_with(line, reach, lambda x, end: F.when((x["kind"] == 1) & (x["end"] > end), F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"))))
        return F.array_compact(free)

    return F.when(F.size(found_places) > 0, let(F.array_sort(F.concat(marks, asked)), swept)).otherwise(found_places)


def normal_tail(z: Column) -> Column:
    """P(Z > z), by a rational approximation of the error function (error under 1e-7)."""
    x = F.least(F.lit(8.0), F.abs(z)) / math.sqrt(2)
    t = 1 / (1 + 0.3275911 * x)
    half = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x) / 2
    return F.when(z >= 0, half).otherwise(1 - half)


def encoding(token: Column) -> Column:
    """Alphabet of the narrowest encoding that a token fits; null if it fits none."""
    out = F.lit(None).cast("string")
    for looks, alphabet in reversed(ENCODINGS.values()):
        out = F.when(token.rlike(looks), F.lit(alphabet)).otherwise(out)
    return out


def tests(token: Column) -> Column:
    """``(p, text)``: the corrected p-value of the three randomness tests, and minus the logarithm of the text p-value."""
    alphabet = encoding(token)
    body = F.translate(F.regexp_replace(token, "=+$", ""), "-_", "+/")
    body = F.when(F.length(alphabet) <= 16, F.lower(body)).when((F.length(alphabet) == 36) & body.rlike("^[0-9A-Z]+$"), F.lower(body)).otherwise(body)

    def with_parts(x):
        body, alphabet = x["body"], x["alphabet"]
        m, n = F.length(alphabet).cast("double"), F.length(body).cast("double")
        values = F.transform(F.sequence(F.lit(1), F.length(body)), lambda i: (F.instr(alphabet, F.substring(body, i, F.lit(1))) - 1).cast("double"))
        squares = F.aggregate(F.array_distinct(F.filter(F.split(body, ""), lambda c: c != "")), F.lit(0.0), lambda a, c: a + F.pow(n - F.length(F.replace(body, c, F.lit(""))), F.lit(2)))
        return F.struct(m.alias("m"), n.alias("n"), values.alias("values"), squares.alias("squares"), body.alias("body"))

    def with_statistics(x):
        m, n, v = x["m"], x["n"], x["values"]
        mid = (m - 1) / 2
        steps = F.sequence(F.lit(1), F.size(v) - 1)
        runs = F.aggregate(steps, F.lit(1.0), lambda a, i: a + F.when((F.get(v, i) > mid) != (F.get(v, i - 1) > mid), 1.0).otherwise(0.0))
        serial = F.aggregate(steps, F.lit(0.0), lambda a, i: a + (F.get(v, i) - mid) * (F.get(v, i - 1) - mid))
        chi = x["squares"] * m / n - n
        free = m - 1
        z_chi = (F.pow(chi / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        z_runs = (runs - 1 - (n - 1) / 2) / F.sqrt((n - 1) / 4)
        z_serial = serial / ((m * m - 1) / 12) / F.sqrt(n - 1)
        p = F.least(normal_tail(z_chi), 2 * normal_tail(F.abs(z_runs)), 2 * normal_tail(F.abs(z_serial)))
        return F.least(F.lit(1.0), 3 * p)

    n = F.length(token).cast("double")
    lower, upper, digit = (n - F.length(F.regexp_replace(token, c, "")) for c in ("[a-z]", "[A-Z]", "[0-9]"))

    def divergence(x, mix):
        return sum((F.when(x[k] > 0, x[k] / x["n"] * F.log(x[k] / x["n"] / F.lit(q))).otherwise(0.0) for k, q in zip("luds", mix, strict=True)), F.lit(0.0))

    counts = F.struct(n.alias("n"), lower.alias("l"), upper.alias("u"), digit.alias("d"), (n - lower - upper - digit).alias("s"))

    g = let(counts, lambda x: 2 * x["n"] * F.least(divergence(x, TEXT_MIX), divergence(x, CAPITALS_MIX)))
    text = let(g, lambda x: F.when(x > 3, x / 2 - 1.5 * (1 + F.log(x / 3))).otherwise(0.0))
    random = F.when(alphabet.isNull(), F.lit(0.0)).otherwise(let(let(F.struct(body.alias("body"), alphabet.alias("alphabet")), with_parts), with_statistics))
    return F.when(token.rlike("[0-9]") & token.rlike("[A-Za-z]"), F.struct(random.alias("p"), text.alias("text"))).otherwise(F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("text")))


def band(length: Column) -> Column:
    """Four bands of length to each doubling."""
    return F.floor(4 * F.log2(length / F.lit(float(TOKEN_LENGTH)))).cast("int")


def p_class(text: Column) -> Column:
    return F.least(F.lit(CLASSES), F.floor(text)).cast("int")


def thresholds(docs: DataFrame, text: str = "text") -> dict[int, int]:
    """Least p-value class of a discovery in each band of length, over all tokens of the corpus.

    A band has ``CLASSES + 1`` classes and a doubling of length four bands, so
    the table is small whatever the corpus.
    """
    tokens = docs.select(F.explode(F.concat(*[found(F.col(text), p) for p in TESTED.values()])).alias("token"))
    scored = tokens.select(band(F.length("token")).alias("band"), p_class(tests(F.col("token"))["text"]).alias("class"))
    counts = scored.groupBy("band", "class").count()
    down = Window.partitionBy("band").orderBy(F.desc("class"))
    ranked = counts.select("band", "class", F.sum("count").over(down).alias("found"), F.sum("count").over(Window.partitionBy("band")).alias("all"))
    hold = ranked.where((F.col("class") > 0) & (F.exp(-F.col("class")) * F.col("all") <= F.lit(RATE) * F.col("found")))
    return {r["band"]: r["least"] for r in hold.groupBy("band").agg(F.min("class").alias("least")).collect()}


def scan(docs: DataFrame, least: dict[int, int], text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``all_spans``, arrays of (start, kind, end) in order; ``kind`` counts ``KINDS``."""
    taken = [c for c in docs.columns if c.startswith(P) or c in ("base_spans", "all_spans")]
    if taken:
        raise ValueError(f"columns {taken} are needed by the scan")
    t = F.coalesce(F.col(text), F.lit(""))
    patterns = {"assign": ASSIGN, "access": ACCESS_LONG, "hex": HEX_LONG, **TESTED}
    df = docs.select("*", *[found(t, p).alias(f"{P}m_{k}") for k, p in patterns.items()])
    df = df.select("*", *[places(F.col(f"{P}m_{k}"), between(t, p, F.col(f"{P}m_{k}"))).alias(f"{P}s_{k}") for k, p in patterns.items()])
    kept = F.filter(F.col(f"{P}s_assign"), lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= LEAST["assign"])

    def spans(found_places, kind):
        return F.transform(found_places, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end")))

    df = df.select("*", F.array_sort(F.concat(spans(kept, "assign"), spans(F.col(f"{P}s_access"), "access"), spans(F.col(f"{P}s_hex"), "hex"))).alias("base_spans"))
    if least:
        limit = F.create_map(*[F.lit(x) for pair in sorted(least.items()) for x in pair])
        discovered = lambda x: p_class(x["text"]) >= F.coalesce(F.element_at(limit, band(F.length(x["match"]))), F.lit(CLASSES + 1))
        extra = F.array().cast(SPAN)

        for k in TESTED:
            # parts come after what they are parts of
            before = f"{P}before_{k}"
            df = df.select("*", F.concat("base_spans", extra).alias(before))
            open_places = not_within(F.col(f"{P}s_{k}"), F.col(before))
            tested = F.transform(open_places, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"), tests(x["match"]).alias("t")))
            df = df.select("*", tested.alias(f"{P}tested_{k}"))
            flat = F.transform(F.col(f"{P}tested_{k}"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"), x["t"]["p"].alias("p"), x["t"]["text"].alias("text")))
            df = df.select("*", F.concat(extra, spans(F.filter(flat, lambda x: (x["p"] >= ALPHA) & discovered(x)), "random")).alias(f"{P}extra_{k}"))
            extra = F.col(f"{P}extra_{k}")
    else:
        extra = F.array().cast(SPAN)
    return df.select(*docs.columns, "base_spans", F.array_sort(F.concat("base_spans", extra)).alias("all_spans"))


def joined(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of their texts replaced by ``mark``, and with ``n_chars`` of changed texts; null texts stay null."""
    df = scan(docs, thresholds(docs, text), text)
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    body = F.col(text)

    def step(acc, x):
        keep = F.substring(body, (acc["at"] + 1).cast("int"), F.greatest(F.lit(0), x["start"] - acc["at"]).cast("int"))
        out = F.concat(acc["out"], keep, F.when(x["start"] >= acc["at"], F.lit(mark)).otherwise(F.lit("")))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), out.alias("out"))

    clean = F.aggregate("all_spans", start, step, lambda acc: F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), F.length(body))))
    df = df.withColumn(text, F.when(F.size("all_spans") > 0, clean).otherwise(body))
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.when(F.size("all_spans") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    return df.select(*docs.columns)


def secret_report(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    df = scan(rows, thresholds(rows))

    def count(kind):
        return F.size(F.filter("base_spans", lambda x: x["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS[:3]]
    return df.select("doc_id", *counts, F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("all_spans").alias("spans"))


@query("op2_secrets")
def op2_secrets(spark, folder):
    return secret_report(table(spark, folder, "documents"))
