"""Language identification by cross-parsing.

Each language has a reference: its most frequent words, by the number of documents
that have them, counted over all labelled texts and indexed by a suffix automaton. A text is cut into phrases, each the longest string from
its place on that occurs in the reference. Few phrases mean that the reference
predicts the text well: phrases * log2(reference length) / text length is an
upper estimate of the cross entropy, and the language with the smallest wins.

The automata are turned into transition tables, so that thousands of text blocks
walk through all languages in lockstep, one symbol a step. Where letters are so many
that full tables would be large, edges are looked up in a sorted list instead.

``keep_known`` rejects texts that no reference predicts. How many phrases a symbol a
text of a learned language may need depends on its length, so the limits are
measured: every labelled text gives a piece of each length class, at a place given by
a hash of its key.

Nothing is learned from a sample. The model is bounded: the ``LANGUAGES`` languages with
most labelled texts, and of each the words that fit ``SAMPLE_SYMBOLS`` symbols.

Cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text if nothing was learned. Rows with a null id are predicted, never learned
from. Repeated rows get equal answers, and each of them counts. Ties go to the language first by name. Columns named like the
results are replaced by them in ``identify``; ``keep_known`` keeps all columns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlib.llm.registry import free_name, query, table
from martlib.llm.texts import column_bytes, slices

LANGUAGES = 200  # languages learned, at most: those with most labelled documents
SAMPLE_SYMBOLS = 12_000  # length of a reference, at most: bounds the tables of all languages together
LONG_WORD = 24  # longer runs of letters count by pieces
PIECE = 4
WORDS_HELD = 500_000  # counts a task holds before it hands them on
CALIBRATION_SYMBOLS = 1_000
CALIBRATION_LEAST = 100  # pieces from which on a length class has a limit of its own
MARGIN = 1.15  # a text may need so many times the phrases of the worst piece
DENSE_CELLS = 1 << 23  # full tables have at most so many cells, 32 MB
SHORT_REFERENCE = 4_096  # shorter references count as this long, or a few words would make every phrase cheap
BLOCK = 1_024  # texts are parsed in blocks of so many symbols
GAP, OTHER = 0, 1  # symbols of everything between words, and of letters no reference has
SHORT = 8  # texts of fewer symbols are too short to be rejected
MAX_RATE = 0.6  # phrases a symbol that a text under 32 symbols may need in any case, and longer ones where no limit could be measured


@cache
def letters() -> np.ndarray:
    """Lower-case code point of every letter, 0 for all else."""
    out = np.zeros(0x110000, np.int32)
    for i in range(len(out)):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def letter_codes(data: np.ndarray) -> np.ndarray:
    """Lower-case letters of UTF-8 bytes, with 0 for other characters."""
    return letters()[np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)]


def squeeze(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Makes one gap of each run of gaps within a document."""
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != GAP) | (codes[:-1] != GAP)
    keep[offsets[:-1][offsets[:-1] < len(codes)]] = True
    return codes[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the start."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for s in symbols:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and s not in go[p]:
            go[p][s] = new
            p = link[p]
        if p >= 0:
            q = go[p][s]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = copy
                while p >= 0 and go[p].get(s) == q:
                    go[p][s] = copy
                    p = link[p]
        last = new
    return go


class Parser:
    """Phrase counts of blocks of text in every language at once."""

    def __init__(self, references: dict[str, str]) -> None:
        self.languages = sorted(references)
        codes = {k: [ord(c) if c != " " else 0 for c in v] for k, v in references.items()}
        used = sorted({c for v in codes.values() for c in v} - {0})
        self.symbol_of = np.full(0x110000, OTHER, np.uint8 if len(used) < 250 else np.uint16)
        self.symbol_of[0] = GAP
        for i, c in enumerate(used):
            self.symbol_of[c] = i + 2
        width = self.width = len(used) + 2
        automata, self.roots, at = [], [], 0
        for name in self.languages:
            automata.append(automaton([int(self.symbol_of[c]) for c in codes[name]]))
            self.roots.append(at * width)
            at += len(automata[-1])
        # a symbol that cannot extend the phrase ends it (low bit) and starts the next one from the root
        start = np.repeat(np.array(self.roots, np.int64)[:, None] * 2 + 1, width, axis=1)
        for i, go in enumerate(automata):
            for s, to in go[0].items():
                start[i, s] = (self.roots[i] + to * width) * 2 + 1
        self.dense = at * width <= DENSE_CELLS
        if self.dense:
            parts = [np.tile(start[i], (len(go), 1)) for i, go in enumerate(automata)]
            for root, go, part in zip(self.roots, automata, parts, strict=True):
                for state, out in enumerate(go):
                    for s, to in out.items():
                        part[state, s] = (root + to * width) * 2
            self.next = np.concatenate(parts).ravel().astype(np.int32) if parts else np.zeros(0, np.int32)
        else:
            edges = np.array(sorted((root + state * width + s, (root + to * width) * 2) for root, go in zip(self.roots, automata, strict=True) for state, out in enumerate(go) for s, to in out.items()), np.int64)
            self.edge, self.to, self.start = np.ascontiguousarray(edges[:, 0]), np.ascontiguousarray(edges[:, 1]), start
        self.bits = np.array([np.log2(max(SHORT_REFERENCE, len(references[k]))) for k in self.languages])

    def step(self, state: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The next states, doubled; the low bit says that a phrase ended."""
        if self.dense:
            return self.next.take(state + symbols)
        at = state + symbols
        place = np.minimum(np.searchsorted(self.edge, at), len(self.edge) - 1)
        return np.where(self.edge[place] == at, self.to[place], self.start[:, symbols])

    def phrases(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each block in each language."""
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        state = np.repeat(np.array(self.roots, np.int32 if self.dense else np.int64)[:, None], len(starts), axis=1)
        count = np.ones(state.shape, np.int32)
        live = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")
        for t, k in enumerate(live):
            got = self.step(state[:, :k], symbols.take(starts[:k] + t))
            count[:, :k] += got & 1
            np.right_shift(got, 1, out=state[:, :k])
        out = np.empty_like(count)
        out[:, order] = count
        return out

    def rates(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per symbol of each document in each language, and the documents' lengths in symbols."""
        symbols, at = squeeze(self.symbol_of[codes], offsets)
        sizes = np.diff(at)
        blocks = -(-sizes // BLOCK)
        doc = np.repeat(np.arange(len(sizes)), blocks)
        index = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        starts = at[:-1][doc] + index * BLOCK
        count = self.phrases(symbols, starts, np.minimum(BLOCK, at[1:][doc] - starts))
        total = np.stack([np.bincount(doc, row, len(sizes)) for row in count]) if len(count) else np.zeros((0, len(sizes)))
        return total / np.maximum(1, sizes), sizes


_parsers: dict[tuple, Parser] = {}


def parser(references: dict[str, str]) -> Parser:
    """The parser is made once in each Python worker."""
    key = tuple(sorted(references.items()))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(references)
    return _parsers[key]


def predict(texts: pa.Array, references: dict[str, str]) -> tuple[list[str], list[float], list[float], list[int]]:
    """Language, score, phrases per symbol and symbols of each text."""
    names, scores, best_rates, lengths = [], [], [], []
    p = parser(references)
    data, offsets = column_bytes(texts)
    for lo, hi in slices(offsets):
        chunk = data[offsets[lo]:offsets[hi]]
        codes = letter_codes(chunk)
        lead = np.concatenate([[0], np.cumsum((chunk & 0xC0) != 0x80)])
        at = lead[offsets[lo:hi + 1] - offsets[lo]]
        has_letter = np.diff(np.concatenate([[0], np.cumsum(codes != 0)])[at]) > 0
        if not p.languages:
            names += ["und"] * (hi - lo)
            scores += [0.0] * (hi - lo)
            best_rates += [1.0] * (hi - lo)
            lengths += [0] * (hi - lo)
            continue
        rates, sizes = p.rates(codes, at)
        lengths += sizes.tolist()
        cost = rates * p.bits[:, None]
        best = np.argmin(cost, axis=0)
        rows = np.arange(hi - lo)
        low = cost[best, rows]
        rest = cost.copy()
        rest[best, rows] = np.inf
        second = rest.min(axis=0) if len(rest) > 1 else np.full(hi - lo, p.bits[0])
        score = np.clip(1 - low / np.maximum(second, 1e-9), 0, 1)
        names += [p.languages[b] if ok else "und" for b, ok in zip(best, has_letter, strict=True)]
        scores += np.where(has_letter, score, 0.0).tolist()
        best_rates += np.where(has_letter, rates[best, rows], 1.0).tolist()
    return names, scores, best_rates, lengths


def spellings(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Lower-case letters of each document, with spaces for everything else."""
    codes = letter_codes(data)
    codes[codes == 0] = ord(" ")
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    letters_, at = codes.astype("<u4").tobytes().decode("utf-32-le", "replace"), lead[offsets - offsets[0]]
    return [letters_[i:j] for i, j in zip(at[:-1], at[1:])]


def words_of(spelled: str) -> set[str]:
    """Distinct words; a run too long for one, as in scripts without spaces, counts by its pieces."""
    out = set()
    for w in spelled.split():
        if len(w) <= LONG_WORD:
            out.add(w)
        else:
            out.update(w[i:i + PIECE] for i in range(0, len(w), PIECE))
    return out


def _given(labelled: DataFrame, text: str, lang: str, key: str) -> DataFrame:
    return labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).cast("string").alias("key")).where("text is not null and lang is not null and key is not null")


def references(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, str]:
    """For each language the words that most of its labelled documents have, counted over all of them, as far as they fit."""
    given = _given(labelled, text, lang, key)
    most = given.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def flush() -> pa.RecordBatch:
            got = pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"])
            found.clear()
            return got

        for b in batches:
            data, offsets = column_bytes(b.column(0))
            langs = b.column(1).to_pylist()
            for lo, hi in slices(offsets):
                for name, spelled in zip(langs[lo:hi], spellings(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1])):
                    found.update((name, w) for w in words_of(spelled))
                if len(found) > WORDS_HELD:
                    yield flush()
        if found:
            yield flush()

    counted = given.join(F.broadcast(most), "lang").select("text", "lang").mapInArrow(count, "lang string, word string, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    # a word takes two symbols at least, so more of them cannot fit
    top = counted.groupBy("lang", "word").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLE_SYMBOLS // 2)
    out: dict[str, str] = {}
    for r in sorted(top.select("lang", "rank", "word").collect(), key=lambda r: (r["lang"], r["rank"])):
        if len(out.get(r["lang"], "")) + len(r["word"]) < SAMPLE_SYMBOLS:
            out[r["lang"]] = out.get(r["lang"], "") + r["word"] + " "
    return out


def rate_limits(labelled: DataFrame, learned: dict[str, str], text: str = "text", lang: str = "lang", key: str = "doc_id") -> list[float]:
    """Most phrases a symbol of texts of 1, 2, 4, ... symbols: every labelled document is measured on a piece of each length."""
    sizes = [1 << i for i in range((CALIBRATION_SYMBOLS // 2).bit_length())]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = parser(learned)
        most, pieces = np.zeros(len(sizes)), np.zeros(len(sizes), np.int64)
        for b in batches:
            data, offsets = column_bytes(b.column(0))
            langs, keys = b.column(1).to_pylist(), b.column(2).to_pylist()
            for lo, hi in slices(offsets):
                spelled = [" ".join(x.split()) for x in spellings(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1])]
                for k, size in enumerate(sizes):
                    cut = []
                    for x, name, own in zip(spelled, langs[lo:hi], keys[lo:hi]):
                        at = crc32(f"{own}/{k}".encode()) % (len(x) - size + 1) if len(x) >= size else 0
                        piece = x[at:at + size]
                        if len(piece) == size and name in learned and piece.strip():
                            cut.append(piece)
                    if cut:
                        codes = np.frombuffer("".join(cut).encode("utf-32-le"), np.uint32).copy()
                        codes[codes == ord(" ")] = GAP
                        rates, _ = p.rates(codes, np.arange(len(cut) + 1) * size)
                        most[k], pieces[k] = max(most[k], rates.min(axis=0).max()), pieces[k] + len(cut)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sizes)), pa.int32()), pa.array(most), pa.array(pieces)], ["class", "most", "pieces"])

    found = _given(labelled, text, lang, key).select("text", "lang", "key").mapInArrow(measure, "class int, most double, pieces long")
    got = {r["class"]: r for r in found.groupBy("class").agg(F.max("most").alias("most"), F.sum("pieces").alias("pieces")).collect()}
    limits = []
    for k, size in enumerate(sizes):
        limit = MARGIN * got[k]["most"] if k in got and got[k]["pieces"] >= CALIBRATION_LEAST else MAX_RATE
        limits.append(max(limit, MAX_RATE) if size < 32 else limit)
    return limits


Drawn = list[tuple[str, int, str]]  # language, rank, letters


def draw(labelled: DataFrame, rows: int, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Drawn:
    """A window of letters of at most ``rows`` labelled documents a language, in the order of a hash of the key.

    Distinct keys are ranked without their texts, and Spark limits the ranks
    before the shuffle. One text for each drawn key reaches the driver, cut to a
    window at a place that the key's hash gives.
    """
    given = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key")).where("text is not null and lang is not null and key is not null")
    keys = given.select("lang", "key").distinct()
    most = keys.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    # at most LANGUAGES * rows keys
    drawn = keys.join(F.broadcast(most), "lang").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rows)
    place = F.pmod(F.xxhash64("key", F.lit(1)), F.greatest(F.lit(1), F.length("text") - 4 * CALIBRATION_SYMBOLS)) + 1
    window = F.substring(F.col("text"), place.cast("int"), F.lit(4 * CALIBRATION_SYMBOLS))
    got = given.join(F.broadcast(drawn), ["lang", "key"]).groupBy("lang", "rank").agg(F.min(window).alias("text")).collect()
    out = []
    for r in sorted(got, key=lambda r: (r["lang"], r["rank"])):
        codes = letter_codes(np.frombuffer(r["text"].encode(), np.uint8))
        codes, _ = squeeze(codes, np.array([0, len(codes)]))
        out.append((r["lang"], r["rank"], "".join(chr(c) if c else " " for c in codes)))
    return out


def identify(docs: DataFrame, learned: dict[str, str], text: str = "text", names: tuple[str, ...] = ("lang_pred", "score", "phrase_rate")) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``phrase_rate`` (phrases per symbol); a fourth name adds the symbols."""
    fields = [f.name for f in docs.schema.fields]
    kept = [i for i, f in enumerate(fields) if f.lower() not in {x.lower() for x in names}]
    kinds = [(pa.string(), T.StringType()), (pa.float64(), T.DoubleType()), (pa.float64(), T.DoubleType()), (pa.int64(), T.LongType())][:len(names)]
    at = fields.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = predict(b.column(at), learned)
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in kept], *[pa.array(x, kind) for x, (kind, _) in zip(got, kinds, strict=False)]], [*[fields[i] for i in kept], *names])

    schema = T.StructType([*[docs.schema.fields[i] for i in kept], *[T.StructField(n, kind) for n, (_, kind) in zip(names, kinds, strict=True)]])
    return docs.mapInArrow(run, schema)


def is_held_out(key: str = "doc_id") -> Column:
    """A fifth of the documents is never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(5)) == 0, F.lit(False))


def learnable(docs: DataFrame) -> DataFrame:
    return docs.where(~is_held_out() & F.col("lang").isNotNull())


def learn(docs: DataFrame) -> dict[str, str]:
    return references(learnable(docs))


def rate_limit(symbols: Column, limits: list[float]) -> Column:
    """The limit of a text, between those of the length classes around it."""
    if not limits:
        return F.lit(MAX_RATE)
    x = F.least(F.log2(F.greatest(symbols, F.lit(1)).cast("double")), F.lit(float(len(limits) - 1)))
    table_ = F.array(*[F.lit(float(v)) for v in limits])
    lo = F.floor(x).cast("int")
    a, b = F.get(table_, lo), F.coalesce(F.get(table_, lo + 1), F.get(table_, lo))
    return a + (b - a) * (x - lo)


def keep_known(docs: DataFrame) -> DataFrame:
    """Documents in a learned language; ``und`` and texts that no reference predicts are rejected.

    Texts of fewer than ``SHORT`` symbols are kept if they have a letter: they are too short to tell.
    """
    labelled = learnable(docs)
    learned = references(labelled)
    names = tuple(free_name(docs.columns, x) for x in ("_lang_pred", "_lang_score", "_lang_rate", "_lang_symbols"))
    pred, _, rate, symbols = (F.col(x) for x in names)
    limit = rate_limit(symbols, rate_limits(labelled, learned)) if learned else F.lit(0.0)
    return identify(docs, learned, names=names).where((pred != "und") & ((symbols < SHORT) | (rate <= limit))).select(*docs.columns)


@query("op7_language")
def op7_language(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
