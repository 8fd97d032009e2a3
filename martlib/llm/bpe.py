"""Byte-level BPE by merge replay: all new words of a block of the corpus are merged together, rank by rank.

A block's distinct words are laid out as one sequence of byte tokens. An
inverted index holds, for each rank, the positions of the pairs that merge to
it. Ranks are replayed in ascending order; a merge touches its two neighbours
only and enters the pairs it makes under their ranks. A pair that a merge makes
with a lower rank than its own is merged at once, as it is then the lowest of
its word. Within a rank, positions run from left to right. So each word gets the
tokens that merging its lowest pair first, again and again, would give it.

Blocks are runs of documents of a bounded size, so Spark's partitions are the
unit of work, nothing is shuffled, and a lost task is redone from its input. The
words of earlier blocks are remembered up to ``REMEMBERED``.

Cases: a null or empty text has no tokens. Repeated rows get equal ids. Texts of
any length are cut into words piece by piece. Ids that are null or out of the
vocabulary cannot be decoded and raise an error.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlib.llm.registry import query, table
from martlib.llm.texts import slices

# Letters and numbers that the regex library knows, but not the Unicode version of the tiktoken library.
NEW_LETTERS = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A"
    " 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168"
    " 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E"
    " 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
NEW_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"

REMEMBERED = 300_000  # words whose tokens a worker keeps for later blocks, about 60 MB
PIECES = 200_000  # words of one text that are held at a time
RANKS = "byte_bpe_multi_50k.tiktoken"


def load_ranks(path: str | None = None) -> bytes:
    """A rank file, read on the driver: its size is the vocabulary's, whatever the corpus."""
    with open(path or public_tokenizers.path(RANKS), "rb") as f:
        return f.read()


def parse_ranks(rank_file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}


class MergeReplay:
    def __init__(self, rank_file: bytes, pattern: str = public_tokenizers.PATTERN) -> None:
        self.ranks = parse_ranks(rank_file)
        new = "".join("-".join(f"\\U{int(c, 16):08X}" for c in r.split("-")) for r in f"{NEW_LETTERS} {NEW_NUMBERS}".split())
        self.new = regex.compile(f"[{new}]")
        self.plain = regex.compile(pattern)
        # texts of ASCII and Latin letters alone are cut by the faster library, with the classes written out
        latin, space = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", "\t-\r "
        self.wide = re.compile("[^\0-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]")
        narrow = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{latin}0-9]").replace(r"\p{L}", f"[{latin}]").replace(r"\p{N}", "[0-9]")
        self.narrow = re.compile(narrow.replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]"))
        # these characters count as neither letter nor number
        other = r"[^\s\p{L}\p{N}]"
        careful = pattern.replace(other, "<other>").replace(r"\p{L}", f"(?:(?![{new}])\\p{{L}})").replace(r"\p{N}", f"(?:(?![{new}])\\p{{N}})")
        self.careful = regex.compile(careful.replace("<other>", f"(?:{other}|[{new}])"))
        self.size = max(self.ranks.values(), default=0) + 1
        # what two tokens make: every way to cut a token into two
        self.made: dict[int, int] = {}
        for t, r in self.ranks.items():
            for i in range(1, len(t)):
                a, b = self.ranks.get(t[:i]), self.ranks.get(t[i:])
                if a is not None and b is not None:
                    self.made[a * self.size + b] = r
        self.known: dict[str, bytes] = {}

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word."""
        if not any(words):
            return [[] for _ in words]
        made, size = self.made.get, self.size
        token = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        n = len(token)
        # every place starts a token; the one before and after it in its word, or -1
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends[ends > 0] - 1] = -1
        before[(ends - [len(w) for w in words])[[len(w) > 0 for w in words]]] = -1
        codes, place = np.unique(np.where(after[:-1] >= 0, token[:-1] * size + token[1:], -1), return_inverse=True)
        rank = np.array([made(c, -1) for c in codes.tolist()], np.int64)[place] if n > 1 else np.zeros(0, np.int64)
        by = np.argsort(rank, kind="stable")
        by = by[np.searchsorted(rank[by], 0):]
        ranks, cuts = np.unique(rank[by], return_index=True)
        index = dict(zip(ranks.tolist(), (p.tolist() for p in np.split(by, cuts[1:])), strict=True)) if len(ranks) else {}
        queue = ranks.tolist()  # ascending, so it is a heap
        token, after, before = token.tolist(), after.tolist(), before.tolist()
        push, pop = heapq.heappush, heapq.heappop
        while queue:
            rank = pop(queue)
            places = index.pop(rank)
            places.sort()
            for i in places:
                r = rank
                while True:
                    j, a = after[i], token[i]
                    if a < 0 or j < 0 or made(a * size + token[j]) != r:
                        break
                    token[i], token[j] = r, -1
                    after[i] = right = after[j]
                    left = before[i]
                    lower = rank
                    if left >= 0 and (m := made(token[left] * size + r)) is not None:
                        if m < lower:
                            lower, at = m, left
                        elif m in index:
                            index[m].append(left)
                        else:
                            index[m] = [left]
                            push(queue, m)
                    if right >= 0:
                        before[right] = i
                        if (m := made(r * size + token[right])) is not None:
                            if m < lower:
                                if lower < rank:
                                    self._enter(index, queue, lower, at)
                                lower, at = m, i
                            elif m in index:
                                index[m].append(i)
                            else:
                                index[m] = [i]
                                push(queue, m)
                    if lower == rank:
                        break
                    # the merge made a pair below its own rank: it is the lowest of its word now
                    i, r = at, lower
        out, start = [], 0
        for end in ends.tolist():
            ids = [t for t in token[start:end] if t >= 0]
            out.append(ids)
            start = end
        return out

    @staticmethod
    def _enter(index: dict[int, list[int]], queue: list[int], rank: int, place: int) -> None:
        if rank in index:
            index[rank].append(place)
        else:
            index[rank] = [place]
            heapq.heappush(queue, rank)

    def learn(self, words: Iterable[str]) -> None:
        """Finds the ids of words that are not known yet, all of them together."""
        known = self.known
        new = [w for w in set(words) if w not in known]
        coded = [w.encode("utf-8", "surrogatepass") for w in new]
        long = []
        for w, b in zip(new, coded, strict=True):
            whole = self.ranks.get(b)
            if whole is None:
                long.append((w, b))
            else:
                known[w] = whole.to_bytes(4, "little")
        for (w, _), ids in zip(long, self.replay([b for _, b in long]), strict=True):
            known[w] = np.array(ids, "<i4").tobytes()

    def words(self, text: str) -> re.Pattern | regex.Pattern:
        """The pattern to cut a text with."""
        if text.isascii() or not self.wide.search(text):
            return self.narrow
        return self.careful if self.new.search(text) else self.plain

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The words of a text, a bounded number at a time."""
        if len(text) <= 4 * PIECES:
            yield self.words(text).findall(text)
        else:
            found = (m[0] for m in self.words(text).finditer(text))
            while part := list(islice(found, PIECES)):
                yield part

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text of a slice as little-endian 32-bit integers."""
        if not texts:
            return []
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(texts) > 1 or len(texts[0]) <= 4 * PIECES:
            parts = [self.words(t).findall(t) for t in texts]
            self.learn(chain.from_iterable(parts))
            return [b"".join(map(self.known.__getitem__, p)) for p in parts]
        out = []
        for t in texts:
            ids = bytearray()
            for part in self.pieces(t):
                self.learn(part)
                ids += b"".join(map(self.known.__getitem__, part))
            out.append(bytes(ids))
        return out


_replays: dict[str, MergeReplay] = {}


def replayer(rank_file: bytes, pattern: str) -> MergeReplay:
    key = f"{hash(rank_file)} {pattern}"
    if key not in _replays:
        _replays.clear()
        _replays[key] = MergeReplay(rank_file, pattern)
    return _replays[key]


_tokens: dict[int, dict[int, bytes]] = {}


def tokens(rank_file: bytes) -> dict[int, bytes]:
    """The bytes of each id, made once in each Python worker."""
    key = hash(rank_file)
    if key not in _tokens:
        _tokens.clear()
        _tokens[key] = {r: t for t, r in parse_ranks(rank_file).items()}
    return _tokens[key]


def lists_of(parts: list[bytes]) -> pa.Array:
    sizes = np.array([0, *(len(p) // 4 for p in parts)])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes).astype(np.int32)), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def bytes_of(ids: pa.Array, token: dict[int, bytes]) -> list[bytes | None]:
    """What each list of ids stands for."""
    return [b"".join(map(token.__getitem__, v.values.to_numpy().tolist())) if v.is_valid else None for v in ids]


def encode(docs: DataFrame, rank_file: bytes | None = None, pattern: str = public_tokenizers.PATTERN, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the token ids of their texts as ``ids``, an array of integers.

    With ``decoded`` the bytes that the ids stand for are added in the same pass.
    """
    if taken := {ids, decoded} & {*docs.columns}:
        raise ValueError(f"there are columns {sorted(taken)} already; name others")
    fields, names = docs.schema.fields, docs.columns
    at = names.index(text)
    shared = _share(docs.sparkSession, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, token = replayer(shared.value, pattern), tokens(shared.value)
        for b in batches:
            column = b.column(at).cast(pa.large_string()).fill_null("")
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
            for lo, hi in slices(offsets):
                part = b.slice(lo, hi - lo)
                got = lists_of(bpe.encode(column.slice(lo, hi - lo).to_pylist()))
                more = [pa.array(bytes_of(got, token), pa.binary())] if decoded else []
                yield pa.RecordBatch.from_arrays([*part.columns, got, *more], [*names, ids, *([decoded] if decoded else [])])

    out = [*fields, T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    return docs.mapInArrow(run, T.StructType([*out, T.StructField(decoded, T.BinaryType())] if decoded else out))


def decode(df: DataFrame, rank_file: bytes | None = None, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its ``ids`` stand for; null ids of a row give null."""
    if decoded in df.columns:
        raise ValueError(f"there is a column {decoded} already; name another")
    names = df.columns
    at = names.index(ids)
    shared = _share(df.sparkSession, rank_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = tokens(shared.value)
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bytes_of(part.column(at), token), pa.binary())], [*names, decoded])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(decoded, T.BinaryType())]))


def _share(spark: SparkSession, rank_file: bytes | None):
    """The rank file for all tasks; its size is that of the vocabulary."""
    return spark.sparkContext.broadcast(load_ranks() if rank_file is None else rank_file)


def token_report(docs: DataFrame) -> DataFrame:
    coded = encode(docs.select("doc_id", "text"), decoded="decoded")
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op5_byte_bpe")
def op5_byte_bpe(spark, folder):
    return token_report(table(spark, folder, "documents"))
