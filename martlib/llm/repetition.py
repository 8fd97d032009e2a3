"""Quality rules on repetition, from suffix arrays over the words of each text.

The suffixes of all documents of a slice are sorted together by prefix doubling;
a word counts with its document, so nothing matches across documents, and only
groups that are not yet told apart are sorted on. The common prefix of
neighbours in that order comes from the saved ranks of the doublings. The longer
of a suffix's two neighbour prefixes is the longest repeat that starts there:
its interval is a maximal repeated substring. The spans of all repeats of at
least ``LEAST`` words are united; their share of the words and the longest
repeat are limited.

Words are compared by 64-bit hashes. Cases: a null text has no words; a text
with fewer than 50 words fails the base rules. Repeated rows get equal answers,
and texts of any length are one suffix array. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from martlib.llm.registry import query, table
from martlib.llm.texts import SPACE, Words, column_bytes, mix, range_hashes, slices, words

LEAST = 6  # words of a repeat that counts
COVERED = 0.4  # share of the words in repeats, at most
LONGEST = 60  # words of a repeat, at most
# The base rules.
FEWEST_WORDS = 50
REPEATED_PERCENT = 50
WINDOW = 3
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def keyed(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within a document."""
    return mix(hashes + mix(docs.astype(np.uint64) + np.uint64(1)))


def group_starts(sorted_keys: np.ndarray) -> np.ndarray:
    """For each place of a sorted array, the first place with its key."""
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(sorted_keys)), 0))


class SuffixArray:
    """Sorted suffixes of the documents of a slice; ``ranks[k]`` orders them by their first ``2**k`` words."""

    def __init__(self, keys: np.ndarray, ends: np.ndarray) -> None:
        n = len(keys)
        self.ends = ends  # for each word, the end of its document
        by = np.argsort(keys, kind="stable")
        rank = np.empty(n, np.int64)
        rank[by] = group_starts(keys[by])
        self.ranks = [rank]
        self.active = [self._shared(rank)]
        width = 1
        while len(self.active[-1]):
            at, rank = self.active[-1], self.ranks[-1]
            ahead = at + width
            inside = ahead < ends[at]
            second = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
            key = rank[at] * (n + 1) + second
            by = np.argsort(key, kind="stable")
            at, key = at[by], key[by]
            new = rank.copy()
            new[at] = rank[at] + group_starts(key) - group_starts(rank[at])
            self.ranks.append(new)
            width *= 2
            self.active.append(self._shared(new, at))

    @staticmethod
    def _shared(rank: np.ndarray, among: np.ndarray | None = None) -> np.ndarray:
        """Suffixes whose rank is not theirs alone."""
        among = np.arange(len(rank)) if among is None else among
        counts = np.bincount(rank[among], minlength=len(rank) + 1)
        return among[counts[rank[among]] > 1]

    def repeats(self, least: int) -> np.ndarray:
        """Length of the longest repeat that starts at each word; 0 where it is shorter than ``least``."""
        n = len(self.ends)
        out = np.zeros(n, np.int64)
        level = min(least.bit_length() - 1, len(self.ranks) - 1)
        near = self.active[level]
        if not len(near):
            return out
        order = near[np.argsort(self.ranks[-1][near])]
        a, b = order[:-1], order[1:]
        same = self.ranks[level][a] == self.ranks[level][b]
        a, b = a[same], b[same]
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            i, j = a + length, b + length
            # equal ranks of suffixes shorter than the width cannot be: the end of a document ranks alone
            fits = (i + (1 << k) <= self.ends[a]) & (j + (1 << k) <= self.ends[b])
            i, j = np.minimum(i, n - 1), np.minimum(j, n - 1)
            length += np.where(fits & (self.ranks[k][i] == self.ranks[k][j]), 1 << k, 0)
        np.maximum.at(out, a, length)
        np.maximum.at(out, b, length)
        out[out < least] = 0
        return out


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in one of the spans."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:n]) > 0


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, w: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their document, by document."""
    docs = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.concatenate([offsets[:-1], breaks + 1])
    ends = np.concatenate([breaks, offsets[1:]])
    doc = np.concatenate([np.arange(docs), np.searchsorted(offsets, breaks, "right") - 1])
    by = np.lexsort((starts, doc))
    starts, doc = starts[by], doc[by]
    ends = ends[np.lexsort((ends, np.concatenate([np.searchsorted(offsets, breaks, "right") - 1, np.arange(docs)])))]
    with_word = np.searchsorted(w.starts, starts) < np.searchsorted(w.starts, ends)
    starts, ends, doc = starts[with_word], ends[with_word], doc[with_word]
    keys = keyed(range_hashes(data, starts, ends), doc)
    _, first = np.unique(keys, return_index=True)
    return np.bincount(doc, minlength=docs) - np.bincount(doc[first], minlength=docs)


def measure(data: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> dict[str, np.ndarray]:
    """The measures of each document of a slice."""
    docs = len(offsets) - 1
    w = words(data, offsets)
    n = len(w.hashes)

    def per_doc(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(mask)])[at])

    out = {"n_words": np.diff(w.first)}
    out["word_chars"] = per_doc(~SPACE[data] & ((data & 0xC0) != 0x80), offsets)
    out["n_symbols"] = per_doc(SYMBOL[data], offsets)
    out["n_dup_lines"] = duplicate_lines(data, offsets, w)
    zero = np.zeros(docs, np.int64)
    out |= {"n_repeat_words": zero, "covered_words": zero, "longest_repeat": zero}
    if not n:
        return out
    ends = w.first[1:][w.docs]
    suffixes = SuffixArray(keyed(w.hashes, w.docs), ends)
    longest = suffixes.repeats(least)
    out["covered_words"] = per_doc(covered(np.flatnonzero(longest), longest[longest > 0], n), w.first)
    top = np.zeros(docs, np.int64)
    np.maximum.at(top, w.docs, longest)
    out["longest_repeat"] = top
    # a window of three words is told by the ranks of its two halves of two words
    two = suffixes.active[1] if len(suffixes.active) > 1 else np.zeros(0, np.int64)
    two = two[two + WINDOW <= ends[two]]
    if len(two):
        key = suffixes.ranks[1][two] * (n + 1) + suffixes.ranks[1][two + 1]
        _, back, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = np.sort(two[count[back] > 1])
        out["n_repeat_words"] = per_doc(covered(hit, np.full(len(hit), WINDOW), n), w.first)
    return out


def repetition(docs: DataFrame, text: str = "text", least: int = LEAST, share: float = COVERED, longest: int = LONGEST) -> DataFrame:
    """``docs`` without their text, with the measures, ``base_failed`` and ``kept``."""
    names = docs.columns
    at = names.index(text)
    others = [c for c in names if c != text]
    if clash := sorted({*others} & {*COLUMNS, "base_failed", "kept"}):
        raise ValueError(f"columns {clash} are results of this operator")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = column_bytes(b.column(at))
            for lo, hi in slices(offsets):
                m = measure(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], least)
                failed = (m["n_words"] < FEWEST_WORDS) | (100 * m["n_repeat_words"] > REPEATED_PERCENT * m["n_words"])
                kept = ~failed & (m["covered_words"] <= share * m["n_words"]) & (m["longest_repeat"] <= longest)
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i, c in enumerate(names) if c != text), *(pa.array(m[c], pa.int64()) for c in COLUMNS), pa.array(failed), pa.array(kept)], [*others, *COLUMNS, "base_failed", "kept"])

    fields = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in COLUMNS), T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType())])
    return docs.mapInArrow(run, schema)


@query("op6_repetition")
def op6_repetition(spark, folder):
    return repetition(table(spark, folder, "documents").select("doc_id", "text"))
