"""Token ids in Arrow IPC files of fixed-size lists.

The ids of all documents, in ascending order of their ids, are one stream that
is cut into sequences of equal length. A file holds a range of documents as
record batches of ``fixed_size_list`` columns, ``ids`` and ``mask`` (false for the
padding of a file's last sequence), so that any sequence is found by arithmetic
and read from the mapped file without a copy. A second file lists the documents
(id, start in the file, number of ids).

Spark range-partitions the documents, and each task writes its own files under a
temporary name and renames them, so a task that runs twice leaves one result.
The folder must be one that all executors reach; it is opened with
``pyarrow.fs``, so local paths, ``hdfs://`` and object stores work alike.

Cases: a null or empty text has only the end id. A null id sorts first. Rows that
repeat an id follow each other in the order of a hash of their text. Other
columns are not written. An empty table gives no files.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlib.llm.registry import query, table
from martlib.llm.texts import slices
from martlib.session import checkpoint_dir

VOCABULARY = "word_bpe_49k.json"
END = 1  # id after each document
LENGTH = 2_048  # ids in a sequence
SEQUENCES = 256  # sequences in a record batch
REMEMBERED = 1_000_000  # words whose ids a worker keeps, about 200 MB
# Texts for the short way: ASCII and Latin letters whose lower case is one letter. The pieces are those of the tokenizer's own pattern.
LATIN = re.compile("[\\0-\\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]*")
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017f]+|[0-9]|[^\\t-\\r 0-9a-z\u00df-\u00f6\u00f8-\u017f]+")
BREAKS = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^(\w+):/(?!/)", r"\1:///", path)) if ":" in path else (fs.LocalFileSystem(), os.path.abspath(path))


class WordIds:
    """Ids of texts with a tokenizer that works on each word alone.

    Its normaliser and its pattern never reach over ASCII white space and drop
    it, so the ids of a text are those of its words; each new word is encoded by
    the library once. Texts of ASCII and Latin letters are cut by the pattern
    itself, lower-cased; their new words are encoded many in one call and told
    apart by the tokens that end a word.
    """

    def __init__(self, vocabulary: str, kind: np.dtype) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks of an executor share its cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.kind = kind
        words = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(words.values(), default=0) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {"": b""}  # by word, as it stands between white space
        self.pieces: dict[str, bytes] = {}  # by lower-case piece of the pattern

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) + len(self.pieces) > REMEMBERED:
            self.known, self.pieces = {"": b""}, {}
        latin = [bool(LATIN.fullmatch(t)) and "<|" not in t for t in texts]
        parts = [PIECE.findall(t.lower()) if ok else t.translate(BREAKS).split(" ") for t, ok in zip(texts, latin, strict=True)]
        new = [w for w in set(chain.from_iterable(p for p, ok in zip(parts, latin, strict=True) if ok)) if w not in self.pieces]
        for lo in range(0, len(new), 1_000):
            self._learn_pieces(new[lo:lo + 1_000])
        words = [w for w in set(chain.from_iterable(p for p, ok in zip(parts, latin, strict=True) if not ok)) if w not in self.known]
        for lo in range(0, len(words), 10_000):
            self._learn(words[lo:lo + 10_000], self.known)
        return [b"".join(map((self.pieces if ok else self.known).__getitem__, p)) for p, ok in zip(parts, latin, strict=True)]

    def _learn(self, some: list[str], known: dict[str, bytes]) -> None:
        for w, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True):
            known[w] = np.array(e.ids, self.kind).tobytes()

    def _learn_pieces(self, some: list[str]) -> None:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.kind)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(some) or not len(ids) or ends[-1] != len(ids):
            return self._learn(some, self.pieces)
        whole, size, at = ids.tobytes(), self.kind.itemsize, 0
        for w, end in zip(some, ends.tolist(), strict=True):
            self.pieces[w] = whole[at * size:end * size]
            at = end


_encoders: dict[int, WordIds] = {}


def encoder(vocabulary: str, kind: np.dtype) -> WordIds:
    key = hash((vocabulary, kind.str))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = WordIds(vocabulary, kind)
    return _encoders[key]


class Writer:
    """One file of sequences and one of documents, written batch by batch."""

    def __init__(self, folder: str, name: str, kind: np.dtype, length: int, sequences: int) -> None:
        self.fs, self.root = open_folder(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.name, self.kind, self.length, self.batch = name, kind, length, length * sequences
        self.schema = pa.schema([("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))])
        self.temporary = f"{self.root}/_{name}-{uuid.uuid4().hex}"
        self.sink = self.fs.open_output_stream(f"{self.temporary}.ids")
        self.out = pa.ipc.new_file(self.sink, self.schema)
        self.held = bytearray()
        self.ids = 0
        self.docs: list[pa.Table] = []

    def add(self, doc_ids: pa.Array, parts: list[bytes]) -> None:
        sizes = np.array([len(p) // self.kind.itemsize for p in parts], np.int64)
        starts = self.ids + np.cumsum(sizes) - sizes
        self.docs.append(pa.table({"doc_id": doc_ids, "start": starts, "n_tokens": sizes}))
        self.ids += int(sizes.sum())
        for p in parts:
            self.held += p
            while len(self.held) >= self.batch * self.kind.itemsize:
                self._flush(self.batch)

    def _flush(self, n: int) -> None:
        ids = np.frombuffer(bytes(self.held[:n * self.kind.itemsize]), self.kind)
        del self.held[:n * self.kind.itemsize]
        pad = -len(ids) % self.length
        mask = np.ones(len(ids) + pad, bool)
        mask[len(ids):] = False
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (np.pad(ids, (0, pad)), mask)]
        self.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.held:
            self._flush(len(self.held) // self.kind.itemsize)
        self.out.close()
        self.sink.close()
        with self.fs.open_output_stream(f"{self.temporary}.docs") as sink, pa.ipc.new_file(sink, self.docs[0].schema) as out:
            for t in self.docs:
                out.write_table(t)
        for end in ("ids", "docs"):
            self.fs.move(f"{self.temporary}.{end}", f"{self.root}/{self.name}.{end}")


class TokenFile:
    """Random access to the sequences and documents of one file."""

    def __init__(self, folder: str, name: str) -> None:
        files, root = open_folder(folder)
        self.batches = pa.ipc.open_file(self._open(files, f"{root}/{name}.ids"))
        self.docs = pa.ipc.open_file(self._open(files, f"{root}/{name}.docs"))
        self.length = self.batches.schema.field("ids").type.list_size
        self.size = self.batches.get_batch(0).num_rows if self.batches.num_record_batches else 0

    @staticmethod
    def _open(files: fs.FileSystem, path: str) -> pa.NativeFile:
        return pa.memory_map(path) if isinstance(files, fs.LocalFileSystem) else files.open_input_file(path)

    def flat(self, batch: int, column: str = "ids") -> np.ndarray:
        """All values of a column of a batch; ids are a view of the file."""
        return self.batches.get_batch(batch).column(column).values.to_numpy(zero_copy_only=column == "ids")

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and mask of a sequence."""
        at = slice(i % self.size * self.length, (i % self.size + 1) * self.length)
        return self.flat(i // self.size)[at], self.flat(i // self.size, "mask")[at]

    def range(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Ids from ``start`` on, by batch."""
        step = self.size * self.length
        while n > 0:
            part = self.flat(start // step)[start % step:][:n]
            yield part
            start, n = start + len(part), n - len(part)


def write(docs: DataFrame, folder: str, vocabulary: str | None = None, end: int = END, length: int = LENGTH, sequences: int = SEQUENCES) -> list[dict]:
    """Writes the ids of all texts; one row a file with its name, documents, ids and the ids before it.

    The list is as long as there are partitions. Ids take two bytes where the
    vocabulary allows it.
    """
    spark = docs.sparkSession
    with open(vocabulary or public_tokenizers.path(VOCABULARY), encoding="utf-8") as f:
        text = f.read()
    from tokenizers import Tokenizer

    kind = np.dtype("<u2" if Tokenizer.from_str(text).get_vocab_size() <= 1 << 16 and end < 1 << 16 else "<u4")
    shared = spark.sparkContext.broadcast(text)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        words, writer, n, last = encoder(shared.value, kind), None, 0, np.array([end], kind).tobytes()
        for b in batches:
            column = b.column(1).cast(pa.large_string())
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
            for lo, hi in slices(offsets):
                writer = writer or Writer(folder, f"part-{part:06d}", kind, length, sequences)
                writer.add(b.column(0).slice(lo, hi - lo), [p + last for p in words.encode(column.slice(lo, hi - lo).to_pylist())])
                n += hi - lo
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [writer.name], "docs": [n], "ids": [writer.ids]})

    found = sorted(dealt.mapInArrow(run, "part int, name string, docs bigint, ids bigint").collect(), key=lambda r: r["part"])
    before, out = 0, []
    for r in found:
        out.append(r.asDict() | {"before": before})
        before += r["ids"]
    return out


def read_documents(spark, folder: str, files: list[dict]) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files; one task reads a file at a time."""
    if not files:
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    listed = spark.createDataFrame([(f["name"], f["before"]) for f in files], "name string, before long").repartition(len(files))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f = TokenFile(folder, name)
                for i in range(f.docs.num_record_batches):
                    docs = f.docs.get_batch(i)
                    starts, sizes = docs.column("start").to_numpy(), docs.column("n_tokens").to_numpy()
                    sums = np.zeros(docs.num_rows, np.int64)
                    for k, (s, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
                        c = 0
                        for ids in f.range(s, n):
                            c = crc32(ids.astype("<u4").tobytes(), c)
                        sums[k] = c
                    yield pa.RecordBatch.from_arrays([docs.column("doc_id"), pa.array(starts + before), pa.array(sizes), pa.array(sums)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return listed.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


@query("op9_token_files")
def op9_token_files(spark, folder):
    out = f"{checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    return read_documents(spark, out, write(table(spark, folder, "documents"), out))
