"""Token ids as flat binary files.

A dataset is a folder of files in ascending order of document id. A file holds, little-endian:

  ids      unsigned integers, the narrowest kind that holds the vocabulary; each document ends with the end id
  padding  to a multiple of eight bytes
  doc_ids  signed 64-bit, one for each document; the lowest number stands for null
  offsets  signed 64-bit, one more than documents: where each begins among the file's ids
  counts   signed 64-bit: documents, ids
  mark     the end id, as Spark's writer puts it behind every record

Where a file begins among all ids follows from the counts of the files before it. `open_file` maps a local file into
memory; `read` reads a dataset on the executors. Spark's own committer publishes the files, so a lost executor leaves
nothing half-written, and any file system that Spark can write to will do.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veriflux.llm import words as W

LETTER, NUMBER, OTHER, BLANK = 0, 1, 2, 3
MEMORY = 1 << 19  # distinct pieces that a worker remembers before it starts afresh
BATCH = 4096
ROWS = 512  # rows whose texts are copied at once
NO_ID = -(1 << 63)
DOCUMENT = "path string, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"


@cache
def _classes() -> np.ndarray:
    """Class of every code point, as the vocabulary's splitting pattern tells them apart."""
    import regex

    points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000)))
    out = np.full(0x110000, OTHER, np.uint8)
    text = "".join(map(chr, points))
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (BLANK, r"\s")):
        out[[ord(c) for c in regex.findall(pattern, text)]] = kind
    return out


CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")  # fixed values of the splitting pattern


def _piece_starts(points: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Where the vocabulary's pattern starts a piece: runs of one class, a single blank taken along in front.

    docs: code-point offsets of the texts. Apostrophe endings are cut off where a piece starts with an apostrophe.
    """
    n = len(points)
    kind = _classes()[points]
    first = np.zeros(n + 1, bool)
    first[docs] = True
    starts = first[:n].copy()
    starts[1:] |= kind[1:] != kind[:-1]
    blank = kind == BLANK
    joins = np.zeros(n, bool)  # a blank that goes with the run after it
    joins[:-1] = (points[:-1] == 32) & ~blank[1:] & ~first[1:n]
    # The last character of a run of white space stands alone when a run of another kind follows in the same text.
    alone = np.zeros(n, bool)
    alone[:-1] = blank[:-1] & ~blank[1:] & ~first[1:n]
    starts |= alone
    after = np.flatnonzero(joins) + 1
    starts[after] = False
    marks = np.flatnonzero((points == 39) & starts)
    if len(marks):
        ends = np.append(np.flatnonzero(first)[1:], n)
        for at in marks.tolist():
            stop = int(ends[np.searchsorted(ends, at, "right")])
            tail = "".join(map(chr, points[at + 1 : min(at + 3, stop)].tolist()))
            ending = next((c for c in CONTRACTIONS if tail.startswith(c)), None)
            if ending:
                starts[at + 1] = False
                after_it = at + 1 + len(ending)
                if after_it < stop and not (starts[after_it] or (after_it and joins[after_it - 1])):
                    starts[after_it] = True
    return starts


class Encoder:
    """Encodes texts as the tokenizer does, piece by piece, and remembers the pieces.

    The tokenizer splits a text by a pattern before it merges, so the ids of a text are those of its pieces. Texts that
    hold one of the tokenizer's added tokens go to it whole.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; more threads only cost memory
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self._forget()

    def _forget(self) -> None:
        self.known, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.begin, self.ids = np.zeros(1, np.int64), np.zeros(0, self.dtype)

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        """Adds the ids of pieces that are new; `known` is kept sorted, `at` tells where the ids of each lie."""
        if len(self.known) + len(hashes) > MEMORY:
            self._forget()
        lengths, ids = [], []
        for k in range(0, len(pieces), BATCH):
            for e in self.tokenizer.encode_batch_fast(pieces[k : k + BATCH], add_special_tokens=False):
                lengths.append(len(e.ids))
                ids += e.ids
        new = np.arange(len(hashes)) + len(self.begin) - 1
        self.begin = np.concatenate((self.begin, self.begin[-1] + np.cumsum(lengths, dtype=np.int64)))
        self.ids = np.concatenate((self.ids, np.array(ids, self.dtype)))
        known, at = np.concatenate((self.known, hashes)), np.concatenate((self.at, new))
        order = np.argsort(known, kind="stable")
        self.known, self.at = known[order], at[order]

    def _missing(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.ones(len(hashes), bool)
        return self.known[np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)] != hashes

    def chunk(self, texts: W.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk, and how many each has."""
        data, offsets = texts.data, texts.offsets
        n = len(offsets) - 1
        raw = data.tobytes()
        if any(token in raw for token in self.added):
            whole = [raw[s:e].decode() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
            ids = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in whole]
            return np.array([i for row in ids for i in row], self.dtype), np.array([len(row) for row in ids], np.int64)
        if not len(data):
            return np.zeros(0, self.dtype), np.zeros(n, np.int64)
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each code point
        points = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32)
        docs = np.searchsorted(lead, offsets)
        at = np.flatnonzero(_piece_starts(points, docs))
        starts = lead[at]
        ends = np.append(starts[1:], len(data))
        hashes = W.span_hashes(data, starts, ends)
        order = np.argsort(hashes, kind="stable")
        edge = W.runs(hashes[order])
        which = order[edge[:-1]]
        distinct = hashes[which]
        new = which[self._missing(distinct)]
        if len(new):
            before = len(self.known)
            self._learn(hashes[new], [raw[s:e].decode() for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            if len(self.known) < before + len(new):  # started afresh
                new = which[self._missing(distinct)]
                self._learn(hashes[new], [raw[s:e].decode() for s, e in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
        row = np.empty(len(hashes), np.int64)
        row[order] = np.repeat(self.at[np.searchsorted(self.known, distinct)], np.diff(edge))
        length = self.begin[row + 1] - self.begin[row]
        stop = np.cumsum(length)
        source = np.arange(stop[-1]) + np.repeat(self.begin[row] - stop + length, length)
        total = np.concatenate(([0], stop))
        sizes = np.diff(total[np.searchsorted(at, docs)])
        return self.ids[source], sizes


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """The records of one file: the ids of each document, then the footer. The writer adds the end id to each."""
    model = encoder(path)
    doc_ids, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        doc_ids.append(pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy(zero_copy_only=False))
        W.give_back()
        for c in (c for k in range(0, batch.num_rows, ROWS) for c in W.chunks(batch.column("text").slice(k, ROWS))):
            ids, n = model.chunk(c)
            sizes.append(n + 1)
            offsets = np.concatenate(([0], np.cumsum(n))).astype(np.int32) * model.dtype.itemsize
            blobs = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ids.tobytes())])
            yield pa.RecordBatch.from_arrays([blobs], ["value"])
    doc_ids, offsets = np.concatenate(doc_ids), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    room = b"\0" * (-int(offsets[-1]) * model.dtype.itemsize % 8)
    footer = room + b"".join(x.astype("<i8").tobytes() for x in (doc_ids, offsets, np.array([len(doc_ids), offsets[-1]])))
    yield pa.RecordBatch.from_arrays([pa.array([footer], pa.binary())], ["value"])


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every whole text and writes a dataset to `folder`, in ascending order of id.

    Null texts count as empty, an empty text gives the end id alone; null ids come first, rows with equal ids stay
    together. An empty table gives files without documents. Other columns are not read. The one shuffle sorts the texts
    by range of id; the tokenizer file has to be at the same path on every machine. The bytes of the end id have to be
    below 128, as the writer puts it out as text.
    """
    spark = docs.sparkSession
    mark = end_id.to_bytes(id_type(Tokenizer.from_file(tokenizer).get_vocab_size()).itemsize, "little")
    if max(mark) > 127:
        raise ValueError("each byte of the end id must be below 128")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    placed = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    records = placed.mapInArrow(lambda batches: _encode(batches, tokenizer, end_id), "value binary")
    # The cast keeps the bytes as they are.
    records.select(F.col("value").cast("string")).write.option("lineSep", mark.decode()).text(folder)


def _parts(content, dtype: np.dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, doc_ids and offsets of a file's bytes; views, not copies."""
    n_docs, n_ids = np.frombuffer(content, "<i8", 2, len(content) - 16 - dtype.itemsize).tolist()
    at = -(-n_ids * dtype.itemsize // 8) * 8
    doc_ids = np.frombuffer(content, "<i8", n_docs, at)
    return np.frombuffer(content, dtype, n_ids), doc_ids, np.frombuffer(content, "<i8", n_docs + 1, at + 8 * n_docs)


def open_file(path: str, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, doc_ids and offsets of a local file, mapped into memory."""
    return _parts(np.memmap(path, np.uint8, "r"), id_type(vocabulary))


def _counts(batches: Iterator[pa.RecordBatch], dtype: np.dtype) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [len(_parts(body.as_buffer(), dtype)[0]) for body in batch.column("content")]
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], ["path", "n"])


def _documents(batches: Iterator[pa.RecordBatch], dtype: np.dtype) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, body in zip(batch.column("path"), batch.column("content"), strict=True):
            ids, doc_ids, offsets = _parts(body.as_buffer(), dtype)
            wide = memoryview(ids.astype("<u4").view(np.uint8))
            crc = [zlib.crc32(wide[s:e]) for s, e in zip((4 * offsets[:-1]).tolist(), (4 * offsets[1:]).tolist(), strict=True)]
            columns = (pa.array(doc_ids, mask=doc_ids == NO_ID), offsets[:-1], np.diff(offsets), np.array(crc, np.int64))
            arrays = [pa.array([path.as_py()] * len(doc_ids), pa.string()), *(pa.array(c, pa.int64()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, ["path", "doc_id", "local", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, folder: str, vocabulary: int) -> DataFrame:
    """One row for each document of a dataset: doc_id, start (ids before it in all files), n_tokens, ids_crc32 (of its
    ids as 32-bit integers), path and local (its place in the file)."""
    dtype = id_type(vocabulary)
    files = spark.read.format("binaryFile").load(folder)
    sizes = files.select("path", "content").mapInArrow(lambda b: _counts(b, dtype), "path string, n bigint")
    # One row for each file, in the order of the numbers in their names: Spark pads these to five digits only.
    before = Window.orderBy(F.regexp_extract("path", r"/part-(\d+)[^/]*$", 1).cast("bigint"), "path").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("path", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = files.select("path", "content").mapInArrow(lambda b: _documents(b, dtype), DOCUMENT)
    found = rows.join(bases, "path")
    return found.select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", "path", "local")
