"""Word-wise byte-pair encoding with a table of distinct words.

Texts are cut at blanks, tabs and line ends, and each distinct word is encoded once, however often and wherever it occurs.
That is exact for vocabularies whose splitting drops white space, so that no piece reaches from one word into the next;
others are refused.

Chunks of texts become a list of distinct words and the numbers of their words, text by text. Words go to buckets by
hash; a bucket is a range of the table of distinct words: it encodes each word once and sends the ids back to every
chunk that has the word. There the ids are joined to the words by position. Decoding joins ids with the vocabulary's
table of pieces.
"""

from __future__ import annotations

import hashlib
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriflux.llm import blocks as B
from veriflux.llm import words as W

CHUNK_BYTES = 10 << 20  # texts whose words share one list; a longer text is a chunk of its own
MOST_BUCKETS = 1 << 14  # keeps messages long when the input is large: a chunk sends a message to each bucket
ENCODED_AT_ONCE = 1 << 13
TOKENS_AT_ONCE = 1 << 18
ROWS_AT_ONCE = 256
NO_BUCKET = -1
MESSAGE = "chunk binary, bucket int, body binary"
CODEC = "zstd"
RESULT = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _squeeze(*parts: np.ndarray | bytes) -> bytes:
    """Arrays, as planes of their lowest, second, ... bytes, with their lengths in front; compressed."""
    planes = [p if isinstance(p, bytes) else B.pack(p) for p in parts]
    body = np.array([len(p) for p in planes], np.int64).tobytes() + b"".join(planes)
    return len(body).to_bytes(8, "little") + pa.compress(body, CODEC, asbytes=True)


def _unsqueeze(body: bytes, *types) -> list:
    raw = pa.decompress(body[8:], int.from_bytes(body[:8], "little"), CODEC, asbytes=True)
    sizes = np.frombuffer(raw, np.int64, len(types))
    out, at = [], 8 * len(types)
    for size, kind in zip(sizes.tolist(), types, strict=True):
        plane = raw[at : at + size]
        out.append(plane if kind is bytes else B.unpack(plane, (kind,))[0] if size else np.zeros(0, kind))
        at += size
    return out


class Chunk:
    """Texts as numbers of words. `key` names the chunk by its place and its words, so that it is the same only if the
    task that made it got the same rows in the same order."""

    def __init__(self, place: tuple[int, int], ids: list, texts: list[bytes | None], buckets: int) -> None:
        self.ids = ids
        table: dict[bytes, int] = {}
        number = table.setdefault
        numbers = array("I")
        counts = []
        for text in texts:
            words = text.split() if text else ()
            numbers.extend([number(w, len(table)) for w in words])
            counts.append(len(words))
        self.numbers, self.counts = np.frombuffer(numbers, np.uint32), np.array(counts, np.uint32)
        self.words = list(table)
        self.sizes = np.fromiter(map(len, self.words), np.uint32, len(self.words))
        flat = b"".join(self.words)
        ends = np.cumsum(self.sizes, dtype=np.int64)
        hashes = W.span_hashes(np.frombuffer(flat, np.uint8), ends - self.sizes, ends) if len(ends) else np.zeros(0, np.uint64)
        self.bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16)
        digest = hashlib.blake2b(flat, digest_size=16)
        digest.update(self.sizes.tobytes())
        self.key = np.array(place, np.int32).tobytes() + digest.digest()

    def messages(self) -> Iterator[tuple[int, bytes]]:
        """(bucket, its words)."""
        order = np.argsort(self.bucket, kind="stable")
        edges = W.runs(self.bucket[order])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            which = order[a:b]
            yield int(self.bucket[which[0]]), _squeeze(b"".join([self.words[k] for k in which.tolist()]), self.sizes[which])

    def rows(self) -> bytes:
        given = np.array([i is not None for i in self.ids], np.uint8)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        return _squeeze(given, ids, self.counts, self.numbers, self.bucket)


def _chunks(batches: Iterator[pa.RecordBatch], buckets: int, most: int) -> Iterator[Chunk]:
    task, ids, texts, size, made = TaskContext.get().partitionId(), [], [], 0, 0
    for part in (batch.slice(k, ROWS_AT_ONCE) for batch in batches for k in range(0, batch.num_rows, ROWS_AT_ONCE)):
        for i, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
            if texts and size + len(text or b"") > most:
                yield Chunk((task, made), ids, texts, buckets)
                ids, texts, size, made = [], [], 0, made + 1
            ids.append(i)
            texts.append(text)
            size += len(text or b"")
    if texts:
        yield Chunk((task, made), ids, texts, buckets)


def _table(keys: list, numbers: list, bodies: list) -> pa.RecordBatch:
    columns = [pa.array(keys, pa.binary()), pa.array(numbers, pa.int32()), pa.array(bodies, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["chunk", "bucket", "body"])


def _send_words(batches: Iterator[pa.RecordBatch], buckets: int, most: int) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches, buckets, most):
        numbers, bodies = zip(*chunk.messages(), strict=True) if chunk.words else ((), ())
        yield _table([chunk.key] * len(bodies), list(numbers), list(bodies))


def _send_rows(batches: Iterator[pa.RecordBatch], buckets: int, most: int) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches, buckets, most):
        yield _table([chunk.key], [NO_BUCKET], [chunk.rows()])


@lru_cache(maxsize=2)
def load(tokenizer: str):
    """The tokenizer of a file; an error if white space matters to it, or if its added tokens may hold some."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(tokenizer)
    found.no_truncation()
    found.no_padding()
    added = found.get_added_tokens_decoder().values()
    plain = not any(t.lstrip or t.rstrip or t.single_word or t.content.split() != [t.content] for t in added)

    def ids(text: str) -> list[int]:
        return found.encode(text, add_special_tokens=False).ids

    if not plain or ids(" a\t\n b.c ") != ids("a") + ids("b.c"):
        raise ValueError("words can be encoded one by one only if the vocabulary drops white space")
    return found


def _encode(words: list[str], tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """Ids of each word, one behind the other, and their number for each word."""
    ids: list[int] = []
    counts = []
    for k in range(0, len(words), ENCODED_AT_ONCE):
        for found in tokenizer.encode_batch(words[k : k + ENCODED_AT_ONCE], add_special_tokens=False):
            got = found.ids
            ids += got
            counts.append(len(got))
    return np.array(ids, np.uint32), np.array(counts, np.uint32)


def _gather(values: np.ndarray, ends: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches of `values` named by `which`, one behind the other."""
    n = sizes[which].astype(np.int64)
    out = np.cumsum(n)
    total = int(out[-1]) if len(out) else 0
    return values[np.repeat((ends - sizes)[which] - (out - n), n) + np.arange(total)]


def _reply(table: pa.Table, tokenizer) -> pa.Table:
    """Encodes the distinct words of a bucket, and tells each chunk the ids of its words."""
    chunks, bodies = table.column("chunk").to_pylist(), table.column("body").to_pylist()
    known: dict[bytes, int] = {}
    asked = []
    for body in bodies:
        flat, sizes = _unsqueeze(body, bytes, np.uint32)
        ends = np.cumsum(sizes, dtype=np.int64)
        words = [flat[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
        asked.append(np.array([known.setdefault(w, len(known)) for w in words], np.int64))
    ids, sizes = _encode([w.decode() for w in known], tokenizer)
    ids, ends = ids.astype(_narrowest(tokenizer)), np.cumsum(sizes, dtype=np.int64)
    replies = [_squeeze(sizes[which], _gather(ids, ends, sizes, which)) for which in asked]
    return pa.Table.from_batches([_table(chunks, table.column("bucket").to_pylist(), replies)])


def _narrowest(tokenizer) -> type:
    return np.uint16 if tokenizer.get_vocab_size() <= 1 << 16 else np.uint32


def _joined(key: bytes, rows: pa.Table, replies: pa.Table, narrow: type, table: pa.Array | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk with their ids, joined to their words by position, and with their text if there is a table of pieces."""
    for body in rows.column("body").to_pylist():
        given, doc_ids, counts, numbers, bucket = _unsqueeze(body, np.uint8, np.int64, np.uint32, np.uint32, np.uint16)
        order = np.argsort(bucket, kind="stable")
        got = sorted(zip(replies.column("bucket").to_pylist(), replies.column("body").to_pylist(), strict=True))
        if [b for b, _ in got] != np.unique(bucket).tolist():
            raise RuntimeError(f"chunk {key.hex()} has other words than before: its rows came in another order; store them first")
        parts = [_unsqueeze(b, np.uint32, narrow) for _, b in got]
        sizes = np.zeros(len(bucket), np.uint32)
        first = np.zeros(len(bucket), np.int64)
        if parts:
            sizes[order] = in_order = np.concatenate([p[0] for p in parts])
            first[order] = np.cumsum(in_order, dtype=np.int64) - in_order
            ids = np.concatenate([p[1] for p in parts])
        word_ends = np.cumsum(counts, dtype=np.int64)
        a = 0
        while a < len(counts):  # slices of whole rows
            start = int(word_ends[a] - counts[a])
            b = max(a + 1, int(np.searchsorted(word_ends, start + TOKENS_AT_ONCE, "right")))
            which = numbers[start : int(word_ends[b - 1])]
            n = sizes[which].astype(np.int64)
            ends = np.concatenate(([0], np.cumsum(n)))
            at = np.repeat(first[which] - ends[:-1], n) + np.arange(int(ends[-1]))
            flat = pa.array(ids[at].astype(np.int32) if len(at) else np.zeros(0, np.int32), pa.int32())
            offsets = ends[np.concatenate(([0], np.cumsum(counts[a:b], dtype=np.int64)))]
            columns = [pa.array(doc_ids[a:b], pa.int64(), mask=given[a:b] == 0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)]
            columns += [] if table is None else [_texts(columns[1], table)]
            yield pa.RecordBatch.from_arrays(columns, RESULT.names[: len(columns)])
            a = b


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id and ids of each text, as the tokenizers library encodes it with the file `tokenizer`, without special tokens
    added, truncation or padding; with `decoded`, also the text that `decode` gives for the ids, formed where they are joined.

    A null or empty text has no ids. Every row gives one row: repeated rows and ids give repeated results, a null id stays null,
    other columns are left out whatever their names, an empty table gives no rows. Special tokens written in a
    text are recognised, as the library does it.

    Texts are read twice, once for their words and once for their positions, and are not shuffled: two exchanges move the distinct
    words of a chunk and their ids, a third the numbers of its words. Rows have to come in the same order when a task
    is repeated, as they do from files; otherwise the job stops with an error, and the frame has to be stored first."""
    buckets = min(B.partitions(docs), MOST_BUCKETS)
    narrow = _narrowest(load(tokenizer))
    held = _held_pieces(docs, tokenizer) if decoded else None
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    words = rows.mapInArrow(lambda batches: _send_words(batches, buckets, chunk_bytes), MESSAGE)
    replies = B.to_buckets(words).groupBy("bucket").applyInArrow(lambda t: _reply(t, load(tokenizer)), MESSAGE)
    places = rows.mapInArrow(lambda batches: _send_rows(batches, buckets, chunk_bytes), MESSAGE)
    schema = pa.schema(list(RESULT)[: 3 if decoded else 2])

    def join(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            raise RuntimeError(f"chunk {key[0].as_py().hex()} is gone: its rows came in another order; store them first")
        table = pa.array(held.value, pa.string()) if held else None
        return pa.Table.from_batches(_joined(key[0].as_py(), left, right, narrow, table), schema)

    joined = places.groupBy("chunk").cogroup(replies.groupBy("chunk"))
    return joined.applyInArrow(join, "doc_id bigint, ids array<int>" + ", decoded string" * decoded)


def _held_pieces(df: DataFrame, tokenizer: str):
    """The piece of each id, broadcast: the table's size is the vocabulary's."""
    found = load(tokenizer)
    if found.decoder is not None:
        raise ValueError("only vocabularies without a decoder")
    return df.sparkSession.sparkContext.broadcast([found.id_to_token(k) or "" for k in range(found.get_vocab_size())])


def decode(encoded: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns of `encoded`, and the text of its ids, special tokens kept: pieces joined by one blank, as the library
    does it for a file without a decoder (other files are refused).

    The join of ids with pieces is a join against the broadcast vocabulary, whose size is the file's: an id is the
    place of its piece. Null or empty ids give an empty text; an id that the vocabulary lacks is left out, as the library does it."""
    held = _held_pieces(encoded, tokenizer)
    at = encoded.columns.index(ids_col)
    names = [f"c{k}" for k in range(len(encoded.columns) + 1)]
    types = [f.dataType.simpleString() for f in encoded.schema] + ["string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(held.value, pa.string())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _texts(batch.column(at), table)], names)

    found = encoded.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True)))
    return found.select(*(F.col(n).alias(c) for n, c in zip(names, [*encoded.columns, text_col], strict=True)))


def _texts(ids: pa.Array, table: pa.Array) -> pa.Array:
    out = []
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    a = 0
    while a < len(ids):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - lengths[a] + TOKENS_AT_ONCE, "right")))
        part = ids.slice(a, b - a)
        flat = part.flatten()
        known = pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(table)))
        places = pc.if_else(known, flat, None)
        offsets = np.concatenate(([0], np.cumsum(lengths[a:b])))
        if places.null_count:  # the library leaves unknown ids out
            kept = np.concatenate(([0], np.cumsum(known.to_numpy(zero_copy_only=False))))
            offsets, places = kept[offsets], places.drop_null()
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), table.take(places))
        out.append(pc.binary_join(lists, " "))
        a = b
    return pa.chunked_array(out, pa.string()).combine_chunks() if out else pa.array([], pa.string())
