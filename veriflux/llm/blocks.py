"""Documents in blocks that send messages to buckets and get replies.

A block is a hash class of documents, small enough for one task; a bucket is a range of 64-bit hashes. Blocks reduce
what they hold before they send it, so that no bucket gets more than one entry for a hash from any block, however
often the hash occurs. Both counts follow spark.sql.shuffle.partitions, which has to be set in proportion to the input.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MESSAGE = "bucket int, block int, kind int, body binary"
ENTRY, OWN = 0, 1  # kinds: entries to compare; marks that a block sends to itself


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def blocked(docs: DataFrame, id_col: str, text_col: str, blocks: int, **more: Column) -> DataFrame:
    """Columns block, nul, id, text and more. Rows with equal ids share a block; a null id is replaced by a hash of the
    text and sorts after all others. Shuffles the texts once."""
    text = docs[text_col].cast("string")
    own = docs[id_col].cast("long")
    more = [c.alias(name) for name, c in more.items()]
    rows = docs.select(own.isNull().alias("nul"), F.coalesce(own, F.xxhash64(text)).alias("id"), text.alias("text"), *more)
    block = F.pmod(F.xxhash64("nul", "id"), F.lit(blocks)).cast("int").alias("block")
    return rows.select(block, *rows.columns).repartition(partitions(docs), "block")


def in_order(table: pa.Table) -> pa.Table:
    """Rows by id, null ids last, equal ids by text: the same numbering of documents in every stage."""
    return table.sort_by([("nul", "ascending"), ("id", "ascending"), ("text", "ascending")]).combine_chunks()


def ids_of(table: pa.Table) -> pa.Array:
    """The ids as they were given."""
    return pa.array(table.column("id").to_numpy(), pa.int64(), mask=table.column("nul").to_numpy(zero_copy_only=False))


def block_of(*tables: pa.Table) -> int:
    return next(t.column("block")[0].as_py() for t in tables if t.num_rows)


def bucket_edges(sorted_hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range begins among sorted hashes."""
    bounds = (np.arange(buckets + 1, dtype=np.float64) * (2.0**64 / buckets)).astype(np.float64)
    bounds = np.array([int(b) if b < 2.0**64 else (1 << 64) - 1 for b in bounds], np.uint64)
    edges = np.searchsorted(sorted_hashes, bounds, "left")
    edges[-1] = len(sorted_hashes)
    return edges


def pack(*parts: np.ndarray) -> bytes:
    """Arrays of equal length as byte planes: first all lowest bytes of the first array, and so on. Bytes that are the
    same in all values lie together, so that shuffle compression removes them."""
    return b"".join(p.view(np.uint8).reshape(-1, p.itemsize).T.tobytes() for p in map(np.ascontiguousarray, parts))


def unpack(body: bytes, types: Sequence) -> list[np.ndarray]:
    sizes = [np.dtype(t).itemsize for t in types]
    planes = np.frombuffer(body, np.uint8).reshape(sum(sizes), -1)
    out, at = [], 0
    for size, kind in zip(sizes, types, strict=True):
        out.append(np.ascontiguousarray(planes[at : at + size].T).view(kind).reshape(-1))
        at += size
    return out


class Outbox:
    """Collects messages and gives them out as one Arrow table."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, bucket: int, block: int, kind: int, *parts: np.ndarray) -> None:
        self.rows.append((int(bucket), int(block), kind, pack(*parts)))

    def spread(self, buckets: int, block: int, kind: int, hashes: np.ndarray, *parts: np.ndarray) -> None:
        """Sends the parts of sorted hashes, each range of hashes to its bucket."""
        edges = bucket_edges(hashes, buckets)
        for k in np.flatnonzero(np.diff(edges)):
            self.add(k, block, kind, *(p[edges[k] : edges[k + 1]] for p in parts))

    def table(self) -> pa.Table:
        names = ("bucket", "block", "kind", "body")
        types = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        columns = zip(*self.rows, strict=True) if self.rows else [[]] * 4
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=list(names))


def messages(table: pa.Table, kind: int) -> Iterator[tuple[int, bytes]]:
    """(block, body) of each message of one kind."""
    cols = [table.column(n).to_pylist() for n in ("kind", "block", "body")]
    return ((block, body) for k, block, body in zip(*cols, strict=True) if k == kind)


def gathered(table: pa.Table, kind: int, types: Sequence) -> list[np.ndarray]:
    """The parts of all messages of one kind, joined; the first array names the block of each value."""
    got = [(block, unpack(body, types)) for block, body in messages(table, kind)]
    out = [np.concatenate([np.full(len(parts[0]), block, np.int32) for block, parts in got] or [np.zeros(0, np.int32)])]
    return out + [np.concatenate([parts[k] for _, parts in got] or [np.zeros(0, t)]) for k, t in enumerate(types)]


def to_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition(partitions(rows), "block")


def to_buckets(rows: DataFrame) -> DataFrame:
    return rows.repartition(partitions(rows), "bucket")
