"""Benchmark decontamination by q-gram filtering and banded alignment.

An item occurs in a text if one part of the text can be turned into the item by at most `rate` of its length in edits
(k characters inserted, deleted or replaced). Texts and items are compared as lower-case words joined by one blank. The
q-gram lemma: such a part shares at least m + 1 - q - k q of the item's m + 1 - q q-grams, all within k diagonals of
each other. Shared q-grams are counted in overlapping bands of diagonals, bands that reach the bound are kept, and only
their regions are aligned, within the band.

An item of less than 2 q bytes is allowed no edit. It must occur as it is, and not begin or end inside a word; it is
found by the hash of all its bytes.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriflux.llm import words as W

Q = 10
SHORT = 2 * Q  # items below are searched as they are
RATE = 0.08
SLICE_CHARS = 8 << 20  # benchmark text that is broadcast at a time
SLOTS = 22
FOUND = "doc_id bigint, item_id bigint, start bigint, stop bigint, edits bigint"


def budget(length: int, rate: float = RATE) -> int:
    """Edits allowed for an item: `rate` of its length, but so that at least one shared q-gram remains certain."""
    return max(0, min(int(rate * length), (length - Q) // Q))


class Index:
    """The q-grams of the items of a slice, sorted by hash, with item and position; short items by length and hash."""

    def __init__(self, ids: list[int], items: list[bytes], rate: float) -> None:
        self.ids, self.items = ids, [np.frombuffer(x, np.uint8) for x in items]
        self.edits = np.array([budget(len(x), rate) for x in items], np.int64)
        self.needed = np.array([len(x) + 1 - Q for x in items], np.int64) - Q * self.edits
        hashes = [gram_hashes(x) if len(x) >= SHORT else np.zeros(0, np.uint64) for x in self.items]
        owner = np.repeat(np.arange(len(items)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes])
        all_ = np.concatenate(hashes)
        order = np.argsort(all_, kind="stable")
        self.hash, self.owner, self.place = all_[order], owner[order], place[order]
        self.slots = np.zeros(1 << SLOTS, bool)
        self.slots[self.hash >> np.uint64(64 - SLOTS)] = True
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in sorted({len(x) for x in items if len(x) < SHORT}):
            own = np.array([k for k, x in enumerate(items) if len(x) == size])
            h = W.span_hashes(np.concatenate([self.items[k] for k in own]), size * np.arange(len(own)), size * np.arange(1, len(own) + 1))
            order = np.argsort(h, kind="stable")
            self.short[size] = h[order], own[order]

    def shared(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions in the text, items and positions in the items of all shared q-grams."""
        h = gram_hashes(text)
        at = np.flatnonzero(self.slots[h >> np.uint64(64 - SLOTS)])
        low, high = np.searchsorted(self.hash, h[at], "left"), np.searchsorted(self.hash, h[at], "right")
        n = high - low
        row = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(at, n), self.owner[row], self.place[row]


def gram_hashes(text: np.ndarray) -> np.ndarray:
    if len(text) < Q:
        return np.zeros(0, np.uint64)
    sums, down = W.span_sums(W.BYTE_VALUES[text], W.BYTES)
    return W.mix((sums[Q:] - sums[:-Q]) * down[: len(text) + 1 - Q])


@lru_cache(1)
def _letters() -> np.ndarray:
    """Per code point: whether it is a letter, mark or digit of a script that puts blanks between words."""
    out = np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(0x20000)] + [False])
    for low, high in ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)):
        out[low : high + 1] = False
    return out


def _edges(text: np.ndarray) -> np.ndarray:
    """Per place in the text, its end included: whether a character begins there that isn't in one word with the last."""
    head = np.flatnonzero((text & 0xC0) != 0x80)
    lead, size = text[head].astype(np.int64), np.diff(np.append(head, len(text)))
    code = np.where(lead < 0x80, lead, np.where(lead < 0xE0, lead & 0x1F, np.where(lead < 0xF0, lead & 0x0F, lead & 0x07)))
    for k in (1, 2, 3):
        more = size > k
        code[more] = code[more] << 6 | text[head[more] + k] & 0x3F
    letter = _letters()[np.minimum(code, 0x20000)]
    out = np.zeros(len(text) + 1, bool)
    out[head] = ~(letter & np.append(False, letter[:-1]))
    out[-1] = True
    return out


def _copies(index: Index, text: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(document, item, place in the chunk) of the first copy of each short item in each document."""
    if not index.short or not len(text):
        return
    edge = _edges(text)
    starts = np.flatnonzero(edge[:-1] & (text != 32))
    sums, down = W.span_sums(W.BYTE_VALUES[text], W.BYTES)
    for size, (hashes, own) in index.short.items():
        at = starts[: np.searchsorted(starts, len(text) - size, "right")]
        at = at[edge[at + size]]
        h = W.mix((sums[at + size] - sums[at]) * down[at])
        low, n = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        n -= low
        item, at = own[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())], np.repeat(at, n)
        doc = np.searchsorted(docs, at, "right") - 1
        inside = at + size < docs[doc + 1]
        doc, item, at = doc[inside], item[inside], at[inside]
        _, first = np.unique(doc * len(index.ids) + item, return_index=True)  # places ascend
        yield from zip(doc[first].tolist(), item[first].tolist(), at[first].tolist(), strict=True)


def align(item: np.ndarray, text: np.ndarray, first: int, width: int, most: int) -> tuple[int, int, int] | None:
    """Best alignment of the whole item with a part of the text on diagonals [first, first + width): (edits, start,
    stop), or None beyond `most` edits. Row by row over the band; ties go to the smaller start, then stop."""
    m, far = len(item), 1 << 20
    diagonal = first + np.arange(width)
    cost = np.where((diagonal >= 0) & (diagonal <= len(text)), 0, far)
    start = np.clip(diagonal, 0, len(text))
    steps = np.arange(width)
    for i in range(m):
        at = diagonal + i
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == item[i]
        # Replace or keep along the diagonal; skip the item's character from the next diagonal.
        diag = np.where(inside, cost + ~same, far)
        drop, drop_start = np.append(cost[1:], far) + 1, np.append(start[1:], 0)
        better = (drop < diag) | ((drop == diag) & (drop_start < start))
        cost, start = np.where(better, drop, diag), np.where(better, drop_start, start)
        valid = (at + 1 >= 0) & (at + 1 <= len(text))
        cost = np.where(valid, cost, far)
        # Skip characters of the text: a running minimum over lower diagonals.
        key = (cost - steps) * (far << 12) + start
        best = np.minimum.accumulate(key)
        cost, start = best // (far << 12) + steps, best % (far << 12)
        if cost.min() > most:
            return None
    k = int(np.lexsort((diagonal, start, cost))[0])
    return (int(cost[k]), int(start[k]), int(diagonal[k] + m)) if cost[k] <= most else None


def _regions(index: Index, text: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, first diagonal, width) of the bands that share enough q-grams; diagonals within the chunk."""
    at, item, place = index.shared(text)
    if not len(at):
        return
    doc = np.searchsorted(docs, at, "right") - 1
    within = at + Q <= docs[doc + 1]
    at, item, place, doc = at[within], item[within], place[within], doc[within]
    step = index.edits[item] + 1  # bands of two steps, one step apart: k diagonals always lie within one
    diagonal = at - place + len(text)
    keys = []
    for shift in (0, 1):
        band = diagonal // step - shift
        key = np.stack((doc, item, band), 1)
        keys.append(np.concatenate((key, place[:, None]), 1))
    rows = np.concatenate(keys)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(1)  # each q-gram of the item counts once in a band
    rows = rows[new]
    head = np.ones(len(rows), bool)
    head[1:] = (rows[1:, :3] != rows[:-1, :3]).any(1)
    edge = np.append(np.flatnonzero(head), len(rows))
    enough = np.diff(edge) >= index.needed[rows[edge[:-1], 1]]
    for d, i, band, _ in rows[edge[:-1][enough]].tolist():
        size = int(index.edits[i]) + 1
        yield d, i, band * size - len(text), 2 * size


def _hits(column, index: Index) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, start, stop, edits): the best occurrence of each item in each text."""
    for c in W.chunks(column, lower=True):
        text, _, docs = c.joined()
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for d, i, first, width in _regions(index, text, docs):
            begin, end = int(docs[d]), int(docs[d + 1]) - 1  # without the last blank
            found = align(index.items[i], text[begin:end], first - begin, width, int(index.edits[i]))
            if found and found < best.get((d, i), (1 << 30, 0, 0)):
                best[d, i] = found
        for d, i, at in _copies(index, text, docs):
            best[d, i] = 0, at - int(docs[d]), at - int(docs[d]) + len(index.items[i])
        yield from ((c.first + d, index.ids[i], s, e, k) for (d, i), (k, s, e) in best.items())


def _search(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        got = [(ids[row].as_py(), *hit) for row, *hit in _hits(batch.column("text"), index)]
        columns = zip(*got, strict=True) if got else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.int64()) for x in columns], ["doc_id", "item_id", "start", "stop", "edits"])


def _clean(batches: Iterator[pa.RecordBatch], index: Index, text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        clean = np.ones(batch.num_rows, bool)
        clean[[row for row, *_ in _hits(batch.column(text_at), index)]] = False
        yield batch.filter(pa.array(clean))
    W.give_back()


def normal(text: str | None) -> bytes:
    """Lower-case words joined by one blank."""
    return b" ".join((text or "").encode().translate(W.LOWER.tobytes()).split())


def find_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE,
    slice_chars: int = SLICE_CHARS,
) -> DataFrame:
    """doc_id, item_id, start, stop (of the best part of the normal text, in bytes), edits: the items in each document.

    Null and empty texts hold nothing; items that are null or without a word are left out. Items of any other length are
    searched, so an item of one frequent word is found in most documents. Repeated rows are searched each by itself; null ids stay null. Of several occurrences of an item in
    a document the one with the fewest edits is reported, ties to the first. An empty table on either side gives no rows.

    Documents are neither shuffled nor joined. The benchmark's size is summed first; it is sent to the executors in
    slices of at most `slice_chars`, one pass over the documents for each.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    found = None
    for held in _slices(benchmark, rate, slice_chars):
        hits = rows.mapInArrow(lambda batches, held=held: _search(batches, Index(*held.value)), FOUND)
        found = hits if found is None else found.unionAll(hits)
    return docs.sparkSession.createDataFrame([], FOUND) if found is None else found


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", rate: float = RATE, slice_chars: int = SLICE_CHARS,
) -> DataFrame:
    """The rows of `docs`, all columns as they are, without those that hold an item."""
    at, schema = docs.columns.index(text_col), docs.schema
    for held in _slices(benchmark, rate, slice_chars):
        docs = docs.mapInArrow(lambda batches, held=held: _clean(batches, Index(*held.value), at), schema)
    return docs


def _slices(benchmark: DataFrame, rate: float, slice_chars: int) -> Iterator[Broadcast]:
    """What an index is built from, for one slice of the benchmark after the other."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    slices = max(1, -(-total // slice_chars))
    for k in range(slices):
        mine = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k).orderBy("item_id", "text")
        part = [(r.item_id, normal(r.text)) for r in mine.collect()]
        part = [(i, t) for i, t in part if t]
        if part:
            yield benchmark.sparkSession.sparkContext.broadcast(([i for i, _ in part], [t for _, t in part], rate))
