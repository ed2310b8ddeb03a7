"""Substring deduplication by difference-cover anchors.

Positions modulo 13 that lie in {0, 1, 3, 9} form a difference cover: for any two starts of a repeated passage there
is a shift below 13 after which both lie in the cover. So two equal windows of 20 words share an anchor, eight words
hashed at a cover position, at the same offset; only 4 of 13 positions are hashed. Where an anchor repeats, the
windows around it are extended to full length, compared by 96 hash bits and judged by where they start first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from veriflux.llm import blocks as B
from veriflux.llm import words as W

PERIOD, COVER = 13, (0, 1, 3, 9)  # fixed values: every difference modulo 13 occurs within the cover

RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept string, removed array<struct<start:int,stop:int>>"


def _first_of_runs(sorted_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of runs; per row, whether its run has other rows."""
    edge = W.runs(sorted_hashes)
    n = np.diff(edge)
    return edge[:-1], np.repeat(n > 1, n)


def _anchors(table: pa.Table, width: int, buckets: int) -> pa.Table:
    """Entries (hash, document, position) of one block: one for each hash, and the block's own repeats."""
    table, span, block = B.in_order(table), width - PERIOD + 1, B.block_of(table)
    in_cover = np.isin(np.arange(PERIOD), COVER)
    found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32))]
    for c in W.chunks(table.column("text")):
        owner, pos = c.owners()
        n = np.diff(c.doc)[owner] if len(owner) else owner
        at = np.flatnonzero(in_cover[pos % PERIOD] & (pos + span <= n) & (n >= width))
        if len(at):
            found.append((W.window_hashes(c.hashes(), at, span), (owner[at] + c.first).astype(np.uint32), pos[at].astype(np.uint32)))
    h, idx, pos = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(h, kind="stable")
    h, idx, pos = h[order], idx[order], pos[order]
    first, repeated = _first_of_runs(h)
    out = B.Outbox()
    # 48 hash bits and the bucket tell anchors apart; full windows are compared later.
    out.spread(buckets, block, B.ENTRY, h[first], h[first] >> np.uint64(16), idx[first], pos[first])
    if repeated.any():
        out.add(block % buckets, block, B.OWN, idx[repeated], pos[repeated])
    return out.table()


def _reply(table: pa.Table, block: np.ndarray, idx: np.ndarray, pos: np.ndarray) -> pa.Table:
    """Marks for the blocks that they belong to, those of OWN messages among them."""
    out = B.Outbox()
    order = np.argsort(block, kind="stable")
    block, idx, pos = block[order], idx[order], pos[order]
    edge = W.runs(block)
    for s, e in zip(edge[:-1], edge[1:], strict=True):
        if e > s:
            out.add(0, block[s], B.OWN, idx[s:e], pos[s:e])
    for own, body in B.messages(table, B.OWN):
        out.rows.append((0, own, B.OWN, body))
    return out.table()


def _repeated_anchors(table: pa.Table) -> pa.Table:
    """Tells blocks which of their anchors another block holds too."""
    block, h, idx, pos = B.gathered(table, B.ENTRY, (np.uint64, np.uint32, np.uint32))
    order = np.argsort(h, kind="stable")
    _, repeated = _first_of_runs(h[order])
    hit = order[repeated]
    return _reply(table, block[hit], idx[hit], pos[hit])


def _marks(marks: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    _, idx, pos = B.gathered(marks, B.OWN, (np.uint32, np.uint32))
    return idx.astype(np.int64), pos.astype(np.int64)


def _spread_over(c: W.Texts, idx: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Per word of a chunk, whether one of the ranges [low, high) of word positions of its documents covers it."""
    mine = (idx >= c.first) & (idx < c.first + len(c.doc) - 1)
    doc = idx[mine] - c.first
    begin, end = c.doc[doc], c.doc[doc + 1]
    step = np.zeros(len(c.starts) + 1, np.int64)
    np.add.at(step, np.clip(begin + low[mine], begin, end), 1)
    np.add.at(step, np.clip(begin + high[mine], begin, end), -1)
    return np.cumsum(step[:-1]) > 0


_WINDOW = (np.uint64, np.uint32, np.int64, np.uint8, np.uint32, np.uint32)  # two hashes, id, null id, document, position


def _windows(table: pa.Table, marks: pa.Table, width: int, buckets: int) -> pa.Table:
    """Full windows around repeated anchors: the first of each hash as an entry, the others as the block's repeats."""
    if not table.num_rows or not marks.num_rows:
        return B.Outbox().table()
    table, block, span = B.in_order(table), B.block_of(table), width - PERIOD + 1
    idx, pos = _marks(marks)
    ids, nul = (table.column(n).to_numpy(zero_copy_only=False) for n in ("id", "nul"))
    found = []
    for c in W.chunks(table.column("text")):
        near = _spread_over(c, idx, pos - (width - span), pos + 1)
        owner, place = c.owners()
        at = np.flatnonzero(near)
        at = at[place[at] + width <= np.diff(c.doc)[owner[at]]]
        if len(at):
            h = c.hashes()
            found.append((W.window_hashes(h, at, width), W.window_hashes(h, at, width, 1), owner[at] + c.first, place[at]))
    out = B.Outbox()
    if not found:
        return out.table()
    h1, h2, doc, place = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((h2, h1))  # stable: within equal windows the earliest comes first
    h1, h2, doc, place = h1[order], h2[order], doc[order], place[order]
    first = np.ones(len(h1), bool)
    first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    which = doc[first]
    values = (h1[first], h2[first] >> np.uint64(32), ids[which], nul[which], which, place[first])
    out.spread(buckets, block, B.ENTRY, h1[first], *(v.astype(t) for v, t in zip(values, _WINDOW, strict=True)))
    if not first.all():
        out.add(block % buckets, block, B.OWN, doc[~first].astype(np.uint32), place[~first].astype(np.uint32))
    return out.table()


def _later_windows(table: pa.Table) -> pa.Table:
    """Tells blocks which of their windows start earlier in another block."""
    block, *parts = B.gathered(table, B.ENTRY, _WINDOW)
    order = np.argsort(parts[0], kind="stable")
    _, repeated = _first_of_runs(parts[0][order])
    k = order[repeated]
    block, (h1, h2, ids, nul, idx, pos) = block[k], (p[k] for p in parts)
    order = np.lexsort((pos, idx, ids, nul, h2, h1))
    later = np.zeros(len(h1), bool)
    later[1:] = (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    k = order[later]
    return _reply(table, block[k], idx[k], pos[k])


def _cut(table: pa.Table, marks: pa.Table, width: int) -> pa.Table:
    """Removes the words that marked windows cover."""
    table = B.in_order(table)
    idx, pos = _marks(marks)
    n_words, n_removed, kept, removed = [], [], [], []
    for c in W.chunks(table.column("text")):
        gone = _spread_over(c, idx, pos, pos + width)
        for k, (s, e) in enumerate(zip(c.doc[:-1], c.doc[1:], strict=True)):
            words, cut = c.words_of(k), gone[s:e]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], cut.astype(np.int8), [0])))).reshape(-1, 2).tolist()
            left, at = [], 0
            for a, b in edges:
                left += words[at:a]
                at = b
            left += words[at:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(left))
            kept.append(b" ".join(left))
            removed.append([{"start": a, "stop": b} for a, b in edges])
    span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    return pa.table({
        "doc_id": B.ids_of(table), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
        "kept": pa.array(kept, pa.binary()).cast(pa.string()), "removed": pa.array(removed, span),
    })


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20) -> DataFrame:
    """Removes each word that lies in a window of `width` words which also starts earlier.

    Earlier means in a document with a smaller id, or in the same document at a smaller position. Windows are judged
    on the input. Columns: doc_id, n_words, n_removed, kept (kept words, joined by one blank), removed (word ranges).

    Null and empty texts have no words and are kept as they are; documents of fewer than `width` words lose nothing.
    Documents without an id come after all others, in the order of a hash of their text. Rows that share an id are
    ordered by their text; of full copies of a row one keeps its words. Other columns are not read. `width` has to be
    at least 13, the period of the cover.

    The texts are shuffled once and read three times; what travels besides them is one entry for each distinct
    anchor or window of a block, and the marks that come back.
    """
    if width < PERIOD:
        raise ValueError(f"width must be at least {PERIOD}")
    n = B.partitions(docs)
    count = 2 * n
    texts = B.blocked(docs, id_col, text_col, count)
    anchors = texts.groupBy("block").applyInArrow(lambda t: _anchors(t, width, count), B.MESSAGE)
    marks = B.to_buckets(anchors).groupBy("bucket").applyInArrow(_repeated_anchors, B.MESSAGE)
    marks = B.to_blocks(marks.drop("bucket"))
    windows = texts.groupBy("block").cogroup(marks.groupBy("block"))
    windows = windows.applyInArrow(lambda t, m: _windows(t, _with_bucket(m), width, count), B.MESSAGE)
    later = B.to_buckets(windows).groupBy("bucket").applyInArrow(_later_windows, B.MESSAGE)
    later = B.to_blocks(later.drop("bucket"))
    return texts.groupBy("block").cogroup(later.groupBy("block")).applyInArrow(lambda t, m: _cut(t, _with_bucket(m), width), RESULT)


def _with_bucket(marks: pa.Table) -> pa.Table:
    return marks.add_column(0, "bucket", pa.array(np.zeros(marks.num_rows, np.int32)))
