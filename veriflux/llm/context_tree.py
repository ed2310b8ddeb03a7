"""Language-model scores by context-tree weighting over bytes.

A text is the bytes of its words, lower case, each word followed by one blank and the last by a line feed, which also
stands for "before the text". The next byte is coded as eight binary decisions; each decision has a context tree of
its own, whose nodes are the last 0 to `depth` bytes. A node mixes its Krichevsky-Trofimov estimate with what its
children say; the weights follow from how well either codes the training texts. A context that training has not seen
is left to the deepest one that it has.

Blocks of documents count their distinct contexts and ask the buckets that hold the trees; a bucket holds all contexts
that end in the same two bytes. Only sums for contexts of at most one byte, 65,280 at the most, go to every bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriflux.llm import blocks as B
from veriflux.llm import words as W

GRAMS, WORDS, TOTALS = 0, 1, 2
FOLD = 1 << 19
END = 10
FIXED = float(1 << 20)  # logarithms are summed as multiples of this fraction, so that the order does not matter
RESULT = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
    "score double, n_bytes bigint, bits_per_byte double"
)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series at x + 7, taken back; x is 0.5 or more."""
    product = x.copy()
    for k in range(1, 7):
        product *= x + k
    z = x + 7
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    a, b = zeros.astype(float), ones.astype(float)
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - np.log(np.pi) - _log_gamma(a + b + 1)


def _grams(texts: W.Texts, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Per byte of the coded texts: its context and itself as one number, latest context byte first; its document."""
    n_words = np.diff(texts.doc)
    empty = np.flatnonzero(n_words == 0)
    starts, ends = (np.insert(x, texts.doc[empty], texts.offsets[empty]) for x in (texts.starts, texts.ends))
    n_words = np.maximum(n_words, 1)
    last = np.cumsum(n_words) - 1
    size = ends - starts + 1
    lead = np.zeros(len(size), np.int64)
    lead[last - n_words + 1] = depth  # room before each text
    stop = np.cumsum(size + lead)
    coded = np.full(stop[-1], END, np.uint8)
    coded[stop - 1] = 32
    coded[stop[last] - 1] = END
    fill = np.zeros(stop[-1] + 1, np.int8)
    fill[stop - size] += 1
    fill[stop - 1] -= 1
    inside = np.zeros(len(texts.data) + 1, np.int8)
    inside[texts.starts] += 1
    inside[texts.ends] -= 1
    coded[np.cumsum(fill[:-1]) > 0] = texts.data[np.cumsum(inside[:-1]) > 0]
    real = np.ones(len(coded), bool)
    first = stop[last] - np.add.reduceat(size, last - n_words + 1) - depth
    for k in range(depth):
        real[first + k] = False
    at = np.flatnonzero(real)
    key = np.zeros(len(at), np.uint64)
    for k in range(1, depth + 1):
        key |= coded[at - k].astype(np.uint64) << np.uint64(8 * (depth + 1 - k))
    key |= coded[at]
    sizes = np.add.reduceat(size, last - n_words + 1)
    return key, np.repeat(np.arange(len(n_words)), sizes)


def _counted(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with summed counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    edge = W.runs(key[order])[:-1]
    return key[order][edge], np.add.reduceat(count[order], edge) if len(edge) else count


def _distinct(values: np.ndarray, counted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, and how often each occurs where `counted` holds."""
    learned, rest = np.sort(values[counted]), W.distinct(values[~counted])
    edge = W.runs(learned)
    return np.concatenate((learned[edge[:-1]], rest)), np.concatenate((np.diff(edge), np.zeros(len(rest), np.int64)))


def _block_keys(table: pa.Table, depth: int) -> Iterator[tuple[W.Texts, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: texts, grams, their documents, word hashes with the end of each text, their documents."""
    end = W.span_hashes(np.array([END], np.uint8), np.array([0]), np.array([1]))
    for c in W.chunks(table.column("text"), lower=True):
        n = len(c.doc) - 1
        words = np.concatenate((c.hashes(), np.repeat(end, n)))
        yield c, *_grams(c, depth), words, np.concatenate((c.owners()[0], np.arange(n)))


def _bucket_hash(grams: np.ndarray, depth: int) -> np.ndarray:
    return W.mix((grams >> np.uint64(8 * (depth - 1))) + np.uint64(1))


def _requests(table: pa.Table, depth: int, buckets: int) -> pa.Table:
    """The distinct contexts and words of a block, with their training counts."""
    table, block = B.in_order(table), B.block_of(table)
    train = ~table.column("held").to_numpy(zero_copy_only=False)
    grams, words = [], []
    for c, key, key_doc, word, word_doc in _block_keys(table, depth):
        learn = train[c.first : c.first + len(c.doc) - 1]
        grams.append(_distinct(key, learn[key_doc]))
        words.append(_distinct(word, learn[word_doc]))
    out = B.Outbox()
    key, n = _counted(*map(list, zip(*grams, strict=True)))
    h = _bucket_hash(key, depth)
    order = np.argsort(h, kind="stable")
    out.spread(buckets, block, GRAMS, h[order], key[order], n[order].astype(np.uint32))
    key, n = _counted(*map(list, zip(*words, strict=True)))
    out.spread(buckets, block, WORDS, key, key, n.astype(np.uint32))
    return out.table()


class _Level:
    """The nodes of one depth: context and place in the byte, counts, logarithm of the weighted probability."""

    def __init__(self, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> None:
        order = np.argsort(key, kind="stable")
        edge = W.runs(key[order])[:-1]
        total = lambda x: np.add.reduceat(x[order], edge) if len(edge) else x
        self.key, self.zeros, self.ones = key[order][edge], total(zeros), total(ones)
        own = _log_kt(self.zeros, self.ones)
        if below is None:
            self.log, self.stay = own, np.ones(len(own))
        else:
            self.log = np.logaddexp(own, total(below)) - np.log(2)
            self.stay = np.exp(own - np.log(2) - self.log)

    def at(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each key, and whether it is there."""
        if not len(self.key):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        k = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return k, self.key[k] == key


def _nodes(grams: np.ndarray, depth: int, level: int, bit: int) -> np.ndarray:
    """Number of the node that decides a bit of the last byte, in the context of the latest `level` bytes."""
    byte = grams & np.uint64(255)
    place = (np.uint64(1) << np.uint64(bit)) | (byte >> np.uint64(8 - bit))
    context = grams >> np.uint64(8 * (depth + 1 - level)) if level else np.zeros_like(grams)
    return (context << np.uint64(8)) | place


def _parent(key: np.ndarray) -> np.ndarray:
    """The same decision with the oldest byte of the context left out."""
    return ((key >> np.uint64(16)) << np.uint64(8)) | (key & np.uint64(255))


def _tree(grams: np.ndarray, counts: np.ndarray, depth: int) -> dict[int, _Level]:
    """The levels from the deepest up to contexts of two bytes."""
    seen = counts > 0
    grams, counts = grams[seen], counts[seen].astype(np.int64)
    key = np.concatenate([_nodes(grams, depth, depth, bit) for bit in range(8)])
    one = np.concatenate([(grams >> np.uint64(7 - bit)) & np.uint64(1) for bit in range(8)]).astype(np.int64)
    n = np.tile(counts, 8)
    levels = {depth: _Level(key, n * (1 - one), n * one, None)}
    for d in range(depth - 1, 1, -1):
        low = levels[d + 1]
        levels[d] = _Level(_parent(low.key), low.zeros, low.ones, low.log)
    return levels


def _totals(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a bucket with their counts over all blocks; messages are folded in as they come."""
    keys, counts, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for _, body in B.messages(table, kind):
        key, n = B.unpack(body, (np.uint64, np.uint32))
        keys.append(key)
        counts.append(n.astype(np.int64))
        held += len(key)
        if held > max(FOLD, len(keys[0])):
            key, n = _counted(keys, counts)
            keys, counts, held = [key], [n], 0
    return _counted(keys, counts)


def _bucket(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams and words of a bucket with their training counts."""
    return *_totals(table, GRAMS), *_totals(table, WORDS)


def _sums(table: pa.Table, depth: int) -> pa.Table:
    """What contexts of at most one byte need from a bucket; node -1 carries training tokens and distinct ones."""
    grams, n, _, m = _bucket(table)
    two = _tree(grams, n, depth)[2]
    out = {
        "node": np.append(_parent(two.key).astype(np.int64), -1), "zeros": np.append(two.zeros, m.sum()),
        "ones": np.append(two.ones, (m > 0).sum()),
        "log": np.append(np.round(two.log * FIXED).astype(np.int64), 0),
    }
    return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})


def _answers(table: pa.Table, sums: pa.Table, depth: int) -> pa.Table:
    """Replies in the order of the requests: log2 probabilities of grams, training counts of words, totals."""
    out = B.Outbox()
    if not table.num_rows:
        return out.table()
    grams, n, words, m = _bucket(table)
    node, zeros, ones, log = (sums.column(k).to_numpy() for k in ("node", "zeros", "ones", "log"))
    low = node >= 0
    levels = _tree(grams, n, depth)
    levels[1] = one = _Level(node[low].astype(np.uint64), zeros[low], ones[low], log[low] / FIXED)
    levels[0] = _Level(_parent(one.key), one.zeros, one.ones, one.log)
    total = np.zeros(len(grams))
    for bit in range(8):
        is_one = ((grams >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        p = np.full(len(grams), np.nan)  # nan: no deeper context was seen
        for d in range(depth, -1, -1):
            level = levels[d]
            k, there = level.at(_nodes(grams, depth, d, bit))
            if not there.any():
                continue
            hits, all_ = np.where(is_one, level.ones[k], level.zeros[k]), level.zeros[k] + level.ones[k]
            own = (hits + 0.5) / (all_ + 1)
            mixed = np.where(np.isnan(p), own, level.stay[k] * own + (1 - level.stay[k]) * p)
            p = np.where(there, mixed, p)
        total += np.log2(np.where(np.isnan(p), 0.5, p))
    bucket = table.column("bucket")[0].as_py()
    for block, body in B.messages(table, GRAMS):
        key, _ = B.unpack(body, (np.uint64, np.uint32))
        out.add(bucket, block, GRAMS, total[np.searchsorted(grams, key)].astype(np.float32))
    end = W.span_hashes(np.array([END], np.uint8), np.array([0]), np.array([1]))
    for block, body in B.messages(table, WORDS):
        key, _ = B.unpack(body, (np.uint64, np.uint32))
        out.add(bucket, block, WORDS, m[np.searchsorted(words, key)])
        if end[0] in key:
            out.add(bucket, block, TOTALS, np.array([zeros[~low].sum()]), np.array([ones[~low].sum()]))
    return out.table()


def _in_bucket_order(replies: pa.Table, kind: int, dtype) -> np.ndarray:
    rows = zip(*(replies.column(n).to_pylist() for n in ("bucket", "kind", "body")), strict=True)
    parts = [B.unpack(body, (dtype,))[0] for _, k, body in sorted(rows, key=lambda r: r[0]) if k == kind]
    return np.concatenate(parts or [np.zeros(0, dtype)])


def _indexed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, sorted, and for each value its place among them."""
    order = np.argsort(values)
    edge = W.runs(values[order])
    place = np.empty(len(values), np.int32)
    place[order] = np.repeat(np.arange(len(edge) - 1, dtype=np.int32), np.diff(edge))
    return values[order[edge[:-1]]], place


def _scores(table: pa.Table, replies: pa.Table, depth: int) -> pa.Table:
    table = B.in_order(table)
    held = []
    for c, key, key_doc, word, word_doc in _block_keys(table, depth):
        n = len(c.doc) - 1
        held.append((n, *_indexed(key), np.bincount(key_doc, minlength=n), *_indexed(word), word_doc, np.diff(c.doc) + 1))
    grams, words = (W.distinct(np.concatenate([h[k] for h in held])) for k in (1, 4))
    bits = np.empty(len(grams))
    bits[np.argsort(_bucket_hash(grams, depth), kind="stable")] = _in_bucket_order(replies, GRAMS, np.float32)
    counts = _in_bucket_order(replies, WORDS, np.int64)
    (tokens, distinct), = [B.unpack(body, (np.int64, np.int64)) for _, body in B.messages(replies, TOTALS)]
    base = np.log10((counts + 0.5) / (tokens[0] + 0.5 * (distinct[0] + 1)))
    got: dict[str, list[np.ndarray]] = {k: [] for k in ("n_tokens", "n_known", "base_score", "score", "n_bytes")}
    for n, gram, key, sizes, distinct_words, word, word_doc, n_tokens in held:
        at = np.searchsorted(words, distinct_words)
        got["n_tokens"].append(n_tokens)
        got["n_known"].append(np.bincount(word_doc, (counts[at] > 0)[word], n).astype(np.int64))
        got["base_score"].append(np.bincount(word_doc, base[at][word], n))
        got["score"].append(np.add.reduceat(bits[np.searchsorted(grams, gram)][key], np.cumsum(sizes) - sizes))
        got["n_bytes"].append(sizes)
    out = {k: np.concatenate(v) for k, v in got.items()}
    rate = -out["score"] / out["n_bytes"]
    return pa.table({
        "doc_id": B.ids_of(table), "held_out": table.column("held"),
        "n_tokens": pa.array(out["n_tokens"], pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
        "train_tokens": pa.array(np.full(table.num_rows, tokens[0]), pa.int64()), "base_score": out["base_score"],
        "score": out["score"] * np.log10(2), "n_bytes": pa.array(out["n_bytes"], pa.int64()), "bits_per_byte": rate,
    })


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = 6) -> DataFrame:
    """Scores every text by a model of those for which `held_out` is not true.

    Columns: doc_id, held_out, n_tokens (words and one end), n_known (tokens that occur in training), train_tokens,
    base_score (log10, smoothed word frequencies), score (log10, context trees), n_bytes, bits_per_byte.

    Null and empty texts consist of the end alone. A null in `held_out` counts as training. Rows with equal or null ids
    are scored each by itself. With no training text every bit has probability one half. An empty table gives no rows;
    other columns are not read. `depth` is the number of context bytes, from 2 to 6.
    """
    if not 2 <= depth <= 6:
        raise ValueError("depth must lie between 2 and 6")
    buckets = B.partitions(docs)
    texts = B.blocked(docs, id_col, text_col, 2 * buckets, held=F.coalesce(held_out, F.lit(False)))
    asked = B.to_buckets(texts.groupBy("block").applyInArrow(lambda t: _requests(t, depth, buckets), B.MESSAGE))
    sums = asked.groupBy("bucket").applyInArrow(lambda t: _sums(t, depth), "node bigint, zeros bigint, ones bigint, log bigint")
    sums = sums.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "log")))
    everywhere = sums.select(F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), "*")
    replies = asked.groupBy("bucket").cogroup(B.to_buckets(everywhere).groupBy("bucket"))
    replies = replies.applyInArrow(lambda t, s: _answers(t, s, depth), B.MESSAGE)
    together = texts.groupBy("block").cogroup(B.to_blocks(replies).groupBy("block"))
    return together.applyInArrow(lambda t, r: _scores(t, r, depth), RESULT)
