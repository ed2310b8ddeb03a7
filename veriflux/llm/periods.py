"""Periodic runs of words, found by block convolution.

A run is a stretch of words with a period q (words q apart are the same) that holds at least `repeats` periods and that no
neighbouring word extends. At each dyadic scale B, the words are cut into blocks of B; a run whose period lies in
[B, 2B) and that has four periods or more holds a whole block and the place one period behind it. So each block is
compared with the window of 2B - 1 words that begins B behind it, at all distances d in [B, 2B) at once:

    sum over j of (w[s + j] - w[s + d + j])^2

is a sum of squares and a correlation, and the correlation is a product of number-theoretic transforms. Everything is
done modulo primes whose product exceeds the largest possible sum, so a sum is zero exactly where it is zero
modulo each of them. Every zero is a distance at which the block occurs again; it is extended to both sides, word by
word, to the longest stretch with that period.

Two exact rules leave blocks out before the transform. Every word of a block in such a run occurs again within less than
2B words. And a window that lies in a run already found (its period is below B) has only multiples of that period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriflux.llm import words as W

PRIMES = (2013265921, 1811939329, 469762049)  # each is a multiple of 2^26, plus 1
GENERATORS = {2013265921: 31, 1811939329: 13, 469762049: 3}
LONGEST = 1 << 26  # the longest transform that all primes have
BATCH = 1 << 20  # numbers in one batch of transforms
NEVER = np.int64(1) << 62
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

_ROOTS: dict[tuple[int, int, bool], np.ndarray] = {}


def _roots(p: int, size: int, inverse: bool) -> np.ndarray:
    """The powers of a root of unity of the given order, the first half of them."""
    key = (p, size, inverse)
    if key not in _ROOTS:
        root = pow(GENERATORS[p], (p - 1) // size, p)
        root = pow(root, -1, p) if inverse else root
        powers = np.ones(max(1, size // 2), np.uint64)
        done = 1
        while done < len(powers):  # doubles the known powers
            more = min(done, len(powers) - done)
            powers[done : done + more] = powers[:more] * np.uint64(pow(root, done, p)) % np.uint64(p)
            done += more
        if len(_ROOTS) > 200:
            _ROOTS.clear()
        _ROOTS[key] = powers
    return _ROOTS[key]


def _forward(a: np.ndarray, p: int) -> np.ndarray:
    """Transforms each row; the result is in bit-reversed order."""
    rows, size = a.shape
    prime, span = np.uint64(p), size
    while span > 1:
        half = span // 2
        view = a.reshape(rows, -1, span)
        u, v = view[..., :half], view[..., half:]
        total = u + v
        low = (u + (prime - v)) * _roots(p, span, False) % prime
        u[...] = total - prime * (total >= prime)
        v[...] = low
        span = half
    return a


def _back(a: np.ndarray, p: int) -> np.ndarray:
    """The inverse of `_forward`, from bit-reversed to natural order."""
    rows, size = a.shape
    prime, span = np.uint64(p), 2
    while span <= size:
        half = span // 2
        view = a.reshape(rows, -1, span)
        u, v = view[..., :half], view[..., half:] * _roots(p, span, True) % prime
        total, apart = u + v, u + (prime - v)
        view[..., :half] = total - prime * (total >= prime)
        view[..., half:] = apart - prime * (apart >= prime)
        span *= 2
    return a * np.uint64(pow(size, -1, p)) % prime


def squared_differences(x: np.ndarray, y: np.ndarray, p: int) -> np.ndarray:
    """Rows x of B and y of 2B - 1 numbers: for d = 0 .. B - 1 the sum of (x[j] - y[d + j])^2, modulo p."""
    rows, block = x.shape
    size, prime = 2 * block, np.uint64(p)
    x, y = x.astype(np.uint64) % prime, y.astype(np.uint64) % prime
    turned = np.zeros((rows, size), np.uint64)
    turned[:, 0] = x[:, 0]
    turned[:, block + 1 :] = x[:, :0:-1]
    padded = np.zeros((rows, size), np.uint64)
    padded[:, :-1] = y
    products = _back(_forward(turned, p) * _forward(padded, p) % prime, p)[:, :block]
    sums = np.zeros((rows, size), np.uint64)
    np.cumsum(y * y % prime, axis=1, out=sums[:, 1:])
    squares = (sums[:, block:] - sums[:, :block]) % prime + (x * x % prime).sum(1, keepdims=True) % prime
    return (squares + np.uint64(2) * (prime - products)) % prime


def _occurrences(seq: np.ndarray, starts: np.ndarray, block: int, top: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start, distance) of the zero-mismatch places of each block, distances in [block, 2 * block)."""
    if 2 * block > LONGEST:
        raise ValueError(f"a text of more than {4 * LONGEST} words")
    bound, primes = block * top * top, []
    for p in PRIMES:
        primes.append(p)
        if np.prod([float(q) for q in primes]) > 2.0 * bound:
            break
    else:
        raise ValueError("too many different words in one text")
    step = max(1, BATCH // (2 * block))
    inside, behind = np.arange(block), np.arange(block, 3 * block - 1)
    for k in range(0, len(starts), step):
        at = starts[k : k + step]
        x, y = seq[at[:, None] + inside], seq[at[:, None] + behind]
        zero = squared_differences(x, y, primes[0]) == 0
        for p in primes[1:]:
            rows = np.flatnonzero(zero.any(1))
            if len(rows):
                zero[rows] &= squared_differences(x[rows], y[rows], p) == 0
        row, shift = np.nonzero(zero)
        yield at[row], shift + block


def _equal_until(seq: np.ndarray, at: int, d: int, step: int) -> int:
    """Number of places at, at + step, ... from which words d apart are equal; step is 1 or -1."""
    done, width = 0, 64
    while True:
        if step > 0:
            a = seq[at + done : at + done + width]
            b = seq[at + done + d : at + done + d + width]
            differ = np.flatnonzero(a[: len(b)] != b)
        else:
            low = max(0, at - done - width + 1)
            differ = np.flatnonzero((seq[low : at - done + 1] != seq[low + d : at - done + 1 + d])[::-1])
            if not len(differ) and low == 0:
                return at + 1
        if len(differ):
            return done + int(differ[0])
        done, width = done + width, width * 2


def find_runs(numbers: np.ndarray, bounds: np.ndarray, repeats: int = 4, least: int = 6) -> np.ndarray:
    """Runs of texts that lie behind one another: `numbers` names each word, text k has the words bounds[k] up to
    bounds[k + 1]. Gives rows (start, length, period), starts counted from the first word of all, by start and period.
    Periods are smallest ones; a run has at least `repeats` periods (four or more) and `least` words."""
    if repeats < 4:
        raise ValueError("block convolution needs at least four periods")
    texts = len(bounds) - 1
    sizes = np.diff(bounds)
    longest = int(sizes.max()) if texts else 0
    if longest < repeats:
        return np.zeros((0, 3), np.int64)
    # A different separator behind each text and a padding of separators: nothing reaches across them.
    known = int(numbers.max()) + 1
    shift = np.repeat(np.arange(texts), sizes)
    pad = 2 * longest + 3
    seq = np.empty(len(numbers) + texts + pad, np.int64)
    seq[len(numbers) + texts :] = known + texts + np.arange(pad)
    seq[np.arange(len(numbers)) + shift] = numbers
    ends = bounds[1:] + np.arange(texts)  # of each text, in seq
    seq[ends] = known + np.arange(texts)
    total, top = len(numbers) + texts, known + texts + pad

    order = np.argsort(seq[:total], kind="stable")
    gap = np.diff(order)
    again = np.full(total, NEVER)
    same = seq[order[1:]] == seq[order[:-1]]
    again[order[:-1][same]] = gap[same]

    found: dict[tuple[int, int], int] = {}
    block = 1
    while repeats * block <= longest:
        at = np.flatnonzero(again < 2 * block) * block
        stop = ends[np.searchsorted(ends, at, "right")] if len(at) else at
        at, stop = at[at + 2 * block <= stop], stop[at + 2 * block <= stop]
        at = at[_reach(found, at) < np.minimum(at + 3 * block, stop)] if found else at
        if len(at):
            pairs = list(_occurrences(seq, at, block, top))
            starts, apart = (np.concatenate(c) for c in zip(*pairs, strict=True))
            if found:
                fresh = _reach(found, starts) < starts + apart + block
                starts, apart = starts[fresh], apart[fresh]
            order = np.lexsort((starts, apart))
            starts, apart = starts[order], apart[order]
            edges = W.runs(apart)
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                d, left = int(apart[lo]), starts[lo:hi]
                while len(left):  # the first place of each stretch; the others lie within it
                    s = int(left[0])
                    begin = s - _equal_until(seq, s - 1, d, -1) if s else 0
                    end = s + block + _equal_until(seq, s + block, d, 1)
                    if end - begin + d >= max(least, repeats * d):
                        found.setdefault((begin, end + d), d)
                    left = left[np.searchsorted(left, end) :]
        if len(again) < 2:
            break
        again = again[: len(again) // 2 * 2].reshape(-1, 2).max(1)
        block *= 2
    rows = sorted((begin, end - begin, d) for (begin, end), d in found.items())
    out = np.array(rows, np.int64).reshape(-1, 3)
    out[:, 0] -= np.searchsorted(ends, out[:, 0], "right")
    return out


def _reach(found: dict[tuple[int, int], int], at: np.ndarray) -> np.ndarray:
    """Where the run ends that reaches farthest among the known ones that begin at or before each place."""
    spans = np.array(sorted(found), np.int64)
    far = np.maximum.accumulate(spans[:, 1])
    k = np.searchsorted(spans[:, 0], at, "right") - 1
    return np.where(k >= 0, far[np.maximum(k, 0)], -1)


def _collapse(texts: W.Texts, repeats: int, least: int) -> tuple[np.ndarray, list[list[tuple]], list[str]]:
    """Of each document: number of words, runs, text without repetitions."""
    table: dict[bytes, int] = {}
    n = len(texts.offsets) - 1
    each = [w for k in range(n) for w in texts.words_of(k)]
    numbers = np.fromiter((table.setdefault(w, len(table)) for w in each), np.int64, len(each))
    sizes = np.diff(texts.doc)
    found = find_runs(numbers, texts.doc, repeats, least)
    owner = np.searchsorted(texts.doc, found[:, 0], "right") - 1
    runs: list[list[tuple]] = [[] for _ in range(n)]
    cut = np.zeros(len(each) + 1, np.int64)
    np.add.at(cut, found[:, 0] + found[:, 2], 1)
    np.add.at(cut, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(cut[:-1]) == 0
    for k, (start, length, period) in zip(owner.tolist(), found.tolist(), strict=True):
        runs[k].append((start - int(texts.doc[k]), length, period))
    out, begins, _ = texts.joined()
    if not kept.all():
        size = texts.ends - texts.starts + 1
        out = out[np.repeat(kept, size)]
        begins = np.cumsum(np.where(kept, size, 0)) - np.where(kept, size, 0)
    edges = np.append(begins, len(out))[texts.doc]
    joined = [out[a : max(a, b - 1)].tobytes().decode() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    return sizes, runs, joined


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _batches(batches: Iterator[pa.RecordBatch], repeats: int, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for texts in W.chunks(batch.column(1)):
            sizes, runs, joined = _collapse(texts, repeats, least)
            ids = batch.column(0).slice(texts.first, len(sizes))
            columns = [ids, pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(_RUN)), pa.array(joined, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: int = 4, least: int = 6) -> DataFrame:
    """doc_id, n_words, runs, collapsed: the runs of each text, by start and period, words counted from 0, and its words
    joined by one blank, without those that lie in a run behind its first period.

    Words are what `[^\\x20\\x09-\\x0D]+` matches; they are compared byte by byte. A null or empty text has no word, no
    run and an empty result. Every row is judged on its own: repeated rows and ids give repeated results, a null id
    stays null, other columns are left out whatever their names, an empty table gives no rows. No shuffle; a task
    holds one batch of texts, and of these about 1 MB, or one longer text, at a time."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _batches(batches, repeats, least), f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")


def strongest(runs):
    """The run with the greatest exact length / period of an ordered list; the first of equal ones; null if there is none."""
    return F.reduce(runs, F.lit(None).cast(RUNS[len("array<") : -1]), lambda best, run: F.when(
        best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best))
