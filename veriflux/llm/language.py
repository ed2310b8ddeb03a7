"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets a language. Features of a word are its letters n-grams with word borders (so prefixes and
suffixes among them) and the whole word, hashed into a fixed number of weights for each language; a matrix of
transitions is learned with them. Forward-backward gives each word's probabilities; a text's are their mean. Chains
break every SEGMENT words, so that many of them are computed side by side; the words beside a break still count.

The model is fitted on the driver from a bounded sample of labelled rows (SAMPLE rows at the most, about as many for
each language) and has a fixed size; predictions cover all words of all texts and run where the rows are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriflux.llm import words as W

SAMPLE = 1200
SEGMENT = 64
SLOTS = 1 << 17
ORDERS = (1, 2, 3, 4)  # n-grams in bytes, the blanks around a word included
EPOCHS, RATE, BATCH, DECAY = 3, 0.3, 512, 1e-6


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # slots x languages
    transitions: np.ndarray  # from x to, logarithms


class WordTypes:
    """The distinct words of a chunk and their feature slots; `of` is each word's type."""

    def __init__(self, c: W.Texts) -> None:
        text, begins, self.docs = c.joined()
        self.n_words = np.diff(c.doc)
        hashes = c.hashes()
        order = np.argsort(hashes, kind="stable")
        edge = W.runs(hashes[order])
        self.of = np.empty(len(hashes), np.int64)
        self.of[order] = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
        first = order[edge[:-1]]
        size = (c.ends - c.starts)[first]
        # Each type as blank, bytes, blank; a byte is a letter if it is one in ASCII or part of a longer code point.
        stop = np.cumsum(size + 2)
        flat = np.full(int(stop[-1]) if len(stop) else 0, 32, np.uint8)
        source = np.repeat(begins[first] - stop + size + 1, size) + (inner := np.flatnonzero(_inner(size, stop, len(flat))))
        flat[inner] = text[source]
        low = flat | 0x20
        letter = ((low >= 97) & (low <= 122)) | (flat >= 0x80)
        owner = np.repeat(np.arange(len(size)), size + 2)
        self.lettered = np.bincount(owner[letter], minlength=len(size)) > 0
        slots, owners = [(W.mix(hashes[first]) % np.uint64(SLOTS)).astype(np.int64)], [np.arange(len(size))]
        sums, down = W.span_sums(W.BYTE_VALUES[flat], W.BYTES)
        for n in ORDERS:
            at = np.arange(max(0, len(flat) + 1 - n))
            at = at[owner[at] == owner[at + n - 1]]
            if n == 1:
                at = at[letter[at]]
            h = W.mix((sums[at + n] - sums[at]) * down[at] + np.uint64(n))
            slots.append((h % np.uint64(SLOTS)).astype(np.int64))
            owners.append(owner[at])
        slot, own = np.concatenate(slots), np.concatenate(owners)
        keep = self.lettered[own]
        self.slot, self.owner = slot[keep], own[keep]

    def emissions(self, weights: np.ndarray) -> np.ndarray:
        """Per type and language; a mean over features, so that long words don't drown the others."""
        n = len(self.lettered)
        return np.stack([np.bincount(self.owner, weights[self.slot, k], n) for k in range(weights.shape[1])], 1) / self.share[:, None]

    @property
    def share(self) -> np.ndarray:
        return np.sqrt(np.maximum(1, np.bincount(self.owner, minlength=len(self.lettered))))


def _inner(size: np.ndarray, stop: np.ndarray, total: int) -> np.ndarray:
    inner = np.ones(total, bool)
    inner[stop - 1] = False
    inner[stop - size - 2] = False
    return inner


def _segments(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and length of each chain."""
    begin = np.concatenate(([0], np.cumsum(n_words)))
    pieces = -(-n_words // SEGMENT)
    doc = np.repeat(np.arange(len(n_words)), pieces)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = begin[doc] + nth * SEGMENT
    return start, np.minimum(SEGMENT, begin[doc + 1] - start)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word probabilities (chains x steps x languages), and expected transitions summed over all chains. Scores are
    logarithms; steps beyond a chain's length are left as they come and have to be ignored."""
    emit = np.exp(scores - scores.max(2, keepdims=True))
    move = np.exp(transitions)
    n, steps, k = emit.shape
    ahead, behind = np.empty_like(emit), np.ones_like(emit)
    at = emit[:, 0]
    ahead[:, 0] = at / at.sum(1, keepdims=True)
    for t in range(1, steps):
        at = (ahead[:, t - 1] @ move) * emit[:, t]
        ahead[:, t] = at / at.sum(1, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(steps - 2, -1, -1):
        weight = behind[:, t + 1] * emit[:, t + 1]
        live = lengths > t + 1
        back = weight @ move.T
        behind[:, t] = np.where(live[:, None], back / back.sum(1, keepdims=True), 1.0)
        joint = ahead[live, t][:, :, None] * move * weight[live][:, None, :]
        if len(joint):
            pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    marginals = ahead * behind
    return marginals / marginals.sum(2, keepdims=True), pairs


def _padded(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (chains x steps), and which of them are real."""
    steps = np.arange(int(length.max()) if len(length) else 1)
    real = steps < length[:, None]
    return np.where(real, start[:, None] + steps, 0), real


def fit(texts: list[str], languages: list[str], seed: int = 1) -> Model:
    """Maximum likelihood by adaptive gradient steps; every word of a text carries the text's language."""
    names = sorted(set(languages))
    gold = np.array([names.index(x) for x in languages])
    k = len(names)
    weights, squares = np.zeros((SLOTS, k)), np.full((SLOTS, k), 1e-8)
    transitions, move_squares = np.zeros((k, k)), np.full((k, k), 1e-8)
    chunks = []
    for c in W.chunks(pa.array(texts, pa.string()), lower=True):
        types = WordTypes(c)
        start, length = _segments(types.n_words)
        label = np.repeat(gold[c.first : c.first + len(types.n_words)], -(-types.n_words // SEGMENT))
        chunks.append((types, start, length, label))
    random = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for types, start, length, label in chunks:
            order = random.permutation(len(start))
            for s in range(0, len(order), BATCH):
                pick = order[s : s + BATCH]
                word, real = _padded(start[pick], length[pick])
                share = types.share
                kind = types.of[word]
                emissions = types.emissions(weights)[kind]
                marginals, pairs = forward_backward(emissions, length[pick], transitions)
                error = -marginals
                np.put_along_axis(error, np.broadcast_to(label[pick][:, None, None], (*word.shape, 1)), np.take_along_axis(error, np.broadcast_to(label[pick][:, None, None], (*word.shape, 1)), 2) + 1, 2)
                error[~real] = 0
                total = real.sum()
                by_type = np.stack([np.bincount(kind.ravel(), error[:, :, j].ravel(), len(share)) for j in range(k)], 1) / share[:, None]
                step = np.stack([np.bincount(types.slot, by_type[types.owner, j], SLOTS) for j in range(k)], 1) / total - DECAY * weights
                squares += step**2
                weights += RATE * step / np.sqrt(squares)
                seen = np.bincount(label[pick], (length[pick] - 1).astype(float), k)
                change = (np.diag(seen) - pairs) / total
                move_squares += change**2
                transitions += RATE * 0.1 * change / np.sqrt(move_squares)
    return Model(names, weights.astype(np.float32), transitions)


def _has_letter(text: np.ndarray) -> bool:
    low = text | 0x20
    if ((low >= 97) & (low <= 122)).any():
        return True
    return (text >= 0x80).any() and any(ch.isalpha() for ch in text.tobytes().decode())


def shares(model: Model, c: W.Texts) -> np.ndarray:
    """Per document of a chunk: mean probability of each language over its words with letters; nan without a letter."""
    n, k = len(c.doc) - 1, len(model.languages)
    out = np.full((n, k), np.nan)
    if not k:
        return out
    types = WordTypes(c)
    if len(types.of):
        emissions = types.emissions(model.weights)
        start, length = _segments(types.n_words)
        marginals = np.empty((len(types.of), k))
        for s in range(0, len(start), 2048):
            word, real = _padded(start[s : s + 2048], length[s : s + 2048])
            got, _ = forward_backward(emissions[types.of[word]], length[s : s + 2048], model.transitions)
            marginals[word[real]] = got[real]
        counted = types.lettered[types.of].astype(float)
        doc = np.repeat(np.arange(n), types.n_words)
        total = np.bincount(doc, counted, n)
        summed = np.stack([np.bincount(doc, marginals[:, j] * counted, n) for j in range(k)], 1)
        real = total > 0
        out[real] = summed[real] / total[real, None]
    for d in range(n):
        if not np.isnan(out[d, 0]) and not _has_letter(c.data[c.offsets[d] : c.offsets[d + 1]]):
            out[d] = np.nan
    return out


def _predict(batches: Iterator[pa.RecordBatch], model: Model, text_at: int) -> Iterator[pa.RecordBatch]:
    """The rows as they came, with a language and a score at the end."""
    names = np.array([*model.languages, "und"], object)
    for batch in batches:
        got = [shares(model, c) for c in W.chunks(batch.column(text_at), lower=True)]
        p = np.concatenate(got) if got else np.zeros((0, len(model.languages)))
        unknown = np.isnan(p).any(1) if p.shape[1] else np.ones(len(p), bool)
        p = np.where(unknown[:, None], 0.0, p)
        best = np.where(unknown, len(model.languages), p.argmax(1) if p.shape[1] else 0)
        score = np.clip(p.max(1), 0.0, 1.0) if p.shape[1] else np.zeros(len(p))
        columns = [*batch.columns, pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, [f"c{k}" for k in range(len(columns))])
    W.give_back()


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Fits a model from rows with a language and a text; a sample of `sample` rows at the most, drawn by a hash of the
    text, with about the same share for each language."""
    rows = docs.select(docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang")).dropna()
    counts = {r.lang: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(sample).collect()}
    if not counts:
        return Model([], np.zeros((SLOTS, 0), np.float32), np.zeros((0, 0)))
    quota = max(1, sample // len(counts))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)
    chance = F.element_at(F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, quota / n))), F.col("lang"))
    drawn = rows.filter(place < F.coalesce(chance, F.lit(0.0))).orderBy(F.xxhash64("text"), "text", "lang").limit(sample).collect()
    return fit([r.text for r in drawn], [r.lang for r in drawn])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for each row; a learned language, or `und` with score 0 where the text is null or has no
    letter, or nothing was learned. Only the text is read for it; ids may be null or repeat. An empty table gives no
    rows. Ties go to the language that comes first by code point."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return _classified(rows, model, 1).select(F.col("c0").alias("doc_id"), F.col("c2").alias("lang_pred"), F.col("c3").alias("score"))


def _classified(rows: DataFrame, model: Model, text_at: int) -> DataFrame:
    """Columns c0, c1, ... of the rows, then language and score."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    types = [f.dataType.simpleString() for f in rows.schema] + ["string", "double"]
    return rows.mapInArrow(lambda batches: _predict(batches, held.value, text_at), ", ".join(f"c{k} {t}" for k, t in enumerate(types)))


def keep_identified(docs: DataFrame, model: Model, least: float = 0.4, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns as they are, without those that have no language (`und`) or whose words lie so
    far apart that no language gets a share of `least`."""
    n = len(docs.columns)
    found = _classified(docs, model, docs.columns.index(text_col))
    kept = found.filter((F.col(f"c{n}") != "und") & (F.col(f"c{n + 1}") >= least))
    return kept.select(*(F.col(f"c{k}").alias(name) for k, name in enumerate(docs.columns)))


def is_held_out(id_: Column) -> Column:
    return F.coalesce(F.crc32(id_.cast("string")) % 4 == 2, F.lit(False))
