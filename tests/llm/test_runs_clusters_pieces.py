"""Periodic runs, centroid clustering and word-wise pieces against plain versions of what they compute."""

import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veriflux.llm import centroids, metric_tree, periods, queries, word_pieces

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(30_000))
SCHEMA = "doc_id long, text string, runs string, block int, chunk string, vector string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with internal ones."""
    texts = [
        (1, "a b " * 9 + "c"), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (6, LONG), (6, LONG), (7, "x " * 50_000), (8, "x y x y x y x"), (8, "x y x y x y x y"),
        (None, "ha " * 8), (None, None), (9, "x"), (10, "a a a a a"), (11, "a a a a a a"), (12, "Über élan 日本 <|endoftext|> don't 'll ½\x0bIİẞΣ"), (13, "ab" * 40_000),
        (14, "<|ENDOFTEXT|>a<|startoftext|>b\x85c\xa0d é ́ \x1c\x00"), (-5, "u v w " * 7 + "u v w x " * 7), (15, "\U0001f600 x‍y"),
    ]
    return spark.createDataFrame([(i, t, "q", 1, None, "v") for i, t in texts], SCHEMA)


def plain_runs(w, repeats=4, least=6):
    found = {}
    for q in range(1, len(w) // repeats + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def with_loop(w, rng):
    if w and rng.random() < 0.6:
        a = rng.randrange(len(w))
        p = 1 + rng.randrange(max(1, (len(w) - a) // 3))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = 0
    return w


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_plain_search(seed):
    rng = random.Random(seed)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(0, 5)):
            n, kinds = rng.randint(0, rng.choice([3, 20, 90, 400])), rng.choice([1, 2, 2, 3, 30])
            texts.append(with_loop([rng.randrange(kinds) for _ in range(n)], rng))
        bounds = np.cumsum([0] + [len(t) for t in texts])
        got = periods.find_runs(np.array([x for t in texts for x in t], np.int64), bounds)
        want = sorted((s + int(b), n, q) for t, b in zip(texts, bounds, strict=False) for s, n, q in plain_runs(t))
        assert [tuple(r) for r in got.tolist()] == want


@pytest.mark.parametrize("block", [1, 2, 8, 128])
@pytest.mark.parametrize("p", periods.PRIMES)
def test_transforms_give_squared_differences(block, p):
    rng = np.random.default_rng(block)
    x, y = rng.integers(0, 1 << 28, (3, block)), rng.integers(0, 1 << 28, (3, 2 * block - 1))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x[r], y[r, d:], strict=False)) % p for d in range(block)] for r in range(3)]
    assert periods.squared_differences(x, y, p).tolist() == want


def test_runs_of_odd_rows(spark, odd):
    got = periods.collapse_runs(odd).collect()
    rows = [(r.doc_id, WORD.findall(r.text or "")) for r in odd.select("doc_id", "text").collect()]
    want = []
    for i, w in rows:
        runs = plain_runs(w) if len(w) < 1000 else [(0, len(w), 1)] if len(set(w)) == 1 else []
        want.append((i, len(w), runs, collapsed(w, runs)))
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in got)
    assert periods.collapse_runs(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.find_runs(np.zeros(9, np.int64), np.array([0, 9]), repeats=3)


def test_runs_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in docs:
        w = WORD.findall(r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w)
        best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        want[r.doc_id] = (len(runs), *best, milli, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(collapsed(w, runs)))
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert got == want
    assert sum(v[0] > 0 for v in want.values()) > 5


def plain_clusters(rows, k, rounds):
    """Rows (id, integer components) in seeding order."""
    centres = [list(v) for _, v in rows[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        where = [nearest(v)[1] for _, v in rows]
        for j in range(len(centres)):
            mine = [v for (_, v), w in zip(rows, where, strict=True) if w == j]
            if mine:
                centres[j] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    found = [(i, *nearest(v)[::-1]) for i, v in rows]
    return [(i, j, d, sum(e for _, m, e in found if m == j), sum(e for *_, e in found), centres[j]) for i, j, d in found]


def test_clusters_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    made = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 4]) for i in range(300)]  # a coarse grid: many ties
    made += [made[5]] * 40 + [(None, [0.5, 0.25, 0.0, -0.25])]
    bad = [(900, None), (901, [1.0, 2.0, 3.0]), (902, [1.0, None, 3.0, 4.0]), (903, [1.0, math.nan, 3.0, 4.0]), (904, [math.inf, 0.0, 0.0, 0.0]), (905, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in made + bad], "vec_id long, embedding array<float>, cluster int, vector string")
    vectors = centroids.whole_vectors(df.repartition(5), 4)
    got = centroids.cluster(vectors, 12, 3, 4, F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256))
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in made]
    rows.sort(key=lambda r: (r[0] is None, sha(f"2:{r[0]}"), r[0]))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, plain_clusters(rows, 12, 3)))
    assert centroids.cluster(vectors.limit(0), 12, 3, 4, F.lit("")).count() == 0
    few = centroids.cluster(vectors.limit(3), 12, 2, 4, F.col("vec_id"))
    assert {r.cluster for r in few.collect()} <= {0, 1, 2}
    huge = spark.createDataFrame([(1, [1e30] * 4), (2, [0.0] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(centroids.whole_vectors(huge, 4), 2, 1, 4, F.col("vec_id")).collect()


@pytest.mark.parametrize("k", [1, 3, 5, 40, 300])
def test_tree_search_equals_all_distances(k):
    rng = np.random.default_rng(k)
    for spread in (1, 6, 100_000):
        centres = rng.integers(-spread, spread + 1, (k, 6))
        rows = rng.integers(-spread, spread + 1, (500, 6))
        apart = ((rows[:, None, :] - centres) ** 2).sum(2)
        number, best = centroids.VantageTree(centres).nearest(rows)
        assert (best == apart.min(1)).all() and (number == apart.argmin(1)).all()


PATH = public_tokenizers.path(queries.WORD_TOKENIZER)


def check_pieces(df, coded):
    library = Tokenizer.from_file(PATH)
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, ids, library.decode(ids, skip_special_tokens=False)))
    got = [(r.doc_id, r.ids, r.decoded) for r in coded.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("size", [1 << 12, 32 << 20])
def test_pieces_equal_the_library(spark, odd, size):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (odd, docs):
        rows = df.repartition(3, "doc_id").cache()
        check_pieces(rows, word_pieces.encode(rows, PATH, decoded=True, chunk_bytes=size))
        check_pieces(rows, word_pieces.decode(word_pieces.encode(rows, PATH, chunk_bytes=size), PATH))
        rows.unpersist()


def test_chunks_carry_all_words():
    """One chunk and its replies, without Spark."""
    texts = ["the cat sat", None, "", "the dog <|endoftext|> sat sat", "x" * 5000]
    ids = [4, None, 6, 7, 7]
    tokenizer = word_pieces.load(PATH)
    chunk = word_pieces.Chunk((0, 0), ids, [t and t.encode() for t in texts], 3)
    sent = list(chunk.messages())
    assert {b for b, _ in sent} <= {0, 1, 2}
    replies = [word_pieces._reply(pa.Table.from_batches([word_pieces._table([chunk.key], [b], [body])]), tokenizer) for b, body in sent]
    rows = pa.Table.from_batches([word_pieces._table([chunk.key], [word_pieces.NO_BUCKET], [chunk.rows()])])
    got = [r for batch in word_pieces._joined(chunk.key, rows, pa.concat_tables(replies), np.uint16) for r in batch.to_pylist()]
    library = Tokenizer.from_file(PATH)
    assert got == [{"doc_id": i, "ids": library.encode(t or "", add_special_tokens=False).ids} for i, t in zip(ids, texts, strict=True)]
    with pytest.raises(RuntimeError, match="another order"):
        list(word_pieces._joined(chunk.key, rows, pa.concat_tables(replies[1:]), np.uint16))


def test_pieces_of_other_vocabularies_and_ids(spark, odd):
    with pytest.raises(ValueError, match="white space"):
        word_pieces.encode(odd, public_tokenizers.path("byte_bpe_50k.json"))
    assert word_pieces.encode(odd.limit(0), PATH).count() == 0
    rows = spark.createDataFrame([(1, [320, 10**6, -1, 49407], "a"), (2, None, "b"), (3, [], "c")], "k int, ids array<int>, c1 string")
    got = {r.k: r.decoded for r in word_pieces.decode(rows, PATH).collect()}
    assert got == {1: Tokenizer.from_file(PATH).decode([320, 49407], skip_special_tokens=False), 2: "", 3: ""}


def test_pieces_query_equals_the_library(spark):
    library = Tokenizer.from_file(PATH)
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        want.add((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert {tuple(r) for r in queries.op13_word_pieces(spark, SF).collect()} == want


def test_vector_search_of_odd_rows(spark):
    """Ties, repeated rows and ids, several lengths, empty vectors, nulls, large components, many parts and trees."""
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 3, 3)]) for i in range(400)]
    rows += [(7, [1.0, 0.0, 2.0]), (8, rows[8][1]), (8, rows[8][1]), (None, [1.0, 1.0, 1.0]), (500, None), (501, [None, 1.0, 1.0]), (502, [math.nan, 0.0, 0.0])]
    rows += [(600 + i, [float(i % 4)] * 2) for i in range(20)] + [(700, []), (701, [])]
    df = spark.createDataFrame([(i, v, 1, 0) for i, v in rows], "vec_id long, vector array<double>, part int, tree int")
    asked = F.col("vec_id") % 10 == 0
    got = metric_tree.top_inner_products(df, asked, tree_rows=90, task_queries=11).collect()
    usable = [(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i, v in sorted({r for r in usable if r[0] % 10 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in usable if j != i and len(w) == len(v))
        want += [(i, n, j, int(-s)) for n, (s, j) in enumerate(scored[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    large = [[2.0**29 + i, 2.0**30 - 3 * i, float(i)] for i in range(60)]
    df = spark.createDataFrame(list(enumerate(large)), "vec_id long, vector array<double>")
    got = metric_tree.top_inner_products(df, F.col("vec_id") == 3, k=60).collect()
    want = sorted((-sum(int(a) * int(b) for a, b in zip(large[3], w, strict=True)), j) for j, w in enumerate(large) if j != 3)
    assert [(r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == [(-s, j) for s, j in want]
    with pytest.raises(Exception, match="too large"):
        metric_tree.top_inner_products(spark.createDataFrame([(0, [2.0**40]), (1, [2.0**40])], "vec_id long, vector array<double>"), F.lit(True)).collect()
