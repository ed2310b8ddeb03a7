"""Operators on documents against plain versions of what they compute."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veriflux.llm import contamination, context_tree, language, mixing, near_copies, queries, substrings, token_files
from veriflux.llm import words as W

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, block int, id string"
LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))


def words(text, lower=False):
    found = WORD.findall(text or "")
    return [w.translate(LOWER) for w in found] if lower else found


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names clash with internal ones."""
    texts = [
        (1, PASSAGE), (2, "a b c " + PASSAGE + " d e f"), (3, None), (4, ""), (5, " \t\n"), (6, LONG), (7, LONG), (7, LONG),
        (8, "same id one " * 9), (8, "same id two " * 9), (None, PASSAGE), (None, "no id here"), (9, "x"), (10, "X"),
        (11, "ha " * 100), (12, "Über élan 日本 <|endoftext|> don't 'll ½"), (13, "12 34 !!"), (-5, PASSAGE + " tail"),
    ]
    return spark.createDataFrame([(i, t, "en", None, 1, "q") for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ordered(df):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    given = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] or ""))
    return given, [r for r in rows if r[0] is None]


def plain_substrings(rows, width=20):
    seen, out = set(), []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            key = tuple(w[k : k + width])
            if key in seen:
                gone[k : k + width] = [True] * width
            seen.add(key)
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def test_substrings(docs, odd):
    for df in (docs, odd):
        given, without = ordered(df)
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in substrings.drop_repeated_passages(df).collect()]
        assert sorted(r for r in got if r[0] is not None) == sorted(plain_substrings(given))
        assert len(got) == len(given) + len(without)
    by_text = {r[1]: r[2] for r in got if r[0] is None}
    assert by_text[60] == 60 and by_text[3] == 0  # null ids come last


def test_difference_cover():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(13))
    with pytest.raises(ValueError):
        substrings.drop_repeated_passages(None, width=12)


def plain_sets(rows):
    out = []
    for i, t in rows:
        w = words(t, lower=True)
        out.append((i, {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}))
    return out


def plain_components(sets):
    up = list(range(len(sets)))

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return [root(k) for k in range(len(sets))]


def test_near_copies(docs, odd):
    for df in (docs, odd):
        given, _ = ordered(df)
        sets = plain_sets(given)
        roots = plain_components(sets)
        want = sorted((i, len(s), sets[r][0]) for (i, s), r in zip(sets, roots, strict=True))
        got = [tuple(r) for r in near_copies.link_near_copies(df).collect()]
        assert sorted(r for r in got if r[0] is not None) == want
    assert sorted((r[1], r[2]) for r in got if r[0] is None) == [(1, None), (56, -5)]
    kept = sorted((r.doc_id if r.doc_id is not None else 99, r.text or "") for r in near_copies.keep_one(odd).collect())
    assert [i for i, _ in kept] == [-5, 3, 4, 5, 6, 8, 8, 9, 11, 12, 13, 99]


def test_group_links_find_every_component():
    rng = np.random.default_rng(3)
    for _ in range(60):
        base = [rng.integers(0, 60, 30) for _ in range(4)]
        sets = []
        for _ in range(rng.integers(2, 30)):
            x = base[rng.integers(0, 4)].copy()
            x[rng.integers(0, 30, rng.integers(0, 9))] = rng.integers(60, 400)
            sets.append(np.unique(x).astype(np.uint64))
        want = plain_components([(k, set(s.tolist())) for k, s in enumerate(sets)])
        up = list(range(len(sets)))

        def root(k, up=up):
            while up[k] != k:
                k = up[k]
            return k

        for a, b in near_copies.group_links(sets, len(sets)):
            up[max(root(a), root(b))] = min(root(a), root(b))
        assert [root(k) for k in range(len(sets))] == want


def test_mixing(odd, docs):
    for df in (docs, odd.withColumn("source", F.when(F.col("doc_id") > 6, "b").when(F.col("doc_id") > 2, "a"))):
        rows = mixing.mix(df).select("row.source", "size", "source_size", "target", "copies").collect()
        assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(df).select("row.source", "size", "source_size", "target", "copies").collect()))
        assert len(rows) == df.count() and all(0 <= r.copies <= 3 for r in rows)
        goals = {r.source: (r.target, r.source_size) for r in rows}
        assert abs(sum(t for t, _ in goals.values()) - sum(r.size for r in rows)) < 1e-6
        assert all(t <= 3 * s + 1e-9 for t, s in goals.values())
        for source, (target, _) in goals.items():
            mine = [r for r in rows if r.source == source]
            assert abs(sum(r.size * r.copies for r in mine) - target) <= 2 * max(r.size for r in mine)  # copies share their fate


def test_whole_copies_have_no_sample(spark):
    rows = [(k, "" if k < 3 else "a few words", "a") for k in range(9)] + [(k, "many words " * 20, "b") for k in range(10, 90)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).select("row.doc_id", "copies").collect()
    assert {r.copies for r in got if r.doc_id < 9} == {3}  # stopped at three times the size; empty documents too


@pytest.mark.parametrize("share", [1 - 2**-53, 0.999999, 0.5, 1e-6])
def test_bins_spread_and_keep_the_order(spark, share):
    rows = spark.range(20_000).select(((F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)).alias("u"), F.lit(share).alias("share"), F.lit(1.0).alias("odds"))
    got = sorted((r.rank, r.bin) for r in rows.withColumn("rank", mixing._rank()).withColumn("bin", mixing._bin()).collect())
    bins = [b for _, b in got]
    assert bins == sorted(bins) and 0 <= bins[0] and bins[-1] < mixing.BINS
    assert max(Counter(bins).values()) < 30


def test_targets(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 890), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(sizes).collect()}
    assert got["a"] == 30 and got["b"] == 300 and got["c"] == pytest.approx(670) and got[None] == 0


def test_token_files(odd, docs, spark, folder):
    path = public_tokenizers.path(queries.TOKENIZER)
    plain = Tokenizer.from_file(path)
    for k, df in enumerate((docs, odd, docs.limit(0))):
        token_files.write(df, f"{folder}/{k}", path, 2)
        got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read(spark, f"{folder}/{k}", 50257).collect())
        want = []
        for doc, text in ((r.doc_id, r.text) for r in df.collect()):
            ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
            want.append((doc, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        assert Counter(r[1:] for r in got) == Counter(want)
        ids = [r[1] for r in got if r[1] is not None]
        assert ids == sorted(ids)
        at = 0
        for start, _, n, _ in got:
            assert start == at
            at += n


def test_files_map_into_memory(spark, folder):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path(queries.TOKENIZER)
    folder += "/tokens"
    token_files.write(df, folder, path, 2)
    plain = Tokenizer.from_file(path).encode("a b").ids
    parts = [token_files.open_file(str(p), 50257) for p in sorted(__import__("pathlib").Path(folder).glob("part-*"))]
    assert [i for ids, _, _ in parts for i in ids.tolist()] == [*plain, 2, 2]
    assert all(len(offsets) == len(docs) + 1 for _, docs, offsets in parts)


def test_encoder_splits_as_the_tokenizer(spark):
    path = public_tokenizers.path(queries.TOKENIZER)
    plain, own = Tokenizer.from_file(path), token_files.Encoder(path)
    rng = np.random.default_rng(5)
    letters = ["a", "B", "é", "1", "٣", "½", ".", "'", "'s", "'ll", " ", "  ", "\n", "\t", " ", "日", "\U0001f600", "s", "\r\n", "́"]
    for _ in range(60):
        texts = ["".join(rng.choice(letters, rng.integers(0, 30))) for _ in range(10)]
        for c in W.chunks(pa.array(texts)):
            ids, sizes = own.chunk(c)
            want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
            assert ids.tolist() == [i for w in want for i in w] and sizes.tolist() == [len(w) for w in want]


def test_language(docs, odd, spark):
    model = language.train(docs.filter(~language.is_held_out(F.col("doc_id"))))
    rows = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(language.is_held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.9 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    got = {(r.doc_id, r.lang_pred) for r in language.predict(odd, model).collect()}
    assert {i for i, p in got if p == "und"} == {3, 4, 5, 13}
    kept = language.keep_identified(odd, model, 0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4
    empty = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.predict(odd, empty).collect()} == {"und"}


def test_forward_backward_sums_over_all_paths():
    rng = np.random.default_rng(0)
    scores, move = rng.normal(size=(1, 4, 3)), rng.normal(size=(3, 3))
    total, want = 0.0, np.zeros((4, 3))
    for path in np.ndindex(3, 3, 3, 3):
        p = math.exp(sum(scores[0, t, k] for t, k in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += p
        for t, k in enumerate(path):
            want[t, k] += p
    got, _ = language.forward_backward(scores, np.array([4]), move)
    assert np.allclose(got[0], want / total)


def edits(item, text):
    row = [(0, j) for j in range(len(text) + 1)]
    for a in item:
        new = [(row[0][0] + 1, row[0][1])]
        for j, b in enumerate(text, 1):
            new.append(min((row[j - 1][0] + (a != b), row[j - 1][1]), (row[j][0] + 1, row[j][1]), (new[-1][0] + 1, new[-1][1])))
        row = new
    return min(c for c, _ in row)


def test_contamination_matches_edit_distance(spark):
    rng = np.random.default_rng(4)
    letters = list("abcd ")
    items, texts = [], []
    for k in range(12):
        item = " ".join("".join(rng.choice(letters, 110)).split())
        x = list(item)
        for _ in range(rng.integers(0, contamination.budget(len(item)) + 3)):
            p = rng.integers(0, len(x))
            x[p : p + 1] = [["", "z", x[p] + "y"][rng.integers(0, 3)]]
        items.append((k, item))
        texts.append((k, " ".join(("".join(rng.choice(letters, 50)) + "".join(x) + "".join(rng.choice(letters, 50))).split())))
    docs = spark.createDataFrame([*texts, (77, None), (78, "")], "doc_id long, text string")
    benchmark = spark.createDataFrame([*items, (50, None), (51, "short")], "item_id long, text string")
    want = {(d, i, e) for d, t in texts for i, m in items if (e := edits(m, t)) <= contamination.budget(len(m))}
    for slice_chars in (1 << 20, 300):
        got = contamination.find_items(docs, benchmark, slice_chars=slice_chars).collect()
        assert {(r.doc_id, r.item_id, r.edits) for r in got} == want and len(got) == len(want)
    clean = contamination.drop_contaminated(docs, benchmark)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in [*texts, (77, 0), (78, 0)]} - {d for d, _, _ in want}
    assert contamination.find_items(docs, benchmark.limit(0)).count() == 0


def test_contamination_finds_short_items(spark):
    items = [(0, "x"), (1, "ab cd"), (2, "Forty two"), (3, "élan"), (4, "日本語"), (5, "seventeen  letters"), (6, "日本語" * 6), (7, ""), (8, None), (9, " "), (5, "seventeen letters")]
    items += [(10, "one item of thirty-three bytes ok"), (11, "ab cd")]
    texts = [
        (0, "ab cde xab cd"), (1, "cab AB  CD."), (2, "(forty two), Forty two"), (3, "élans Élan élan"), (4, "これは日本語です"), (5, "now seventeen\nletters"), (6, "の" + "日本語" * 6 + "を"),
        (7, "has x"), (8, None), (9, ""), (10, "with one item of thirty-thre bytes ok here"), (11, "seventeenletters"), (12, "ab"), (13, "cd"), (14, "forty two"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    norm = lambda t: " ".join(words(t, lower=True))

    def place(item, text):
        """In bytes, by trying all places."""
        letter = lambda c: re.match(r"\w", c) and not re.match("[\u3040-\u30ff\u4e00-\u9fff]", c)
        joint = lambda k: 0 < k < len(text) and letter(text[k - 1]) and letter(text[k])
        k = next((k for k in range(len(text)) if text.startswith(item, k) and not joint(k) and not joint(k + len(item))), None)
        return None if k is None else len(text[:k].encode())

    want = [(d, i, s, s + len(m.encode()), 0) for d, t in texts for i, x in items if 0 < len((m := norm(x)).encode()) < 20 and (s := place(m, norm(t))) is not None]
    want += [(6, 6, 3, 57, 0), (10, 10, 5, 37, 1)]
    assert {(1, 1), (1, 11), (2, 2), (3, 3), (4, 4), (5, 5), (7, 0), (14, 2)} <= {w[:2] for w in want} and not any(w[0] in (0, 11, 12, 13) for w in want)
    for slice_chars in (1 << 20, 8):
        got = contamination.find_items(docs, benchmark, slice_chars=slice_chars).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert {r.doc_id for r in contamination.drop_contaminated(docs, benchmark).collect()} == {d for d, _ in texts} - {w[0] for w in want}


def test_scores_of_words_and_bytes(odd, docs):
    for df in (docs, odd):
        held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
        rows = context_tree.score_texts(df, held).collect()
        tokens = lambda t: [*words(t, lower=True), "\n"]
        given = [(r.doc_id, r.text) for r in df.collect()]
        train = Counter(w for i, t in given if i is None or zlib.crc32(str(i).encode()) % 5 != 1 for w in tokens(t))
        n, v = sum(train.values()), len(train)
        want = Counter()
        for i, t in given:
            w = tokens(t)
            base = sum(math.log10((train[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
            want[i, len(w), sum(train[x] > 0 for x in w), round(base, 4)] += 1
        assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 4)) for r in rows) == want
        assert {r.train_tokens for r in rows} == {n} and all(r.score < 0 for r in rows)


def test_context_trees(spark):
    depth, texts = 2, [(1, "abab abba"), (2, "abab"), (3, "ba"), (4, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.score for r in context_tree.score_texts(df, F.col("doc_id") == 3, depth=depth).collect()}
    counts = Counter()
    code = lambda t: (" ".join(words(t)) + "\n").encode()

    def bits(t):
        s = b"\n" * depth + code(t)
        for k in range(depth, len(s)):
            node = 1
            for b in range(7, -1, -1):
                yield s[k - depth : k], node, s[k] >> b & 1
                node = 2 * node + (s[k] >> b & 1)

    for i, t in texts:
        if i != 3:
            for context, node, bit in bits(t):
                for d in range(depth + 1):
                    counts[context[depth - d :], node, bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
    nodes = {k[:2] for k in counts}
    log, stay = {}, {}
    for context, node in sorted(nodes, key=lambda k: -len(k[0])):
        own = kt(counts[context, node, 0], counts[context, node, 1])
        if len(context) == depth:
            log[context, node], stay[context, node] = own, 1.0
        else:
            below = sum(log[c, m] for c, m in log if m == node and len(c) == len(context) + 1 and c.endswith(context))
            log[context, node] = math.log(0.5 * math.exp(own) + 0.5 * math.exp(below))
            stay[context, node] = 0.5 * math.exp(own - log[context, node])
    for i, t in texts:
        total = 0.0
        for context, node, bit in bits(t):
            p = None
            for d in range(depth, -1, -1):
                key = (context[depth - d :], node)
                if key in nodes:
                    own = (counts[*key, bit] + 0.5) / (counts[*key, 0] + counts[*key, 1] + 1)
                    p = own if p is None else stay[key] * own + (1 - stay[key]) * p
            total += math.log10(0.5 if p is None else p)
        assert got[i] == pytest.approx(total, rel=1e-6)


def test_empty_tables(docs):
    none = docs.limit(0)
    assert substrings.drop_repeated_passages(none).count() == 0
    assert near_copies.link_near_copies(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert context_tree.score_texts(none, F.lit(False)).count() == 0


def test_kept_digest(spark):
    rows = {r.doc_id: r for r in queries.op1_substring_dedup(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    whole = [i for i, r in rows.items() if not r.n_removed]
    assert all(rows[i].kept_sha256 == hashlib.sha256(" ".join(words(texts[i])).encode()).hexdigest() for i in whole)
