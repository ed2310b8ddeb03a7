"""Chat formatting, vector search, main text and the pipeline."""

import json
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veriflux.llm import chat, main_text, metric_tree, near_copies, oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(oracle.SQL))
def test_queries_equal_their_sql(spark, key):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.QUERIES[key](spark, SF)
    want = con.execute(f"SELECT {', '.join(df.columns)} FROM ({oracle.SQL[key]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, want))


def call(*calls):
    return json.dumps({"content": None, "tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def test_chat_links_calls(spark):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", call(("a", "add", {"y": 2, "x": 1}), ("b", "add", {"x": "s"}))),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "3"})), (1, 0, "tool", json.dumps({"tool_call_id": "b", "content": "early"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "zz"})), (1, 4, "assistant", '{"broken'), (None, None, None, None),
        (2, 0, "assistant", call(("q", "nope", {}))), (2, 1, "assistant", call(("r", "add", [1]))), (2, 1, "assistant", call(("r", "add", {"z": 1}))),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("link", F.lit(1))
    tools = spark.createDataFrame([("add", ["x"], {"x": "integer", "y": "number"})], "name string, required array<string>, properties map<string,string>")
    got = chat.format_turns(turns, tools).orderBy("conv_id", "place").collect()
    assert [r.turn for r in got if r.conv_id == 1] == [0, 1, 0, 2, 3, 4]
    assert [r.call_turn for r in got if r.conv_id == 1] == [None, None, 1, 1, None, None]
    problems = [r.problem for r in got]
    assert sorted(filter(None, problems)) == ["arguments are no object", "missing: x", "no such call", "unknown tool", "wrong type: x"]
    assert '{"content":null,"role":"assistant","tool_calls":[{"arguments":{"x":1,"y":2},"id":"a","name":"add"},{"arguments":{"x":"s"},"id":"b","name":"add"}]}' in {r.message for r in got}
    assert chat.format_turns(turns.limit(0), tools).count() == 0


def test_chat_query_checks_every_conversation(spark, folder):
    """The given turns with a call, its result and the tool in every conversation, against plain Python."""
    turns = spark.read.parquet(f"{SF}/conversations.parquet").filter("conv_id is not null and turn is not null")
    convs = sorted(r.conv_id for r in turns.select("conv_id").distinct().collect())
    given = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    kinds = [({"x": 1}, None), ({"x": "s"}, "wrong type: x"), ({}, "missing: x"), ({"x": 1, "q": 0}, "unknown: q"), ([1], "arguments are no object")]
    extra, want = [], {}
    for n, conv in enumerate(convs):
        arguments, why = kinds[n % 5]
        name = f"tool{n % 7}"
        schema = {"name": name, "parameters": {"properties": {"x": {"type": "integer"}, "y": {}}, "required": ["x"]}}
        made = "other" if n % 11 == 3 else name
        back = 995 if n % 3 == 0 else 1005  # some results come before their call
        extra += [
            (conv, 990, "system", json.dumps({"tools": [{"function": schema} if n % 2 else schema]})),
            (conv, 1000, "assistant", call(("c", made, arguments))), (conv, back, "tool", json.dumps({"tool_call_id": "c", "content": "r"})),
        ]
        want[conv] = {(990, "system", 990, None, None), (1000, "assistant", 1000, None, "unknown tool" if made == "other" else why),
                      (back, "tool", max(back, 1000), 1000, None)}
    rows = spark.createDataFrame([*given, *extra], "conv_id long, turn long, role string, text string")
    rows.write.parquet(f"{folder}/conversations.parquet")
    got = queries.op4_chat_formatting(spark, folder).collect()
    assert len(got) == len(given) + len(extra)
    for conv in convs:
        mine = [r for r in got if r.conv_id == conv]
        assert {(r.turn, r.role, r.place_turn, r.call_turn, r.problem) for r in mine if r.turn >= 990} == want[conv], conv
        order = [r.role for r in sorted(mine, key=lambda r: (r.place_turn, r.call_turn is not None and r.call_turn >= r.turn))]
        assert order[-3:] == ["system", "assistant", "tool"]
        assert all(r.place_turn == r.turn and r.problem is None for r in mine if r.turn < 990)


def test_chat_uses_no_python(spark):
    plan = chat.format_turns(spark.read.parquet(f"{SF}/conversations.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_tree_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = rng.integers(-3, 4, (700, 6)).astype(float)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [(None, [1.0] * 6), (800, None), (801, [1.0, None] * 3), (802, [float("nan")] * 6), (50, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").withColumn("tree", F.lit(1))
    got = metric_tree.top_inner_products(df, F.col("vec_id") % 50 == 0, tree_rows=200).collect()
    for q in range(0, 700, 50):
        scores = vectors @ vectors[q]
        want = sorted(((-s, k) for k, s in enumerate(scores.tolist()) if k != q))[:5]
        assert sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q) == [(n, k, int(-s)) for n, (s, k) in enumerate(want, 1)]
    same = spark.createDataFrame([(k, [1.0, 1.0]) for k in range(300)], "vec_id long, vector array<double>")
    got = metric_tree.top_inner_products(same, F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r.rank)] == [1, 2, 3, 4, 5]
    assert metric_tree.top_inner_products(same.limit(0), F.lit(True)).count() == 0


def article(h):
    inner = re.search(r"<article>(.*?)</article>", h, re.S).group(1)
    blocks = (" ".join(__import__("html").unescape(re.sub("</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)[^>]*>", inner))
    return "\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def model(spark):
    return main_text.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_main_text_of_pages(spark, model):
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(600).collect()
    got = main_text.extract([r.html for r in rows], model)
    assert sum(g == article(r.html) for g, r in zip(got, rows, strict=True)) >= 0.98 * len(rows)


def test_main_text_without_article(model):
    text = "".join(f"<p>{s}</p>" for s in ("The quick brown fox jumps over the lazy dog, and then it sleeps. It was a long day.", "Another paragraph with &amp; more,\n which goes  on for a bit. It does."))
    page = (
        "<html><body><div class='navbar'><ul><li><a href=/>Home</a></li><li><a href=/x>News</a></li></ul></div><div class='cookie-banner'><p>We use cookies, accept them.</p></div>"
        f"<div class='content'><h1>Title</h1>{text}</div><div class='comments'><p>Great article, thanks a lot, I really liked it.</p></div><div class='footer'>&copy; 2024</div></body></html>"
    )
    got = main_text.extract([page, None, "", "<div><p>abc <b>def<p>ghi</div"], model)
    assert got[0].split("\n") == ["Title", "The quick brown fox jumps over the lazy dog, and then it sleeps. It was a long day.", "Another paragraph with & more, which goes on for a bit. It does."]
    assert got[1:3] == ["", ""] and "abc def" in got[3]


def test_main_text_learns_from_rare_labels(spark):
    """One page in a hundred holds an article; others name one in a comment or have one for comments."""
    given = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").limit(20).collect()]
    empty = [f"<html><body><!-- <article> --><article class='comments'>{k}</article><div class='content'><p>{k}</p></div></body></html>" for k in range(1980)]
    rows = spark.createDataFrame([(h,) for h in [*given, *empty, None]], "html string").repartition(8)
    got = main_text.train(rows, sample=20)
    assert len(got.trees) == main_text.ROUNDS
    cut = main_text.extract(given, got)
    assert sum(g == article(h) for g, h in zip(cut, given, strict=True)) >= 0.9 * len(given)
    few = main_text.train(rows, sample=4)  # the four with the least hashes, though few of the pages drawn first have labels
    least = spark.createDataFrame([(h,) for h in given], "h string").orderBy(F.xxhash64("h"), "h").limit(4).collect()
    assert few.start == main_text.fit([r.h for r in least]).start
    none = main_text.train(spark.createDataFrame([(h,) for h in empty[:50]], "html string"))
    assert none.start == main_text.fit([]).start  # the layouts that always teach


def test_main_text_rows(spark, model):
    df = spark.createDataFrame([(1, "u", None), (None, None, ""), (1, "u", None)], "page_id long, url string, html string")
    assert [r.text for r in main_text.extract_main_text(df, model).collect()] == ["", "", ""]


def test_decode_is_hierarchical(model):
    page = main_text.dom.parse("<div><button><b>x</b></button><section><p>y</p></section></div>")
    kept = main_text.decode(page, np.array([0.0, 1.0, 5.0, 9.0, -9.0, 1.0]))
    assert kept.tolist() == [True, True, False, False, False, False]


def test_pipeline(spark):
    """The stages against their operators, and the rows that they keep."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF)
        assert docs.columns == names, name
        if name == "near_copies":
            links = near_copies.link_near_copies(before).filter("doc_id = component_id").select("doc_id")
            assert sorted(r.doc_id for r in docs.collect()) == sorted(r.doc_id for r in links.collect())
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in final) == sorted(r.doc_id for r in docs.collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, final))
