"""Call forms, order of early results, and token files in great number."""

import json
import shutil
from pathlib import Path

import public_tokenizers
from pyspark.sql import functions as F

from veriflux.llm import chat, token_files
from veriflux.llm.queries import END_ID, TOKENIZER, VOCABULARY

SCHEMA = "conv_id long, turn long, role string, text string"


def test_both_call_forms_give_one_message(spark):
    bare = {"tool_calls": [{"id": "a", "name": "add", "arguments": {"y": 2, "x": 1}}]}
    nested = {"tool_calls": [{"id": "a", "type": "function", "function": {"name": "add", "arguments": {"x": 1, "y": 2}}}]}
    quoted = {"tool_calls": [{"id": "a", "type": "function", "function": {"name": "add", "arguments": '{"x": 1, "y": 2}'}}]}
    rows = [(k, 0, "assistant", json.dumps(c)) for k, c in enumerate((bare, nested, quoted))]
    tools = spark.createDataFrame([("add", ["x"], {"x": "integer", "y": "number"})], "name string, required array<string>, properties map<string,string>")
    got = chat.format_turns(spark.createDataFrame(rows, SCHEMA), tools).collect()
    assert {r.problem for r in got} == {None}
    assert {r.message for r in got} == {'{"content":null,"role":"assistant","tool_calls":[{"arguments":{"x":1,"y":2},"id":"a","name":"add"}]}'}


ORDER = {
    "required": ["item"],
    "properties": {
        "item": {"type": "object", "required": ["id"], "additionalProperties": False, "properties": {
            "id": {"type": "integer"}, "kind": {"enum": ["a", {"y": 1, "x": [2]}, None]}, "sizes": {"type": "array", "items": {"type": ["number", "null"]}}}},
        "note": {"type": "string", "enum": ["x", "y"]}, "free": {},
        "deep": {"items": {"items": {"properties": {"k.v": {"type": "boolean"}}, "additionalProperties": {"type": "string"}}}},
    },
}
CASES = [
    ({"item": {"id": 1}}, None),
    ({"item": {"id": 1, "kind": {"x": [2], "y": 1}, "sizes": [1, 2.5, None]}, "note": "y", "free": [{"any": 1}]}, None),
    ({"item": {"id": "1"}}, "wrong type: item.id"),
    ({"item": {"id": 1.5}}, "wrong type: item.id"),
    ({"item": {}}, "missing: item.id"),
    ({"item": {"id": 1, "q": 0, "p": 0}}, "unknown: item.p, item.q"),
    ({"item": {"id": 1, "kind": "b"}}, "not in enum: item.kind"),
    ({"item": {"id": 1, "kind": None, "sizes": [1, "2"]}}, "wrong type: item.sizes[1]"),
    ({"item": {"id": 1}, "note": "z"}, "not in enum: note"),
    ({"item": [1]}, "wrong type: item"),
    ({"item": {"id": "1"}, "other": 1}, "unknown: other"),
    ({"item": {"id": 1}, "deep": [[{"k.v": True, "w": "s"}], []]}, None),
    ({"item": {"id": 1}, "deep": [[], [{"k.v": 1}]]}, "wrong type: deep[1][0].k.v"),
    ({"item": {"id": 1}, "deep": [[{"w": 3}]]}, "wrong type: deep[0][0].w"),
    ({"item": {"id": 1}, "deep": "no list"}, None),
    ({}, "missing: item"),
]


def test_nested_schemas(spark):
    rows = [(0, 0, "system", json.dumps({"tools": [{"function": {"name": "f", "parameters": ORDER}}, {"name": "open", "parameters": {"additionalProperties": True}}]}))]
    rows += [(0, k, "assistant", json.dumps({"tool_calls": [{"id": f"c{k}", "name": "f", "arguments": a}]})) for k, (a, _) in enumerate(CASES, 1)]
    both = [{"id": "d", "name": "open", "arguments": {"any": 1}}, {"id": "e", "name": "f", "arguments": CASES[2][0]}, {"id": "f", "name": "f", "arguments": {}}]
    rows += [(0, 100, "assistant", json.dumps({"tool_calls": both})), (0, 101, "assistant", json.dumps({"tool_calls": both[:1]}))]
    turns = spark.createDataFrame(rows, SCHEMA)
    formatted = chat.format_turns(turns, chat.declared_tools(turns))
    assert {r.turn: r.problem for r in formatted.collect() if r.turn} == {**{k: why for k, (_, why) in enumerate(CASES, 1)}, 100: "wrong type: item.id", 101: None}
    assert not any(word in formatted._jdf.queryExecution().executedPlan().toString() for word in ("Python", "Pandas", "Arrow"))


def test_early_results_keep_their_order(spark):
    rows = [(1, k, "tool", json.dumps({"tool_call_id": "a", "content": f"r{k}"})) for k in range(6)]
    rows += [(1, 6, "assistant", json.dumps({"tool_calls": [{"id": "a", "name": "f", "arguments": {}}]})), (1, 7, "user", "x" * 200_000)]
    got = chat.format_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("place").collect()
    assert [r.turn for r in got] == [6, 0, 1, 2, 3, 4, 5, 7] and len(got[-1].message) > 200_000


def test_files_are_read_in_the_order_of_their_numbers(spark, folder):
    docs = spark.createDataFrame([(i, f"text {i} " * (i + 1)) for i in range(8)], "doc_id long, text string")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        token_files.write(docs, f"{folder}/a", public_tokenizers.path(TOKENIZER), END_ID)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    Path(f"{folder}/b").mkdir()
    for number, path in zip((99_999, 100_000), sorted(Path(f"{folder}/a").glob("part-*")), strict=True):
        shutil.copy(path, f"{folder}/b/part-{number:05d}{path.name[10:]}")
    first, second = ([tuple(r) for r in token_files.read(spark, f"{folder}/{k}", VOCABULARY).select("doc_id", "start", "n_tokens").orderBy("doc_id").collect()] for k in "ab")
    assert first == second and first[0][1] == 0 and [s for _, s, _ in first] == sorted(s for _, s, _ in first)
