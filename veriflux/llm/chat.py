"""Chat formatting: one canonical JSON message for each turn, with tool calls linked to their results.

An assistant turn whose text is a JSON object with `tool_calls` (a list of id, name, arguments, the last two bare or as
`function`) makes calls; a `tool` turn whose text is a JSON object with `tool_call_id` is a result. Only DataFrame functions are used, and no
conversation is collected into one row: a conversation may hold any share of all turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veriflux.llm.store import stored

CALLS = "content string, tool_calls array<struct<id:string,name:string,arguments:string,function:struct<name:string,arguments:string>>>"
RESULT = "content string, tool_call_id string"
TOOLS = "tools array<struct<name:string,parameters:string,function:struct<name:string,parameters:string>>>"
PARAMETERS = "required array<string>, properties map<string,struct<type:string>>"
SCHEMA = "type string, enum string, required array<string>, properties map<string,string>, items string, additionalProperties string"


def _object(text: Column, schema: str) -> Column:
    """The text as a struct, null if it isn't a JSON object."""
    return F.when(F.ltrim(text).startswith("{"), F.from_json(text, schema, {"mode": "PERMISSIVE"}))


def _calls(text: Column) -> Column:
    """The calls of a turn, both forms as one."""
    call = _object(text, CALLS)
    both = F.transform(call["tool_calls"], lambda c: F.struct(
        c["id"].alias("id"), F.coalesce(c["name"], c["function"]["name"]).alias("name"), F.coalesce(c["arguments"], c["function"]["arguments"]).alias("arguments")))
    return F.when(call.isNotNull(), F.struct(call["content"].alias("content"), both.alias("tool_calls")))


def _types(arguments: Column) -> Column:
    """Names and JSON types of the arguments; null if they aren't a JSON object."""
    parsed = F.when(F.ltrim(arguments).startswith("{"), F.from_json(arguments, "map<string,variant>"))
    return F.transform(F.map_entries(parsed), lambda e: F.struct(e["key"].alias("name"), F.schema_of_variant(e["value"]).alias("type")))


def _fits(found: Column, wanted: Column) -> Column:
    """Whether a JSON value of one type may stand where a schema wants another."""
    whole = found == "BIGINT"
    number = whole | found.startswith("DECIMAL") | found.isin("DOUBLE", "FLOAT")
    return (
        F.when(wanted == "integer", whole).when(wanted == "number", number).when(wanted == "string", found == "STRING")
        .when(wanted == "boolean", found == "BOOLEAN").when(wanted == "object", found.startswith("OBJECT"))
        .when(wanted == "array", found.startswith("ARRAY")).otherwise(F.lit(True))
    )


def _problem(types: Column, required: Column, properties: Column, parameters: Column) -> Column:
    """Why the arguments of a call don't match its schema by their names and types; null if they do."""
    others = F.coalesce(F.from_json(parameters, SCHEMA)["additionalProperties"], F.lit("false"))
    names = F.transform(types, lambda t: t["name"])
    missing = F.array_except(required, names)
    unknown = F.array_except(names, F.map_keys(properties))
    wrong = F.filter(types, lambda t: ~_fits(t["type"], F.coalesce(F.element_at(properties, t["name"]), F.lit("any"))))
    return (
        F.when(properties.isNull(), F.lit("unknown tool"))
        .when(types.isNull(), F.lit("arguments are no object"))
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(F.array_sort(missing), ", ")))
        .when((F.size(unknown) > 0) & (others == "false"), F.concat(F.lit("unknown: "), F.array_join(F.array_sort(unknown), ", ")))
        .when(F.size(wrong) > 0, F.concat(F.lit("wrong type: "), F.array_join(F.array_sort(F.transform(wrong, lambda t: t["name"])), ", ")))
    )


def _is(value: Column, wanted: Column) -> Column:
    """Whether a JSON text is of a type that a schema names; names of no JSON type hold for all."""
    number = value.rlike("^-?[0-9]")
    return (
        F.when(wanted == "integer", value.rlike("^-?[0-9]+$")).when(wanted == "number", number).when(wanted == "string", value.startswith('"'))
        .when(wanted == "boolean", value.isin("true", "false")).when(wanted == "null", value == "null")
        .when(wanted == "object", value.startswith("{")).when(wanted == "array", value.startswith("[")).otherwise(F.lit(True))
    )


def _as_map(value: Column) -> Column:
    return F.when(value.startswith("{"), F.from_json(value, "map<string,variant>"))


def _as_list(value: Column) -> Column:
    return F.when(value.startswith("["), F.from_json(value, "array<variant>"))


def _text(value: Column) -> Column:
    """Canonical JSON of a variant: equal values have equal texts."""
    return F.coalesce(F.to_json(value), F.lit("null"))


def _inside(nodes: DataFrame) -> DataFrame:
    """The values within each value (k, at, path, value, schema) that the schema says something about, one level down."""
    s = F.col("s")
    rest = F.when(s["additionalProperties"].startswith("{"), s["additionalProperties"])
    fields = F.transform(F.map_entries(_as_map(F.col("value"))), lambda e: F.struct(
        F.concat_ws(".", "path", e["key"]).alias("path"), _text(e["value"]).alias("value"),
        F.when(F.map_contains_key(s["properties"], e["key"]), F.element_at(s["properties"], e["key"])).otherwise(rest).alias("schema")))
    items = F.transform(_as_list(F.col("value")), lambda v, i: F.struct(
        F.concat("path", F.lit("["), i.cast("string"), F.lit("]")).alias("path"), _text(v).alias("value"), s["items"].alias("schema")))
    rows = nodes.withColumn("s", F.from_json("schema", SCHEMA)).select("k", "at", F.explode(F.coalesce(fields, items)).alias("inner"))
    return rows.select("k", "at", "inner.*").filter(F.col("schema").startswith("{"))


def _nested_problem() -> Column:
    """Why a value does not match its own schema; null if it does, whatever it holds within."""
    value, path = F.col("value"), F.col("path")
    s = F.from_json("schema", SCHEMA)
    types = F.when(s["type"].startswith("["), F.from_json(s["type"], "array<string>")).otherwise(F.array(s["type"]))
    allowed = F.transform(_as_list(s["enum"]), _text)
    names = F.map_keys(_as_map(value))
    inner = lambda found: F.array_join(F.array_sort(F.transform(found, lambda name: F.concat(path, F.lit("."), name))), ", ")
    missing = F.array_except(s["required"], names)
    known = F.coalesce(F.map_keys(s["properties"]), F.array().cast("array<string>"))
    unknown = F.array_except(names, known)
    return (
        F.when(s["type"].isNotNull() & ~F.exists(types, lambda t: _is(value, t)), F.concat(F.lit("wrong type: "), path))
        .when(~F.array_contains(allowed, value), F.concat(F.lit("not in enum: "), path))
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), inner(missing)))
        .when((s["additionalProperties"] == "false") & (F.size(unknown) > 0), F.concat(F.lit("unknown: "), inner(unknown)))
    )


def _all_problems(each: DataFrame) -> DataFrame:
    """k, why of the calls (k, at, c, schema) that don't match: of the first such call, what is wrong at the outermost level.

    Values are opened level by level, all calls together; every level is a stored table of its own, and there are as many
    as the deepest arguments that a schema describes have.
    """
    schema = F.col("schema")
    outer = _problem(_types(F.col("c.arguments")), schema["required"], schema["properties"], schema["parameters"])
    found = each.select("k", F.struct("at", F.lit(0).alias("depth"), outer.alias("why")).alias("p"))
    values = each.select("k", "at", F.lit(None).cast("string").alias("path"), _text(F.try_parse_json("c.arguments")).alias("value"), schema["parameters"].alias("schema"))
    nodes, depth = stored(_inside(values.filter(F.col("schema").startswith("{"))), "arguments"), 1
    while not nodes.isEmpty():
        found = found.union(nodes.select("k", F.struct("at", F.lit(depth).alias("depth"), _nested_problem().alias("why")).alias("p")))
        nodes, depth = stored(_inside(nodes), "arguments"), depth + 1
    return found.filter("p.why is not null").groupBy("k").agg(F.min("p")["why"].alias("why"))


def declared_tools(turns: DataFrame) -> DataFrame:
    """conv_id, name, required, properties, parameters: the tools that the conversations themselves declare.

    A system turn whose text is a JSON object with `tools` declares them: a list of name and parameters (a JSON schema
    with required and properties), bare or as `function`. Tools without parameters take no arguments; properties without
    a type take any value. Tools without a name are left out. `parameters` is the schema as JSON text.
    """
    rows = turns.filter(F.col("role") == "system").select("conv_id", F.explode(_object(F.col("text").cast("string"), TOOLS)["tools"]).alias("t"))
    text = F.coalesce("t.parameters", "t.function.parameters")
    parameters = F.from_json(text, PARAMETERS)
    properties = F.coalesce(parameters["properties"], F.from_json(F.lit("{}"), "map<string,struct<type:string>>"))
    return rows.select(
        "conv_id", F.coalesce("t.name", "t.function.name").alias("name"), F.coalesce(parameters["required"], F.array().cast("array<string>")).alias("required"),
        F.transform_values(properties, lambda _, p: F.coalesce(p["type"], F.lit("any"))).alias("properties"), text.alias("parameters"),
    ).filter("name is not null")


def format_turns(turns: DataFrame, tools: DataFrame | None = None) -> DataFrame:
    """conv_id, turn, place, role, call_turn, problem, message for each row of `turns` (conv_id, turn, role, text).

    message: canonical JSON (keys in order, no white space). place (turn, later, given, row) sorts a conversation so that a
    result comes after its call: results that stand before it move right behind the turn of the call, in the order of their turns. call_turn: the
    turn that a result answers, the first with that identifier. problem: of a result, that no call has its identifier;
    of calls, why their arguments don't match `tools` (name, required array<string>, properties map<string,string>, and
    conv_id if a tool is known in its own conversation only; not checked when `tools` is None). If `tools` has `parameters`, a
    JSON schema as text, values within the arguments are checked too: type (one or a list), enum, required, properties, items
    and additionalProperties, at any depth. Arguments that no property names are a problem unless additionalProperties
    allows them; objects within arguments may hold other names unless it is false. Other words of a schema are not read.

    Null texts give null content; malformed JSON is ordinary text; calls and results without an identifier are linked
    with nothing. Repeated results link to the same call, repeated identifiers to the first. Null roles, turns and
    conversations stay null; rows without a conversation are never linked. Rows that tie are ordered by their text; the
    order of full copies doesn't matter. An empty table gives no rows. Other columns are dropped.
    """
    text = F.col("text")
    rows = turns.select("conv_id", "turn", "role", text.cast("string").alias("text"))
    rows = rows.withColumns({
        "call": F.when(F.col("role") == "assistant", _calls(text)), "result": F.when(F.col("role") == "tool", _object(text, RESULT)),
    })
    is_call, is_result = F.col("call.tool_calls").isNotNull(), F.col("result.tool_call_id").isNotNull()
    calls = rows.filter(is_call).select("conv_id", "turn", F.explode("call.tool_calls").alias("c"))
    firsts = calls.filter(F.col("c.id").isNotNull()).groupBy("conv_id", F.col("c.id").alias("id")).agg(F.min("turn").alias("call_turn"))
    wanted = F.col("result.tool_call_id")
    results = rows.filter(is_result).select("*", F.struct(F.col("conv_id").alias("conv"), wanted.alias("id")).alias("link"))
    firsts = firsts.select(F.struct(F.col("conv_id").alias("conv"), "id").alias("its_link"), "call_turn")
    linked = results.join(firsts.hint("shuffle_hash"), F.col("link") == F.col("its_link"), "left").drop("link", "its_link")
    linked = linked.withColumn("problem", F.when(F.col("call_turn").isNull(), "no such call"))
    plain = rows.filter(~F.coalesce(is_result, F.lit(False)))
    none = F.lit(None)
    checked = F.lit(None).cast("string")
    if tools is not None:
        own = ["conv_id"] if "conv_id" in tools.columns else []
        parameters = F.col("parameters") if "parameters" in tools.columns else F.lit(None).cast("string").alias("parameters")
        schemas = tools.groupBy(*own, "name").agg(F.min(F.struct(F.to_json(F.struct("required", "properties", parameters)).alias("json"), "required")).alias("s"))
        schemas = schemas.select(
            *(F.col(c).alias("tool_conv") for c in own), F.col("name").alias("tool"),
            F.from_json("s.json", "required array<string>, properties map<string,string>, parameters string").alias("schema"),
        )
        # A call names its turn by a hash of the row, so that only the problems travel back; other turns stay where they are.
        key = F.xxhash64("conv_id", "turn", "text")
        each = plain.filter(is_call).select("conv_id", key.alias("k"), F.posexplode("call.tool_calls").alias("at", "c"))
        known = F.col("c.name") == F.col("tool")
        each = each.join(schemas, known & (F.col("conv_id") == F.col("tool_conv")) if own else known, "left")
        problems = _all_problems(each)
        callers = plain.filter(is_call).withColumn("key", key).join(problems, F.col("key") == F.col("k"), "left").drop("key", "k")
        plain = plain.filter(~is_call).withColumn("why", checked).unionByName(callers)
        checked = F.col("why")
    plain = plain.select("conv_id", "turn", "role", "text", "call", "result", none.cast(turns.schema["turn"].dataType).alias("call_turn"), checked.alias("problem"))
    together = plain.unionByName(linked.select(*plain.columns))
    moved = F.col("call_turn") >= F.col("turn")
    place = F.struct(
        F.when(moved, F.col("call_turn")).otherwise(F.col("turn")).alias("turn"), F.when(moved, 1).otherwise(0).alias("later"),
        F.when(moved, F.col("turn")).alias("given"), F.xxhash64("turn", "role", "text").alias("row"),
    )
    keep = {"ignoreNullFields": "false"}
    arguments = lambda c: F.coalesce(F.to_json(F.try_parse_json(c["arguments"])), F.to_json(F.struct(c["arguments"].alias("text"))))
    one_call = lambda c: F.concat(
        F.lit('{"arguments":'), F.coalesce(arguments(c), F.lit("null")), F.lit(","), F.substring(F.to_json(F.struct(c["id"].alias("id"), c["name"].alias("name")), keep), 2, 1 << 30),
    )
    calling = F.concat(
        F.expr("substring(to_json(named_struct('content', call.content, 'role', role), map('ignoreNullFields', 'false')), 1, length(to_json(named_struct('content', call.content, 'role', role), map('ignoreNullFields', 'false'))) - 1)"),
        F.lit(',"tool_calls":['), F.array_join(F.transform(F.col("call.tool_calls"), one_call), ","), F.lit("]}"),
    )
    answering = F.to_json(F.struct(F.col("result.content").alias("content"), "role", F.col("result.tool_call_id").alias("tool_call_id")), keep)
    message = F.when(is_call, calling).when(is_result, answering).otherwise(F.to_json(F.struct(F.col("text").alias("content"), "role"), keep))
    return together.select("conv_id", "turn", place.alias("place"), "role", "call_turn", "problem", message.alias("message"))
