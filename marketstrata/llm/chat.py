"""Chat messages in canonical JSON, with tool calls linked to their results and checked against schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CALL = "struct<id:string,name:string,arguments:variant>"

#: JSON schema type to the pattern of the variant types that satisfy it.
_TYPES = {
    "string": "^STRING$",
    "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$",
    "number": "^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$",
    "boolean": "^BOOLEAN$",
    "object": "^OBJECT<.*",
    "array": "^ARRAY<.*",
    "null": "^VOID$",
}


def _call(c: Column) -> Column:
    """One call from either layout; arguments may be an object or its JSON text."""
    at = lambda path, kind: F.try_variant_get(c, path, kind)
    arguments = F.coalesce(at("$.function.arguments", "string"), at("$.arguments", "string"))
    return F.struct(
        F.try_parse_json(F.coalesce(arguments, F.lit("{}"))).alias("arguments"),
        at("$.id", "string").alias("id"),
        F.coalesce(at("$.function.name", "string"), at("$.name", "string")).alias("name"),
    )


def _fits(kind: Column, found: Column) -> Column:
    """An argument without a declared type, or of a kind not listed, is accepted."""
    return F.coalesce(*[F.when(kind == name, found.rlike(pattern)) for name, pattern in _TYPES.items()], F.lit(True))


def declared_tools(messages: DataFrame) -> DataFrame:
    """``(conv, tools)``: tool name to its declared arguments, from the system messages of each conversation.

    A tool declared twice takes the definition with the greater JSON text, whatever the row order.
    """
    at = lambda path, kind: F.try_variant_get("tool", path, kind)
    either = lambda path, kind: F.coalesce(at(f"$.function.{path}", kind), at(f"$.{path}", kind))
    tools = (
        messages.filter(F.col("role") == "system")
        .select("conv", F.explode(F.try_variant_get("body", "$.tools", "array<variant>")).alias("tool"))
        .select(
            "conv",
            either("name", "string").alias("name"),
            F.coalesce(either("parameters.properties", "map<string,variant>"), F.create_map().cast("map<string,variant>")).alias("p"),
            F.coalesce(either("parameters.required", "array<string>"), F.array().cast("array<string>")).alias("required"),
            F.to_json("tool").alias("written"),
        )
        .filter("conv IS NOT NULL AND name IS NOT NULL")
        .select(
            "conv",
            "name",
            F.struct(
                "written",
                F.transform(
                    F.map_entries("p"),
                    lambda e: F.struct(e["key"].alias("argument"), F.try_variant_get(e["value"], "$.type", "string").alias("kind")),
                ).alias("arguments"),
                "required",
            ).alias("tool"),
        )
    )
    one = tools.groupBy("conv", "name").agg(F.max("tool").alias("tool"))
    return one.groupBy("conv").agg(F.map_from_entries(F.collect_list(F.struct("name", "tool"))).alias("tools"))


def _valid(call: Column, tools: Column) -> Column:
    """The tool is declared, all required arguments are there, none is undeclared, types fit."""
    tool = F.try_element_at(tools, call["name"])
    given = F.try_variant_get(call["arguments"], "$", "map<string,variant>")
    names = F.map_keys(given)
    known = F.transform(tool["arguments"], lambda a: a["argument"])
    typed = F.forall(
        tool["arguments"],
        lambda a: ~F.array_contains(names, a["argument"])
        | _fits(a["kind"], F.schema_of_variant(F.try_element_at(given, a["argument"]))),
    )
    whole = F.forall(tool["required"], lambda r: F.array_contains(names, r)) & F.forall(names, lambda n: F.array_contains(known, n))
    return F.coalesce(whole & typed, F.lit(False))


def format_chat(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row a message: its place, its canonical JSON, and what is known of its calls or its result.

    A message whose text is a JSON object, with or without white space around it, may carry ``tool_calls`` (role assistant), ``tools`` (role system) or
    ``tool_call_id`` (role tool); any other text, duplicate keys included, is plain content. Results meet the
    calls of their conversation by identifier in a hash join; of calls with one identifier the first by turn
    counts. ``order_turn, order_step`` order a conversation topologically: a message keeps its turn, a result
    written before its call follows that call. No conversation is gathered in one place, so its size is free.

    ``link`` is ``linked`` or ``orphan`` for results, else NULL; ``n_calls`` and ``n_valid`` count a message's
    calls and those that satisfy the schemas of their conversation. Canonical JSON has sorted keys at every
    depth, no white space and no NULL members. NULL text has no content, NULL roles, turns and ids stay NULL; a
    result without a conversation or identifier is an orphan. Repeated rows give repeated rows, an empty table
    an empty one; further columns are not read.
    """
    rows = messages.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    parsed = F.try_parse_json("text")
    rows = rows.withColumn("body", F.when(F.ltrim(F.col("text"), F.lit(" \t\n\r")).startswith("{") & (F.schema_of_variant(parsed).startswith("OBJECT")), parsed))
    rows = rows.withColumn(
        "calls",
        F.when(
            F.col("role") == "assistant",
            F.transform(F.try_variant_get("body", "$.tool_calls", "array<variant>"), _call),
        ),
    ).withColumn("answers", F.when(F.col("role") == "tool", F.try_variant_get("body", "$.tool_call_id", "string")))

    is_call = F.col("calls").isNotNull()
    is_result = F.coalesce(F.col("role") == "tool", F.lit(False))
    none = F.lit(None)
    plain = rows.filter(~is_call & ~is_result).select(
        "*", none.cast("map<string,int>").alias("unused"), none.cast("long").alias("call_turn"), F.lit(0).cast("long").alias("n_valid")
    )
    callers = (
        rows.filter(is_call)
        .join(declared_tools(rows), "conv", "left")
        .withColumn("n_valid", F.size(F.filter("calls", lambda c: _valid(c, F.col("tools")))).cast("long"))
        .withColumn("call_turn", none.cast("long"))
    )
    first_calls = (
        rows.filter(is_call)
        .select("conv", "turn", F.explode("calls.id").alias("answers"))
        .filter("conv IS NOT NULL AND answers IS NOT NULL")
        .groupBy("conv", "answers")
        .agg(F.min("turn").alias("call_turn"), F.lit(True).alias("found"))
    )
    results = (
        rows.filter(is_result)
        .join(first_calls.hint("shuffle_hash"), ["conv", "answers"], "left")
        .withColumn("n_valid", F.lit(0).cast("long"))
    )
    shared = ["conv", "turn", "role", "text", "body", "calls", "answers", "call_turn", "n_valid"]
    everything = (
        plain.select(*shared, none.cast("string").alias("link"))
        .unionByName(callers.select(*shared, none.cast("string").alias("link")))
        .unionByName(results.select(*shared, F.when(F.col("found"), "linked").otherwise("orphan").alias("link")))
    )
    structured = is_call | F.col("answers").isNotNull()
    content = F.when(structured, F.try_variant_get("body", "$.content", "string")).when(
        F.col("body").isNotNull(), F.to_json("body")
    )
    message = F.to_json(
        F.struct(
            F.when(structured | F.col("body").isNotNull(), content).otherwise(F.col("text")).alias("content"),
            "role",
            F.col("answers").alias("tool_call_id"),
            F.col("calls").alias("tool_calls"),
        )
    )
    late = F.col("call_turn") > F.col("turn")
    return everything.select(
        F.col("conv").alias(conv),
        F.col("turn").alias(turn),
        F.when(late, F.col("call_turn")).otherwise(F.col("turn")).alias("order_turn"),
        F.when(late, 1).otherwise(0).alias("order_step"),
        "role",
        message.alias("message"),
        F.coalesce(F.size("calls"), F.lit(0)).cast("long").alias("n_calls"),
        "n_valid",
        "link",
    )
