"""Chat formatting: calls and results linked, ordered, validated, as canonical JSON.

DataFrame functions only.  Calls and results come from messages: an assistant message
that is a JSON object with ``tool_calls`` (id, name, arguments, after) holds calls, a
``tool`` message with ``tool_call_id`` and ``content`` a result.  Any other user message
is a call of the tool ``reply`` with its text as argument, identified by its turn, and
any other assistant message the result of the turn before it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanlens import scratch
from loanlens.operators.keys import dense_key

#: Per tool and argument the JSON type; a trailing ``?`` marks an optional one.
SCHEMAS: Mapping[str, Mapping[str, str]] = {"reply": {"text": "string"}}

_TYPES = {
    "string": r"^STRING$", "integer": r"^BIGINT$", "number": r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": r"^BOOLEAN$", "object": r"^OBJECT", "array": r"^ARRAY",
}


def quoted(value: Column) -> Column:
    """A string as a JSON string, null as null."""
    listed = F.to_json(F.array(value.cast("string")))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def canonical(parsed: Column) -> Column:
    """A parsed JSON value with keys in order and no blanks."""
    return F.to_json(parsed)


def events(messages: DataFrame) -> DataFrame:
    """One row per call, result and plain message.

    conv_id, turn, item (place within the message), role, kind, call_id, name, arguments
    (canonical JSON), parsed, content and after (identifiers a call waits for).
    """
    text = F.col("text")
    json = F.when(text.rlike(r"^\s*\{"), F.try_parse_json(text))
    rows = messages.select("conv_id", "turn", "role", "text").withColumn("json", json)
    calls = F.try_variant_get("json", "$.tool_calls", "array<variant>")
    rows = rows.withColumn("calls", F.when(F.col("role") == "assistant", calls))
    rows = rows.withColumn(
        "answers", F.when(F.col("role") == "tool", F.try_variant_get("json", "$.tool_call_id", "string"))
    )
    none = F.lit(None)
    explicit = (
        rows.where("size(calls) > 0")
        .select("conv_id", "turn", "role", F.posexplode("calls").alias("item", "call"))
        .withColumn("given", F.try_variant_get("call", "$.arguments", "variant"))
        .withColumn(
            "parsed",
            F.coalesce(F.try_parse_json(F.try_variant_get("call", "$.arguments", "string")), "given"),
        )
        .select(
            "conv_id", "turn", "item", "role", F.lit("call").alias("kind"),
            F.try_variant_get("call", "$.id", "string").alias("call_id"),
            F.try_variant_get("call", "$.name", "string").alias("name"),
            canonical(F.col("parsed")).alias("arguments"), "parsed", none.cast("string").alias("content"),
            F.try_variant_get("call", "$.after", "array<string>").alias("after"),
        )
    )
    kind = (
        F.when(F.col("answers").isNotNull() | (F.col("role") == "assistant"), "result")
        .when(F.col("role") == "user", "call").otherwise("message")
    )
    is_call, own = F.col("kind") == "call", F.col("turn").cast("string")
    plain = (
        rows.where("coalesce(size(calls), 0) < 1").withColumn("kind", kind)
        .select(
            "conv_id", "turn", F.lit(0).alias("item"), "role", "kind",
            F.when(is_call, F.concat(F.lit("turn:"), own))
            .when(F.col("kind") == "result", F.coalesce("answers", F.concat(F.lit("turn:"), (F.col("turn") - 1).cast("string"))))
            .alias("call_id"),
            F.when(is_call, F.lit("reply")).alias("name"),
            F.when(is_call, F.to_json(F.struct("text"))).alias("arguments"),
            none.cast("variant").alias("parsed"),
            F.when(~is_call, F.coalesce(F.when(F.col("answers").isNotNull(), F.try_variant_get("json", "$.content", "string")), text)).alias("content"),
            none.cast("array<string>").alias("after"),
        )
    )
    return plain.unionByName(explicit)


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, call_turn, level): a call's level is above all it waits for.

    One join per level of waiting; a call that waits for itself, directly or not, or for
    an unknown one gets no level.
    """
    one = calls.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min("turn").alias("call_turn"), F.array_distinct(F.flatten(F.collect_set(F.coalesce("after", F.array())))).alias("after")
    )
    free = one.where("size(after) = 0").select("conv_id", "call_id", "call_turn", F.lit(0).alias("level"))
    waiting = one.where("size(after) > 0")
    if waiting.isEmpty():
        return free
    done, waiting = scratch.materialise(free), scratch.materialise(waiting)
    while True:
        known = done.select("conv_id", F.col("call_id").alias("need"), "level")
        ready = (
            waiting.select("conv_id", "call_id", "call_turn", F.size("after").alias("n"), F.explode("after").alias("need"))
            .join(known, ["conv_id", "need"]).groupBy("conv_id", "call_id", "call_turn", "n")
            .agg(F.count("*").alias("met"), (F.max("level") + 1).alias("level")).where("met = n")
        )
        ready = scratch.materialise(ready.select("conv_id", "call_id", "call_turn", "level"))
        if ready.isEmpty():
            break
        done = done.unionByName(ready)
        waiting = scratch.materialise(waiting.join(ready.select("conv_id", "call_id"), ["conv_id", "call_id"], "left_anti"))
    return done.unionByName(waiting.select("conv_id", "call_id", "call_turn", F.lit(None).cast("int").alias("level")))


def _problems(schemas: Mapping[str, Mapping[str, str]]) -> Column:
    """Names of what is wrong with a call's arguments, in schema order, joined by '; '."""
    found = [F.when(~F.coalesce(F.col("name").isin(*schemas), F.lit(False)), "unknown tool")]
    for tool, arguments in schemas.items():
        for argument, kind in arguments.items():
            path = f"$.{argument}"
            typed = F.schema_of_variant(F.try_variant_get("parsed", path, "variant"))
            if tool == "reply" and argument == "text":
                # A plain turn: its argument is the text itself and was never parsed.
                whole = F.when(F.get_json_object("arguments", path).isNotNull(), "STRING")
                typed = F.when(F.col("parsed").isNull(), whole).otherwise(typed)
            absent = typed.isNull() | (typed == "VOID")
            wrong = F.when(absent, None if kind.endswith("?") else f"{argument} is missing").when(
                ~typed.rlike(_TYPES[kind.rstrip("?")]), f"{argument} is no {kind.rstrip('?')}"
            )
            found.append(F.when(F.col("name") == tool, wrong))
    return F.concat_ws("; ", *found)


def format_chats(messages: DataFrame, schemas: Mapping[str, Mapping[str, str]] = SCHEMAS) -> DataFrame:
    """Every call, result and message with its link, verdict, place and canonical JSON.

    conv_id, turn, kind, call_id, linked (a result whose call is there, a call that has
    a result), level, valid and problems (of a call's arguments), position in the
    conversation from 0, json.  In a conversation a call stands where it was made, after
    those it waits for, and a result behind its call; what cannot be linked keeps its
    turn.  JSON has its keys in order, no blanks and explicit nulls.

    Calls with one identifier in one conversation are one for linking, each still a row;
    rows without conv_id or identifier link with nothing; a null text is a missing
    argument or a null content; empty tables give none, other columns are ignored.
    Positions come from one sort over all rows, so that no conversation has to fit a
    task.
    """
    rows = scratch.materialise(events(messages))
    calls, results = rows.where("kind = 'call'"), rows.where("kind = 'result'")
    levels = _levels(calls)
    answered = results.where("conv_id is not null and call_id is not null").select("conv_id", "call_id").distinct()
    known = levels.join(answered.withColumn("answered", F.lit(True)), ["conv_id", "call_id"], "left")
    joined = rows.join(known, ["conv_id", "call_id"], "left")
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    found = F.col("call_turn").isNotNull()
    problems = F.when(is_call, _problems(schemas)).otherwise("")
    json = F.when(
        is_call,
        F.concat(
            F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"call_id":'), quoted(F.col("call_id")),
            F.lit(',"kind":"call","name":'), quoted(F.col("name")), F.lit(',"role":'), quoted(F.col("role")),
            F.lit(',"turn":'), F.coalesce(F.col("turn").cast("string"), F.lit("null")), F.lit("}"),
        ),
    ).otherwise(
        F.concat(
            F.lit("{"), F.when(is_result, F.concat(F.lit('"call_id":'), quoted(F.col("call_id")), F.lit(","))).otherwise(""),
            F.lit('"content":'), quoted(F.col("content")), F.lit(',"kind":'), quoted(F.col("kind")), F.lit(',"role":'),
            quoted(F.col("role")), F.lit(',"turn":'), F.coalesce(F.col("turn").cast("string"), F.lit("null")), F.lit("}"),
        )
    )
    level = F.when(is_result, F.col("level") + 1).otherwise(F.col("level"))
    out = joined.select(
        "conv_id", "turn", "item", "kind", "call_id",
        F.when(is_call, F.coalesce("answered", F.lit(False))).when(is_result, found).otherwise(False).alias("linked"),
        F.when(F.col("kind") == "message", 0).otherwise(F.coalesce(level, F.lit(0))).alias("level"),
        (problems == "").alias("valid"), problems.alias("problems"), json.alias("json"),
        F.when(is_result, F.coalesce("call_turn", "turn")).otherwise(F.col("turn")).alias("_turn"),
    )
    order = ["conv_id", "_turn", "level", "turn", "item", "kind", "call_id", "json"]
    placed = scratch.materialise(dense_key(out, order, "_place"))
    first = placed.groupBy("conv_id").agg(F.min("_place").alias("_first")).withColumnRenamed("conv_id", "_conv")
    return placed.join(first, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "turn", "kind", "call_id", "linked", "level", "valid", "problems",
        (F.col("_place") - F.col("_first")).alias("position"), "json",
    )
