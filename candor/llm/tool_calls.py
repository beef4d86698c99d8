"""Linking of tool calls and results in conversations.

Calls and results are hash-joined by ``(conv_id, call_id)``; results are reduced to one row per identifier
first, so an identifier with very many results is one row in the join. A call may name one call that it
comes ``after``. Depths along these links are found by pointer doubling (each round doubles the steps
known, so a chain of ``n`` calls takes about ``log2 n`` joins), and a conversation's calls are numbered by depth,
turn and identifier, which is a topological order. Arguments are checked against the tool's schema and
written as canonical JSON: keys sorted, no spaces, characters as they are.

No group is gathered: conversations and identifiers may be as large as the table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.llm.common import cut
from candor.plans.ordinals import global_row_number

TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict, "null": type(None)}
ID = ["conv_id", "call_id"]


def _pairs(pairs: list[tuple[str, object]]) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ValueError("a key occurs twice")
    return out


def _constant(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


def canonical(value: object) -> str:
    out = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    out.encode()  # lone surrogates have no UTF-8 form
    return out


def is_type(value: object, name: str) -> bool:
    return isinstance(value, TYPES[name]) and (name == "boolean" or not isinstance(value, bool))


def check_arguments(text: str | None, schema: dict | None) -> tuple[str, str | None]:
    """``(problem, canonical arguments)``; the problem is empty for valid arguments.

    A schema is ``{"required": [names], "properties": {name: type}}``; names it does not list are not allowed.
    """
    try:
        value = json.loads(text, object_pairs_hook=_pairs, parse_constant=_constant) if text is not None else None
        form = canonical(value) if text is not None else None
    except (ValueError, RecursionError):  # UnicodeEncodeError and JSONDecodeError are ValueErrors
        return "invalid_json", None
    if text is None:
        return "invalid_json", None
    if schema is None:
        return "unknown_tool", form
    known = schema.get("properties", {})
    if (not isinstance(value, dict) or any(k not in value for k in schema.get("required", []))
            or any(k not in known or not is_type(v, known[k]) for k, v in value.items())):
        return "invalid_arguments", form
    return "", form


def depths(nodes: DataFrame) -> DataFrame:
    """``conv_id, call_id, depth`` of ``nodes(conv_id, call_id, after)``, unique by id; NULL depth: on or below a cycle.

    ``after`` must be NULL or the id of a node of the same conversation.
    """
    state = cut(nodes.select(*ID, F.col("after").alias("up"), F.when(F.col("after").isNotNull(), 1).otherwise(0).cast("long").alias("steps")))
    open_before = None
    while True:
        still = state.where("up is not null").count()
        if still in (0, open_before):
            # Depths are contiguous: a round that ends no path means the rest never ends.
            return state.select(*ID, F.when(F.col("up").isNull(), F.col("steps")).alias("depth"))
        open_before = still
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"))
        moving = state.where("up is not null").join(above, ["conv_id", "up"]).select(
            *ID, F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"))
        state = cut(state.where("up is null").select(*ID, "up", "steps").unionByName(moving))


MESSAGE = "conv_id LONG, ord LONG, turn LONG, call_id STRING, tool STRING, depth LONG, n_results LONG, status STRING, message STRING"


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per row of ``calls(conv_id, turn, call_id, tool, arguments, after)``: the columns of ``MESSAGE``.

    ``results`` is ``(conv_id, turn, call_id, content)``; a call gets the result of the lowest turn (then content).
    ``message`` is canonical JSON of id, name, arguments (NULL if not JSON) and result. ``status`` is the first that holds of:
    ``missing_id`` (NULL conversation or call id), ``duplicate_id`` (not the first call of its id, by turn, then content),
    ``invalid_json``, ``unknown_tool``, ``invalid_arguments``, ``cycle``, ``unknown_dependency``, ``no_result``, ``ok``. ``ord`` counts a
    conversation's calls from 1; calls without a depth (missing or duplicate id, cycle) come last. Repeated rows are duplicates
    of one another. Other columns are ignored; empty tables are fine.
    """
    own = calls.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "call_id", "tool", "arguments", "after")
    # Which of several calls with an id is the first, without gathering them.
    order = F.struct(F.coalesce("turn", F.lit((1 << 63) - 1)), F.xxhash64("tool", "arguments", "after"))
    named = own.where("conv_id is not null and call_id is not null").groupBy(*ID).agg(
        F.min(F.struct(order.alias("o"), F.col("after").alias("after"))).alias("m"), F.count(F.lit(1)).alias("times"))
    firsts = cut(named.select(*ID, F.col("m.o").alias("first"), F.col("m.after").alias("after"), "times"))
    known = firsts.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("found"))
    resolved = cut(firsts.join(known, ["conv_id", "after"], "left"))
    depth = depths(resolved.select(*ID, F.when(F.col("found"), F.col("after")).alias("after")))
    placed = resolved.select(*ID, "first", (F.col("after").isNotNull() & F.col("found").isNull()).alias("dangling")).join(depth, ID)
    content = results.select(F.col("conv_id").cast("long").alias("conv_id"), "call_id", F.struct(
        F.coalesce(F.col("turn").cast("long"), F.lit((1 << 63) - 1)).alias("t"), F.coalesce("content", F.lit("")).alias("content")).alias("r"))
    answered = content.dropna(subset=ID).groupBy(*ID).agg(F.min("r").alias("r"), F.count(F.lit(1)).alias("n_results"))
    # Rows of one id that are alike share a number; the first of them is the call, the others repeat it.
    alike = own.groupBy("conv_id", "turn", "call_id", "tool", "arguments", "after").agg(F.count(F.lit(1)).alias("copies"))
    each = alike.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    joined = each.join(placed, ID, "left").join(answered, ID, "left")
    is_first = (order == F.col("first")) & (F.col("copy") == 1)
    rows = joined.select(
        "conv_id", "turn", "call_id", "tool", "arguments", F.when(is_first, F.col("depth")).alias("depth"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"), F.col("r.content").alias("content"),
        F.when(F.col("first").isNull(), "missing_id").when(~is_first, "duplicate_id").otherwise("").alias("early"),
        F.when(F.col("depth").isNull(), "cycle").when(F.col("dangling"), "unknown_dependency").when(F.col("n_results").isNull(), "no_result").otherwise("ok").alias("late"),
        F.xxhash64("tool", "arguments", "after", "copy").alias("h"))
    last = F.coalesce("depth", F.lit((1 << 62)))
    numbered = global_row_number(rows, [F.col("conv_id").asc_nulls_last(), last.asc(), F.col("turn").asc_nulls_last(),
                                        F.col("call_id").asc_nulls_last(), F.col("h").asc()], "rn")
    starts = numbered.groupBy("conv_id").agg(F.min("rn").alias("start")).withColumnRenamed("conv_id", "c")
    ordered = numbered.join(starts, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn("ord", F.col("rn") - F.col("start") + 1)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = {n: batch.column(n).to_pylist() for n in ("call_id", "tool", "arguments", "content", "early", "late")}
            status, messages = [], []
            for call, tool, arguments, content, early, late in zip(*col.values()):
                problem, form = check_arguments(arguments, schemas.get(tool))
                status.append(early or problem or late)
                messages.append('{"arguments":%s,"id":%s,"name":%s,"result":%s}' % (form or "null", *map(canonical, (call, tool, content))))
            kept = [batch.column(n) for n in ("conv_id", "ord", "turn", "call_id", "tool", "depth", "n_results")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(status, pa.string()), pa.array(messages, pa.string())],
                                             names=["conv_id", "ord", "turn", "call_id", "tool", "depth", "n_results", "status", "message"])

    return ordered.select("conv_id", "ord", "turn", "call_id", "tool", "depth", "n_results", "arguments", "content", "early", "late").mapInArrow(write, MESSAGE)


def orphan_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Rows of ``results`` whose identifier no call has (NULL identifiers included)."""
    return results.join(calls.select(*ID).dropna().distinct(), ID, "left_anti")


# ---------------------------------------------------------------------------------------------
# Calls and results derived from a table of conversations (which holds plain turns)
# ---------------------------------------------------------------------------------------------

SCHEMAS = {
    "search": {"required": ["query"], "properties": {"query": "string", "limit": "integer"}},
    "lookup": {"required": ["key"], "properties": {"key": "string", "turn": "integer"}},
    "calc": {"required": ["values"], "properties": {"values": "array", "unit": "string"}},
}


def _digest(kind: str, turn: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(kind), F.col("conv_id").cast("string"), turn.cast("string")))


def _call_id(turn: Column) -> Column:
    return F.concat(F.lit("call_"), F.substring(_digest("id", turn), 1, 12))


def calls_of(conversations: DataFrame) -> DataFrame:
    """Every user turn as a call after the user turn two before it; MD5 digits choose tool and faults.

    Digit 1 chooses the tool, digit 2 wrong (0) or broken (1) arguments, digit 3 an unknown dependency (0) or one on itself (1).
    """
    turn, h = F.col("turn"), _digest("call", F.col("turn"))
    digit = [F.conv(F.substring(h, i, 1), 16, 10).cast("int") for i in (1, 2, 3)]
    tool = F.when(digit[0] < 8, "search").when(digit[0] < 12, "lookup").when(digit[0] < 15, "calc").otherwise("shell")
    body = (F.when(tool == "search", F.to_json(F.struct(F.col("text").alias("query"), turn.alias("limit"))))
            .when(tool == "lookup", F.to_json(F.struct(turn.alias("turn"), F.col("role").alias("key"))))
            .otherwise(F.to_json(F.struct(F.array(turn, F.length("text")).alias("values"), F.lit("x").alias("unit")))))
    arguments = F.when(digit[1] == 0, F.to_json(F.struct(turn.alias("query")))).when(digit[1] == 1, F.lit("{broken")).otherwise(body)
    after = F.when(digit[2] == 0, "call_none").when(digit[2] == 1, _call_id(turn)).when(turn >= 2, _call_id(turn - 2))
    return conversations.where("role = 'user' and text is not null").select(
        "conv_id", "turn", _call_id(turn).alias("call_id"), tool.alias("tool"), arguments.alias("arguments"), after.alias("after"))


def results_of(conversations: DataFrame) -> DataFrame:
    """Every assistant turn as the result of the turn before; where the first MD5 digit is 0 it names no call."""
    lost = F.substring(_digest("result", F.col("turn")), 1, 1) == "0"
    return conversations.where("role = 'assistant'").select(
        "conv_id", "turn", F.when(lost, F.lit("call_lost")).otherwise(_call_id(F.col("turn") - 1)).alias("call_id"), F.col("text").alias("content"))
