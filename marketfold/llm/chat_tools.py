"""Chat formatting with linked tool calls.

Calls and results are joined by (conversation, call id), put into a
topological order, their arguments are validated against the tools' schemas,
and every message and call becomes one line of canonical JSON (sorted keys, no
spaces, characters as they are).

Order: a call may name one call that it comes after.  Following those links by
pointer doubling gives, in as many joins as the depth has bits, its depth and
the turn at which everything it waits for is there; (turn ready, depth, turn,
id) is then a topological order.  Rows are range-sorted by conversation and
that order; no conversation is gathered anywhere, however long.

Defined results: of several calls (results) with one id the earliest counts,
and how many there were is reported; a result without a call is an ``orphan``,
a call without a result is ``pending``; without an id every call is a line of
its own, ``invalid``, and every result an ``orphan``; a call after one that does not exist
starts from its own turn (``missing_after``); calls in a cycle, and those after
them, keep their own turn and depth -1 (``cycle``); null conversation ids are
one conversation; a null text is empty; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketfold.session import cut_lineage

# The tools of the query: JSON schemas (the subset that ``schema_errors`` knows).
TOOLS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}}},
    "translate": {"type": "object", "required": ["text", "target"],
                  "properties": {"text": {"type": "string"}, "target": {"type": "string", "enum": ["de", "en", "es", "fr"]}}},
    "count": {"type": "object", "required": ["words"], "additionalProperties": False,
              "properties": {"words": {"type": "array", "items": {"type": "string"}, "maxItems": 100}, "unique": {"type": "boolean"}}},
}

_KINDS = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _is_kind(value: object, kind: str) -> bool:
    if kind in ("integer", "number"):
        whole = isinstance(value, int) or isinstance(value, float) and value.is_integer()
        return not isinstance(value, bool) and (whole if kind == "integer" else isinstance(value, (int, float)))
    return isinstance(value, _KINDS[kind])


def schema_errors(value: object, schema: dict, at: str = "$") -> list[str]:
    """What in ``value`` breaks the schema, in the order of the schema."""
    if "type" in schema and not _is_kind(value, schema["type"]):
        return [f"{at}: not {schema['type']}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        out.append(f"{at}: too short")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            out.append(f"{at}: too small")
        if value > schema.get("maximum", value):
            out.append(f"{at}: too large")
    if isinstance(value, list):
        if len(value) > schema.get("maxItems", len(value)):
            out.append(f"{at}: too many items")
        if "items" in schema:
            for i, x in enumerate(value):
                out += schema_errors(x, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{name}: missing" for name in schema.get("required", []) if name not in value]
        for name in sorted(value):
            if name in known:
                out += schema_errors(value[name], known[name], f"{at}.{name}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{name}: not allowed")
    return out


def check_arguments(tool: str | None, arguments: str | None, tools: dict) -> tuple[object, list[str]]:
    """Parsed arguments (the raw text if they are not JSON) and their errors."""
    if tool not in tools:
        errors = ["unknown tool"]
    else:
        errors = []
    try:
        value = json.loads(arguments) if arguments is not None else None
    except ValueError:
        return arguments, [*errors, "not JSON"]
    return value, errors if errors else schema_errors(value, tools[tool])


# ---- linking ----------------------------------------------------------------

def _conv() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit("\0"))


def _call_id(kind: str) -> Column:
    """The call id; rows without one are numbered (their number is not put out)."""
    return F.coalesce(F.col("call_id").cast("string"), F.concat(F.lit("\0" + kind), F.monotonically_increasing_id().cast("string")))


def link_calls(calls: DataFrame, results: DataFrame) -> DataFrame:
    """One row per (conv, call_id) of calls (conv_id, turn, call_id, name,
    arguments, after) and results (conv_id, turn, call_id, content)."""
    calls, results = calls.withColumn("call_id", _call_id("call")), results.withColumn("call_id", _call_id("result"))
    c = calls.groupBy(_conv().alias("conv"), "call_id").agg(
        F.min(F.struct(F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), "name", "arguments", "after")).alias("call"), F.count(F.lit(1)).alias("n_calls"))
    r = results.groupBy(_conv().alias("conv"), "call_id").agg(
        F.min(F.struct(F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), "content")).alias("result"), F.count(F.lit(1)).alias("n_results"))
    return c.join(r, ["conv", "call_id"], "full_outer").select(
        "conv", "call_id", F.coalesce("call.turn", "result.turn").alias("turn"), "call.name", "call.arguments", "call.after",
        F.col("result.turn").alias("result_turn"), "result.content", F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"))


def topological(linked: DataFrame) -> DataFrame:
    """``linked`` plus ``depth``, ``ready`` and ``order_note``."""
    linked = cut_lineage(linked, "chat-linked")
    there = linked.filter("n_calls > 0").select("conv", F.col("call_id").alias("after"), F.col("result_turn").alias("_waits"), F.lit(True).alias("_there"))
    nodes = linked.select("conv", "call_id", "turn", "after").join(there, ["conv", "after"], "left")
    # A node points to what it comes after; ready: the latest turn on the way so far.
    nodes = nodes.select("conv", "call_id", F.when(F.col("_there"), F.col("after")).alias("to"), F.when(F.col("_there"), 1).otherwise(0).cast("long").alias("depth"),
                         F.greatest("turn", F.coalesce("_waits", "turn")).alias("ready"),
                         (F.col("after").isNotNull() & F.col("_there").isNull()).alias("missing"))
    nodes, open_before = cut_lineage(nodes, "chat-nodes"), None
    while True:
        n_open = nodes.filter("to IS NOT NULL").count()
        if n_open == 0 or n_open == open_before:  # what is still open is a cycle or hangs on one
            break
        open_before = n_open
        ahead = nodes.select("conv", F.col("call_id").alias("to"), F.col("to").alias("_to"), F.col("depth").alias("_depth"), F.col("ready").alias("_ready"))
        nodes = cut_lineage(nodes.join(ahead, ["conv", "to"], "left").select(
            "conv", "call_id", F.col("_to").alias("to"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            F.greatest("ready", F.coalesce("_ready", "ready")).alias("ready"), "missing"), "chat-nodes")
    cycle = F.col("to").isNotNull()
    placed = nodes.select("conv", "call_id", F.when(cycle, F.lit(-1)).otherwise(F.col("depth")).alias("depth"), F.when(~cycle, F.col("ready")).alias("_ready"),
                          F.when(cycle, F.lit("cycle")).when(F.col("missing"), F.lit("missing_after")).alias("order_note"))
    return linked.join(placed, ["conv", "call_id"]).withColumn("ready", F.coalesce("_ready", "turn")).drop("_ready")


LINES = "conv string, ready long, kind int, depth long, turn long, call_id string, status string, errors array<string>, line string"


def _call_lines(tools: dict):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                text = lambda x: None if x is None or x != x else x
                result, called = text(r.content), r.n_calls > 0
                value, errors = check_arguments(text(r.name), text(r.arguments), tools) if called else (None, [])
                named = None if r.call_id.startswith("\0") else r.call_id
                if called and named is None:
                    errors = ["no call id", *errors]
                status = "orphan" if not called else "invalid" if errors else "pending" if r.n_results == 0 else "ok"
                line = {"id": named, "status": status}
                if called:
                    line |= {"tool": text(r.name), "arguments": value, "turn": int(r.turn)}
                if r.n_results:
                    line |= {"result": result, "result_turn": int(r.result_turn)}
                if text(r.after):
                    line["after"] = r.after
                if errors:
                    line["errors"] = errors
                if text(r.order_note):
                    line["order"] = r.order_note
                out.append((r.conv, int(r.ready), 1, int(r.depth), int(r.turn), named, status, errors, canonical(line)))
            yield pd.DataFrame(out, columns=[x.split()[0] for x in LINES.split(", ")])
    return run


def _message_lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        out = [(r.conv, int(r.turn), 0, 0, int(r.turn), None, "message", [], canonical({"role": r.role, "content": r.text, "turn": int(r.turn)}))
               for r in f.itertuples(index=False)]
        yield pd.DataFrame(out, columns=[x.split()[0] for x in LINES.split(", ")])


def format_chats(messages: DataFrame, calls: DataFrame, results: DataFrame, tools: dict = TOOLS) -> DataFrame:
    """Lines of all messages and calls, range-sorted by conversation and order."""
    linked = topological(link_calls(calls, results)).withColumn("result_turn", F.coalesce("result_turn", F.lit(0)))
    said = messages.select(_conv().alias("conv"), F.coalesce("turn", F.lit(0)).cast("long").alias("turn"),
                           F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    lines = said.mapInPandas(_message_lines, LINES).unionByName(linked.mapInPandas(_call_lines(tools), LINES))
    lines = cut_lineage(lines, "chat-lines")
    order = ["conv", "ready", "kind", "depth", "turn", "call_id", "line"]
    return lines.repartitionByRange(*order).sortWithinPartitions(*order)


# ---- tool calls derived from plain conversations -----------------------------

def derived_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the turns of a plain conversation stand for.

    A user turn calls one of the tools (chosen, like its faults, by a hash of
    its text) and, every second time, after the call of the user turn before;
    the assistant turn that follows is the result, now and then left out."""
    t = conversations.select("conv_id", F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    h = F.crc32(F.col("text").cast("binary"))
    words = F.filter(F.split("text", "[^\\p{L}]+"), lambda w: w != "")
    name = F.element_at(F.array(*map(F.lit, ("search", "translate", "count", "search", "translate", "count", "browse"))), (h % 7 + 1).cast("int"))
    limit = (F.shiftright(h, 5) % 60).cast("int")
    search = F.to_json(F.struct(F.array_join(F.slice(words, 1, 3), " ").alias("query"), limit.alias("limit")))
    translate = F.to_json(F.struct(F.lit("fr").alias("target"), F.coalesce(F.get(words, F.lit(0)), F.lit("")).alias("text")))
    count = F.to_json(F.struct((h % 2 == 0).alias("unique"), F.slice(words, 1, 5).alias("words")))
    arguments = F.when(name == "translate", translate).when(name == "count", count).otherwise(search)
    arguments = F.when(F.shiftright(h, 9) % 23 == 0, F.concat(arguments, F.lit("}"))).otherwise(arguments)
    call_id = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    calls = t.filter("role = 'user'").select("conv_id", "turn", call_id(F.col("turn")).alias("call_id"), name.alias("name"), arguments.alias("arguments"),
                                             F.when((h % 2 == 0) & (F.col("turn") >= 2), call_id(F.col("turn") - 2)).alias("after"))
    results = t.filter("role = 'assistant'").filter(h % 11 != 0).select("conv_id", "turn", call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def report(conversations: DataFrame) -> DataFrame:
    """Lines of the table's messages and of the calls derived from it."""
    calls, results = derived_calls(conversations)
    lines = format_chats(conversations, calls, results)
    return lines.select(F.when(F.col("conv") != "\0", F.col("conv")).try_cast("long").alias("conv_id"), "ready", "kind", "depth", "turn", "call_id",
                        "status", "errors", "line")
