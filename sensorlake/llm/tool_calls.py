"""Tool calls of conversations: linked to results, ordered by dependency, validated, as canonical JSON.

Messages are rows (conv_id, turn, role, text). A call message has the JSON
``{"tool_calls": [{"id", "name", "arguments", "after": [ids]}]}``, a result message (role ``tool``)
``{"tool_call_id", "content"}``; other messages are left alone. Calls and results meet in
hash joins on (conversation, identifier). A call's level is one more than
the greatest level of the calls that it names in ``after``, found in rounds over the
dependency edges (as many as the longest chain; calls on a cycle get none). No step
gathers a conversation, so one may hold any share of the rows.

Result rows, one per call, and one per result that answers no call:

    conv_id, call_id, turn, name, status, level, n_results, record

status is the first that applies: ``orphan_result``, ``malformed`` (no id or name, or arguments
that are no object), ``duplicate_id`` (a later call with a known id), ``unknown_tool``,
``invalid_arguments``, ``cyclic``, ``missing_dependency``, ``missing_result``, ``ok``. record is canonical JSON (sorted
keys, no spaces, text unescaped where JSON allows) with the first result, by turn.

Rows: null or empty text, text that is no JSON object of those forms and unknown
roles give nothing; null conv_id or turn are values of their own (one unnamed
conversation, before turn 0); equal rows give equal rows;
arguments with numbers beyond the range of doubles, or NaN, are malformed, such a result is null; lone surrogates become U+FFFD;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.tables import stored

TYPES = {"string": str, "object": dict, "array": list, "boolean": bool, "null": type(None)}


def canonical(value) -> str | None:
    """Canonical JSON; None for numbers that JSON has no form for (NaN, infinities)."""
    try:
        return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    except ValueError:
        return None


def whole_text(value):
    """A JSON value whose strings have lone surrogates replaced by U+FFFD."""
    if isinstance(value, str):
        return value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    if isinstance(value, list):
        return [whole_text(x) for x in value]
    return {whole_text(k): whole_text(v) for k, v in value.items()} if isinstance(value, dict) else value


def fits(value, schema: dict) -> bool:
    """Whether a JSON value meets a schema (type, enum, bounds, lengths, properties, required, items)."""
    kind = schema.get("type")
    number = isinstance(value, (int, float)) and not isinstance(value, bool)
    if kind == "integer" and not (number and (isinstance(value, int) or value.is_integer())) or kind == "number" and not number:
        return False
    if kind in TYPES and not isinstance(value, TYPES[kind]):
        return False
    if "enum" in schema and value not in schema["enum"]:
        return False
    if number and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        return False
    if isinstance(value, (str, list)) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        return False
    if isinstance(value, list) and "items" in schema:
        return all(fits(x, schema["items"]) for x in value)
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if any(k not in value for k in schema.get("required", ())):
            return False
        if schema.get("additionalProperties") is False and any(k not in known for k in value):
            return False
        return all(fits(v, known[k]) for k, v in value.items() if k in known)
    return True


def _parse(role: str | None, text: str | None):
    """Yields (kind, id, name, arguments, after, content) of one message."""
    if not text or text.lstrip()[:1] != "{":
        return
    try:
        body = json.loads(text)
        if "\\u" in text:
            body = whole_text(body)
    except (ValueError, RecursionError):
        return
    if role == "tool" and "tool_call_id" in body:
        yield "result", _id(body["tool_call_id"]), None, None, [], canonical(body.get("content"))
    elif isinstance(body.get("tool_calls"), list):
        for c in body["tool_calls"]:
            c = c if isinstance(c, dict) else {}
            after = c.get("after")
            name, args = c.get("name"), c.get("arguments")
            if canonical(args) is None:
                args = None
            yield ("call", _id(c.get("id")), name if isinstance(name, str) else None, args if isinstance(args, dict) else None,
                   [x for x in map(_id, after) if x is not None] if isinstance(after, list) else [], None)


def _id(x) -> str | None:
    return x if isinstance(x, str) and x else str(x) if isinstance(x, int) and not isinstance(x, bool) else None


ROWS = ("conv_id long, turn long, seq int, kind string, id string, name string, arguments string, fault string, "
        "after array<string>, content string")
ARROW = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("seq", pa.int32()), ("kind", pa.string()), ("id", pa.string()),
                   ("name", pa.string()), ("arguments", pa.string()), ("fault", pa.string()), ("after", pa.list_(pa.string())), ("content", pa.string())])


def parsed(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, turn, role, text in zip(*[b.column(c).to_pylist() for c in range(4)], strict=True):
                for seq, (kind, i, name, args, after, content) in enumerate(_parse(role, text)):
                    fault = None
                    if kind == "call":
                        if i is None or name is None or args is None:
                            fault = "malformed"
                        elif name not in schemas:
                            fault = "unknown_tool"
                        elif not fits(args, {"type": "object", **schemas[name]}):
                            fault = "invalid_arguments"
                    out.append({"conv_id": conv, "turn": turn, "seq": seq, "kind": kind, "id": i, "name": name,
                                "arguments": None if args is None else canonical(args), "fault": fault, "after": after, "content": content})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=ARROW)

    return messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
                           F.col("text").cast("string")).mapInArrow(run, ROWS)


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, level) of every node of an acyclic part: 0, or one more than the greatest level of its parents."""
    state = stored(nodes.join(edges.select(F.col("child").alias("key")).distinct(), "key", "left_anti").withColumn("level", F.lit(0)), "levels")
    left = edges
    while True:
        ready = left.join(state.selectExpr("key AS parent", "level"), "parent", "left").groupBy("child").agg(
            F.max("level").alias("level"), F.count(F.lit(1)).alias("n"), F.count("level").alias("known")).filter("n = known").selectExpr(
            "child AS key", "level + 1 AS level")
        ready = stored(ready.join(state.select("key"), "key", "left_anti"), "ready")
        if ready.isEmpty():
            return state
        left = stored(left.join(ready.selectExpr("key AS child"), "child", "left_anti"), "edges")
        state = stored(state.unionAll(ready), "levels")


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """See the module: one row per call and per orphan result."""
    key = "xxhash64(coalesce(conv_id, -1), conv_id IS NULL, id)"
    rows = stored(parsed(messages, schemas).withColumn("key", F.expr(f"CASE WHEN id IS NOT NULL THEN {key} END")), "tool-rows")
    calls, results = rows.filter("kind = 'call'"), rows.filter("kind = 'result'")
    place = F.struct("turn", "seq")
    # the first call with an id, by place, owns it (so do equal rows of that place)
    sound = calls.filter("id IS NOT NULL AND coalesce(fault, '') != 'malformed'")
    owners = sound.groupBy("key").agg(F.min(place).alias("own"))
    answers = results.filter("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n_results"), F.min(F.struct("turn", "seq", "content")).alias("first"))
    ids = owners.select("key")
    edges = sound.join(owners, "key").filter(place.eqNullSafe(F.col("own"))).selectExpr(
        "key AS child", "conv_id", "explode(after) AS id").selectExpr("child", f"{key} AS parent").distinct()
    known = stored(edges.join(ids.withColumnRenamed("key", "parent"), "parent"), "edges")
    missing = edges.join(ids.withColumnRenamed("key", "parent"), "parent", "left_anti").select(F.col("child").alias("key")).distinct().withColumn("lacks", F.lit(True))
    level = levels(ids, known)
    out = calls.join(owners, "key", "left").join(answers, "key", "left").join(level, "key", "left").join(missing, "key", "left")
    owner = "(turn <=> own.turn AND seq <=> own.seq)"
    status = ("CASE WHEN fault = 'malformed' THEN fault "
              f"WHEN NOT {owner} THEN 'duplicate_id' WHEN fault IS NOT NULL THEN fault WHEN level IS NULL THEN 'cyclic' "
              "WHEN lacks THEN 'missing_dependency' WHEN n_results IS NULL THEN 'missing_result' ELSE 'ok' END")
    out = out.withColumn("status", F.expr(status)).withColumn("mine", F.expr("status NOT IN ('malformed', 'duplicate_id')"))
    linked = out.selectExpr("conv_id", "id AS call_id", "turn", "name", "status", "CASE WHEN mine THEN CAST(level AS LONG) END AS level",
                            "CASE WHEN mine THEN coalesce(n_results, 0L) ELSE 0L END AS n_results", "arguments", "CASE WHEN mine THEN first.content END AS content")
    orphans = results.join(ids, "key", "left_anti").selectExpr(
        "conv_id", "id AS call_id", "turn", "CAST(NULL AS STRING) AS name", "'orphan_result' AS status", "CAST(NULL AS LONG) AS level", "1L AS n_results",
        "CAST(NULL AS STRING) AS arguments", "content")

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = (b.column(c).to_pylist() for c in (1, 3, 4, 7, 8))
            out = [f'{{"arguments":{args or "null"},"id":{canonical(i)},"name":{canonical(name)},"result":{content or "null"},"status":{canonical(status)}}}'
                   for i, name, status, args, content in zip(*cells, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:7], pa.array(out, pa.string())], names=[*b.schema.names[:7], "record"])

    return linked.unionAll(orphans).mapInArrow(
        serialise, "conv_id long, call_id string, turn long, name string, status string, level long, n_results long, record string")


#: tools of the exchange that ``as_tool_messages`` derives
EXCHANGE = {
    "reply": {"required": ["text", "turn"], "additionalProperties": False,
              "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 1200}, "turn": {"type": "integer", "minimum": 0}}},
    "configure": {"required": ["text"], "additionalProperties": False, "properties": {"text": {"type": "string"}}},
}


def as_tool_messages(messages: DataFrame) -> DataFrame:
    """A conversation as a tool exchange: a user turn calls ``reply``, a system turn ``configure``, an assistant turn answers
    the turn before it; replies come after the conversation's system turn 0, if it has one."""
    m = messages.selectExpr("CAST(conv_id AS LONG) AS conv_id", "CAST(turn AS LONG) AS turn", "role", "coalesce(text, '') AS text")
    systems = m.filter("role = 'system' AND turn = 0").select("conv_id").distinct().withColumn("has_system", F.lit(True))
    call = ("to_json(named_struct('tool_calls', array(named_struct('id', concat(conv_id, ':', turn), 'name', {name}, 'arguments', "
            "named_struct({args}), 'after', {after}))))")
    user = call.format(name="'reply'", args="'text', text, 'turn', turn", after="CASE WHEN has_system THEN array(concat(conv_id, ':0')) ELSE CAST(array() AS ARRAY<STRING>) END")
    system = call.format(name="'configure'", args="'text', text", after="CAST(array() AS ARRAY<STRING>)")
    return m.join(systems, "conv_id", "left").selectExpr(
        "conv_id", "turn", "CASE WHEN role = 'assistant' THEN 'tool' ELSE 'assistant' END AS role",
        f"CASE role WHEN 'user' THEN {user} WHEN 'system' THEN {system} "
        "WHEN 'assistant' THEN to_json(named_struct('tool_call_id', concat(conv_id, ':', turn - 1), 'content', text)) END AS text")
