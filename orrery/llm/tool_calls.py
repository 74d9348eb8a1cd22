"""Tool calls of conversations linked to their results, ordered, validated and written canonically.

A message whose text is a JSON object with `tool_calls` holds calls (`id`, `name`,
`arguments`, the last also as a string of JSON; a `function` object around name and
arguments is read too). One with `tool_call_id` holds the result of that call. Every
other text is plain. An argument `{"$ref": id}` stands for the result of an earlier call.

Calls and results meet by (conversation, id) in hash joins between one row an id and the
messages, never as all messages of a conversation; so a conversation may hold a third of
all rows. Where an id is repeated its first call and its first result count.

Messages keep their turn as place, unless something they need stands later: then they
move behind it. The order is (order_turn, order_depth, turn): order_turn is the latest
turn among a message and all it needs, order_depth how many moved messages in a row lead
to it. A round lets single needs point twice as far, so a chain costs rounds by the
logarithm of its length; messages with several needs cost a round a level, where they move.
Circles are what is left when messages whose needs are all settled are taken away.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.rows import named, with_results
from orrery.workspace import materialise

#: The turn in place of a null one.
_FIRST = -(2**62)
#: How deep lists and objects may lie in each other; JSON beyond is read as plain text.
MOST_NESTED = 200
#: Half of a surrogate pair, which a JSON escape can write alone and UTF-8 cannot.
_HALF = re.compile("[\ud800-\udfff]")
#: Longer than any chain of needs; only steps around a circle come to it.
_ENDLESS = 1 << 40
#: The tool schemas are broadcast; more than this many characters of them are refused.
MOST_SCHEMA_CHARACTERS = 16 << 20
_CALL = "struct<id:string,name:string,arguments:string,status:string,refs:array<string>>"
_PARSED = {"calls": f"array<{_CALL}>", "answers": "string", "canonical": "string"}
_TYPES = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


def whole(text: str) -> str:
    """The text with each half of a surrogate pair that stands alone written as its JSON escape."""
    return _HALF.sub(lambda half: f"\\u{ord(half[0]):04x}", text)


def canonical(value) -> str:
    """JSON with sorted keys, no blanks, and every character as itself where JSON and UTF-8 allow."""
    told = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return whole(told)


def _depth_of(value) -> int:
    """How deep lists and objects lie in each other."""
    depth, level = 0, [value]
    while level := [x for x in level if isinstance(x, (dict, list))]:
        depth += 1
        level = [y for x in level for y in (x.values() if isinstance(x, dict) else x)]
    return depth


def is_reference(value) -> bool:
    return isinstance(value, dict) and set(value) == {"$ref"} and isinstance(value["$ref"], str)


def violation(value, schema: dict, at: str = "$") -> str | None:
    """The first rule of the schema that the value breaks, else None; references pass.

    Knows type, enum, const, required, properties, additionalProperties, items,
    minimum, maximum, minLength, maxLength, minItems and maxItems.
    """
    if is_reference(value):
        return None
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        if not any(_TYPES[k](value) for k in kinds):
            return f"{at}: not {' or '.join(kinds)}"
    if "enum" in schema and value not in schema["enum"] or "const" in schema and value != schema["const"]:
        return f"{at}: not an allowed value"
    if isinstance(value, dict):
        own = schema.get("properties", {})
        for name in schema.get("required", []):
            if name not in value:
                return f"{at}.{name}: missing"
        for name in sorted(value):
            rule = own.get(name, schema.get("additionalProperties", True))
            if rule is False:
                return f"{at}.{name}: not allowed"
            if isinstance(rule, dict) and (found := violation(value[name], rule, f"{at}.{name}")):
                return found
    measured = {
        "minimum": (value, 1), "maximum": (value, -1),
    } if _TYPES["number"](value) else {
        "minLength": (len(value), 1), "maxLength": (len(value), -1),
    } if isinstance(value, str) else {
        "minItems": (len(value), 1), "maxItems": (len(value), -1),
    } if isinstance(value, list) else {}
    for rule, (size, sign) in measured.items():
        if rule in schema and sign * size < sign * schema[rule]:
            return f"{at}: against {rule} {schema[rule]}"
    if isinstance(value, list) and isinstance(schema.get("items"), dict):
        for i, item in enumerate(value):
            if found := violation(item, schema["items"], f"{at}[{i}]"):
                return found
    return None


def references(value) -> Iterator[str]:
    if is_reference(value):
        yield value["$ref"]
    elif isinstance(value, dict):
        for v in value.values():
            yield from references(v)
    elif isinstance(value, list):
        for v in value:
            yield from references(v)


def _finite(text: str):
    value = float(text)
    if not math.isfinite(value):
        raise ValueError("a number beyond the range of JSON readers")
    return value


def _loaded(text: str):
    """The JSON value; None if it is not JSON, is nested too deep, or has NaN in it."""
    def refuse(name):
        raise ValueError(name)

    try:
        value = json.loads(text, parse_float=_finite, parse_constant=refuse)
    except (ValueError, RecursionError):
        return None
    return value if _depth_of(value) <= MOST_NESTED else None


def read_call(call, schemas: dict) -> dict:
    """One call as it is stored; its status is valid, or says what is wrong."""
    call = call if isinstance(call, dict) else {}
    inner = call.get("function") if isinstance(call.get("function"), dict) else call
    id, name, arguments = call.get("id"), inner.get("name"), inner.get("arguments", {})
    if isinstance(arguments, str):
        arguments = _loaded(arguments)
    if not isinstance(id, str):
        status = "no id"
    elif not isinstance(arguments, dict):
        status = "arguments are not an object"
    elif not isinstance(name, str) or name not in schemas:
        status = "unknown tool"
    else:
        status = whole(violation(arguments, schemas[name]) or "valid")
    return {
        "id": whole(id) if isinstance(id, str) else None,
        "name": whole(name) if isinstance(name, str) else None,
        "arguments": canonical(arguments if isinstance(arguments, dict) else {}),
        "status": status,
        "refs": sorted({whole(r) for r in references(arguments)}),
    }


def read_message(role: str | None, text: str | None, schemas: dict) -> tuple[list, str | None, str]:
    """(calls, id of the answered call, canonical JSON) of a message."""
    value = _loaded(text) if text and text.lstrip().startswith("{") else None
    calls: list[dict] = []
    answers = None
    out: dict = {"role": role, "content": text}
    if isinstance(value, dict) and isinstance(value.get("tool_calls"), list):
        calls = [read_call(c, schemas) for c in value["tool_calls"]]
        out["content"] = value.get("content")
        out["tool_calls"] = [
            {"id": c["id"], "type": "function", "function": {"name": c["name"], "arguments": c["arguments"]}}
            for c in calls
        ]
    elif isinstance(value, dict) and isinstance(value.get("tool_call_id"), str):
        answers = whole(value["tool_call_id"])
        content = value.get("content")
        out = {
            "role": "tool",
            "tool_call_id": answers,
            "content": content if content is None or isinstance(content, str) else canonical(content),
        }
    return calls, answers, canonical(out)


def _greatest_needed(needs: DataFrame, own: DataFrame) -> DataFrame:
    """(row, v): the greatest `v` of `own` among a message and all that it needs.

    A need of a message with one need is replaced by that one once its value is taken
    over, which leaves the result as it is and doubles the reach of a chain each round.
    """
    state, edges = own, needs
    while True:
        value = state.select(F.col("row").alias("need"), F.col("v").alias("w"))
        grown = edges.join(value, "need").groupBy("row").agg(F.max("w").alias("w"))
        new = materialise(
            state.select("row", "v").join(grown, "row", "left").select(
                "row", F.greatest("v", "w").alias("v"), F.coalesce(F.col("w") > F.col("v"), F.lit(False)).alias("grew")
            ),
            "messages-reached",
        )
        if new.where("grew").isEmpty():
            return new.select("row", "v")
        state = new
        single = edges.groupBy("row").agg(F.count("*").alias("n"), F.max("need").alias("next")).where("n = 1")
        edges = materialise(
            edges.join(single.select(F.col("row").alias("need"), "next"), "need", "left")
            .select("row", F.coalesce("next", "need").alias("need"))
            .distinct(),
            "message-needs-doubled",
        )


def _depths(needs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, k), the longest chain of needs from a row, and the rows in or behind a circle.

    A settled need, one without needs left, is taken over and dropped; a need with one
    need left is taken over and replaced by that one, its steps added. When a round
    finds no settled need, each row left needs a row left, so all of them reach a circle.
    """
    edges = needs.distinct().withColumn("n", F.lit(1).cast("long"))
    state = needs.select("row").union(needs.select("need")).distinct().withColumn("k", F.lit(0).cast("long"))
    bounded = lambda c: F.least(c, F.lit(_ENDLESS))
    while True:
        waits = edges.groupBy(F.col("row").alias("need")).agg(
            F.count("*").alias("open"), F.max("need").alias("next"), F.max("n").alias("step")
        )
        told = materialise(
            edges.join(state.select(F.col("row").alias("need"), "k"), "need").join(waits, "need", "left"),
            "message-needs-told",
        )
        if told.where("open is null").isEmpty():
            return state, edges.select("row").distinct()
        taken = (
            told.where("open is null or open = 1")
            .groupBy("row").agg(F.max(bounded(F.col("k") + F.col("n"))).alias("t"))
        )
        state = materialise(
            state.join(taken, "row", "left").select("row", F.greatest("k", "t").alias("k")), "messages-depth"
        )
        one = F.col("open") == 1
        edges = materialise(
            told.where("open is not null")
            .select(
                "row",
                F.when(one, F.col("next")).otherwise(F.col("need")).alias("need"),
                F.when(one, bounded(F.col("n") + F.col("step"))).otherwise(F.col("n")).alias("n"),
            )
            .groupBy("row", "need").agg(F.max("n").alias("n")),
            "message-needs-open",
        )


def link_tool_calls(
    messages: DataFrame,
    schemas: dict[str, dict],
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per message, with its calls, their links and validity, its order and its JSON.

    Columns: conv_id, turn, role, n_calls, n_valid, n_answered (calls with a result),
    statuses (by call), answers (id of the call a result is for), answered_turn (turn of
    that call; null for an orphan), order_turn, order_depth, unordered (in or behind a
    circle of needs; order_depth is 0 in a circle and for what is moved behind it), canonical.
    JSON nested deeper than `MOST_NESTED` is plain text, and such arguments are no object; a
    lone half of a surrogate pair is told as its escape.

    A null conversation is a conversation; a null turn stands before all others and has
    a null order_turn unless the message needs something later. Null and empty texts are
    plain. Repeated rows each get a row. Invalid calls and orphans are kept and told.
    """
    if len(json.dumps(schemas)) > MOST_SCHEMA_CHARACTERS:
        raise ValueError("the tool schemas are too large to be sent to all workers")
    sent = messages.sparkSession.sparkContext.broadcast(schemas)

    def prepare():
        known = sent.value

        def compute(columns: list[pa.Array]) -> list[pa.Array]:
            texts, roles = (c.to_pylist() for c in columns)
            read = [read_message(r, t, known) for r, t in zip(roles, texts)]
            call = pa.struct(
                [(n, pa.string()) for n in ("id", "name", "arguments", "status")]
                + [("refs", pa.list_(pa.string()))]
            )
            return [
                pa.array([c for c, _, _ in read], pa.list_(call)),
                pa.array([a for _, a, _ in read], pa.string()),
                pa.array([j for _, _, j in read], pa.string()),
            ]

        return compute

    given = messages.select(
        named(messages, conversation).alias("conv_id"),
        named(messages, turn).cast("long").alias("turn"),
        named(messages, role).cast("string").alias("role"),
        named(messages, text).alias("t"),
    )
    read = materialise(
        with_results(given, ["conv_id", "turn", "role"], [F.col("t"), F.col("role")], _PARSED, prepare)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("c", F.coalesce(F.col("conv_id").cast("string"), F.lit("\0")))
        .withColumn("at", F.coalesce("turn", F.lit(_FIRST))),
        "messages-read",
    )
    calls = read.select("row", "c", "at", F.explode("calls").alias("call")).select(
        "row", "c", "at", F.col("call.id").alias("id"), F.col("call.refs").alias("refs")
    )
    results = read.where("answers is not null").select("row", "c", "at", F.col("answers").alias("id"))
    first_call = (
        calls.where("id is not null").groupBy("c", "id").agg(F.min(F.struct("at", "row")).alias("f"))
        .select("c", "id", F.col("f.row").alias("need"), F.col("f.at").alias("need_at"))
    )
    first_result = (
        results.groupBy("c", "id").agg(F.min(F.struct("at", "row")).alias("f"))
        .select("c", "id", F.col("f.row").alias("need"), F.col("f.at").alias("need_at"))
    )
    answered = results.join(first_call, ["c", "id"]).select("row", "at", "need", "need_at")
    referred = (
        calls.select("row", "c", "at", F.explode("refs").alias("id"))
        .join(first_result, ["c", "id"])
        .select("row", "at", "need", "need_at")
    )
    needs = materialise(answered.union(referred).distinct(), "message-needs")

    own = needs.select("row", F.col("at").alias("v")).union(needs.select("need", F.col("need_at"))).distinct()
    latest = _greatest_needed(needs.select("row", "need"), own)
    behind = latest.select(F.col("row").alias("need"), F.col("v").alias("w"))
    # a place is passed on by needs of the same latest turn only, and circles hold no others
    tight = materialise(
        needs.select("row", "need").join(latest, "row").join(behind, "need").where("v = w").select("row", "need"),
        "message-needs-late",
    )
    placed = latest.select("row", F.col("v").alias("p"))
    if tight.isEmpty():
        placed = placed.withColumn("k", F.lit(0)).withColumn("circle", F.lit(0))
    else:
        depth, left = _depths(tight)
        placed = placed.join(depth, "row", "left").join(left.withColumn("l", F.lit(1)), "row", "left")
        placed = materialise(
            placed.select("row", "p", F.when(F.col("l").isNull(), F.col("k")).cast("int").alias("k"), F.coalesce("l", F.lit(0)).alias("circle")),
            "messages-placed",
        )
        if not left.isEmpty():
            found = _greatest_needed(
                needs.select("row", "need"), placed.select("row", F.col("circle").cast("long").alias("v"))
            )
            placed = placed.drop("circle").join(found.withColumnRenamed("v", "circle"), "row")
    answers = (
        calls.where("id is not null").join(first_result, ["c", "id"], "left_semi")
        .groupBy("row").agg(F.count("*").alias("n_answered"))
    )
    of = answered.select("row", F.col("need_at").alias("of"))
    out = read.join(answers, "row", "left").join(of, "row", "left")
    out = out.join(placed, "row", "left")
    return out.select(
        "conv_id",
        "turn",
        "role",
        F.size("calls").alias("n_calls"),
        F.size(F.filter("calls", lambda c: c["status"] == "valid")).alias("n_valid"),
        F.coalesce("n_answered", F.lit(0)).cast("int").alias("n_answered"),
        F.col("calls.status").alias("statuses"),
        "answers",
        F.when(F.col("of") > _FIRST, F.col("of")).alias("answered_turn"),
        F.coalesce(F.when(F.col("p") > _FIRST, F.col("p")), "turn").alias("order_turn"),
        F.coalesce("k", F.lit(0)).alias("order_depth"),
        F.coalesce(F.col("circle") > 0, F.lit(False)).alias("unordered"),
        "canonical",
    )
