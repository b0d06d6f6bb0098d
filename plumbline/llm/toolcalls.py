"""Tool-call linking in chats: join calls and results by identifier, order them, validate arguments, write canonical JSON.

Messages have conv_id, turn, role and text. An assistant's message may be JSON with ``tool_calls``, a list of {id, name,
arguments}; a message of role ``tool`` is JSON with ``tool_call_id`` and ``content``. An argument {"$ref": id} stands for
the result of another call of the conversation, which has to come first.

Calls and results are first counted per identifier, so a repeated identifier joins once and is reported. In a log whose
references point back in time, the order of turns is a topological one already; only conversations in which a call refers
to one that stands later are ordered anew.
"""

from __future__ import annotations

import json
import re
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.lineage import written

CALLS = "conv_id long, turn long, place int, call_id string, name string, arguments string, refs array<string>, error string"
RESULTS = "conv_id long, turn long, call_id string, content string"
#: References of a conversation that one task orders at once; longer ones are ordered round by round.
GATHERED = 100_000
# JSON schema's names of types.
_TYPES = {
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "null": lambda v: v is None,
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
}


def _well_formed(text: str) -> str:
    """Halves of surrogate pairs, which no UTF-8 text can hold, as escapes."""
    return re.sub("[\ud800-\udfff]", lambda m: f"\\u{ord(m[0]):04x}", text)


def canonical(value: Any) -> str:
    """JSON with sorted keys, no spaces and unescaped letters; ValueError for numbers that JSON does not have."""
    return _well_formed(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _no_number(name: str):
    raise ValueError(f"{name} is no JSON")


def parsed(text: str) -> Any:
    """The value of a JSON text; ValueError if it is none, or nested deeper than can be read."""
    try:
        return json.loads(text, parse_constant=_no_number)
    except RecursionError as error:
        raise ValueError("nested too deep") from error


def _fits(value: Any, kind: Any) -> bool | None:
    """Whether a value is of a type or of one of several; None for a type that is not known."""
    if isinstance(value, dict) and set(value) == {"$ref"} or kind is None:
        return True
    kinds = kind if isinstance(kind, list) else [kind]
    if not all(isinstance(k, str) and k in _TYPES for k in kinds):
        return None
    return any(_TYPES[k](value) for k in kinds)


def violation(arguments: Any, schema: dict | None) -> str | None:
    """The first way in which arguments break a schema {"properties": {name: {"type": kind}}, "required": [name]}.

    A kind is a name of a JSON type or a list of such; a property without one takes any value, and one with another kind
    gives ``unsupported_schema``.
    """
    if schema is None:
        return "unknown_tool"
    if not isinstance(arguments, dict):
        return "arguments_not_an_object"
    properties = schema.get("properties", {})
    for name in schema.get("required", []):
        if name not in arguments:
            return f"missing:{name}"
    for name in sorted(arguments):
        if name not in properties:
            return f"unexpected:{_well_formed(name)}"
        fits = _fits(arguments[name], (properties[name] or {}).get("type"))
        if not fits:
            return f"type:{name}" if fits is False else f"unsupported_schema:{name}"
    return None


def _references(value: Any) -> list[str]:
    found, todo = [], [value]
    while todo:
        now = todo.pop()
        if isinstance(now, dict):
            if set(now) == {"$ref"} and isinstance(now["$ref"], str):
                found.append(_well_formed(now["$ref"]))
            else:
                todo += now.values()
        elif isinstance(now, list):
            todo += now
    return sorted(set(found))


def _arguments(value: Any) -> tuple[Any, str, list[str]]:
    """The arguments, their canonical JSON and their references; None for what is no JSON or nested too deep."""
    try:
        value = parsed(value) if isinstance(value, str) else value
        return value, canonical(value), _references(value)
    except (ValueError, RecursionError):
        return None, "null", []


def _batch(rows: list[tuple], columns: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    names, types = zip(*(c.split() for c in columns.split(", ")), strict=True)
    values = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, k in zip(values, types, strict=True)], names=list(names))


def _text(value: Any) -> str | None:
    return _well_formed(value) if isinstance(value, str) else None


def _calls(schemas: dict[str, dict]):
    def parse(batches):
        for batch in batches:
            rows = []
            for conv, turn, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "text")), strict=True):
                try:
                    found = parsed(text)["tool_calls"]
                    found = found if isinstance(found, list) else []
                except (ValueError, KeyError, TypeError):
                    continue
                for place, call in enumerate(found):
                    call = call if isinstance(call, dict) else {}
                    name = _text(call.get("name"))
                    value, line, refs = _arguments(call.get("arguments"))
                    rows.append((conv, turn, place, _text(call.get("id")), name, line, refs, violation(value, schemas.get(name))))
            yield _batch(rows, CALLS)

    return parse


def _results(batches):
    for batch in batches:
        rows = []
        for conv, turn, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "text")), strict=True):
            try:
                found = parsed(text)
                key = _text(found["tool_call_id"])
                content = canonical(found.get("content"))
            except (ValueError, KeyError, TypeError, AttributeError, RecursionError):
                continue
            if key is not None:
                rows.append((conv, turn, key, content))
        yield _batch(rows, RESULTS)


def _ordered(key: tuple, edges: pa.Table) -> pa.Table:
    """Levels of the calls of one conversation; those on or behind a cycle get one more than it has backward references."""
    calls, refs, back = (edges[c].to_pylist() for c in ("call_id", "ref", "back"))
    most = edges["backward"][0].as_py() + 1
    users: dict[str, list[tuple[str, int]]] = {}
    waiting: dict[str, int] = dict.fromkeys(refs, 0)
    for call, ref, b in zip(calls, refs, back, strict=True):
        users.setdefault(ref, []).append((call, b))
        waiting[call] = waiting.get(call, 0) + 1
    level = dict.fromkeys(waiting, 0)
    ready = [c for c, n in waiting.items() if not n]
    while ready:
        ref = ready.pop()
        for call, b in users.get(ref, ()):
            level[call] = max(level[call], level[ref] + b)
            waiting[call] -= 1
            if not waiting[call]:
                ready.append(call)
    found = [(c, most if waiting[c] else n) for c, n in level.items() if n or waiting[c]]
    columns = {"conv_id": pa.array([key[0].as_py()] * len(found), pa.int64()), "call_id": pa.array([c for c, _ in found], pa.string())}
    return pa.table(columns | {"level": pa.array([n for _, n in found], pa.int32()), "backward": pa.array([most - 1] * len(found), pa.int32())})


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level, backward) of the calls of a level over 0; all others have level 0.

    A reference is backward if its call does not stand earlier. The level of a call is the greatest number of backward
    references on a path from it, so that sorting by level, turn and place puts every call behind those it refers to.
    A level above the number of the conversation's backward references means a cycle, or a call behind one. References to
    calls that don't exist don't count. Only conversations with backward references take part; one with at most
    ``GATHERED`` references is ordered by one task, and levels of longer ones are raised until nothing changes.
    """
    nodes = calls.select("conv_id", "call_id", "turn", "place")
    targets = nodes.select("conv_id", F.col("call_id").alias("ref"), F.struct("turn", "place").alias("target"))
    edges = calls.select("conv_id", "call_id", F.struct("turn", "place").alias("own"), F.explode("refs").alias("ref")).join(targets, ["conv_id", "ref"])
    edges = edges.select("conv_id", "call_id", "ref", (F.col("target") >= F.col("own")).cast("int").alias("back"))
    backward = edges.groupBy("conv_id").agg(F.sum("back").cast("int").alias("backward"), F.count("*").alias("size")).where("backward > 0")
    edges = written(edges.join(backward, "conv_id"), "references")
    small = edges.where(F.col("size") <= GATHERED).groupBy("conv_id").applyInArrow(_ordered, "conv_id long, call_id string, level int, backward int")
    return small.unionByName(_raised(edges.where(F.col("size") > GATHERED)))


def _raised(edges: DataFrame) -> DataFrame:
    """Levels of long conversations, raised along their references round by round."""
    level = written(edges.where("back = 1").select("conv_id", "call_id", F.lit(1).alias("level"), "backward").distinct(), "levels")
    raised = level
    while not raised.isEmpty():
        known = raised.select("conv_id", F.col("call_id").alias("ref"), F.col("level").alias("before"))
        new = edges.join(known, ["conv_id", "ref"]).groupBy("conv_id", "call_id").agg(F.max(F.least(F.col("before") + F.col("back"), F.col("backward") + 1)).alias("new"), F.first("backward").alias("b"))
        both = written(level.join(new, ["conv_id", "call_id"], "full").select("conv_id", "call_id", "level", "new", F.coalesce("backward", "b").alias("backward")), "levels")
        level = both.select("conv_id", "call_id", F.greatest("level", "new").alias("level"), "backward")
        raised = both.where("new > coalesce(level, 0)").select("conv_id", "call_id", F.col("new").alias("level"))
    return level


def link(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call, and per result without a call, with its place in a topological order and its canonical JSON.

    conv_id, call_id, name, level, turn, place (sort by level, turn, place within a conversation), result_turn, status and
    line. Of calls or results that repeat an identifier the first counts (by turn, place, text); further calls have the
    status duplicate_id and no result. Other statuses: ok, invalid (with the violation), no_result, no_call, cyclic,
    no_id. Messages without a conversation or turn, null texts and texts that are no such JSON are no calls or results;
    arguments that are no JSON, or nested too deep to be read, count as null. Halves of surrogate pairs are written as
    escapes. A result is any JSON value and is written canonically too; none is null.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").where("conv_id IS NOT NULL AND turn IS NOT NULL")
    calls = written(rows.where("role = 'assistant' AND text LIKE '%tool_calls%'").select("conv_id", "turn", "text").mapInArrow(_calls(schemas), CALLS), "calls")
    named = calls.where("call_id IS NOT NULL")
    order = F.struct("turn", "place", "name", "arguments", "refs", "error")
    first = named.groupBy("conv_id", "call_id").agg(F.min(order).alias("c"), F.count("*").alias("n")).select("conv_id", "call_id", "c.*", "n")
    first = written(first, "first")
    again = named.join(first.where("n > 1").select("conv_id", "call_id", F.col("turn").alias("t"), F.col("place").alias("p"), F.col("arguments").alias("a")), ["conv_id", "call_id"])
    again = again.where("NOT (turn = t AND place = p AND arguments <=> a)").select("conv_id", "call_id", "turn", "place", "name", "arguments", "error")
    results = rows.where("role = 'tool'").select("conv_id", "turn", "text").mapInArrow(_results, RESULTS)
    results = results.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("r"))
    results = results.select("conv_id", "call_id", F.col("r.turn").alias("result_turn"), F.col("r.content").alias("content"), F.lit(True).alias("answered"))
    linked = first.drop("refs", "n").join(results, ["conv_id", "call_id"], "full").join(_levels(first), ["conv_id", "call_id"], "left")
    linked = linked.withColumn("level", F.when(F.col("turn").isNotNull(), F.coalesce("level", F.lit(0))))
    status = (
        F.when(F.col("turn").isNull(), "no_call").when(F.col("level") > F.col("backward"), "cyclic").when(F.col("error").isNotNull(), F.concat(F.lit("invalid "), "error"))
        .when(F.col("answered").isNull(), "no_result").otherwise("ok")
    )
    linked = linked.withColumn("status", status).withColumn("level", F.when(F.col("status") != "cyclic", F.col("level"))).drop("backward")
    nothing = [F.lit(None).cast("long").alias("result_turn"), F.lit(None).cast("string").alias("content"), F.lit(None).cast("int").alias("level")]
    more = again.select("*", *nothing, F.lit("duplicate_id").alias("status")).unionByName(calls.where("call_id IS NULL").select("conv_id", "call_id", "turn", "place", "name", "arguments", "error", *nothing, F.lit("no_id").alias("status")))
    columns = ["conv_id", "call_id", "name", "level", "turn", "place", "result_turn", "status", "arguments", "content"]
    quoted = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("x"))), r'(?s)^\{"x":(.*)\}$', 1), F.lit("null"))
    either = lambda c: F.when(F.col(c).isNull(), F.lit("null")).otherwise(quoted(c))
    line = F.concat(
        F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'), either("call_id"), F.lit(',"name":'), either("name"),
        F.lit(',"result":'), F.coalesce("content", F.lit("null")), F.lit("}"),
    )
    return linked.select(columns).unionByName(more.select(columns)).select(*columns[:-2], line.alias("line"))
