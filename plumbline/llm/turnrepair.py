"""Repair of the structure of conversations: empty, repeated and cut-off turns, and roles that do not alternate.

Turns are ranged by conversation and order, so that a conversation of any size lies in neighbouring partitions. A task
packs its turns into runs of bounded size. A conversation that lies inside one partition is solved at once by divide and
conquer (``hirschberg``). Runs of other conversations carry their four-state cost vectors, from each state they may start
in; the vectors of a conversation's runs, and nothing else of it, meet in one place, where the states between the runs are
chosen, and every run is then solved by itself.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.functions.lineage import written
from plumbline.llm.hirschberg import END, GONE, INITIALS, STATES, crossings, edits, forward, only

RUN_TURNS = 4096
RUN_BYTES = 4 << 20
KNOWN_EDITS = 50_000
_SPACES = " \t\n\x0b\f\r"
_LEGAL = {"su", "ua", "au"}
ROLES = ("user", "assistant")

_MESSAGES = "array<struct<role:string,text:string>>"
_COUNTS = "turns long, low long, high long, distinct_turns long, blank long, duplicate long, truncated long, illegal long, cost long"
_NUMBERS = [c.split()[0] for c in _COUNTS.split(", ")]
_RUN = f"whole boolean, place long, first_initial string, last_initial string, {_COUNTS}, edits string, messages {_MESSAGES}, kinds binary, costs array<double>, ranks array<int>"


def _ordered(rows: DataFrame) -> DataFrame:
    """The turns of each conversation in order, equal rows once with their number, with kind and fault."""
    # conversation, role and text in one key, so that a null conversation needs no case of its own
    parts = [F.coalesce(F.col("conv_id").cast("string"), F.lit("\0")), F.col("role"), F.col("text")]
    key = F.unhex(F.sha2(F.concat(*[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]), 256))
    keyed = rows.withColumn("key", key).withColumn("text_key", F.sha2("text", 256))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    again = keyed.groupBy("key").agg(F.min(when).alias("first"), F.max(when).alias("last")).where("first <> last").select("key", "first")
    once = keyed.groupBy("conv_id", "turn", "role", "text_key", "key").agg(F.first("text").alias("text"), F.count("*").alias("n"))
    kept = F.rtrim(F.col("text"), F.lit(_SPACES))
    fault = F.when(kept == "", "blank").when(when > F.col("first"), "duplicate").when(~F.substring(kept, -1, 1).isin(".", "!", "?"), "truncated")
    ordered = once.join(again, "key", "left").withColumn("fault", fault)
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_key")]
    return ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "n", "fault", F.substring("role", 1, 1).alias("initial"))


class _Run:
    """Turns of one conversation that follow each other in one partition."""

    def __init__(self, conversation, before: int):
        self.conversation, self.before, self.bytes = conversation, before, 0
        self.kinds, self.messages, self.initials, self.turns = bytearray(), [], [], []
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)

    def add(self, turn, role, text, fault, initial) -> None:
        if fault:
            self.faults[fault] += 1
        kind = INITIALS.find(initial) % 4 if initial else 3
        self.kinds.append(GONE if fault in ("blank", "duplicate") else kind + 4 * (fault == "truncated"))
        # a turn that has to go needs no text
        self.messages.append(("", "") if self.kinds[-1] == GONE else (role, text))
        self.initials.append(initial)
        if turn is not None and (not self.turns or turn != self.turns[-1]):
            self.turns.append(turn)
        self.bytes += 64 + sum(map(len, self.messages[-1]))

    def row(self, place: int, whole: bool, known: dict[bytes, list[str]]) -> dict:
        kinds, pairs = bytes(self.kinds), zip(self.initials, self.initials[1:], strict=False)
        row = {"conv_id": self.conversation, "whole": whole, "place": place, "first_initial": self.initials[0], "last_initial": self.initials[-1]}
        row |= {"turns": len(kinds), "low": min(self.turns, default=None), "high": max(self.turns, default=None), "distinct_turns": len(self.turns)}
        row |= self.faults | {"illegal": sum(a + b not in _LEGAL for a, b in pairs)}
        if whole:
            found = known.get(kinds)
            if found is None:
                found = edits(kinds + bytes([END]))
                if len(known) < KNOWN_EDITS:
                    known[kinds] = found
            cost = int(forward(kinds + bytes([END]), only(0))[0][3])
            return row | {"cost": cost, "edits": "".join(found), "messages": repaired(found, self.messages, 0), "kinds": None, "costs": None, "ranks": None}
        matrix = [forward(kinds, only(s)) for s in STATES]
        messages = [{"role": r, "text": t} for r, t in self.messages]
        return row | {"cost": None, "edits": None, "messages": messages, "kinds": kinds, "costs": [c for v in matrix for c in v[0]], "ranks": [r for v in matrix for r in v[1]]}


def repaired(found: list[str], messages: list[tuple[str, str]], state: int) -> list[dict]:
    """The turns that the edits leave, from a state on; the last edits may stand after the last turn."""
    out = []
    for k, text in enumerate(found):
        for edit in text:
            if edit == "D":
                continue
            role = ROLES[state == 2]
            if edit == "K":
                out.append({"role": messages[k][0], "text": messages[k][1]})
                state = 1 if messages[k][0][:1] == "s" else 3 if messages[k][0][:1] == "a" else 2
            else:
                out.append({"role": role, "text": messages[k][1] if edit == "R" else ""})
                state = 3 if state == 2 else 2
    return out


def _packed(schema: pa.Schema):
    def pack(batches):
        known: dict[bytes, list[str]] = {}
        place, run, ready, held = TaskContext.get().partitionId() << 40, None, [], 0
        inner = False  # whether another conversation of the partition came before

        def close(whole: bool):
            nonlocal place, held
            ready.append(run.row(place, whole and inner and not run.before, known))
            place, held = place + 1, held + run.bytes

        for batch in batches:
            for conversation, turn, role, text, n, fault, initial in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run is not None and run.conversation != conversation:
                    close(True)
                    run, inner = None, True
                for copy in range(n):
                    if run is not None and (len(run.kinds) >= RUN_TURNS or run.bytes + len(text) > RUN_BYTES):
                        close(False)
                        run = _Run(conversation, run.before + 1)
                    if run is None:
                        run = _Run(conversation, 0)
                    run.add(turn, role, text, "duplicate" if copy and fault != "blank" else fault, initial)
                    if held > RUN_BYTES or len(ready) >= 2000:
                        yield pa.RecordBatch.from_pylist(ready, schema)
                        ready, held = [], 0
        if run is not None:
            close(False)
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)

    return pack


def _matrix(costs: list[float], ranks: list[int]):
    return [(tuple(costs[4 * s : 4 * s + 4]), tuple(ranks[4 * s : 4 * s + 4])) for s in STATES]


def _grouped(batches, columns: list[str]):
    """(conversation, rows) of batches that are sorted by conversation and place."""
    now, held = None, []
    for batch in batches:
        for row in batch.select(columns).to_pylist():
            if held and now != row["conv_id"]:
                yield now, held
                held = []
            now = row["conv_id"]
            held.append(row)
    if held:
        yield now, held


_ENDING = [(tuple(c if t == 3 else math.inf for t in STATES), (-1, -1, -1, 0)) for c in (forward(bytes([END]), only(s))[0][3] for s in STATES)]


def _met(schema: pa.Schema):
    columns = ["conv_id", "place", "first_initial", "last_initial", *_NUMBERS[:-1], "costs", "ranks"]

    def meet(batches):
        for _, runs in _grouped(batches, columns):
            parts = [_matrix(r["costs"], r["ranks"]) for r in runs] + [_ENDING]
            states = crossings(parts)
            cost = sum(part[a][0][b] for part, (a, b) in zip(parts, states, strict=True))
            total = {k: sum(r[k] for r in runs) for k in ("turns", "distinct_turns", "blank", "duplicate", "truncated", "illegal")}
            for a, b in zip(runs, runs[1:], strict=False):
                total["illegal"] += (a["last_initial"] or "") + (b["first_initial"] or "") not in _LEGAL
                total["distinct_turns"] -= a["high"] is not None and a["high"] == b["low"]
            lows, highs = ([r[k] for r in runs if r[k] is not None] for k in ("low", "high"))
            total |= {"low": min(lows, default=None), "high": max(highs, default=None), "cost": int(cost)}
            out = []
            for k, (r, (start, end)) in enumerate(zip(runs, states, strict=False)):
                last = k == len(runs) - 1
                out.append({"place": r["place"], "start": start, "end": end, "final": last, "runs": len(runs)} | {n: total[n] if not k else None for n in _NUMBERS})
            yield pa.RecordBatch.from_pylist(out, schema)

    return meet


def _solved(schema: pa.Schema):
    def solve(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                kinds, messages = row["kinds"], [(m["role"], m["text"]) for m in row["messages"]]
                found = edits(kinds, row["start"], row["end"])
                if row["final"]:
                    found.append(edits(bytes([END]), row["end"], 3)[0])
                row |= {"edits": "".join(found), "messages": repaired(found, messages, row["start"])}
                yield pa.RecordBatch.from_pylist([{n: row[n] for n in schema.names}], schema)

    return solve


def _schemas(columns: str, conversation: T.DataType | None = None) -> tuple[T.StructType, pa.Schema]:
    """Spark's and Arrow's schema of some columns, after the conversation's own."""
    schema = T.StructType([*([T.StructField("conv_id", conversation)] if conversation else []), *T.StructType.fromDDL(columns).fields])
    return schema, to_arrow_schema(schema)


def repair(conversations: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired turns of every conversation, in runs: conv_id, place (the order of a conversation's runs), runs (how many
    it has), edits (their initials) and messages (role and text of what stays); and, on the first run of a conversation, null on the others:
    turns, low, high and distinct_turns (of the turn numbers that are not null), blank, duplicate and truncated (turns by
    their first fault), illegal (neighbours whose role initials are not su, ua or au) and cost.

    A null role or text counts as one space; a null conversation is a conversation. Turns come in the order of their
    numbers, nulls first; equal numbers in the order of role and of the text's SHA-256; equal rows follow each other. A
    conversation of any length, and a text of any length, is repaired whole: runs hold at most 4,096 turns or 4 MB, or one
    longer text. An empty table gives no runs. Other columns are ignored.
    """
    named = lambda c: F.col(f"`{c}`")
    space = lambda c: F.coalesce(named(c).cast("string"), F.lit(" "))
    rows = conversations.select(named(conversation).alias("conv_id"), named(turn).cast("long").alias("turn"), space(role).alias("role"), space(text).alias("text"))
    kind = rows.schema["conv_id"].dataType
    schema, arrow = _schemas(_RUN, kind)
    runs = written(_ordered(rows).mapInArrow(_packed(arrow), schema), "turns")
    parts = runs.where("NOT whole")
    narrow = parts.select("conv_id", "place", "first_initial", "last_initial", *_NUMBERS[:-1], "costs", "ranks")
    schema, arrow = _schemas(f"place long, start int, end int, final boolean, runs int, {_COUNTS}")
    met = narrow.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_met(arrow), schema)
    schema, arrow = _schemas(f"place long, runs int, {_COUNTS}, edits string, messages {_MESSAGES}", kind)
    joined = parts.select("conv_id", "place", "kinds", "messages").join(met, "place")
    return runs.where("whole").withColumn("runs", F.lit(1)).select(*schema.names).unionByName(joined.mapInArrow(_solved(arrow), schema))


def line(message: Column) -> Column:
    return F.concat(message["role"], F.lit(":"), message["text"])


def _hashed(schema: pa.Schema):
    def write(batches):
        now, out = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                (row,) = batch.slice(at, 1).to_pylist()
                if out is None or row["conv_id"] != now:
                    if out is not None:
                        yield finished(now, out)
                    now, out = row["conv_id"], [hashlib.sha256(), bytearray(), False, {n: row[n] for n in _NUMBERS}]
                for m in row["messages"]:
                    out[0].update((("\n" if out[2] else "") + m["role"] + ":" + m["text"]).encode("utf-8", "surrogatepass"))
                    out[2] = True
                out[1] += row["edits"].encode()
        if out is not None:
            yield finished(now, out)

    def finished(conversation, out):
        row = {"conv_id": conversation, "audit": out[1].decode(), "repaired_sha256": out[0].hexdigest()} | out[3]
        return pa.RecordBatch.from_pylist([row], schema)

    return write


def summaries(conversations: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``: its counts, audit (all edits) and repaired_sha256 (of role:text lines).

    Conversations in several runs are hashed run by run in order; what is held of one is its edits.
    """
    runs = repair(conversations)
    schema, arrow = _schemas(f"audit string, repaired_sha256 string, {_COUNTS}", runs.schema["conv_id"].dataType)
    text = F.array_join(F.transform("messages", line), "\n")
    alone = runs.where("runs = 1").select("conv_id", F.col("edits").alias("audit"), F.sha2(text, 256).alias("repaired_sha256"), *_NUMBERS)
    several = runs.where("runs > 1").repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_hashed(arrow), schema)
    return alone.unionByName(several)
