"""Conversation repair against a search over all edit strings and against plain dynamic programming."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import turnrepair
from plumbline.llm.hirschberg import END, GONE, crossings, edits, forward, joined, only
from plumbline.llm.queries import damaged, op12_conversation_repair
from plumbline.llm.turnrepair import repair, summaries

SCHEMA = "conv_id long, turn long, role string, text string, edits string, place string"
SPACES = " \t\n\x0b\f\r"


def least(turns):
    """(cost, audit, repaired turns) by a best-first search over (cost, audit) of partial repairs; turns: (role, text, fault)."""
    heap = [(0, "", 0, "", ())]
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if at == len(turns) and (not roles or roles.lstrip("s") and roles[-1] == "a"):
            return cost, audit, out
        def step(role, text, cost, edit, at, roles=roles, audit=audit, out=out):
            follows = {"": "su", "s": "u", "u": "a", "a": "u"}[roles[-1:]]
            if role[:1] and role[:1] in follows:
                heapq.heappush(heap, (cost, audit + edit, at, roles + role[0], (*out, (role, text))))

        for role in ("user", "assistant"):
            step(role, "", cost + 3, "I", at)
        if at < len(turns):
            role, text, fault = turns[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles, out))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                step(role, text, cost + extra, "K", at + 1)
                for other in ("user", "assistant"):
                    step(other, text, cost + 3 + extra, "R", at + 1)


def table_of(turns):
    """(cost, audit, repaired) by the full table of whole strings."""
    empty = {"": (0, "", ())}
    for role, text, fault in turns:
        opened = inserted(empty)
        new = {}

        def put(state, item, new=new):
            new[state] = min(new.get(state, (10**9,)), item)

        for state, (cost, audit, out) in opened.items():
            follows = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            put(state, (cost + 4, audit + "D", out))
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if role[:1] and role[0] in follows:
                    put(role[0], (cost + extra, audit + "K", (*out, (role, text))))
                for other in ("user", "assistant"):
                    if other[0] in follows:
                        put(other[0], (cost + 3 + extra, audit + "R", (*out, (other, text))))
        empty = new
    return min(v for k, v in inserted(empty).items() if k in ("", "a"))


def inserted(states):
    found = dict(states)
    for _ in range(2):
        for state, (cost, audit, out) in list(found.items()):
            role = "assistant" if state == "u" else "user"
            item = (cost + 3, audit + "I", (*out, (role, "")))
            found[role[0]] = min(found.get(role[0], (10**9,)), item)
    return found


def kinds_of(turns):
    return bytes(GONE if f in ("blank", "duplicate") else (r[:1] and "sua".find(r[0]) % 4 if r else 3) + 4 * (f == "truncated") for r, _, f in turns)


def some_turns(n):
    return [(random.choice(["user", "assistant", "system", "tool", "user", "assistant"]), "t", random.choice([None, None, None, "blank", "truncated", "duplicate"])) for _ in range(n)]


def test_full_table_equals_a_search_over_all_edit_strings():
    random.seed(1)
    for _ in range(150):
        turns = some_turns(random.randint(0, 5))
        assert table_of(turns)[:2] == least(turns)[:2], turns


def test_divide_and_conquer_equals_the_full_table():
    random.seed(2)
    for n in [0, 1, 2, 3, 5, 8, 13, 40, 120] * 12:
        turns = some_turns(n)
        kinds = kinds_of(turns) + bytes([END])
        cost, audit, _ = table_of(turns)
        assert "".join(edits(kinds)) == audit and forward(kinds, only(0))[0][3] == cost, turns


def test_parts_meet_on_the_same_path():
    random.seed(3)
    for _ in range(60):
        turns = some_turns(random.randint(1, 60))
        kinds = kinds_of(turns) + bytes([END])
        cuts = sorted({0, len(kinds), *(random.randrange(len(kinds)) for _ in range(random.randint(0, 6)))})
        pieces = [kinds[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        states = crossings([[forward(p, only(s)) for s in range(4)] for p in pieces])
        assert "".join(e for p, (a, b) in zip(pieces, states, strict=True) for e in edits(p, a, b)) == "".join(edits(kinds))
        left = only(0)
        for p in pieces:
            left = joined(left, [forward(p, only(s)) for s in range(4)])
        assert left[0][3] == forward(kinds, only(0))[0][3]


def test_long_conversations_take_little_space():
    kinds = bytes(random.Random(4).choice([0, 1, 2, 3, 5, 8]) for _ in range(30_000)) + bytes([END])
    assert len(edits(kinds)) == len(kinds)


def brute(rows):
    """Contract rows by conversation from rows (conv, turn, role, text) after damage."""
    found = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode("utf-8", "surrogatepass")).hexdigest()))
        seen, turns = set(), []
        for _, role, text in mine:
            kept = text.rstrip(SPACES)
            fault = "blank" if not kept else "duplicate" if (role, text) in seen else None if kept[-1] in ".!?" else "truncated"
            seen.add((role, text))
            turns.append((role, text, fault))
        cost, audit, out = table_of(turns)
        numbers = [t for t, *_ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        counts = [sum(f == x for *_, f in turns) for x in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        text = "\n".join(f"{r}:{t}" for r, t in out)
        found[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return found


def contract(rows):
    return {r.conv_id: ((r.high or 0) - (r.low or 0) + 1 - r.distinct_turns if r.low is not None else 0, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


@pytest.mark.parametrize("size", [4096, 3])
def test_conversations_of_every_kind(frame, monkeypatch, size):
    monkeypatch.setattr(turnrepair, "RUN_TURNS", size)
    random.seed(5)
    rows = []
    for conv in range(60):
        for turn in range(random.randint(1, 9)):
            rows.append((conv, turn, random.choice(["user", "assistant", "system", "uzer", ""]), random.choice(["Hi.", "Hello there", "", " \n", "Same!", "é?", "x" * 500])))
    rows += [(70, t % 50, ["user", "assistant"][t % 2], f"turn {t % 60}.") for t in range(300)]  # one long conversation with ties
    rows += [(71, 5, "user", "Again.")] * 40  # equal rows
    rows += [(None, None, None, None), (None, 1, "user", "A."), (None, None, "user", "B?"), (None, 3, None, "C."), (72, None, None, None), (73, -4, "assistant", "a"), (73, 2, "system", ".")]
    rows += [(None, 2**62, "user", "A."), (74, 0, "user", "y " * 300_000 + ".")]
    random.shuffle(rows)
    got = summaries(frame([(*r, "x", "y") for r in rows], SCHEMA).repartition(7)).collect()
    assert contract(got) == brute(rows)


def test_repaired_turns_are_legal(frame):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "tool", "cut"), (2, 0, "system", "S."), (3, 0, "user", "")]
    runs = {r.conv_id: r for r in repair(frame([(*r, "", "") for r in rows], SCHEMA)).collect()}
    assert [(m.role, m.text) for m in runs[1].messages] == [("user", "A."), ("assistant", "B.")] and runs[1].edits == "KRD"
    assert runs[2].edits == "D" and runs[2].messages == [] and runs[3].edits == "D" and runs[3].cost == 4


def test_empty_table(frame):
    assert summaries(frame([], SCHEMA)).collect() == []


def test_query_on_odd_rows(spark, tmp_path):
    rows = [(c, t, ["system", "user", "assistant"][(t + c) % 3 if t % 7 == 3 else 1 + t % 2], f"Text {c} of {t % 4}. More") for c in range(40) for t in range(8)]
    rows += [(None, None, None, None), (99, None, "user", None), (50, 1, "user", "A b.\nc!")]
    spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, copy int").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    after = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else "".join(c for c in text if c not in ".!?") if code == 2 and text is not None else text
        after += [(conv, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    expected = dict.fromkeys({r[0] for r in rows}, (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())) | brute(after)
    got = op12_conversation_repair(spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r[1:]) for r in got} == expected and len(got) == len(expected)
    assert damaged(spark.read.parquet(f"{tmp_path}/conversations.parquet")).count() == len(after)


def test_null_texts_are_one_space(frame):
    got = repair(frame([(1, 0, "user", None, "", "")], SCHEMA)).select("blank", F.size("messages").alias("n")).first()
    assert (got.blank, got.n) == (1, 0)
