"""Least edits that make a sequence of turns alternate, in linear space.

The role initials of a repaired conversation match ``(s?(ua)+)?``. Its automaton has four states: nothing yet, after a
system turn, after a user's and after an assistant's turn; first and last of these may end. A turn is kept, given the
role that fits, or deleted, and turns may be inserted before it; the edits of a turn are one string of initials such as
``IK``. Each edit string leads from a state to one other, and the string of a whole path ends in a turn's own edit, so
strings of different paths over the same turns never start one another. A vector of costs and of the order of the four
strings is thus enough to find the cheapest path with the ASCII-least string: a forward and a backward vector meet in the
middle, the least optimal crossing is kept, and both halves are solved by themselves.
"""

from __future__ import annotations

import math

START, SYSTEM, USER, DONE = range(4)
STATES = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Kinds of turns: 0 to 3 by initial (s, u, a, any other), 4 more if truncated; one that has to go; the end.
INITIALS = "sua"
GONE, END = 8, 9
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, DONE: USER}, "a": {USER: DONE}}
_NEXT = {START: USER, SYSTEM: USER, DONE: USER, USER: DONE}
MEMORY = 200_000

Vector = tuple[tuple[float, ...], tuple[int, ...]]


def _moves(kind: int) -> dict[tuple[int, int], tuple[float, str]]:
    """(cost, edits) of the best way from state to state over one turn of a kind."""
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for start in STATES:
        state = start
        for inserts in range(3):
            cost, text = INSERT * inserts, "I" * inserts
            options = []
            if kind == END:
                options = [(DONE, cost, text)] if state in (START, DONE) else []
            else:
                options.append((state, cost + DELETE, text + "D"))
                if kind != GONE:
                    extra = TRUNCATED if kind >= 4 else 0
                    options.append((_NEXT[state], cost + REROLE + extra, text + "R"))
                    kept = _KEPT.get((INITIALS + "x")[kind % 4], {}).get(state)
                    if kept is not None:
                        options.append((kept, cost + KEEP + extra, text + "K"))
            for end, *found in options:
                best[start, end] = min(best.get((start, end), (math.inf, "")), tuple(found))
            state = _NEXT[state]
    return best


MOVES = [_moves(kind) for kind in range(END + 1)]
INTO = [[[(s, *m[s, t]) for s in STATES if (s, t) in m] for t in STATES] for m in MOVES]
OUT = [[[(t, m[s, t][0]) for t in STATES if (s, t) in m] for s in STATES] for m in MOVES]

_forward: dict[tuple[int, Vector], tuple[Vector, float]] = {}
_backward: dict[tuple[int, tuple[float, ...]], tuple[tuple[float, ...], float]] = {}


def ordered(chosen: list[tuple | None]) -> tuple[int, ...]:
    """Places of the four keys in their order; None is out of reach."""
    keys = sorted(k for k in chosen if k is not None)
    return tuple(-1 if k is None else keys.index(k) for k in chosen)


def only(state: int) -> Vector:
    return tuple(0.0 if s == state else math.inf for s in STATES), tuple(0 if s == state else -1 for s in STATES)


def forward(kinds: bytes, vector: Vector) -> Vector:
    """Costs of reaching each state over the turns, and the order of the strings that do so."""
    total = 0.0
    for kind in kinds:
        known = _forward.get((kind, vector))
        if known is None:
            costs, ranks = vector
            new, chosen = [], []
            for t in STATES:
                cost, rank, text = min(((costs[s] + c, ranks[s], text) for s, c, text in INTO[kind][t] if costs[s] < math.inf), default=(math.inf, 0, ""))
                new.append(cost)
                chosen.append((rank, text) if cost < math.inf else None)
            least = min(new)
            shift = least if least < math.inf else 0.0
            known = (tuple(c - shift for c in new), ordered(chosen)), shift
            if len(_forward) < MEMORY:
                _forward[kind, vector] = known
        vector, shift = known
        total += shift
    return tuple(c + total for c in vector[0]), vector[1]


def backward(kinds: bytes, costs: tuple[float, ...]) -> tuple[float, ...]:
    """Costs from each state over the turns to an end."""
    total = 0.0
    for kind in reversed(kinds):
        known = _backward.get((kind, costs))
        if known is None:
            new = [min((c + costs[t] for t, c in OUT[kind][s]), default=math.inf) for s in STATES]
            least = min(new)
            shift = least if least < math.inf else 0.0
            known = tuple(c - shift for c in new), shift
            if len(_backward) < MEMORY:
                _backward[kind, costs] = known
        costs, shift = known
        total += shift
    return tuple(c + total for c in costs)


def crossing(left: Vector, right: tuple[float, ...]) -> int:
    """The state in which the cheapest paths meet; of those the one whose string so far is least."""
    return min((left[0][s] + right[s], left[1][s], s) for s in STATES if left[0][s] + right[s] < math.inf)[2]


def edits(kinds: bytes, start: int = START, end: int = DONE) -> list[str]:
    """The edits of each turn on the cheapest, then ASCII-least path from a state to another."""
    out: list[str] = []
    todo = [(0, len(kinds), start, end)]
    while todo:
        a, b, start, end = todo.pop()
        if b - a == 1:
            out.append(MOVES[kinds[a]][start, end][1])
        elif b > a:
            mid = (a + b) // 2
            state = crossing(forward(kinds[a:mid], only(start)), backward(kinds[mid:b], only(end)[0]))
            todo += [(mid, b, state, end), (a, mid, start, state)]
    return out


def joined(left: Vector, matrix: list[Vector]) -> Vector:
    """The vector after one more part, of which the vectors from each state are known."""
    costs, chosen = [], []
    for t in STATES:
        found = min(((left[0][s] + matrix[s][0][t], left[1][s], matrix[s][1][t]) for s in STATES if left[0][s] + matrix[s][0][t] < math.inf), default=None)
        costs.append(found[0] if found else math.inf)
        chosen.append(found[1:] if found else None)
    return tuple(costs), ordered(chosen)


def crossings(parts: list[list[Vector]]) -> list[tuple[int, int]]:
    """(start, end) of every part of a sequence on its cheapest, ASCII-least path."""
    rights = [only(DONE)[0]]
    for matrix in reversed(parts):
        right = rights[-1]
        rights.append(tuple(min(matrix[s][0][t] + right[t] for t in STATES) for s in STATES))
    rights.reverse()
    left, state, out = only(START), START, []
    for k, matrix in enumerate(parts):
        left = joined(left, matrix)
        end = crossing(left, rights[k + 1])
        out.append((state, end))
        state = end
    return out
