"""Block tables for the cheapest repair of a role sequence, after the Four Russians.

Rows are symbols, the wanted sequences a small automaton, and what is still to be
paid from each state of it a cost vector.  Vectors are kept relative to their least
entry; only a few dozen of those exist.  For every such vector and every block of
``BLOCK`` symbols the tables hold the vector on the block's left side and, for
each state before the block, the state after it.  A sequence is then worked off
block by block from the right; a block is expanded symbol by symbol only to write
down its edits.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np

BLOCK = 4
# Costs of the edits, and the roles that can be written.
DELETE, REROLE, INSERT, CUT_OFF = 3, 2, 2, 1
USER, ASSISTANT = "user", "assistant"

#: States: nothing written, system written, user written, assistant written.
START, SYSTEM, ASKED, ANSWERED = range(4)
STATES = 4
WHOLE = (START, ANSWERED)
#: What user or assistant turn can be written in each state, and the state after it.
WRITES = (USER, USER, ASSISTANT, USER)
NEXT = (ASKED, ASKED, ANSWERED, ASKED)
#: Initials a row can have: system, user, assistant, any other.
INITIALS = "sua"
SYMBOLS = 8


def symbol(initial: str, cut_off: bool) -> int:
    """The symbol of a row that may stay."""
    at = INITIALS.find(initial) if initial else -1
    return 2 * (at if at >= 0 else 3) + cut_off


def kept_state(state: int, sym: int) -> int | None:
    """The state after a row that keeps its role, if the role fits."""
    initial = sym // 2
    if initial == 0:
        return SYSTEM if state == START else None
    if initial < 3 and WRITES[state][0] == INITIALS[initial]:
        return NEXT[state]
    return None


def with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Cost vector when turns may be inserted first."""
    asked = min(costs[ASKED], INSERT + costs[ANSWERED])
    answered = min(costs[ANSWERED], INSERT + costs[ASKED])
    return (min(costs[START], INSERT + asked), min(costs[SYSTEM], INSERT + asked), asked, answered)


#: After the last row only inserts are left.
FINAL = with_inserts([0, 99, 99, 0])


def before_row(costs: tuple[int, ...], sym: int) -> tuple[int, ...]:
    """The cost vector before a row, from the one after it."""
    extra = CUT_OFF * (sym % 2)
    out = []
    for state in range(STATES):
        ways = [DELETE + costs[state], REROLE + extra + costs[NEXT[state]]]
        kept = kept_state(state, sym)
        if kept is not None:
            ways.append(extra + costs[kept])
        out.append(min(ways))
    return with_inserts(out)


def row_edits(state: int, costs: tuple[int, ...], sym: int) -> tuple[str, int]:
    """Edits up to and including a row, and the state after it.

    Of equally cheap edits the first by letter, D before I before K before R: an
    edit's letter settles where it leads, so this gives the least string.
    """
    here, extra, letters = before_row(costs, sym), CUT_OFF * (sym % 2), ""
    while True:
        if DELETE + costs[state] == here[state]:
            return letters + "D", state
        if INSERT + here[NEXT[state]] == here[state]:
            letters, state = letters + "I", NEXT[state]
            continue
        kept = kept_state(state, sym)
        if kept is not None and extra + costs[kept] == here[state]:
            return letters + "K", kept
        return letters + "R", NEXT[state]


def last_edits(state: int) -> str:
    """Inserts after the last row."""
    letters = ""
    while state not in WHOLE:
        letters, state = letters + "I", NEXT[state]
    return letters


@dataclass
class Tables:
    """``step[v, b]``: vector left of block ``b`` when ``v`` is right of it; ``end[v, b, q]``:
    state after the block when ``q`` is before it; ``edits``: the same for one row, with letters."""

    vectors: list[tuple[int, ...]]
    final: int
    step: dict[int, np.ndarray]
    end: dict[int, np.ndarray]
    edits: dict[tuple[int, int, int], tuple[str, int]]


def relative(costs: tuple[int, ...]) -> tuple[int, ...]:
    least = min(costs)
    return tuple(c - least for c in costs)


@functools.cache
def tables() -> Tables:
    """All vectors that can occur, and the tables for one row and for ``BLOCK`` rows."""
    vectors, number = [relative(FINAL)], {relative(FINAL): 0}
    left: list[list[int]] = []
    for v in vectors:  # grows while it is walked
        left.append([])
        for sym in range(SYMBOLS):
            w = relative(before_row(v, sym))
            if w not in number:
                number[w] = len(vectors)
                vectors.append(w)
            left[-1].append(number[w])
    edits = {(v, sym, q): row_edits(q, costs, sym)
             for v, costs in enumerate(vectors) for sym in range(SYMBOLS) for q in range(STATES)}
    n = len(vectors)
    step1 = np.array(left, np.int16)
    end1 = np.array([[[edits[v, sym, q][1] for q in range(STATES)] for sym in range(SYMBOLS)] for v in range(n)], np.int8)
    step, end = step1, end1
    for _ in range(BLOCK - 1):
        # One more row on the left of every block.
        after = end1[step]
        v, b = np.ogrid[:n, :step.shape[1]]
        end = end[v[:, :, None, None], b[:, :, None, None], after].transpose(0, 2, 1, 3).reshape(n, -1, STATES)
        step = step1[step].transpose(0, 2, 1).reshape(n, -1)
    return Tables(vectors, 0, {1: step1, BLOCK: step}, {1: end1, BLOCK: end}, edits)


def cut(symbols: list[int]) -> list[tuple[int, int]]:
    """``(rows, code)`` of single rows at the left and whole blocks after them."""
    head = len(symbols) % BLOCK
    out = [(1, s) for s in symbols[:head]]
    for at in range(head, len(symbols), BLOCK):
        code = 0
        for s in symbols[at: at + BLOCK]:
            code = code * SYMBOLS + s
        out.append((BLOCK, code))
    return out


def summary(symbols: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """What a stretch of rows does, whatever stands around it: for each vector right of
    it the vector left of it, and for each vector and state before it the state after."""
    t, parts = tables(), cut(symbols)
    vector = np.arange(len(t.vectors), dtype=np.int16)
    right = []
    for rows, code in reversed(parts):
        right.append(vector)
        vector = t.step[rows][vector, code]
    state = np.tile(np.arange(STATES, dtype=np.int8), (len(t.vectors), 1))
    for (rows, code), v in zip(parts, reversed(right), strict=True):
        state = t.end[rows][v[:, None], code, state]
    return vector, state


def trace(symbols: list[int], state: int, vector: int) -> tuple[list[str], int]:
    """The edits of each row, from the state before the first and the vector after the last."""
    t, parts = tables(), cut(symbols)
    right = []
    for rows, code in reversed(parts):
        right.append(vector)
        vector = int(t.step[rows][vector, code])
    out, at = [], 0
    for (rows, _), v in zip(parts, reversed(right), strict=True):
        # Expand the block backward, then write its edits forward.
        inner = []
        for sym in symbols[at: at + rows][::-1]:
            inner.append(v)
            v = int(t.step[1][v, sym])
        for sym, v_right in zip(symbols[at: at + rows], reversed(inner), strict=True):
            letters, state = t.edits[v_right, sym, state]
            out.append(letters)
        at += rows
    return out, state
