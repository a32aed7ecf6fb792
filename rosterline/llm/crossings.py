"""Cheapest edits of a sequence of turns, by divide and conquer in linear space.

A conversation is in order if its role initials spell ``(s?(ua)+)?``. Four states read that: the
start, after s, after u, after a. A step is a turn (or a run of turns) given as a 4 x 4 table of
costs from state to state. Forward and backward cost vectors meet in the middle of a sequence, an
optimal crossing state is chosen there, and both halves are solved alike.

Among equally cheap edits the audit, the edits' initials in order, that is least in ASCII is
taken. For that each cost comes with a rank: the order of the least audits that lead from one
start to the four states. Every audit of a step ends with the edit of its last turn, so none is
the beginning of another, and ranks of joined steps follow from ranks of the parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

STATES = range(4)
START, AFTER_S, AFTER_U, AFTER_A = STATES
NEXT = ({"s": AFTER_S, "u": AFTER_U}, {"u": AFTER_U}, {"a": AFTER_A}, {"u": AFTER_U})
INITIALS = "sua-"  # the last stands for any other
LEGAL = {"su", "ua", "au"}
MUST_DELETE, TRUNCATED = 1, 2  # faults; 0 is none or one that may stay
RE_ROLE, DELETE, INSERT, LEFT_TRUNCATED = 2, 3, 2, 1
# What closes a conversation after its last turn, by state.
TAIL = ("", "II", "I", "")
NO_WAY = -1


class Vector(NamedTuple):
    """Per state the cost to get there, NO_WAY if none, and the rank of the least audit."""

    costs: tuple[int, ...]
    ranks: tuple[int, ...]


Table = tuple[Vector, ...]  # one vector per state to start from


def fill_in(state: int) -> tuple[str, int]:
    """The only role, user or assistant, that may follow a state, and the state it leads to."""
    return ("assistant", AFTER_A) if state == AFTER_U else ("user", AFTER_U)


def _ranked(costs: Sequence[int], keys: Sequence) -> Vector:
    order = sorted((s for s in STATES if costs[s] != NO_WAY), key=lambda s: keys[s])
    ranks = [0] * 4
    for rank, s in enumerate(order):
        ranks[s] = rank
    return Vector(tuple(costs), tuple(ranks))


@lru_cache(maxsize=None)
def turn_edits(code: int) -> tuple[tuple[str | None, ...], ...]:
    """The cheapest, least edits of a turn from state to state: inserts, then the turn's own.

    The code is the initial's number plus four times the fault.
    """
    return tuple(tuple(None if best is None else best[1] for best in row)
                 for row in _turn_choices(code))


def _turn_choices(code: int) -> list[list[tuple[int, str] | None]]:
    initial, fault = INITIALS[code & 3], code >> 2
    left = LEFT_TRUNCATED if fault == TRUNCATED else 0
    table = []
    for start in STATES:
        found: list[tuple[int, str] | None] = [None] * 4
        state, cost, letters = start, 0, ""
        for _ in range(3):  # more than two inserts would come back to a state
            ways = [(state, DELETE, "D")]
            if fault != MUST_DELETE:
                ways.append((fill_in(state)[1], RE_ROLE + left, "R"))
                if initial in NEXT[state]:
                    ways.append((NEXT[state][initial], left, "K"))
            for end, more, letter in ways:
                way = (cost + more, letters + letter)
                if found[end] is None or way < found[end]:
                    found[end] = way
            state, cost, letters = fill_in(state)[1], cost + INSERT, letters + "I"
        table.append(found)
    return table


@lru_cache(maxsize=None)
def turn_table(code: int) -> Table:
    return tuple(
        _ranked([NO_WAY if best is None else best[0] for best in row],
                ["" if best is None else best[1] for best in row])
        for row in _turn_choices(code))


def at(state: int) -> Vector:
    return Vector(tuple(0 if s == state else NO_WAY for s in STATES), (0, 0, 0, 0))


def advance(vector: Vector, table: Table) -> Vector:
    """The vector after one more step."""
    costs, keys = [NO_WAY] * 4, [(0, 0)] * 4
    for s in STATES:
        if vector.costs[s] == NO_WAY:
            continue
        for t in STATES:
            if table[s].costs[t] == NO_WAY:
                continue
            way = vector.costs[s] + table[s].costs[t], (vector.ranks[s], table[s].ranks[t])
            if costs[t] == NO_WAY or way < (costs[t], keys[t]):
                costs[t], keys[t] = way
    return _ranked(costs, keys)


def retreat(costs: tuple[int, ...], table: Table) -> tuple[int, ...]:
    """Costs from each state to the end, one more step before it."""
    found = []
    for s in STATES:
        ways = [table[s].costs[t] + costs[t] for t in STATES
                if table[s].costs[t] != NO_WAY and costs[t] != NO_WAY]
        found.append(min(ways, default=NO_WAY))
    return tuple(found)


def _lowered(costs: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Costs less their least, so that few different vectors occur; and that least."""
    least = min(c for c in costs if c != NO_WAY)
    return tuple(c if c == NO_WAY else c - least for c in costs), least


@lru_cache(maxsize=1 << 16)
def _advance_turn(vector: Vector, code: int) -> tuple[Vector, int]:
    costs, ranks = advance(vector, turn_table(code))
    costs, least = _lowered(costs)
    return Vector(costs, ranks), least


@lru_cache(maxsize=1 << 16)
def _retreat_turn(costs: tuple[int, ...], code: int) -> tuple[int, ...]:
    return _lowered(retreat(costs, turn_table(code)))[0]


Steps = bytes | Sequence[Table]  # codes of turns, or tables


def forward(vector: Vector, steps: Steps, first: int, last: int) -> Vector:
    if not isinstance(steps, bytes):
        for i in range(first, last):
            vector = advance(vector, steps[i])
        return vector
    total = 0
    for i in range(first, last):
        vector, more = _advance_turn(vector, steps[i])
        total += more
    return Vector(tuple(c if c == NO_WAY else c + total for c in vector.costs), vector.ranks)


def backward(costs: tuple[int, ...], steps: Steps, first: int, last: int) -> tuple[int, ...]:
    """Costs from each state to the end; of turns only their differences."""
    for i in range(last - 1, first - 1, -1):
        costs = (_retreat_turn(costs, steps[i]) if isinstance(steps, bytes)
                 else retreat(costs, steps[i]))
    return costs


def joined(steps: Steps) -> Table:
    """All steps as one."""
    return tuple(forward(at(s), steps, 0, len(steps)) for s in STATES)


def closing(vector: Vector) -> tuple[int, int]:
    """The state to end in, before inserts that close the conversation, and the whole cost."""
    cost, _, state = min((c + INSERT * len(TAIL[s]), vector.ranks[s], s)
                         for s, c in enumerate(vector.costs) if c != NO_WAY)
    return state, cost


def crossings(steps: Steps, start: int, end: int) -> list[int]:
    """The state before each step and after the last, on the audit-least cheapest way."""
    states = [start] * len(steps) + [end]
    halves = [(0, len(steps))]
    while halves:  # at most one per level waits
        first, last = halves.pop()
        if last - first < 2:
            continue
        middle = (first + last) // 2
        here = forward(at(states[first]), steps, first, middle)
        there = backward(at(states[last]).costs, steps, middle, last)
        states[middle] = min(
            (here.costs[s] + there[s], here.ranks[s], s) for s in STATES
            if here.costs[s] != NO_WAY and there[s] != NO_WAY)[2]
        halves += [(first, middle), (middle, last)]
    return states


def edits(codes: bytes, start: int, end: int) -> Iterator[tuple[int, str, str | None]]:
    """The edits of turns on the way from state to state: turn's place, letter, new role.

    The role is None for what keeps its own; an insert comes with the place of the turn after it.
    """
    states = crossings(codes, start, end)
    for i, code in enumerate(codes):
        state = states[i]
        for letter in turn_edits(code)[state][states[i + 1]]:
            if letter in "IR":
                role, state = fill_in(state)
                yield i, letter, role
            else:
                yield i, letter, None
                if letter == "K":
                    state = NEXT[state][INITIALS[code & 3]]


def illegal_pairs(codes: bytes) -> int:
    """Neighbours whose initials may not follow each other."""
    return sum(not _legal(a, b) for a, b in zip(codes, codes[1:]))


@lru_cache(maxsize=None)
def _legal(a: int, b: int) -> bool:
    return INITIALS[a & 3] + INITIALS[b & 3] in LEGAL
