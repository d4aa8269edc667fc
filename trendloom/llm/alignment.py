"""Cheapest edits that bring a sequence into a pattern of four states, in linear space.

Edits of a row: Keep, Rerole, Delete, with Inserts before it. The edits of a row are written as its
inserts and then its own initial, which no other row edit begins with, so the edits of equally many
rows are never a proper beginning of one another. Therefore ties can be broken while costs are
summed: a vector holds for every state its least cost, and the rank of its least edits among those
of the four states. Costs in vectors are less their smallest, so the same vectors come again and the latest
steps from one to the next are remembered.

``crossings`` is Hirschberg's scheme: a forward vector from the entry and a backward vector from the
exit meet in the middle, the best crossing with the least edits is chosen, and both halves are
solved alone. It needs no table of rows by states, and works on rows and on whole segments alike.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

# States by what was put out last: nothing, a system row, a user row, an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)

# A row's initial, and what is wrong with it.
INITIALS = "sua"
OTHER = 3
FINE, CUT_OFF, GONE = range(3)

# Fixed by the rules.
KEEP, REROLE, DELETE, INSERT, UNMENDED = 0, 1, 2, 5, 5

REMEMBERED = 1 << 16

# (next state, cost, edits) for each state before
Step = tuple[tuple[tuple[int, int, str], ...], ...]
# (cost, rank) for each state, or None where it can't be reached
Vector = tuple[tuple[int, int] | None, ...]


def code(initial: str, fault: int) -> int:
    """A row as a small number; an initial other than the three can't be kept, nor can an empty one."""
    at = INITIALS.find(initial) if initial else -1
    return 4 * fault + (at if at >= 0 else OTHER)


def put_out(state: int, initial: int) -> int | None:
    """The state after a row with this initial, if the pattern ``(s?(ua)+)?`` lets it follow."""
    if initial == 0:
        return SYSTEM if state == EMPTY else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def next_role(state: int) -> int:
    """The state after the one row, user or assistant, that may be inserted here."""
    return ASSISTANT if state == USER else USER


def _row_step(row: int) -> Step:
    fault, initial = divmod(row, 4)
    out = []
    for state in STATES:
        ways: dict[int, tuple[int, str]] = {}
        at = state
        for inserts in range(3):  # a third insert comes back to where one leads
            own = [(at, DELETE, "D")]
            if fault != GONE:
                more = UNMENDED if fault == CUT_OFF else 0
                own.append((next_role(at), REROLE + more, "R"))
                if (kept := put_out(at, initial)) is not None:
                    own.append((kept, KEEP + more, "K"))
            for to, cost, edit in own:
                way = (cost + INSERT * inserts, "I" * inserts + edit)
                ways[to] = min(ways.get(to, way), way)
            at = next_role(at)
        out.append(tuple((to, cost, edits) for to, (cost, edits) in sorted(ways.items())))
    return tuple(out)


ROW_STEPS = [_row_step(row) for row in range(12)]
# Inserts after the last row, until the pattern is whole.
CLOSING: dict[int, int] = {EMPTY: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
CLOSE: Step = tuple(((EMPTY, INSERT * CLOSING[s], "I" * CLOSING[s]),) for s in STATES)


def at_state(state: int) -> Vector:
    return tuple((0, 0) if s == state else None for s in STATES)


def _packed(best: list) -> Vector:
    """Costs less the smallest, and keys replaced by their rank."""
    found = [b for b in best if b is not None]
    least = min((b[0] for b in found), default=0)
    ranks = {key: i for i, key in enumerate(sorted({b[1:] for b in found}))}
    return tuple(None if b is None else (b[0] - least, ranks[b[1:]]) for b in best)


def forward(vector: Vector, step: Step) -> Vector:
    best: list = [None] * len(vector)
    for state, entry in enumerate(vector):
        if entry is not None:
            group = state - state % 4  # vectors may hold several starts, four states each
            for to, cost, edits in step[state % 4]:
                way = (entry[0] + cost, entry[1], edits)
                if best[group + to] is None or way < best[group + to]:
                    best[group + to] = way
    return _packed(best)


def backward(vector: Vector, step: Step) -> Vector:
    best: list = [None] * 4
    for state in STATES:
        for to, cost, edits in step[state]:
            if (entry := vector[to]) is not None:
                way = (cost + entry[0], edits, entry[1])
                if best[state] is None or way < best[state]:
                    best[state] = way
    return _packed(best)


@functools.lru_cache(maxsize=REMEMBERED)
def forward_row(vector: Vector, row: int) -> Vector:
    return forward(vector, ROW_STEPS[row])


@functools.lru_cache(maxsize=REMEMBERED)
def backward_row(vector: Vector, row: int) -> Vector:
    return backward(vector, ROW_STEPS[row])


def crossings(steps: Sequence, entry: int, exit: int, ahead: Callable = forward_row, back: Callable = backward_row) -> list[int]:
    """The state after each step on the best way from ``entry`` to ``exit``."""
    out = [exit] * len(steps)
    todo = [(0, len(steps), entry, exit)]
    while todo:
        first, last, start, end = todo.pop()
        if last - first < 2:
            continue
        middle = (first + last) // 2
        upper, lower = at_state(start), at_state(end)
        for i in range(first, middle):
            upper = ahead(upper, steps[i])
        for i in range(last - 1, middle - 1, -1):
            lower = back(lower, steps[i])
        ways = [(a[0] + b[0], a[1], b[1], s) for s, (a, b) in enumerate(zip(upper, lower, strict=True)) if a is not None and b is not None]
        state = min(ways)[3]
        out[middle - 1] = state
        todo += [(first, middle, start, state), (middle, last, state, end)]
    return out


def edits(rows: Sequence[int], entry: int, exit: int) -> list[tuple[int, str, int]]:
    """Cost, edits and the state after them, for each row on the best way from ``entry`` to ``exit``."""
    out, state = [], entry
    for row, to in zip(rows, crossings(rows, entry, exit), strict=True):
        out.append((*min((cost, text) for s, cost, text in ROW_STEPS[row][state] if s == to), to))
        state = to
    return out


@functools.lru_cache(maxsize=REMEMBERED)
def _forward_all(vector: Vector, row: int) -> tuple[Vector, int]:
    """The next vector, and by how much the smallest cost rose, which the vector leaves out."""
    rise = min(entry[0] + cost for s, entry in enumerate(vector) if entry is not None for _, cost, _ in ROW_STEPS[row][s % 4])
    return forward(vector, ROW_STEPS[row]), rise


def summary(rows: Sequence[int]) -> list[int]:
    """What a segment does to any entry: 16 costs and 16 ranks by entry and exit; -1 where there is no way.

    Ranks order the edits of all entries and exits, so a segment can stand as one step of a longer way.
    """
    vector: Vector = tuple((0, 0) if s % 5 == 0 else None for s in range(16))
    total = 0
    for row in rows:
        vector, rise = _forward_all(vector, row)
        total += rise
    return [-1 if v is None else v[0] + total for v in vector] + [-1 if v is None else v[1] for v in vector]


def segment_step(found: Sequence[int]) -> tuple:
    """A summary as a step; ranks stand for edits."""
    return tuple(tuple((to, found[4 * s + to], found[16 + 4 * s + to]) for to in STATES if found[4 * s + to] >= 0) for s in STATES)
