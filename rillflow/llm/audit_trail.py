"""The cheapest edits of a sequence of conversation turns, with ties broken by the text of the edits.

A turn is a code: whose role it has and whether it must go or is cut off. Reading turns, the roles that stay
pass through four states (nothing yet, after system, user or assistant). For a turn, or for any stretch of
turns, a `Table` says for each pair of states what the cheapest edits between them cost and where
their letters stand in ASCII order among those of the table. Tables of neighbours combine to that of
the whole stretch, so a conversation of any length is a tree of small tables.

Combining keeps, per start and state, one node of a persistent trail: nodes share their
prefixes, know their ancestors 1, 2, 4, ... steps up and a rolling hash of the path from the root. If two
trails cost the same, a search over the ancestors' hashes finds their longest common prefix, and the
first step that differs decides. Equal hashes are verified step by step, up to the shared node. Between equal costs and
ends no trail is a proper prefix of another, as a step always ends with the letter of a turn.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cmp_to_key, lru_cache

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
FINE, GO, TRUNCATED = range(3)  # what is wrong with a turn
OTHER = 3  # of the roles s, u, a by number
LETTERS = "sua"
_NEXT = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}  # the state after a user or an assistant
_MOD, _BASE = 2**61 - 1, 1_000_003

def code_of(role: int, fault: int) -> int:
    return 3 * role + fault


@dataclass(frozen=True)
class Table:
    """cost[4 * a + b] from state a to b (-1: impossible) and the rank of its letters."""

    cost: tuple[int, ...]
    rank: tuple[int, ...]


def _best(steps: dict, key, cost: int, letters: str) -> None:
    if key not in steps or (cost, letters) < steps[key]:
        steps[key] = (cost, letters)


@lru_cache(None)
def turn_steps(code: int) -> dict[tuple[int, int], tuple[int, str]]:
    """Cheapest letters of one turn between two states: insertions before it, then its own letter."""
    role, fault = divmod(code, 3)
    steps: dict = {}
    for a in range(STATES):
        before, cost, letters = a, 0, ""
        for _ in range(3):
            _best(steps, (a, before), cost + DELETE_COST, letters + DELETE)
            if fault != GO:
                more = cost + (TRUNCATED_COST if fault == TRUNCATED else 0)
                _best(steps, (a, _NEXT[before]), more + REROLE_COST, letters + REROLE)
                if role == 0 and before == START:
                    _best(steps, (a, SYSTEM), more, letters + KEEP)
                if role == _NEXT[before] - 1:
                    _best(steps, (a, _NEXT[before]), more, letters + KEEP)
            before, cost, letters = _NEXT[before], cost + INSERT_COST, letters + INSERT
    return steps


#: What is inserted behind the last turn, by the state there.
TAIL = {START: (0, ""), ASSISTANT: (0, ""), USER: (INSERT_COST, INSERT), SYSTEM: (2 * INSERT_COST, 2 * INSERT)}


def _table(steps: dict, rank_of) -> Table:
    pairs = [(a, b) for a in range(STATES) for b in range(STATES)]
    return Table(tuple(steps[p][0] if p in steps else -1 for p in pairs), tuple(rank_of(p) if p in steps else 0 for p in pairs))


@lru_cache(None)
def turn_table(code: int) -> Table:
    steps = turn_steps(code)
    order = sorted({letters for _, letters in steps.values()})
    return _table(steps, lambda p: order.index(steps[p][1]))


class Node:
    """The end of a trail: its last step and state, the trail before it, ancestors and hash."""

    __slots__ = ("state", "label", "hash", "up")

    def __init__(self, state: int, label: int = 0, parent: "Node | None" = None):
        self.state, self.label, self.up = state, label, []
        self.hash = 0
        if parent is not None:
            self.hash = (parent.hash * _BASE + label + 1) % _MOD
            at, k = parent, 0
            while at is not None:
                self.up.append(at)
                at = at.up[k] if k < len(at.up) else None
                k += 1


def _first_difference(x: Node, y: Node) -> int:
    """The sign of the first differing step above x and y, walking to their shared node: exact."""
    sign = 0
    while x is not y and x.up and y.up:
        if x.label != y.label:
            sign = -1 if x.label < y.label else 1
        x, y = x.up[0], y.up[0]
    return sign


def compare(x: Node, y: Node) -> int:
    """Order of two trails of as many steps, by their first differing one."""
    if x is y:
        return 0
    if x.hash == y.hash:
        return _first_difference(x, y)
    for k in range(len(x.up) - 1, -1, -1):
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    above = _first_difference(x.up[0], y.up[0])  # 0 unless unlike prefixes have one hash
    return above or (x.label > y.label) - (x.label < y.label)


def trails(tables: list[Table], starts: range | tuple = range(STATES)) -> dict[tuple[int, int], tuple[int, Node]]:
    """The best trail through all tables for each start and end."""
    best: dict = {}
    for start in starts:
        # roots of all starts are alike, as trails of unlike starts are compared too
        now = {start: (0, Node(start))}
        for t in tables:
            new: dict = {}
            for a, (cost, node) in now.items():
                for b in range(STATES):
                    more = t.cost[STATES * a + b]
                    if more < 0:
                        continue
                    if b in new and new[b][0] < cost + more:
                        continue
                    step = Node(b, t.rank[STATES * a + b], node)
                    if b not in new or cost + more < new[b][0] or compare(step, new[b][1]) < 0:
                        new[b] = (cost + more, step)
            now = new
        best |= {(start, b): found for b, found in now.items()}
    return best


def combined(tables: list[Table], starts: range | tuple = range(STATES)) -> Table:
    """The table of a stretch from those of its parts."""
    best = trails(tables, starts)
    nodes = sorted((node for _, node in best.values()), key=cmp_to_key(compare))
    rank, last = {}, None
    for node in nodes:
        if last is None:
            rank[id(node)] = 0
        else:
            rank[id(node)] = rank[id(last)] + (compare(last, node) != 0)
        last = node
    return _table(best, lambda p: rank[id(best[p][1])])


def path(tables: list[Table], start: int, end: int) -> list[tuple[int, int]]:
    """The states before and after each part on the best trail from start to end."""
    node, out = trails(tables, (start,))[start, end][1], []
    while node.up:
        out.append((node.up[0].state, node.state))
        node = node.up[0]
    return out[::-1]


def finished(table: Table) -> tuple[int, int]:
    """Cost of a whole conversation, and the state behind its last turn."""
    ends = {b: (table.cost[b] + TAIL[b][0], table.rank[b], TAIL[b][1]) for b in range(STATES) if table.cost[b] >= 0}
    end = min(ends, key=ends.get)
    return ends[end][0], end


def _stretch_table(codes: bytes, starts: tuple[int, ...]) -> Table:
    return combined([turn_table(c) for c in codes], starts)


def _stretch_edits(codes: bytes, start: int, end: int) -> list[tuple[str, int | None, int]]:
    out = []
    for i, (c, (a, b)) in enumerate(zip(codes, path([turn_table(c) for c in codes], start, end))):
        state = a
        for letter in turn_steps(c)[a, b][1]:
            if letter != DELETE:
                state = SYSTEM if letter == KEEP and c // 3 == 0 else _NEXT[state]
            out.append((letter, None if letter == INSERT else i, state))
    return out


SHORT = 16  # turns of stretches whose results are remembered, as they repeat; long ones would fill the memory
_known_table, _known_edits = lru_cache(100_000)(_stretch_table), lru_cache(100_000)(_stretch_edits)


def stretch_table(codes: bytes, starts: tuple[int, ...]) -> Table:
    return (_known_table if len(codes) <= SHORT else _stretch_table)(codes, starts)


def stretch_edits(codes: bytes, start: int, end: int) -> list[tuple[str, int | None, int]]:
    """The letters of a stretch: letter, number of its turn (none: inserted), state after it."""
    return (_known_edits if len(codes) <= SHORT else _stretch_edits)(codes, start, end)
