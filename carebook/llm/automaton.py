"""Rules as one deterministic automaton over bytes.

A rule is a regular expression from a plain subset (literals, classes, groups,
alternatives, repeats, ``(?i:...)`` for ASCII letters). All rules become one
nondeterministic automaton, subset construction makes it deterministic over
classes of equal bytes, and partition refinement makes it minimal. The result
is three arrays: class of a byte, next state, and rules accepted in a state.
"""

from __future__ import annotations

from re import _constants as C
from re import _parser

import numpy as np

MAX_STATES = 60_000


class _Nfa:
    def __init__(self):
        self.empty: list[list[int]] = []
        self.steps: list[list[tuple[frozenset, int]]] = []
        self.counted: dict[int, tuple[int, int]] = {}  # state: (its counted repeat, copies done)

    def state(self) -> int:
        self.empty.append([])
        self.steps.append([])
        return len(self.empty) - 1

    def add(self, items, start: int, fold: bool) -> int:
        """Add a parsed sequence from ``start``; returns its end state."""
        for op, arg in items:
            if op is C.LITERAL:
                start = self._step(start, _folded({arg}, fold))
            elif op is C.IN:
                start = self._step(start, _folded(_class(arg), fold))
            elif op is C.BRANCH:
                end = self.state()
                for branch in arg[1]:
                    self.empty[self.add(branch, start, fold)].append(end)
                start = end
            elif op is C.SUBPATTERN:
                _, on, off, inner = arg
                start = self.add(inner, start, (fold or bool(on & C.SRE_FLAG_IGNORECASE)) and not off & C.SRE_FLAG_IGNORECASE)
            elif op is C.MAX_REPEAT:
                least, most, inner = arg
                repeat = len(self.empty)
                for done in range(least):
                    start = self.add(inner, start, fold)
                    if len(inner) == 1 and inner[0][0] in (C.IN, C.LITERAL):
                        self.counted[start] = (repeat, done + 1)
                if most is C.MAXREPEAT:
                    loop, end = self.state(), self.state()
                    self.empty[start] += [loop, end]
                    self.empty[self.add(inner, loop, fold)] += [loop, end]
                    start = end
                else:
                    end = self.state()
                    for _ in range(most - least):
                        self.empty[start].append(end)
                        start = self.add(inner, start, fold)
                    self.empty[start].append(end)
                    start = end
            else:
                raise ValueError(f"not in the subset of regular expressions: {op}")
        return start

    def _step(self, start: int, codes: frozenset) -> int:
        end = self.state()
        self.steps[start].append((codes, end))
        return end

    def furthest(self, states: set[int]) -> set[int]:
        """``states`` without those behind another in the same counted repeat of one class:
        whatever they still meet, the furthest one meets no later."""
        most: dict[int, int] = {}
        for s in states & self.counted.keys():
            repeat, done = self.counted[s]
            most[repeat] = max(done, most.get(repeat, 0))
        return {s for s in states if s not in self.counted or most[self.counted[s][0]] == self.counted[s][1]}

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.empty[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


def _class(items) -> set[int]:
    out: set[int] = set()
    negated = False
    for op, arg in items:
        if op is C.NEGATE:
            negated = True
        elif op is C.LITERAL:
            out.add(arg)
        elif op is C.RANGE:
            out |= set(range(arg[0], arg[1] + 1))
        else:
            raise ValueError(f"not in the subset of character classes: {op}")
    return set(range(128)) - out if negated else out


def _folded(codes: set[int], fold: bool) -> frozenset:
    if max(codes) > 127:
        raise ValueError("rules are ASCII")
    both = {c ^ 32 for c in codes if 65 <= c & ~32 <= 90} if fold else set()
    return frozenset(codes | both)


class Automaton:
    """``next[state, class_of[byte]]``; ``accepts[state]`` has bit r for rule r; state 0 is
    the start. With ``anywhere`` a match may begin at every byte and what counts is
    where a rule is first met; else it begins at the first byte."""

    def __init__(self, rules: list[str], anywhere: bool):
        nfa = _Nfa()
        first = nfa.state()
        final: dict[int, int] = {}
        for r, rule in enumerate(rules):
            begin = nfa.state()
            nfa.empty[first].append(begin)
            final[nfa.add(_parser.parse(rule), begin, False)] = r
        # Bytes that every step treats alike are one class.
        member = np.zeros((256, sum(map(len, nfa.steps))), bool)
        column = 0
        for steps in nfa.steps:
            for codes, _ in steps:
                member[list(codes), column] = True
                column += 1
        _, sample, class_of = np.unique(member, axis=0, return_index=True, return_inverse=True)
        class_of = class_of.reshape(-1)
        begin = nfa.closure([first])
        number, sets, table = {begin: 0}, [begin], []
        while len(table) < len(sets):
            here, row = sets[len(table)], []
            for byte in sample.tolist():
                moved = {to for s in here for codes, to in nfa.steps[s] if byte in codes}
                there = nfa.closure(nfa.furthest(moved)) | begin if anywhere else nfa.closure(moved)
                if there not in number:
                    if len(sets) >= MAX_STATES:
                        raise ValueError("the rules need too many states")
                    number[there] = len(sets)
                    sets.append(there)
                row.append(number[there])
            table.append(row)
        accepts = np.array([sum(1 << final[s] for s in states if s in final) for states in sets], np.uint32)
        self.class_of = class_of.astype(np.uint8)
        self.next, self.accepts = _minimal(np.array(table, np.int64), accepts)
        # Bytes after which every state is the start state: no match runs over them.
        self.resets = (self.next == 0).all(0)[self.class_of] if anywhere else np.zeros(256, bool)
        dead = (self.next == np.arange(len(self.next))[:, None]).all(1) & (self.accepts == 0)
        self.dead = int(np.flatnonzero(dead)[0]) if dead.any() else -1

    def arrays(self) -> dict:
        """What a worker needs of the automaton, in plain arrays."""
        return {k: v for k, v in vars(self).items() if not k.startswith("_")}

    @classmethod
    def of_arrays(cls, arrays: dict) -> Automaton:
        self = cls.__new__(cls)
        vars(self).update(arrays)
        return self

    def longest(self, data: bytes, start: int) -> int:
        """End of the longest match that begins at ``start``; -1 if there is none."""
        rows = self.by_byte()
        state, end, accepts, dead = 0, -1, self._accept_list, self.dead
        for at in range(start, len(data)):
            state = rows[state][data[at]]
            if state == dead:
                break
            if accepts[state]:
                end = at + 1
        return end

    def by_byte(self) -> list[list[int]]:
        """The table with a column for each byte, as lists; kept."""
        if not hasattr(self, "_rows"):
            self._rows = self.next[:, self.class_of].tolist()
            self._accept_list = self.accepts.tolist()
        return self._rows


def _minimal(table: np.ndarray, accepts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge states that no input tells apart; state 0 stays the start."""
    block = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # Number blocks by first state, so that the start state is block 0.
    _, firsts, block = np.unique(block, return_index=True, return_inverse=True)
    order = np.argsort(firsts)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    block = rank[block.reshape(-1)]
    firsts = firsts[order]
    return block[table[firsts]], accepts[firsts]


def hits(auto: Automaton, data: np.ndarray, lanes: int = 2048) -> np.ndarray:
    """Positions in ``data`` after whose byte a rule is accepted, ascending.

    One pass over the bytes, by many lanes side by side: each lane is a run of
    the data and begins at the last reset byte before its run, where the state
    is known to be the start state. ``auto`` must be built with ``anywhere``.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    resets = np.flatnonzero(auto.resets[data])
    width = max(256, -(-n // lanes))
    firsts = np.arange(0, n, width)
    before = np.searchsorted(resets, firsts, side="left") - 1
    warm = np.where(before >= 0, resets[np.maximum(before, 0)] + 1, 0) if len(resets) else np.zeros(len(firsts), np.int64)
    lead = firsts - warm
    flat = np.ascontiguousarray(auto.next * auto.next.shape[1]).astype(np.int32).reshape(-1)
    accepting = auto.accepts > 0
    wide = auto.next.shape[1]
    classes = auto.class_of[data]
    state = np.zeros(len(firsts), np.int32)
    # Warm-up: lanes with a long lead go first, the others join when theirs begins.
    order = np.argsort(-lead, kind="stable")
    sorted_lead = lead[order]
    todo = int(sorted_lead[0])
    while todo > 0:
        active = int(np.searchsorted(-sorted_lead, -todo, side="right"))
        who = order[:active]
        state[who] = flat[state[who] + classes[firsts[who] - todo]]
        todo -= 1
    padded = np.zeros(len(firsts) * width, np.uint8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(len(firsts), width).T)
    marks = np.zeros((width, len(firsts)), bool)
    accepting_at = np.zeros(len(flat), bool)
    accepting_at[::wide] = accepting
    for at in range(width):
        state = flat[state + columns[at]]
        marks[at] = accepting_at[state]
    lane_at = np.flatnonzero(marks.T.reshape(-1))
    return lane_at[lane_at < n]
