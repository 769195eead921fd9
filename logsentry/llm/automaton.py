"""Rules as one deterministic automaton over bytes.

Each rule is a regular expression in ASCII without negated classes, look-arounds and lazy or possessive repeats. Subset
construction makes it an automaton that searches: a state holds, in the order of their starts, the sets of places that each
attempt can be at. Once an attempt accepts, it alone lives on until it fails, and the search goes on at that byte: so matches
are the leftmost ones, as long as can be, and do not overlap. The automata are minimised, their reachable combinations are
one automaton, and that is minimised again. Its transition array is indexed by state and byte class.

A rule must keep accepting until it fails, and no attempt may accept while an earlier one is open; others raise a ValueError.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Sequence
from re import _constants as sre  # the parsed form of Python's own expressions
from re import _parser as sre_parser
from typing import NamedTuple

import numpy as np

MAX_STATES = 60_000


class Rule(NamedTuple):
    """``least``: bytes a match must have from the one that first completes it to its end.

    Counting so, rather than by long repeats, keeps the combined automaton small: counters of rules that can run at one time multiply.
    """

    kind: str
    pattern: str
    least: int = 1


class Nfa:
    """Places joined by empty steps and by steps over sets of bytes."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.steps: list[list[tuple[frozenset[int], int]]] = []

    def place(self) -> int:
        self.empty.append([])
        self.steps.append([])
        return len(self.empty) - 1

    def closure(self, places: set[int] | frozenset[int]) -> frozenset[int]:
        found, todo = set(places), list(places)
        while todo:
            for q in self.empty[todo.pop()]:
                if q not in found:
                    found.add(q)
                    todo.append(q)
        return frozenset(found)

    def move(self, places: frozenset[int], byte: int) -> frozenset[int]:
        return self.closure({q for p in places for wanted, q in self.steps[p] if byte in wanted})

    def reversed(self) -> Nfa:
        turned = Nfa()
        for _ in self.empty:
            turned.place()
        for p, targets in enumerate(self.empty):
            for q in targets:
                turned.empty[q].append(p)
        for p, steps in enumerate(self.steps):
            for wanted, q in steps:
                turned.steps[q].append((wanted, p))
        return turned


def _bytes(items: list, ignore_case: bool) -> frozenset[int]:
    found: set[int] = set()
    for op, value in items:
        if op is sre.LITERAL:
            found.add(value)
        elif op is sre.RANGE:
            found.update(range(value[0], value[1] + 1))
        else:
            raise ValueError(f"a rule cannot hold {op}")
    if max(found, default=0) > 0x7F:
        raise ValueError("a rule must be ASCII")
    return frozenset(found | {ord(chr(b).swapcase()) for b in found} if ignore_case else found)


def _add(nfa: Nfa, tree, at: int, ignore_case: bool) -> int:
    """Add a parsed expression after the place ``at``; returns the place behind it."""
    for op, value in tree:
        if op is sre.LITERAL or op is sre.IN:
            after = nfa.place()
            nfa.steps[at].append((_bytes([(op, value)] if op is sre.LITERAL else value, ignore_case), after))
            at = after
        elif op is sre.SUBPATTERN:
            _, on, off, inner = value
            at = _add(nfa, inner, at, (ignore_case or bool(on & re.IGNORECASE)) and not off & re.IGNORECASE)
        elif op is sre.BRANCH:
            after = nfa.place()
            for inner in value[1]:
                first = nfa.place()
                nfa.empty[at].append(first)
                nfa.empty[_add(nfa, inner, first, ignore_case)].append(after)
            at = after
        elif op is sre.MAX_REPEAT:
            least, most, inner = value
            for _ in range(least):
                at = _add(nfa, inner, at, ignore_case)
            if most is sre.MAXREPEAT:
                loop, after = nfa.place(), nfa.place()
                nfa.empty[at].append(loop)
                nfa.empty[loop].append(after)
                nfa.empty[_add(nfa, inner, loop, ignore_case)].append(loop)
                at = after
            else:
                after = nfa.place()
                for _ in range(most - least):
                    nfa.empty[at].append(after)
                    at = _add(nfa, inner, at, ignore_case)
                nfa.empty[at].append(after)
                at = after
        else:
            raise ValueError(f"a rule cannot hold {op}")
    return at


def _parsed(pattern: str) -> tuple[Nfa, int, int]:
    nfa = Nfa()
    start = nfa.place()
    return nfa, start, _add(nfa, sre_parser.parse(pattern), start, False)


def _classes(nfas: Sequence[Nfa]) -> np.ndarray:
    """Class of each byte: bytes of one class are told apart by no rule."""
    wanted = sorted({tuple(sorted(w)) for nfa in nfas for steps in nfa.steps for w, _ in steps})
    member = np.zeros((256, max(len(wanted), 1)), bool)
    for k, w in enumerate(wanted):
        member[list(w), k] = True
    return np.unique(member, axis=0, return_inverse=True)[1].reshape(-1).astype(np.uint8)


def _subsets(start, step: Callable, symbols: Sequence[int]) -> tuple[np.ndarray, list]:
    """All states reachable from ``start``: transitions (state, symbol), and the states themselves."""
    number, states, table = {start: 0}, [start], []
    for state in states:  # grows while it is read
        row = []
        for b in symbols:
            after = step(state, b)
            if after not in number:
                if len(states) >= MAX_STATES:
                    raise ValueError("the rules need too many states")
                number[after] = len(states)
                states.append(after)
            row.append(number[after])
        table.append(row)
    return np.array(table, np.int64), states


def _minimised(table: np.ndarray, out: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest automaton with the same outputs; state 0 stays the first."""
    block = np.unique(out, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    _, first = np.unique(block, return_index=True)
    place = np.empty(len(first), np.int64)
    place[np.argsort(first)] = np.arange(len(first))  # numbered as they were found, so that 0 is the start
    chosen = np.sort(first)
    return place[block][table[chosen]], out[chosen]


def _searching(nfa: Nfa, start: int, accept: int, symbols: Sequence[int], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The automaton of one rule that searches, with outputs: 1 within a match, 3 on the byte that first accepts."""
    begin = nfa.closure({start})
    if accept in begin:
        raise ValueError(f"rule {kind} matches the empty text")

    def step(state: tuple, byte: int) -> tuple:
        attempts, out = state
        if out:  # one attempt, accepted
            on = nfa.move(attempts[0], byte)
            if on:
                if accept not in on:
                    raise ValueError(f"rule {kind} stops accepting before it fails")
                return (on,), 1
            attempts = ()
        found, seen = [], frozenset()
        for places in (*attempts, begin):
            on = nfa.move(places, byte) - seen
            if accept in on:
                if found:
                    raise ValueError(f"rule {kind} accepts while an earlier attempt is open")
                return (on,), 3
            if on:
                found.append(on)
                seen |= on
        return tuple(found), 0

    table, states = _subsets(((), 0), step, symbols)
    return _minimised(table, np.array([out for _, out in states]))


def _backward(nfa: Nfa, start: int, accept: int, symbols: Sequence[int]) -> tuple[list[list[int]], list[int]]:
    """The automaton that reads a match from its end to its start: transitions, and 1 (a start), 0, or -1 (no start further on)."""
    turned = nfa.reversed()
    table, states = _subsets(turned.closure({accept}), turned.move, symbols)
    table, out = _minimised(table, np.array([-1 if not s else int(start in s) for s in states]))
    return table.tolist(), out.tolist()


class Automaton(NamedTuple):
    """``classes``: class of each byte; one more class, the last, stands between texts. ``table``: next state by state and class, flat.

    ``within`` and ``first``: bits of the rules that are within a match in a state, and that have accepted just now. ``known``: the
    state after two classes in a row, or -1 where it depends on what came before. ``back``: per rule, its backward automaton.
    """

    classes: np.ndarray
    table: np.ndarray
    within: np.ndarray
    first: np.ndarray
    known: np.ndarray
    back: list[tuple[list[list[int]], list[int]]]

    @property
    def width(self) -> int:
        return int(self.classes.max()) + 2


@functools.lru_cache(4)
def compiled(rules: tuple[Rule, ...]) -> Automaton:
    """The automaton of all rules."""
    parsed = [_parsed(r.pattern) for r in rules]
    classes = _classes([p[0] for p in parsed])
    symbols = [int(np.flatnonzero(classes == c)[0]) for c in range(classes.max() + 1)]
    alone = [_searching(*p, symbols, r.kind) for p, r in zip(parsed, rules)]
    sizes = [len(t) for t, _ in alone]
    # Combinations of the rules' states, numbered in mixed radix, breadth first.
    todo = np.zeros((1, len(rules)), np.int64)
    number, states, rows = {0: 0}, [todo], []
    while len(todo):
        after = np.stack([t[todo[:, k]] for k, (t, _) in enumerate(alone)], axis=2)
        code = np.ravel_multi_index(tuple(np.moveaxis(after, 2, 0)), sizes)
        fresh = []
        for c, at in zip(*np.unique(code, return_index=True)):
            if int(c) not in number:
                number[int(c)] = len(number)
                fresh.append(at)
        if len(number) > MAX_STATES:
            raise ValueError("the rules need too many states")
        rows.append(np.vectorize(number.__getitem__, otypes=[np.int64])(code))
        todo = after.reshape(-1, len(rules))[fresh]
        states.append(todo)
    combined = np.concatenate(states)
    out = sum(o[combined[:, k]] << (2 * k) for k, (_, o) in enumerate(alone))
    table, out = _minimised(np.concatenate(rows), out)
    table = np.column_stack([table, np.zeros(len(table), np.int64)])  # between texts: back to the start
    twice = table[table]  # state, first class, second class
    known = np.where((twice == twice[:1]).all(axis=0), twice[0], -1)
    within = sum(((out >> (2 * k)) & 1) << k for k in range(len(rules)))
    first = sum(((out >> (2 * k + 1)) & 1) << k for k in range(len(rules)))
    return Automaton(classes, table.astype(np.int32).ravel(), within.astype(np.uint32), first.astype(np.uint32), known.astype(np.int32),
                     [_backward(*p, symbols) for p in parsed])
