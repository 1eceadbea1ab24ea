"""Regular expressions as deterministic automata over bytes, in transition arrays.

Takes the regular part of ``re`` syntax (literals, classes, groups, alternatives,
``?``, ``*``, ``+`` and ``{m,n}``) over ASCII; a byte from 0x80 on is in no class but
a negated one. Expressions are read with the standard library's parser, turned into
one nondeterministic automaton, made deterministic by subset construction and then
minimal by splitting classes of states until none can be told apart.
"""

from __future__ import annotations

import re._constants as sre
from collections.abc import Sequence
from re import _parser
from typing import NamedTuple

import numpy as np


class Automaton(NamedTuple):
    """``step[state, column[byte]]`` is the next state; 0 is the start."""

    step: np.ndarray  # int32
    column: np.ndarray  # uint8, of 256
    accepts: np.ndarray  # int64 bits, one for each expression that ends here
    dead: int  # the state that nothing leaves, or -1


class _Builder:
    def __init__(self):
        self.moves: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def _class(self, items) -> frozenset[int]:
        found: set[int] = set()
        negate = False
        for op, value in items:
            if op is sre.NEGATE:
                negate = True
            elif op is sre.LITERAL:
                found.add(value)
            elif op is sre.RANGE:
                found.update(range(value[0], value[1] + 1))
            else:
                raise ValueError(f"not supported in a class: {op}")
        if any(c >= 0x80 for c in found):
            raise ValueError("only ASCII characters can be named")
        return frozenset(range(256)) - found if negate else frozenset(found)

    def add(self, tree, start: int, reverse: bool) -> int:
        """Add the expression behind ``start``; its last state."""
        for op, value in reversed(list(tree)) if reverse else tree:
            start = self._one(op, value, start, reverse)
        return start

    def _one(self, op, value, start: int, reverse: bool) -> int:
        if op is sre.LITERAL:
            end = self.state()
            self.moves[start].append((self._class([(op, value)]), end))
        elif op is sre.IN:
            end = self.state()
            self.moves[start].append((self._class(value), end))
        elif op is sre.SUBPATTERN:
            end = self.add(value[3], start, reverse)
        elif op is sre.BRANCH:
            end = self.state()
            for branch in value[1]:
                self.free[self.add(branch, start, reverse)].append(end)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = value
            end = start
            for _ in range(low):
                end = self.add(body, end, reverse)
            if high is sre.MAXREPEAT:
                loop = self.state()
                self.free[end].append(loop)
                self.free[self.add(body, loop, reverse)].append(loop)
                end = loop
            else:
                last = self.state()
                self.free[end].append(last)
                for _ in range(high - low):
                    end = self.add(body, end, reverse)
                    self.free[end].append(last)
                end = last
        else:
            raise ValueError(f"not supported: {op}")
        return end

    def closure(self, states) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for x in self.free[todo.pop()]:
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        return frozenset(seen)


def compile_rules(
    patterns: Sequence[str], anywhere: bool = False, reverse: bool = False
) -> Automaton:
    """One automaton for all patterns; bit k of ``accepts`` is pattern k's.

    With ``anywhere`` a match may begin at any byte; else only at the first. With
    ``reverse`` the patterns are read from their end.
    """
    nfa = _Builder()
    start = nfa.state()
    if anywhere:
        nfa.moves[start].append((frozenset(range(256)), start))
    ends: dict[int, int] = {}
    for k, pattern in enumerate(patterns):
        own = nfa.state()
        nfa.free[start].append(own)
        end = nfa.add(_parser.parse(pattern), own, reverse)
        ends[end] = ends.get(end, 0) | 1 << k

    # Bytes that every class treats alike share a column.
    classes = {c for moves in nfa.moves for c, _ in moves}
    groups: dict[tuple, int] = {}
    column = np.array(
        [groups.setdefault(tuple(b in c for c in classes), len(groups)) for b in range(256)],
        np.uint8,
    )
    sample = [int(np.flatnonzero(column == i)[0]) for i in range(len(groups))]

    first = nfa.closure([start])
    index, rows, todo = {first: 0}, [], [first]
    for states in todo:
        row = []
        for byte in sample:
            target = nfa.closure(
                {to for s in states for c, to in nfa.moves[s] if byte in c}
            )
            if target not in index:
                index[target] = len(index)
                todo.append(target)
            row.append(index[target])
        rows.append(row)
    step = np.array(rows, np.int64)
    accepts = np.array(
        [sum({ends[s] for s in states if s in ends}) for states in index], np.int64
    )
    return _minimal(step, column, accepts)


def _minimal(step: np.ndarray, column: np.ndarray, accepts: np.ndarray) -> Automaton:
    _, block = np.unique(accepts, return_inverse=True)
    while True:
        seen = np.column_stack([block, block[step]])
        _, finer = np.unique(seen, axis=0, return_inverse=True)
        finer = finer.reshape(-1)
        if finer.max() == block.max():
            break
        block = finer
    # Number the blocks so that the start's is 0.
    _, where = np.unique(block, return_index=True)
    order = np.argsort(where)
    new = np.empty_like(order)
    new[order] = np.arange(len(order))
    block, where = new[block], where[order]
    small, ends = block[step[where]], accepts[where]
    stays = np.all(small == np.arange(len(small))[:, None], axis=1) & (ends == 0)
    dead = int(np.flatnonzero(stays)[0]) if stays.any() else -1
    return Automaton(small.astype(np.int32), column, ends, dead)


def longest(automaton: Automaton, data: bytes, start: int) -> int:
    """End of the longest match from ``start``, or -1."""
    step, column, accepts = automaton.step, automaton.column, automaton.accepts
    state, end = 0, start if accepts[0] else -1
    for at in range(start, len(data)):
        state = step[state, column[data[at]]]
        if state == automaton.dead:
            break
        if accepts[state]:
            end = at + 1
    return end


def first_end(automaton: Automaton, data: bytes, start: int, stop: int) -> int:
    """With an ``anywhere`` automaton: the first end of a match in start..stop, or -1."""
    step, column, accepts = automaton.step, automaton.column, automaton.accepts
    state = 0
    for at in range(start, stop):
        state = step[state, column[data[at]]]
        if accepts[state]:
            return at + 1
    return -1


def leftmost_start(automaton: Automaton, data: bytes, end: int, floor: int) -> int:
    """With a reversed automaton: where the longest match that ends at ``end`` begins."""
    step, column, accepts = automaton.step, automaton.column, automaton.accepts
    state, start = 0, -1
    for at in range(end - 1, floor - 1, -1):
        state = step[state, column[data[at]]]
        if state == automaton.dead:
            break
        if accepts[state]:
            start = at
    return start


class Scanner:
    """Runs an ``anywhere`` automaton over many texts at once.

    The bytes are cut into lanes that advance together, one array lookup a step. A
    lane starts as if at a text's first byte; where the lane before it ends in
    another state, it is run again from there until the states agree.
    """

    def __init__(self, automaton: Automaton, lanes: int = 2048):
        width = automaton.step.shape[1]
        # Columns from ``width`` on are for the first byte of a text.
        fresh = np.broadcast_to(automaton.step[0], automaton.step.shape)
        self.columns, self.width, self.lanes = 2 * width, width, lanes
        self.step = np.concatenate([automaton.step, fresh], axis=1).ravel()
        self.column = automaton.column.astype(np.int32)
        self.accepts = automaton.accepts

    def states(self, data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """The state behind each byte; ``firsts``: where texts begin."""
        steps = -(-len(data) // self.lanes)
        columns = np.zeros(self.lanes * steps, np.int32)
        columns[: len(data)] = self.column[data]
        columns[firsts] += self.width
        columns = np.ascontiguousarray(columns.reshape(self.lanes, steps).T)
        out = np.empty((steps, self.lanes), np.int32)
        state = np.zeros(self.lanes, np.int32)
        for t in range(steps):
            state = self.step[state * self.columns + columns[t]]
            out[t] = state
        entered = np.zeros(self.lanes, np.int32)
        while True:
            due = np.concatenate([[0], out[-1, :-1]]).astype(np.int32)
            wrong = np.flatnonzero(due != entered)
            if not len(wrong):
                break
            entered, state = due, due[wrong]
            for t in range(steps):
                state = self.step[state * self.columns + columns[t, wrong]]
                other = state != out[t, wrong]
                if not other.any():
                    break
                out[t, wrong] = state
        return np.ascontiguousarray(out.T).ravel()[: len(data)]
