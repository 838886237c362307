"""One deterministic automaton for many regular expressions, and scans of whole slices of texts with it.

The expressions use a small syntax: literals, ``\\xHH`` and escaped literals, classes ``[...]``, groups, ``|``,
``? * +`` and ``{m}``, ``{m,}``, ``{m,n}``. Each becomes a position automaton; their union, read from every
position of the text, is made deterministic by subset construction over byte classes and then minimised by
partition refinement. The result is one transition array and one array of accept bits.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

from .blocks import Flat

#: Texts are cut into lanes of about this many bytes, at bytes after which the automaton starts anew.
LANE_BYTES = 1024


class _Parser:
    """Recursive descent; gives nested tuples ('set', bytes), ('cat', parts), ('alt', parts), ('rep', part, low, high)."""

    def __init__(self, pattern: str, ignore_case: bool):
        self.pattern, self.at, self.ignore_case = pattern, 0, ignore_case

    def parse(self):
        tree = self.choice()
        if self.at != len(self.pattern):
            raise ValueError(f"unexpected {self.pattern[self.at]!r} at {self.at} in {self.pattern!r}")
        return tree

    def peek(self) -> str:
        return self.pattern[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.pattern[self.at - 1]

    def choice(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("cat", parts)

    def repeated(self):
        part = self.single()
        while self.peek() and self.peek() in "?*+{":
            mark = self.take()
            if mark == "{":
                low, comma, high = self.pattern[self.at : self.pattern.index("}", self.at)].partition(",")
                self.at = self.pattern.index("}", self.at) + 1
                part = ("rep", part, int(low), None if comma and not high else int(high or low))
            else:
                part = ("rep", part, int(mark == "+"), 1 if mark == "?" else None)
        return part

    def single(self):
        char = self.take()
        if char == "(":
            inner = self.choice()
            if self.take() != ")":
                raise ValueError(f"no ) in {self.pattern!r}")
            return inner
        if char == "[":
            return ("set", self.set_of())
        return ("set", self.cased({self.code(char)}))

    def code(self, char: str) -> int:
        if char != "\\":
            return ord(char)
        char = self.take()
        if char == "x":
            self.at += 2
            return int(self.pattern[self.at - 2 : self.at], 16)
        return ord(char)

    def set_of(self) -> frozenset[int]:
        found: set[int] = set()
        while (char := self.take()) != "]":
            low = self.code(char)
            if self.peek() == "-" and self.pattern[self.at + 1] != "]":
                self.take()
                found |= set(range(low, self.code(self.take()) + 1))
            else:
                found.add(low)
        return self.cased(found)

    def cased(self, codes: set[int]) -> frozenset[int]:
        if self.ignore_case:
            codes = codes | {c ^ 32 for c in codes if 65 <= c <= 90 or 97 <= c <= 122}
        return frozenset(codes)


class _Nfa:
    """Thompson's construction: states with byte-set moves and empty moves."""

    def __init__(self):
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1

    def build(self, tree, start: int) -> int:
        kind = tree[0]
        if kind == "set":
            end = self.state()
            self.moves[start].append((tree[1], end))
            return end
        if kind == "cat":
            for part in tree[1]:
                start = self.build(part, start)
            return start
        if kind == "alt":
            end = self.state()
            for part in tree[1]:
                own = self.state()
                self.empty[start].append(own)
                self.empty[self.build(part, own)].append(end)
            return end
        _, part, low, high = tree
        for _ in range(low):
            start = self.build(part, start)
        if high is None:
            loop, end = self.state(), self.state()
            self.empty[start] += [loop, end]
            self.empty[self.build(part, loop)] += [loop, end]
            return end
        end = self.state()
        for _ in range(high - low):
            self.empty[start].append(end)
            own = self.state()
            self.empty[start].append(own)
            start = self.build(part, own)
        self.empty[start].append(end)
        return end

    def closure(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for other in self.empty[todo.pop()]:
                if other not in found:
                    found.add(other)
                    todo.append(other)
        return frozenset(found)


@dataclass
class Dfa:
    """``next[state * width + classes[byte]]`` is the next state; state 0 is the start; ``accepts`` has a bit per rule."""

    classes: np.ndarray
    width: int
    next: np.ndarray
    accepts: np.ndarray
    resets: np.ndarray

    def longest(self, data: bytes, begin: int = 0, stop: int | None = None) -> int:
        """Length of the longest match that begins at ``begin``, or -1; for automata that are not ``everywhere``."""
        return self._longest(data, range(begin, len(data) if stop is None else stop))

    def longest_back(self, data: bytes, stop: int, floor: int = 0) -> int:
        """The same for an automaton that reads ``backward``, from ``stop`` down to ``floor``."""
        return self._longest(data, range(stop - 1, floor - 1, -1))

    def _longest(self, data: bytes, places: range) -> int:
        state, end, classes, width, follow, accepts = 0, -1, self.classes, self.width, self.next, self.accepts
        for size, at in enumerate(places, 1):
            state = follow[state * width + classes[data[at]]]
            if accepts[state]:
                end = size
            elif state == self.dead:
                break
        return end

    @cached_property
    def dead(self) -> int:
        """The state that no byte leaves and that accepts nothing; -1 if there is none."""
        table = self.next.reshape(-1, self.width)
        stuck = np.flatnonzero((table == np.arange(len(table))[:, None]).all(1) & (self.accepts == 0))
        return int(stuck[0]) if len(stuck) else -1


def _backward(tree):
    """The expression that matches the reversed strings."""
    if tree[0] == "set":
        return tree
    if tree[0] == "rep":
        return ("rep", _backward(tree[1]), *tree[2:])
    parts = [_backward(part) for part in tree[1]]
    return (tree[0], parts[::-1] if tree[0] == "cat" else parts)


def compile_dfa(patterns: list[tuple[str, bool]], everywhere: bool = True, backward: bool = False) -> Dfa:
    """The minimal automaton of ``patterns`` (text, ignore case). ``everywhere``: a match may begin at any byte;
    ``backward``: it reads from the end of a match to its start."""
    nfa = _Nfa()
    begin = nfa.state()
    ends = {}
    for k, (pattern, ignore_case) in enumerate(patterns):
        own = nfa.state()
        nfa.empty[begin].append(own)
        tree = _Parser(pattern, ignore_case).parse()
        ends[nfa.build(_backward(tree) if backward else tree, own)] = 1 << k
    sets = {codes for moves in nfa.moves for codes, _ in moves}
    kinds: dict[tuple, int] = {}
    classes = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)], np.int32)
    samples = [int(np.flatnonzero(classes == k)[0]) for k in range(len(kinds))]
    first = nfa.closure([begin])
    number, order, table = {first: 0}, [first], []
    for states in order:
        row = []
        for byte in samples:
            reached = {to for s in states for codes, to in nfa.moves[s] if byte in codes}
            new = nfa.closure(reached | {begin}) if everywhere else nfa.closure(reached)
            if new not in number:
                number[new] = len(order)
                order.append(new)
            row.append(number[new])
        table.append(row)
    follow = np.array(table, np.int32)
    accepts = np.array([sum(bit for end, bit in ends.items() if end in states) for states in order], np.int32)
    block = np.unique(accepts, return_inverse=True)[1]
    while True:
        refined = np.unique(np.column_stack([block, block[follow]]), axis=0, return_inverse=True)[1].ravel()
        if refined.max() == block.max():
            break
        block = refined
    swap = np.arange(block.max() + 1)
    swap[[0, block[0]]] = swap[[block[0], 0]]
    block = swap[block]
    keep = np.unique(block, return_index=True)[1]
    follow, accepts = block[follow[keep]], accepts[keep]
    resets = (follow == 0).all(axis=0)[classes]
    return Dfa(classes, follow.shape[1], follow.ravel().astype(np.int32), accepts, resets)


def lanes_of(flat: Flat, resets: np.ndarray, most: int = LANE_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of pieces of texts, and whether the automaton may be in any state where a piece starts.

    Texts are cut behind bytes that reset the automaton, and where none comes for long, anywhere.
    """
    safe = np.flatnonzero(resets[flat.data]) + 1
    size = len(flat.data)
    aims = np.arange(most, size, most)
    at = np.searchsorted(safe, aims)
    cuts = safe[at[at < len(safe)]]
    known = np.unique(np.concatenate([flat.offsets, cuts[cuts < size]]))
    pieces = np.maximum(1, -(-np.diff(known) // (2 * most)))
    first = np.concatenate([[0], np.cumsum(pieces)])
    inner = np.arange(first[-1]) - np.repeat(first[:-1], pieces)
    starts = np.repeat(known[:-1], pieces) + inner * 2 * most
    return starts, np.append(starts[1:], size), inner > 0


class _Run:
    """States behind every byte of the texts; pieces go forward in step, one byte at a time."""

    def __init__(self, dfa: Dfa, flat: Flat, starts: np.ndarray, ends: np.ndarray):
        self.dfa, self.starts, self.ends = dfa, starts, ends
        self.codes = dfa.classes[flat.data]
        self.trace = np.zeros(len(flat.data), np.int32)
        self.begin = np.zeros(len(starts), np.int32)

    def forward(self, pieces: np.ndarray, until_same: bool) -> None:
        """Run ``pieces`` from their ``begin``; ``until_same``: as soon as a piece is in a state that it was in before, the rest is known."""
        pieces = pieces[np.argsort(self.starts[pieces] - self.ends[pieces], kind="stable")]
        at, state = self.starts[pieces], self.begin[pieces]
        sizes = self.ends[pieces] - at
        step = 0
        while len(at):
            going = len(sizes) - np.searchsorted(sizes[::-1], step, "right")
            if going < len(sizes):
                at, state, sizes = at[:going], state[:going], sizes[:going]
                if not going:
                    break
            place = at + step
            state = self.dfa.next[state * self.dfa.width + self.codes[place]]
            if until_same:
                new = state != self.trace[place]
                if not new.all():
                    at, state, sizes, place = at[new], state[new], sizes[new], place[new]
            self.trace[place] = state
            step += 1

    def ending(self) -> np.ndarray:
        return np.where(self.ends > self.starts, self.trace[np.maximum(self.ends, 1) - 1], self.begin)

    def one_by_one(self, pieces: np.ndarray) -> None:
        """Run ``pieces`` in order, each from where the piece before ends, until it is in the state that it was in before."""
        follow, width, codes = self.dfa.next.tolist(), self.dfa.width, self.codes
        for piece in pieces.tolist():
            begin, end = int(self.starts[piece]), int(self.ends[piece])
            state = int(self.trace[begin - 1])
            if state == self.begin[piece]:
                continue
            self.begin[piece] = state
            before, new = self.trace[begin:end].tolist(), []
            for code, old in zip(codes[begin:end].tolist(), before, strict=True):
                state = follow[state * width + code]
                if state == old:
                    break
                new.append(state)
            self.trace[begin : begin + len(new)] = new


#: Times that pieces run again in step from the state in which the piece before has ended; then they go one by one.
AGAIN = 3


def states_of(dfa: Dfa, flat: Flat) -> np.ndarray:
    """The state behind every byte of every text.

    Pieces first run as if from the start. Where the piece before ends in another state, a piece runs again from that, until it is in the
    state that it was in before; mostly this takes a few bytes. What is then still wrong follows a long stretch that keeps two states apart, and
    goes piece by piece.
    """
    starts, ends, open_ = lanes_of(flat, dfa.resets)
    run = _Run(dfa, flat, starts, ends)
    run.forward(np.arange(len(starts)), until_same=False)
    for turn in range(AGAIN + 1):
        wanted = np.concatenate([[0], run.ending()[:-1]]).astype(np.int32)[: len(starts)]
        wrong = np.flatnonzero(open_ & (wanted != run.begin))
        if not len(wrong):
            break
        if turn == AGAIN:
            run.one_by_one(np.flatnonzero(open_))
            break
        run.begin[wrong] = wanted[wrong]
        run.forward(wrong, until_same=True)
    return run.trace


def scan(dfa: Dfa, flat: Flat) -> tuple[np.ndarray, np.ndarray]:
    """One pass over all texts: positions behind which a rule has matched, in order, and the rules' bits."""
    found = dfa.accepts[states_of(dfa, flat)] if len(flat.data) else np.zeros(0, np.int32)
    hits = np.flatnonzero(found)
    return hits + 1, found[hits]
