"""A semi-Markov conditional random field over windows of tokens.

A window is cut into segments: single tokens outside any entity (type 0), and candidate spans of several tokens that have one entity type.
Scores of types belong to whole candidates, and a learned matrix scores the type of a segment after that of the one before. Sums and
maxima over all ways to cut and label a window are found by dynamic programming over the places between tokens; as a candidate has a bounded
number of tokens, its cost grows in proportion to the window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .learning import Adam

NEVER = -1e30


@dataclass
class Window:
    """``size`` tokens and candidates (first token, token behind the last) with one row of feature numbers each, 0 for none."""

    size: int
    spans: list[tuple[int, int]]
    features: np.ndarray


@dataclass
class Field:
    """``weights`` (features, types) and ``moves`` (types, types); type 0 is outside."""

    kinds: list[str]
    weights: np.ndarray
    moves: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.weights[features].sum(axis=1)


def _steps(window: Window, scores: np.ndarray) -> list[tuple[int, int, int, np.ndarray]]:
    """All segments (begin, end, candidate or -1, scores of types), by begin."""
    types = scores.shape[1]
    outside, inside = np.full(types, NEVER), scores.copy()
    outside[0] = 0
    inside[:, 0] = NEVER
    steps = [(t, t + 1, -1, outside) for t in range(window.size)] + [(s, e, k, inside[k]) for k, (s, e) in enumerate(window.spans)]
    return sorted(steps, key=lambda step: step[:2])


def best_types(window: Window, scores: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The type of each candidate in the best way to cut and label the window, 0 if it is not part of it."""
    types = moves.shape[0]
    best = np.full((window.size + 1, types), NEVER)
    best[0, 0] = 0
    back: dict[tuple[int, int], tuple[int, int, int]] = {}
    into: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for begin, end, k, own in _steps(window, scores):
        if begin not in into:
            ways = best[begin][:, None] + moves
            into[begin] = ways.max(axis=0), ways.argmax(axis=0)
        value, before = into[begin]
        for y in np.flatnonzero(value + own > best[end]):
            best[end, y] = value[y] + own[y]
            back[end, int(y)] = begin, int(before[y]), k
    found = np.zeros(len(window.spans), np.int64)
    at, y = window.size, int((best[window.size] + moves[:, 0]).argmax())
    while at:
        begin, before, k = back[at, y]
        if k >= 0:
            found[k] = y
        at, y = begin, before
    return found


def expected(window: Window, scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Probabilities (candidates, types), expected numbers of moves, and the logarithm of the sum over all ways."""
    types = moves.shape[0]
    steps = _steps(window, scores)
    ahead, behind = np.full((window.size + 1, types), NEVER), np.full((window.size + 1, types), NEVER)
    starting = np.full((window.size + 1, types), NEVER)
    ahead[0, 0], behind[window.size] = 0, moves[:, 0]
    into: dict[int, np.ndarray] = {}
    for begin, end, _, own in steps:
        if begin not in into:
            into[begin] = np.logaddexp.reduce(ahead[begin][:, None] + moves, axis=0)
        ahead[end] = np.logaddexp(ahead[end], into[begin] + own)
    done = window.size
    for begin, end, _, own in reversed(steps):
        for t in range(done - 1, end - 1, -1):
            behind[t] = np.logaddexp.reduce(moves + starting[t], axis=1)
        done = min(done, end)
        starting[begin] = np.logaddexp(starting[begin], own + behind[end])
    total = float(np.logaddexp.reduce(ahead[window.size] + moves[:, 0]))
    shares = np.zeros(scores.shape)
    for begin, end, k, own in steps:
        if k >= 0:
            shares[k] = np.exp(into[begin] + own + behind[end] - total)
    went = np.exp(ahead[:-1, :, None] + moves + starting[:-1, None, :] - total).sum(axis=0)
    went[:, 0] += np.exp(ahead[window.size] + moves[:, 0] - total)
    return shares, went, total


def train(windows: list[Window], truth: list[np.ndarray], kinds: list[str], buckets: int, epochs: int = 5, batch: int = 32,
          rate: float = 0.05, decay: float = 1e-3) -> Field:
    """Fitted on the likelihood of ``truth``, the types of all candidates of each window. Without windows nothing is ever found."""
    types = 1 + len(kinds)
    w = {"weights": np.zeros((buckets, types)), "moves": np.zeros((types, types))}
    if not windows:
        w["weights"][:, 1:] = -1.0
        return Field(kinds, w["weights"], w["moves"])
    adam, random = Adam(w, rate), np.random.default_rng(5)
    told = [_moves_of(window, own, types) for window, own in zip(windows, truth, strict=True)]
    for _ in range(epochs):
        for rows in np.array_split(random.permutation(len(windows)), -(-len(windows) // batch)):
            g = {"weights": decay * w["weights"], "moves": decay * w["moves"]}
            for k in rows:
                shares, went, _ = expected(windows[k], w["weights"][windows[k].features].sum(axis=1), w["moves"])
                pull = shares - np.eye(types)[truth[k]]
                pull[:, 0] = 0
                np.add.at(g["weights"], windows[k].features, pull[:, None, :] / len(rows))
                g["moves"] += (went - told[k]) / len(rows)
            g["weights"][0] = 0
            adam.step(g)
    return Field(kinds, w["weights"], w["moves"])


def _moves_of(window: Window, types_of: np.ndarray, types: int) -> np.ndarray:
    """Moves between the segments that the given types make, from an outside before the window to one behind it."""
    moves, at, before = np.zeros((types, types)), 0, 0
    taken = {window.spans[k][0]: (window.spans[k][1], int(types_of[k])) for k in np.flatnonzero(types_of)}
    while at < window.size:
        at, y = taken.get(at, (at + 1, 0))
        moves[before, y] += 1
        before = y
    moves[before, 0] += 1
    return moves
