"""Secrets in texts, found by one combined automaton over the bytes of whole texts.

All rules are compiled into one minimal automaton (:mod:`.dfa`) that reads each byte once and says behind which bytes
which rules have matched. Such places are rare. There the rule's own backward automaton finds the leftmost start and
its forward automaton the longest end, as a scan for leftmost, greedy, non-overlapping matches would.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import Flat, flat_of, map_slices, pick
from .dfa import Dfa, compile_dfa, scan


@dataclass(frozen=True)
class Rule:
    """Matches are ``lead`` and a value: ``begin`` and then any number of ``run``; a value has ``least`` characters at least.

    The combined automaton reads ``lead`` and ``begin`` only, which is enough to know that there is a match; so the
    runs of different rules do not multiply its states.
    """

    name: str
    least: int
    begin: str
    run: str = ""
    lead: str = ""
    ignore_case: bool = False

    @property
    def shortest(self) -> tuple[str, bool]:
        return self.lead + self.begin, self.ignore_case

    @property
    def full(self) -> tuple[str, bool]:
        return self.lead + self.begin + (f"({self.run})*" if self.run else ""), self.ignore_case

    @cached_property
    def forward(self) -> Dfa:
        return compile_dfa([self.full], everywhere=False)

    @cached_property
    def reverse(self) -> Dfa:
        return compile_dfa([self.full], everywhere=False, backward=True)

    @cached_property
    def leading(self) -> Dfa:
        return compile_dfa([(self.lead, self.ignore_case)], everywhere=False)


# Forms of secrets. A hex run counts from its eighth character on, so that words do not set it off.
BASE_RULES = (
    Rule("assign", 6, "[A-Za-z0-9+/_.=-]", "[A-Za-z0-9+/_.=-]",
         "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?", True),
    Rule("access", 20, "AKIA[A-Z0-9]", "[A-Z0-9]"),
    Rule("hex", 24, "[0-9a-f]{8}", "[0-9a-f]"),
)
MORE_RULES = (
    Rule("github", 40, "gh[pousr]_[A-Za-z0-9]", "[A-Za-z0-9]"),
    Rule("google", 39, "AIza[A-Za-z0-9_-]", "[A-Za-z0-9_-]"),
    Rule("jwt", 32, "eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]", "[A-Za-z0-9_-]"),
    Rule("key_block", 27, "-----BEGIN( [A-Z]+)* PRIVATE KEY-----"),
    Rule("slack", 15, "xox[abprs]-[A-Za-z0-9-]", "[A-Za-z0-9-]"),
)
RULES = BASE_RULES + MORE_RULES


@lru_cache(8)
def automaton(rules: tuple[Rule, ...]) -> Dfa:
    return compile_dfa([rule.shortest for rule in rules])


def _matches(rule: Rule, data: bytes, ends: np.ndarray) -> list[tuple[int, int]]:
    """Leftmost, longest, non-overlapping matches, given the places behind which the rule matched."""
    found, floor, at = [], 0, 0
    while at < len(ends):
        back = rule.reverse.longest_back(data, int(ends[at]), floor)
        if back < 0:
            at += 1
            continue
        start = int(ends[at]) - back
        floor = start + rule.forward.longest(data, start)
        value = rule.leading.longest(data, start, floor) if rule.lead else 0
        if floor - start - value >= rule.least:
            found.append((start, floor))
        at = int(np.searchsorted(ends, floor, "right"))
    return found


def spans_of(flat: Flat, rules: tuple[Rule, ...] = RULES) -> list[list[tuple[str, int, int]]]:
    """For each text its (rule, start, end) in code points, by start and then in the order of ``rules``."""
    ends, bits = scan(automaton(rules), flat)
    owner = np.searchsorted(flat.offsets, ends, "left") - 1
    found: list[list[tuple[str, int, int]]] = [[] for _ in range(len(flat))]
    for text in np.unique(owner):
        begin, end = flat.offsets[text], flat.offsets[text + 1]
        data = flat.data[begin:end].tobytes()
        mine = slice(*np.searchsorted(owner, [text, text + 1]))
        points = np.concatenate([[0], np.cumsum((flat.data[begin:end] & 0xC0) != 0x80)])
        own = []
        for k, rule in enumerate(rules):
            places = ends[mine][(bits[mine] >> k & 1).astype(bool)] - begin
            own += [(int(points[s]), k, int(points[e])) for s, e in _matches(rule, data, places)]
        found[text] = [(rules[k].name, s, e) for s, k, e in sorted(own)]
    return found


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id and ``spans``, an array of (rule, start, end).

    Places are code points, the end is exclusive. A null text has no spans, like an empty one; repeated rows and null
    ids are kept as they are; an empty table gives no rows; other columns are not read.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        kind = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        spans = [[{"rule": r, "start": s, "end": e} for r, s, e in own] for own in spans_of(flat_of(batch), rules)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(spans, kind)], ["doc_id", "spans"])

    return map_slices(pick(docs, "doc_id", "text"), work, "doc_id bigint, spans array<struct<rule: string, start: bigint, end: bigint>>")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its rule's name and a short digest, so that equal secrets stay equal."""
    done, parts = 0, []
    for rule, start, end in spans:
        if start >= done:
            parts += [text[done:start], f"<{rule}:{hashlib.sha256(text[start:end].encode()).hexdigest()[:8]}>"]
        done = max(done, end)
    return "".join([*parts, text[done:]])
