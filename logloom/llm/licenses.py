"""License wording by templates with optional and replaceable regions, compiled into token automata.

A template is a text with two kinds of markup: ``<<optional>> ... <<end>>`` may be there or not, and
``<<any 1-4>>`` stands for so many words of any kind. Everything else is mandatory and must match word for word. All
templates become one deterministic automaton over word numbers; words that no template uses share one number. It
runs from every word that can begin a template, all starts of a slice in step, and dead starts drop out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .blocks import Flat, Words, flat_of, map_slices, pick, word_hashes, words_of

#: Bytes that separate words: all ASCII but digits and letters. Words are compared with A-Z as a-z.
SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))

# Names of licenses, and wording of notices and of full texts.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit-notice", "<<optional>>this <<any 1-3>> is<<end>> <<optional>>released<<end>> <<optional>>licensed<<end>> under the mit license"),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and"
                 " associated documentation files <<optional>>the software<<end>> to deal in the software without restriction"),
    ("apache-2.0-notice", "licensed under the apache license <<optional>>version<<end>> 2 0 <<optional>>the license<<end>>"),
    ("gpl-notice", "<<optional>>this <<any 1-3>> is<<end>> <<optional>>licensed<<end>> under the <<optional>>gnu<<end>>"
                   " general public license <<optional>>version <<any 1-1>><<end>>"),
    ("gpl-text", "you can redistribute it and or modify it under the terms of the gnu general public license as published by"
                 " the free software foundation <<optional>>either version <<any 1-1>> of the license<<end>>"),
    ("cc-by-nc-4.0-notice", "licensed under <<optional>>a<<end>> cc by nc 4 0"),
    ("cc-by-notice", "licensed under <<optional>>a<<end>> creative commons attribution <<any 0-3>> license"),
    ("bsd-text", "redistribution and use in source and binary forms with or without modification are permitted provided that"
                 " the following conditions are met"),
    ("rights-reserved", "copyright <<any 1-8>> all rights reserved"),
)


@dataclass
class TokenDfa:
    """``next[state, word]``; state 0 is dead, state 1 the start; ``accepts`` has a bit per template."""

    hashes: np.ndarray
    next: np.ndarray
    accepts: np.ndarray


def _parts(template: str) -> list:
    """Words, ('any', low, high) and ('optional', parts), in order."""
    stack: list[list] = [[]]
    for markup, low, high, word in re.findall(r"<<(optional|end|any (\d+)-(\d+))>>|([^\s<]+)", template):
        if word:
            stack[-1].append(word)
        elif low:
            stack[-1].append(("any", int(low), int(high)))
        elif markup == "optional":
            stack.append([])
        else:
            inner = stack.pop()
            stack[-1].append(("optional", inner))
    if len(stack) != 1:
        raise ValueError(f"unbalanced markup in {template!r}")
    return stack[0]


def _hashes(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    flat = Flat(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    return word_hashes(flat, Words(flat.offsets[:-1], flat.offsets[1:], np.arange(len(data) + 1)))


@lru_cache(8)
def compile_templates(templates: tuple[tuple[str, str], ...]) -> TokenDfa:
    """Subset construction over word numbers; the last number stands for all words that no template uses."""
    moves: list[list[tuple[str | None, int]]] = [[]]
    empty: list[list[int]] = [[]]

    def state() -> int:
        moves.append([])
        empty.append([])
        return len(moves) - 1

    def step(at: int, word: str | None) -> int:
        to = state()
        moves[at].append((word, to))
        return to

    def chain(at: int, parts: list) -> int:
        for part in parts:
            if isinstance(part, str):
                at = step(at, part)
            elif part[0] == "optional":
                end = state()
                empty[at].append(end)
                empty[chain(at, part[1])].append(end)
                at = end
            else:
                end = state()
                for k in range(part[2] + 1):
                    if k >= part[1]:
                        empty[at].append(end)
                    if k < part[2]:
                        at = step(at, None)
                at = end
        return at

    finals = {}
    for k, (_, template) in enumerate(templates):
        own = state()
        empty[0].append(own)
        finals[chain(own, _parts(template))] = 1 << k

    def closure(states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for other in empty[todo.pop()]:
                if other not in found:
                    found.add(other)
                    todo.append(other)
        return frozenset(found)

    words = sorted({word for own in moves for word, _ in own if word is not None})
    hashes = _hashes(words)
    order = np.argsort(hashes)
    words, hashes = [words[k] for k in order], hashes[order]
    sets = [frozenset(), closure([0])]
    number = {states: k for k, states in enumerate(sets)}
    rows = []
    for states in sets:
        row = []
        for word in [*words, None]:
            new = closure([to for s in states for on, to in moves[s] if on is None or on == word])
            if new not in number:
                number[new] = len(sets)
                sets.append(new)
            row.append(number[new])
        rows.append(row)
    accepts = np.array([sum(bit for end, bit in finals.items() if end in states) for states in sets], np.int64)
    return TokenDfa(hashes, np.array(rows, np.int32), accepts)


def numbers_of(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """For each word its place in the sorted vocabulary, or the vocabulary's size."""
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, len(vocabulary))


def template_places(numbers: np.ndarray, first: np.ndarray, dfa: TokenDfa) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start word, end word, bits): for each start and each length at which a template is complete."""
    last = np.repeat(first[1:], np.diff(first))
    begin = np.flatnonzero(dfa.next[1, numbers] > 0)
    at, state, found = begin, np.ones(len(begin), np.int32), []
    while len(begin):
        state = dfa.next[state, numbers[at]]
        at = at + 1
        hit = dfa.accepts[state] > 0
        found.append((begin[hit], at[hit], dfa.accepts[state[hit]]))
        alive = (state > 0) & (at < last[begin])
        begin, at, state = begin[alive], at[alive], state[alive]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def phrase_places(hashes: np.ndarray, owner: np.ndarray, phrase: str) -> np.ndarray:
    """Words at which the phrase's words stand one after the other in one text."""
    wanted = _hashes(phrase.split())
    if len(hashes) < len(wanted):
        return np.zeros(0, np.int64)
    span = len(hashes) - len(wanted) + 1
    places = np.flatnonzero(hashes[:span] == wanted[0])
    for k in range(1, len(wanted)):
        places = places[hashes[places + k] == wanted[k]]
    return places[owner[places] == owner[places + len(wanted) - 1]]


def find_licenses(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES,
                  phrases: tuple[tuple[str, str], ...] = PHRASES) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): what it says about licenses.

    ``n_words``; ``phrases``, an array of (label, word); ``templates``, an array of (label, word, words), the longest
    match for each label and start word; ``score``: 1 minus half to the power of the words that the longest
    template match covers, or of the words of a phrase, 0 without any. A null text has no words; repeated rows and
    null ids are kept as they are; an empty table gives no rows; other columns are not read.
    """
    dfa = compile_templates(templates)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat = flat_of(batch)
        words = words_of(flat, SEPARATORS)
        hashes = word_hashes(flat, words)
        counts = np.diff(words.first)
        owner = np.repeat(np.arange(len(flat)), counts)
        named: list[list[dict]] = [[] for _ in range(len(flat))]
        matched: list[dict[tuple, int]] = [{} for _ in range(len(flat))]
        longest = np.zeros(len(flat))
        for phrase, label in phrases:
            for place in phrase_places(hashes, owner, phrase):
                text = owner[place]
                named[text].append({"label": label, "word": int(place - words.first[text])})
                longest[text] = max(longest[text], len(phrase.split()))
        for start, end, bits in zip(*template_places(numbers_of(hashes, dfa.hashes), words.first, dfa), strict=True):
            text = owner[start]
            longest[text] = max(longest[text], end - start)
            for k, (label, _) in enumerate(templates):
                if bits >> k & 1:
                    key = (int(start - words.first[text]), label)
                    matched[text][key] = max(matched[text].get(key, 0), int(end - start))
        found = [[{"label": label, "word": word, "words": size} for (word, label), size in sorted(own.items())] for own in matched]
        for own in named:
            own.sort(key=lambda place: (place["word"], place["label"]))
        pair, triple = [("label", pa.string()), ("word", pa.int64())], [("label", pa.string()), ("word", pa.int64()), ("words", pa.int64())]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(named, pa.list_(pa.struct(pair))),
             pa.array(found, pa.list_(pa.struct(triple))), pa.array(np.where(longest > 0, 1 - 0.5**longest, 0.0))],
            ["doc_id", "n_words", "phrases", "templates", "score"])

    return map_slices(pick(docs, "doc_id", "text"), work,
                      "doc_id bigint, n_words bigint, phrases array<struct<label: string, word: bigint>>, "
                      "templates array<struct<label: string, word: bigint, words: bigint>>, score double")
