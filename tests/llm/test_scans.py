"""Secrets, licenses and test items against regular expressions, word lists and full edit tables."""

import random
import re
import time
import tracemalloc

import numpy as np
import pandas as pd
import pytest

from logloom.llm import dfa, edit_match, licenses, secrets
from logloom.llm.blocks import Flat
from logloom.llm.dfa import compile_dfa, scan

DOCS = "doc_id bigint, text string"
BASE = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24))


def flat(texts):
    data = [t.encode() for t in texts]
    return Flat(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))


def brute_spans(text):
    found = [(m.start(), k, name, m.end()) for k, (name, pattern, good) in enumerate(BASE) for m in pattern.finditer(text) if good(m)]
    return [(name, start, end) for start, _, name, end in sorted(found)]


def odd_texts(count):
    pick = random.Random(8)
    bits = ["token", "TOKEN", "password", "passwd", "secret", "api_key", "apikey", "AKIA", "AKIAAKIA", "=", ":", " ", "  ", "'", '"', "abc", "abcdef", "04db",
            "0123456789abcdef0123456789abcdef", "ABCDEFGH12345678", "é", "ſecret", "toKen", "\n", ".", "-", "_", "x", "toke", "AKI", "deadbeefdeadbeef0"]
    return ["".join(pick.choice(bits) for _ in range(pick.randrange(40))) for _ in range(count)]


def test_spans_of_base_rules_are_those_of_regular_expressions():
    texts = [*odd_texts(3000), "", "é" * 5 + " token = 'abcdefgh'", "f" * 5000, "token=token:abcdef", "AKIA" * 700, "a" * 23 + " " + "b" * 24]
    for text, got in zip(texts, secrets.spans_of(flat(texts), secrets.BASE_RULES), strict=True):
        assert got == brute_spans(text), text
    for text, got in zip(texts, secrets.spans_of(flat(texts)), strict=True):
        assert [s for s in got if s[0] in ("assign", "access", "hex")] == brute_spans(text), text


def test_spans_of_further_rules():
    text = "é gh" + "p_" + "a1" * 18 + " eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeKKF2Q xox" + "b-1234567890-abc -----BEGIN RSA PRIVATE KEY----- AI" + "za" + "b" * 35
    spans = [s for s in secrets.spans_of(flat([text]))[0] if s[0] not in ("assign", "access", "hex")]
    assert [s[0] for s in spans] == ["github", "jwt", "slack", "key_block", "google"]
    assert text[spans[0][1] : spans[0][2]] == "gh" + "p_" + "a1" * 18
    shown = secrets.redacted(text, spans)
    assert shown.startswith("é <github:") and "eyJ" not in shown


def test_automata_against_regular_expressions():
    pick = random.Random(1)
    patterns = ["ab*c", "(a|bc)+d?", "[a-c]{2,3}d", "a{3}", "x?y(z|aa)*b"]
    together = compile_dfa([(p, False) for p in patterns])
    for pattern in patterns:
        forward, backward = compile_dfa([(pattern, False)], everywhere=False), compile_dfa([(pattern, False)], everywhere=False, backward=True)
        for _ in range(200):
            text = "".join(pick.choice("abcdxyz") for _ in range(pick.randrange(12)))
            ends = [e for e in range(len(text) + 1) if re.fullmatch(pattern, text[:e])]
            assert forward.longest(text.encode()) == (max([e for e in ends if e] or [-1]))
            ends = [e for e in range(len(text) + 1) if e and re.fullmatch(pattern, text[len(text) - e :])]
            assert backward.longest_back(text.encode(), len(text)) == max(ends or [-1])
    text = "".join(pick.choice("abcdxyz ") for _ in range(4000))
    ends, bits = scan(together, flat([text]))
    found = dict(zip(ends.tolist(), bits.tolist(), strict=True))
    for end in range(1, len(text) + 1):
        window = text[max(0, end - 40) : end]
        expected = sum(1 << k for k, p in enumerate(patterns) if re.search(f"(?:{p})$", window))
        assert found.get(end, 0) == expected
    with pytest.raises((ValueError, IndexError)):
        compile_dfa([("(ab", False)])


def test_texts_without_safe_places_are_cut_anywhere(monkeypatch):
    monkeypatch.setattr(dfa, "LANE_BYTES", 8)
    monkeypatch.setattr(dfa.lanes_of, "__defaults__", (8,))
    automaton = secrets.automaton(secrets.RULES)
    pick = random.Random(4)
    texts = [*odd_texts(300), "token" + " " * 900 + "= abcdef0", "a" * 700, "token=ab " * 90, "AKIA" * 200, "password" * 60 + ":" + "x" * 300]
    texts += ["".join(pick.choice(["token", " ", "=", "f", "passw", "eyJ", "."]) for _ in range(400)) for _ in range(20)]
    data = flat(texts)
    expected = []
    for text in texts:
        state = 0
        for byte in text.encode():
            state = int(automaton.next[state * automaton.width + automaton.classes[byte]])
            expected.append(state)
    assert dfa.states_of(automaton, data).tolist() == expected


@pytest.mark.parametrize("text", ["a" * 2_000_000, "wort und mehr " * 140_000, "token=abcdefgh1\n" * 120_000, "token" + " " * 2_000_000 + "=abcdef"])
def test_long_texts_take_no_longer_than_short_ones(text):
    began = time.process_time()
    spans = secrets.spans_of(flat([text]))[0]
    assert time.process_time() - began < 10
    assert len(spans) == (text.count("token") if "=abcdef" in text else 1 if "a" * 100 in text else 0)


def test_find_secrets_keeps_rows_and_ignores_other_columns(spark):
    rows = [(1, None, "r"), (1, None, "r"), (None, "", "r"), (2, "token = abcdef é", "r"), (3, "x" * 400_000 + " AKIA" + "Z" * 16, "r")]
    got = secrets.find_secrets(spark.createDataFrame(rows, DOCS + ", spans string")).collect()
    assert sorted((r.doc_id or 0, [tuple(s) for s in r.spans]) for r in got) == [
        (0, []), (1, []), (1, []), (2, [("assign", 0, 14)]), (3, [("access", 400_001, 400_021)])]
    assert secrets.find_secrets(spark.createDataFrame([], DOCS)).count() == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def test_licenses_against_word_lists(spark):
    pick = random.Random(6)
    bits = ["MIT", "mit", "License", "license.", "apache", "general", "Public", "é", "the", "under", "Licensed", ",", "2.0", "version", "\n", "gnu", "License x"]
    texts = [" ".join(pick.choice(bits) for _ in range(pick.randrange(30))) for _ in range(300)] + ["", None, "mit", "license mit license"]
    got = licenses.find_licenses(spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], DOCS + ", score string")).collect()
    phrases = [(p.split(), label) for p, label in licenses.PHRASES]
    for row in got:
        words = WORD.findall((texts[row.doc_id] or "").translate(LOWER))
        places = sorted((k, label) for k in range(len(words)) for p, label in phrases if words[k : k + len(p)] == p)
        assert row.n_words == len(words)
        assert sorted((p.word, p.label) for p in row.phrases) == places
        assert 0 <= row.score <= 1
    assert licenses.find_licenses(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize(("text", "label"), [
    ("x Released under the MIT License. y", "mit-notice"), ("This fine thing is licensed under the MIT license", "mit-notice"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0-notice"), ("licensed under the apache license 2.0", "apache-2.0-notice"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-notice"), ("Copyright (c) 2020 A B. All rights reserved", "rights-reserved"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0-notice"), ("licensed below the apache license version 2.0", None), ("copyright a b c d e f g h i all rights reserved", None)])
def test_templates(spark, text, label):
    row = licenses.find_licenses(spark.createDataFrame([(1, text)], DOCS)).first()
    assert (label in {t.label for t in row.templates}) if label else not row.templates


def test_templates_with_unbalanced_markup_are_refused():
    with pytest.raises(ValueError, match="unbalanced"):
        licenses.compile_templates((("x", "a <<optional>> b"),))


def table_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for k, char in enumerate(pattern, 1):
        new = [k]
        for j, other in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (char != other)))
        row = new
    return min(row)


def test_bit_parallel_distance_against_the_full_table():
    pick = random.Random(3)
    for _ in range(1500):
        pattern = "".join(pick.choice("abc") for _ in range(pick.randint(1, 80)))
        text = "".join(pick.choice("abc") for _ in range(pick.randint(0, 60)))
        assert edit_match.best_match(pattern, text)[0] == table_distance(pattern, text)
    pairs = [("".join(pick.choice("abé😀") for _ in range(pick.randint(1, 64))), "".join(pick.choice("abé😀") for _ in range(pick.randint(0, 90)))) for _ in range(1500)]
    assert edit_match.least_distances(*map(list, zip(*pairs, strict=True))).tolist() == [edit_match.best_match(*pair)[0] for pair in pairs]


def test_search_against_the_full_table():
    pick = random.Random(9)
    words = [["la", "ti", "on", "er", "th"][k % 5] + "aeiou"[k % 3] * (k % 4) for k in range(40)]
    say = lambda n: " ".join(pick.choice(words) for _ in range(n))
    items = [say(pick.randint(6, 40)) for _ in range(25)]
    units = [u for k, text in enumerate(items) for u in edit_match.units_of(k, text)]
    searcher = edit_match.Searcher([(k, edit_match.plain(text)) for k, text in enumerate(items)])
    for _ in range(150):
        item = list(pick.choice(items))
        for _ in range(pick.randrange(8)):
            item[pick.randrange(len(item))] = pick.choice("abc ")
        text = edit_match.plain(say(20) + " " + "".join(item) + " " + say(20))
        expected = {}
        for unit in units:
            distance = 0 if unit.whole and text == unit.text else 99 if unit.whole else table_distance(unit.text, text)
            if distance <= unit.edits:
                expected[unit.item_id] = min(expected.get(unit.item_id, 99), distance)
        assert {k: m[0] for k, m in searcher.found(text).items()} == expected


def test_any_excerpt_above_the_stated_length_is_found():
    items = [(r.item_id, r.text) for r in pd.read_parquet("/root/testdata/sf0.001/benchmark.parquet").itertuples()]
    searcher = edit_match.Searcher([(item_id, edit_match.plain(text)) for item_id, text in items])
    sure, tried = edit_match.SURE, 0
    assert sure <= 88
    for item_id, text in items:
        text = edit_match.plain(text)
        for begin in range(0, max(0, len(text) - sure + 1), 5):
            found = searcher.found(f"one two thrice{text[begin : begin + sure]}other words around it")
            assert found[item_id][0] == 0
            tried += 1
    assert tried > 500
    text = "".join(chr(97 + (k * k + k // 7) % 26) for k in range(sure))
    assert all(text[a : a + edit_match.SPAN] in {u.text for u in edit_match.units_of(1, text)} for a in (0, len(text) - edit_match.SPAN))


def test_leaks_and_what_is_left(spark):
    item = "The quick onerbleretion of the thonthwh was, in all, a story of antion and of edhash and of many words more"
    docs = [(1, "x y " + item.upper() + " z", "k"), (2, "nothing of the kind", "k"), (3, None, "k"), (4, "", "k"), (None, item, "k"), (5, "yes", "k"), (6, "yes and no", "k"),
            (7, item[:-4] + "moer", "k"), (8, "a " * 200_000, "k"), (1, "x y " + item, "k")]
    table = spark.createDataFrame(docs, DOCS + ", distance string")
    tests = spark.createDataFrame([(10, item), (11, None), (12, ""), (13, "Yes!"), (10, item), (None, "nothing of the kind, nothing of the kind")], "item_id bigint, text string")
    got = sorted(((r.doc_id, r.item_id, r.distance, r.first_word) for r in edit_match.leaks(table, tests).collect()), key=repr)
    assert [g[:3] for g in got if g[0] in (1, 5, None)] == sorted([(1, 10, 0), (1, 10, 0), (5, 13, 0), (None, 10, 0)], key=repr)
    assert {g[3] for g in got if g[0] == 1} == {2}
    assert [g[:2] for g in got if g[0] == 7] == [(7, 10)]
    left = edit_match.without_leaks(table, tests)
    assert left.columns == table.columns
    assert sorted(r.doc_id for r in left.collect()) == [2, 3, 4, 6, 8]
    none = tests.limit(0)
    assert edit_match.leaks(table, none).count() == 0
    assert edit_match.without_leaks(table, none).count() == len(docs)
    assert edit_match.leaks(table.limit(0), tests).count() == 0


def test_short_items_inside_documents_and_items_without_id(spark):
    items = [(1, "Who is Ada Byron?"), (2, "日本の首都はどこですか"), (3, "Yes!"), (None, "an item without an id that stands in a document"), (None, "Why 6 by 7?")]
    docs = [(1, "Q: who is Ada  Byron, A: a countess"), (2, "who is ada byrons"), (3, "xwho is ada byron"), (4, "問い、日本の首都はどこですか。東京です"), (5, "日本の首都は東京です"),
            (6, "well yes"), (7, "yes"), (8, "so: An item without an id that stands in a document!"), (9, "and why 6 by 7 there"), (10, "who is Ada Byronée")]
    table = spark.createDataFrame(docs, DOCS)
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    got = sorted(tuple(r) for r in edit_match.leaks(table, tests).collect())
    assert got == [(1, 1, 0, 1, 4), (4, 2, 0, 0, 0), (7, 3, 0, 0, 0)]
    assert sorted(r.doc_id for r in edit_match.without_leaks(table, tests).collect()) == [2, 3, 5, 6, 10]


def test_pieces_of_any_script_and_size_are_looked_up():
    """Items of two to thirty characters of one to four bytes each, in texts that hold them and in texts that do not."""
    pick = random.Random(5)
    letters = "aé日😀b"
    items = ["".join(pick.choice(letters) for _ in range(pick.randint(1, 4))) + " " + " ".join("".join(pick.choice(letters) for _ in range(pick.randint(1, 9))) for _ in range(pick.randint(1, 5)))
             for _ in range(60)]
    searcher = edit_match.Searcher(list(enumerate(map(edit_match.plain, items))))
    texts = [f"{pick.choice(['', 'x ', 'é é '])}{item}{pick.choice(['', ' y', '. 日日'])}" for item in items] + ["".join(pick.choice(letters + " ") for _ in range(200)) for _ in range(20)]
    for text, got in zip(texts, searcher.found_in(texts), strict=True):
        text, expected = edit_match.plain(text), {}
        for k, item in enumerate(items):
            for unit in edit_match.units_of(k, item):
                if unit.whole:
                    distance = 0 if text == unit.text else 99
                elif unit.exact:
                    places = [m.start() for m in re.finditer(f"(?={re.escape(unit.text)})", text)]
                    distance = 0 if any(not edit_match.joined(text, p) and not edit_match.joined(text, p + len(unit.text)) for p in places) else 99
                else:
                    distance = table_distance(unit.text, text)
                if distance <= unit.edits:
                    expected[k] = min(expected.get(k, 99), distance)
        assert {k: m[0] for k, m in got.items()} == expected


def test_many_items_fit_in_a_worker():
    pick = random.Random(2)
    items = [(k, " ".join("".join(pick.choice("abcdefgh") for _ in range(pick.randint(2, 7))) for _ in range(40))) for k in range(8000)]
    tracemalloc.start()
    searcher = edit_match.Searcher(items)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    size = sum(len(text) for _, text in items)
    assert held < 20 * size
    assert all(searcher.found(f"so {text} it")[k][0] == 0 for k, text in items[::200])


def test_items_in_many_blocks_give_the_same_leaks(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "benchmark"))
    whole = sorted(tuple(r) for r in edit_match.leaks(docs, items).collect())
    monkeypatch.setattr(edit_match, "BLOCK_BYTES", 3000)
    assert len(list(edit_match.item_blocks(items))) > 2
    assert sorted(tuple(r) for r in edit_match.leaks(docs, items).collect()) == whole
    assert whole
