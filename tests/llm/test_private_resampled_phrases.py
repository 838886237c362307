"""Personal data, importance resampling and phrases against regular expressions, full enumeration and plain counting."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from logloom.llm import collocations, private_spans, resampling
from logloom.llm.blocks import Flat
from logloom.llm.semi_markov import Window, best_types, expected

DOCS = "doc_id bigint, text string, lang string, score string, rank int"
BASE = (("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda t: True),
        ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda t: all(int(p) <= 255 for p in t.split("."))),
        ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda t: 16 <= len(re.sub("[^0-9]", "", t)) <= 19 and private_spans.luhn(re.sub("[^0-9]", "", t))),
        ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda t: 8 <= len(re.sub("[^0-9]", "", t)) <= 15))


def brute_spans(text):
    return [(kind, *m.span()) for kind, pattern, good in BASE for m in pattern.finditer(text) if good(m[0])]


def test_fixed_forms_are_those_of_regular_expressions():
    pick = random.Random(4)
    bits = ["@", "a", "a.b", ".", "..", "-", "%", "mail", "com", "é", " ", "  ", "+", "+1", "(", ")", "255", "256", "0007", "1", "12", "4387513035237269", "4387 5130-3523 7269",
            "x", "1.2.3.4", "9.9", "@x.y", "\n", "0000000000000000", "+1 (988) 555-2485", "0", "٣", "7-7", " - "]
    texts = ["".join(pick.choice(bits) for _ in range(pick.randrange(30))) for _ in range(6000)]
    for text in [*texts, "", "a@a@a.b@c.d", "1.2.3.4.5.6.7.8.9", "+1 2", "+12", "+1-)2", "1" * 5000, "a@b.c@d.e"]:
        assert private_spans.base_spans(text) == brute_spans(text), text
    for text in ["a" * 300_000, "1" * 300_000, "1 " * 150_000, "a@" * 150_000, "1." * 150_000, "+1" * 150_000]:
        private_spans.base_spans(text)


def test_field_against_every_way_to_cut_a_window():
    random_ = np.random.default_rng(2)
    for _ in range(40):
        size, types = int(random_.integers(1, 6)), 3
        places = [(s, e) for s in range(size) for e in range(s + 1, min(size, s + 3) + 1)]
        spans = sorted(places[k] for k in random_.permutation(len(places))[:4])
        scores, moves = random_.normal(size=(len(spans), types)), random_.normal(size=(types, types))
        window = Window(size, spans, np.zeros((len(spans), 1), int))
        ways = []
        for own in itertools.product(range(types), repeat=len(spans)):
            taken = sorted((spans[k], k) for k in range(len(spans)) if own[k])
            if any(a[0][1] > b[0][0] for a, b in itertools.pairwise(taken)):
                continue
            covered = {t for (s, e), _ in taken for t in range(s, e)}
            segments = sorted([(s, own[k]) for (s, _), k in taken] + [(t, 0) for t in range(size) if t not in covered])
            labels = [0, *(y for _, y in segments), 0]
            value = sum(scores[k, own[k]] for _, k in taken) + sum(moves[a, b] for a, b in itertools.pairwise(labels))
            ways.append((value, own, labels))
        shares, went, total = expected(window, scores, moves)
        assert total == pytest.approx(np.logaddexp.reduce([w[0] for w in ways]))
        for k, y in itertools.product(range(len(spans)), range(1, types)):
            assert shares[k, y] == pytest.approx(sum(math.exp(v - total) for v, own, _ in ways if own[k] == y), abs=1e-9)
        moved = sum(math.exp(v - total) * np.array([[list(itertools.pairwise(labels)).count((a, b)) for b in range(types)] for a in range(types)]) for v, _, labels in ways)
        assert went == pytest.approx(moved, abs=1e-9)
        assert tuple(best_types(window, scores, moves)) == max(ways)[1]


WORDS = ["the", "of", "erst", "thn", "onble", "und", "die", "zu", "ñas", "ciónes", "que", "was", "at", "in"]


def plain_texts(count, salt):
    pick = random.Random(salt)
    return [" ".join(pick.choice(WORDS) for _ in range(60)) for _ in range(count)]


@pytest.fixture(scope="module")
def field():
    return private_spans.train(*private_spans.examples(plain_texts(250, 1)), list(private_spans.KINDS), private_spans.BUCKETS)


def test_field_finds_new_spellings_and_leaves_other_numbers(field):
    windows, truth = private_spans.examples(plain_texts(120, 2), salt=77)
    hits = wrong = wanted = 0
    for window, own in zip(windows, truth, strict=True):
        got = best_types(window, field.scores(window.features), field.moves)
        hits, wrong, wanted = hits + ((got == own) & (own > 0)).sum(), wrong + ((got != own) & (got > 0)).sum(), wanted + (own > 0).sum()
    assert wanted > 300
    assert hits >= 0.93 * wanted
    assert wrong <= 0.05 * wanted
    text = "erst john.doe at mail dot example dot com und (988) 555-2485, of 2024-01-30 the"
    spans = private_spans.all_spans(text, field)
    assert [(k, text[s:e]) for k, s, e in spans] == [("crf_email", "john.doe at mail dot example dot com"), ("crf_phone", "(988) 555-2485")]
    assert private_spans.masked(text, spans) == "erst <email> und <phone>, of 2024-01-30 the"


def test_find_private_on_odd_rows(spark, field):
    long = "der " * 100_000 + "a@b.cd"
    rows = [(1, None, "x", "s", 1), (1, None, "x", "s", 1), (None, "", None, "s", 1), (2, "é +1 (988) 555-2485", None, "s", 1), (3, long, None, None, None)]
    got = private_spans.find_private(spark.createDataFrame(rows, DOCS.replace("rank", "spans")), field).collect()
    assert sorted((r.doc_id or 0, [tuple(s) for s in r.spans]) for r in got) == [
        (0, []), (1, []), (1, []), (2, [("phone", 2, 19)]), (3, [("email", 400_000, 400_006)])]
    empty = spark.createDataFrame([], DOCS)
    model = private_spans.private_model(empty)
    assert private_spans.find_private(empty, model).count() == 0
    assert private_spans.field_spans("(988) 555-2485", model) == []
    for text in ("12 " * 100_000, "1 dot " * 50_000, "a @ b " * 50_000):
        private_spans.field_spans(text, model)


# ---- resampling ----

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def runs_of(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in itertools.pairwise(words)]


def bucket(run):
    return zlib.crc32(run.encode()) % 10_000


def brute_resampled(docs, target):
    s, t = (Counter(bucket(r) for text in texts for r in runs_of(text)[1]) for texts in ([d[1] for d in docs], target))
    held, wanted = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * held / ((s[b] + 1) * wanted))) for b in s}
    rows = []
    for doc_id, text, *_ in docs:
        words, runs = runs_of(text)
        weight = sum(gain[bucket(r)] for r in runs) // len(runs) if runs else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    order = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = Counter()
    drawn = [(*r[:4], k) for k, r in enumerate(order[: 25 * len(order) // 100], 1)]
    ranks.update(r[:4] for r in drawn)
    for r in rows:
        if ranks[r[:4]] > 0:
            ranks[r[:4]] -= 1
        else:
            drawn.append((*r[:4], None))
    return sorted(drawn, key=repr)


def some_docs(count):
    pick = random.Random(9)
    vocabulary = [*WORDS, "Ab", "x" * 70, "É", "日本", "a1", "0", "y" * 130]
    docs = [(k, " ".join(pick.choice(vocabulary) for _ in range(pick.randrange(60))) + pick.choice(["", ".", "\n!"]), None, "s", 1) for k in range(count)]
    return docs + [(count, None, None, "s", 1), (count, "", None, "s", 1), (None, docs[3][1] + " the" * 30, None, None, 2), (5, *docs[5][1:]), (5, *docs[5][1:])]


def test_buckets_of_runs():
    texts = [d[1] or "" for d in some_docs(60)]
    data = [t.encode() for t in texts]
    flat = Flat(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    words = resampling.word_runs(flat)
    single, pairs = resampling.run_buckets(flat, words)
    for k, text in enumerate(texts):
        own, runs = runs_of(text)
        mine = slice(words.first[k], words.first[k + 1])
        assert [*single[mine], *pairs[mine][:-1]] == [bucket(r) for r in runs]
        assert not len(own) or pairs[mine][-1] == -1


@pytest.mark.parametrize("most", [3, 5000])
def test_resampled_against_sorting_everything(spark, monkeypatch, most):
    monkeypatch.setattr(resampling, "SORTED", most)
    docs, target = some_docs(300), ["the erst of Ab x ñas", None, "", "die die die"]
    got = resampling.resampled(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_resampled(docs, target)


def test_resampled_odd_tables(spark):
    empty, one = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "the " * 30, None, None, 0)], DOCS)
    assert resampling.resampled(empty, empty).count() == 0
    assert [r["rank"] for r in resampling.resampled(one, empty).collect()] == [None]
    same = spark.createDataFrame([(7, "the " * 30, None, None, 0)] * 50, DOCS)
    assert sorted(r["rank"] or 99 for r in resampling.resampled(same, one).collect()) == [*range(1, 13), *[99] * 38]


@pytest.mark.parametrize("margin", [1e-9, 0.001])
def test_cutoff_is_the_row_of_a_full_sort(spark, monkeypatch, margin):
    monkeypatch.setattr(resampling, "SORTED", 20)
    monkeypatch.setattr(resampling, "MARGIN", margin)
    pick = random.Random(3)
    rows = [(int(pick.gauss(0, 40)), pick.randrange(50)) for _ in range(3000)] + [(3, 3)] * 900
    table = spark.createDataFrame(rows, "falling bigint, last_id bigint").cache()
    order = sorted(rows)
    for wanted in (1, 2, 1500, 2200, 2900, len(rows)):
        got = resampling.cutoff(table, ["falling", "last_id"], wanted, len(rows))
        assert (got["falling"], got["last_id"]) == order[wanted - 1]


# ---- phrases ----

def brute_phrases(docs, top):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                own.update(" ".join(words[k : k + size]) for k in range(len(words) - size + 1))
    rows = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if a >= 10 and " " in p}
        kept = []
        for phrase, a in found.items():
            words = phrase.split(" ")
            if any(len(p.split(" ")) > len(words) and f" {phrase} " in f" {p} " and 100 * f >= 50 * a for p, f in found.items()):
                continue
            score, _, left, right = min((1000000 * a * a // (own[" ".join(words[:k])] * own[" ".join(words[k:])]), k, own[" ".join(words[:k])], own[" ".join(words[k:])])
                                        for k in range(1, len(words)))
            kept.append((-score, -a, phrase.encode(), left, right))
        rows += [(lang, k, p.decode(), -a, left, right, totals[lang], -s) for k, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(rows)


def phrase_docs(count):
    pick = random.Random(12)
    vocabulary = [*WORDS, "The", "New", "York", "É", "日本", "a-b", "b'c", *(f"w{k}" for k in range(60))]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = []
    for k in range(count):
        words = pick.choices(vocabulary, weights, k=pick.randrange(80))
        words += pick.choice([[], ["new", "york", "city"], ["New", "York"], ["die", "zu", "\t", "que"]])
        docs.append((k, "".join(w + pick.choice([" "] * 8 + ["  ", "\t", ". ", "\n", "!"]) for w in words), pick.choice(["en", "en", "en", "de", None, ""]), "s", 1))
    return docs + [(count, None, "en", "s", 1), (None, "", None, "s", 1), (0, *docs[0][1:]), (1, "solo", "xx", None, None)]


@pytest.mark.parametrize("small", [False, True])
def test_phrases_against_plain_counting(spark, monkeypatch, small):
    if small:
        for name, value in {"RANKED": 40, "TILE": 3, "CROWDED": 4, "ARRAYS": 5, "HELD_WORDS": 50, "HELD_COORDINATES": 60, "AT_ONCE": 40, "GIVEN": 7}.items():
            monkeypatch.setattr(collocations, name, value)
    docs = phrase_docs(250)
    got = collocations.phrases(spark.createDataFrame(docs, DOCS).repartition(4), top=60)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_phrases(docs, 60)


def in_task_counts(texts, known, size):
    counter, found = collocations.Counter(size, known), Counter()
    for text in texts:
        for tokens in collocations.tokens_of(text.encode(), size - 1):
            counter.add("en", tokens)
            if counter.full():
                for batch in counter.given():
                    found.update(dict(zip(batch["phrase"].to_pylist(), batch["n"].to_pylist(), strict=True)))
    for batch in counter.given():
        for phrase, n in zip(batch["phrase"].to_pylist(), batch["n"].to_pylist(), strict=True):
            found[phrase] += n
    return found


@pytest.mark.parametrize(("crowded", "arrays"), [(1, 100), (6, 3), (10**9, 0)])
def test_tiles_and_coordinates_give_the_same_counts(monkeypatch, crowded, arrays):
    for name, value in {"TILE": 2, "CROWDED": crowded, "ARRAYS": arrays}.items():
        monkeypatch.setattr(collocations, name, value)
    texts = [text.lower() for _, text, *_ in phrase_docs(60) if text]
    every = np.full(collocations.BITS // 64, 2**64 - 1, np.uint64)
    pairs = np.array(sorted((a << 21 | b, k) for k, (a, b) in enumerate([(1, 2), (2, 1), (5, 3), (3, 4)])))
    known = collocations.Frequent({"en": [w.encode() for w in WORDS]}, every, {"en": pairs}, every)
    for size in (2, 3):
        want = Counter()
        for text in texts:
            for piece in re.split("[.,;:!?\x0a-\x0d]", text):
                words = re.findall("[^ \t]+", piece)
                want.update(" ".join(words[k : k + size]) for k in range(len(words) - size + 1))
        assert in_task_counts(texts, known, size) == want


def test_phrases_of_nothing(spark):
    assert collocations.phrases(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.phrases(spark.createDataFrame([(1, "a b c", "en", None, None), (2, None, None, None, None)], DOCS)).count() == 0
    same = collocations.phrases(spark.createDataFrame([(1, "a b " * 10, "en", None, None)], DOCS)).collect()
    assert [(r.phrase, r.a, r.l, r.r, r.n) for r in same] == brute_tuples([(1, "a b " * 10, "en")])


def brute_tuples(docs):
    return [(p, a, left, right, n) for _, _, p, a, left, right, n, _ in brute_phrases(docs, 10)]
