"""Exact repeats, components, sketches and near-duplicates against brute force."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from logloom.llm import near_duplicates, run_merge
from logloom.llm.blocks import Flat, words_of
from logloom.llm.components import components
from logloom.llm.fast_sketch import band_keys, marks_of, sketches
from logloom.llm.shingles import digest_of, shingle_sets

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"


def flat(texts):
    data = [t.encode() for t in texts]
    return Flat(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))


def grouped(rows):
    """Rows of (doc_id, text) to (doc_id, keep_id, size, sha), sorted, by brute force."""
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", text or "") for _, text in rows]
    found = defaultdict(list)
    for (doc_id, _), text in zip(rows, norm, strict=True):
        found[text].append(doc_id)
    key = lambda d: (d is None, d or 0)
    return sorted(((d, min(found[t], key=key), len(found[t]), hashlib.sha256(t.encode()).hexdigest())
                   for (d, _), t in zip(rows, norm, strict=True)), key=repr)


@pytest.mark.parametrize("fan", [2, 16])
def test_exact_groups_with_a_hot_text_over_many_runs(spark, monkeypatch, fan):
    monkeypatch.setattr(run_merge, "FAN", fan)
    pick = random.Random(fan)
    rows = [(i, pick.choice(["hot\ttext", "hot text", "hot  text"]) if i % 3 == 0 else f"text {pick.randrange(80)}") for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " "), (1003, "\n\t "), (None, "hot text"), (None, "alone"), (7, "x" * 300_000)]
    pick.shuffle(rows)
    got = run_merge.exact_groups(spark.createDataFrame(rows, DOCS).repartition(9)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == grouped(rows)
    kept = [r for r in got if r.kept]
    assert len({r.text_sha256 for r in got}) == len(kept)
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_groups_of_nothing_and_of_repeated_rows(spark):
    assert run_merge.exact_groups(spark.createDataFrame([], DOCS)).count() == 0
    got = run_merge.exact_groups(spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], DOCS)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == [(1, 1, 3), (1, 1, 3), (2, 1, 3)]
    assert [r.kept for r in got].count(True) == 1


def test_keep_first_keeps_all_columns_and_clashing_names(spark):
    docs = spark.createDataFrame([(3, "b", 1, "x"), (1, "a", 2, "y"), (1, "a", 2, "y"), (2, "a ", 3, "z"), (4, "a", 4, "w"), (2, "a  ", 5, "v")],
                                 "doc_id bigint, text string, run int, digest string")
    got = [tuple(r) for r in run_merge.keep_first(docs).collect()]
    assert sorted(r[0] for r in got) == [1, 2, 3]
    assert set(got) <= {tuple(r) for r in docs.collect()}
    assert run_merge.keep_first(docs).columns == docs.columns


def test_components_against_union_find(spark):
    pick = random.Random(4)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1080)] + [(2000, 2000 + k) for k in range(1, 90)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    ends = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: top(x) for x in ends}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_sets(texts):
    for text in texts:
        words = (text or "").encode().lower().split()
        yield frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def test_words_and_shingles_of_odd_texts():
    pick = random.Random(2)
    texts = ["".join(pick.choice("aB \t\n\x0b\x0c\r é\x1c") for _ in range(pick.randrange(60))) for _ in range(300)] + ["", " ", "a b c d e", "A B C D E", "a b"]
    one = flat(texts)
    words = words_of(one)
    split = [one.data[s:e].tobytes() for s, e in zip(words.starts, words.ends, strict=True)]
    assert [split[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)] == [t.encode().split() for t in texts]
    sets, expected = list(shingle_sets(one)), list(brute_sets(texts))
    assert list(map(len, sets)) == list(map(len, expected))
    for a, b in itertools.combinations(range(len(texts)), 2):
        assert (digest_of(sets[a]) == digest_of(sets[b])) == (expected[a] == expected[b])
        assert len(np.intersect1d(sets[a], sets[b])) == len(expected[a] & expected[b])


def test_sketches_fill_and_estimate_the_similarity():
    random_ = np.random.default_rng(1)
    draw = lambda n: random_.integers(0, 1 << 63, n).astype(np.uint64)
    shared, t = draw(300), 384
    sets = [np.concatenate([shared, draw(50)]), np.concatenate([shared, draw(50)]), draw(1), draw(3), draw(20_000)]
    got = sketches(sets, t)
    assert (got != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert abs((got[0] == got[1]).mean() - 0.75) < 0.08
    assert (got[0] == got[4]).mean() < 0.02
    for k, own in enumerate(sets):
        assert (sketches([own], t)[0] == got[k]).all()
    keys = band_keys(marks_of(got), 6)
    assert (keys[0] == keys[1]).any()
    assert sketches([], t).shape == (0, t)


def brute_near(rows):
    """doc_id to (set size, smallest reachable id)."""
    sets = {d: s for (d, _), s in zip(rows, brute_sets(t for _, t in rows), strict=True)}
    by_shingle = defaultdict(list)
    for d, own in sets.items():
        for shingle in own:
            by_shingle[shingle].append(d)
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, own in sets.items():
        common = defaultdict(int)
        for shingle in own:
            for other in by_shingle[shingle]:
                common[other] += other < d
        for other, both in common.items():
            if both and 100 * both >= 75 * (len(own) + len(sets[other]) - both):
                a, b = top(d), top(other)
                parent[max(a, b)] = min(a, b)
    return {d: (len(own), top(d)) for d, own in sets.items()}


def near_rows(seed):
    """Chains in which only neighbours are linked, a large group of near copies, copies, short and empty texts."""
    pick = random.Random(seed)
    word = lambda: f"w{pick.randrange(5000)}"
    texts = []
    chain = [word() for _ in range(80)]
    for _ in range(25):
        chain = chain[4:] + [word() for _ in range(4)]
        texts.append(" ".join(chain))
    base = [word() for _ in range(120)]
    for _ in range(120):
        own = list(base)
        for _ in range(pick.randrange(4)):
            own[pick.randrange(120)] = word()
        texts.append(" ".join(own))
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(100)) for _ in range(60)]
    texts += [texts[k] for k in range(0, 60, 3)] * 3 + ["", None, " ", "one", "ONE", "one two", "a b c d e", "A b c d E", None]
    order = list(range(len(texts)))
    pick.shuffle(order)
    return [(order[k] * 3, text) for k, text in enumerate(texts)]


@pytest.mark.parametrize(("rounds", "part"), [(0, 512), (6, 512), (0, 5)])
def test_near_classes_against_brute_force(spark, monkeypatch, rounds, part):
    monkeypatch.setattr(near_duplicates, "PART", part)
    monkeypatch.setattr(near_duplicates, "LEADER_ROUNDS", rounds)
    monkeypatch.setattr(near_duplicates, "PAIRS_EACH", 0.01)
    rows = near_rows(rounds)
    got = near_duplicates.near_classes(spark.createDataFrame([(d, t, 1, "k") for d, t in rows], DOCS + ", key int, component string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_near(rows)
    assert len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_classes_of_the_test_table(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    got = near_duplicates.near_classes(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_near(list(zip(docs.doc_id, docs.text, strict=True)))


def test_near_classes_of_nothing_and_of_nulls(spark):
    assert near_duplicates.near_classes(spark.createDataFrame([], DOCS)).count() == 0
    got = near_duplicates.near_classes(spark.createDataFrame([(None, "a b"), (1, None), (2, "a b"), (3, "a b")], DOCS)).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=repr) == sorted([(None, None, True), (1, 1, True), (2, 2, True), (3, 2, False)], key=repr)
