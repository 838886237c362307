"""The learned operators: exact parts against brute force, the rest by held-out accuracy."""

import itertools
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logloom.llm import attention, language_crf, learning, noisy_or
from logloom.llm.learning import Known, labelled_sample

SF = "/root/testdata/sf0.1"
DOCS = "doc_id bigint, text string"
LEXICON = ["idiot", "trash"]


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def area(scores, labels):
    ranks = pd.Series(scores).rank().to_numpy()
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def held_out(spark, found, label):
    rows = found.join(table(spark, "labels"), "doc_id").where("held_out").toPandas()
    assert all(fold(d, 5) == 0 for d in rows.doc_id)
    return rows, area(rows.score, rows[label].to_numpy())


def test_quality_on_held_out_documents(spark):
    docs = table(spark, "documents")
    found = attention.quality(docs, attention.quality_model(docs, table(spark, "labels")))
    rows, auc = held_out(spark, found, "quality")
    assert auc > 0.99
    assert (rows.predicted == rows.quality).mean() > 0.98
    assert found.where("abs(aggregate(attention, 0d, (a, b) -> a + b) - 1) > 1e-6").count() == 0


def test_toxicity_on_held_out_documents(spark):
    docs = table(spark, "documents")
    found = noisy_or.toxicity(docs, noisy_or.toxicity_model(docs, table(spark, "labels")))
    rows, auc = held_out(spark, found, "toxic")
    assert auc > 0.95
    assert (rows.predicted == rows.toxic).mean() > 0.97
    assert rows.predicted[rows.toxic == 0].mean() < 0.02


def test_languages_on_held_out_documents(spark):
    docs = table(spark, "documents")
    found = language_crf.languages(docs, language_crf.language_model(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert all(fold(d, 3) == 1 for d in found.doc_id)
    assert (found.lang_pred == found.lang).mean() > 0.98


def toxic_sample():
    pick = np.random.default_rng(1)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    say = lambda n: " ".join(pick.choice(words, n))
    sample = []
    for k in range(400):
        sentences = [say(8) for _ in range(pick.integers(1, 9))]
        if k % 5 == 0:
            sentences[pick.integers(len(sentences))] += " " + pick.choice(LEXICON)
        sample.append((". ".join(sentences) + ".", int(k % 5 == 0)))
    return sample


@pytest.fixture(scope="module")
def toxic():
    return noisy_or.train(toxic_sample())


def test_noisy_or_is_one_minus_the_product(toxic):
    texts = [text for text, _ in toxic_sample()[:50]] + ["", ".", "a", "no end", "idiot. idiot. x"]
    logits, first = toxic.sentence_logits(texts)
    for text, score, a, b in zip(texts, toxic.scores(texts), first[:-1], first[1:], strict=True):
        assert np.isclose(score, 1 - np.prod([1 - 1 / (1 + np.exp(-z)) for z in logits[a:b]]))
        assert np.isclose(toxic.scores([text])[0], score)


def test_offending_sentences_are_located(toxic):
    text = "Wa wb wc wd we. Wf wg idiot wh wi. Wj wk wl. Wm trash wn wo"
    assert toxic.scores([text])[0] > 0.5
    assert [text[a:b].strip() for a, b, _ in toxic.offending(text)] == ["Wf wg idiot wh wi.", "Wm trash wn wo"]
    assert toxic.scores(["wa wb wc. " * 2000])[0] < 0.5


def test_models_of_one_label_or_nothing():
    assert noisy_or.train([]).scores(["a"])[0] < 0.5
    assert noisy_or.train([("a", 1)]).scores(["a", ""]).min() > 0.5
    assert 0 <= attention.train([]).scores(["a b", ""])[0] <= 1
    assert attention.train([("a b", 1), ("", 1)]).scores(["a b"])[0] > 0.5
    assert language_crf.train([]).predict(["a"]) == [("und", 0.0)]
    assert language_crf.train([("a b", "xx"), ("1", "yy")]).predict(["b", "1", ""]) == [("xx", 1.0), ("und", 0.0), ("und", 0.0)]


def test_attention_gradients_train_the_weighted_passages():
    good, bad = "all is well and fine here " * 40, "$$$ ### !!! $$$ ### " * 30
    model = attention.train([(good + str(k), 1) for k in range(60)] + [(good[:200] + bad + good[: 3 * k], 0) for k in range(60)], epochs=12)
    scores, weights, first = model.scored([good, good[:200] + bad, ""])
    assert scores[0] > 0.5 > scores[1]
    for a, b in zip(first[:-1], first[1:], strict=True):
        assert np.isclose(weights[a:b].sum(), 1)
    for text in (good, bad, "", "x"):
        assert np.isclose(model.scores([text])[0], model.scores([good, text, bad])[1])


def test_marginals_against_all_label_sequences():
    pick = np.random.default_rng(3)
    scores, moves, first = pick.normal(size=(9, 3)), pick.normal(size=(3, 3)), np.array([0, 5, 5, 9])
    got = language_crf.marginals(scores, first, moves)
    for a, b in ((0, 5), (5, 9)):
        sums = np.zeros((b - a, 3))
        for labels in itertools.product(range(3), repeat=b - a):
            weight = sum(np.exp(moves[s, labels[0]]) for s in range(3))
            weight *= np.exp(sum(scores[a + t, labels[t]] for t in range(b - a)) + sum(moves[labels[t - 1], labels[t]] for t in range(1, b - a)))
            for t, label in enumerate(labels):
                sums[t, label] += weight
        assert np.allclose(got[a:b], sums / sums.sum(axis=1, keepdims=True))


def test_marginals_do_not_depend_on_the_block(monkeypatch):
    pick = np.random.default_rng(4)
    scores, moves, first = pick.normal(size=(700, 4)), pick.normal(size=(4, 4)), np.array([0, 1, 3, 400, 400, 700])
    whole = language_crf.marginals(scores, first, moves)
    monkeypatch.setattr(language_crf, "BLOCK", 7)
    assert np.allclose(language_crf.marginals(scores, first, moves), whole)


def test_words_of_a_text_that_switches_are_labelled():
    docs = pd.read_parquet(f"{SF}/documents.parquet").head(3000)
    model = language_crf.train(list(zip(docs.text, docs.lang, strict=True)))
    english, french = (next(t for t, lang in zip(docs.text, docs.lang, strict=True) if lang == wanted and 300 < len(t) < 900) for wanted in ("en", "fr"))
    found = model.label_words(english[:250].rsplit(" ", 1)[0] + " " + french[:250])
    assert [lang for _, _, lang, _ in found[:20]].count("en") >= 18
    assert [lang for _, _, lang, _ in found[-20:]].count("fr") >= 18


@pytest.mark.parametrize("operator", ["quality", "toxicity", "languages"])
def test_odd_rows(spark, operator):
    docs = spark.createDataFrame([(1, None, "z"), (None, "", "z"), (2, "12 ...", "z"), (3, "wa wb. " * 60_000, "z"), (4, "wa wb", "z"), (4, "wa wb", "z")], DOCS + ", score string")
    run = {"quality": lambda d: attention.quality(d, attention.train([("a b", 1), ("$$", 0)] * 20)),
           "toxicity": lambda d: noisy_or.toxicity(d, noisy_or.train(toxic_sample()[:50])),
           "languages": lambda d: language_crf.languages(d, language_crf.train([("wa wb", "xx"), ("que la", "yy")] * 10))}[operator]
    got = run(docs).collect()
    assert sorted(r.doc_id or 0 for r in got) == [0, 1, 2, 3, 4, 4]
    assert all(0 <= r.score <= 1 for r in got)
    if operator == "languages":
        assert {r.doc_id: r.lang_pred for r in got} == {1: "und", None: "und", 2: "und", 3: "xx", 4: "xx"}
    assert run(docs.limit(0)).count() == 0


def test_accepted_keeps_rows_as_they_are(spark):
    model = attention.train([("all is well and fine here", 1), ("$$$ ### !!!", 0)] * 60, epochs=100)
    docs = spark.createDataFrame([(1, "all is fine here", 5), (2, "### $$$ ###", 6), (1, "all is fine here", 5)], DOCS + ", _label int")
    good = [s >= attention.ACCEPTED for s in model.scores([r.text for r in docs.collect()])]
    expected = [tuple(r) for r, keep in zip(docs.collect(), good, strict=True) if keep]
    assert sorted(tuple(r) for r in attention.accepted(docs, model).collect()) == sorted(expected)


def test_sample_is_bounded_and_takes_one_of_equal_texts(spark):
    docs = spark.createDataFrame([(k, f"text {k // 2}") for k in range(40)] + [(100, None), (101, "x" * 30_000), (0, "text 0")], DOCS)
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(100, 1), (101, 1), (None, 1), (3, None), (2, 1)], "doc_id bigint, y int")
    sample = labelled_sample(docs, labels, "y")
    assert len(sample) == len({t for t, _ in sample}) == 20
    assert len(labelled_sample(docs, labels, "y", rows=5)) == 5


def test_known_words_survive_a_full_table():
    known = Known(lambda words: np.array([[len(w)] for w in words]), most=10)
    for start in range(0, 60, 6):
        words = ["x" * (1 + (start + k) % 30) for k in range(6)]
        numbers = known.numbers(words)
        assert known.rows[numbers][:, 0].tolist() == list(map(len, words))
    assert known.numbers([]).tolist() == []


def test_scores_of_documents_are_those_of_plain_loops():
    """Passage by passage and word by word, from the weights alone."""
    docs = pd.read_parquet("/root/testdata/sf0.001/documents.parquet").head(60)
    model = attention.train([(text, k % 2) for k, text in enumerate(docs.text)], epochs=1)
    w = model.weights
    texts = [*docs.text[:40], "", "a", "a a a b " * 40, "###"]
    for text, got in zip(texts, model.scores(texts), strict=True):
        words = text.split()
        passages = [words[k : k + attention.PASSAGE] for k in range(0, len(words), attention.PASSAGE)] or [[]]
        energies, codes = [], []
        for number, passage in enumerate(passages):
            rows = [attention.word_rows([word])[0] for word in passage]
            length = max(1, len(passage))
            form = [sum(w["words"][int(b)][k] for row in rows for b in row[: attention.FORMS]) / length for k in range(attention.VECTOR)]
            before = [words[number * attention.PASSAGE - 1] if number else None, *passage[:-1]]
            again = sum(a == b for a, b in zip(passage, before, strict=False)) if passage else 0
            counted = [sum(float(row[attention.FORMS + k]) for row in rows) / length for k in range(attention.COUNTS - 2)]
            counted += [again / length, len(set(passage)) / length]
            inputs = np.array([*form, *((np.array(counted) - model.center) / model.scale)])
            code = np.tanh(inputs @ w["enc"] + w["enc_b"])
            gate = 1 / (1 + np.exp(-(code @ w["gate"] + w["gate_b"])))
            energies.append(float((np.tanh(code @ w["att"] + w["att_b"]) * gate) @ w["pick"]))
            codes.append(code)
        shares = np.exp(np.array(energies) - max(energies))
        bag = sum(share * code for share, code in zip(shares / shares.sum(), codes, strict=True))
        expected = 1 / (1 + np.exp(-(bag @ w["out"] + w["out_b"][0])))
        assert got == pytest.approx(expected, abs=1e-4)
        assert model.scores([text])[0] == pytest.approx(expected, abs=1e-4)


def test_smallest_hashes_leave_the_tasks_alone(spark):
    """Also where the table has fewer rows than said, or all rows share few hashes."""
    table = spark.range(3000).selectExpr("id", "id % 7 as few", "cast(id as string) as text").repartition(5)
    for hashed in (F.xxhash64("id"), F.xxhash64("few"), F.lit(1 << 62)):
        wanted = [r.id for r in table.orderBy(hashed, "text").limit(20).collect()]
        for total in (0, 3000, 10**12):
            assert [r.id for r in learning.smallest(table, hashed, "text", 20, total)] == wanted
    assert learning.smallest(table.limit(0), F.xxhash64("id"), "text", 20, 0) == []
