"""Languages of words by a linear-chain conditional random field.

Each word has a score for every language from its lexicon entry, its beginnings and ends and its three-letter runs; a learned matrix
scores the language of a word after that of the word before. Forward-backward gives the probability of each language at each word, so a text that
switches is labelled word by word; the text's language is the one with the largest share of words.

Texts are cut into blocks of words. A block acts on what comes before it as one small matrix, so all blocks of a slice are computed side by side,
and a long text costs one step per block in sequence, not one per word. The result is that of the plain recursion.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from .blocks import map_slices, pick, texts_of
from .learning import SAMPLE_BYTES, Adam, Known, affixes, bucket, fold_of

BUCKETS = 1 << 16
AFFIXES, GRAM, GRAMS = (1, 4), 3, 6
WIDTH = 1 + 2 * AFFIXES[1] + GRAMS
#: Words of a block.
BLOCK = 64
#: Texts and training chains: a chain joins stretches of several texts, so that languages switch inside it. Of each language at most
#: ``EACH`` texts are looked at, and they take turns until there are ``SAMPLE``.
SAMPLE, EACH, CHAIN, STRETCH, CHAINS = 3000, 1000, 48, (4, 24), 4000
EPOCHS, BATCH, RATE = 4, 64, 0.05
FOLDS, HELD = 3, 1
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")


def _spans(text: str) -> list[tuple[int, int]]:
    """Places of words: runs of letters, and of signs that count as such (like ``½``) where they stand with a letter."""
    return [m.span() for m in _WORD.finditer(text) if m[0].isalpha() or any(map(str.isalpha, m[0]))]


def words_in(text: str) -> list[str]:
    return [word for word in _WORD.findall(text.lower()) if word.isalpha() or any(map(str.isalpha, word))]


def features_of(words: list[str]) -> np.ndarray:
    """(words, WIDTH) feature numbers, 0 for none."""
    found = np.zeros((len(words), WIDTH), np.int32)
    for k, word in enumerate(words):
        own = affixes(word, *AFFIXES)
        own += [word[at : at + GRAM] for at in range(min(GRAMS, len(word) - GRAM + 1))]
        found[k, : len(own)] = [1 + bucket(f, BUCKETS - 1) for f in own]
    return found


def marginals(scores: np.ndarray, first: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """(words, languages) probabilities; text ``i`` has the words ``first[i]`` to ``first[i + 1]``.

    ``scores`` and ``moves`` are logarithms; before the first word every language is equally likely.
    """
    if len(scores) == 0:
        return scores
    size = scores.shape[1]
    emit, move = np.exp(scores - scores.max(axis=1, keepdims=True)), np.exp(moves - moves.max())
    lengths = np.diff(first)
    blocks = -(-lengths // BLOCK)
    begin = np.concatenate([[0], np.cumsum(blocks)])
    starts = np.repeat(first[:-1] - begin[:-1] * BLOCK, blocks) + np.arange(begin[-1]) * BLOCK
    counts = np.minimum(BLOCK, np.repeat(first[1:], blocks) - starts)
    steps = [(np.flatnonzero(counts > j), starts[counts > j] + j) for j in range(int(counts.max()))]
    through = np.broadcast_to(np.eye(size), (len(starts), size, size)).copy()
    for rows, words in steps:
        new = (through[rows] @ move) * emit[words][:, None, :]
        through[rows] = new / new.sum(axis=(1, 2), keepdims=True)
    before, behind = np.full((len(starts), size), 1 / size), np.ones((len(starts), size))
    for j in range(1, int(blocks.max())):
        rows = begin[:-1][blocks > j] + j
        new = np.einsum("bi,bij->bj", before[rows - 1], through[rows - 1])
        before[rows] = new / new.sum(axis=1, keepdims=True)
        rows = begin[1:][blocks > j] - j
        new = np.einsum("bij,bj->bi", through[rows], behind[rows])
        behind[rows - 1] = new / new.sum(axis=1, keepdims=True)
    found = np.empty_like(emit)
    for rows, words in steps:
        new = (before[rows] @ move) * emit[words]
        before[rows] = found[words] = new / new.sum(axis=1, keepdims=True)
    for rows, words in reversed(steps):
        found[words] *= behind[rows]
        new = (emit[words] * behind[rows]) @ move.T
        behind[rows] = new / new.sum(axis=1, keepdims=True)
    return found / found.sum(axis=1, keepdims=True)


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray
    moves: np.ndarray
    known: Known | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"languages": self.languages, "weights": self.weights, "moves": self.moves, "known": None}

    def word_marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of all words, and the first word of each text, with the end at last."""
        if self.known is None:
            self.known = Known(lambda words: self.weights[features_of(words)].sum(axis=1))
        words = [words_in(text) for text in texts]
        first = np.concatenate([[0], np.cumsum([len(own) for own in words], dtype=np.int64)]).astype(np.int64)
        numbers = self.known.numbers([w for own in words for w in own])
        return marginals(self.known.rows[numbers].astype(float), first, self.moves), first

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """For each text the language with the largest expected number of words, and its share."""
        if not texts or not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        found, first = self.word_marginals(texts)
        sums = np.concatenate([np.zeros((1, found.shape[1])), np.cumsum(found, axis=0)])
        shares = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(1, np.diff(first))[:, None]
        best = shares.argmax(axis=1)
        return [(self.languages[b], float(min(1.0, s[b]))) if n else (UNKNOWN, 0.0) for b, s, n in zip(best, shares, np.diff(first), strict=True)]

    def label_words(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, language, probability) of each word."""
        found, _ = self.word_marginals([text])
        spans = _spans(text)
        return [(*s, self.languages[p.argmax()], float(p.max())) for s, p in zip(spans, found, strict=False)]


def train(sample: list[tuple[str, str]], epochs: int = EPOCHS) -> Crf:
    """By stochastic steps on the likelihood of chains. An empty sample gives a model without languages."""
    random = np.random.default_rng(11)
    texts = [(own, lang) for text, lang in sample if (own := words_in(text))]
    languages = sorted({lang for _, lang in texts})
    size = len(languages)
    if not size:
        return Crf([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)))
    table = Known(features_of, most=1 << 30)
    numbers = [table.numbers(own) for own, _ in texts]
    labels = [languages.index(lang) for _, lang in texts]
    features = table.rows
    chains, marks = np.zeros((CHAINS, CHAIN), np.int64), np.zeros((CHAINS, CHAIN), np.int64)
    for row in range(CHAINS):
        at = 0
        while at < CHAIN:
            k = random.integers(len(texts))
            want = int(random.integers(*STRETCH)) if random.random() < 0.5 else CHAIN
            from_ = random.integers(max(1, len(numbers[k]) - want + 1))
            part = numbers[k][from_ : from_ + want][: CHAIN - at]
            chains[row, at : at + len(part)], marks[row, at : at + len(part)] = part, labels[k]
            at += len(part)
    w = {"words": np.zeros((BUCKETS, size)), "moves": np.zeros((size, size))}
    adam = Adam(w, RATE)
    for _ in range(epochs):
        for batch in np.array_split(random.permutation(CHAINS), CHAINS // BATCH):
            own, back = np.unique(chains[batch], return_inverse=True)
            back = back.reshape(len(batch), CHAIN)
            scores = w["words"][features[own]].sum(axis=1)[back]
            emit, move = np.exp(scores - scores.max(axis=2, keepdims=True)), np.exp(w["moves"] - w["moves"].max())
            ahead, behind = np.empty_like(emit), np.ones_like(emit)
            state = np.full((len(batch), size), 1 / size)
            for t in range(CHAIN):
                state = (state @ move) * emit[:, t]
                state /= state.sum(axis=1, keepdims=True)
                ahead[:, t] = state
            for t in range(CHAIN - 1, 0, -1):
                state = (emit[:, t] * behind[:, t]) @ move.T
                behind[:, t - 1] = state / state.sum(axis=1, keepdims=True)
            p = ahead * behind
            p /= p.sum(axis=2, keepdims=True)
            pairs = ahead[:, :-1, :, None] * move * (emit[:, 1:] * behind[:, 1:])[:, :, None, :]
            pairs /= pairs.sum(axis=(2, 3), keepdims=True)
            truth = np.eye(size)[marks[batch]]
            seen = np.einsum("bti,btj->ij", truth[:, :-1], truth[:, 1:])
            pull = (p - truth).reshape(-1, size) / len(batch)
            by_word = np.zeros((len(own), size))
            np.add.at(by_word, back.ravel(), pull)
            g = np.stack([np.bincount(features[own].ravel(), np.repeat(by_word[:, k], WIDTH), BUCKETS) for k in range(size)], axis=1)
            g[0] = 0
            adam.step({"words": g + 1e-5 * w["words"], "moves": (pairs.sum(axis=(0, 1)) - seen) / len(batch) + 1e-4 * w["moves"]})
    return Crf(languages, w["words"].astype(np.float32), w["moves"])


def language_sample(docs: DataFrame, rows: int = SAMPLE, each: int = EACH, most: int = SAMPLE_BYTES) -> list[tuple[str, str]]:
    """At most ``rows`` (text, language) pairs of ``docs`` (doc_id, text, lang): the languages take turns, each by the smallest hashes of ids.

    Texts of at most ``most`` bytes come first; a language without enough of them gives the beginnings of longer ones.
    """
    told = docs.select(docs["doc_id"], docs["text"], docs["lang"]).where("doc_id is not null and text is not null and lang is not null")
    order = W.partitionBy("lang").orderBy("long", F.xxhash64(F.col("doc_id").cast("bigint")), "doc_id")
    ids = told.select("doc_id", "lang", (F.octet_length("text") > most).alias("long")).withColumn("turn", F.row_number().over(order))
    chosen = ids.where(F.col("turn") <= each).orderBy("turn", "lang").limit(rows).select("doc_id", "lang").distinct()
    texts = told.join(F.broadcast(chosen), ["doc_id", "lang"]).select(
        "lang", F.when(F.octet_length("text") <= most, F.col("text")).otherwise(F.substring("text", 1, most // 4)).alias("text"))
    return sorted({(row.text, row.lang) for row in texts.collect()})


def language_model(docs: DataFrame) -> Crf:
    """Fitted on a bounded sample of the texts with a language outside the held-out fold."""
    return train(language_sample(docs.where(fold_of(docs["doc_id"], FOLDS) != HELD)))


def languages(docs: DataFrame, model: Crf) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, held_out, lang_pred, score.

    ``score`` is the share of words. A text that is null or has no letter is ``und`` with score 0, as is every text without a learned
    language; of equal shares the first language wins; repeated rows and null ids are kept as they are (a null id is in the fold of
    the empty string); an empty table gives no rows; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = shipped.value.predict(texts_of(batch))
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array([f[0] for f in found], pa.string()),
                                           pa.array([f[1] for f in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    found = map_slices(pick(docs, "doc_id", "text"), work, "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == HELD).alias("held_out"), "lang_pred", "score")
