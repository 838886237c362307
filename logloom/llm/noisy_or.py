"""Toxicity by multiple-instance learning with noisy-or.

Only documents are labelled. Each sentence has a probability of its own, from the words in it and their beginnings
and ends; a document is toxic unless all of its sentences are harmless: 1 minus the product of their complements. The
likelihood of the document labels is maximised, so the sentences that explain them are found along the way.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import map_slices, pick, texts_of
from .learning import Adam, Known, affixes, bucket, fold_of, labelled_sample, sigmoid, telling

BUCKETS = 1 << 18
AFFIXES = (3, 8)
WIDTH = 1 + 2 * (AFFIXES[1] - AFFIXES[0] + 1)
#: A feature counts if so many documents of the sample share it and it is that many deviations more common with one label.
LEAST_SEEN, DEVIATIONS = 5, 3.5
EPOCHS, BATCH, RATE, DECAY = 15, 64, 0.08, 1e-3
#: Logit of a sentence without telling words. It is not learned, so that the length of a harmless document does not add up.
BIAS = -12.0
#: Sentences at or above this are called offending.
OFFENDING = 0.5
FOLDS = 5

_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
_ENDS = frozenset(".!?\n")


def features_of(words: list[str]) -> np.ndarray:
    """(words, WIDTH) feature numbers; 0 stands for none."""
    found = np.zeros((len(words), WIDTH), np.int32)
    for k, word in enumerate(words):
        if word not in _ENDS:
            own = [1 + bucket(f, BUCKETS - 1) for f in affixes(word, *AFFIXES)]
            found[k, : len(own)] = own
    return found


def sentences_of(words: list[str]) -> np.ndarray:
    """For each word the number of its sentence."""
    ends = np.fromiter((w in _ENDS for w in words), bool, len(words))
    return np.concatenate([[0], np.cumsum(ends)[:-1]]) if len(words) else np.zeros(0, np.int64)


def distinct_in(place: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word once per sentence."""
    size = int(numbers.max()) + 1
    pairs = np.unique(place * size + numbers)
    return pairs // size, pairs % size


@dataclass
class NoisyOr:
    """``weights`` by feature and the ``bias`` of a sentence."""

    weights: np.ndarray
    bias: float = BIAS
    known: Known | None = field(default=None, repr=False, compare=False)

    def words(self) -> Known:
        if self.known is None:
            self.known = Known(lambda words: self.weights[features_of(words)].sum(axis=1))
        return self.known

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "known": None}

    def sentence_logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of all sentences, and for each text where its sentences begin, with the end at last."""
        words = [_TOKEN.findall(text.lower()) for text in texts]
        table = self.words()
        numbers = table.numbers([w for own in words for w in own])
        sizes, places, at = np.zeros(len(texts), np.int64), [], 0
        for k, own in enumerate(words):
            number = sentences_of(own)
            sizes[k] = number[-1] + 1 if len(own) else 1
            places.append(number + at)
            at += sizes[k]
        place, numbers = distinct_in(np.concatenate(places), numbers) if len(numbers) else (numbers, numbers)
        sums = np.bincount(place, table.rows[numbers], at) if len(numbers) else np.zeros(at)
        return sums + self.bias, np.concatenate([[0], np.cumsum(sizes)])

    def scores(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        logits, first = self.sentence_logits(texts)
        return 1 - np.exp(np.add.reduceat(-np.logaddexp(0, logits), first[:-1]))

    def offending(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, probability) of offending sentences, in code points of the text."""
        logits, _ = self.sentence_logits([text])
        cuts = [0, *(m.end() for m in re.finditer(r"[.!?\n]", text)), len(text)]
        return [(a, b, float(p)) for a, b, p in zip(cuts[:-1], cuts[1:], sigmoid(logits), strict=False) if p >= OFFENDING and b > a]


def train(sample: list[tuple[str, int]], epochs: int = EPOCHS) -> NoisyOr:
    """Without both labels in the sample, every document gets the label that is there, or is harmless."""
    labels = np.array([int(y) for _, y in sample], float)
    if len(set(labels)) < 2:
        return NoisyOr(np.zeros(BUCKETS), -BIAS if labels.any() else BIAS)
    table = Known(features_of, most=1 << 30)
    words = [_TOKEN.findall(text.lower()) for text, _ in sample]
    numbers = [table.numbers(own) for own in words]
    sentences = [sentences_of(own) for own in words]
    features = table.rows
    kept = telling((features[np.unique(n)].ravel() for n in numbers), labels, BUCKETS, LEAST_SEEN, DEVIATIONS)
    kept[0] = False
    features = np.where(kept[features], features, 0)
    weights = {"w": np.zeros(BUCKETS)}
    adam, random = Adam(weights, RATE), np.random.default_rng(5)
    for _ in range(epochs):
        for batch in np.array_split(random.permutation(len(sample)), max(1, len(sample) // BATCH)):
            batch = [k for k in batch if len(numbers[k])]
            if not batch:
                continue
            flat = np.concatenate([numbers[k] for k in batch])
            sizes = np.array([sentences[k][-1] + 1 for k in batch])
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            place = np.concatenate([sentences[k] + f for k, f in zip(batch, first, strict=True)])
            place, flat = distinct_in(place, flat)
            own, back = np.unique(flat, return_inverse=True)
            scores = weights["w"][features[own]].sum(axis=1)
            logits = np.bincount(place, scores[back], sizes.sum()) + BIAS
            p = sigmoid(logits)
            none = np.exp(np.add.reduceat(-np.logaddexp(0, logits), first))
            y = labels[batch]
            pull = np.repeat(np.where(y == 1, none / np.maximum(1 - none, 1e-9), -1.0), sizes) * p / len(batch)
            by_word = np.bincount(back, pull[place], len(own))
            g = np.bincount(features[own].ravel(), np.repeat(by_word, WIDTH), BUCKETS)
            g[0] = 0
            adam.step({"w": -g})
            weights["w"] *= 1 - RATE * DECAY
    return NoisyOr(weights["w"].astype(np.float32))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> NoisyOr:
    """Fitted on a bounded sample of the labelled documents outside fold 0."""
    learned = labels.where(fold_of(labels["doc_id"], FOLDS) != 0)
    return train([(text, int(y)) for text, y in labelled_sample(docs, learned, "toxic")])


def toxicity(docs: DataFrame, model: NoisyOr) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted, and the ``offending`` sentences.

    A null text is empty and has one sentence without words; repeated rows and null ids are kept as they are (a null id is in the fold of the
    empty string); an empty table gives no rows; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, model = texts_of(batch), shipped.value
        scores = model.scores(texts)
        found = [[dict(zip(("start", "end", "score"), s, strict=True)) for s in model.offending(t)] if p >= OFFENDING else [] for t, p in zip(texts, scores, strict=True)]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores, pa.float64()), pa.array(found, kind)], ["doc_id", "score", "offending"])

    scored = map_slices(pick(docs, "doc_id", "text"), work, "doc_id bigint, score double, offending array<struct<start: bigint, end: bigint, score: double>>")
    return scored.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                         (F.col("score") >= OFFENDING).cast("int").alias("predicted"), "offending")
