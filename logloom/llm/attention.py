"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from its words: the mean of learned vectors for word forms,
beginnings and ends, and what can be counted (case, digits, marks, repeats). Gated attention, learned from document labels alone,
weighs the passages; the weighted mean of their codes is the document's representation, which a logistic unit scores.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import keep_slices, map_slices, pick, texts_of
from .learning import Adam, Known, bucket, fold_of, labelled_sample, sigmoid

#: Words in a passage.
PASSAGE = 64
#: Buckets of word features, features of a word, and the sizes of word vectors, passage codes and the attention layer.
BUCKETS, FORMS, VECTOR, CODE, GATE = 1 << 12, 3, 12, 24, 16
COUNTS = 7
EPOCHS, BATCH, RATE = 8, 32, 0.01
ACCEPTED = 0.3
FOLDS = 5

_KINDS = ((re.compile(r"[^\W\d_]+"), "a"), (re.compile(r"\d+"), "0"))


def form_of(word: str) -> str:
    """The word with runs of letters and of digits as one sign each, upper case apart."""
    shape = _KINDS[1][0].sub("0", word)
    return _KINDS[0][0].sub(lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a", shape)


def word_rows(words: list[str]) -> np.ndarray:
    """For each word its ``FORMS`` feature buckets and ``COUNTS - 2`` counted properties."""
    rows = np.zeros((len(words), FORMS + COUNTS - 2), np.float32)
    for k, word in enumerate(words):
        form, size = form_of(word), len(word)
        letters, upper, digits = sum(map(str.isalpha, word)), sum(map(str.isupper, word)), sum(map(str.isdigit, word))
        low = word.lower()
        rows[k] = (bucket("f" + form, BUCKETS), bucket("^" + low[:2], BUCKETS), bucket("$" + low[-2:], BUCKETS),
                   min(size, 40) / 10, upper / size, digits / size, (size - letters - digits) / size, letters == 0)
    return rows


@dataclass
class Bags:
    """Passages of several texts: word numbers, the first word of each passage, the passages of each text."""

    numbers: np.ndarray
    starts: np.ndarray
    first: np.ndarray
    counted: np.ndarray


def bags_of(texts: list[str], table: Known) -> Bags:
    """Whole texts cut into passages; a text without words is one empty passage."""
    words = [text.split() for text in texts]
    numbers = table.numbers([w for own in words for w in own])
    sizes = np.array([len(own) for own in words])
    passages = np.maximum(1, -(-sizes // PASSAGE))
    first = np.concatenate([[0], np.cumsum(passages)])
    begin = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    starts = np.repeat(begin - first[:-1] * PASSAGE, passages) + np.arange(first[-1]) * PASSAGE
    ends = np.minimum(starts + PASSAGE, np.repeat(begin + sizes, passages))
    length = np.maximum(1, ends - starts)
    properties = _sums(table.rows[numbers][:, FORMS:], starts, ends) / length[:, None]
    again = np.zeros(len(numbers), np.float32)
    again[1:] = numbers[1:] == numbers[:-1]
    again[begin[begin < len(numbers)]] = 0
    place = np.repeat(np.arange(first[-1]), ends - starts)
    size = int(numbers.max()) + 1 if len(numbers) else 1
    different = np.bincount(np.unique(place * size + numbers) // size, minlength=first[-1])
    counted = np.column_stack([properties, _sums(again[:, None], starts, ends)[:, 0] / length, different / length])
    return Bags(numbers, np.column_stack([starts, ends]), first, counted.astype(np.float32))


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of rows ``starts`` to ``ends``, which follow each other without gaps."""
    if len(values) == 0:
        return np.zeros((len(starts), values.shape[1]), np.float64)
    sums = np.add.reduceat(values, np.minimum(starts, len(values) - 1), axis=0)
    sums[ends == starts] = 0
    return sums


def _mean_forms(bags: Bags, vectors: np.ndarray) -> np.ndarray:
    length = np.maximum(1, np.diff(bags.starts, axis=1))
    return _sums(vectors[bags.numbers], bags.starts[:, 0], bags.starts[:, 1]) / length


def _forward(w: dict[str, np.ndarray], inputs: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Codes, gated attention within each text, and the logits of texts."""
    code = np.tanh(inputs @ w["enc"] + w["enc_b"])
    left, right = np.tanh(code @ w["att"] + w["att_b"]), sigmoid(code @ w["gate"] + w["gate_b"])
    energy = (left * right) @ w["pick"]
    sizes = np.diff(first)
    raised = np.exp(energy - np.repeat(np.maximum.reduceat(energy, first[:-1]), sizes))
    weight = raised / np.repeat(np.add.reduceat(raised, first[:-1]), sizes)
    bag = np.add.reduceat(weight[:, None] * code, first[:-1], axis=0)
    return {"code": code, "left": left, "right": right, "weight": weight, "bag": bag, "logit": bag @ w["out"] + w["out_b"][0]}


@dataclass
class Attention:
    weights: dict[str, np.ndarray]
    center: np.ndarray
    scale: np.ndarray
    known: Known | None = field(default=None, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "center": self.center, "scale": self.scale, "known": None}

    def scored(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of texts, attention of all passages, and the passages of each text."""
        if self.known is None:
            self.known = Known(word_rows)
        bags = bags_of(texts, self.known)
        own, back = np.unique(bags.numbers, return_inverse=True)
        vectors = self.weights["words"][self.known.rows[own, :FORMS].astype(np.int32)].sum(axis=1)
        bags.numbers = back
        inputs = np.concatenate([_mean_forms(bags, vectors) if len(own) else np.zeros((len(bags.starts), VECTOR)),
                                 (bags.counted - self.center) / self.scale], axis=1)
        found = _forward(self.weights, inputs, bags.first)
        return sigmoid(found["logit"]), found["weight"], bags.first

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.scored(texts)[0] if texts else np.zeros(0)


def _start(random: np.random.Generator) -> dict[str, np.ndarray]:
    def draw(*shape: int) -> np.ndarray:
        return random.normal(0, 1 / np.sqrt(shape[0]), shape)

    return {"words": random.normal(0, 0.1, (BUCKETS, VECTOR)), "enc": draw(VECTOR + COUNTS, CODE), "enc_b": np.zeros(CODE),
            "att": draw(CODE, GATE), "att_b": np.zeros(GATE), "gate": draw(CODE, GATE), "gate_b": np.zeros(GATE),
            "pick": draw(GATE), "out": draw(CODE), "out_b": np.zeros(1)}


def train(sample: list[tuple[str, int]], epochs: int = EPOCHS) -> Attention:
    """An empty sample gives a model that scores by its random start; one with a single label learns that label."""
    random = np.random.default_rng(3)
    w = _start(random)
    if not sample:
        return Attention(w, np.zeros(COUNTS), np.ones(COUNTS))
    table = Known(word_rows, most=1 << 30)
    labels = np.array([int(y) for _, y in sample], float)
    bags = [bags_of([text], table) for text, _ in sample]
    counted = np.concatenate([b.counted for b in bags])
    center, scale = counted.mean(axis=0), counted.std(axis=0) + 1e-3
    rows = table.rows[:, :FORMS].astype(np.int32)
    share = np.clip(labels.mean(), 0.02, 0.98)
    w["out_b"][0] = np.log(share / (1 - share))
    adam = Adam(w, RATE)
    for _ in range(epochs):
        for batch in np.array_split(random.permutation(len(sample)), max(1, len(sample) // BATCH)):
            own, back = np.unique(np.concatenate([bags[k].numbers for k in batch]), return_inverse=True)
            passages = np.concatenate([np.diff(bags[k].starts, axis=1)[:, 0] for k in batch])
            ends = np.cumsum(passages)
            joined = Bags(back, np.column_stack([ends - passages, ends]),
                          np.concatenate([[0], np.cumsum([bags[k].first[-1] for k in batch])]), np.concatenate([bags[k].counted for k in batch]))
            forms = _mean_forms(joined, w["words"][rows[own]].sum(axis=1)) if len(own) else np.zeros((len(ends), VECTOR))
            inputs = np.concatenate([forms, (joined.counted - center) / scale], axis=1)
            got = _forward(w, inputs, joined.first)
            sizes = np.diff(joined.first)
            pull = (sigmoid(got["logit"]) - labels[batch]) / len(batch)
            by_bag = np.repeat(pull[:, None] * w["out"], sizes, axis=0)
            by_weight = (by_bag * got["code"]).sum(axis=1)
            mean = np.repeat(np.add.reduceat(by_weight * got["weight"], joined.first[:-1]), sizes)
            by_energy = got["weight"] * (by_weight - mean)
            by_left = by_energy[:, None] * w["pick"] * got["right"] * (1 - got["left"] ** 2)
            by_right = by_energy[:, None] * w["pick"] * got["left"] * got["right"] * (1 - got["right"])
            by_code = got["weight"][:, None] * by_bag + by_left @ w["att"].T + by_right @ w["gate"].T
            by_code *= 1 - got["code"] ** 2
            g = {"out": got["bag"].T @ pull, "out_b": pull.sum(keepdims=True), "pick": (got["left"] * got["right"]).T @ by_energy,
                 "att": got["code"].T @ by_left, "att_b": by_left.sum(axis=0), "gate": got["code"].T @ by_right, "gate_b": by_right.sum(axis=0),
                 "enc": inputs.T @ by_code, "enc_b": by_code.sum(axis=0)}
            by_forms = (by_code @ w["enc"].T)[:, :VECTOR] / np.maximum(1, passages)[:, None]
            by_word = np.zeros((len(own), VECTOR))
            np.add.at(by_word, back, np.repeat(by_forms, passages, axis=0))
            g["words"] = np.zeros_like(w["words"])
            for k in range(FORMS):
                np.add.at(g["words"], rows[own][:, k], by_word)
            adam.step(g)
    return Attention(w, center, scale)


def quality_model(docs: DataFrame, labels: DataFrame) -> Attention:
    """Fitted on a bounded sample of the labelled documents outside fold 0."""
    learned = labels.where(fold_of(labels["doc_id"], FOLDS) != 0)
    return train([(text, int(y)) for text, y in labelled_sample(docs, learned, "quality")])


def quality(docs: DataFrame, model: Attention) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted, and ``attention``, the weights of its passages.

    A null or empty text is one passage without words; repeated rows and null ids are kept as they are (a null id is in the fold
    of the empty string); an empty table gives no rows; other columns are not read.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, weights, first = shipped.value.scored(texts_of(batch))
        attention = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(weights, pa.float64()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(scores, pa.float64()), attention], ["doc_id", "score", "attention"])

    scored = map_slices(pick(docs, "doc_id", "text"), work, "doc_id bigint, score double, attention array<double>")
    return scored.select("doc_id", (fold_of(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                         (F.col("score") >= ACCEPTED).cast("int").alias("predicted"), "attention")


def accepted(docs: DataFrame, model: Attention) -> DataFrame:
    """``docs`` without the rows whose text scores below ``ACCEPTED``; all columns stay."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    return keep_slices(docs, lambda batch: shipped.value.scores(texts_of(batch)) >= ACCEPTED)
