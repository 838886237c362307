"""What the learned operators share: bounded samples of labelled texts, hashed features and tables of known words."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

#: Rows that a model is fitted on at most, and bytes of the longest text among them.
SAMPLE_ROWS, SAMPLE_BYTES = 8000, 20_000


def fold_of(doc_id: Column, folds: int) -> Column:
    """The part that a document belongs to, from the CRC-32 of its id as text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = SAMPLE_ROWS, most: int = SAMPLE_BYTES) -> list[tuple[str, object]]:
    """At most ``rows`` (text, label) pairs, those with the smallest hashes of ids; ``labels`` has doc_id and ``label``.

    An id with several labels has the largest; texts that are null or longer than ``most`` bytes are left out, and
    of equal texts one is kept.
    """
    chosen = (labels.select(labels["doc_id"], labels[label].alias("_label")).where("doc_id is not null and _label is not null")
              .groupBy("doc_id").agg(F.max("_label").alias("_label")))
    chosen = chosen.orderBy(F.xxhash64(F.col("doc_id").cast("bigint")), "doc_id").limit(2 * rows)
    texts = docs.select(docs["doc_id"], docs["text"]).where((F.octet_length("text") <= most) & F.col("text").isNotNull())
    found = texts.join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("_label").alias("_label"))
    found = found.orderBy(F.xxhash64(F.col("doc_id").cast("bigint")), "doc_id").limit(rows)
    return sorted((row.text, row._label) for row in found.collect())


def smallest(table: DataFrame, hashed: Column, tie: str, rows: int, total: int) -> list[Row]:
    """The ``rows`` rows of ``table`` with the smallest 64-bit hashes; ``total`` says about how many rows it has.

    Only rows below a bound on the hash, about four times as many as wanted, leave the tasks, however many tasks there are.
    """
    share = 4 * rows + 100
    while True:
        below = -(1 << 63) + (share << 64) // max(1, total)
        few = table.where(hashed < F.lit(below)) if below < 1 << 63 else table
        found = few.orderBy(hashed, tie).limit(rows).collect()
        if len(found) == rows or few is table:
            return found
        share *= 16


def bucket(feature: str, buckets: int) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % buckets


def affixes(word: str, low: int, high: int) -> list[str]:
    """The word itself and its beginnings and ends of ``low`` to ``high`` characters."""
    sizes = range(low, min(high, len(word)) + 1)
    return ["=" + word, *("^" + word[:k] for k in sizes), *(word[-k:] + "$" for k in sizes)]


class Known:
    """Numbers for words, with one row of values each; ``rows_of`` computes the rows of new words.

    When more than ``most`` words are known, all are forgotten; numbers hold until the next call of ``numbers``.
    """

    def __init__(self, rows_of: Callable[[list[str]], np.ndarray], most: int = 200_000):
        self.rows_of, self.most = rows_of, most
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.rows: np.ndarray | None = None

    def numbers(self, words: list[str]) -> np.ndarray:
        new = set(words).difference(self.number)
        if self.number and len(self.number) + len(new) > self.most:
            self.forget()
            new = set(words)
        if new or self.rows is None:
            new = sorted(new)
            at = len(self.number)
            rows = self.rows_of(new)
            if self.rows is None or at + len(new) > len(self.rows):
                grown = np.zeros((max(2 * (at + len(new)), 1 << 12), *rows.shape[1:]), rows.dtype)
                if self.rows is not None:
                    grown[:at] = self.rows[:at]
                self.rows = grown
            self.rows[at : at + len(new)] = rows
            self.number.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))


class Adam:
    """Adaptive steps for a dictionary of arrays, which is changed in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.turn = weights, rate, 0
        self.first = {name: np.zeros_like(w) for name, w in weights.items()}
        self.second = {name: np.zeros_like(w) for name, w in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.turn += 1
        for name, g in gradients.items():
            one, two = self.first[name], self.second[name]
            one += 0.1 * (g - one)
            two += 0.001 * (g * g - two)
            self.weights[name] -= self.rate * (one / (1 - 0.9**self.turn)) / (np.sqrt(two / (1 - 0.999**self.turn)) + 1e-8)


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def telling(features: Iterable[np.ndarray], labels: np.ndarray, buckets: int, least: int, deviations: float) -> np.ndarray:
    """For each bucket whether ``least`` documents have a feature in it and the shares of the documents
    with either label that have it differ by so many standard deviations."""
    counts = np.zeros((2, buckets))
    for own, label in zip(features, labels, strict=True):
        counts[int(label), np.unique(own)] += 1
    size = np.array([max(1, (labels == 0).sum()), max(1, (labels == 1).sum())])
    share, both = counts / size[:, None], counts.sum(axis=0) / size.sum()
    spread = np.sqrt(both * (1 - both) * (1 / size).sum()) + 1e-12
    return (counts.sum(axis=0) >= least) & (np.abs(share[1] - share[0]) >= deviations * spread)
