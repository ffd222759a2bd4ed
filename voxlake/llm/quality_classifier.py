"""Supervised subword embeddings: a softmax over averaged vectors of words and character n-grams.

Words and n-grams (of UTF-8 bytes) are hashed to rows of an embedding table. A document is the mean
of its words' vectors plus the mean of its n-grams' vectors; a word equal to the one before it has a
row of its own, so that repetition can be learned. Table and softmax are trained together by numpy
stochastic gradient descent on a bounded sample of labelled documents. Scoring is linear in the
averages, so it needs just one number for each row and class.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm import textops as X
from voxlake.llm.labels import bounded, fold

BUCKETS = 1 << 16  # for words, and again for n-grams
GRAMS = (2, 4)
DIMENSION = 16
SAMPLE = 3000  # labelled documents at most that a model is fitted on
EPOCHS = 8
RATE = 0.3
SHARE = 8.0  # how much faster rows of the table move than the softmax does


Group = tuple[np.ndarray, np.ndarray]  # buckets, and where each text's begin


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[list[Group], list[Group]]:
    """Buckets of words, and of n-grams of each size; those of n-grams follow the words'."""
    n, size = len(offsets) - 1, np.diff(offsets)
    starts, ends, owner = X.words(data, offsets, X.UNSPACED)
    hashes = X.span_hashes(X.prefix_sums(data), starts, ends)
    words = (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
    if len(hashes):
        same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])])
        words[same] = 0
    wide, grams = data.astype(np.uint32), []
    for length in GRAMS:
        count = max(0, len(data) - length + 1)
        key = np.full(count, length, np.uint32)
        for i in range(length):
            key = (key << np.uint32(8)) ^ (key >> np.uint32(24)) ^ wide[i:i + count]
        whole = np.ones(count, bool)  # but for those that reach into the next text
        for back in range(1, length):
            edges = offsets[1:-1] - back
            whole[edges[(edges >= 0) & (edges < count)]] = False
        key = (key[whole] * np.uint32(0x9E3779B1)) >> np.uint32(16)
        begin = np.concatenate([[0], np.cumsum(np.maximum(0, size - length + 1))])
        grams.append((BUCKETS + (key & np.uint32(BUCKETS - 1)).astype(np.int64), begin))
    return [(words, np.searchsorted(owner, np.arange(n + 1)))], grams


def _means(values: np.ndarray, groups: list[Group]) -> np.ndarray:
    """For each text, the mean of its buckets' values over all groups; 0 without any."""
    total = count = 0
    for buckets, begin in groups:
        sums = np.concatenate([[0.0], np.cumsum(values[buckets], dtype=np.float64)])
        total = total + sums[begin[1:]] - sums[begin[:-1]]
        count = count + np.diff(begin)
    return total / np.maximum(count, 1)


@dataclass(frozen=True)
class Model:
    """What each bucket adds to the score of each class, and each class's bias."""

    table: np.ndarray  # buckets x classes
    bias: np.ndarray

    @functools.cached_property
    def columns(self) -> list[np.ndarray]:
        """Each class's values over those of class 0, which then adds nothing."""
        return [np.ascontiguousarray(self.table[:, c] - self.table[:, 0])
                for c in range(1, self.table.shape[1])]

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Class probabilities, one row for each text."""
        words, grams = features(data, offsets)
        out = np.tile(self.bias.astype(np.float64), (len(offsets) - 1, 1))
        for c, values in enumerate(self.columns, 1):
            out[:, c] += _means(values, words) + _means(values, grams)
        out = np.exp(out - out.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def _examples(docs: DataFrame) -> DataFrame:
    """(id, label, buckets, weights): sparse averages of labelled texts, as arrays of 32-bit numbers."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = X.packed(batch.column("text"))
            buckets, weights = [], []
            for a in range(len(batch)):
                parts = [np.unique(np.concatenate([x for x, _ in groups]), return_counts=True)
                         for groups in features(*X.cut(data, offsets, a, a + 1))]
                buckets.append(np.concatenate([p[0] for p in parts]).astype(np.int32))
                weights.append(np.concatenate(
                    [p[1] / max(1, p[1].sum()) for p in parts]).astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"),
                 pa.array([x.tobytes() for x in buckets], pa.binary()),
                 pa.array([x.tobytes() for x in weights], pa.binary())],
                ["id", "label", "buckets", "weights"])

    return docs.select("id", "label", "text").mapInArrow(
        work, "id long, label int, buckets binary, weights binary")


def trained(examples: list[tuple[int, np.ndarray, np.ndarray]], classes: int,
            dimension: int = DIMENSION, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Stochastic gradient descent, one document at a time, in an order that a seed fixes.

    The bias begins at the classes' log frequencies; without examples the model knows just that.
    """
    random = np.random.default_rng(7)
    table = random.uniform(-1, 1, (2 * BUCKETS, dimension)) / dimension
    weight = np.zeros((dimension, classes))
    counts = np.bincount([label for label, *_ in examples], minlength=classes) + 1.0
    bias = np.log(counts / counts.sum())
    steps, total = 0, max(1, epochs * len(examples))
    for _ in range(epochs):
        for e in random.permutation(len(examples)):
            label, buckets, weights = examples[e]
            step = rate * (1 - steps / total)
            steps += 1
            vector = weights @ table[buckets]
            out = vector @ weight + bias
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[label] -= 1
            back = weight @ error
            weight -= step * np.outer(vector, error)
            bias -= step * 0.1 * error
            # the mean spreads a document's step over its buckets; undo that, as rows are shared
            table[buckets] -= (step * SHARE * weights)[:, None] * back
    return Model((table @ weight).astype(np.float32), bias.astype(np.float32))


def fitted(docs: DataFrame, labels: DataFrame, classes: int, rows: int = SAMPLE) -> Model:
    """A model for labels (id, label) of docs (id, text), from `rows` labelled documents at most.

    The sampled ids, a bounded number, are broadcast; so texts are not shuffled to find theirs.
    """
    sample = bounded(labels, docs, rows)
    found = _examples(docs.join(F.broadcast(sample), "id")).toArrow().sort_by("id")
    rows = zip(found["label"].to_pylist(), found["buckets"], found["weights"], strict=True)
    # views of what Arrow holds, not copies
    return trained([(label, np.frombuffer(b.as_buffer(), np.int32),
                     np.frombuffer(w.as_buffer(), np.float32))
                    for label, b, w in rows if len(b.as_buffer())], classes)


def class_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(id, n_words, scores) of docs (id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = X.packed(batch.column("text"))
            for a, b in X.pieces(offsets):
                part = X.cut(data, offsets, a, b)
                scores = shared.value.scores(*part)
                n_words = np.bincount(X.words(*part, X.UNSPACED)[2], minlength=b - a)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a), pa.array(n_words, pa.int64()),
                    pa.array(list(scores.astype(np.float64)), pa.list_(pa.float64()))],
                    ["id", "n_words", "scores"])

    return docs.mapInArrow(work, "id long, n_words long, scores array<double>")


def texts_of(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where(
        "id is not null")


def quality_scores(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
                   label: str = "quality", held_out: int = 2, threshold: float = 0.7,
                   sample: int = SAMPLE) -> DataFrame:
    """One row per row of docs: id, held_out, score, predicted.

    score is the probability of label 1; nothing but the text goes into it. Labels are learned
    from rows whose `fold` is not `held_out`, `sample` of them at most. Null and empty texts have
    no features and get the score of the bias; so do all texts if there are no labels. Labels
    that are neither 0 nor 1 are not used; a repeated id counts with its largest. Ids must be distinct
    integers; a row without one gives no row. Other columns are ignored.
    """
    usable = (labels.select(F.col(id).cast("long").alias("id"),
                            F.col(label).cast("int").alias("label"))
              .where("id is not null and label in (0, 1)").where(fold("id") != held_out)
              .groupBy("id").agg(F.max("label").alias("label")))
    docs = texts_of(docs, id, text)
    model = fitted(docs, usable, 2, sample)
    score = F.col("scores")[1]
    return class_scores(docs, model).select(
        F.col("id").alias(id), (fold("id") == held_out).alias("held_out"), score.alias("score"),
        F.when(score >= threshold, 1).otherwise(0).alias("predicted"))
