"""Mixing to target weights with soft membership.

A classifier, learned from a labelled table, gives each document a posterior over domains. A document
then counts for every domain by its posterior, and rates r >= 0 are sought, one for each document,
whose expected domain totals  sum r n p  (n tokens, p posterior) are the target weights of the
corpus's tokens: nonnegative least squares, by projected gradient from r = 1.

The step is a gradient in rates weighted by tokens, against residuals whitened by the domains' Gram
matrix  sum n p p', so its Lipschitz constant is at most 1 and the step size needs no search:

    y = (Gram + ridge)^-1 (totals - target),   r <- max(0, r - p y)

The ridge keeps rates within reason where the posteriors hardly tell two domains apart, but it also
slows what few documents tell of. So the steps only begin: `settled` ends with the y of least squares
itself, whose rates are those that differ least from the ones the steps have led to.

Rates are never stored between steps. They follow from the posteriors and the short history of y, so
a step is one aggregation of a few numbers, and a lost executor loses nothing.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.quality_classifier import SAMPLE, class_scores, fitted, texts_of
from voxlake.llm.storage import kept

STEPS = 60
TOLERANCE = 1e-6  # of all tokens
RIDGE = 1e-3  # of the mean of the Gram matrix's diagonal
CLOSE = 1e-7  # of a domain's target that may be missed
SLACKS = 1e-2, 1e-4, 1e-6, 1e-8, 1e-9  # how much a change of rates counts beside a missed target
LENGTHS = 4.0 ** -np.arange(10)  # of a Newton step, tried in one pass

_log = logging.getLogger(__name__)


def domain_posteriors(docs: DataFrame, labels: DataFrame, domains: int, sample: int = SAMPLE
                      ) -> DataFrame:
    """(id, n_words, scores) of docs (id, text), by a classifier of labels (id, label)."""
    return class_scores(docs, fitted(docs, labels, domains, sample))


def _rates(posteriors: np.ndarray, history: np.ndarray) -> np.ndarray:
    rates = np.ones(len(posteriors))
    for y in history:
        rates = np.maximum(0.0, rates - posteriors @ y)
    return rates


def _posteriors(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("scores").flatten()).reshape(len(batch), -1)


def domain_totals(rows: DataFrame, history: np.ndarray, domains: int) -> np.ndarray:
    """Expected tokens of each domain at the rates that the history leads to."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(domains)
        for batch in batches:
            if len(batch):
                p = _posteriors(batch)
                total += (_rates(p, history) * batch.column("n_words").to_numpy()) @ p
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(domains), pa.int32()), pa.array(total)], ["domain", "tokens"])

    found = rows.select("n_words", "scores").mapInArrow(work, "domain int, tokens double").groupBy(
        "domain").agg(F.sum("tokens").alias("tokens")).collect()
    out = np.zeros(domains)
    for row in found:
        out[row["domain"]] = row["tokens"]
    return out


def gram_matrix(rows: DataFrame, domains: int) -> np.ndarray:
    """sum n p p', as one row of domains x domains numbers."""
    cells = [F.sum(F.col("n_words") * F.col("scores")[i] * F.col("scores")[j])
             for i in range(domains) for j in range(domains)]
    found = rows.agg(*[c.alias(f"c{k}") for k, c in enumerate(cells)]).first()
    return np.array([x or 0.0 for x in found]).reshape(domains, domains)


def whitening(gram: np.ndarray) -> np.ndarray:
    ridge = RIDGE * np.trace(gram) / len(gram)
    return np.linalg.pinv(gram + ridge * np.eye(len(gram)), hermitian=True)


def descent(rows: DataFrame, weights: list[float], steps: int = STEPS,
            tolerance: float = TOLERANCE) -> np.ndarray:
    """The history of y: at most `steps`, fewer once the totals are right, or move no further."""
    domains = len(weights)
    gram = whitening(gram_matrix(rows, domains))
    history = np.zeros((0, domains))
    tokens = rows.agg(F.sum("n_words")).first()[0] or 0
    target = np.array(weights) / sum(weights) * tokens
    before = np.full(domains, np.inf)
    while len(history) < steps:
        residual = domain_totals(rows, history, domains) - target
        small = tolerance * max(tokens, 1)
        if np.abs(residual).max() <= small or np.abs(residual - before).max() <= small:
            break
        history, before = np.vstack([history, gram @ residual]), residual
    return history


def _dual(rows: DataFrame, history: np.ndarray, ys: np.ndarray) -> list[tuple]:
    """(half the squared rates by tokens, totals, Gram matrix of rates above 0) for each last y."""
    k = ys.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(ys), 1 + k + k * k))
        for batch in batches:
            if len(batch):
                p, n = _posteriors(batch), batch.column("n_words").to_numpy().astype(float)
                before = _rates(p, history)
                for i, y in enumerate(ys):
                    rate = np.maximum(0.0, before - p @ y)
                    weighted = p * (n * (rate > 0))[:, None]
                    sums[i] += np.concatenate([[(n * rate * rate).sum() / 2], (n * rate) @ p,
                                               (weighted.T @ p).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(sums.size), pa.int32()), pa.array(sums.ravel())], ["at", "x"])

    out = np.zeros(len(ys) * (1 + k + k * k))
    for row in rows.select("n_words", "scores").mapInArrow(work, "at int, x double").groupBy(
            "at").agg(F.sum("x").alias("x")).collect():
        out[row["at"]] = row["x"]
    return [(x[0], x[1:1 + k], x[1 + k:].reshape(k, k)) for x in out.reshape(len(ys), -1)]


def settled(rows: DataFrame, weights: list[float], history: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """(history with one y more, tokens by which each domain still misses its target).

    The last y is the minimum of the dual of least squares, found by Newton steps until the gradient
    is zero for every domain, or floating point finds no lower value: convex, with as many unknowns
    as domains. Slack falls by degrees, so targets that cannot be met lead to large y step by step. What is still missed then is what no rates of 0 or more can reach.
    """
    k = len(weights)
    gram = gram_matrix(rows, k)
    tokens = rows.agg(F.sum("n_words")).first()[0] or 0
    target = np.array(weights) / sum(weights) * tokens
    scale = 1 / np.sqrt(np.maximum(np.diag(gram), np.finfo(float).tiny))

    def valued(y: np.ndarray, found: tuple, ridge: np.ndarray) -> tuple[float, np.ndarray]:
        value, totals, _ = found
        return value + target @ y + y @ ridge @ y / 2, target - totals + ridge @ y

    def lowest(tried: np.ndarray, ridge: np.ndarray) -> tuple[float, np.ndarray, tuple]:
        each = _dual(rows, history, tried)
        values = [valued(*pair, ridge)[0] for pair in zip(tried, each, strict=True)]
        best = int(np.argmin(values))
        return values[best], tried[best], each[best]

    y = np.zeros(k)
    found, before = _dual(rows, history, y[None])[0], SLACKS[0]
    for slack in SLACKS if tokens else ():
        if (np.abs(found[1] - target) <= CLOSE * target).all():
            break
        ridge = slack * gram
        # a missed target stays as it is if y grows as the slack falls, a met one if y stays
        value, y, found = lowest(np.array([y, y * (before / slack)]), ridge)
        before = slack
        while True:
            slope = valued(y, found, ridge)[1]
            curve = (found[2] + ridge) * np.outer(scale, scale)
            step = -scale * (np.linalg.pinv(curve, rcond=1e-13, hermitian=True) @ (scale * slope))
            if (np.abs(slope) <= CLOSE * target).all() or not step.any():
                break
            found_ = lowest(y + LENGTHS[:, None] * step, ridge)
            if not found_[0] < value:
                break
            value, y, found = found_
    return np.vstack([history, y]), found[1] - target


def mixture_report(rated: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(domain, target, expected, effective_share) for each domain of `mixing_rates`' rows.

    target and expected are tokens: the domain's share of the corpus by its weight, and what the rates
    give. effective_share says for the whole mixture how much of the corpus speaks in it, with
    n tokens and rate r: (sum n r)^2 / (sum n * sum n r^2), 1 where all rates are equal, less the
    more the rates differ. It is null without tokens or rates. One aggregation, whatever the number of rows.
    """
    n, r = F.col("n_tokens"), F.col("rate")
    sums = rated.agg(F.coalesce(F.sum(n), F.lit(0)).alias("tokens"),
                     F.sum(n * r).alias("drawn"), F.sum(n * r * r).alias("squared"),
                     *[F.coalesce(F.sum(n * r * F.col(f"p_{name}")), F.lit(0.0)).alias(f"t_{name}")
                       for name in weights])
    whole = float(sum(weights.values()))
    domains = F.array(*[F.struct(F.lit(name).alias("domain"),
                                 (F.col("tokens") * (weight / whole)).alias("target"),
                                 F.col(f"t_{name}").alias("expected"))
                        for name, weight in weights.items()])
    share = F.try_divide(F.col("drawn") * F.col("drawn"), F.col("tokens") * F.col("squared"))
    return sums.select(F.explode(domains).alias("d"), share.alias("effective_share")).select(
        "d.*", "effective_share")


def mixing_rates(docs: DataFrame, labels: DataFrame, label: Column, weights: dict[str, float],
                 id: str = "doc_id", text: str = "text", sample: int = SAMPLE, steps: int = STEPS
                 ) -> DataFrame:
    """One row per row of docs: id, n_tokens, p_<domain> of each domain, rate.

    Weights are finite, none is negative and not all are 0; others are refused. `label` is a condition on a row of labels that gives the number of its domain in `weights`, or
    null; a repeated id counts for the largest. Tokens are words between blanks. Null, blank and
    empty texts have no tokens and the posterior of the classifier's bias; they get a rate as any
    other. Targets that no rates reach are met as closely as least squares can; the log, and
    `mixture_report` of the result, have what each domain misses. `steps` bounds the steps before the last one only. No labels: equal posteriors, so equal rates. No documents: no rows. Ids must be distinct integers;
    a row without one gives no row. Other columns are ignored.
    """
    if not (all(math.isfinite(w) and w >= 0 for w in weights.values()) and any(weights.values())):
        raise ValueError(f"weights must be finite, not negative and not all 0: {weights}")
    known = (labels.select(F.col(id).cast("long").alias("id"), label.cast("int").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").between(0, len(weights) - 1))
             .groupBy("id").agg(F.max("label").alias("label")))
    rows = kept(domain_posteriors(texts_of(docs, id, text), known, len(weights), sample),
                "posteriors")
    history = descent(rows, list(weights.values()), steps)
    history, missed = settled(rows, list(weights.values()), history)
    _log.info("tokens beside the target: %s", dict(zip(weights, missed.tolist(), strict=True)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                rates = _rates(_posteriors(batch), history)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(rates)], [*batch.schema.names, "rate"])

    rated = rows.mapInArrow(work, "id long, n_words long, scores array<double>, rate double")
    return rated.select(
        F.col("id").alias(id), F.col("n_words").alias("n_tokens"),
        *[F.col("scores")[i].alias(f"p_{name}") for i, name in enumerate(weights)], "rate")
