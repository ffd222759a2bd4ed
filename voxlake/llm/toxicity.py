"""Toxicity by two Kneser-Ney language models, one of toxic and one of ordinary text.

Both are models of the characters (bytes, A-Z lowered) of words: a character is predicted from up to
five before it in the word, the blank that begins the word among them, and so is the blank that ends
it. Each class discounts its own counts; what it holds back goes to lower orders that both share:
continuation counts, how many different characters an n-gram has been seen after in labelled texts of
either class, down to order one. So an expression that no class has seen says nothing, a rare form
is judged by the parts it shares with others, and the two likelihoods differ only where the classes
do.

A text is judged by the logarithm of the likelihood ratio for each character: its mean over the
text, and the mean over the window where it is highest, as one expression in a long text is enough.
A logistic curve, fitted on labelled texts the models have not counted, turns both into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm import textops as X
from voxlake.llm.labels import bounded, fold, joined
from voxlake.llm.quality_classifier import texts_of
from voxlake.llm.storage import kept

ORDER = 6
DISCOUNT = 0.75
PART = 1 << 21  # n-grams, about, in one part of the ratios that scoring looks up
WINDOW = 16
CALIBRATION = 20_000  # labelled texts at most that the curve is fitted on
MERGE = 1 << 22  # n-grams that a task holds before it passes them on

_BLANK = 32


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram as a number of eight bits a symbol, its text), one for each character and word end.

    An n-gram reaches back to the blank before its word at most, so it is shorter near the start.
    """
    data = X.LOWER[data]
    starts, ends, owner = X.words(data, offsets, X.ALPHANUMERIC)
    size = ends - starts + 1
    symbols = np.full(size.sum() + ORDER - 1, _BLANK, np.uint64)  # blanks first, to reach back to
    letter = np.ones(size.sum(), bool)
    letter[np.cumsum(size) - 1] = False
    symbols[ORDER - 1:][letter] = data[X.ALPHANUMERIC[data]]
    depth = np.arange(len(letter)) - np.repeat(np.cumsum(size) - size, size)
    key = np.zeros(len(letter), np.uint64)
    for i in range(ORDER):
        key = (key << np.uint64(8)) | symbols[i:i + len(letter)]
    # only the bits of the word and of one blank before it
    kept_bits = np.array([(1 << 8 * min(ORDER, d + 2)) - 1 for d in range(ORDER)], np.uint64)
    return key & kept_bits[np.minimum(depth, ORDER - 1)], np.repeat(owner, size)


def class_counts(texts: DataFrame) -> DataFrame:
    """(gram, toxic, ordinary): counts over the texts (text, label), summed over all of them."""
    def merged(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys = np.concatenate([k for k, _ in found] or [np.zeros(0, np.uint64)])
        keys, place = np.unique(keys, return_inverse=True)
        n = np.concatenate([n for _, n in found]) if found else np.zeros((0, 2))
        sums = [np.bincount(place, n[:, c], len(keys)).astype(np.int64) for c in (1, 0)]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), *map(pa.array, sums)], ["gram", "toxic", "ordinary"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            data, offsets = X.packed(batch.column("text"))
            label = batch.column("label").to_numpy()
            for a, b in X.pieces(offsets, 4 * X.PIECE):
                key, text = grams(*X.cut(data, offsets, a, b))
                marked = np.sort((key << np.uint64(1)) | label[a:b][text].astype(np.uint64))
                edge = np.flatnonzero(np.concatenate([[True], marked[1:] != marked[:-1]])
                                      if len(marked) else np.zeros(0, bool))
                n = np.zeros((len(edge), 2), np.int64)
                which = (marked[edge] & np.uint64(1)).astype(np.int64)
                n[np.arange(len(edge)), which] = np.diff(np.append(edge, len(marked)))
                held.append((marked[edge] >> np.uint64(1), n))
                size += len(edge)
                if size > MERGE:
                    yield merged(held)
                    held, size = [], 0
        yield merged(held)

    return (texts.select("text", "label").mapInArrow(work, "gram long, toxic long, ordinary long")
            .groupBy("gram").agg(F.sum("toxic").alias("toxic"),
                                 F.sum("ordinary").alias("ordinary")))


def _length(gram: Column) -> Column:
    return sum((F.when(gram >= 1 << 8 * m, 1).otherwise(0) for m in range(1, ORDER)), F.lit(1))


def _tail(gram: Column) -> Column:
    """The n-gram without its first symbol."""
    cut = F.lit(0).cast("long")
    for m in range(1, ORDER):
        cut = F.when(gram >= 1 << 8 * m, gram.bitwiseAND(F.lit((1 << 8 * m) - 1))).otherwise(cut)
    return cut


def shared_backoff(types: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """(tail, shared): how likely the last symbol of an n-gram is after the others in general.

    types: the different n-grams that the classes have seen. The tails of those of one length,
    with the number of n-grams each is the tail of, are the counts of the next lower order; the
    lowest backs off to all symbols alike.
    """
    by_length = {m: types.where(_length(F.col("gram")) == m).select("gram")
                 for m in range(2, ORDER + 1)}
    counts = {}
    for m in range(ORDER - 1, 0, -1):
        longer = by_length[m + 1]
        if m + 1 in counts:
            longer = longer.union(counts[m + 1].select("gram"))
        counts[m] = kept(longer.groupBy(_tail(F.col("gram")).alias("gram")).agg(
            F.count("*").alias("n")), "continuations")
    result = None
    for m in range(1, ORDER):
        after = counts[m].groupBy(F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds"))
        here = counts[m].join(after, F.shiftright("gram", 8) == F.col("context"))
        here = here.withColumn("lower", F.lit(1 / 256)) if result is None else here.join(
            level.select("tail", F.col("shared").alias("lower")), _tail(F.col("gram")) == F.col("tail"))
        level = kept(here.select(F.col("gram").alias("tail"), (
            (F.col("n") - discount + discount * F.col("kinds") * F.col("lower"))
            / F.col("total")).alias("shared")), "backoff")
        result = level if result is None else result.union(level)
    return result


def likelihood_ratios(counts: DataFrame, discount: float = DISCOUNT
                      ) -> tuple[DataFrame, DataFrame]:
    """((gram, ratio, n), (context, ratio, n)): log ratios of seen grams, and of unseen ones.

    A gram that no class has seen keeps only the ratio of what the classes hold back after its
    context; after an unseen context the classes agree, and the ratio is 0.
    """
    def held(c: str) -> Column:
        return F.when(F.col(f"n_{c}") > 0, discount * F.col(f"k_{c}") / F.col(f"n_{c}")
                      ).otherwise(1.0)

    def likely(c: str) -> Column:
        own = F.when(F.col(f"n_{c}") > 0,
                     F.greatest(F.col(c) - discount, F.lit(0.0)) / F.col(f"n_{c}")).otherwise(0.0)
        return own + held(c) * F.col("shared")

    contexts = kept(counts.groupBy(F.shiftright("gram", 8).alias("context")).agg(
        *[F.sum(c).alias(f"n_{c}") for c in ("toxic", "ordinary")],
        *[F.count(F.when(F.col(c) > 0, 1)).alias(f"k_{c}") for c in ("toxic", "ordinary")]),
        "contexts")
    shared = shared_backoff(counts, discount)
    seen = (counts.join(shared, _tail(F.col("gram")) == F.col("tail"))
            .join(contexts, F.shiftright("gram", 8) == F.col("context"))
            .select("gram", F.log(likely("toxic") / likely("ordinary")).alias("ratio"),
                    (F.col("toxic") + F.col("ordinary")).alias("n")))
    unseen = contexts.select("context", F.log(held("toxic") / held("ordinary")).alias("ratio"),
                             (F.col("n_toxic") + F.col("n_ordinary")).alias("n"))
    return seen, unseen


_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)  # no n-gram is as large


@dataclass(frozen=True)
class Table:
    """Ratios by exact n-gram: a hash table that steps to the next slot where one is taken."""

    keys: np.ndarray
    ratios: np.ndarray
    bits: int

    @classmethod
    def of(cls, keys: np.ndarray, ratios: np.ndarray) -> Table:
        bits = max(1, (2 * len(keys)).bit_length())
        home = _home(keys, bits)
        order = np.argsort(home, kind="stable")
        steps = np.arange(len(keys))
        at = np.maximum.accumulate(home[order] - steps) + steps
        size = max(1 << bits, int(at[-1]) + 1 if len(at) else 0) + 1  # the last slot stays empty
        table = cls(np.full(size, _NONE), np.zeros(size, np.float32), bits)
        table.keys[at], table.ratios[at] = keys[order], ratios[order]
        return table

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The ratio of each key, nan where there is none."""
        out = np.full(len(keys), np.nan, np.float32)
        left, at = np.arange(len(keys)), _home(keys, self.bits)
        while len(left):
            here = self.keys[at]
            hit = here == keys[left]
            out[left[hit]] = self.ratios[at[hit]]
            on = ~hit & (here != _NONE)
            left, at = left[on], at[on] + 1
        return out


def _home(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def _part(contexts: np.ndarray, parts: int) -> np.ndarray:
    return X.mixed(contexts) % np.uint64(parts)


def lookup(ratios: DataFrame, key: str, part: int = 0, parts: int = 1) -> Table:
    """The ratios of one part; a gram is in the part of its context, so both are found together."""
    shift = np.uint64(8 if key == "gram" else 0)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contexts = batch.column(key).to_numpy().view(np.uint64) >> shift
            yield batch.filter(pa.array(_part(contexts, parts) == part))

    ratios = ratios.select(key, F.col("ratio").cast("float").alias("ratio"))
    found = (ratios.mapInArrow(own, ratios.schema) if parts > 1 else ratios).toArrow()
    return Table.of(found[key].to_numpy().view(np.uint64), found["ratio"].to_numpy())


@dataclass(frozen=True)
class Model:
    """One part of the ratios, the only one if there are no more."""

    seen: Table
    unseen: Table
    part: int = 0
    parts: int = 1

    def ratios(self, key: np.ndarray) -> np.ndarray:
        """The ratio at each place; 0 at those of the other parts."""
        if self.parts > 1:
            out = np.zeros(len(key), np.float32)
            own = np.flatnonzero(_part(key >> np.uint64(8), self.parts) == self.part)
            out[own] = Model(self.seen, self.unseen).ratios(key[own])
            return out
        ratio = self.seen.find(key)
        rest = np.flatnonzero(np.isnan(ratio))
        ratio[rest] = np.nan_to_num(self.unseen.find(key[rest] >> np.uint64(8)))
        return ratio

    def measures(self, data: np.ndarray, offsets: np.ndarray, others: np.ndarray | float = 0
                 ) -> np.ndarray:
        """(mean ratio of the best window, of the text) for each text; 0 for very short texts.

        others: the ratios that the other parts have found.
        """
        n = len(offsets) - 1
        key, text = grams(data, offsets)
        ratio = self.ratios(key) + others
        out = np.zeros((n, 2))
        if len(key):
            sums = np.concatenate([[0.0], np.cumsum(ratio, dtype=np.float64)])
            begin = np.searchsorted(text, np.arange(n + 1))
            size = np.diff(begin)
            full = np.flatnonzero(size)
            out[full, 1] = (sums[begin[1:]] - sums[begin[:-1]])[full] / size[full]
            out[:, 0] = out[:, 1]
            last = np.minimum(np.arange(len(key)) + WINDOW, begin[1:][text])
            # windows that the end of the text cuts short count as full ones, so as weaker
            best = np.maximum.reduceat((sums[last] - sums[:-1]) / WINDOW, begin[:-1][full])
            out[full, 0] = np.maximum(best, out[full, 1])
        return out


def models(spark: SparkSession, seen: DataFrame, unseen: DataFrame, n: int) -> list[Broadcast]:
    """The parts of the ratios, of bounded size each, for about n grams."""
    parts = max(1, -(-n // PART))
    if parts > 1:
        seen, unseen = kept(seen, "seen"), kept(unseen, "unseen")
    return [spark.sparkContext.broadcast(Model(
        lookup(seen, "gram", k, parts), lookup(unseen, "context", k, parts), k, parts))
        for k in range(parts)]


def measured(docs: DataFrame, parts: list[Broadcast]) -> DataFrame:
    """docs (id, text, ...) with columns peak and mean in place of the text.

    A pass over the texts for each part; what is found at the places of a text goes on to the next.
    """
    rest = [c for c in docs.columns if c != "text"]
    kinds = dict(docs.dtypes)
    head = ", ".join(f"{c} {kinds[c]}" for c in rest)

    def others(batch: pa.RecordBatch) -> np.ndarray | float:
        if "found" not in batch.schema.names:
            return 0
        return np.frombuffer(b"".join(batch.column("found").to_pylist()), np.float32)

    def passed_on(model: Broadcast):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in X.slices(whole, X.PIECE):
                    key, text = grams(*X.packed(batch.column("text")))
                    ratio = model.value.ratios(key) + others(batch)
                    places = np.searchsorted(text, np.arange(len(batch) + 1))
                    found = [ratio[a:b].astype(np.float32).tobytes()
                             for a, b in zip(places[:-1], places[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c) for c in rest], batch.column("text"),
                         pa.array(found, pa.binary())], [*rest, "text", "found"])
        return work

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [last.value.measures(*X.packed(piece.column("text")), others(piece))
                     for piece in X.slices(batch, X.PIECE)]
            found = np.concatenate(found or [np.zeros((0, 2))])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in rest], pa.array(found[:, 0]), pa.array(found[:, 1])],
                [*rest, "peak", "mean"])

    *before, last = parts
    for model in before:
        docs = kept(docs.mapInArrow(passed_on(model), f"{head}, text string, found binary"), "found")
    return docs.mapInArrow(work, f"{head}, peak double, mean double")


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression with an intercept, by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(weights))
        change = np.linalg.solve(curve, slope)
        weights -= change
        if np.abs(change).max() < 1e-9:
            break
    return weights


def toxicity_scores(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
                    label: str = "toxic", held_out: int = 2, threshold: float = 0.3
                    ) -> DataFrame:
    """One row per row of docs: id, held_out, score, predicted, peak, mean.

    score is the probability of label 1; nothing but the text goes into it. The models count all
    labelled texts of two `fold`s, the curve is fitted on the one left beside `held_out`. Null,
    empty and very short texts have measures of 0. Without labels every score is one half. Labels
    that are neither 0 nor 1 are not used; a repeated one counts as 1 if any of its rows does.
    Ids must be distinct integers; a row without one gives no row. Other columns are ignored.
    """
    usable = (labels.select(F.col(id).cast("long").alias("id"),
                            F.col(label).cast("int").alias("label"))
              .where("id is not null and label in (0, 1)")
              .groupBy("id").agg(F.max("label").alias("label")))
    docs = texts_of(docs, id, text)
    curve_fold = (held_out + 1) % 4
    counted = usable.where(~fold("id").isin(held_out, curve_fold))
    counts = kept(class_counts(joined(docs, counted)), "grams")
    seen, unseen = likelihood_ratios(counts)
    parts = models(docs.sparkSession, seen, unseen, counts.count())

    sample = F.broadcast(bounded(usable.where(fold("id") == curve_fold), docs, CALIBRATION))
    fit = measured(docs.join(sample, "id"), parts).select("peak", "mean", "label").toArrow()
    peak, mean, marked = (fit[c].to_numpy().astype(float) for c in ("peak", "mean", "label"))
    weights = [float(w) for w in logistic(np.column_stack([peak, mean]), marked)]
    score = 1 / (1 + F.exp(-(weights[0] + weights[1] * F.col("peak")
                             + weights[2] * F.col("mean"))))
    return measured(docs, parts).withColumn("score", score).select(
        F.col("id").alias(id), (fold("id") == held_out).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "peak", "mean")
