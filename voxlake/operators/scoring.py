"""Sentiment scoring where the rows are. Nothing is collected.

A predictor is any object with predict(list[str]) returning one dict per text with
positive_score, negative_score and sentiment. A classifier is any callable that returns, per text,
a list of {label, score}, as text-classification pipelines do; its labels are mapped to the three
sentiments. A factory builds either of them once per worker process.
"""

import hashlib
import logging
import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from types import ModuleType
from typing import Any, Protocol

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from voxlake.fixed_values import (
    LABEL_SPELLINGS, NEGATIVE_KEYWORDS, POSITIVE_KEYWORDS, SENTIMENTS)
from voxlake.functions.sentiment import (
    prediction_from_hits, prediction_from_scores, sentiment_hits)
from voxlake.functions.slang import SlangTerm, scoring_text
from voxlake.schemas import PREDICTION_FIELDS
from voxlake.settings import ScoringSettings

cloudpickle.register_pickle_by_value(sys.modules[__name__])
log = logging.getLogger(__name__)


class Predictor(Protocol):
    def predict(self, texts: list[str]) -> Sequence[dict[str, Any]]: ...


Classifier = Callable[[list[str]], Sequence[Sequence[dict[str, Any]]]]
CLASS_SCORES = StructType([StructField(s, DoubleType()) for s in SENTIMENTS])


def sentiment_of(label: str) -> str:
    """Label spelling of one classifier class to a sentiment; the column form is normalize_label."""
    spelling = label.strip().lower()
    for sentiment, spellings in LABEL_SPELLINGS.items():
        if spelling in spellings:
            return sentiment
    if "star" not in spelling:
        raise ValueError(f"Unsupported sentiment label: {label}")
    above = int(spelling.split()[0]) - 3
    return SENTIMENTS[1 - (above > 0) + (above < 0)]


class KeywordPredictor:
    """Keyword scorer in predictor form; scores equal the built-in expression."""

    def __init__(self, positive: Sequence[str] = POSITIVE_KEYWORDS,
                 negative: Sequence[str] = NEGATIVE_KEYWORDS) -> None:
        self.positive, self.negative = tuple(positive), tuple(negative)

    def predict(self, texts: list[str]) -> list[dict[str, Any]]:
        return [self._score((text or "").lower()) for text in texts]

    def _score(self, text: str) -> dict[str, Any]:
        up = sum(word in text for word in self.positive)
        down = sum(word in text for word in self.negative)
        hits = up + down or 1
        lead = (up > down) - (up < down)
        return {"positive_score": round(up / hits * 100), "negative_score": round(down / hits * 100),
                "sentiment": SENTIMENTS[1 - lead]}


@dataclass(frozen=True)
class Scorer:
    """The scorer of one run: its name and the factory behind it (None: built-in keywords)."""

    name: str
    factory: Callable[[], Predictor | Classifier] | None = None
    batch_size: int = 16
    classifies: bool = False


def choose_scorer(settings: ScoringSettings,
                  model_factory: Callable[[], Predictor | Classifier] | None = None) -> Scorer:
    """Decide once, on the driver, which scorer the whole run uses."""
    if settings.mode == "keyword":
        return Scorer("keyword")
    if settings.mode != "model":
        raise ValueError(f"unknown scoring mode: {settings.mode}")
    try:
        if model_factory is None:
            raise ValueError("mode 'model' needs a predictor factory")
        classifies = _kind_of(model_factory)
    except Exception as failure:
        if not settings.fallback:
            raise
        log.warning("model not available, keyword scorer used instead: %s", failure)
        return Scorer("keyword")
    return Scorer("model", model_factory, settings.batch_size, classifies)


def _kind_of(factory: Callable[[], Predictor | Classifier]) -> bool:
    """Whether the factory makes a classifier.

    A factory with an attribute `available`, a cheap check that raises if the model cannot be
    had, says so in `classifies`; only without one is the model loaded here to find out.
    """
    if hasattr(factory, "available"):
        factory.available()
        return bool(getattr(factory, "classifies", False))
    return not hasattr(factory(), "predict")


def _once_per_process(key: str, factory: Callable[[], Any]) -> Any:
    """The factory's model: made once in a worker process, for all its tasks.

    Kept under a module of its own, as this one is pickled by value and comes anew each time.
    """
    made = sys.modules.setdefault("_voxlake_models", ModuleType("_voxlake_models")).__dict__
    if key not in made:
        made[key] = factory()
    return made[key]


def checked_predictions(rows: list[dict[str, Any]]) -> list[dict[str, Any]]:
    """The rows, if each is a complete prediction: two scores from 0 to 100, a known sentiment."""
    for row in rows:
        good = (row["sentiment"] in SENTIMENTS and all(
            row[c] is not None and 0 <= row[c] <= 100 for c in ("positive_score", "negative_score")))
        if not good:
            raise ValueError(f"not a prediction: {row}")
    return rows


def _batched(text: Column, factory: Callable[[], Any], rows_of: Callable[[Any, list[str]], list],
             fields: StructType, batch_size: int) -> Column:
    """Struct column filled batch by batch. Only the text travels to Python."""
    names = fields.names
    key = hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = _once_per_process(key, factory)
        for texts in batches:
            rows: list = []
            for start in range(0, len(texts), batch_size):
                rows.extend(rows_of(model, texts.iloc[start:start + batch_size].tolist()))
            yield pd.DataFrame(rows, columns=names)

    return F.pandas_udf(run, fields)(text)


def predictor_column(text: Column, factory: Callable[[], Predictor], batch_size: int = 16) -> Column:
    """Struct (positive_score, negative_score, sentiment) of a predictor."""
    return _batched(text, factory, lambda model, texts: checked_predictions(model.predict(texts)),
                    PREDICTION_FIELDS, batch_size)


def class_scores(text: Column, factory: Callable[[], Classifier], batch_size: int = 16) -> Column:
    """Struct (positive, neutral, negative) of a classifier's scores; a class not named has 0."""
    def by_sentiment(model: Classifier, texts: list[str]) -> list[dict[str, float]]:
        return [{s: 0.0 for s in SENTIMENTS}
                | {sentiment_of(c["label"]): float(c["score"]) for c in classes}
                for classes in model(texts)]

    return _batched(text, factory, by_sentiment, CLASS_SCORES, batch_size)


def with_hits(rows: DataFrame, text: str) -> DataFrame:
    """Add the keyword hits _up and _down of a lower-case text.

    They are columns of their own, so that what is made of them does not search the text again.
    """
    up, down = sentiment_hits(F.col(text))
    return rows.withColumns({"_up": up, "_down": down})


def score(comments: DataFrame, scorer: Scorer, terms: Sequence[SlangTerm] = ()) -> DataFrame:
    """Add positive_score, negative_score, sentiment and the scorer's name."""
    source = scoring_text(F.col("text"), list(terms)) if terms else F.col("text_clean")
    readable = comments.withColumn("_reads", source)
    if scorer.factory is None:
        readable = with_hits(readable, "_reads")
        prediction = prediction_from_hits(F.col("_up"), F.col("_down"))
    elif scorer.classifies:
        readable = readable.withColumn("_classes", class_scores(
            F.col("_reads"), scorer.factory, scorer.batch_size))
        prediction = prediction_from_scores(*[F.col("_classes")[s] for s in SENTIMENTS])
    else:
        prediction = predictor_column(F.col("_reads"), scorer.factory, scorer.batch_size)
    return (readable.withColumn("_prediction", prediction)
            .select(*comments.columns, "_prediction.*", F.lit(scorer.name).alias("scorer")))


def attach_predictions(comments: DataFrame, predictions: DataFrame) -> DataFrame:
    """Join predictions made elsewhere; comments without one drop out."""
    return comments.join(predictions, ["video_id", "comment_id"], "inner")
