import sys

import pytest
from comments import comment, frame
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voxlake.functions import sentiment as M
from voxlake.operators.cleaning import clean_comments
from voxlake.operators.scoring import (
    KeywordPredictor, Scorer, attach_predictions, choose_scorer, score, sentiment_of)
from voxlake.settings import ScoringSettings

# executors cannot import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def scores(rows):
    return {r.comment_id: (r.positive_score, r.negative_score, r.sentiment) for r in rows.collect()}


TEXTS = {"tie": "khong thich", "none": "xyz", "pos": "great", "neg": "bad and boring",
         "eighth": "good te do bad poor toi met chan", "misfire": "terrible dog",
         "half": "GOOD " * 3 + "awful te"}


@pytest.fixture
def cleaned(spark):
    return clean_comments(frame(spark, [comment(k, text=t) for k, t in TEXTS.items()]))


def test_keyword_scores(cleaned):
    found = scores(score(cleaned, Scorer("keyword")))
    assert found["tie"] == (50, 50, "neutral")
    assert found["none"] == (0, 0, "neutral")
    assert found["pos"] == (100, 0, "positive")
    assert found["eighth"] == (12, 88, "negative")
    assert found["misfire"] == (0, 100, "negative")


def test_predictor_equals_the_expression(cleaned):
    as_predictor = score(cleaned, Scorer("p", KeywordPredictor, batch_size=2))
    assert scores(as_predictor) == scores(score(cleaned, Scorer("keyword")))
    assert {r.scorer for r in as_predictor.collect()} == {"p"}


def test_predictor_runs_once_per_row(cleaned):
    plan = score(cleaned, Scorer("p", KeywordPredictor))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("ArrowEvalPython") == 1


def test_whole_word_mode(one):
    assert one(lambda x: M.keyword_hits(x, ["do"], whole_words=True), ["dog", "a do b", "édo"]) == [
        0, 1, 0]


def test_scorer_is_chosen_once():
    def broken():
        raise OSError("no model")

    assert choose_scorer(ScoringSettings("keyword")).factory is None
    assert choose_scorer(ScoringSettings("model"), KeywordPredictor).name == "model"
    assert choose_scorer(ScoringSettings("model"), broken).name == "keyword"
    with pytest.raises(OSError):
        choose_scorer(ScoringSettings("model", fallback=False), broken)
    with pytest.raises(ValueError):
        choose_scorer(ScoringSettings("other"))


def test_labels(one):
    assert one(M.normalize_label, ["4 stars", "LABEL_1", " neg ", "2 stars", "0", "POS"]) == [
        "positive", "neutral", "negative", "negative", "negative", "positive"]


@pytest.mark.parametrize("label", ["x", "many stars", None])
def test_unknown_label_fails(one, label):
    with pytest.raises(PySparkException, match="Unsupported sentiment label"):
        one(M.normalize_label, [label])


def test_strongest_prefers_positive_then_neutral(spark):
    rows = spark.createDataFrame([(1., 1., 1.), (0., 1., 1.), (0., 0., 1.), (0., 2., 1.)],
                                 "p double, u double, n double")
    found = rows.select(M.strongest(F.col("p"), F.col("u"), F.col("n")).alias("s")).collect()
    assert [r.s for r in found] == ["positive", "neutral", "negative", "neutral"]


def test_attach_predictions_drops_comments_without_one(spark, cleaned):
    predictions = score(cleaned.filter("comment_id = 'pos'"), Scorer("keyword")).select(
        "video_id", "comment_id", "sentiment")
    assert [r.comment_id for r in attach_predictions(cleaned, predictions).collect()] == ["pos"]


def classifier():
    def classify(texts):
        return [[{"label": "LABEL_2", "score": 0.125}, {"label": "neg", "score": 0.875}]
                if "bad" in t else [{"label": "POS", "score": 0.5}, {"label": "1", "score": 0.5}]
                for t in texts]
    return classify


def test_classifier_scores(cleaned):
    scorer = choose_scorer(ScoringSettings("model", batch_size=3), classifier)
    assert scorer.classifies
    found = scores(score(cleaned, scorer))
    assert found["neg"] == (12, 88, "negative")
    assert found["pos"] == (50, 0, "positive")


@pytest.mark.parametrize("label", ["4 stars", "LABEL_1", " neg ", "2 stars", "0", "POS", "3 stars"])
def test_labels_mean_the_same_in_python(one, label):
    assert one(M.normalize_label, [label]) == [sentiment_of(label)]


def test_unknown_label_fails_in_python():
    with pytest.raises(ValueError):
        sentiment_of("x")
