import pytest
from comments import comment, frame
from pyspark.errors import PySparkException

from voxlake.operators.cleaning import clean_comments
from voxlake.operators.scoring import Scorer, choose_scorer, score
from voxlake.plans.ingestion import ingest
from voxlake.settings import ScoringSettings


def answering(**answer):
    """A factory of a predictor that always says the same, and is falsy."""
    class Same:
        def predict(self, texts):
            return [dict(answer) for _ in texts]

        def __len__(self):
            return 0

    return Same


def test_a_model_is_made_once_in_a_process(spark, tmp_path):
    folder = str(tmp_path)
    make = answering(positive_score=1, negative_score=2, sentiment="neutral")

    def factory():
        import os
        import tempfile
        os.close(tempfile.mkstemp(prefix=f"{os.getpid()}-", dir=folder)[0])
        return make()

    rows = clean_comments(frame(spark, [comment(str(i), "x") for i in range(200)])).repartition(24)
    for _ in range(2):
        scored = score(rows, Scorer("counted", factory))
        assert scored.filter("positive_score = 1 and scorer = 'counted'").count() == 200
    processes = [path.name.split("-")[0] for path in tmp_path.iterdir()]
    assert len(processes) == len(set(processes)) <= 8


@pytest.mark.parametrize("answer", [
    dict(positive_score=101, negative_score=0, sentiment="positive"),
    dict(positive_score=None, negative_score=0, sentiment="positive"),
    dict(positive_score=1, negative_score=0, sentiment="fine")])
def test_incomplete_predictions_fail(spark, answer):
    rows = clean_comments(frame(spark, [comment("1", "x")]))
    with pytest.raises(PySparkException, match="not a prediction"):
        score(rows, Scorer("odd", answering(**answer))).collect()


def test_a_factory_is_asked_not_run(caplog):
    class Factory:
        classifies = True

        def __init__(self, there):
            self.there = there

        def available(self):
            if not self.there:
                raise OSError("no model file")

        def __call__(self):
            raise AssertionError("loaded on the driver")

    chosen = choose_scorer(ScoringSettings("model"), Factory(True))
    assert chosen.classifies and chosen.name == "model"
    assert choose_scorer(ScoringSettings("model"), Factory(False)).name == "keyword"
    with pytest.raises(OSError):
        choose_scorer(ScoringSettings("model", fallback=False), Factory(False))


def test_ingestion_counts_and_repeats(spark, tmp_path):
    rows = frame(spark, [comment("a", "x"), comment("a", "x"), comment("b", "y"),
                         comment("c", None), comment("d\t", "z")])
    landed = spark.createDataFrame([("b",), ("d",)], "comment_id string")
    for _ in range(2):
        counts = ingest(rows, str(tmp_path / "out"), landed, skip_invalid=True)
        assert counts == {"incoming": 5, "published": 1, "quarantined": 1}
    assert {r.key for r in spark.read.json(str(tmp_path / "out" / "messages")).collect()} == {"a"}
