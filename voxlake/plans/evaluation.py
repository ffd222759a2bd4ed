"""Labelled file -> detail file, bucket accuracy and summary."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxlake.functions.slang import SlangTerm
from voxlake.operators import evaluation as E
from voxlake.operators.scoring import Classifier
from voxlake.schemas import EVALUATION_DETAIL
from voxlake.sources.records import read_labelled, write_detail, write_summary


def evaluate_file(spark: SparkSession, source: str, target: str,
                  label_column: str = "manual_label", notes_column: str = "reviewer_notes",
                  review_column: str | None = None, terms: list[SlangTerm] = (),
                  classifier: Callable[[], Classifier] | None = None,
                  batch_size: int = 8, lexicon: str | None = None, model: str | None = None
                  ) -> DataFrame:
    """Evaluate a labelled CSV; writes detail/, buckets/ and summary/ below `target`.

    Columns are found by the header; text, the label column and a given review column must be
    there. The summary row is returned: it names the input, the lexicon and the model, and where
    the accuracy of each bucket is. Metrics are read from the written detail, so no row is
    predicted twice.
    """
    needed = ["text", label_column, *([review_column] if review_column else [])]
    rows = E.prepare_labelled(read_labelled(spark, source, needed), label_column, list(terms))
    predicted = (E.keyword_predictions(rows) if classifier is None
                 else E.classifier_predictions(rows, classifier, batch_size))
    write_detail(E.evaluation_detail(predicted, notes_column, review_column), f"{target}/detail")
    detail = read_labelled(spark, f"{target}/detail", EVALUATION_DETAIL.names, ())
    E.accuracy_by_bucket(detail).write.mode("overwrite").json(f"{target}/buckets")
    summary = E.evaluation_summary(
        detail, evaluation_mode="keyword" if classifier is None else "model",
        input_file=source, label_column=label_column, lexicon=lexicon, model=model,
        bucket_accuracy=f"{target}/buckets")
    write_summary(summary, f"{target}/summary")
    return spark.read.text(f"{target}/summary")
