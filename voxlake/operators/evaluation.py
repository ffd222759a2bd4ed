"""Predicted against actual labels.

All label metrics follow from nine counts, so one pass over the detail rows is enough.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.fixed_values import SENTIMENTS
from voxlake.functions.cleaning import squeeze
from voxlake.functions.sentiment import (
    confidence_from_hits, normalize_label, prediction_from_hits, strongest)
from voxlake.functions.slang import SlangTerm, evaluation_text
from voxlake.operators.scoring import Classifier, class_scores, with_hits
from voxlake.schemas import EVALUATION_DETAIL


def prepare_labelled(rows: DataFrame, label_column: str,
                     terms: list[SlangTerm] = ()) -> DataFrame:
    """Add text_clean and actual_label; a row without a label fails the run."""
    label = F.col(label_column)
    missing = F.raise_error(F.concat(
        F.lit(f"missing label in column {label_column}, row "),
        F.coalesce(F.col("idx").cast("string"), F.lit("unknown"))))
    present = F.when(F.coalesce(label, F.lit("")) == "", missing.cast("string")).otherwise(label)
    return rows.withColumns({
        "text_clean": evaluation_text(F.col("text"), list(terms)),
        "actual_label": normalize_label(present)})


def keyword_predictions(rows: DataFrame) -> DataFrame:
    """Add predicted_label and predicted_confidence of the keyword scorer."""
    up, down = F.col("_up"), F.col("_down")
    return with_hits(rows, "text_clean").withColumns({
        "predicted_label": prediction_from_hits(up, down)["sentiment"],
        "predicted_confidence": confidence_from_hits(up, down)}).drop("_up", "_down")


def classifier_predictions(rows: DataFrame, factory: Callable[[], Classifier],
                           batch_size: int = 8) -> DataFrame:
    """Add predicted_label and predicted_confidence of a classifier."""
    classes = [F.col("_classes")[s] for s in SENTIMENTS]
    return (rows.withColumn("_classes", class_scores(F.col("text_clean"), factory, batch_size))
            .withColumns({"predicted_label": strongest(*classes),
                          "predicted_confidence": F.greatest(*classes)}).drop("_classes"))


def evaluation_detail(predicted: DataFrame, notes_column: str = "reviewer_notes",
                      review_column: str | None = None) -> DataFrame:
    """One line per labelled row, as kept in the detail file."""
    bucket = squeeze(F.col(review_column)) if review_column else F.lit("")
    notes = F.coalesce(notes_column, F.lit("")) if notes_column in predicted.columns else F.lit("")
    matches = F.col("actual_label") == F.col("predicted_label")
    return predicted.select(
        F.col("idx").cast("string").alias("idx"), "comment_id", "video_id", "text",
        "actual_label",
        F.coalesce(F.nullif(bucket, F.lit("")), F.lit("unbucketed")).alias("review_bucket"),
        notes.alias("notes"), "predicted_label",
        F.format_string("%.6f", "predicted_confidence").alias("predicted_confidence"),
        F.when(matches, "yes").otherwise("no").alias("is_match"),
    ).select(*EVALUATION_DETAIL.names)


def _matched() -> Column:
    return F.col("actual_label") == F.col("predicted_label")


def accuracy(detail: DataFrame) -> DataFrame:
    """total_rows, correct_rows, agreement_accuracy, mismatch_count."""
    counts = detail.agg(F.count("*").alias("total_rows"),
                        F.count_if(_matched()).alias("correct_rows"))
    total, correct = F.col("total_rows"), F.col("correct_rows")
    return counts.withColumns({
        "agreement_accuracy": F.when(total > 0, correct / total).otherwise(F.lit(0.0)),
        "mismatch_count": total - correct})


def label_distributions(detail: DataFrame) -> DataFrame:
    """(side, label, row_count) for the actual and the predicted labels, in one pass."""
    sides = F.explode(F.array(
        F.struct(F.lit("actual").alias("side"), F.col("actual_label").alias("label")),
        F.struct(F.lit("predicted").alias("side"), F.col("predicted_label").alias("label"))))
    return (detail.select(sides.alias("s")).groupBy("s.side", "s.label")
            .agg(F.count("*").alias("row_count")))


def _cell(actual: str, predicted: str) -> str:
    return f"{actual}_as_{predicted}"


def _label_counts(detail: DataFrame) -> DataFrame:
    """One row with the nine actual/predicted counts."""
    return detail.agg(*[
        F.count_if((F.col("actual_label") == a) & (F.col("predicted_label") == p))
         .alias(_cell(a, p)) for a in SENTIMENTS for p in SENTIMENTS])


def _added(names) -> Column:
    return sum((F.col(n) for n in names), F.lit(0))


def _matrix_row(actual: str) -> Column:
    return F.struct(F.lit(actual).alias("actual_label"),
                    *[F.col(_cell(actual, p)).alias(p) for p in SENTIMENTS])


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _rates(label: str) -> Column:
    hits = F.col(_cell(label, label))
    support = _added(_cell(label, p) for p in SENTIMENTS)
    precision = _share(hits, _added(_cell(a, label) for a in SENTIMENTS))
    recall = _share(hits, support)
    return F.struct(F.lit(label).alias("label"), precision.alias("precision"),
                    recall.alias("recall"),
                    _share(2 * precision * recall, precision + recall).alias("f1_score"),
                    support.alias("support"))


def _macro_f1() -> Column:
    return sum((_rates(s)["f1_score"] for s in SENTIMENTS), F.lit(0.0)) / len(SENTIMENTS)


def _row_per_label(detail: DataFrame, row: Callable[[str], Column]) -> DataFrame:
    rows = F.explode(F.array(*[row(s) for s in SENTIMENTS]))
    return _label_counts(detail).select(rows.alias("r")).select("r.*")


def confusion_matrix(detail: DataFrame) -> DataFrame:
    """One row per actual label, one column per predicted label, zeros filled in."""
    return _row_per_label(detail, _matrix_row)


def label_metrics(detail: DataFrame) -> DataFrame:
    """precision, recall, f1_score and support per label; 0 where a denominator is 0."""
    return _row_per_label(detail, _rates)


def macro_f1(detail: DataFrame) -> DataFrame:
    return _label_counts(detail).select(_macro_f1().alias("macro_f1"))


def accuracy_by_bucket(detail: DataFrame) -> DataFrame:
    counts = detail.groupBy("review_bucket").agg(
        F.count("*").alias("total"), F.count_if(_matched()).alias("correct"))
    return counts.withColumn("accuracy", F.col("correct") / F.col("total"))


def top_mismatches(detail: DataFrame, n: int = 20) -> DataFrame:
    """Wrong rows: bucket 'reviewed' first, then the least confident."""
    return (detail.filter(~_matched())
            .orderBy(F.col("review_bucket") != "reviewed",
                     F.col("predicted_confidence").cast("double"),
                     F.col("idx").cast("long"), "idx").limit(n))


def evaluation_summary(detail: DataFrame, **facts: str | None) -> DataFrame:
    """One row, column `value`: the metrics as JSON.

    It holds the fixed-size parts only: three labels, nine counts, at most 20 mismatches.
    Buckets are free text, so accuracy_by_bucket stays a table of its own.
    """
    cells = {(a, p): F.col(_cell(a, p)) for a in SENTIMENTS for p in SENTIMENTS}
    total = sum(cells.values(), F.lit(0))
    correct = _added(_cell(s, s) for s in SENTIMENTS)
    worst = top_mismatches(detail)
    worst = worst.agg(F.collect_list(F.struct(*worst.columns)))
    return _label_counts(detail).select(F.to_json(F.struct(
        total.alias("total_rows"),
        correct.alias("correct_rows"),
        _share(correct, total).alias("agreement_accuracy"),
        F.struct(*[_added(_cell(s, p) for p in SENTIMENTS).alias(s) for s in SENTIMENTS])
         .alias("actual_distribution"),
        F.struct(*[_added(_cell(a, s) for a in SENTIMENTS).alias(s) for s in SENTIMENTS])
         .alias("predicted_distribution"),
        F.array(*[_rates(s) for s in SENTIMENTS]).alias("label_metrics"),
        _macro_f1().alias("macro_f1"),
        F.array(*[_matrix_row(s) for s in SENTIMENTS]).alias("confusion_matrix"),
        (total - correct).alias("mismatch_count"),
        worst.scalar().alias("top_mismatches"),
        *[F.lit(value).alias(name) for name, value in facts.items()],
    )).alias("value"))
