import json
import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.errors import PySparkException

from voxlake.functions.slang import slang_terms
from voxlake.operators import evaluation as E
from voxlake.plans.evaluation import evaluate_file
from voxlake.schemas import EVALUATION_DETAIL
from voxlake.sources import records as REC

# executors cannot import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# published counts of a model on 100 labelled comments: actual -> predicted
COUNTS = {("positive", "positive"): 42, ("neutral", "positive"): 2, ("neutral", "neutral"): 25,
          ("neutral", "negative"): 6, ("negative", "positive"): 1, ("negative", "neutral"): 2,
          ("negative", "negative"): 22}


@pytest.fixture
def detail(spark):
    pairs = [pair for pair, n in COUNTS.items() for _ in range(n)]
    return spark.createDataFrame([
        (str(i), f"c{i}", "v", "t", actual, "reviewed" if i % 7 == 0 else "unbucketed", "",
         predicted, f"{0.5 + i / 1000:.6f}", "yes" if actual == predicted else "no")
        for i, (actual, predicted) in enumerate(pairs)], EVALUATION_DETAIL)


def test_published_metrics(detail):
    assert E.accuracy(detail).collect() == [(100, 89, 0.89, 11)]
    assert E.macro_f1(detail).first().macro_f1 == pytest.approx(0.8763464179859756, abs=1e-15)
    rates = {r.label: tuple(round(x, 4) for x in r[1:]) for r in E.label_metrics(detail).collect()}
    assert rates == {"positive": (0.9333, 1.0, 0.9655, 42), "neutral": (0.9259, 0.7576, 0.8333, 33),
                     "negative": (0.7857, 0.88, 0.8302, 25)}


def test_confusion_matrix_has_all_rows_and_zeros(detail):
    assert sorted(map(tuple, E.confusion_matrix(detail).collect())) == [
        ("negative", 1, 2, 22), ("neutral", 2, 25, 6), ("positive", 42, 0, 0)]
    empty = detail.limit(0)
    assert {tuple(r)[1:] for r in E.confusion_matrix(empty).collect()} == {(0, 0, 0)}
    assert E.accuracy(empty).collect() == [(0, 0, 0.0, 0)]
    assert E.macro_f1(empty).first().macro_f1 == 0.0


def test_mismatches_reviewed_first_then_least_confident(detail):
    rows = E.top_mismatches(detail).collect()
    order = [(r.review_bucket != "reviewed", float(r.predicted_confidence)) for r in rows]
    assert len(rows) == 11 and order == sorted(order) and not order[0][0]


def test_sinks(spark, detail, tmp_path):
    REC.write_summary(E.evaluation_summary(detail, input_file="x.csv", model_name=None),
                      str(tmp_path / "s"))
    text = "".join(p.read_text() for p in Path(tmp_path, "s").glob("*.txt"))
    summary = json.loads(text)
    assert summary["correct_rows"] == 89 and summary["input_file"] == "x.csv"
    assert summary["actual_distribution"] == {"positive": 42, "neutral": 33, "negative": 25}
    assert summary["predicted_distribution"] == {"positive": 45, "neutral": 27, "negative": 28}
    assert len(summary["top_mismatches"]) == 11
    assert summary["macro_f1"] == pytest.approx(0.8763464179859756)
    REC.write_detail(detail, str(tmp_path / "d"))
    back = REC.read_labelled(spark, str(tmp_path / "d"), EVALUATION_DETAIL.names, ())
    assert back.columns == EVALUATION_DETAIL.names and back.count() == 100


CSV = ('\ufeff"idx","comment_id","video_id","text","manual_label","reviewer_notes"\n'
       '"1","a","v","W \\U0001f60a","positive","n"\n'
       '"2","b","v","two\nlines ""quoted"", comma","NEG",""\n')


def test_labelled_csv(spark, tmp_path):
    (tmp_path / "l.csv").write_text(CSV, encoding="utf-8")
    rows = REC.read_labelled(spark, str(tmp_path / "l.csv"))
    ready = E.prepare_labelled(rows, "manual_label", slang_terms()).orderBy("idx").collect()
    assert [(r.idx, r.text_clean, r.actual_label) for r in ready] == [
        ("1", "awesome win happy", "positive"), ("2", 'two lines "quoted", comma', "negative")]
    detail = E.evaluation_detail(E.keyword_predictions(
        E.prepare_labelled(rows, "manual_label", slang_terms()))).orderBy("idx").collect()
    assert [(r.predicted_label, r.predicted_confidence, r.is_match, r.review_bucket, r.notes)
            for r in detail] == [("positive", "1.000000", "yes", "unbucketed", "n"),
                                 ("negative", "1.000000", "yes", "unbucketed", "")]


def test_missing_label_fails_the_run(spark, tmp_path):
    (tmp_path / "l.csv").write_text(CSV + '"3","c","v","t","",""\n', encoding="utf-8")
    rows = REC.read_labelled(spark, str(tmp_path / "l.csv"))
    with pytest.raises(PySparkException, match="missing label in column manual_label, row 3"):
        E.prepare_labelled(rows, "manual_label").select("actual_label").collect()


def stars():
    """A classifier that names stars: five for a heart, one for 'bad', else three."""
    def classify(texts):
        return [[{"label": "5 stars", "score": 0.905 if "love" in t else 0.1},
                 {"label": "1 star", "score": 0.7 if "bad" in t else 0.05},
                 {"label": "3 stars", "score": 0.2}] for t in texts]
    return classify


def test_evaluate_a_file(spark, tmp_path):
    source = tmp_path / "l.csv"
    source.write_text('idx,comment_id,video_id,text,label,notes,bucket\n'
                      '1,a,v,"I love \\U0001F60A it",pos,n1,reviewed\n'
                      '2,b,v,"bad",1 star,,\n3,c,v,"meh",2,n3,\n')
    how = dict(label_column="label", notes_column="notes", review_column="bucket",
               lexicon="none", model="stars")
    row = evaluate_file(spark, str(source), str(tmp_path / "m"), classifier=stars, **how).first()
    summary = json.loads(row.value)
    assert (summary["total_rows"], summary["correct_rows"]) == (3, 2)
    assert summary["evaluation_mode"] == "model"
    assert [m["comment_id"] for m in summary["top_mismatches"]] == ["c"]
    assert (summary["lexicon"], summary["model"]) == ("none", "stars")
    assert summary["bucket_accuracy"] == str(tmp_path / "m" / "buckets")
    detail = spark.read.options(header=True).csv(str(tmp_path / "m" / "detail"))
    assert {r.comment_id: (r.predicted_label, r.predicted_confidence) for r in detail.collect()} == {
        "a": ("positive", "0.905000"), "b": ("negative", "0.700000"), "c": ("neutral", "0.200000")}
    buckets = spark.read.json(str(tmp_path / "m" / "buckets")).collect()
    assert {(r.review_bucket, r.total, r.correct) for r in buckets} == {
        ("reviewed", 1, 1), ("unbucketed", 2, 1)}
    row = evaluate_file(spark, str(source), str(tmp_path / "k"), **how).first()
    assert json.loads(row.value)["evaluation_mode"] == "keyword"


def test_labelled_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "l.csv").write_text("comment_id,idx,video_id,text,reviewer_notes,manual_label\n"
                                    "c,1,v,fine,negative,positive\n")
    (row,) = E.prepare_labelled(REC.read_labelled(
        spark, str(tmp_path / "l.csv"), ["text", "manual_label"]), "manual_label").collect()
    assert (row.actual_label, row.reviewer_notes, row.idx) == ("positive", "negative", "1")
    (tmp_path / "t.csv").write_text("comment_id,video_id,text,manual_label,notes\nc,v,good,pos,n\n")
    row = evaluate_file(spark, str(tmp_path / "t.csv"), str(tmp_path / "o"),
                        notes_column="notes").first()
    assert json.loads(row.value)["correct_rows"] == 1
    with pytest.raises(ValueError, match="no column label"):
        REC.read_labelled(spark, str(tmp_path / "t.csv"), ["text", "label"])
