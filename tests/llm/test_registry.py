"""Registered operators and the pipeline over the smallest tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from checks import compare
from voxlake.llm import queries
from voxlake.llm.oracles import oracle_sql
from voxlake.llm.storage import kept

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not here")


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
    assert set(SQL) < set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", queries.QUERIES)
    assert compare.differences(spark, compare.connect(SF), SF, name, SQL[name]) == ""


def test_stages_follow_each_other(spark):
    docs = queries.table(spark, SF, "documents")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "near_duplicates", "decontamination", "personal_data", "mixing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept(stage(spark, docs, SF), name)
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert docs.columns == columns and left <= ids and docs.count() == len(left)
        assert (left == ids) == (name == "personal_data")
        ids = left
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in last.collect()} == ids
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.select("doc_id", "n_tokens").collect())) == sorted(
        map(str, last.select("doc_id", "n_tokens").collect()))


def test_decisions_of_the_stages(spark):
    """Against plain Python on what each stage was given."""
    from tests.llm.test_decontamination import brute_force as contaminated
    from tests.llm.test_near_duplicates import brute_force as grouped
    from tests.llm.test_sanitisation import brute_force as personal

    docs = queries.table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    kept_ids = lambda stage: {
        r.doc_id for r in stage(spark, docs, SF).select("doc_id").collect()}
    assert kept_ids(corpus_pipeline.without_copies) == {
        i for i, (_, _, first) in grouped(rows, 80).items() if first}
    items = [(r.item_id, r.text) for r in queries.table(spark, SF, "benchmark").collect()]
    assert kept_ids(corpus_pipeline.without_benchmark) == {
        i for i, (_, hit, _) in contaminated(rows, items).items() if not hit}
    masked = {r.doc_id: r for r in corpus_pipeline.without_personal_data(spark, docs, SF).collect()}
    for i, text in rows:
        assert (masked[i].text != text) == bool(personal(text))
        assert masked[i].n_chars == len(masked[i].text)
        assert not personal(masked[i].text)
    good = kept_ids(corpus_pipeline.good_quality)
    marks = {r.doc_id: r.quality for r in queries.table(spark, SF, "labels").collect()}
    assert sum((i in good) == (q == 1) for i, q in marks.items()) >= 0.95 * len(marks)
