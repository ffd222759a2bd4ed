"""Rows without an id give no row, change no other, and pass the filters of the pipeline."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import by_id
from voxlake.llm.decontamination import contamination
from voxlake.llm.near_duplicates import near_duplicates
from voxlake.llm.periodic_runs import periodic_runs
from voxlake.llm.quality_classifier import quality_scores
from voxlake.llm.queries import CLEANING, DOMAIN, PRE_TOKENS, TOKENIZER, tokenizer_file
from voxlake.llm.repeated_passages import without_repeats
from voxlake.llm.sanitisation import masked, sanitisation
from voxlake.llm.source_mixing import mixing_rates
from voxlake.llm.token_alignment import alignment
from voxlake.llm.token_counts import edit_aware_counts
from voxlake.llm.token_files import token_files
from voxlake.llm.toxicity import toxicity_scores
from voxlake.settings import shared_folder


def operators(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0), (4, 0, 1), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "some words of an item"), (None, "text 1")],
                                      "item_id long, text string")
    return {
        "mixing": lambda d: mixing_rates(d, labels, F.expr(DOMAIN), {"a": 1.0, "b": 1.0, "c": 1.0}),
        "toxicity": lambda d: toxicity_scores(d, labels),
        "quality": lambda d: quality_scores(d, labels),
        "near": near_duplicates,
        "repeats": without_repeats,
        "tokens": lambda d: edit_aware_counts(d, CLEANING, TOKENIZER, PRE_TOKENS),
        "leaks": lambda d: contamination(d, benchmark),
        "private": sanitisation,
        "files": lambda d: token_files(d, shared_folder(spark, "files"),
                                       tokenizer_file("byte_bpe_50k.json"), 2),
        "alignment": lambda d: alignment(d, tokenizer_file("byte_bpe_50k.json"),
                                         tokenizer_file("piece_bpe_32k.model")),
        "runs": periodic_runs,
    }


@pytest.mark.parametrize("name", [
    "mixing", "toxicity", "quality", "near", "repeats", "tokens", "leaks", "private", "files",
    "alignment", "runs"])
def test_operators(spark, documents, name):
    rows = [(i, f"text {i} some words of an item " * 9) for i in range(1, 7)]
    operator = operators(spark)[name]
    found = by_id(operator(documents([*rows, (None, rows[0][1]), (None, None)])))
    plain = by_id(operator(documents(rows)))
    assert set(found) == set(plain) == {i for i, _ in rows}
    if name not in ("private", "mixing"):  # the others do not depend on the number of documents
        assert {i: str(r) for i, r in found.items()} == {i: str(r) for i, r in plain.items()}


def test_masking_and_filters_keep_them(documents):
    docs = documents([(1, "a@b.cd x"), (None, "a@b.cd y"), (None, None)])
    assert {r.text for r in masked(docs, sanitisation(docs)).collect()} == {
        "<email> x", "a@b.cd y", None}
    left = corpus_pipeline._without(docs, docs.where("doc_id = 1"))
    assert left.columns == docs.columns and left.count() == 2
