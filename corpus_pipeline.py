"""From raw documents to a weighted training corpus: stages that each call one operator.

A stage takes (spark, docs, sf_dir), docs with the columns of `documents`, and returns the documents
it keeps with the same columns; the last one returns the rate of each document instead. Rows without
a doc_id are not judged: they pass until the last stage, which has no rate for them.
"""

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.decontamination import contamination
from voxlake.llm.near_duplicates import near_duplicates
from voxlake.llm.quality_classifier import quality_scores
from voxlake.llm.queries import DOMAIN, WEIGHTS, table
from voxlake.llm.sanitisation import masked, sanitisation
from voxlake.llm.source_mixing import mixing_rates
from voxlake.llm.storage import finished, ship_package
from voxlake.settings import lend_shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(build: Stage) -> Stage:
    """What a stage needs of the session, whoever calls it."""
    @functools.wraps(build)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        lend_shared_folder(spark)
        ship_package(spark)
        return build(spark, docs, sf_dir)

    return run


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    return docs.join(rejected.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


@stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good stay."""
    scores = quality_scores(docs, table(spark, sf_dir, "labels"))
    return _without(docs, scores.where("predicted = 0"))


@stage
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    return _without(docs, near_duplicates(docs).where("not kept"))


@stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where(F.size("ranges") > 0))


@stage
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and terms that disclose it are masked in the texts; n_chars follows."""
    hidden = masked(docs, sanitisation(docs))
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rate of each document at which the corpus has the target weights."""
    return mixing_rates(docs, table(spark, sf_dir, "labels"), F.expr(DOMAIN), WEIGHTS)


STAGES = [("quality", good_quality), ("near_duplicates", without_copies),
          ("decontamination", without_benchmark), ("personal_data", without_personal_data),
          ("mixing", mixture)]

#: SQL cannot train the classifiers; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again.

    A stage's own tables go once its rows are written, the stages' once the last one's are.
    """
    lend_shared_folder(spark)

    def chained() -> DataFrame:
        docs = table(spark, sf_dir, "documents")
        for name, build in STAGES[:-1]:
            docs = finished(spark, functools.partial(build, spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)

    return finished(spark, chained, STAGES[-1][0])
