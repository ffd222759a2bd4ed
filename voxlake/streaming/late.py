"""Rows behind the watermark: kept in a table of their own, and counted per epoch."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.fixed_values import LATENESS
from voxlake.functions.slang import SlangTerm
from voxlake.operators.cleaning import admit, with_clean_text
from voxlake.operators.dedup import first_per_key
from voxlake.operators.gold import with_event_date
from voxlake.operators.scoring import Scorer, score
from voxlake.plans.lakehouse import KEYWORDS, silver_at_rest
from voxlake.plans.landing import Landing, silver_table, without_known
from voxlake.schemas import BRONZE, PROGRESS
from voxlake.settings import TableLayout
from voxlake.sources.tables import gather, overwrite_batch, read_table


def _when():
    # as in dedup_stream: a row from the future moves the watermark no further than others do
    return F.least(F.greatest("collected_at", "event_time"), "ingested_at")


def latest_before(spark: SparkSession, layout: TableLayout, query: str, epoch: int) -> DataFrame:
    """One row: the latest time in the query's earlier epochs; null if there was none."""
    return (read_table(spark, layout.progress, PROGRESS, layout.fmt)
            .where((F.col("query") == query) & (F.col("epoch") < epoch))
            .agg(F.max("latest").alias("latest")))


def split_late(rows: DataFrame, latest: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """rows with `late`: whether one is more than `lateness` before the latest time seen so far."""
    border = latest.select((F.col("latest") - F.expr(f"INTERVAL {lateness}"))).scalar()
    return rows.withColumn("late", F.coalesce(_when() < border, F.lit(False)))


def split_epoch(bronze: DataFrame, layout: TableLayout, query: str, epoch: int,
                scorer: Scorer = KEYWORDS, terms: Sequence[SlangTerm] = (),
                lateness: str = LATENESS) -> None:
    """Land an epoch: late rows as they came, the others in Silver, and the epoch's progress.

    Late is judged before anything else, on rows that are admitted or not. The progress comes last:
    an epoch that is repeated has the border it had before and replaces all three.
    """
    spark, name = bronze.sparkSession, f"{query}-{epoch}"
    marked = split_late(bronze.select(*BRONZE.names), latest_before(spark, layout, query, epoch),
                        lateness).persist()
    try:
        overwrite_batch(marked.where("late").drop("late"), layout.late, name, layout.fmt)
        punctual = marked.where("not late").drop("late")
        known = silver_table(spark, layout).where(F.col("landed_in") != name)
        fresh = without_known(first_per_key(admit(punctual)), known, admit(punctual),
                              punctual.count())
        landing = Landing(spark, layout)
        landing.replace_batch(silver_at_rest(
            score(with_clean_text(gather(with_event_date(fresh))), scorer, terms), name), name)
        landing.finish()
        progress = marked.agg(
            F.lit(query).alias("query"), F.lit(epoch).cast("long").alias("epoch"),
            F.count("*").alias("rows"), F.count_if("late").alias("late"),
            F.max(_when()).alias("latest"))
        overwrite_batch(progress, layout.progress, name, layout.fmt)
    finally:
        marked.unpersist()


def progress(spark: SparkSession, layout: TableLayout) -> DataFrame:
    """Rows, late rows and latest time of each epoch."""
    return read_table(spark, layout.progress, PROGRESS, layout.fmt).drop("batch_id")


def late_table(spark: SparkSession, layout: TableLayout) -> DataFrame:
    """Every row that came late, as Bronze had it."""
    return read_table(spark, layout.late, BRONZE, layout.fmt)
