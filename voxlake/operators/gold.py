"""Daily metrics per video, and the same per sentiment.

Averages and ratios are one division of exact integer sums, rounded half up.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.fixed_values import SENTIMENTS
from voxlake.functions.cleaning import ratio
from voxlake.schemas import GOLD_BREAKDOWN, GOLD_SUMMARY

GRAIN = ("event_date", "video_id")


def with_event_date(silver: DataFrame) -> DataFrame:
    if "event_date" in silver.columns:
        return silver
    return silver.withColumn("event_date", F.to_date("event_time"))


def _mean(column: str) -> Column:
    # sum / count is what avg does, but sums integers exactly
    return F.round(F.sum(column) / F.count(column), 2)


def gold_summary(silver: DataFrame) -> DataFrame:
    """One row per event date and video.

    Distinct authors are counted on (date, video, author) groups first, so a video with most of
    the comments is spread over many tasks.
    """
    metrics = with_event_date(silver).groupBy(*GRAIN).agg(
        F.count("*").alias("total_comments"),
        F.count_if(~F.col("is_reply")).alias("top_level_comment_count"),
        F.count_if("is_reply").alias("reply_comment_count"),
        F.count_distinct("author").alias("unique_author_count"),
        F.sum("like_count").alias("total_likes"),
        _mean("like_count").alias("avg_likes_per_comment"),
        _mean("reply_count").alias("avg_reply_count"),
        _mean("text_length").alias("avg_text_length"),
        _mean("collected_delay_seconds").alias("avg_collected_delay_seconds"),
        *[F.count_if(F.col("sentiment") == s).alias(f"{s}_comment_count") for s in SENTIMENTS],
    )
    return _with_shares(metrics)


def _with_shares(metrics: DataFrame) -> DataFrame:
    total = F.col("total_comments")
    shares = {f"{s}_ratio": ratio(F.col(f"{s}_comment_count"), total, 4) for s in SENTIMENTS}
    return metrics.withColumns({
        **shares,
        "reply_ratio": ratio(F.col("reply_comment_count"), total, 4),
        "engagement_score": F.col("total_likes") + F.col("reply_comment_count"),
    }).select(*GOLD_SUMMARY.names)


def gold_breakdown(silver: DataFrame) -> DataFrame:
    """One row per event date, video and sentiment.

    The total of a (date, video) comes from its few breakdown rows, not from a second scan.
    """
    per_sentiment = with_event_date(silver).groupBy(*GRAIN, "sentiment").agg(
        F.count("*").alias("comment_count"),
        _mean("like_count").alias("avg_likes"),
        _mean("reply_count").alias("avg_replies"),
        F.count_if("is_reply").alias("reply_comment_count"),
        _mean("text_length").alias("avg_text_length"),
    )
    return _with_ratio(per_sentiment)


def _with_ratio(per_sentiment: DataFrame) -> DataFrame:
    total = F.sum("comment_count").over(Window.partitionBy(*GRAIN))
    return (per_sentiment.withColumn("comment_ratio", ratio(F.col("comment_count"), total, 4))
            .select(*GOLD_BREAKDOWN.names))


def gold_sums(silver: DataFrame) -> DataFrame:
    """What Gold adds up, by date, video and sentiment. Sums of pieces of Silver add up to the whole's."""
    measures = {"like_count": ("likes", "liked"), "reply_count": ("reply_sum", "reply_rows"),
                "text_length": ("length_sum", "length_rows"),
                "collected_delay_seconds": ("delay_sum", "delay_rows")}
    return with_event_date(silver).groupBy(*GRAIN, "sentiment").agg(
        F.count("*").alias("comments"), F.count_if("is_reply").alias("replies"),
        *[f(c).alias(name) for c, names in measures.items()
          for f, name in zip((F.sum, F.count), names, strict=True)])


def gold_authors(silver: DataFrame) -> DataFrame:
    """Who commented on a video on a date. Sets of pieces unite to the whole's."""
    return with_event_date(silver).select(*GRAIN, "author").distinct()


SKETCH_BITS = 12  # some 1.6 % standard error


def day_sketches(silver: DataFrame, by: Sequence[str] = ("event_date",)) -> DataFrame:
    """Sketches of the videos and authors of each date, which unite to those of any range of dates."""
    return with_event_date(silver).groupBy(*by).agg(
        F.hll_sketch_agg("video_id", SKETCH_BITS).alias("videos"),
        F.hll_sketch_agg("author", SKETCH_BITS).alias("authors"))


def distinct_estimates(sketches: DataFrame, period: str = "week") -> DataFrame:
    """About how many videos and authors each period has, from stored sketches alone."""
    return sketches.groupBy(F.trunc("event_date", period).alias("period")).agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"approx_{c}") for c in ("videos", "authors")])


def distinct_exact(authors: DataFrame, period: str = "week") -> DataFrame:
    """How many videos and authors each period has, from the sets of authors."""
    return authors.groupBy(F.trunc("event_date", period).alias("period")).agg(
        F.count_distinct("video_id").alias("videos"), F.count_distinct("author").alias("authors"))


def _mean_of(total: str, rows: str) -> Column:
    return F.round(F.sum(total) / F.sum(rows), 2)


def summary_of_parts(sums: DataFrame, authors: DataFrame) -> DataFrame:
    """`gold_summary` of the Silver whose pieces these sums and authors are of."""
    counted = authors.groupBy(*GRAIN).agg(F.count_distinct("author").alias("unique_author_count"))
    metrics = sums.groupBy(*GRAIN).agg(
        F.sum("comments").alias("total_comments"),
        (F.sum("comments") - F.sum("replies")).alias("top_level_comment_count"),
        F.sum("replies").alias("reply_comment_count"),
        F.sum("likes").alias("total_likes"),
        _mean_of("likes", "liked").alias("avg_likes_per_comment"),
        _mean_of("reply_sum", "reply_rows").alias("avg_reply_count"),
        _mean_of("length_sum", "length_rows").alias("avg_text_length"),
        _mean_of("delay_sum", "delay_rows").alias("avg_collected_delay_seconds"),
        *[F.coalesce(F.sum(F.when(F.col("sentiment") == s, F.col("comments"))), F.lit(0))
          .alias(f"{s}_comment_count") for s in SENTIMENTS])
    return _with_shares(metrics.join(counted, list(GRAIN)))


def breakdown_of_parts(sums: DataFrame) -> DataFrame:
    """`gold_breakdown` of the Silver whose pieces these sums are of."""
    return _with_ratio(sums.groupBy(*GRAIN, "sentiment").agg(
        F.sum("comments").alias("comment_count"),
        _mean_of("likes", "liked").alias("avg_likes"),
        _mean_of("reply_sum", "reply_rows").alias("avg_replies"),
        F.sum("replies").alias("reply_comment_count"),
        _mean_of("length_sum", "length_rows").alias("avg_text_length")))


def touched_dates(rows: DataFrame) -> DataFrame:
    """The event dates in a batch: at most one short row per calendar day."""
    return with_event_date(rows).select("event_date").distinct()


def rows_of_dates(silver: DataFrame, dates: DataFrame) -> DataFrame:
    """Silver rows of the given dates.

    The dates become a plain filter, so a date-partitioned table reads only those partitions.
    They are partitions of Silver, whose list the driver holds anyway to plan a read.
    """
    days = [row.event_date for row in dates.collect()]
    return with_event_date(silver).filter(F.col("event_date").isin(days))
