"""Analyst reports. A limit here is the report itself; every order ends in a key."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, n: int, by: str, columns: Sequence[str],
           tie_break: Sequence[str] = ("video_id", "comment_id")) -> DataFrame:
    """The newest n rows."""
    return rows.orderBy(F.desc(by), *tie_break).limit(n).select(*columns)


def sentiment_share(silver: DataFrame) -> DataFrame:
    """Count and percentage per sentiment; the window sees only the finished counts."""
    counts = silver.groupBy("sentiment").agg(F.count("*").alias("count"))
    everything = Window.partitionBy(F.lit(1))
    return counts.withColumn(
        "percentage", F.round(F.col("count") * 100 / F.sum("count").over(everything), 2))


def negative_sample(silver: DataFrame, n: int = 10) -> DataFrame:
    return (silver.filter(F.col("sentiment") == "negative")
            .orderBy("video_id", "comment_id").limit(n).select("author", "text_clean"))


def top_positive_authors(silver: DataFrame, n: int = 5) -> DataFrame:
    return (silver.filter(F.col("sentiment") == "positive")
            .groupBy("author").agg(F.count("*").alias("positive_count"))
            .orderBy(F.desc("positive_count"), "author").limit(n))


def comments_per_video(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("video_id").agg(F.count("*").alias("comment_count"))
            .orderBy(F.desc("comment_count"), "video_id"))


def reply_split(rows: DataFrame) -> DataFrame:
    return rows.groupBy("is_reply").agg(F.count("*").alias("row_count"))


def hourly_volume(rows: DataFrame, by: str = "ingested_at") -> DataFrame:
    return (rows.groupBy(F.hour(by).alias("hour")).agg(F.count("*").alias("count"))
            .orderBy("hour"))


def distinct_video_list(rows: DataFrame) -> DataFrame:
    return rows.select("video_id").distinct()


def kpi_report(summary: DataFrame) -> DataFrame:
    return summary.select(
        "event_date", "video_id", "total_comments", "positive_comment_count",
        "neutral_comment_count", "negative_comment_count", "positive_ratio", "neutral_ratio",
        "negative_ratio", "engagement_score").orderBy(F.desc("event_date"), "video_id")


def breakdown_report(breakdown: DataFrame) -> DataFrame:
    return breakdown.select(
        "event_date", "video_id", "sentiment", "comment_count", "comment_ratio", "avg_likes",
        "avg_replies").orderBy(F.desc("event_date"), "sentiment", "video_id")


def largest_breakdowns(breakdown: DataFrame) -> DataFrame:
    return breakdown.select("video_id", "sentiment", "comment_count").orderBy(
        F.desc("comment_count"), "video_id", "sentiment")


def replies_per_day(rows: DataFrame, by: str = "event_time") -> DataFrame:
    """Comments and, of these, replies for each day."""
    return rows.groupBy(F.to_date(by).alias("event_date")).agg(
        F.count("*").alias("comment_count"), F.count_if("is_reply").alias("reply_count"))


def top_liked_comments(rows: DataFrame, k: int = 3, by: Sequence[str] = ("video_id",),
                       tie_break: Sequence[str] = ("event_time", "comment_id"),
                       keep_ties: bool = False) -> DataFrame:
    """The k comments with most likes of each group, with their rank.

    Among equal likes the first by `tie_break` comes first; with `keep_ties` all that equal the k-th
    stay and share a rank. Spark limits each task to the k best of a group before the shuffle, so a giant
    group costs k rows a task (with ties kept, those that tie too).
    """
    likes = F.desc_nulls_last("like_count")
    order = [likes] if keep_ties else [likes, *tie_break]
    rank = (F.rank() if keep_ties else F.row_number()).over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def sentiment_trend(rows: DataFrame, width: str = "1 day", by: str = "event_time") -> DataFrame:
    """Comments and their mean likes per window of time and sentiment.

    A batch counts all rows. Of a stream with a watermark a window comes out once, when the
    watermark has passed its end; rows later than that are dropped.
    """
    return (rows.groupBy(F.window(by, width).alias("w"), "sentiment")
            .agg(F.count("*").alias("comment_count"), F.sum("like_count").alias("likes"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "sentiment", "comment_count",
                    F.round(F.col("likes") / F.col("comment_count"), 2).alias("avg_likes")))
