"""Bronze -> cleaned comments: the admission rules, then one narrow projection."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.functions.cleaning import (
    UNKNOWN, blank_to, delay_seconds, non_negative, normalize_text, not_before)


def clean_base(comments: DataFrame) -> DataFrame:
    """Every field cleaned, nothing dropped, the text not yet normalised."""
    is_reply = F.coalesce(F.col("is_reply"), F.lit(False))
    collected = not_before(F.col("collected_at"), F.col("event_time"))
    passed_on = [c for c in comments.columns if c not in _CLEANED]
    return comments.select(
        "event_time",
        collected.alias("collected_at"),
        blank_to(F.col("comment_id")).alias("comment_id"),
        blank_to(F.col("video_id")).alias("video_id"),
        blank_to(F.col("author"), UNKNOWN).alias("author"),
        blank_to(F.col("text")).alias("text"),
        non_negative(F.col("like_count")).alias("like_count"),
        non_negative(F.col("reply_count")).alias("reply_count"),
        is_reply.alias("is_reply"),
        F.when(is_reply, blank_to(F.col("parent_comment_id"))).alias("parent_comment_id"),
        F.lower(blank_to(F.col("lang"), UNKNOWN)).alias("lang"),
        F.lower(blank_to(F.col("source"), UNKNOWN)).alias("source"),
        *passed_on,
        delay_seconds(collected, F.col("event_time")).alias("collected_delay_seconds"))


def with_clean_text(cleaned: DataFrame) -> DataFrame:
    """Add text_clean and text_length. Best after the shuffles: one text travels, not two."""
    return (cleaned.withColumn("text_clean", normalize_text(F.col("text")))
            .withColumn("text_length", F.length("text_clean")))


def clean_fields(comments: DataFrame) -> DataFrame:
    """Every field cleaned, derived columns added, nothing dropped."""
    return with_clean_text(clean_base(comments))


_CLEANED = frozenset((
    "event_time", "collected_at", "comment_id", "video_id", "author", "text", "like_count",
    "reply_count", "is_reply", "parent_comment_id", "lang", "source"))


_LINKS_AND_BLANKS = r"^\s*+(?:(?i:https?://|www\.)\S++\s*+)*+\z"


def admitted() -> Column:
    """Whether Silver accepts a raw row: keys, time and text present, replies with a parent.

    The test needs no cleaned text. Spark moves it below the cleaning, down to the scan, and
    would otherwise clean every text twice.
    """
    filled = [F.col(c).rlike(r"\S") for c in ("comment_id", "video_id", "text")]
    with_parent = F.col("parent_comment_id").rlike(r"\S")
    return (F.col("event_time").isNotNull() & filled[0] & filled[1] & filled[2]
            & ~F.col("text").rlike(_LINKS_AND_BLANKS)
            & (~F.coalesce("is_reply", F.lit(False)) | with_parent))


def admit(comments: DataFrame) -> DataFrame:
    """Admitted rows, cleaned but for the text."""
    return clean_base(comments.filter(admitted()))


def clean_comments(comments: DataFrame) -> DataFrame:
    return with_clean_text(admit(comments))
