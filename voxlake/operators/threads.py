"""Nested API pages -> flat comment records, in one pass over the pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.fixed_values import API_SOURCE
from voxlake.functions.cleaning import UNKNOWN, strip
from voxlake.functions.web import unescape_entities


def _text(snippet: Column) -> Column:
    original, display = snippet["textOriginal"], snippet["textDisplay"]
    return strip(F.coalesce(F.nullif(original, F.lit("")), display, F.lit("")))


def _record(comment: Column, reply_count: Column, is_reply: bool) -> Column:
    snippet = comment["snippet"]
    parent = snippet["parentId"] if is_reply else F.lit(None).cast("string")
    return F.struct(
        snippet["publishedAt"].alias("event_time"),
        comment["id"].alias("comment_id"),
        F.nullif(snippet["videoId"], F.lit("")).alias("video_id"),
        F.coalesce(snippet["authorDisplayName"], F.lit(UNKNOWN)).alias("author"),
        _text(snippet).alias("text"),
        F.coalesce(snippet["likeCount"], F.lit(0)).alias("like_count"),
        F.coalesce(reply_count, F.lit(0)).alias("reply_count"),
        F.lit(is_reply).alias("is_reply"),
        parent.alias("parent_comment_id"))


def flatten_threads(pages: DataFrame, collected_at: Column | None = None,
                    expected_video: str | None = None, source: str = API_SOURCE) -> DataFrame:
    """One record per top-level comment and per reply.

    Other columns of `pages` are not passed on. `collected_at` defaults to now.
    """
    collected = F.current_timestamp() if collected_at is None else collected_at

    def thread(item: Column) -> Column:
        top = _record(item["snippet"]["topLevelComment"], item["snippet"]["totalReplyCount"], False)
        replies = F.transform(
            item["replies"]["comments"], lambda reply: _record(reply, F.lit(0), True))
        return F.concat(F.array(top), F.coalesce(replies, F.array()))

    items = pages.select(collected.alias("collected_at"), F.explode("items").alias("item"))
    flat = (items.select("collected_at", F.explode(thread(F.col("item"))).alias("r"))
            .select("collected_at", "r.*"))
    return flat.select(
        "event_time", "collected_at", "comment_id",
        F.coalesce("video_id", F.lit(expected_video)).alias("video_id"),
        "author", unescape_entities(F.col("text")).alias("text"), "like_count", "reply_count",
        "is_reply", "parent_comment_id", F.lit(UNKNOWN).alias("lang"),
        F.lit(source).alias("source"))
