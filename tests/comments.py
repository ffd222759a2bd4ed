"""Literal comment rows for the tests."""

from datetime import datetime, timedelta

T0 = datetime(2026, 4, 11, 9, 0, 0)
COLUMNS = ("event_time timestamp, collected_at timestamp, comment_id string, video_id string, "
           "author string, text string, like_count int, reply_count int, is_reply boolean, "
           "parent_comment_id string, lang string, source string")


def comment(comment_id, text="good video", **changes):
    row = {"event_time": T0, "collected_at": T0 + timedelta(seconds=2), "comment_id": comment_id,
           "video_id": "v1", "author": "ann", "text": text, "like_count": 1, "reply_count": 0,
           "is_reply": False, "parent_comment_id": None, "lang": "vi", "source": "files"}
    return tuple({**row, **changes}.values())


def frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)
