"""Table contracts. One declaration per table; SQL DDL is generated from it."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType], nullable: bool = True) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind in fields])


_TS, _STR, _INT, _LONG, _DBL = (
    T.TimestampType(), T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType())

RECORD = _struct(
    ("event_time", _TS), ("collected_at", _TS), ("comment_id", _STR), ("video_id", _STR),
    ("author", _STR), ("text", _STR), ("like_count", _INT), ("reply_count", _INT),
    ("is_reply", T.BooleanType()), ("parent_comment_id", _STR), ("lang", _STR), ("source", _STR),
)

BRONZE = T.StructType(RECORD.fields + _struct(("ingested_at", _TS)).fields)

PREDICTION_FIELDS = _struct(
    ("positive_score", _INT), ("negative_score", _INT), ("sentiment", _STR))

# At rest Bronze carries its partition columns.
BRONZE_STORED = T.StructType(
    BRONZE.fields + _struct(("batch_id", _STR), ("ingested_date", T.DateType())).fields)

# Messages that could not be decoded, as they came.
QUARANTINE = _struct(("value", _STR), ("ingested_at", _TS), ("batch_id", _STR))

SILVER = T.StructType(
    BRONZE.fields
    + _struct(("text_clean", _STR), ("text_length", _INT),
              ("collected_delay_seconds", _LONG), ("silver_processed_at", _TS)).fields
    + PREDICTION_FIELDS.fields)

# At rest Silver also names its scorer and the batch or epoch that brought the row, and carries its
# partition columns. batch_id says in which piece a row lies: its own batch's, or a compacted one.
SILVER_STORED = T.StructType(
    SILVER.fields + _struct(("scorer", _STR), ("landed_in", _STR), ("batch_id", _STR),
                            ("event_date", T.DateType())).fields)

# What is behind the watermark, as Bronze had it.
LATE = T.StructType(BRONZE.fields + _struct(("batch_id", _STR)).fields)

# What Gold is made of: sums that add up over pieces, and sets of authors that unite.
GOLD_SUMS = _struct(
    ("event_date", T.DateType()), ("video_id", _STR), ("sentiment", _STR),
    ("comments", _LONG), ("replies", _LONG),
    ("likes", _LONG), ("liked", _LONG), ("reply_sum", _LONG), ("reply_rows", _LONG),
    ("length_sum", _LONG), ("length_rows", _LONG), ("delay_sum", _LONG), ("delay_rows", _LONG),
    ("batch_id", _STR))
GOLD_AUTHORS = _struct(
    ("event_date", T.DateType()), ("video_id", _STR), ("author", _STR), ("batch_id", _STR))

GOLD_SKETCHES = _struct(
    ("videos", T.BinaryType()), ("authors", T.BinaryType()), ("batch_id", _STR),
    ("event_date", T.DateType()))

# A batch: how much Bronze holds of it, a checksum of that, where it came from, and the dates to
# refresh until it is done.
BATCHES = _struct(
    ("rows", _LONG), ("content", _STR), ("files", T.ArrayType(_STR)),
    ("dates", T.ArrayType(T.DateType())), ("done", T.BooleanType()), ("batch_id", _STR))

# An epoch of the Silver stream: rows in, of these late, and the latest time seen.
PROGRESS = _struct(
    ("query", _STR), ("epoch", _LONG), ("rows", _LONG), ("late", _LONG), ("latest", _TS),
    ("batch_id", _STR))

GOLD_SUMMARY = _struct(
    ("event_date", T.DateType()), ("video_id", _STR),
    ("total_comments", _LONG), ("top_level_comment_count", _LONG),
    ("reply_comment_count", _LONG), ("unique_author_count", _LONG), ("total_likes", _LONG),
    ("avg_likes_per_comment", _DBL), ("avg_reply_count", _DBL), ("avg_text_length", _DBL),
    ("avg_collected_delay_seconds", _DBL),
    ("positive_comment_count", _LONG), ("neutral_comment_count", _LONG),
    ("negative_comment_count", _LONG),
    ("positive_ratio", _DBL), ("neutral_ratio", _DBL), ("negative_ratio", _DBL),
    ("reply_ratio", _DBL), ("engagement_score", _LONG),
)

GOLD_BREAKDOWN = _struct(
    ("event_date", T.DateType()), ("video_id", _STR), ("sentiment", _STR),
    ("comment_count", _LONG), ("comment_ratio", _DBL), ("avg_likes", _DBL),
    ("avg_replies", _DBL), ("reply_comment_count", _LONG), ("avg_text_length", _DBL),
)

LABELLED = _struct(
    ("idx", _STR), ("comment_id", _STR), ("video_id", _STR), ("text", _STR),
    ("manual_label", _STR), ("reviewer_notes", _STR))

EVALUATION_DETAIL = _struct(
    ("idx", _STR), ("comment_id", _STR), ("video_id", _STR), ("text", _STR),
    ("actual_label", _STR), ("review_bucket", _STR), ("notes", _STR),
    ("predicted_label", _STR), ("predicted_confidence", _STR), ("is_match", _STR))

_SNIPPET = _struct(
    ("publishedAt", _TS), ("videoId", _STR), ("authorDisplayName", _STR),
    ("textOriginal", _STR), ("textDisplay", _STR), ("likeCount", _INT), ("parentId", _STR))

# One page of the comment API: threads with their first replies nested inside.
API_PAGE = _struct(
    ("items", T.ArrayType(_struct(
        ("snippet", _struct(
            ("topLevelComment", _struct(("id", _STR), ("snippet", _SNIPPET))),
            ("totalReplyCount", _INT))),
        ("replies", _struct(
            ("comments", T.ArrayType(_struct(("id", _STR), ("snippet", _SNIPPET))))))))),
    ("nextPageToken", _STR))


def ddl_columns(schema: T.StructType) -> str:
    """Column list for CREATE TABLE."""
    return ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
