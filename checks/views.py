"""Comment views over the driver's tables, as documented in FIXTURES.md."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

START = 1704067200


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """C_doc: with negative likes, early or missing collection times, replies without parent."""
    n = F.col("doc_id")
    is_reply = n % 4 == 0
    return table(spark, sf, "documents").select(
        n.cast("string").alias("comment_id"),
        F.col("source").alias("video_id"),
        F.concat(F.lit("u"), (n % 97).cast("string")).alias("author"),
        "text",
        F.when(n % 11 == 0, -1).otherwise(F.col("n_chars") % 100).cast("int").alias("like_count"),
        (n % 5).cast("int").alias("reply_count"),
        is_reply.alias("is_reply"),
        F.when(is_reply & (n % 20 != 0), (n + 1).cast("string")).alias("parent_comment_id"),
        "lang", "source",
        F.timestamp_seconds(START + n * 600).alias("event_time"),
        F.when(n % 13 != 0, F.timestamp_seconds(START + n * 600 + n % 300 - 10))
         .alias("collected_at"))


def _number() -> Column:
    return F.col("comment_id").cast("long")


def sentiments(spark: SparkSession, sf: str) -> DataFrame:
    """C_sent: C_doc with keywords and links added, so that every sentiment occurs."""
    tail = (F.when(_number() % 6 == 0, " GREAT good awesome useful")
            .when(_number() % 6 == 1, " https://ex.am/p?q=1 bad")
            .when(_number() % 6 == 2, " www.ex.am  good").otherwise(""))
    return documents(spark, sf).withColumn("text", F.concat("text", tail))


def duplicated(spark: SparkSession, sf: str) -> DataFrame:
    """C_dup: C_sent plus later copies of every seventh row, with one more like."""
    rows = sentiments(spark, sf)
    copies = rows.filter(_number() % 7 == 0).withColumn("like_count", F.col("like_count") + 1)
    return rows.unionByName(copies)


def copied(spark: SparkSession, sf: str) -> DataFrame:
    """C_sent plus exact copies of every seventh row."""
    rows = sentiments(spark, sf)
    return rows.unionByName(rows.filter(_number() % 7 == 0))


def slangy(spark: SparkSession, sf: str) -> DataFrame:
    """C_sent with slang, stretched words and emoji added."""
    tail = (F.when(_number() % 8 == 0, " huge w bro, w w w!")
            .when(_number() % 8 == 1, " Niceeeee \U0001f525\U0001f525 sooo fire")
            .when(_number() % 8 == 2, " ain't no way... Éaaa loool_ xl l")
            .when(_number() % 8 == 3, " ❤️ ❤ goated goat justice for x").otherwise(""))
    return sentiments(spark, sf).withColumn("text", F.concat("text", tail))


def escaped(spark: SparkSession, sf: str) -> DataFrame:
    """C_doc with literal escapes added."""
    tail = (F.when(_number() % 3 == 0, F.lit(r" \u00e9t\u00E9 \U0001f60a"))
            .when(_number() % 3 == 1, F.lit(r" \U00110000 \u12 C:\users")).otherwise(F.lit("")))
    return documents(spark, sf).withColumn("text", F.concat("text", tail))


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    """C_conv: one video per conversation, every later turn a reply to the first."""
    first = F.concat(F.col("conv_id").cast("string"), F.lit(":0"))
    is_reply = F.col("turn") > 0
    return table(spark, sf, "conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("comment_id"),
        F.col("conv_id").cast("string").alias("video_id"),
        F.col("role").alias("author"), "text",
        is_reply.alias("is_reply"), F.when(is_reply, first).alias("parent_comment_id"))


def events(spark: SparkSession, sf: str) -> DataFrame:
    """C_event: one video per event type."""
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("comment_id"),
        F.col("event_type").alias("video_id"),
        F.col("user_id").cast("string").alias("author"),
        F.floor("value").cast("int").alias("like_count"),
        F.col("ts").cast("timestamp").alias("event_time"))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Evaluation input: labels joined to C_sent. It tests arithmetic, not sentiment."""
    label = F.when(F.col("toxic") == 1, "neg").when(F.col("quality") == 1, "LABEL_2").otherwise(
        "3 stars")
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("comment_id"), label.alias("manual_label"))
    rows = sentiments(spark, sf).select("comment_id", "video_id", "text", "lang")
    return labels.join(rows, "comment_id").select(
        F.col("comment_id").alias("idx"), "comment_id", "video_id", "text", "manual_label",
        F.concat(F.lit("note "), "lang").alias("reviewer_notes"), "lang")


def flawed(spark: SparkSession, sf: str) -> DataFrame:
    """C_doc with blank authors, parents on non-replies and missing sources."""
    n = _number()
    return documents(spark, sf).withColumns({
        "author": F.when(n % 17 == 0, "").otherwise(F.col("author")),
        "parent_comment_id": F.when(n % 19 == 0, "1").otherwise(F.col("parent_comment_id")),
        "source": F.when(n % 23 != 0, F.col("source"))})


def corrections(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
    return table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("comment_id"),
        label.otherwise("neutral").alias("sentiment"))


def raw_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The labels in several spellings: toxic negative, else by quality; by length of the text."""
    spellings = {"positive": ["POS", "5 stars", "2"], "neutral": ["Neutral", "3 stars", "1"],
                 "negative": [" neg ", "1 star", "LABEL_0"]}
    meaning = (F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive")
               .otherwise("neutral"))
    label = F.lit(None).cast("string")
    for sentiment, choice in spellings.items():
        spelled = F.element_at(F.array(*[F.lit(s) for s in choice]),
                               (F.col("n_chars") % len(choice) + 1).cast("int"))
        label = F.when(meaning == sentiment, spelled).otherwise(label)
    return (table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
            .select("doc_id", label.alias("label")))
