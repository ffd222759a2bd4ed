from datetime import timedelta

from comments import T0, comment, frame
from pyspark.sql import functions as F

from voxlake.operators.dedup import first_per_key, new_records_only


def hot_rows(spark, n=3000):
    """A third of all rows are copies of one key."""
    i = F.col("id")
    return spark.range(n).select(
        F.lit("v").alias("video_id"),
        F.when(i % 3 == 0, "hot").otherwise(i.cast("string")).alias("comment_id"),
        (i % 100).cast("int").alias("like_count"), F.lit("a").alias("author"))


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_earliest_row_wins(spark):
    rows = frame(spark, [
        comment("a", collected_at=T0 + timedelta(seconds=9), like_count=0), comment("a", like_count=7),
        comment("a", like_count=5), comment("a", video_id="v2")])
    found = first_per_key(rows).orderBy("video_id").collect()
    assert [(r.video_id, r.like_count) for r in found] == [("v1", 5), ("v2", 1)]


def test_hot_key_is_thinned_before_the_shuffle(spark):
    rows = first_per_key(hot_rows(spark))
    assert rows.count() == 2001
    plan = plan_of(rows)
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_new_records_only(spark):
    incoming = frame(spark, [comment("a"), comment("a"), comment("b"), comment(" "), comment(None),
                             comment(" a "), comment("c")])
    landed = spark.createDataFrame([("b",), ("b ",), (None,)], "comment_id string")
    found = sorted(str(r.comment_id).strip() for r in new_records_only(incoming, landed).collect())
    assert found == ["", "None", "a", "c"]


def test_landed_keys_are_thinned_before_the_shuffle(spark):
    landed = hot_rows(spark).select("comment_id")
    fresh = new_records_only(hot_rows(spark, 6000), landed)
    # landed: hot and the numbers below 3000; fresh: the other numbers not divisible by three
    assert fresh.count() == 2000
