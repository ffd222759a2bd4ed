"""Data-quality checks and layer reconciliation. Results are small tables, never asserts."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.operators.dedup import KEYS
from voxlake.operators.gold import GRAIN


def _union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def layer_counts(layers: Mapping[str, DataFrame]) -> DataFrame:
    """(layer, row_count) for every table given."""
    return _union(table.agg(F.lit(name).alias("layer"), F.count("*").alias("row_count"))
                  for name, table in layers.items())


def distinct_videos(layers: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, check_value): how many videos each table knows."""
    return _union(
        table.agg(F.lit(f"{name}_distinct_video_count").alias("check_name"),
                  F.count_distinct("video_id").alias("check_value"))
        for name, table in layers.items())


def null_checks(layers: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(check_name, check_value): null values in the named columns, one pass per table."""
    return _union(
        as_checks(table.agg(*[F.count_if(F.col(c).isNull()).alias(f"{name}_null_{c}")
                              for c in columns]))
        for name, (table, columns) in layers.items())


def as_checks(one_row: DataFrame) -> DataFrame:
    """Turn the columns of a one-row result into (check_name, check_value) rows."""
    return one_row.unpivot([], one_row.columns, "check_name", "check_value")


def duplicate_keys(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def duplicate_key_count(rows: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return duplicate_keys(rows, keys).agg(F.count("*").alias("duplicate_comment_rows"))


def silver_invariants(silver: DataFrame) -> DataFrame:
    """Rows that break a Silver rule, all rules in one pass."""
    return silver.agg(
        F.count_if(F.col("comment_id").isNull()).alias("null_comment_id_rows"),
        F.count_if(F.col("video_id").isNull()).alias("null_video_id_rows"),
        F.count_if(F.trim(F.coalesce("text_clean", F.lit(""))) == "").alias("empty_text_clean_rows"),
        F.count_if(F.col("is_reply") & F.col("parent_comment_id").isNull())
         .alias("invalid_reply_rows"),
        F.count_if(F.col("collected_delay_seconds") < 0).alias("negative_delay_rows"))


def gold_invariants(summary: DataFrame) -> DataFrame:
    """Summary rows whose parts do not add up."""
    def added(*names: str) -> Column:
        return reduce(Column.__add__, [F.col(n) for n in names])

    by_kind = added("top_level_comment_count", "reply_comment_count")
    by_sentiment = added("positive_comment_count", "neutral_comment_count", "negative_comment_count")
    ratios = added("positive_ratio", "neutral_ratio", "negative_ratio")
    total = F.col("total_comments")
    return summary.agg(
        F.count_if(total != by_kind).alias("invalid_comment_total_rows"),
        F.count_if(total != by_sentiment).alias("invalid_sentiment_total_rows"),
        F.count_if(F.abs(ratios - 1.0) > 0.01).alias("invalid_ratio_rows"))


def gold_reconcile(summary: DataFrame, breakdown: DataFrame) -> DataFrame:
    """Summary totals next to the totals of the breakdown."""
    totals = breakdown.groupBy(*GRAIN).agg(F.sum("comment_count").alias("breakdown_total"))
    return (summary.select(*GRAIN, "total_comments").join(totals, list(GRAIN), "left")
            .select(*GRAIN, "total_comments", "breakdown_total"))


def layer_flow_check(bronze: DataFrame, silver: DataFrame, summary: DataFrame,
                     breakdown: DataFrame) -> DataFrame:
    """Rows per Bronze video in every layer, null where a layer has none.

    The layers are stacked and counted in one aggregation instead of joined one by one.
    """
    layers = {"bronze_comments": bronze, "silver_comments": silver,
              "metric_rows": summary, "breakdown_rows": breakdown}
    stacked = _union(table.groupBy("video_id").agg(F.count("*").alias("n"))
                     .withColumn("layer", F.lit(name)) for name, table in layers.items())
    counted = stacked.groupBy("video_id").agg(
        *[F.sum(F.when(F.col("layer") == name, F.col("n"))).alias(name) for name in layers])
    return (counted.filter(F.col("bronze_comments").isNotNull())
            .orderBy(F.desc("bronze_comments"), "video_id"))


def sentiment_distribution(silver: DataFrame, per_video: bool = False) -> DataFrame:
    keys = ["video_id", "sentiment"] if per_video else ["sentiment"]
    counts = silver.groupBy(*keys).agg(F.count("*").alias("comment_count"))
    return counts.orderBy(*keys) if per_video else counts.orderBy(F.desc("comment_count"),
                                                                  "sentiment")


def silver_gold_agreement(silver: DataFrame, breakdown: DataFrame) -> DataFrame:
    """Comments per sentiment as Silver and as Gold counts them."""
    by_silver = silver.groupBy("sentiment").agg(F.count("*").alias("silver_count"))
    by_gold = breakdown.groupBy("sentiment").agg(F.sum("comment_count").alias("gold_count"))
    return by_silver.join(by_gold, "sentiment", "full").orderBy("sentiment")


def freshness(table: DataFrame, *columns: str) -> DataFrame:
    """Latest value of each time column."""
    return table.agg(*[F.max(c).alias(f"latest_{c}") for c in columns])
