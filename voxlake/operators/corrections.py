"""Keyed corrections to a table that is rewritten, not updated in place."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.operators.dedup import first_per_key


def apply_corrections(rows: DataFrame, corrections: DataFrame, key: str = "comment_id",
                      column: str = "sentiment", order: list[Column] | None = None) -> DataFrame:
    """Replace `column` where a correction for the key exists.

    Several corrections for one key: the first by `order` wins (default: smallest value).
    Spark broadcasts the corrections only when their size allows it.
    """
    chosen = first_per_key(corrections, [key], order or [F.col(column)]).select(
        key, F.col(column).alias("_corrected"))
    return (rows.join(chosen, key, "left")
            .withColumn(column, F.coalesce("_corrected", column)).drop("_corrected")
            .select(*rows.columns))
