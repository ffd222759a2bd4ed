"""Labelled rows: which may be learned from, and their texts."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm.bitmap import key_bitmap, passes


def fold(id: str, folds: int = 4) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return (F.crc32(F.col(id).cast("string").cast("binary")) % folds).cast("int")


def joined(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs (id, text) with the columns of labels; unlabelled texts are sieved before the shuffle."""
    wanted = key_bitmap(labels, "id")

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(wanted, batch.column("id").to_numpy())))

    return docs.mapInArrow(sieve, docs.schema).join(labels, "id")


def bounded(labels: DataFrame, docs: DataFrame, rows: int) -> DataFrame:
    """At most `rows` labels (id, ...) of docs, the same for the same tables: the first by hash.

    Labels without a document do not count towards the bound.
    """
    found = joined(docs.select("id"), labels.select("id"))
    return labels.join(found, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(rows)
