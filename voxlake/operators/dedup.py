"""First row per key, and rows not seen before.

The row_number filters below make Spark keep one row per key inside each input partition, before
the shuffle (WindowGroupLimit), so a key with very many copies costs one row per task, not one
huge group.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxlake.functions.cleaning import is_blank, strip

KEYS = ("video_id", "comment_id")
_PREFERENCE = ("ingested_at", "collected_at", "event_time", "like_count", "reply_count", "author")


def arrival_order(rows: DataFrame) -> list[Column]:
    """Earliest row first; further columns make the choice repeatable."""
    order = [F.col(c) for c in _PREFERENCE if c in rows.columns]
    # the cleaned text where there is one: a reader without texts then needs no other
    text = next((c for c in ("text_clean", "text") if c in rows.columns), None)
    return order + ([F.xxhash64(text)] if text else [])


def first_per_key(rows: DataFrame, keys: Sequence[str] = KEYS,
                  order: Sequence[Column] | None = None) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*(order or arrival_order(rows)))
    return (rows.withColumn("_rank", F.row_number().over(window))
            .filter("_rank = 1").drop("_rank"))


def new_records_only(incoming: DataFrame, landed: DataFrame, key: str = "comment_id",
                     order: Sequence[Column] | None = None) -> DataFrame:
    """Rows whose key has not landed yet, one per key; rows with a blank key always pass."""
    tidy = incoming.withColumn("_key", strip(F.coalesce(F.col(key), F.lit(""))))
    blank = is_blank(F.col("_key"))
    fresh = first_per_key(tidy.filter(~blank), ["_key"], order or arrival_order(incoming))
    known = landed.select(strip(F.col(key)).alias("_key")).distinct()
    return (fresh.join(known, "_key", "left_anti")
            .unionByName(tidy.filter(blank)).drop("_key"))


WORDS = 1 << 17  # of a sieve at most, 64 bits each: a megabyte, however many keys there are


def sieve_words(keys: int) -> int:
    """Words for about so many keys, some 16 bits for each, within bounds."""
    return min(WORDS, 1 << max(10, (max(keys, 1) // 4 - 1).bit_length()))


def key_hash(keys: Sequence[str] = KEYS) -> Column:
    return F.xxhash64(*keys)


def _bits(hashed: Column, words: int) -> list[Column]:
    """Two bits of a sieve for a hash."""
    size = F.lit(words * 64)
    return [F.pmod(hashed, size), F.pmod(F.shiftright(hashed, 32) * 31 + F.shiftright(hashed, 17), size)]


def key_sieve(rows: DataFrame, keys: Sequence[str] = KEYS, words: int = WORDS) -> DataFrame:
    """One row with the words of a Bloom filter of the keys in rows.

    Its size is fixed. More keys than it has bits for make it pass more, so what it passes still has to
    meet an exact join.
    """
    bit = F.explode(F.array(*_bits(key_hash(keys), words)))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))
    found = rows.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(mask).alias("mask"))
    every = rows.sparkSession.range(words).select(F.col("id").alias("word"))
    dense = every.join(found, "word", "left").select(
        F.struct("word", F.coalesce("mask", F.lit(0).cast("long")).alias("mask")).alias("w"))
    return dense.agg(F.transform(F.sort_array(F.collect_list("w")), lambda w: w["mask"]).alias("words"))


def may_hold(words: Column, keys: Sequence[str] = KEYS, size: int = WORDS) -> Column:
    """Whether a row's key may be one of those a sieve was made of; never false for one that is."""
    first, second = [
        F.call_function("getbit", F.get(words, F.shiftright(bit, 6).cast("int")),
                        (bit % 64).cast("int")) == 1 for bit in _bits(key_hash(keys), size)]
    return first & second


def sieved(rows: DataFrame, by: DataFrame, keys: Sequence[str] = KEYS, words: int = WORDS) -> DataFrame:
    """The rows whose key may be among those of `by`: a filter on the scan, before any shuffle.

    A lookup of few keys in a big table so shuffles about as many rows as it asks for.
    """
    return rows.where(may_hold(key_sieve(by, keys, words).scalar(), keys, words))
