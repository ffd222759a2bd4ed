"""Exact top-k inner products, with vectors grouped by length.

A product is at most the product of the two lengths, so a bucket of short vectors can be left out
for a query whose k-th best product is already larger. In a bucket that stays, the query's threshold
divided by the lengths is a threshold on the cosine. Where it is high, vectors are discarded by a few
coordinates: a unit vector that is close enough to the query's can differ from it only so far in
each. Where it is low, only the length cuts. What is left is multiplied out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from voxlake.llm.storage import kept

NORM_BUCKETS = 16
BLOCK = 4096  # vectors of a bucket that one task handles at a time
QUERY_BLOCK = 1024
COORDINATES = 3
SWITCH = 0.6  # cosine threshold from which coordinates are looked at
EXACT = 2.0 ** 53


def integer_vectors(rows: DataFrame, id: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, v, dim, norm): floor(scale * x) of each component, as whole doubles.

    Null vectors, and vectors with a null or non-finite component, give no row; nor do rows
    without an id.
    """
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (rows.select(F.col(id).cast("long").alias("id"),
                        F.col(vector).cast("array<double>").alias("x"))
            .where(F.col("id").isNotNull() & F.col("x").isNotNull() & ~bad)
            .select("id", F.transform("x", lambda x: F.floor(x * scale).cast("double")).alias("v"))
            .withColumn("dim", F.size("v"))
            .withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))))


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles where they cannot be rounded, else in Python's numbers.

    A product beyond 64 bits counts as the largest, or smallest, that fits.
    """
    if len(q) and len(c) and np.linalg.norm(q, axis=1).max() * np.linalg.norm(c, axis=1).max() < EXACT:
        return (q @ c.T).astype(np.int64)
    whole = q.astype(object).astype(int).astype(object) @ c.astype(int).astype(object).T
    return np.clip(whole, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def _candidates(unit: np.ndarray, units: np.ndarray, threshold: float) -> np.ndarray:
    """Unit vectors that may reach the cosine, judged by the query's largest coordinates."""
    left = np.ones(len(units), bool)
    for f in np.argsort(-np.abs(unit))[:COORDINATES]:
        x = unit[f]
        reach = np.sqrt(max(0.0, 1 - threshold ** 2) * max(0.0, 1 - x ** 2)) + 1e-9
        left &= np.abs(units[:, f] - x * threshold) <= reach if abs(x) <= threshold else (
            units[:, f] >= x * threshold - reach) if x > 0 else (units[:, f] <= x * threshold + reach)
    return np.flatnonzero(left)


def best_of_block(q: pd.DataFrame, c: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's best k of one block: columns query_id, vec_id, score.

    A vector whose product cannot reach the query's threshold is left out, one that equals it
    stays: ties go by id.
    """
    c = c.sort_values(["norm", "id"], ascending=[False, True])
    ids, norms = c["id"].to_numpy(), c["norm"].to_numpy()
    vectors, queries = np.stack(c["v"].to_numpy()), np.stack(q["v"].to_numpy())
    units = vectors / np.maximum(norms, 1e-300)[:, None]
    everything = np.arange(len(ids))
    chosen, full = [], []
    for row, (length, least) in enumerate(zip(q["norm"], q["least"], strict=True)):
        cosine = least / (length * norms[0]) if length * norms[0] > 0 else -np.inf
        if not cosine > 0:  # no threshold yet, or one that any vector may reach
            chosen.append(everything)
            full.append(row)
        elif cosine >= SWITCH and cosine <= 1:
            chosen.append(_candidates(queries[row] / length, units, cosine))
        else:  # norms fall, so this is a prefix
            chosen.append(everything[:np.searchsorted(-norms * length, -least * (1 - 1e-12),
                                                      side="right")])
            full.append(row)
    products = dict(zip(full, _products(queries[full], vectors), strict=True)) if full else {}
    out = []
    for row, (query, own) in enumerate(zip(q["id"], chosen, strict=True)):
        own = own[ids[own] != query]
        scores = products[row][own] if row in products else (
            _products(queries[row:row + 1], vectors[own])[0] if len(own) else own)
        order = np.lexsort((ids[own], -scores))[:k]
        out.append(pd.DataFrame({"query_id": query, "vec_id": ids[own][order],
                                 "score": scores[order]}))
    return pd.concat(out).astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})


def _dealt(vectors: DataFrame, wanted: DataFrame) -> DataFrame:
    """The vectors of the wanted blocks, once for each part that wants them; no others move on.

    wanted is a stored table, so Spark knows its size and broadcasts it only if it is small.
    """
    return vectors.join(wanted, ["dim", "bucket", "block"])


def _blocks(queries: DataFrame, places: DataFrame, vectors: DataFrame, k: int, parts: int
            ) -> DataFrame:
    """Best k of each (query, block) in `places`; queries are dealt to `parts` groups."""
    item = ["dim", "bucket", "block", "part"]
    asked = queries.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts).cast("long"))).join(
        places, "id").select(*item, "id", "v", "norm", "least")
    dealt = _dealt(vectors, kept(asked.select(*item).distinct(), "wanted"))
    return asked.groupBy(*item).cogroup(dealt.select(*item, "id", "v", "norm").groupBy(*item)) \
        .applyInPandas(lambda q, c: best_of_block(q, c, k) if len(q) and len(c) else
                       pd.DataFrame({n: np.zeros(0, np.int64)
                                     for n in ("query_id", "vec_id", "score")}),
                       "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id",
          vector: str = "embedding", scale: int = 256, buckets: int = NORM_BUCKETS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is_query picks, its k best partners.

    Partners are all rows with another id, of as many components; score is the integer inner
    product of the components floor(scale * x). Fewer than k partners: all of them; ties go to
    the smaller id. Of a repeated query id one vector asks, the smallest by its components,
    fewer components first; as partners all of its vectors count, each with a row of its own. Vectors that are null or hold a null or non-finite component take no part.
    Every query meets every bucket that its threshold does not rule out, block by block.
    """
    rows = kept(integer_vectors(vectors.where(F.col(id).isNotNull()), id, vector, scale), "vectors")
    queries = rows.join(vectors.where(is_query).select(F.col(id).cast("long").alias("id"))
                        .distinct(), "id", "left_semi")
    first = queries.groupBy("id").agg(F.min(F.struct("dim", "v", "norm")).alias("first"))
    queries = kept(first.select("id", "first.*"), "queries")
    edges = rows.groupBy("dim").agg(F.percentile_approx(
        "norm", [i / buckets for i in range(1, buckets)], 1000).alias("edges"))
    placed = rows.join(edges, "dim").withColumn(
        "bucket", F.size(F.filter("edges", lambda e: e < F.col("norm")))).drop("edges")
    sizes = kept(placed.groupBy("dim", "bucket").agg(
        F.ceil(F.count("*") / BLOCK).alias("blocks"), F.max("norm").alias("longest")), "sizes")
    placed = kept(placed.join(sizes, ["dim", "bucket"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks"))).drop("blocks", "longest"), "placed")
    parts = max(1, -(-queries.count() // QUERY_BLOCK))

    first = sizes.groupBy("dim").agg(F.max("bucket").alias("bucket"))
    start = queries.join(first, "dim").select(
        "id", "bucket", F.lit(0).cast("long").alias("block"))
    seeds = kept(_blocks(queries.withColumn("least", F.lit(-np.inf)), start, placed, k, parts),
                 "seeds")
    least = seeds.groupBy(F.col("query_id").alias("id")).agg(
        F.when(F.count("*") >= k, F.min("score").cast("double")).alias("least"))
    asked = queries.join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(-np.inf)))
    places = (asked.join(sizes, "dim")
              .where(F.col("norm") * F.col("longest") * (1 + 1e-12) >= F.col("least"))
              .select("id", "bucket", F.explode(F.sequence(F.lit(0).cast("long"),
                                                           F.col("blocks") - 1)).alias("block")))
    found = _blocks(asked, places, placed, k, parts)
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id",
                                  "score")
