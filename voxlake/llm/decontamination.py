"""Benchmark passages in documents, by a prefix-filtered join of word shingles.

A window is a run of ten words of a benchmark item (or the whole of a shorter item). All its
shingles of three words must stand in a text that holds the window, so one of them is enough to
find the candidates: the one that is rarest in the corpus. The documents' shingles pass a bitmap of
fixed size that holds those prefixes, and only what passes is shuffled and joined. A candidate then
has to leave room for the window on both sides, and its words have to be the window's words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm import textops as X
from voxlake.llm.bitmap import key_bitmap, passes
from voxlake.llm.storage import kept

WINDOW = 10
SHINGLE = 3


def _hashed_words(data: np.ndarray, offsets: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = X.LOWER[data]
    starts, ends, owner = X.words(data, offsets, X.ALPHANUMERIC)
    return data, starts, ends, owner, X.span_hashes(X.prefix_sums(data), starts, ends)


def _spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    return [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)]


def item_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(item_id, words, shingles): each window of each item with its shingles in order."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts, ends, owner, hashes = _hashed_words(*X.packed(batch.column("text")))
            edges = np.searchsorted(owner, np.arange(len(batch) + 1))
            items, spelled, runs = [], [], []
            for item, a, b in zip(batch.column("item_id").to_pylist(), edges, edges[1:],
                                  strict=False):
                for i in range(a, max(a + 1, b - window + 1) if b > a else a):
                    last = min(b, i + window)
                    size = min(shingle, last - i)
                    items.append(item)
                    spelled.append(_spelled(data, starts[i:last], ends[i:last]))
                    runs.append(X.joined_hashes(hashes[i:last], size).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                pa.array(items, pa.int64()), pa.array(spelled, pa.list_(pa.string())),
                pa.array(runs, pa.list_(pa.int64()))], ["item_id", "words", "shingles"])

    return benchmark.mapInArrow(
        work, "item_id long, words array<string>, shingles array<long>")


def shingle_counts(docs: DataFrame, wanted: np.ndarray, sizes: list[int]) -> DataFrame:
    """(shingle, n): how often the wanted shingles, and some others, stand in the corpus."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = X.packed(batch.column("text"))
            found = []
            for a, b in X.pieces(offsets):
                *_, owner, hashes = _hashed_words(*X.cut(data, offsets, a, b))
                for size in sizes:
                    runs, *_ = X.shingles(hashes, owner, size, short=False)
                    found.append(runs[passes(wanted, runs)])
            runs, n = np.unique(np.concatenate(found or [np.zeros(0, np.uint64)]),
                                return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs.view(np.int64)), pa.array(n, pa.int64())], ["shingle", "n"])

    return (docs.select("text").mapInArrow(work, "shingle long, n long")
            .groupBy("shingle").agg(F.sum("n").alias("n")))


def prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(shingle, place, words) of each distinct window: the rarest shingle that it needs.

    A window with a shingle that the corpus does not have cannot occur, and gives no row.
    """
    return (windows.select("words", F.posexplode("shingles").alias("place", "shingle"))
            .join(counts, "shingle", "left")
            .groupBy("words")
            .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "place"))
                 .alias("rarest"))
            .where("rarest.n > 0")
            .select("rarest.shingle", F.col("rarest.place").alias("place"), "words"))


def prefix_matches(docs: DataFrame, wanted: np.ndarray, sizes: list[int], window: int = WINDOW
                   ) -> DataFrame:
    """(id, n_words, found): where wanted shingles stand, with the words that a window could take.

    found holds (shingle, first word, words before it in `near`, near).
    """
    entry = pa.struct([("shingle", pa.int64()), ("first", pa.int64()), ("before", pa.int32()),
                       ("near", pa.list_(pa.string()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, offsets = X.packed(batch.column("text"))
            for a, b in X.pieces(offsets):
                data, starts, ends, owner, hashes = _hashed_words(*X.cut(texts, offsets, a, b))
                edges = np.searchsorted(owner, np.arange(b - a + 1))
                found = [[] for _ in range(b - a)]
                for size in sizes:
                    runs, text, first = X.shingles(hashes, owner, size, short=False)
                    hit = np.flatnonzero(passes(wanted, runs))
                    for run, t, i in zip(runs[hit].view(np.int64).tolist(), text[hit].tolist(),
                                         first[hit].tolist(), strict=True):
                        low = max(edges[t], i + size - window)
                        high = min(edges[t + 1], i + window)
                        found[t].append((run, i - edges[t], i - low,
                                         _spelled(data, starts[low:high], ends[low:high])))
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a), pa.array(np.diff(edges), pa.int64()),
                    pa.array([[dict(zip(("shingle", "first", "before", "near"), x, strict=True))
                               for x in one] for one in found], pa.list_(entry))],
                    ["id", "n_words", "found"])

    return docs.mapInArrow(
        work, "id long, n_words long, "
              "found array<struct<shingle long, first long, before int, near array<string>>>")


def contamination(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE) -> DataFrame:
    """One row per row of docs: id, n_words, ranges, items.

    ranges are the word ranges [first, last) that windows cover, overlapping ones as they are,
    sorted; items the ids of the items with a window in the text, sorted. Both are empty for clean,
    null and blank texts, and everywhere if no item has words. Repeated items and windows count
    once each. Ids must be distinct integers; a row without one gives no row, an item without
    one takes no part. Other columns are ignored, so their names cannot clash.
    """
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where(
        "id is not null")
    benchmark = benchmark.select(F.col(item).cast("long").alias("item_id"),
                                 F.col(item_text).alias("text")).where("item_id is not null")
    windows = kept(item_windows(benchmark, window, shingle), "windows")
    needed = windows.select(F.explode("shingles").alias("shingle")).distinct()
    sizes = sorted(r.n for r in windows.select(  # shingle sizes in use, at most `shingle` of them
        F.least(F.size("words"), F.lit(shingle)).alias("n")).distinct().collect())
    counts = shingle_counts(docs, key_bitmap(needed, "shingle"), sizes)
    wanted = kept(prefixes(windows, counts), "prefixes")
    rows = kept(prefix_matches(docs, key_bitmap(wanted, "shingle"), sizes, window), "matches")

    start = F.col("before") - F.col("place")
    hits = (rows.select("id", "n_words", F.explode("found").alias("f")).select("id", "n_words", "f.*")
            .join(wanted, "shingle")
            .where((F.size("words") <= F.col("n_words")) & (start >= 0)
                   & (start + F.size("words") <= F.size("near")))
            .where(F.slice("near", start + 1, F.size("words")) == F.col("words"))
            .withColumn("from", F.col("first") - F.col("place"))
            .select("id", "words", F.struct(
                F.col("from").alias("first"),
                (F.col("from") + F.size("words")).alias("last")).alias("range")))
    hits = kept(hits, "hits")
    ranges = hits.groupBy("id").agg(F.sort_array(F.collect_set("range")).alias("ranges"))
    items = (hits.select("id", "words").distinct()
             .join(windows.select("words", "item_id").distinct(), "words")
             .groupBy("id").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    none = "array<struct<first:bigint,last:bigint>>"
    return (rows.select("id", "n_words").join(ranges, "id", "left").join(items, "id", "left")
            .select(F.col("id").alias(id), "n_words",
                    F.coalesce("ranges", F.array().cast(none)).alias("ranges"),
                    F.coalesce("items", F.array().cast("array<bigint>")).alias("items")))


def covered(ranges: str) -> Column:
    """Numbers in the union of sorted ranges [first, last)."""
    step = F.aggregate(
        ranges, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto")),
        lambda state, r: F.struct(
            (state["n"] + F.greatest(F.lit(0), r["last"] - F.greatest(r["first"], state["upto"])))
            .alias("n"),
            F.greatest(state["upto"], r["last"]).alias("upto")))
    return step["n"]
