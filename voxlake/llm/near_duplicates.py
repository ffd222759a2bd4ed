"""Near duplicates: banded MinHash candidates, odd sketches to sift them, full sets to decide.

A document is the set of its runs of five words. Its MinHash samples are used twice: cut into bands
they find candidates, and folded into a parity bitmap, the odd sketch, they tell how alike two
candidates are: the population count of two sketches' XOR grows with the samples that differ. A second
odd sketch is folded from the set itself: its XOR counts no more bits than the sets differ in members,
which rules out small sets that are not quite alike. Pairs whose sketches agree well enough are
compared on their full sets.

Documents with equal sets are one class from the start. In every bucket the classes are first
compared with one pivot, the class that shares most with the others. Buckets that are then still not
connected are drawn together by their pivots to clusters, in which classes of different components
are compared pair by pair, in blocks of bounded size; a join gives only the pairs that are links. So
a group of copies costs rows in proportion to its size, and no link between different texts is
passed over for the size of its bucket.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.llm import textops as X
from voxlake.llm.bitmap import key_bitmap, passes
from voxlake.llm.graph import components
from voxlake.llm.storage import kept

WORDS = 5
SIMILARITY = 80  # in hundredths; for stages on word shingles
MISS_RISK = 2.5e-7  # that a pair at the similarity shares no band
SAMPLES = 130  # at most, where bands of one row do not need more
SKETCH_WORDS = 8  # of 64 bits
BLOCK = 256  # classes of a cluster that are compared pair by pair in one go


def banding(similarity: int = SIMILARITY, risk: float = MISS_RISK) -> tuple[int, int]:
    """(bands, rows) at which a pair at the similarity shares no band but for the risk.

    The more rows, the fewer unlike pairs meet: as many as SAMPLES allow.
    """
    def needed(rows: int) -> int:
        agree = (similarity / 100) ** rows
        return 1 if agree >= 1 else math.ceil(math.log(risk) / math.log1p(-agree))

    rows = 1
    while (rows + 1) * needed(rows + 1) <= SAMPLES:
        rows += 1
    return needed(rows), rows


BANDS, ROWS = banding()


def differing_bits(similarity: int = SIMILARITY, samples: int = BANDS * ROWS,
                   risk: float = 1e-6) -> int:
    """Most bits in which the sketches of a pair at the similarity differ, but for the risk.

    Each sample that differs puts two entries into the sketches' difference, so the XOR counts at
    most twice the samples that differ, a binomial number.
    """
    p, tail = 1 - similarity / 100, 0.0
    for d in range(samples, -1, -1):
        tail += math.comb(samples, d) * p ** d * (1 - p) ** (samples - d)
        if tail > risk:
            return 2 * d
    return 0


def estimated_similarity(bits: int, samples: int = BANDS * ROWS,
                         size: int = SKETCH_WORDS * 64) -> float:
    """Similarity that an XOR count speaks for; 0 where the sketches are saturated."""
    left = 1 - 2 * bits / size
    return max(0.0, 1 + size / (4 * samples) * math.log(left)) if left > 0 else 0.0


def _families(samples: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = X.mixed(np.arange(1, 2 * samples + 1, dtype=np.uint64)) >> np.uint64(32)
    return (seeds[:samples] | np.uint64(1)).astype(np.uint32), seeds[samples:].astype(np.uint32)


def sets_of(data: np.ndarray, offsets: np.ndarray, n: int = WORDS
            ) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingles text after text, where each text's begin)."""
    data = X.LOWER[data]
    starts, ends, owner = X.words(data, offsets, X.UNSPACED)
    hashes = X.span_hashes(X.prefix_sums(data), starts, ends)
    runs, owner, _ = X.shingles(hashes, owner, n)
    return X.distinct_per_text(runs, owner, len(offsets) - 1)


def samples_of(sets: np.ndarray, places: np.ndarray, samples: int) -> np.ndarray:
    """MinHash samples, one row for each text that has shingles."""
    begins = places[:-1][np.diff(places) > 0]
    short = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(begins), samples), np.uint32)
    if len(begins):
        for i, (a, b) in enumerate(zip(*_families(samples), strict=True)):
            out[:, i] = np.minimum.reduceat(short * a + b, begins)
    return out


def band_keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each text and band."""
    keys = np.repeat(X.mixed(np.arange(1, bands + 1, dtype=np.uint64))[None], len(samples), 0)
    for r in range(rows):
        keys = X.mixed(keys ^ samples[:, r::rows].astype(np.uint64)) + np.uint64(r)
    return keys


def odd_sketches(samples: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Parity bitmaps: each (position, sample) flips one bit."""
    size = np.uint64(words * 64)
    position = X.mixed(np.arange(samples.shape[1], dtype=np.uint64) << np.uint64(32)
                       | samples.astype(np.uint64)) % size
    out = np.zeros((len(samples), words), np.uint64)
    row = np.repeat(np.arange(len(samples)), samples.shape[1])
    flat = position.ravel()
    np.bitwise_xor.at(out, (row, flat >> np.uint64(6)), np.uint64(1) << (flat & np.uint64(63)))
    return out


def set_sketches(sets: np.ndarray, places: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Parity bitmaps of the sets that are not empty: each member flips one bit."""
    sizes = np.diff(places)
    sizes = sizes[sizes > 0]
    at = (X.mixed(sets ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(words * 64)).astype(np.int64)
    at += np.repeat(np.arange(len(sizes)), sizes) * (words * 64)
    odd = (np.bincount(at, minlength=len(sizes) * words * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64).reshape(len(sizes), words)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    width = values.shape[1]
    flat = pa.array(np.ascontiguousarray(values).reshape(-1).view(np.int64), pa.int64())
    return pa.ListArray.from_arrays(
        pa.array(np.arange(len(values) + 1, dtype=np.int32) * width), flat).cast(kind)


def signatures(docs: DataFrame, n: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, set_a, set_b, bands, sketch); no bands nor sketch for an empty set.

    set_a and set_b name the set: equal sets have equal names.
    """
    longs = pa.list_(pa.int64())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = X.packed(batch.column("text"))
            for a, b in X.pieces(offsets):
                sets, places = sets_of(*X.cut(data, offsets, a, b), n)
                sizes = np.diff(places)
                full = np.flatnonzero(sizes)
                samples = samples_of(sets, places, bands * rows)
                names = np.zeros((2, b - a), np.uint64)
                if len(full):
                    names[0, full] = np.add.reduceat(X.mixed(sets), places[full])
                    names[1, full] = np.bitwise_xor.reduceat(
                        X.mixed(sets ^ np.uint64(0x5851F42D4C957F2D)), places[full])
                back = np.full(b - a, -1)
                back[full] = np.arange(len(full))
                pick = pa.array(back, mask=back < 0)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a), pa.array(sizes, pa.int64()),
                    pa.array(names[0].view(np.int64)), pa.array(names[1].view(np.int64)),
                    _lists(band_keys(samples, bands, rows), longs).take(pick),
                    _lists(np.hstack([odd_sketches(samples), set_sketches(sets, places)]), longs)
                    .take(pick)],
                    ["id", "n_shingles", "set_a", "set_b", "bands", "sketch"])

    return docs.mapInArrow(work, "id long, n_shingles long, set_a long, set_b long, "
                                 "bands array<long>, sketch array<long>")


def full_sets(docs: DataFrame, wanted: np.ndarray, n: int = WORDS) -> DataFrame:
    """(id, shingles) of the documents that the bitmap of ids lets through."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(wanted, batch.column("id").to_numpy())))
            data, offsets = X.packed(batch.column("text"))
            for a, b in X.pieces(offsets):
                sets, places = sets_of(*X.cut(data, offsets, a, b), n)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(a, b - a),
                    pa.ListArray.from_arrays(pa.array(places, pa.int32()),
                                             pa.array(sets.view(np.int64)))], ["id", "shingles"])

    return docs.mapInArrow(work, "id long, shingles array<long>")


def _close(left: str, right: str, most: int, similarity: int) -> Column:
    """Whether two rows' sizes and sketches, in columns s0 to s15, let them be so similar.

    Of the samples' sketches, `most` bits may differ; of the sets', as many as members may.
    """
    def differ(first: int) -> Column:
        bits = [F.bit_count(F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}")))
                for i in range(first, first + SKETCH_WORDS)]
        return functools.reduce(Column.__add__, bits)

    a, b = F.col(f"{left}.n_shingles"), F.col(f"{right}.n_shingles")
    return ((F.least(a, b) * 100 >= F.greatest(a, b) * similarity)
            & (differ(SKETCH_WORDS) * (100 + similarity) <= (a + b) * (100 - similarity))
            & (differ(0) <= most))


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity.

    b's set travels with its pair, a's meets it at the end: a pivot's set is not copied for each
    of its many partners before the last shuffle.
    """
    def side(name: str) -> DataFrame:
        return sets.select(F.col("id").alias(name), F.col("shingles").alias(f"set_{name}"))

    return (pairs.join(side("b"), "b").join(side("a"), "a")
            .where(_alike("set_a", "set_b", similarity)).select("a", "b"))


def _alike(a: str, b: str, similarity: int) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common * 100 >= (F.size(a) + F.size(b) - common) * similarity


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text",
                    similarity: int = SIMILARITY) -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, kept.

    component_id is the smallest id reachable over links of at least `similarity` hundredths;
    kept says that it is the row's own. Links are decided on the full sets of the shingles' 64-bit
    hashes. Null and blank texts have no shingles and no links. Ids
    must be distinct integers; a row without an id takes no part and gives no row. Other columns
    of docs are ignored, so their names cannot clash.
    """
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).where(
        "id is not null")
    bands, band_rows = banding(similarity)
    rows = kept(signatures(docs, bands=bands, rows=band_rows), "signatures")
    name = ["n_shingles", "set_a", "set_b"]
    firsts = rows.where("n_shingles > 0").groupBy(*name).agg(F.min("id").alias("class"))
    own = F.col("id") == F.col("class")
    members = kept(rows.join(firsts, name, "left").select(
        "id", "n_shingles", F.coalesce("class", "id").alias("class"),
        F.when(own, F.col("bands")).alias("bands"),
        *[F.when(own, F.col("sketch")[i]).alias(f"s{i}") for i in range(2 * SKETCH_WORDS)]),
        "members")
    classes = members.where("bands is not null").drop("class")

    banded = classes.select("id", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    buckets = kept(banded.join(shared, "bucket"), "buckets")
    sets = kept(full_sets(docs, key_bitmap(buckets.select("id").distinct(), "id")).join(
        buckets.select("id").distinct(), "id", "left_semi"), "sets")
    sketches = classes.drop("bands")
    most = differing_bits(similarity, bands * band_rows)

    central = buckets.groupBy("id").agg(F.sum("size").alias("rank"))
    pivots = (buckets.join(central, "id").groupBy("bucket")
              .agg(F.max_by("id", F.struct("rank", -F.col("id"))).alias("a")))
    buckets = kept(buckets.join(pivots, "bucket"), "pivots")
    stars = buckets.where("id <> a").select("a", F.col("id").alias("b")).distinct()
    likely = (stars.join(sketches.alias("x"), F.col("a") == F.col("x.id"))
              .join(sketches.alias("y"), F.col("b") == F.col("y.id"))
              .where(_close("x", "y", most, similarity))
              .select("a", "b"))
    links = kept(confirmed(likely, sets, similarity), "star-links")
    roots = components(links)

    rest = _unconnected(buckets.where("size > 2"), roots, sketches, sets)
    late = kept(rest.alias("x").join(rest.alias("y"), ["cluster", "low", "high"]).where(
        F.when(F.col("low") == F.col("high"), F.col("x.id") < F.col("y.id"))
        .otherwise((F.col("x.block") == F.col("low")) & (F.col("y.block") == F.col("high")))
        & (F.col("x.root") != F.col("y.root"))
        & _close("x", "y", most, similarity)
        & _alike("x.shingles", "y.shingles", similarity))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")), "late-links")
    roots = roots if late.isEmpty() else components(links.union(late))
    return (members.join(roots.select(F.col("node").alias("class"), "root"), "class", "left")
            .select(F.col("id").alias(id), "n_shingles",
                    F.coalesce("root", "class").alias("component_id"))
            .withColumn("kept", F.col("component_id") == F.col(id)))


def _unconnected(buckets: DataFrame, roots: DataFrame, sketches: DataFrame, sets: DataFrame
                 ) -> DataFrame:
    """Classes in buckets with several components, once for each pair of blocks they are in.

    Buckets with the same pivot are one cluster, so two classes meet in a few places at most.
    """
    labelled = (buckets.join(roots, buckets["id"] == roots["node"], "left")
                .select("bucket", "id", "a", F.coalesce("root", "id").alias("root")))
    open_ = (labelled.groupBy("bucket").agg(F.min("root").alias("r"), F.max("root").alias("s"))
             .where("r <> s").select("bucket"))
    touching = kept(labelled.join(open_, "bucket").select(
        F.col("a").alias("cluster"), "id", "root").distinct(), "open")
    blocks = F.ceil(F.col("size") / BLOCK)
    sized = touching.groupBy("cluster").agg(F.count("*").alias("size"))
    placed = (touching.join(sized, "cluster")
              .withColumn("block", F.pmod(F.xxhash64("id"), blocks))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))))
    return kept(placed.select(
        "cluster", "id", "root", "block", F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high")).join(sketches, "id").join(sets, "id"),
        "unconnected")
