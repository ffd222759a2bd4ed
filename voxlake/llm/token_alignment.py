"""Two tokenizers' tokens aligned by bytes, composed from fragments.

A stretch of a document gives a fragment: the tokens up to and with the first byte at which tokens of
both end (open prefix: what comes before may belong to the same group), the groups between such bytes
(closed), and the tokens behind the last one (open suffix). Fragments of neighbouring stretches
compose to the fragment of both, and composition is associative, so a very long document is cut into
stretches, encoded by many tasks, and put together in a tree of small groups, level by level.

Pairs of ids are counted by documents over the whole corpus; the counts then come back to the
documents in parts of bounded size.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm import textops as X
from voxlake.llm.chunks import (
    Remembered, byte_level, chunk_array, chunk_edges, encoded, pieces, safe_cut)
from voxlake.llm.quality_classifier import texts_of
from voxlake.llm.storage import kept

STRETCH = 32_000  # characters of a stretch, about; a text without blanks is not cut
CACHED = 300_000  # distinct chunks a worker remembers, for each tokenizer
FAN = 8  # fragments that one step of the tree composes
SLICE = 2 << 20  # bytes of text worked on at a time
PART = 2_000_000  # id pairs whose counts are looked up in one pass
PAIRS = 1 << 20  # id pairs of a group looked at in one go
SMALL = 64  # links of a group that are listed as they are
TOKENS = 1 << 18  # tokens whose links are looked at in one go; a document is not cut
ID_BITS = 21  # of a token id


class Fragment(NamedTuple):
    """Ids in order, and how many of them each part has.

    sizes_a and sizes_b: tokens of the open prefix, of each closed group, of the open suffix.
    Without a common end there is one part, open at both sides.
    """

    a: np.ndarray
    b: np.ndarray
    sizes_a: np.ndarray
    sizes_b: np.ndarray


def fragment(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> Fragment:
    """From the ids of tokens that end in a range of bytes, and where they end."""
    common = np.intersect1d(ends_a, ends_b)
    parts = [np.diff(np.concatenate([[0], np.searchsorted(ends, common, "right"), [len(ends)]]))
             for ends in (ends_a, ends_b)]
    return Fragment(np.asarray(a), np.asarray(b), *parts)


def composed(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    def seam(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.concatenate([x[:-1], [x[-1] + y[0]], y[1:]])

    return Fragment(np.concatenate([left.a, right.a]), np.concatenate([left.b, right.b]),
                    seam(left.sizes_a, right.sizes_a), seam(left.sizes_b, right.sizes_b))


# --- stretches and their fragments --------------------------------------------------------------

def stretches(docs: DataFrame, size: int = STRETCH) -> DataFrame:
    """docs (id, text) as id, seq, n, text: texts cut in n where both tokenizers can start afresh.

    Texts of one stretch stay where they are. Those of the others are dealt out by id and seq, so
    that many tasks encode one long document.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for id, text in zip(batch.column("id"), batch.column("text"), strict=True):
                text, edges = text.as_py(), [0]
                while edges[-1] < len(text):
                    edges.append(safe_cut(text, edges[-1] + size))
                n = len(edges) - 1
                yield pa.RecordBatch.from_arrays([
                    pa.array([id.as_py()] * n, pa.int64()), pa.array(range(n), pa.int64()),
                    pa.array([n] * n, pa.int64()), pa.array([text[i:j] for i, j in zip(
                        edges[:-1], edges[1:], strict=True)], pa.string())],
                    ["id", "seq", "n", "text"])

    whole = F.coalesce(F.length("text"), F.lit(0)) <= size
    short = docs.where(whole).select(
        "id", F.lit(0).cast("long").alias("seq"), F.lit(1).cast("long").alias("n"), "text")
    long = docs.where(~whole).mapInArrow(work, "id long, seq long, n long, text string")
    return short.unionByName(long.repartition("id", "seq"))


@functools.lru_cache(maxsize=2)
def _encoders(a: bytes, b: bytes) -> tuple[list[tuple], list[pa.Array]]:
    """Of both tokenizers: (encoder, what chunks begin with, cut at letters), and each id's bytes."""
    first, second = byte_level(a, True), pieces(b)
    if max(len(t.token_bytes) for t in (first, second)) > 1 << ID_BITS:
        raise ValueError(f"more than {1 << ID_BITS} ids")
    return ([(Remembered(first.encode, CACHED), first.begin, bool(first.begin)),
             (Remembered(second.encode, CACHED), second.begin, False)],
            [pa.array(t.token_bytes, pa.large_binary()) for t in (first, second)])


_FRAGMENT = "id long, seq long, n long, valid boolean, tokens binary"


def packed(whole: Fragment) -> bytes:
    """A fragment as a table keeps it: much smaller than arrays, and so are the batches of it."""
    head = np.array([len(x) for x in whole], np.int32)
    return _packer().compress(np.concatenate([head, *whole]).astype("<i4").tobytes())


def unpacked(content: bytes) -> Fragment:
    flat = np.frombuffer(_unpacker().decompress(content), "<i4").astype(np.int64)
    return Fragment(*np.split(flat[4:], np.cumsum(flat[:3])))


@functools.cache
def _packer() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1)


@functools.cache
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def fragments(rows: DataFrame, a: bytes, b: bytes) -> DataFrame:
    """A fragment for each stretch (id, seq, text); valid tells that the tokens make up the text.

    The first stretch of a document has a space in front.
    """
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(a), context.broadcast(b)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, token_bytes = _encoders(shared[0].value, shared[1].value)
        for batch in batches:
            for part in X.slices(batch, SLICE):
                text = pc.fill_null(part.column("text"), "")
                first = pc.and_(pc.equal(part.column("seq"), 0), pc.not_equal(text, ""))
                data, offsets = X.packed(pc.binary_join_element_wise(
                    pc.if_else(first, " ", ""), text, ""))
                tokens = []
                for encoder, begin, letters in encoders:
                    edges = chunk_edges(data, offsets, begin, letters)
                    tokens.append(encoded(chunk_array(data, edges), np.searchsorted(edges, offsets),
                                          encoder))
                yield _fragments_of(part, data, offsets, token_bytes, tokens)

    return rows.mapInArrow(work, _FRAGMENT)


def _fragments_of(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray,
                  token_bytes: list[pa.Array], tokens: list[tuple[np.ndarray, np.ndarray]]
                  ) -> pa.RecordBatch:
    """`fragment` for all rows at once, whose tokens (ids, where each row's begin) are given."""
    size, valid, places = np.diff(offsets), np.diff(offsets) > 0, []
    for (ids, begin), known in zip(tokens, token_bytes, strict=True):
        joined, ends = X.packed_bytes(known.take(pa.array(ids)))
        row_ends = ends[begin]
        valid &= np.diff(row_ends) == size
        if len(joined) == len(data):
            wrong = np.flatnonzero(joined != data)
            valid[np.searchsorted(offsets, wrong, "right") - 1] = False
        else:  # some row has tokens of another length: then row by row
            for i in np.flatnonzero(valid):
                valid[i] = np.array_equal(joined[row_ends[i]:row_ends[i + 1]],
                                          data[offsets[i]:offsets[i + 1]])
        row = np.repeat(np.arange(len(size)), np.diff(begin))
        places.append(row << 40 | (ends[1:] - row_ends[row]))
    common = np.intersect1d(*places, assume_unique=True)
    # parts end behind a token at a common end, and with the row
    at = np.searchsorted(common >> 40, np.arange(len(size)), "right")
    first = np.concatenate([[0], at + np.arange(1, len(size) + 1)])
    sizes = []
    for (_, begin), place in zip(tokens, places, strict=True):
        bounds = np.insert(np.searchsorted(place, common, "right"), at, begin[1:])
        sizes.append(np.diff(bounds, prepend=0))
    out = []
    for i in range(len(size)):
        part = slice(first[i], first[i + 1])
        out.append(packed(Fragment(*[ids[begin[i]:begin[i + 1]] for ids, begin in tokens],
                                   *[s[part] for s in sizes])))
    return pa.RecordBatch.from_arrays(
        [*[rows.column(c) for c in ("id", "seq", "n")], pa.array(valid), pa.array(out, pa.binary())],
        ["id", "seq", "n", "valid", "tokens"])


def _step(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("seq")
    whole = functools.reduce(composed, map(unpacked, rows["tokens"]))
    return pd.DataFrame({"id": rows["id"].iloc[:1], "seq": rows["seq"].iloc[:1] // FAN,
                         "n": rows["n"].iloc[:1], "valid": [bool(rows["valid"].all())],
                         "tokens": [packed(whole)]})


def reduced(parts: DataFrame, most: int) -> DataFrame:
    """One fragment for each id, FAN neighbours at a time; `most` is how many an id has at most."""
    for _ in range(math.ceil(math.log(max(most, 1), FAN) - 1e-9)):
        parts = (parts.groupBy("id", F.expr(f"seq div {FAN}").alias("up"))
                 .applyInPandas(lambda rows: _step(rows), _FRAGMENT))
    return parts


def documents(docs: DataFrame, a: bytes, b: bytes, size: int = STRETCH) -> DataFrame:
    """The fragment of every document (id, text), from tables."""
    parts = kept(fragments(stretches(docs, size), a, b), "fragments")
    cut = parts.where("n > 1")
    most = cut.agg(F.max("n")).first()[0]
    if most is None:
        return parts
    return parts.where("n = 1").unionByName(kept(reduced(cut, most), "long-documents"))


# --- links, pair counts, results ----------------------------------------------------------------

class Aligned(NamedTuple):
    """The groups of some documents. Ids and group sizes are flat; rows tells each group's document."""

    a: np.ndarray
    b: np.ndarray
    sizes_a: np.ndarray
    sizes_b: np.ndarray
    rows: np.ndarray


def aligned(batch: pa.RecordBatch) -> Iterator[tuple[int, int, Aligned]]:
    """(first row, row behind the last, groups) of parts of a batch of whole documents.

    A document's prefix is a group of its own, as the document begins there.
    """
    first, held, tokens = 0, [], 0
    for row, content in enumerate(batch.column("tokens")):
        held.append(unpacked(content.as_py()))
        tokens += len(held[-1].a)
        if tokens >= TOKENS:
            yield first, row + 1, _together(held, first)
            first, held, tokens = row + 1, [], 0
    if held:
        yield first, len(batch), _together(held, first)


def _together(held: list[Fragment], first: int) -> Aligned:
    a, b, sizes_a, sizes_b = map(np.concatenate, zip(*held, strict=True))
    used = sizes_a > 0
    rows = np.repeat(np.arange(first, first + len(held)), [len(x.sizes_a) for x in held])
    return Aligned(a, b, sizes_a[used], sizes_b[used], rows[used])


def _products(a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray,
              n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, pair) of all pairs of the n and m entries that begin at first_a and first_b."""
    size = n * m
    group = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(group)) - np.repeat(np.cumsum(size) - size, size)
    return group, (a[first_a[group] + place // m[group]] << ID_BITS
                   | b[first_b[group] + place % m[group]])


def links(found: Aligned) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, pair, number of links), piece by piece; a pair is the ids' bits side by side.

    In a big group each id is taken once, with its number of occurrences: the group makes no more
    pairs than it has different ones, and those come in pieces too. A row and a pair may be in
    several pieces.
    """
    first_a = np.cumsum(found.sizes_a) - found.sizes_a
    first_b = np.cumsum(found.sizes_b) - found.sizes_b
    small = found.sizes_a * found.sizes_b <= SMALL
    group, pair = _products(found.a, found.b, first_a[small], first_b[small],
                            found.sizes_a[small], found.sizes_b[small])
    keys, times = np.unique(found.rows[small][group] << 2 * ID_BITS | pair, return_counts=True)
    yield keys >> 2 * ID_BITS, keys & (1 << 2 * ID_BITS) - 1, times
    for g in np.flatnonzero(~small):
        a, times_a = np.unique(found.a[first_a[g]:first_a[g] + found.sizes_a[g]], return_counts=True)
        b, times_b = np.unique(found.b[first_b[g]:first_b[g] + found.sizes_b[g]], return_counts=True)
        step = max(1, PAIRS // len(b))
        for i in range(0, len(a), step):
            pairs = (a[i:i + step, None] << ID_BITS | b).ravel()
            yield (np.full(len(pairs), found.rows[g]), pairs,
                   (times_a[i:i + step, None] * times_b).ravel())


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, count: in how many documents a pair is linked. Added up in the tasks first."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, found in aligned(batch):
                keys = [row << 2 * ID_BITS | pair for row, pair, _ in links(found)]
                keys = keys[0] if len(keys) == 1 else np.unique(np.concatenate(keys))
                pairs, times = np.unique(keys & (1 << 2 * ID_BITS) - 1, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs), pa.array(times.astype(np.int64))], ["pair", "count"])

    return (rows.where("valid").select("tokens").mapInArrow(work, "pair long, count long")
            .groupBy("pair").agg(F.sum("count").alias("count")))


def link_sums(rows: DataFrame, counts: DataFrame, part: int = PART) -> DataFrame:
    """id, n_best, count_sum of the valid rows.

    counts: pair, count, best. They reach the tasks in parts of about `part` pairs, whatever their
    number; each part is a pass over the rows, and what passes find is added up.
    """
    spark = rows.sparkSession
    total = counts.count()
    passes = max(1, math.ceil(total / part))
    valid = rows.where("valid").select("id", "tokens")
    sums = []
    for k in range(passes):
        mine = counts.where(F.pmod(F.xxhash64("pair"), F.lit(passes)) == k)
        table = mine.toArrow()
        pairs = table["pair"].to_numpy()
        order = np.argsort(pairs)
        shared = spark.sparkContext.broadcast(
            (pairs[order], table["count"].to_numpy()[order], table["best"].to_numpy()[order]))
        sums.append(valid.mapInArrow(_looked_up(shared), "id long, n_best long, count_sum long"))
    if passes == 1:
        return sums[0]
    return (functools.reduce(DataFrame.union, sums).groupBy("id")
            .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))


def _looked_up(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = shared.value
        for batch in batches:
            out = np.zeros((2, len(batch) + 1), np.int64)
            for _, _, found in aligned(batch):
                for row, pairs, times in links(found) if len(known) else ():
                    at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
                    times = np.where(known[at] == pairs, times, 0)
                    edges = np.searchsorted(row, np.arange(len(batch) + 1))
                    for k, values in enumerate((times * best[at], times * count[at])):
                        sums = np.concatenate([[0], np.cumsum(values)])[edges]
                        out[k, :-1] += np.diff(sums)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(out[0, :-1]), pa.array(out[1, :-1])],
                ["id", "n_best", "count_sum"])

    return work


def group_texts(found: Aligned, first: int, last: int) -> pa.Array:
    """a1,a2|b1;a3|b2,b3 of each row; '' of one without groups."""
    def joined(values: pa.Array, sizes: np.ndarray, sign: str) -> pa.Array:
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(ends, values), sign)

    sides = [joined(pa.array(ids).cast(pa.string()), sizes, ",")
             for ids, sizes in ((found.a, found.sizes_a), (found.b, found.sizes_b))]
    groups = np.diff(np.searchsorted(found.rows, np.arange(first, last + 1)))
    return joined(pc.binary_join_element_wise(*sides, "|"), groups, ";")


def _summaries(rows: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts = np.zeros((4, len(batch)), np.int64), []
            for first, last, found in aligned(batch):
                for k, values in enumerate((found.sizes_a, found.sizes_b, np.ones_like(found.rows),
                                            found.sizes_a * found.sizes_b)):
                    np.add.at(counts[k], found.rows, values)
                texts += [hashlib.sha256(t.as_buffer()).hexdigest()
                          for t in group_texts(found, first, last)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *map(pa.array, counts), pa.array(texts, pa.string())],
                ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])

    none = [F.lit(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
    return (rows.where("valid").select("id", "tokens").mapInArrow(
        work, "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string")
        .unionByName(rows.where("not valid").select("id", *none, F.lit("").alias("groups_sha256"))))


def alignment(docs: DataFrame, a: bytes, b: bytes, id: str = "doc_id", text: str = "text",
              stretch: int = STRETCH, part: int = PART) -> DataFrame:
    """One row per row of docs: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    a is the file of a byte-level tokenizer, which gets the text with a space in front, b the model
    of a piece tokenizer, which adds one itself. Strings of special tokens are ordinary text. Null and empty
    texts, and those whose tokens' bytes are not the text's, have no tokens and count for no pair.
    Ties for an id's highest count all count as best. Ids must be distinct integers; a row without
    one gives no row. Other columns are ignored.
    """
    rows = documents(texts_of(docs, id, text), a, b, stretch)
    counts = kept(pair_counts(rows), "pair-counts")
    top = counts.groupBy(F.shiftright("pair", ID_BITS).alias("a")).agg(F.max("count").alias("top"))
    judged = kept(counts.join(top, F.shiftright("pair", ID_BITS) == F.col("a")).select(
        "pair", "count", (F.col("count") == F.col("top")).alias("best")), "judged-pairs")
    return (_summaries(rows).join(link_sums(rows, judged, part), "id", "left")
            .select(F.col("id").alias(id), "n_a", "n_b", "n_groups", "n_links",
                    F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
