"""Repeated passages of 100 bytes, by a column-wise Burrows-Wheeler construction.

**Anchors.** Each window of 100 bytes has an anchor, the substring of 32 bytes whose hash is smallest
(the leftmost of equals). Equal windows have equal anchors at equal places, so they can be told apart
family by family. Successive windows with the same anchor are one string. Strings that are equal are
one class, whose earliest occurrence stands for all: every other occurrence is repeated throughout.
Classes that are alone in their family are done; the others are built into a transform.

**Rounds.** The strings of a family are aligned by their anchor. Going from the last column to the
first, each round puts one more symbol before every string: a stable sort by that symbol turns the
order of the suffixes into the next one, and the common prefixes of neighbours grow by one or fall to
zero. A round's symbols in that order are its segment of the collection's transform; segments are
made one after the other and none is touched again, as suffixes of different columns of a family need
no comparison. Neighbours with a common prefix of 100 or more begin with equal windows.

**Large families.** A family that a sample of the documents shows to be large is cut into parts by
class. Each part is built by itself; the windows that are first in theirs then meet by digest.
The sample decides about the cutting alone, never about the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from voxlake.llm import textops as X
from voxlake.llm.bitmap import key_bitmap, passes
from voxlake.llm.quality_classifier import texts_of
from voxlake.llm.storage import kept

LENGTH = 100
ANCHOR = 32
STRINGS = 15_000  # that a task builds at a time
SLICE = 8 << 20  # bytes of text whose strings a task holds at a time
SEGMENT = 1 << 18  # bytes of text that are hashed at a time
BLOCK = 1_000  # strings whose symbols or windows are laid out, or handed on, at a time
FAMILY = 20_000  # classes from which a family is cut, about
SAMPLED = 64  # one document of so many tells which families are large
PLAIN, CUT, REPEAT = 0, 1, 2  # the last two bits of a key


def _segments(offsets: np.ndarray, size: int, overlap: int
              ) -> Iterator[tuple[int, int, int, int]]:
    """(first text, last text, from byte, to byte): pieces of texts, or parts of a long text.

    Parts of a text overlap, so that every window of overlap + 1 bytes is in exactly one.
    """
    for a, b in X.pieces(offsets, size):
        begin, end = int(offsets[a]), int(offsets[b])
        if b - a > 1 or end - begin <= 2 * size:
            yield a, b, begin, end
        else:
            for at in range(begin, max(begin + 1, end - overlap), size):
                yield a, b, at, min(end, at + size + overlap)


def anchored_strings(data: np.ndarray, offsets: np.ndarray, length: int, anchor: int
                     ) -> tuple[np.ndarray, ...]:
    """(key, class, text, start, size, anchor place in it) of the strings of some texts, in order."""
    n, width = len(data), length - anchor + 1
    count = n - length + 1
    if count <= 0:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, *[np.int64] * 4))
    sums = X.prefix_sums(data)
    begin = np.arange(n - anchor + 1)
    hashes = X.span_hashes(sums, begin, begin + anchor)
    # the smallest (hash, place) of each run of `width` places, from running minima of blocks
    ranked = np.full(-(-len(hashes) // width) * width, np.uint64(2 ** 64 - 1))
    ranked[:len(hashes)] = (hashes & np.uint64(0xFFFFFFFF00000000)) | begin.astype(np.uint64)
    blocks = ranked.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[width - 1:width - 1 + count])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:count]
    inside = np.flatnonzero(begin[:count] + length <= offsets[1:][text])
    if not len(inside):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, *[np.int64] * 4))
    place = place[inside]
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1])
                                         | (inside[1:] != inside[:-1] + 1)]))
    first, last = inside[new], inside[np.append(new[1:], len(inside)) - 1]
    place = place[new]
    return (hashes[place] & ~np.uint64(3), X.span_hashes(sums, first, last + length), text[first],
            first - offsets[text[first]], last + length - first, place - first)


def _merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges that touch or overlap drawn together; sorted by document and start, stops rising."""
    if not len(doc):
        return doc, start, stop
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > stop[:-1])]))
    return doc[new], start[new], stop[np.append(new[1:], len(doc)) - 1]


def _strings_of(batch: pa.RecordBatch, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(key, class, doc, place) of a batch, by document and start; place holds start, size, anchor."""
    ids = batch.column("id").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    data, offsets = X.packed(batch.column("text").take(pa.array(order)))
    parts = [tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))]
    for a, b, begin, end in _segments(offsets, SEGMENT, length - 1):
        inner = np.clip(offsets[a:b + 1] - begin, 0, end - begin)
        key, name, text, start, size, at = anchored_strings(data[begin:end], inner, length, anchor)
        start = start + max(0, begin - int(offsets[a]))
        parts.append((key, name, ids[a + text],
                      (start << 16) | ((size - length) << 8) | at))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


ROWS = "key long, class long, doc long, place long"


def _rows(key: np.ndarray, name: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(name.view(np.int64)), pa.array(doc),
         pa.array(place)], ["key", "class", "doc", "place"])


def large_families(docs: DataFrame, length: int, anchor: int, family: int, sampled: int
                   ) -> tuple[np.ndarray, np.ndarray]:
    """(sorted keys, into how many parts to cut each), by a sample of the documents."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in X.slices(whole, SLICE)):
            key, name, *_ = _strings_of(batch, length, anchor)
            pair = np.unique(np.column_stack([key, name]), axis=0)
            key, n = np.unique(pair[:, 0], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(n, pa.int64())], ["key", "n"])

    found = (docs.where(F.pmod(F.xxhash64("id"), F.lit(sampled)) == 0)
             .mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
             .where(F.col("n") * sampled > family).orderBy(F.desc("n")).limit(100_000).toArrow())
    key = found["key"].to_numpy().view(np.uint64)
    order = np.argsort(key)
    return key[order], -(-found["n"].to_numpy()[order] * sampled // family)


def first_strings(docs: DataFrame, large: tuple[np.ndarray, np.ndarray], length: int, anchor: int
                  ) -> DataFrame:
    """(key, class, doc, place) of each class of a slice of texts, at its first place there.

    Its other places are repeated for certain. They come as ranges: a key that ends in REPEAT, the
    stop as the class, the start as the place. So a group of copies is one row for each slice.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts = large
        for batch in (part for whole in batches for part in X.slices(whole, SLICE)):
            key, name, doc, place = _strings_of(batch, length, anchor)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                cut = keys[at] == key
                part = X.mixed(name) % np.where(cut, parts[at], 1).astype(np.uint64)
                key = np.where(cut, (X.mixed(key ^ part) & ~np.uint64(3)) | np.uint64(CUT), key)
            both = X.mixed(key) ^ name
            order = np.argsort(both, kind="stable")  # within a class, by document and start
            first = np.zeros(len(order), bool)
            first[order[np.flatnonzero(np.concatenate(
                [np.ones(min(1, len(order)), bool), both[order][1:] != both[order][:-1]]))]] = True
            yield _rows(key[first], name[first], doc[first], place[first])
            start = place[~first] >> 16
            stop = start + length + ((place[~first] >> 8) & 255)
            doc, start, stop = _merged(doc[~first], start, stop)
            key = (X.mixed(doc.view(np.uint64)) & ~np.uint64(3)) | np.uint64(REPEAT)
            yield _rows(key, stop.view(np.uint64), doc, start)

    return docs.mapInArrow(work, ROWS)


def classes(rows: DataFrame, length: int) -> DataFrame:
    """Repeated ranges, and the classes that are not alone in their family, one row each.

    A class keeps its first place of all. Rows of a family come sorted, as a stream: no more than a
    batch and one row are held at a time.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, last, known, waiting = None, None, 0, None
        for batch in batches:
            key, name, doc, place = (batch.column(i).to_numpy() for i in range(4))
            repeat = (key & 3) == REPEAT
            yield _rows(key[repeat], name[repeat], doc[repeat], place[repeat])
            key, name, doc, place = (x[~repeat] for x in (key, name, doc, place))
            if not len(key):
                continue
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
            new[0] = (key[0], name[0]) != (family, last)
            start = place[~new] >> 16
            yield _rows(np.full(len(start), REPEAT, np.int64),
                        start + length + ((place[~new] >> 8) & 255), doc[~new], start)
            begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            sizes = np.add.reduceat(new.astype(np.int64), begins)
            if key[0] == family:
                sizes[0] += known
                if sizes[0] > 1 and waiting is not None:
                    yield waiting
                    waiting = None
            else:
                waiting = None
            many = np.repeat(sizes, np.diff(np.append(begins, len(key)))) > 1
            out = new & (many | ((key & 3) == CUT))
            yield _rows(key[out], name[out], doc[out], place[out])
            family, last, known = key[-1], name[-1], int(sizes[-1])
            if known == 1 and family & 3 != CUT:
                at = len(key) - 1 - int(np.argmax(new[::-1])) if new.any() else None
                if at is not None and key[at] == family:
                    waiting = _rows(*(x[at:at + 1] for x in (key, name, doc, place)))
            else:
                waiting = None

    return rows.repartition("key").sortWithinPartitions("key", "class", "doc", "place") \
        .mapInArrow(work, ROWS)


STRINGS_SCHEMA = "key long, doc long, place long, string binary"


def with_strings(rows: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """(key, doc, place, string): the bytes of each class at its first place."""
    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(wanted, batch.column("id").to_numpy())))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in X.slices(whole, X.PIECE)):
            data, offsets = X.packed(batch.column("text"))
            own = batch.column("places")
            flat = own.flatten()
            place = flat.field(1).to_numpy()
            n = np.diff(own.offsets.to_numpy())
            start = np.repeat(offsets[:-1], n) + (place >> 16)
            stop = start + length + ((place >> 8) & 255)
            yield pa.RecordBatch.from_arrays(
                [flat.field(0), pa.array(np.repeat(batch.column("id").to_numpy(), n)),
                 pa.array(place),
                 pa.array([bytes(data[i:j]) for i, j in zip(start, stop, strict=True)],
                          pa.binary())], ["key", "doc", "place", "string"])

    wanted = key_bitmap(rows, "doc")
    own = rows.groupBy(F.col("doc").alias("id")).agg(
        F.collect_list(F.struct("key", "place")).alias("places"))
    return docs.mapInArrow(sieve, docs.schema).join(own, "id").mapInArrow(work, STRINGS_SCHEMA)


def column_rounds(symbols: np.ndarray, family: np.ndarray, cap: int
                  ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(column, order, transform, common) after each round, from the last column to the first.

    symbols: strings x columns, aligned, sorted by family, 0 where a string has no symbol. order
    sorts the strings' suffixes from the column on, family by family; transform holds the symbol
    before each suffix, 0 at the first column; common[i] is how much the suffixes i - 1 and i of
    the order share, `cap` at most, and 0 at the start of a family.
    """
    columns = np.ascontiguousarray(symbols.T)
    order = np.arange(len(symbols))
    base = family.astype(np.int64) << 16
    common = np.append(np.zeros(len(order), np.int64), cap)  # one more, where ranges may end
    for column in range(columns.shape[0] - 1, -1, -1):
        marked = base[order] | columns[column][order]
        moved = np.argsort(marked, kind="stable")
        marked = marked[moved]
        order = order[moved]
        grown = np.zeros(len(order), np.int64)
        same = np.flatnonzero(marked[1:] == marked[:-1]) + 1
        low, high = moved[same - 1] + 1, moved[same]
        shared = common[high]
        far = np.flatnonzero(low != high)  # the least of all that stood between the two
        if len(far):
            spans = np.column_stack([low[far], high[far] + 1]).ravel()
            shared[far] = np.minimum.reduceat(common, spans)[::2]
        grown[same] = np.minimum(shared + 1, cap)
        common = np.append(grown, cap)
        before = columns[column - 1][order] if column else np.zeros(len(order), columns.dtype)
        yield column, order, before, grown


def _aligned(strings: list[bytes], anchors: np.ndarray, length: int, anchor: int) -> np.ndarray:
    width, left = 2 * length - anchor, length - anchor
    out = np.zeros((len(strings), width), np.uint16)
    for at in range(0, len(strings), BLOCK):
        own = strings[at:at + BLOCK]
        sizes = np.array([len(s) for s in own])
        flat = np.frombuffer(b"".join(own), np.uint8).astype(np.uint16) + 1
        row = np.repeat(np.arange(at, at + len(own)), sizes)
        inner = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[row, inner + np.repeat(left - anchors[at:at + BLOCK], sizes)] = flat
    return out


def repeated_windows(family: np.ndarray, rank: np.ndarray, strings: list[bytes],
                     anchors: np.ndarray, length: int, anchor: int) -> np.ndarray:
    """strings x window starts (from the leftmost column on): which windows are not the first.

    rank orders the strings' places in the corpus; the window of the least rank is the first.
    """
    left = length - anchor
    symbols = _aligned(strings, anchors, length, anchor)
    begin = left - anchors
    end = begin + np.array([len(s) for s in strings])
    flags = np.zeros((len(strings), left + 1), bool)
    for column, order, _, common in column_rounds(symbols, family, length):
        if column <= left:
            runs = np.flatnonzero(common < length)
            first = np.minimum.reduceat(rank[order], runs)
            later = rank[order] != np.repeat(first, np.diff(np.append(runs, len(order))))
            own = order[later]
            flags[own, column] = (begin[own] <= column) & (column + length <= end[own])
    return flags


BUILT = "kind int, a long, b long, doc long, start long, stop long"


def _built(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns],
                                      ["kind", "a", "b", "doc", "start", "stop"])


def built(strings: DataFrame, length: int, anchor: int, at_once: int) -> DataFrame:
    """(kind, a, b, doc, start, stop): ranges of windows that are repeated in their family (kind 0),

    and for families that are cut the windows that are first in their part, by digest (kind 1).
    """
    left = length - anchor

    def build(rows: list[np.ndarray], held: list[bytes]) -> Iterator[pa.RecordBatch]:
        key, doc, place = (np.concatenate(x) for x in zip(*rows, strict=True))
        family = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]))
        at = (place & 255).astype(np.int64)
        rank = np.empty(len(key), np.int64)
        rank[np.lexsort(((place >> 16) + at, doc))] = np.arange(len(key))
        flags = repeated_windows(family, rank, held, at, length, anchor)
        # window starts of a row are columns: string start = column left - at
        edges = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, begin = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        start = (place[row] >> 16) + begin - (left - at[row])
        yield _built(np.zeros(len(row), np.int32), np.zeros(len(row), np.int64),
                     np.zeros(len(row), np.int64), doc[row], start, start + end - begin + length - 1)
        cut = np.flatnonzero((key & 3) == CUT)
        for first in range(0, len(cut), BLOCK):  # a string has up to 69 windows, each a row
            own = cut[first:first + BLOCK]
            data = np.frombuffer(b"".join(held[i] for i in own), np.uint8)
            size = np.array([len(held[i]) for i in own])
            sums, base = X.prefix_sums(data), np.cumsum(size) - size
            n = size - length + 1
            owner = np.repeat(np.arange(len(own)), n)
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            fresh = ~flags[own[owner], inner + left - at[own[owner]]]
            owner, inner = owner[fresh], inner[fresh]
            p = base[owner] + inner
            half = p + length // 2
            a = X.span_hashes(sums, p, p + length)
            b = X.mixed(X.span_hashes(sums, p, half) * np.uint64(3)
                        + X.span_hashes(sums, half, p + length))
            start = (place[own[owner]] >> 16) + inner
            yield _built(np.ones(len(owner), np.int32), a.view(np.int64), b.view(np.int64),
                         doc[own[owner]], start, start + length)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], []
        for batch in batches:
            key = batch.column("key").to_numpy()
            rows.append((key, batch.column("doc").to_numpy(), batch.column("place").to_numpy()))
            held += batch.column("string").to_pylist()
            if len(held) > at_once:  # up to the last family, which may go on
                whole = np.concatenate([r[0] for r in rows])
                end = int(np.searchsorted(whole, whole[-1]))
                if end:
                    joined = [np.concatenate(x) for x in zip(*rows, strict=True)]
                    yield from build([tuple(x[:end] for x in joined)], held[:end])
                    rows, held = [tuple(x[end:] for x in joined)], held[end:]
        if held:
            yield from build(rows, held)

    return strings.repartition("key").sortWithinPartitions("key").mapInArrow(work, BUILT)


def repeated_ranges(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR,
                    family: int = FAMILY, sampled: int = SAMPLED, at_once: int = STRINGS
                    ) -> DataFrame:
    """(doc, start, stop) byte ranges of docs (id, text) that windows cover which also start earlier.

    Ranges of a document may touch and overlap.
    """
    large = large_families(docs, length, anchor, family, sampled)
    found = kept(classes(first_strings(docs, large, length, anchor), length), "classes")
    repeat = F.col("key").bitwiseAND(F.lit(3)) == REPEAT
    rest = kept(built(with_strings(found.where(~repeat), docs, length), length, anchor, at_once),
                "built")
    order = W.partitionBy("a", "b").orderBy("doc", "start")  # one row for each part of a family
    met = (rest.where("kind = 1").withColumn("nth", F.row_number().over(order)).where("nth > 1"))
    ranges = ["doc", "start", "stop"]
    return (found.where(repeat).select("doc", F.col("place").alias("start"),
                                       F.col("class").alias("stop"))
            .union(rest.where("kind = 0").select(*ranges)).union(met.select(*ranges)))


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text",
                    length: int = LENGTH, anchor: int = ANCHOR, family: int = FAMILY,
                    sampled: int = SAMPLED, at_once: int = STRINGS) -> DataFrame:
    """One row per row of docs: id, n_bytes, removed, kept.

    A byte of the UTF-8 text goes if a window of `length` bytes covers it that also starts earlier:
    in a document with a smaller id, or before in the same one. removed are the maximal ranges of
    bytes that go, kept the other bytes. All windows are judged on the texts as they come; none
    crosses from text to text. Null and empty texts, and texts shorter than a window, lose nothing.
    Ids must be distinct integers; a row without one gives no row. Other columns are ignored.
    """
    docs = texts_of(docs, id, text)
    ranges = kept(repeated_ranges(docs, length, anchor, family, sampled, at_once), "ranges")
    wanted = key_bitmap(ranges, "doc")
    spans = "array<struct<start:bigint,stop:bigint>>"
    pair = pa.struct([("start", pa.int64()), ("stop", pa.int64())])

    def sieve(hit: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = passes(wanted, batch.column("id").to_numpy())
                yield batch.filter(pa.array(found == hit))
        return work

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in X.slices(whole, SLICE)):
            data, offsets = X.packed(batch.column("text"))
            removed, left = [], []
            for row, own in enumerate(batch.column("ranges")):
                whole = data[offsets[row]:offsets[row + 1]]
                mark = np.zeros(len(whole) + 1, np.int32)
                if own.values is not None and len(own.values):
                    np.add.at(mark, own.values.field(0).to_numpy(), 1)
                    np.add.at(mark, own.values.field(1).to_numpy(), -1)
                gone = np.cumsum(mark)[:-1] > 0
                edges = np.flatnonzero(np.diff(np.pad(gone, 1).astype(np.int8)))
                removed.append([dict(start=int(a), stop=int(b))
                                for a, b in zip(edges[::2], edges[1::2], strict=True)])
                left.append(bytes(whole[~gone]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(offsets)), pa.array(removed, pa.list_(pair)),
                 pa.array(left, pa.binary())], ["id", "n_bytes", "removed", "kept"])

    own = ranges.groupBy(F.col("doc").alias("id")).agg(
        F.collect_list(F.struct("start", "stop")).alias("ranges"))
    touched = docs.mapInArrow(sieve(True), docs.schema).join(own, "id", "left")
    whole = docs.mapInArrow(sieve(False), docs.schema).withColumn(
        "ranges", F.lit(None).cast(spans))
    schema = f"id long, n_bytes long, removed {spans}, kept binary"
    return (touched.mapInArrow(work, schema).union(whole.mapInArrow(work, schema))
            .withColumnRenamed("id", id))
