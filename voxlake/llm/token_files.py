"""Token ids in files of independent zstandard frames with a seek table.

A file holds, one after the other: a frame for each document, its ids as little-endian unsigned 32-bit
integers; a skippable frame with the documents' ids (64 bits each, ascending); and last, as a
skippable frame too, the seek table of the public seekable format: compressed size, decompressed size
and checksum (low 32 bits of XXH64) of every frame, then the number of frames, a flag and a magic
number. Any zstandard reader reads such a file from end to end; one that knows the table decompresses
only the documents it is asked for.
"""

from __future__ import annotations

import functools
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm import textops as X
from voxlake.llm.chunks import Remembered, byte_level, chunk_array, chunk_edges, encoded
from voxlake.llm.quality_classifier import texts_of
from voxlake.llm.storage import kept

FILE_BYTES = 8 << 20  # compressed frames of a file, about: a task holds some files at a time
LEVEL = 3  # of compression
SLICE = 2 << 20  # bytes of text encoded at a time

# Fixed values of the format: magic numbers of skippable frames and of the table's end.
NAMES_MAGIC = 0x184D2A50
TABLE_MAGIC = 0x184D2A5E
END_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
_END = struct.pack("<I", END_MAGIC)
_FRAME = "id long, n_tokens long, checksum long, frame binary"


@functools.lru_cache(maxsize=2)
def _remembered(source: bytes) -> Remembered:
    return Remembered(byte_level(source, False).encode)


def _encoded(texts: pa.Array, source: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, where each text's begin and the end of the last)."""
    data, offsets = X.packed(texts)
    own = byte_level(source, False)
    whole = data.tobytes()  # a special token's string must stay in one chunk
    edges = chunk_edges(data, offsets, own.begin, not any(s in whole for s in own.special))
    return encoded(chunk_array(data, edges), np.searchsorted(edges, offsets), _remembered(source))


def frames(docs: DataFrame, tokenizer: bytes, end: int, id: str = "doc_id", text: str = "text",
           level: int = LEVEL) -> DataFrame:
    """id, n_tokens, checksum and frame of every document with an id; `end` follows its tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        for batch in batches:
            for part in X.slices(batch, SLICE):
                ids, starts = _encoded(part.column("text"), shared.value)
                plain = [np.append(ids[a:b], np.int32(end)).astype("<u4").tobytes()
                         for a, b in zip(starts[:-1], starts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(np.diff(starts) + 1, pa.int64()),
                    pa.array([xxhash.xxh64_intdigest(p) & 0xFFFFFFFF for p in plain], pa.int64()),
                    pa.array([packer.compress(p) for p in plain], pa.binary())],
                    ["id", "n_tokens", "checksum", "frame"])

    return texts_of(docs, id, text).mapInArrow(work, _FRAME)


def file_bytes(ids: np.ndarray, sizes: np.ndarray, checksums: np.ndarray, packed: list[bytes]
               ) -> bytes:
    """A file, without the four bytes at its end."""
    table = np.zeros((len(packed), 3), "<u4")
    table[:, 0] = [len(p) for p in packed]
    table[:, 1], table[:, 2] = sizes, checksums
    names = ids.astype("<i8").tobytes()
    # the table has no entry for the frame of names: it is no data, and stands behind all that is
    return b"".join([
        *packed, struct.pack("<II", NAMES_MAGIC, len(names)), names,
        struct.pack("<II", TABLE_MAGIC, table.nbytes + 9), table.tobytes(),
        struct.pack("<IB", len(packed), CHECKSUMS)])


def write_files(rows: DataFrame, path: str, target: int = FILE_BYTES) -> None:
    """Write `frames` as files below path, in ascending order of id within and across files.

    rows should be a table: they are read three times. Spark's own writer commits the files, so a
    task that is repeated leaves one file, in any store that Spark can write to. It ends each
    record with a separator; a record is a whole file here, and the separator the format's last
    four bytes.
    """
    total = rows.agg(F.sum(F.length("frame"))).first()[0] or 0
    dealt = rows.repartitionByRange(max(1, math.ceil(total / target)), "id").sortWithinPartitions("id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in range(len(batch)):
                size += len(batch.column("frame")[row].as_buffer())
                if held and size > target:
                    yield _file(held)
                    held, size = [], 0
                held.append(batch.slice(row, 1))
        if held:
            yield _file(held)

    (dealt.mapInArrow(work, "file binary").select(F.col("file").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
     .option("lineSep", _END.decode("latin-1")).text(path))


def _file(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    found = pa.Table.from_batches(rows)
    content = file_bytes(
        found["id"].to_numpy(), found["n_tokens"].to_numpy() * 4, found["checksum"].to_numpy(),
        found["frame"].to_pylist())
    return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], ["file"])


class TokenFile:
    """What the table at the end of a file's content says."""

    def __init__(self, content: bytes):
        self.content = content
        count, flags, end = struct.unpack_from("<IBI", content, len(content) - 9)
        if end != END_MAGIC or not flags & CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        at = len(content) - 9 - 12 * count
        if struct.unpack_from("<II", content, at - 8) != (TABLE_MAGIC, 12 * count + 9):
            raise ValueError("the seek table is damaged")
        table = np.frombuffer(content, "<u4", 3 * count, at).reshape(count, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(table[:, 0])])
        self.sizes, self.checksums = table[:, 1], table[:, 2]
        names = at - 8 - 8 * count
        if struct.unpack_from("<II", content, names - 8) != (NAMES_MAGIC, 8 * count):
            raise ValueError("the documents' ids are damaged")
        self.ids = np.frombuffer(content, "<i8", count, names)
        self.before = np.concatenate([[0], np.cumsum(self.sizes)])[:-1] // 4

    def tokens(self, place: int, reader: zstandard.ZstdDecompressor) -> bytes:
        """The ids of the document at a place; no other frame is touched."""
        packed = self.content[self.places[place]:self.places[place + 1]]
        plain = reader.decompress(packed, max_output_size=int(self.sizes[place]))
        if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != self.checksums[place]:
            raise ValueError(f"document {self.ids[place]} is damaged")
        return plain


def _contents(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").load(path).where("length > 0")
            .select(F.col("path").alias("file"), "content"))


def seek_tables(spark: SparkSession, path: str) -> DataFrame:
    """file, first_id, n_documents and n_tokens of each file; nothing is decompressed."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = [TokenFile(c.as_py()) for c in batch.column("content")]
            yield pa.RecordBatch.from_arrays([
                batch.column("file"), pa.array([int(t.ids[0]) for t in tables], pa.int64()),
                pa.array([len(t.ids) for t in tables], pa.int64()),
                pa.array([int(t.sizes.sum()) // 4 for t in tables], pa.int64())],
                ["file", "first_id", "n_documents", "n_tokens"])

    return _contents(spark, path).mapInArrow(
        work, "file string, first_id long, n_documents long, n_tokens long")


def read_files(spark: SparkSession, path: str, wanted: list[int] | None = None,
               starts: dict[str, int] | None = None) -> DataFrame:
    """id, file, start and tokens (the document's ids as bytes).

    start counts the ids of all documents before, in the file or, with `starts_of_files`, in all of
    them. `wanted`: only these documents, and only their frames are decompressed. A frame that does not
    have its checksum fails the run.
    """
    asked = None if wanted is None else np.unique(np.array(wanted, np.int64))
    shared = spark.sparkContext.broadcast(starts or {})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = zstandard.ZstdDecompressor()
        for batch in batches:
            for file, content in zip(batch.column("file"), batch.column("content"), strict=True):
                table, file = TokenFile(content.as_py()), file.as_py()
                first = shared.value.get(file, 0)
                places = (np.arange(len(table.ids)) if asked is None
                          else np.flatnonzero(np.isin(table.ids, asked)))
                for part in np.split(places, np.flatnonzero(np.diff(
                        np.cumsum(table.sizes[places]) // SLICE)) + 1):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(table.ids[part], pa.int64()),
                        pa.array([file] * len(part), pa.string()),
                        pa.array(table.before[part] + first, pa.int64()),
                        pa.array([table.tokens(int(p), reader) for p in part], pa.binary())],
                        ["id", "file", "start", "tokens"])

    return _contents(spark, path).mapInArrow(
        work, "id long, file string, start long, tokens binary")


def starts_of_files(spark: SparkSession, path: str) -> dict[str, int]:
    """The ids in all files before each one. Files, not documents: the driver lists them anyway."""
    found = seek_tables(spark, path).toArrow().sort_by("first_id")
    counts = found["n_tokens"].to_numpy()
    return dict(zip(found["file"].to_pylist(), (np.cumsum(counts) - counts).tolist(), strict=True))


def token_files(docs: DataFrame, path: str, tokenizer: bytes, end: int, id: str = "doc_id",
                text: str = "text", target: int = FILE_BYTES) -> DataFrame:
    """Write docs to files below path and read them back: id, start, n_tokens, tokens.

    start counts the ids of all documents before, by id. tokens are little-endian unsigned 32-bit
    integers, `end` last. Null and empty texts have that one only. The strings of special tokens in
    a text become those tokens. Ids must be distinct integers; a row without one is in no file
    and gives no row. No rows: no files, no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    write_files(kept(frames(docs, tokenizer, end, id, text), "frames"), path, target)
    return read_files(spark, path, starts=starts_of_files(spark, path)).select(
        F.col("id").alias(id), "start", F.expr("length(tokens) div 4").alias("n_tokens"), "tokens")
