"""Words, shingles and hashes of many texts at once, on the UTF-8 bytes that Arrow holds.

Every function takes `data`, the bytes of all texts of a piece one after the other, and `offsets`,
where each text begins (one more entry than texts). Nothing here knows Spark.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20  # bytes of text worked on at a time; a longer text is a piece of its own
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def packed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of an Arrow string array; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, data = texts.buffers()
    offsets = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def packed_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of an Arrow array of large binary values without nulls."""
    _, places, data = values.buffers()
    offsets = np.frombuffer(places, np.int64)[values.offset:values.offset + len(values) + 1]
    if data is None or not len(values):
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about `size` bytes each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def slices(batch: pa.RecordBatch, size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `size` bytes of text each, so that no more is worked on at once."""
    for first, last in pieces(packed(batch.column(column))[1], size):
        yield batch.slice(first, last - first)


def cut(data: np.ndarray, offsets: np.ndarray, first: int, last: int
        ) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of the texts first to last - 1."""
    part = offsets[first:last + 1]
    return data[part[0]:part[-1]], part - part[0]


def byte_class(member: Callable[[int], bool]) -> np.ndarray:
    return np.array([member(b) for b in range(256)])


#: A-Z to a-z and nothing else, as bytes.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: Bytes of words that only blanks (space, tab, line breaks) part.
UNSPACED = byte_class(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Bytes of words of digits, small letters and everything beyond ASCII.
ALPHANUMERIC = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of each maximal run of the given bytes; runs end with their text."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = letters[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return (starts, np.flatnonzero(ends) + 1,
            np.searchsorted(offsets, starts, side="right") - 1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n + 1:
        size = max(n + 1, PIECE + 1)
        _powers = tuple(
            np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base))])
            for base in (_BASE, _INVERSE))
    return _powers


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which `span_hashes` takes the hash of any span."""
    powers, _ = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal for equal bytes, wherever they stand."""
    _, inverse = _power_tables(len(sums) - 1)
    return mixed((sums[ends] - sums[starts]) * inverse[starts]
                 + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def joined_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n successive hashes, in order."""
    total = max(0, len(hashes) - n + 1)
    out = np.full(total, np.uint64(0xA0761D6478BD642F ^ int(n)))
    for i in range(n):
        out = mixed(out ^ hashes[i:i + total]) if i % 2 else out * _BASE + hashes[i:i + total]
    return mixed(out)


def shingles(hashes: np.ndarray, texts: np.ndarray, n: int, short: bool = True
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first word) of each run of n words of one text.

    `short`: a text of fewer words, but not none, has all of them as its one run.
    """
    inside = texts[:len(texts) - n + 1] == texts[n - 1:] if len(texts) >= n else np.zeros(0, bool)
    first = np.flatnonzero(inside)
    runs = joined_hashes(hashes, n)[first]
    owner = texts[first]
    if short and len(texts):
        begin = np.flatnonzero(np.concatenate([[True], texts[1:] != texts[:-1]]))
        count = np.diff(np.append(begin, len(texts)))
        for size in range(1, n):
            whole = begin[count == size]
            if len(whole):
                runs = np.concatenate([runs, joined_hashes(hashes, size)[whole]])
                owner = np.concatenate([owner, texts[whole]])
                first = np.concatenate([first, whole])
        order = np.argsort(first, kind="stable")
        runs, owner, first = runs[order], owner[order], first[order]
    return runs, owner, first


def distinct_per_text(hashes: np.ndarray, texts: np.ndarray, n: int
                      ) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes text after text, where each of the n texts begins)."""
    edges = np.searchsorted(texts, np.arange(n + 1))
    parts = [np.unique(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64),
            np.concatenate([[0], np.cumsum(sizes)]))
