"""Texts cut into chunks that tokenizers encode alike alone and in their text; each is encoded once.

A chunk begins at a blank behind a character that is no blank. Byte-level BPE ends a pre-token there,
and piece-level BPE has no piece that reaches across. So a text's tokens are those of its chunks, one
after the other, and a distinct chunk is worth encoding only once. Nothing here knows Spark.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tokenizers

from voxlake.llm import textops as X

CACHED = 300_000  # distinct chunks a worker remembers, some 40 bytes each
_BLOCK = 1_000  # chunks encoded as one text
_AT_ONCE = 1 << 17  # bytes that the tokenizers library is given in one go, about
_BLANKS = b" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f"
#: Last bytes of the blanks beyond ASCII: behind such a byte no chunk begins.
_DOUBTFUL = bytes([*range(0x80, 0x8B), 0x8E, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
_FIRM = X.byte_class(lambda b: b not in _BLANKS and b not in _DOUBTFUL and b > 0x20)
_LETTER = X.byte_class(lambda b: 65 <= b <= 90 or 97 <= b <= 122)
_SIGN = X.byte_class(lambda b: 0x21 <= b <= 0x7E and not chr(b).isalnum() and b != 0x27)


def chunk_edges(data: np.ndarray, offsets: np.ndarray, begin: bytes = b" \t\n",
                letters: bool = False) -> np.ndarray:
    """Where chunks begin in the texts that `offsets` bound, and the end of the last.

    `begin` are the blanks a chunk may begin with; without any each text is one chunk. A text
    begins a chunk, unless it is empty. `letters`: also between an ASCII letter and another sign of
    ASCII that is no letter, digit, blank or apostrophe.
    """
    start = np.zeros(len(data) + 1, bool)
    if begin and len(data):
        start[1:-1] = _FIRM[data[:-1]] & X.byte_class(lambda b: b in begin)[data[1:]]
        if letters:
            letter, sign = _LETTER[data], _SIGN[data]
            start[1:-1] |= (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])
    start[offsets] = True
    return np.flatnonzero(start)


def safe_cut(text: str, at: int) -> int:
    """The first place from `at` on where a chunk with a space in front begins, or the text's end."""
    while (at := text.find(" ", at)) >= 0:
        before = text[at - 1] if at else " "
        if before > " " and (before < "\x7f" or _FIRM[before.encode("utf-8", "replace")[-1]]):
            return at
        at += 1
    return len(text)


def chunk_array(data: np.ndarray, edges: np.ndarray) -> pa.DictionaryArray:
    """The chunks as a dictionary of distinct ones and an index for each."""
    chunks = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(edges) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(edges, np.int64)), pa.py_buffer(data)])
    return pc.dictionary_encode(chunks)


class ByteLevel:
    """Byte-level BPE of the tokenizers library, from the text of its file.

    `plain`: the strings of special tokens inside a text are ordinary text.
    """

    def __init__(self, source: bytes, plain: bool):
        self.tokenizer = tokenizers.Tokenizer.from_str(source.decode())
        self.tokenizer.encode_special_tokens = plain
        described = json.loads(source)
        cutting = described.get("pre_tokenizer") or {}
        added = described.get("added_tokens") or []
        alone = (described.get("normalizer") is None and cutting.get("type") == "ByteLevel"
                 and cutting.get("use_regex") and not cutting.get("add_prefix_space")
                 and not described.get("truncation") and not described.get("padding")
                 and not any(a["lstrip"] or a["rstrip"] or a["single_word"]
                             or set(a["content"]) & set(" \t\n") for a in added))
        self.begin = b" \t\n" if alone else b""
        self.special = [] if plain else [a["content"].encode() for a in added]

    def encode(self, chunks: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, where each chunk's begin and the last's end)."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the cores are Spark's
        return _in_blocks(chunks, self.begin, self._ids, self.token_sizes)

    def _ids(self, texts: list[bytes]) -> list[list[int]]:
        # what the library returns takes some 100 bytes a token: only the ids are held on to
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64) // _AT_ONCE
        parts = np.flatnonzero(np.diff(ends, prepend=-1, append=-1))
        return [e.ids for a, b in itertools.pairwise(parts)
                for e in self.tokenizer.encode_batch_fast(
                    [t.decode() for t in texts[a:b]], add_special_tokens=False)]

    @functools.cached_property
    def token_sizes(self) -> np.ndarray:
        return np.array([len(t) for t in self.token_bytes], np.int64)

    @functools.cached_property
    def token_bytes(self) -> list[bytes]:
        """The bytes of each id; those of a byte-level alphabet, where printable bytes are themselves."""
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        others = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        known = self.tokenizer.get_vocab(with_added_tokens=False)
        whole = self.tokenizer.get_vocab(with_added_tokens=True)
        out = [b""] * (1 + max(whole.values(), default=0))
        for token, i in whole.items():
            out[i] = bytes(byte[c] for c in token if c in byte) if token in known else token.encode()
        return out


class Pieces:
    """Piece-level BPE of the sentencepiece library; it puts a space in front of a text by itself."""

    def __init__(self, model: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = {c for name in names for c in name.lstrip("▁") if len(name) > 1}
        self.begin = b"".join(
            c.encode() for c in " \t\n" if (c if c != " " else "▁") not in crossing)
        self.token_bytes = [
            bytes([int(name[3:-1], 16)]) if self.model.is_byte(i)
            else name.replace("▁", " ").encode() for i, name in enumerate(names)]
        self.token_sizes = np.array([len(t) for t in self.token_bytes], np.int64)
        self.space = self.model.piece_to_id("▁")
        if b" " not in self.begin:
            self.begin = b""

    def encode(self, chunks: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, where each chunk's begin and the last's end).

        They are chunks of a text with a space in front, which the library adds again: one that begins
        otherwise gets none, nor does a chunk that is a space and nothing else, as one at a text's end is.
        """
        return _in_blocks(chunks, b" ", self._ids, self.token_sizes)

    def _ids(self, chunks: list[bytes]) -> list[list[int]]:
        texts = [c.decode() for c in chunks]
        found = self.model.encode([t[1:] if t.startswith(" ") else t for t in texts], num_threads=1)
        return [[self.space] if t == " " else
                ids if t.startswith(" ") or ids[:1] != [self.space] else ids[1:]
                for t, ids in zip(texts, found, strict=True)]


def _after_blank(data: np.ndarray, offsets: np.ndarray, begin: bytes) -> np.ndarray:
    """Which chunks may stand in a row with others: none of their neighbours can change their tokens."""
    return X.byte_class(lambda b: b in begin)[data[offsets[:-1]]] & _FIRM[data[offsets[1:] - 1]]


def _in_blocks(chunks: pa.LargeBinaryArray, begin: bytes, encode: Callable[[list[bytes]], list],
               sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Encode chunks that may stand in a row as one text, which is cut by the bytes of its tokens."""
    fits = _after_blank(*X.packed_bytes(chunks), begin)
    rows, alone = np.flatnonzero(fits), [np.flatnonzero(~fits)]
    data, places = X.packed_bytes(chunks.take(pa.array(rows)))
    firsts = range(0, len(rows), _BLOCK)
    counts, pieces = np.zeros(len(chunks), np.int64), []
    for i, ids in zip(firsts, encode([
            data[places[i]:places[min(i + _BLOCK, len(rows))]].tobytes() for i in firsts]), strict=True):
        block, ids = rows[i:i + _BLOCK], np.array(ids, np.int32)
        ends = np.concatenate([[-1], np.cumsum(sizes[ids])])
        stops = places[i + 1:i + 1 + len(block)] - places[i]
        upto = np.searchsorted(ends, stops, "right") - 1
        if ends[-1] == stops[-1] and (ends[upto] == stops).all():
            counts[block] = np.diff(upto, prepend=0)
            pieces.append((block, ids))
        else:  # some token's bytes are not the text's: then chunk by chunk
            alone.append(block)
    alone = np.sort(np.concatenate(alone))
    found = encode(chunks.take(pa.array(alone)).to_pylist())
    counts[alone] = [len(ids) for ids in found]
    ends = np.concatenate([[0], np.cumsum(counts)])
    out = np.zeros(int(ends[-1]), np.int32)
    for block, ids in [*pieces, (alone, np.fromiter(itertools.chain.from_iterable(found), np.int32))]:
        n = counts[block]
        out[np.arange(len(ids)) + np.repeat(ends[block] - (np.cumsum(n) - n), n)] = ids
    return out, ends


class Remembered:
    """Tokens of distinct chunks, encoded once; those of about `most` chunks are kept.

    Where there are more, the chunks that are asked for just then stay: frequent ones are among them.
    """

    def __init__(self, encode: Callable[[pa.LargeBinaryArray], tuple[np.ndarray, np.ndarray]],
                 most: int = CACHED):
        self.encode, self.most = encode, most
        self.known = pa.array([], pa.large_binary())
        self.ids, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _lists(self) -> pa.LargeListArray:
        return pa.LargeListArray.from_arrays(pa.array(self.ends), pa.array(self.ids))

    def __call__(self, chunks: pa.LargeBinaryArray) -> tuple[pa.LargeListArray, np.ndarray]:
        """(lists of ids, the list of each chunk); no chunk may be there twice."""
        found = pc.fill_null(pc.index_in(chunks, value_set=self.known), -1).to_numpy().astype(np.int64)
        missing = found < 0
        fresh = int(missing.sum())
        if fresh and len(self.known) + fresh > self.most:
            asked = pa.array(found[~missing])
            lists = self._lists().take(asked)
            self.known, self.ids = self.known.take(asked), np.asarray(lists.flatten())
            self.ends = np.asarray(lists.offsets, np.int64) - lists.offsets[0].as_py()
            found[~missing] = np.arange(len(asked))
        if fresh:
            new = chunks.filter(pa.array(missing))
            ids, ends = self.encode(new)
            found[missing] = np.arange(len(self.known), len(self.known) + fresh)
            self.known = pa.concat_arrays([self.known, new])
            self.ends = np.concatenate([self.ends, ends[1:] + self.ends[-1]])
            self.ids = np.concatenate([self.ids, ids])
        return self._lists(), found


def encoded(chunks: pa.DictionaryArray, first: np.ndarray, remembered: Remembered
            ) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all chunks in order, where those of each text begin and the last end).

    Text i has chunks first[i] to first[i + 1] - 1.
    """
    lists, places = remembered(chunks.dictionary)
    found = pc.take(lists, pa.array(places[chunks.indices.to_numpy()]))
    ends = np.asarray(found.offsets, np.int64)
    return np.asarray(found.flatten()), ends[first] - ends[0]


@functools.lru_cache(maxsize=4)
def byte_level(source: bytes, plain: bool) -> ByteLevel:
    """One for each worker process."""
    return ByteLevel(source, plain)


@functools.lru_cache(maxsize=4)
def pieces(model: bytes) -> Pieces:
    """One for each worker process."""
    return Pieces(model)
