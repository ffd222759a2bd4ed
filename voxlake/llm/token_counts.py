"""Token counts that follow edits.

The tokenizer cuts a text into pre-tokens and encodes each by itself, so a text has as many tokens as
its pre-tokens together. A document keeps a segment tree: each leaf is a stretch of pre-tokens, with
its place in the text and its tokens, each inner node the sum of its two children, the root the
document's count. An edit re-encodes only the leaves it touches, from a leaf so far before the edit
that the edit cannot move its border, to the first old border behind it that the new pre-tokens meet
again; from there on the text is cut as before. The sums above the touched leaves are updated.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from voxlake.llm.quality_classifier import texts_of

LEAF = 64  # pre-tokens of a leaf when the tree is built
CACHED = 300_000  # pre-tokens whose counts a worker remembers


class _Counts(dict):
    """Tokens of a pre-token."""

    def __init__(self, encoding: tiktoken.Encoding):
        self.encoding = encoding

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[piece] = n = len(self.encoding.encode_ordinary(piece))
        return n


class Tokenizer:
    """Byte-level BPE from a file of ranks; `pattern` cuts texts into pre-tokens."""

    def __init__(self, path: str, pattern: str):
        ranks = {base64.b64decode(token): int(rank) for token, rank in
                 map(bytes.split, Path(path).read_bytes().splitlines())}
        self.pattern = regex.compile(pattern)
        self.counts = _Counts(tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}))


@functools.lru_cache(maxsize=4)
def tokenizer(path: str, pattern: str) -> Tokenizer:
    """One for each worker process."""
    return Tokenizer(path, pattern)


def built_tree(text: str, own: Tokenizer, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(start of each leaf and the end of the text, tree); tree[1] is the root, tree[0] unused.

    Leaf i is tree[len(tree) // 2 + i]. A text without pre-tokens has one empty leaf.
    """
    pieces, count = own.pattern.findall(text), own.counts.__getitem__
    groups = [pieces[i:i + leaf] for i in range(0, max(1, len(pieces)), leaf)]
    starts = np.zeros(len(groups) + 1, np.int64)
    np.cumsum([len("".join(group)) for group in groups], out=starts[1:])
    width = 1 << (len(groups) - 1).bit_length()
    tree = np.zeros(2 * width, np.int64)
    tree[width:width + len(groups)] = [sum(map(count, group)) for group in groups]
    level = width
    while level > 1:
        tree[level // 2:level] = tree[level:2 * level:2] + tree[level + 1:2 * level:2]
        level //= 2
    return starts, tree


def usable_edits(edits: list[dict], size: int) -> list[tuple[int, int, str]]:
    """(start, end, text) by start; cut to the text, and without those that overlap an earlier one."""
    out: list[tuple[int, int, str]] = []
    for e in sorted((e for e in edits if e and e["start"] is not None and e["end"] is not None),
                    key=lambda e: (e["start"], e["end"])):
        start, end = max(0, min(e["start"], size)), max(0, min(e["end"], size))
        if start <= end and (not out or start >= out[-1][1]):
            out.append((start, end, e["text"] or ""))
    return out


def edited(text: str, edits: list[tuple[int, int, str]]) -> str:
    parts, done = [], 0
    for start, end, new in edits:
        parts += [text[done:start], new]
        done = end
    return "".join(parts) + text[done:]


def _settled(between: str) -> bool:
    """Whether an edit behind this text cannot move the border before it.

    Where a pre-token ends may hang on three characters more, or on the end of a run of blanks.
    """
    return len(between) > 2 and not between.isspace()


def updated_tree(text: str, edits: list[tuple[int, int, str]], starts: np.ndarray,
                 tree: np.ndarray, own: Tokenizer) -> tuple[np.ndarray, np.ndarray, int]:
    """(starts, tree, pre-tokens encoded) of the edited text.

    The leaves of a touched stretch are merged into its first one; the others stay, empty.
    """
    new, width, last = edited(text, edits), len(tree) // 2, len(starts) - 1
    tree, moved, encoded = tree.copy(), starts.copy(), 0
    shift = done = i = 0  # leaves before `done` have their new start
    while i < len(edits):
        leaf = int(np.searchsorted(starts[:last], edits[i][0], "left")) - 1
        while leaf > done and not _settled(text[starts[leaf]:edits[i][0]]):
            leaf -= 1
        leaf = max(done, leaf)
        moved[done:leaf + 1] = starts[done:leaf + 1] + shift
        at, n, end = int(moved[leaf]), 0, leaf + 1
        while True:
            # edits that begin in the stretch, or right at its end, belong to it
            while i < len(edits) and (edits[i][0] <= starts[end] or end == last):
                shift += len(edits[i][2]) - (edits[i][1] - edits[i][0])
                while end < last and starts[end] < edits[i][1]:
                    end += 1
                i += 1
            goal = int(starts[end]) + shift
            while at < goal:
                piece = own.pattern.match(new, at)
                n += own.counts[piece.group()]
                encoded += 1
                at = piece.end()
            if at == goal:
                break
            end += 1  # the old border is inside a new pre-token
        moved[leaf + 1:end] = goal
        for k in range(leaf, end):
            node, value = width + k, n if k == leaf else 0
            change = value - tree[node]
            while change and node:
                tree[node] += change
                node //= 2
        done = end
    moved[done:] = starts[done:] + shift
    return moved, tree, encoded


TREE = "starts array<long>, tree array<long>"
EDITS = "array<struct<start:bigint,end:bigint,text:string>>"


def token_trees(docs: DataFrame, path: str, pattern: str, leaf: int = LEAF) -> DataFrame:
    """docs (id, text, ...) with n_tokens, starts and tree. A null text counts as empty."""
    kinds = [f"`{c}` {t}" for c, t in docs.dtypes]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path, pattern)
        for batch in batches:
            found = [built_tree(t.as_py() or "", own, leaf) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([int(tree[1]) if len(tree) > 1 else 0
                                          for _, tree in found], pa.int64()),
                pa.array([s for s, _ in found], pa.list_(pa.int64())),
                pa.array([t for _, t in found], pa.list_(pa.int64()))],
                [*batch.schema.names, "n_tokens", "starts", "tree"])

    return docs.mapInArrow(work, ", ".join([*kinds, "n_tokens long", TREE]))


RESULT = {"id": "long", "n_before": "long", "n_edits": "long", "n_encoded": "long",
          "n_tokens": "long", "starts": "array<long>", "tree": "array<long>", "text": "string"}
COUNTS = ("id", "n_before", "n_edits", "n_encoded", "n_tokens")


def after_edits(rows: DataFrame, path: str, pattern: str, columns: Sequence[str] = tuple(RESULT)
                ) -> DataFrame:
    """The given columns of RESULT once the edits are made.

    rows: id, text, starts, tree and edits (start, end, text), in code points of the old text.
    Null edits count as none. n_encoded are the pre-tokens that had to be encoded; starts, tree
    and text are those after the edits.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path, pattern)
        for batch in batches:
            out = []
            for row in range(len(batch)):
                text = batch.column("text")[row].as_py() or ""
                edits = usable_edits(batch.column("edits")[row].as_py() or [], len(text))
                starts = np.array(batch.column("starts")[row].values)
                old = np.array(batch.column("tree")[row].values)
                starts, tree, n = updated_tree(text, edits, starts, old, own)
                out.append((int(old[1]), len(edits), n, int(tree[1]), starts, tree,
                            edited(text, edits)))
            kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2 + [pa.string()]
            found = {"id": batch.column("id")} | {
                name: pa.array([x[k] for x in out], kind)
                for k, (name, kind) in enumerate(zip(list(RESULT)[1:], kinds, strict=True))
                if name in columns}
            yield pa.RecordBatch.from_arrays([found[c] for c in columns], list(columns))

    return rows.select("id", "text", "starts", "tree", "edits").mapInArrow(
        work, ", ".join(f"{c} {RESULT[c]}" for c in columns))


def pattern_edits(docs: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """docs (id, text) with the edits that replace each rule's matches by its text."""
    entry = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("text", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [(regex.compile(pattern), new) for pattern, new in rules]
        for batch in batches:
            found = [[dict(start=m.start(), end=m.end(), text=new)
                      for pattern, new in compiled for m in pattern.finditer(t.as_py() or "")]
                     for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(entry))], [*batch.schema.names, "edits"])

    return docs.mapInArrow(work, f"id long, text string, edits {EDITS}")


def edit_aware_counts(docs: DataFrame, rules: list[tuple[str, str]], path: str, pattern: str,
                      id: str = "doc_id", text: str = "text", leaf: int = LEAF,
                      columns: Sequence[str] = tuple(RESULT)) -> DataFrame:
    """One row per row of docs: the given columns of RESULT, of which id is one.

    The edits are those of `pattern_edits`; of two that overlap, the one that starts later is left
    out. Null and empty texts have no tokens and no edits. Ids must be distinct integers; a row
    without one gives no row. Other columns are ignored.
    """
    docs = pattern_edits(texts_of(docs, id, text), rules)
    return after_edits(token_trees(docs, path, pattern, leaf), path, pattern,
                       columns).withColumnRenamed("id", id)
