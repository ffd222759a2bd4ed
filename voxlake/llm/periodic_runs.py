"""Maximal periodic runs of words, found by a suffix automaton whose link tree is a link-cut tree.

Words are appended one by one. A state of the automaton stands for strings that end at the same places;
the states of all suffixes of what has been read lie on the path from the newest state to the root.
That path is recoloured with the place just read (an access in the link-cut tree). Each segment that it
had been in one colour before says: strings up to this length also ended at that earlier place, and not
since. If the distance d of the two ends is at most that length, the text holds a square of period d
there, and the square is extended to a run. The colour of a segment is the string's latest end
before, so d is the smallest period.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.llm import textops as X
from voxlake.llm.quality_classifier import texts_of

LEAST = 12  # words of a run; and at least twice its period
SLICE = 4 << 20  # bytes of text worked on at a time
_GRAM = 6  # words of a sieve's string; a run of LEAST words or more repeats one


class _LinkCut:
    """Paths of one colour in the tree of suffix links; each is a splay tree, by depth.

    Node 0 is nothing. up: parent in the splay tree, or what the path hangs from. A path's colour
    is kept at its splay root. The arrays grow with the automaton.
    """

    def __init__(self):
        self.up, self.low, self.high, self.colour = [0], [0], [0], [-1]

    def add(self, above: int, colour: int) -> int:
        """A new node, a path by itself."""
        self.up.append(above)
        self.low.append(0)
        self.high.append(0)
        self.colour.append(colour)
        return len(self.up) - 1

    def splay(self, x: int) -> None:
        up, low, high = self.up, self.low, self.high
        colour = -2
        while True:
            p = up[x]
            if not p or (low[p] != x and high[p] != x):
                break
            g = up[p]
            inner = g and (low[g] == p or high[g] == p)
            if not inner:
                colour = self.colour[p]
                turns = (x,)
            else:
                turns = (p, x) if (low[g] == p) == (low[p] == x) else (x, x)
                above = up[g]
                if not above or (low[above] != g and high[above] != g):
                    colour = self.colour[g]
            for y in turns:
                q = up[y]
                r = up[q]
                if low[q] == y:
                    child = low[q] = high[y]
                    high[y] = q
                else:
                    child = high[q] = low[y]
                    low[y] = q
                if child:
                    up[child] = q
                if r:
                    if low[r] == q:
                        low[r] = y
                    elif high[r] == q:
                        high[r] = y
                up[y], up[q] = r, y
        if colour != -2:
            self.colour[x] = colour

    def insert_above(self, x: int, above: int) -> int:
        """A new node between x and `above`, which it hung from; with the colour of x."""
        self.splay(x)
        higher = self.low[x]
        if higher:
            self.up[higher], self.colour[higher] = self.up[x], self.colour[x]
            self.low[x] = 0
        new = self.add(above, self.colour[x])
        self.up[x] = new
        return new

    def access(self, x: int, colour: int) -> list[tuple[int, int]]:
        """Recolour the path from x to the root; (deepest node, colour before) of its segments."""
        found, below, at = [], 0, x
        while at:
            self.splay(at)
            before = self.colour[at]
            found.append((at, before))
            deeper = self.high[at]
            if deeper:
                self.colour[deeper] = before
            self.high[at] = below
            below, at = at, self.up[at]
        self.splay(x)
        self.colour[x] = colour
        return found


def squares(codes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(end, period, length of the earlier string) wherever a square is found."""
    tree = _LinkCut()
    root = tree.add(0, -1)
    step: list[dict[int, int]] = [{}, {}]
    size, link = [0, 0], [0, 0]
    last = root
    for i, c in enumerate(codes):
        new = tree.add(0, -1)
        step.append({})
        size.append(size[last] + 1)
        link.append(root)
        at = last
        while at and c not in step[at]:
            step[at][c] = new
            at = link[at]
        if at:
            q = step[at][c]
            if size[q] != size[at] + 1:
                copy = tree.insert_above(q, link[q])
                step.append(dict(step[q]))
                size.append(size[at] + 1)
                link.append(link[q])
                link[q] = copy
                while at and step[at].get(c) == q:
                    step[at][c] = copy
                    at = link[at]
                q = copy
            link[new] = q
        tree.up[new] = link[new]
        last = new
        for node, before in tree.access(new, i):
            if 0 <= before and size[node] >= i - before:
                yield i, i - before, size[node]


def runs_between(words: list, first: int, last: int, least: int = LEAST
                 ) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs within words[first:last], extended beyond it."""
    names: dict = {}
    codes = [names.setdefault(w, len(names)) for w in words[first:last]]
    known: dict[int, int] = {}  # the end of the last run of a period
    found = []
    for i, period, length in squares(codes):
        end = first + i
        if known.get(period, -1) >= end:
            continue
        start = end - period - length + 1
        while start > 0 and words[start - 1] == words[start - 1 + period]:
            start -= 1
        while end + 1 < len(words) and words[end + 1] == words[end + 1 - period]:
            end += 1
        known[period] = end
        if end - start + 1 >= max(least, 2 * period):
            found.append((start, end - start + 1, period))
    return found


def stretches(hashes: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Ranges of words outside of which no run of `least` words or more has a word.

    Of a run's strings of _GRAM words all but _GRAM - 1 in the middle stand a period away once
    more. So what has no string twice has no run, and a run lies within strings that occur twice
    and gaps between them of that length.
    """
    gram = min(_GRAM, least // 2)
    if len(hashes) < least:
        return []
    grams = X.joined_hashes(hashes, gram)
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return []
    twice = np.zeros(len(grams), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    places = np.flatnonzero(twice)
    breaks = np.flatnonzero(np.diff(places) > gram)
    firsts = places[np.concatenate([[0], breaks + 1])]
    lasts = places[np.concatenate([breaks, [len(places) - 1]])] + gram
    return [(int(a), int(b)) for a, b in zip(firsts, lasts, strict=True) if b - a >= least]


def runs(words: list, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a text's words, by start, then period."""
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    return sorted({run for a, b in stretches(hashes, least)
                   for run in runs_between(words, a, b, least)}, key=lambda r: (r[0], r[2]))


def collapsed(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words that no run repeats: of each run the first period stays."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


Words = Callable[[list, int], list]


def periodic_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST,
                  prepared: Words | None = None) -> DataFrame:
    """One row per row of docs: id, n_words, runs (start, length, period), collapsed (bytes).

    Words are what blanks (space, tab, line breaks) part. A run is a stretch of words with smallest period q,
    of `least` words and two periods at least, that no neighbouring word extends. Runs come by start,
    then period; they may overlap. collapsed joins by one space the words that no run holds behind
    its first q. `prepared` may change the words of a document (words, id) before. Null and blank
    texts have no words and no runs. Ids must be distinct integers; a row without one gives no
    row. Other columns are ignored. Memory follows the longest stretch of repeated words.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            for part in X.slices(batch, SLICE):
                out = []
                for key, value in zip(part.column("id").to_pylist(), part.column("text"), strict=True):
                    words = (value.as_py() or "").encode().split()
                    words = prepared(words, key) if prepared and words else words
                    found = runs(words, least)
                    out.append((len(words), [dict(zip(("start", "length", "period"), r, strict=True))
                                             for r in found], b" ".join(collapsed(words, found))))
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1] for x in out], pa.list_(run)),
                    pa.array([x[2] for x in out], pa.binary())],
                    ["id", "n_words", "runs", "collapsed"])

    return texts_of(docs, id, text).mapInArrow(
        work, "id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
              "collapsed binary").withColumnRenamed("id", id)


def repeated_tails(words: list, id: int) -> list:
    """In one document of ten, by the id's checksum, the words from a place on repeat with a period."""
    h = zlib.crc32(str(id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def run_digest(found: DataFrame, id: str = "doc_id") -> DataFrame:
    """The longest run of each document (ties: smallest start, then period) and checksums."""
    best = F.try_element_at(F.array_sort("runs", lambda x, y: F.when(
        x["length"] != y["length"], F.signum(y["length"] - x["length"])).when(
        x["start"] != y["start"], F.signum(x["start"] - y["start"])).otherwise(
        F.signum(x["period"] - y["period"])).cast("int")), F.lit(1))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        id, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
