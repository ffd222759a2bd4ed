import random
import tracemalloc

import numpy as np
import pytest

from tests.llm.conftest import by_id
from voxlake.llm import repeated_passages as R


def brute_force(rows, length):
    first, gone = {}, {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone[i] = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            if first.setdefault(data[s:s + length], (i, s)) != (i, s):
                gone[i][s:s + length] = True
    return {i: (len(gone[i]), bytes(np.frombuffer((t or "").encode(), np.uint8)[~gone[i]]))
            for i, t in rows}


def check(documents, rows, length=100, **more):
    found = by_id(R.without_repeats(documents(rows), length=length, **more))
    assert {i: (r.n_bytes, bytes(r.kept)) for i, r in found.items()} == brute_force(rows, length)
    for i, text in rows:
        data = (text or "").encode()
        ranges = [(s.start, s.stop) for s in found[i].removed]
        assert all(a < b < c for (_, a), (b, c) in zip([(0, -1), *ranges], ranges, strict=False))
        left = bytearray(data)
        for a, b in reversed(ranges):
            del left[a:b]
        assert bytes(left) == bytes(found[i].kept)


def collection(seed=1):
    pick = random.Random(seed)
    text = lambda n, of="abcdé ": "".join(pick.choice(of) for _ in range(n))
    passage, other = text(350), text(130)
    rows = [(i, text(pick.randrange(400)) + (passage if i % 3 else "") + text(90)
             + (other if i % 4 == 0 else "")) for i in range(40)]
    copy = rows[7][1]
    return rows + [(100 - i, copy) for i in range(6)] + [
        (200, None), (201, ""), (202, passage[:99]), (203, passage[:100]), (204, "a" * 700),
        (205, "ab" * 300), (206, passage + passage), (207, "\x00" * 250), (208, "é" * 150)]


def test_against_brute_force(documents):
    check(documents, collection())


def test_small_alphabet_and_short_windows(documents):
    pick = random.Random(5)
    rows = [(i, "".join(pick.choice("ab") for _ in range(pick.randrange(300)))) for i in range(60)]
    check(documents, rows, length=16, anchor=6)


def test_families_that_are_cut(documents):
    """Every family is taken for large and cut into parts of a few classes."""
    check(documents, collection(2), family=2, sampled=1)


def test_collections_are_built_in_turn(documents):
    check(documents, collection(3), at_once=3)


def test_long_texts_are_cut_at_borders(documents, monkeypatch):
    monkeypatch.setattr(R, "SEGMENT", 500)
    monkeypatch.setattr(R, "SLICE", 4000)
    check(documents, [*collection(4), (300, "".join(t or "" for _, t in collection(4)))])


def test_no_documents(documents):
    assert R.without_repeats(documents([])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_rounds_sort_the_suffixes(seed):
    """Order, transform and common prefixes after each round, against sorting whole suffixes."""
    rng = np.random.default_rng(seed)
    symbols = rng.integers(0, 3, (30, 12)).astype(np.uint16)
    family = np.sort(rng.integers(0, 4, 30))
    for column, order, before, common in R.column_rounds(symbols, family, 12):
        suffixes = [(family[i], tuple(symbols[i, column:])) for i in range(30)]
        assert [suffixes[i] for i in order] == sorted(suffixes)
        assert list(before) == [symbols[i, column - 1] if column else 0 for i in order]
        for k in range(1, 30):
            (f, x), (g, y) = suffixes[order[k - 1]], suffixes[order[k]]
            same = 0 if f != g else next(
                (n for n, (p, q) in enumerate(zip(x, y, strict=True)) if p != q), len(x))
            assert common[k] == same


def test_strings_are_laid_out_in_blocks():
    """Besides the table itself, what is needed does not grow with the number of strings."""
    strings = [bytes([k % 251]) * (100 + k % 69) for k in range(20_000)]
    anchors = np.array([k % 69 % (len(s) - 99) for k, s in enumerate(strings)])
    tracemalloc.start()
    table = R._aligned(strings, anchors, 100, 32)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < table.nbytes + (16 << 20)
    for k in (0, 999, 1_000, 1_070, 19_999):
        left = 68 - anchors[k]
        own = np.zeros(168, np.uint16)
        own[left:left + len(strings[k])] = k % 251 + 1
        assert np.array_equal(table[k], own)
