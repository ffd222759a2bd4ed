import hashlib
import random
import zlib

import pytest

from tests.llm.conftest import by_id
from voxlake.llm import periodic_runs as R
from voxlake.llm import queries


def brute_force(words, least=12):
    """Every period, every stretch; no use of anything the operator knows."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smallest = not any(all(words[i + k] == words[i + k + p] for k in range(length - p))
                               for p in range(1, q))
            if j > i and length >= max(least, 2 * q) and smallest:
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [12, 5, 2])
def test_runs_of_random_words(least):
    pick = random.Random(least)
    for _ in range(400):
        n, kinds = pick.randrange(60), pick.choice([1, 2, 3, 5, 20])
        words = [pick.randrange(kinds) for _ in range(n)]
        if n > 4 and pick.random() < 0.6:
            a, p = pick.randrange(n), pick.randrange(1, n // 2 + 1)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        assert R.runs(words, least) == brute_force(words, least)


def test_highly_periodic_words():
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for text in (fibonacci[-1], "a" * 200, "ab" * 100, ("a" * 13 + "b") * 9, "abcabd" * 20):
        assert R.runs(list(text)) == brute_force(list(text))


def test_prose_has_no_stretches_to_look_at(prose):
    import numpy as np
    words = [f"w{i}" for i in range(4000)]
    assert R.stretches(np.array([hash(w) for w in words]).view(np.uint64)) == []
    once_more = words[:3000] + words[2000:3000] + words[3000:]  # a square of period 1000
    assert R.runs(once_more) == [(2000, 2000, 1000)]


def digest(rows, change=None):
    out = {}
    for i, text in rows:
        words = (text or "").encode().split()
        if change and words:
            words = change(words, i)
        found = brute_force(words)
        dropped = {k for s, n, q in found for k in range(s + q, s + n)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        left = b" ".join(w for k, w in enumerate(words) if k not in dropped)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        out[i] = (len(found), *best, 1000 * best[1] // best[2] if found else None,
                  hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())
    return out


def test_digest(documents, prose):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "x " * 30), (6, prose(60) + " " + prose(60)),
            (7, "a b " * 6 + prose(40, 2) + " c d" * 6), (8, prose(300, 3)), (9, "a b a b " * 8),
            (11, ("é ü ö " * 8) + "é x"), (12, "x " * 30)]
    rows += [(100 + i, prose(50, i)) for i in range(40)]  # some with a repeated tail
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows[11:])
    found = by_id(R.run_digest(R.periodic_runs(documents([*rows, (None, "x " * 20)]),
                                               prepared=R.repeated_tails)))
    assert {i: tuple(r)[1:] for i, r in found.items()} == digest(rows, R.repeated_tails)


def test_repeated_tail_follows_its_formula():
    i = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    g, words = zlib.crc32(str(i).encode()) // 10, [f"w{k}" for k in range(57)]
    a = g % 57
    p = 1 + (57 - a) // (3 + g % 8)
    assert R.repeated_tails(words, i) == [
        words[k] if k < a else words[a + (k - a) % p] for k in range(57)]


def test_query_against_plain_python(spark):
    sf = "/root/testdata/sf0.001"
    found = by_id(queries.QUERIES["op13_periodic_runs"](spark, sf))
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect()
            if len((r.text or "").split()) < 400]
    want = digest(rows, R.repeated_tails)
    assert {i: tuple(found[i])[1:] for i in want} == want


def test_empty_table(documents):
    assert R.run_digest(R.periodic_runs(documents([]))).count() == 0
