import re

import pytest

from tests.llm.conftest import by_id
from voxlake.llm import near_duplicates as N


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute_force(rows, similarity=85):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= similarity * len(sets[a] | sets[b]):
                    low = min(root[a], root[b])
                    changed |= root[a] != low or root[b] != low
                    root[a] = root[b] = low
    return {i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def check(documents, rows):
    found = by_id(N.near_duplicates(documents(rows), similarity=85))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} \
        == brute_force(rows)


def varied(text, places, word="CHANGED"):
    words = text.split()
    for p in places:
        words[p % len(words)] = f"{word}{p}"
    return " ".join(words)


def test_copies_variants_and_odd_texts(documents, prose):
    base = prose(150, 1)
    rows = [(5, base), (9, base.upper().replace("\xb5", "")), (7, base + "\t\n"), (1, None), (2, ""),
            (3, " \n "), (4, "one two"), (6, "One  TWO"), (8, "two one"), (10, prose(150, 2))]
    rows += [(20 + i, varied(base, [i * 7])) for i in range(12)]
    rows += [(50, varied(base, range(0, 150, 4))), (51, prose(9000, 3)), (52, prose(9000, 3) + " z")]
    check(documents, rows)


def test_chains_are_followed(documents, prose):
    rows, text = [], prose(120, 4)
    for i in range(8):  # each like the next, the first unlike the last
        rows.append((100 - i, text))
        text = varied(text, [13 * i + 5, 13 * i + 6])
    check(documents, rows)


def test_large_clusters_are_compared_in_blocks(documents, prose, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    base = prose(100, 5)
    # pairs differ from the base, and from each other, by enough that no pivot links them all
    rows = [(i, varied(base, [(i // 2) * 9, (i // 2) * 9 + 30, (i % 2) * 3], f"w{i // 2}"))
            for i in range(24)]
    check(documents, rows)


def test_no_documents(documents):
    assert N.near_duplicates(documents([])).count() == 0


@pytest.mark.parametrize("similarity", [0.5, 0.9])
def test_sketches_tell_similarity(similarity):
    import numpy as np
    rng = np.random.default_rng(1)
    n, samples = 400, 2000
    common = round(2 * n * similarity / (1 + similarity))
    pool = rng.integers(0, 2 ** 63, 2 * n).astype(np.uint64)
    a, b = pool[:n], np.concatenate([pool[:common], pool[n:2 * n - common]])
    taken = N.samples_of(np.concatenate([a, b]), np.array([0, n, 2 * n]), samples)
    sketch = N.odd_sketches(taken, 128)
    bits = int(np.bitwise_count(sketch[0] ^ sketch[1]).sum())
    assert abs(N.estimated_similarity(bits, samples, 128 * 64) - similarity) < 0.05


def test_more_bits_are_allowed_for_less_risk():
    assert N.differing_bits(risk=1e-9) > N.differing_bits(risk=1e-3) > 0


@pytest.mark.parametrize("similarity", [10, 30, 50, 80, 85, 95, 100])
def test_bands_follow_the_similarity(similarity):
    bands, rows = N.banding(similarity)
    assert (1 - (similarity / 100) ** rows) ** bands <= N.MISS_RISK
    assert bands * rows <= N.SAMPLES or rows == 1
    assert N.banding(85) == (26, 5)


def test_lower_similarities_find_all_their_links(documents, prose):
    rows = []
    for i in range(60):  # 196 runs of words each; 20 differ: 0.815, or 60 differ: 0.53
        base = prose(200, 100 + i)
        rows += [(10 * i, base), (10 * i + 1, varied(base, range(20, 60, 10))),
                 (10 * i + 2, varied(base, range(10, 190, 15), "OTHER"))]
    docs = documents(rows)
    for similarity in (80, 50):
        found = by_id(N.near_duplicates(docs, similarity=similarity))
        expected = brute_force(rows, similarity)
        assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == expected
        assert all(expected[10 * i + 1][1] == 10 * i for i in range(60))
    assert brute_force(rows, 85) != brute_force(rows, 80) != brute_force(rows, 50)


def similar(prose, percent, seed):
    """Two texts of 300 words whose similarity is just above or at `percent`, by changed words."""
    base = prose(300, seed)
    best = None
    for changed in range(1, 12):
        other = varied(base, [20 * i + 7 for i in range(changed)])
        a, b = shingles(base), shingles(other)
        if 100 * len(a & b) >= percent * len(a | b):
            best = other
    return base, best


def test_the_default_links_from_eighty(documents, prose):
    rows = []
    for k, percent in enumerate((80, 81, 82, 83, 84, 86, 70)):
        a, b = similar(prose, percent, 20 + k)
        rows += [(10 * k, a), (10 * k + 1, b)]
    expected = brute_force(rows, 80)
    assert sum(not first for *_, first in expected.values()) == 6
    assert expected != brute_force(rows, 85)
    found = by_id(N.near_duplicates(documents(rows)))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == expected
