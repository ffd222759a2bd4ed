import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import by_id
from voxlake.llm import queries
from voxlake.llm import token_alignment as T
from voxlake.llm.chunks import byte_level, pieces, safe_cut

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
A, B = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("piece_bpe_32k.model")
ODD = [None, "", " ", "a▁b", "\n x", "x \n y", "<s> <|endoftext|> </s> <0x0A> <unk>", "\r\n;\r\n a;\r b",
       "é" * 60, "🙂🙂 🙂", "日本語" * 90, " a" * 700, "b" * 900, "word \n next\t\tq　 z", "  \n  lead  ",
       "x \n y"]


def brute_force(rows):
    first = tokenizers.Tokenizer.from_str(A.decode())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_proto=B)
    names_a, names_b = byte_level(A, True).token_bytes, pieces(B).token_bytes
    grouped, counts = {}, Counter()
    for i, text in rows:
        grouped[i] = None
        if not text:
            continue
        sides, whole = [], (" " + text).encode()
        for ids, names in ((first.encode(" " + text, add_special_tokens=False).ids, names_a),
                           (second.encode(text), names_b)):
            at, ends = 0, []
            for t in ids:
                at += len(names[t])
                ends.append(at)
            sides.append(list(zip(ids, ends, strict=True)))
            if b"".join(names[t] for t in ids) != whole:
                sides = None
                break
        if sides is None:
            continue
        cuts = sorted({e for _, e in sides[0]} & {e for _, e in sides[1]})
        grouped[i] = [[[t for t, e in side if lo < e <= hi] for side in sides]
                      for lo, hi in zip([0, *cuts], cuts)]
        counts.update({(a, b) for x, y in grouped[i] for a in set(x) for b in set(y)})
    top = Counter()
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    out = {}
    for i, groups in grouped.items():
        if groups is None:
            out[i] = (0, 0, 0, 0, 0, 0, "")
            continue
        linked = [(a, counts[a, b]) for x, y in groups for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[i] = (sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups),
                  len(linked), sum(n == top[a] for a, n in linked), sum(n for _, n in linked),
                  hashlib.sha256(text.encode()).hexdigest())
    return out


@pytest.mark.parametrize("stretch, part", [(32_000, 2_000_000), (40, 300)])
def test_against_plain_python(documents, prose, stretch, part):
    """Also with short stretches, so a document is put together in several levels, and several parts."""
    rows = list(enumerate(ODD)) + [(100, prose(150)), (101, prose(150)), (102, prose(800, 5))]
    found = by_id(T.alignment(documents([*rows, (None, "no id")]), A, B, stretch=stretch, part=part))
    assert {i: tuple(r)[1:] for i, r in found.items()} == brute_force(rows)


def test_texts_that_end_with_one_space(documents):
    """The space behind the last word is a chunk of its own, and a token of the second tokenizer."""
    rows = list(enumerate(["a word ", "x\n ", "ab ", "two words ", "end.\t", " c ", "🙂 "]))
    found = by_id(T.alignment(documents(rows), A, B))
    assert {i: tuple(r)[1:] for i, r in found.items()} == brute_force(rows)
    assert all(r["n_a"] > 0 for r in found.values())


def test_fragments_compose_in_any_order():
    pick = random.Random(5)
    for _ in range(200):
        size = pick.randrange(1, 60)
        ends = [np.array(sorted({*pick.sample(range(1, size + 1), pick.randrange(size)), size}))
                for _ in range(2)]
        ids = [np.arange(len(e)) + 100 * k for k, e in enumerate(ends)]
        whole = T.fragment(*ids, *ends)
        cuts = sorted({0, size, *(pick.randrange(size) for _ in range(5))})
        parts = []
        for lo, hi in zip(cuts, cuts[1:]):  # any bytes may part two fragments
            inside = [(e > lo) & (e <= hi) for e in ends]
            parts.append(T.fragment(*[x[m] for x, m in zip(ids, inside)],
                                    *[e[m] - lo for e, m in zip(ends, inside)]))
        while len(parts) > 1:
            i = pick.randrange(len(parts) - 1)
            parts[i:i + 2] = [T.composed(parts[i], parts[i + 1])]
        assert all(np.array_equal(x, y) for x, y in zip(whole, parts[0]))


def test_big_groups_are_listed_by_distinct_ids():
    pick = random.Random(2)
    a, b = ([pick.randrange(6) for _ in range(n)] for n in (50, 41))
    found = T.Aligned(np.array([9, *a]), np.array([8, *b]), np.array([1, 50]), np.array([1, 41]),
                      np.array([0, 3]))
    want = Counter({(0, 9, 8): 1}) + Counter((3, x, y) for x in a for y in b)
    got = Counter()
    for row, pair, times in T.links(found):
        for r, p, n in zip(row.tolist(), pair.tolist(), times.tolist()):
            got[r, p >> T.ID_BITS, p & (1 << T.ID_BITS) - 1] += n
    assert got == want


def test_cuts_are_behind_firm_characters():
    assert safe_cut("ab cd", 0) == 2 and safe_cut("ab  cd", 3) == 6
    assert safe_cut("a\u00a0 b c", 0) == 4 and safe_cut("abc", 1) == 3
    assert safe_cut(" abc", 0) == 4


def test_long_documents_are_cut_and_dealt_out(spark, documents, prose):
    docs = documents([(1, prose(400)), (2, "short"), (3, None)]).select(
        "doc_id", "text").withColumnRenamed("doc_id", "id")
    rows = T.stretches(docs, 300).collect()
    assert "".join(r.text for r in sorted(rows, key=lambda r: r.seq) if r.id == 1) == prose(400)
    assert sum(r.id == 1 for r in rows) > 5 and sum(r.id == 2 for r in rows) == 1
    assert [r.text for r in rows if r.id == 3] == [None]


def test_empty_table(documents):
    assert T.alignment(documents([]), A, B).count() == 0
