import random

import pytest
import tiktoken

from tests.llm.conftest import by_id
from voxlake.llm import token_counts as T
from voxlake.llm.queries import CLEANING, PRE_TOKENS, TOKENIZER


@pytest.fixture(scope="module")
def own():
    return T.tokenizer(TOKENIZER, PRE_TOKENS)


@pytest.fixture(scope="module")
def encoding(own) -> tiktoken.Encoding:
    return own.counts.encoding


def test_updated_trees_equal_new_ones(own, encoding):
    pick = random.Random(3)
    pieces = ["the ", "cat's", "  ", "\n\n", "12", " 345", "é", "!?", " x", "\t", "don't ", "'", "re", "r", "   "]
    for _ in range(6000):
        text = "".join(pick.choice(pieces) for _ in range(pick.randrange(60)))
        starts, tree = T.built_tree(text, own, pick.choice([1, 2, 5, 64]))
        assert tree[1] == len(encoding.encode_ordinary(text)) if len(tree) > 1 else not text
        edits = T.usable_edits([
            dict(start=(at := pick.randrange(-2, len(text) + 3)), end=at + pick.randrange(-1, 9),
                 text=pick.choice([*pieces, "", None])) for _ in range(pick.randrange(5))], len(text))
        new = T.edited(text, edits)
        starts, tree, encoded = T.updated_tree(text, edits, starts, tree, own)
        width = len(tree) // 2
        assert tree[1] == len(encoding.encode_ordinary(new))
        assert all(tree[i] == tree[2 * i] + tree[2 * i + 1] for i in range(1, width))
        assert starts[-1] == len(new) and not (encoded and not edits)
        assert all(b > a or not tree[width + i]
                   for i, (a, b) in enumerate(zip(starts, starts[1:], strict=False)))


def test_only_the_neighbourhood_is_encoded(own):
    text = "some words of a long text " * 4000
    starts, tree = T.built_tree(text, own)
    _, _, encoded = T.updated_tree(text, [(52_000, 52_004, "other")], starts, tree, own)
    assert 0 < encoded <= 3 * T.LEAF


def test_table_of_documents(documents, encoding):
    rows = [(1, None), (2, ""), (3, "write to a.b@c.example.org now!!!! ok"), (4, "plain"),
            (5, "wörds %%% and a@b.cd$$$ " * 9000), (6, "%%%%"), (7, "plain"), (8, " \n ")]
    found = by_id(T.edit_aware_counts(documents(rows), CLEANING, TOKENIZER, PRE_TOKENS))
    for i, text in rows:
        row = found[i]
        assert row.n_before == len(encoding.encode_ordinary(text or ""))
        assert row.n_tokens == len(encoding.encode_ordinary(row.text))
        assert "@" not in row.text and "%%" not in row.text
    assert found[4].n_edits == found[4].n_encoded == 0
    assert T.edit_aware_counts(documents([]), CLEANING, TOKENIZER, PRE_TOKENS).count() == 0


def test_edits_that_cannot_be_made():
    edits = [dict(start=5, end=9, text="a"), dict(start=7, end=12, text="b"), None,
             dict(start=None, end=3, text="c"), dict(start=3, end=1, text="d"),
             dict(start=12, end=99, text=None), dict(start=-4, end=2, text="e")]
    assert T.usable_edits(edits, 20) == [(0, 2, "e"), (5, 9, "a"), (12, 20, "")]
