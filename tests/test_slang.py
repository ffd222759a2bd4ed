import random
import re

import pytest

from voxlake.functions import slang as S

TERMS = S.slang_terms()


def plain_decode(text):
    def read(match):
        code = int(match[0][2:], 16)
        if code > 0x10FFFF:
            return match[0]
        return "\ufffd" if 0xD800 <= code < 0xE000 else chr(code)
    return re.sub(r"\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}", read, text)


def plain_expand(text):
    parts = re.split(r"(\w+)", text)
    for i in range(1, len(parts), 2):
        if re.fullmatch("[a-z]+", parts[i]) and re.search(r"(.)\1\1", parts[i]):
            parts[i] += " " + re.sub(r"(.)\1\1+", r"\1", parts[i])
    return "".join(parts)


def plain_replace(text):
    for t in TERMS:
        pieces, start = [], 0
        while (at := text.find(t.term, start)) >= 0:
            end = at + len(t.term)
            sides = text[at - 1:at] + text[end:end + 1]
            if t.is_word and any(c.isalnum() or c == "_" for c in sides):
                pieces.append(text[start:at + 1])
                start = at + 1
            else:
                pieces += [text[start:at], " ", t.replacement, " "]
                start = end
        text = "".join([*pieces, text[start:]])
    return " ".join(text.split())


@pytest.mark.parametrize("raw, expected", [
    (r"hi \U0001f60a", "hi \U0001f60a"),
    (r"\u00e9\u00E9 \u12", "éé \\u12"),
    (r"\U00110000", r"\U00110000"),
    (r"\ud83d!", "\ufffd!"),
    (r"\u005cu0041", r"\u0041"),
    ("plain", "plain"),
    (None, None),
])
def test_decode_escapes(one, raw, expected):
    assert one(S.decode_escapes, [raw]) == [expected]


def test_stretched_words(one):
    assert one(S.expand_stretched, ["niceeeee", "aaabbb!", "éaaa", "aaa_ aaa", "AAA", "good"]) == [
        "niceeeee nice", "aaabbb ab!", "éaaa", "aaa_ aaa a", "AAA", "good"]


def test_longest_term_first(one):
    assert one(lambda x: S.apply_slang(x, TERMS), ["huge w"]) == ["amazing win"]


def test_without_lexicon_the_text_stays(one):
    assert one(lambda x: S.apply_slang(x, []), [r"niceeee \u0041"]) == [r"niceeee \u0041"]


def test_escape_is_decoded_before_lower_casing(one):
    assert one(lambda x: S.scoring_text(x, TERMS), [r"OK \U0001F60A"]) == ["ok happy"]


def test_evaluation_expands_even_without_lexicon(one):
    assert one(lambda x: S.evaluation_text(x, []), ["Sooo"]) == ["sooo so"]


def test_blank_terms_are_left_out():
    assert [t.term for t in S.slang_terms([(" ", "x"), ("A", "b"), ("ab", "c"), ("d", " ")])] == [
        "ab", "a"]


def test_special_characters_in_terms_and_replacements(one):
    terms = S.slang_terms([("c++", "$1 \\ lang"), ("a.b", "dot")])
    assert one(lambda x: S.apply_slang(x, terms), ["c++ axb a.b"]) == ["$1 \\ lang axb dot"]


def test_against_plain_python(one):
    """Random texts of terms, letters of several scripts, emoji and borders."""
    pick = random.Random(7)
    atoms = [t.term for t in TERMS] + list("wlé_ .!'0½²一ßaab\u00a0") + [
        "\u0301", "\u200d", "ooo", "aaa", r"\u00e9", r"\U0001f525", "\U0001d4b3", " ", " "]
    texts = ["".join(pick.choice(atoms) for _ in range(pick.randint(1, 12))) for _ in range(3000)]
    found = one(lambda x: S.apply_slang(x, TERMS), texts)
    wrong = [(t, f, plain_replace(plain_expand(plain_decode(t)))) for t, f in zip(texts, found)
             if f != plain_replace(plain_expand(plain_decode(t)))]
    assert not wrong, wrong[:3]
