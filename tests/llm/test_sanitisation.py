import random
import re

from tests.llm.conftest import by_id
from voxlake.llm import sanitisation as S


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_force(text):
    """The four patterns as they are stated, by the plain engine."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    tests = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
    return sorted(((m.start(), m.end(), kind) for kind, pattern, test in tests
                   for m in re.finditer(pattern, text) if test(m)),
                  key=lambda s: (s[0], S.KINDS.index(s[2])))


def test_base_spans_against_the_patterns():
    texts = ["", "a@b", "a@b.c@d.e", "a@b.c x@d.e.f. @g.h", "a@@b.c", "é.a@b-1.c", "a@b..c",
             "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.0255.1", "0000.0.0.0", "1.2.3",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "12 3 4", "+1 (499) 555-6503",
             "+12345678", "+1 2 3 4 5 6 7 8 9", "++123456789", "+1.2.3.4.5.6.7.8.9", "1" * 5000,
             "+" + "1" * 5000, "9" * 5000 + ".1.1.1"]
    pick = random.Random(6)
    texts += ["".join(pick.choice("a.@0149+- ()é") for _ in range(60)) for _ in range(3000)]
    texts += ["".join(pick.choice("0123456789 -.+") for _ in range(50)) for _ in range(2000)]
    for text in texts:
        if len(text) < 4000:
            assert S.base_spans(text) == brute_force(text), text
        else:
            assert S.base_spans(text) == []


def corpus():
    """A name that stands only beside one address, and common words that stand everywhere."""
    rows = [(i, f"common words all around {i} and more common words") for i in range(40)]
    rows += [(100 + i, f"common {w} wrote Zorblax from bob@mail.example.com common words {i}")
             for i, w in enumerate(["x", "yy", "zzz", "often"])]
    rows += [(200 + i, "single Quimby once eve@mail.example.com") for i in range(5)]  # copies
    return rows + [(300, None), (301, ""), (302, "a b " * 50_000), (303, "Zorblax was here")]


def test_terms_that_disclose_are_found(documents):
    docs = documents(corpus())
    found = by_id(S.sanitisation(docs))
    for i, text in corpus():
        row = found[i]
        assert [tuple(s) for s in row.base] == brute_force(text or "")
        added = {text[s.start:s.end]: s.kind for s in row.added}
        if 100 <= i < 200:  # of five documents with the name, four have the address
            assert added["Zorblax"] in ("generalise", "remove") and "common" not in added
        else:  # no base span, or one text only
            assert not added
    masked = by_id(S.masked(docs, S.sanitisation(docs)))
    assert "bob@" not in masked[100].text and "Zorblax" not in masked[100].text
    assert "<email>" in masked[100].text and masked[303].text == "Zorblax was here"
    assert masked[300].text is None and masked[301].text == "" and masked[0].text == corpus()[0][1]


def test_terms_disclose_from_anywhere(documents):
    """Far from the address or near it, with digits, and wherever they stand again."""
    far = " ".join(["common", "words"] * 40)
    rows = [(i, f"{far} number {i}") for i in range(30)]
    rows += [(100 + i, f"Zorblax and room77 {i} {far} bob@mail.example.com {far} ZORBLAX, 55443 {far}")
             for i in range(2)]
    rows += [(102, f"bob@mail.example.com Zorblax room77 {far} zorblax 55443"),
             (103, f"bob@mail.example.com {far} room77 55443 and Zorblax"), (104, f"Zorblax {far}")]
    found = by_id(S.sanitisation(documents(rows)))
    for i, text in rows:
        added = [(text[s.start:s.end], s.kind) for s in found[i].added]
        hidden = [w for w in re.findall("[0-9A-Za-z]+", text) if w.lower() in (
            "zorblax", "room77", "55443")] if 100 <= i < 104 else []
        assert [w for w, _ in added if w != "and"] == hidden
        assert all(kind == ("generalise" if w.lower() == "zorblax" else "remove")
                   for w, kind in added)


def test_thresholds(documents):
    docs = documents(corpus())
    few = S.sanitisation(docs, support=5).where("size(added) > 0").count()
    many = S.sanitisation(docs, generalise=0.1, remove=2.0)
    assert few == 0
    assert {s.kind for r in many.collect() for s in r.added} == {"generalise"}


def test_spans_as_text(spark, documents):
    from pyspark.sql import functions as F
    row = S.sanitisation(documents([(1, "+1 (499) 555-6503 or 4111 1111 1111 1111 a@b.c 1.2.3.4")])) \
        .select(S.span_text(F.concat("base", "added")).alias("t")).first()
    kinds = [part.split(":")[0] for part in row.t.split(",")]
    assert kinds == ["phone", "card", "email", "ip"]
    assert S.sanitisation(documents([(1, None)])).select(
        S.span_text(F.col("base")).alias("t")).first().t == ""


def test_no_documents(documents):
    assert S.sanitisation(documents([])).count() == 0


def test_a_task_has_one_worker(documents):
    """What sieves the texts and what looks for terms in them are stages of their own."""
    plan = S.sanitisation(documents(corpus()))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
