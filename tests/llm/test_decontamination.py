import re

from tests.llm.conftest import by_id
from voxlake.llm import decontamination as D


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_force(rows, items):
    out = {}
    for i, text in rows:
        own, hit, found = words(text), set(), set()
        for item, passage in items:
            theirs = words(passage)
            size = min(10, len(theirs))
            windows = {tuple(theirs[k:k + size]) for k in range(len(theirs) - size + 1)} \
                if size else set()
            for k in range(len(own) - size + 1):
                if tuple(own[k:k + size]) in windows:
                    hit.update(range(k, k + size))
                    found.add(item)
        out[i] = (len(own), len(hit), sorted(found))
    return out


def check(spark, documents, rows, items):
    benchmark = spark.createDataFrame([(i, t, "x", "y") for i, t in items],
                                      "item_id long, text string, words string, n string")
    result = D.contamination(documents(rows), benchmark).withColumn("n_hit", D.covered("ranges"))
    found = by_id(result)
    assert {i: (r.n_words, r.n_hit, list(r["items"])) for i, r in found.items()} \
        == brute_force(rows, items)


def test_passages_short_items_and_odd_texts(spark, documents, prose):
    item, other = prose(40, 1), prose(12, 2)
    items = [(1, item), (2, other), (3, "Two words"), (4, "solo"), (5, None), (6, ""), (7, "?! ."),
             (8, item), (9, prose(10, 3)), (10, "a b c d e f g h i j k"), (11, "the " * 15)]
    clean = prose(300, 4)
    rows = [
        (1, clean), (2, None), (3, ""), (4, "..."), (5, clean + " " + item.upper() + " " + clean),
        (6, " ".join(item.split()[5:15])), (7, " ".join(item.split()[5:14])),
        (8, other.replace(" ", ", ")), (9, "say TWO, words twice: two words"), (10, "solo"),
        (11, "a b c d e f g h i j k a b c d e f g h i j"), (12, "the " * 40),
        (13, prose(20_000, 5) + " " + other), (14, item), (15, item), (16, "two two words")]
    check(spark, documents, rows, items)


def test_no_items_no_documents(spark, documents, prose):
    check(spark, documents, [(1, prose(30))], [])
    check(spark, documents, [(1, prose(30))], [(1, None), (2, " ")])
    check(spark, documents, [], [(1, prose(30))])


def test_the_rarest_shingle_is_the_prefix(spark, documents):
    text = "p q r s t u v w x y"
    rows = [(1, text)] + [(i, "p q r s t") for i in range(2, 9)] + [(20, "u v w x y")]
    windows = D.item_windows(spark.createDataFrame([(1, text)], "item_id long, text string"))
    docs = documents(rows)
    counts = D.shingle_counts(docs.select("text"), __import__("numpy").full(
        1 << 17, 2 ** 64 - 1, dtype="uint64"), [3])
    (row,) = D.prefixes(windows, counts).collect()
    assert row.place in (3, 4)  # s t u and t u v stand in one document alone
