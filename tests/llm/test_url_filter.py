from pyspark.sql import functions as F

from tests.llm.conftest import by_id
from voxlake.llm import url_filter as U

RULES = [U.Rule("allow", "org", "/"), U.Rule("block", "example.org", "/es/"),
         U.Rule("block", "example.org", "/en/1")]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)],
                                 "page_id long, url string, key string, host string")


def test_parts_and_rules(spark):
    urls = ["http://A.Example.ORG/es/x?q", "https://example.org", "https://example.org/en/12#t",
            "https://example.org/en/2", None, "no scheme", "x://notexample.org/es/1", "://", "",
            "http://h?x=1://y/z", "http://É.net/Ä"]
    found = by_id(U.url_verdicts(pages(spark, urls), F.lit(False), RULES), "page_id")
    assert [(r.host, r.path, r.rule, r.verdict) for _, r in sorted(found.items())] == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "", None, "allow"),
        ("example.org", "/en/12", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("notexample.org", "/es/1", "org/", "allow"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("h", "", None, "allow"), ("É.net", "/Ä", None, "allow")]


def test_the_cascade_is_exact(spark):
    for parts, every in ((1000, 7), (50, 3), (1000, 1000), (1000, 1)):
        urls = [f"http://h{i % 40}.com/{i}" for i in range(400)]
        listing = F.col("page_id") % every == 0
        found = U.url_verdicts(pages(spark, urls), listing, [], keys_per_cascade=parts)
        assert {i: r.verdict for i, r in by_id(found, "page_id").items()} == {
            i: "block" if i % every == 0 else "allow" for i in range(400)}


def test_an_address_is_listed_for_all_its_rows(spark):
    found = U.url_verdicts(pages(spark, ["a://b/c?1", "a://b/c?2", "a://b/d", None]),
                           F.col("url").endswith("1"), [])
    assert [r.verdict for _, r in sorted(by_id(found, "page_id").items())] == [
        "block", "block", "allow", "allow"]


def test_no_pages(spark):
    assert U.url_verdicts(pages(spark, []), F.lit(True), RULES).count() == 0


def test_nothing_but_expressions(spark):
    plan = U.url_verdicts(pages(spark, ["a://b/c"]), F.lit(True), RULES) \
        ._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Join"))
