import json

import pytest
from comments import T0, comment, frame
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voxlake.functions import web as W
from voxlake.operators import validation as VAL
from voxlake.operators.corrections import apply_corrections
from voxlake.operators.threads import flatten_threads
from voxlake.plans.ingestion import prepare_messages
from voxlake.sources import records as REC


def messages(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


RECORD = {"event_time": "2026-04-11T09:00:01Z", "collected_at": "2026-04-11T09:00:03Z",
          "comment_id": "c1", "video_id": "v", "author": "a", "text": "hi", "like_count": 1,
          "reply_count": 0, "is_reply": False, "parent_comment_id": None, "lang": "vi",
          "source": "s"}


def test_bronze_admits_well_formed_records_only(spark):
    raw = messages(spark, [json.dumps(RECORD), "{bad", "", None, "[1]", "7", "{}",
                           json.dumps({**RECORD, "comment_id": "c2", "like_count": "many"}),
                           json.dumps({"like_count": "many"})])
    bronze = {r.comment_id: r for r in REC.bronze_rows(raw).collect()}
    assert bronze["c1"].event_time == T0.replace(second=1) and bronze["c1"].ingested_at
    assert bronze["c2"].like_count is None and bronze["c2"].text == "hi"
    assert {r.value for r in REC.malformed_rows(raw).collect()} == {"{bad", "[1]", "7"}


def test_messages_are_parsed_once(spark):
    plan = REC.bronze_rows(messages(spark, ["{}"]))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json") == 1


def test_keyed_messages_read_back(spark):
    rows = frame(spark, [comment("c1", text='a "q"\nb'), comment(None)])
    out = REC.keyed_messages(rows)
    assert {r.key for r in out.collect()} == {"c1", "no-key"}
    assert REC.bronze_rows(out).drop("ingested_at").exceptAll(rows).isEmpty()


def test_json_lines_skip_blank_lines(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text(json.dumps(RECORD) + "\n\n{bad\n" + json.dumps(RECORD) + "\n")
    assert REC.read_json_lines(spark, str(tmp_path / "f.jsonl")).count() == 2


def test_defaults(spark):
    raw = spark.createDataFrame(
        [("2026", None, "", None, " Yes ", "", " t "), ("2026", "2027", "s", "3", "no", "4", None)],
        "event_time string, collected_at string, source string, like_count string, "
        "is_reply string, reply_count string, text string"
    ).withColumn("lang", F.lit(None).cast("string"))
    first, second = VAL.with_defaults(raw, "files").orderBy("like_count").collect()
    assert (first.collected_at, first.source, first.lang, first.like_count, first.reply_count,
            first.is_reply, first.text) == ("2026", "files", "unknown", 0, 0, True, "t")
    assert (second.collected_at, second.like_count, second.reply_count, second.is_reply,
            second.text) == ("2027", 3, 4, False, "")


def test_reasons_and_quarantine(spark):
    rows = frame(spark, [
        comment("ok"), comment("orphan", is_reply=True), comment("top", parent_comment_id="x"),
        comment("early", event_time=T0.replace(hour=10)), comment("", author=None),
        comment("other", video_id="v2")])
    found = {r.comment_id: r.reasons for r in VAL.with_reasons(rows, "v1").collect()}
    assert found == {
        "ok": [], "orphan": ["reply without parent"], "top": ["parent on a non-reply"],
        "early": ["collected before event"], "": ["missing comment_id", "missing author"],
        "other": ["unexpected video"]}
    valid, quarantined = VAL.split_valid(rows)
    assert (valid.count(), quarantined.count()) == (2, 4)
    assert VAL.ingestion_counts(rows).collect() == [(2, 4)]
    assert VAL.require_valid(valid).count() == 2
    with pytest.raises(PySparkException, match="invalid record"):
        VAL.require_valid(rows).collect()


def test_threads(spark, tmp_path):
    def snippet(**more):
        return {"publishedAt": "2026-04-11T09:00:00Z", **more}

    page = {"items": [
        {"snippet": {"topLevelComment": {"id": "t1", "snippet": snippet(
            videoId="v1", authorDisplayName="ann", textOriginal=" a &lt; b ", textDisplay="no",
            likeCount=3)}, "totalReplyCount": 1},
         "replies": {"comments": [{"id": "r1", "snippet": snippet(
             textOriginal="", textDisplay="x &amp; y", parentId="t1")}]}},
        {"snippet": {"topLevelComment": {"id": "t2", "snippet": snippet(textDisplay="z")}}}]}
    (tmp_path / "p.json").write_text(json.dumps(page) + "\n" + json.dumps({"items": []}) + "\n")
    rows = flatten_threads(REC.read_api_pages(spark, str(tmp_path / "p.json")),
                           expected_video="vx").collect()
    found = {r.comment_id: (r.video_id, r.author, r.text, r.like_count, r.reply_count, r.is_reply,
                            r.parent_comment_id) for r in rows}
    assert found == {"t1": ("v1", "ann", "a < b", 3, 1, False, None),
                     "r1": ("vx", "unknown", "x & y", 0, 0, True, "t1"),
                     "t2": ("vx", "unknown", "z", 0, 0, False, None)}


@pytest.mark.parametrize("link, key", [
    ("https://youtu.be/abc/def?x=1", "abc"),
    ("https://www.youtube.com/watch?a=b&v=XyZ%2B&t=1#k", "XyZ+"),
    ("https://www.youtube.com/watch?v=&x=1", "https://www.youtube.com/watch"),
    ("youtu.be/abc?x", "youtu.be/abc"),
    (" abc&d?e ", "abc"),
    ("", ""),
])
def test_video_key(one, link, key):
    assert one(W.video_key, [link]) == [key]


def test_entities(one):
    texts = ["&lt;a&gt; &copy; &amp;lt; &hellip; &#39;", "no", None]
    assert one(W.unescape_entities, texts) == ["<a> © &lt; … '", "no", None]
    assert one(W.unescape_basic_entities, ["&lt;&amp;lt;"]) == ["<&lt;"]


def test_corrections_do_not_multiply_rows(spark):
    rows = spark.createDataFrame([("a", "neutral"), ("b", "neutral")], "comment_id string, sentiment string")
    fixes = spark.createDataFrame([("a", "positive"), ("a", "negative"), ("z", "positive")],
                                  rows.schema)
    assert sorted(map(tuple, apply_corrections(rows, fixes).collect())) == [
        ("a", "negative"), ("b", "neutral")]


def test_lexicon_file(spark, tmp_path):
    path = tmp_path / "slang.json"
    path.write_text(json.dumps([{"term": "W", "normalized": " win ", "sentiment_hint": "positive"},
                                {"term": "big w", "normalized": "great win"}, {"term": " "}]))
    assert [(t.term, t.replacement) for t in REC.read_slang(spark, str(path))] == [
        ("big w", "great win"), ("w", "win")]
    with pytest.raises(PySparkException):
        REC.read_slang(spark, str(tmp_path / "missing.json"))


def test_ingestion(spark, tmp_path):
    rows = frame(spark, [comment("a"), comment("a"), comment("b"), comment("orphan", is_reply=True)])
    landed = spark.createDataFrame([("b",)], "comment_id string")
    messages, quarantined = prepare_messages(rows, landed, skip_invalid=True)
    REC.publish(messages, "json", path=str(tmp_path / "out"))
    assert [r.key for r in spark.read.json(str(tmp_path / "out")).collect()] == ["a"]
    assert [(r.comment_id, r.reasons) for r in quarantined.collect()] == [
        ("orphan", ["reply without parent"])]
    strict, nothing = prepare_messages(rows)
    assert nothing is None
    with pytest.raises(PySparkException, match="orphan: reply without parent"):
        strict.collect()
