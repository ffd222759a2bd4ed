from datetime import timedelta

from comments import T0, comment, frame
from pyspark.sql import functions as F

from voxlake.functions import cleaning as C
from voxlake.operators.cleaning import clean_comments, clean_fields


def test_blank_text_becomes_the_default(one):
    assert one(C.blank_to, [" \t ", None, " a \n b "]) == [None, None, "a b"]
    assert one(lambda x: C.blank_to(x, "unknown"), [" \t ", None]) == ["unknown", "unknown"]


def test_no_break_spaces_stay(one):
    assert one(C.normalize_text, ["a\u00a0\u00a0b"]) == ["a\u00a0\u00a0b"]


def test_normalize_text_removes_links_and_blanks(one):
    assert one(C.normalize_text, ["See HTTPS://A.b/c?x now\r\n\twww.x.y !", None]) == [
        "see now !", ""]


def test_numbers_and_flags(one):
    assert one(C.non_negative, [-1, None, 3], "int") == [0, 0, 3]
    assert one(C.parse_bool, ["1", " YES ", "on", "off", "", None]) == [
        True, True, True, False, False, False]
    assert one(C.number_is_true, [0, 2, None], "int") == [False, True, False]


def test_collection_is_never_before_the_event(spark):
    early, missing = T0 - timedelta(hours=1), None
    rows = clean_fields(frame(spark, [comment("1", collected_at=early),
                                      comment("2", collected_at=missing), comment("3")]))
    assert [r.collected_delay_seconds for r in rows.orderBy("comment_id").collect()] == [0, 0, 2]


def test_admission(spark):
    rows = [
        comment("kept"),
        comment("reply", is_reply=True, parent_comment_id="kept"),
        comment("orphan", is_reply=True),
        comment("blank parent", is_reply=True, parent_comment_id=" "),
        comment("parent on top", parent_comment_id="kept"),
        comment("link only", text=" https://a.b/c \n WWW.d.e"),
        comment("link and word", text="xhttps://a.b/c"),
        comment("blank", text=" \n "),
        comment("no text", text=None),
        comment(" "),
        comment("no time", event_time=None),
        comment("no video", video_id="\t"),
        comment("no flag", is_reply=None, author=" ", lang=None, source=" API "),
    ]
    kept = {r.comment_id: r for r in clean_comments(frame(spark, rows)).collect()}
    assert set(kept) == {"kept", "reply", "parent on top", "link and word", "no flag"}
    assert kept["parent on top"].parent_comment_id is None
    assert kept["link and word"].text_clean == "x"
    odd = kept["no flag"]
    assert (odd.is_reply, odd.author, odd.lang, odd.source) == (False, "unknown", "unknown", "api")


def test_admission_equals_a_filter_on_the_cleaned_rows(spark):
    texts = ["", " ", "https://", "https:// a", "www.", "www.x", "a www.x", "http://x\u00a0y",
             "\u00a0", "HTTP://Q", "x http://y", "\x0b", "www.www.www", "https://https://a b"]
    raw = frame(spark, [comment(str(i), text=t) for i, t in enumerate(texts)])
    expected = {r.comment_id for r in clean_fields(raw).filter(
        F.col("text").isNotNull() & (F.length("text_clean") > 0)).collect()}
    assert {r.comment_id for r in clean_comments(raw).collect()} == expected


def test_the_texts_are_cleaned_once(spark):
    raw = frame(spark, [comment("1")])
    plan = clean_comments(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("www") == 2  # once to admit, once to clean
