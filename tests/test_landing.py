import json
from datetime import date, timedelta
from pathlib import Path

import pytest
from comments import T0, comment, frame
from pyspark.sql import functions as F

from voxlake.operators import dedup as D
from voxlake.operators import gold as G
from voxlake.plans import lakehouse as L
from voxlake.plans import landing as N
from voxlake.schemas import BRONZE, BRONZE_STORED, GOLD_BREAKDOWN, GOLD_SUMMARY
from voxlake.sources import swaps as S
from voxlake.sources import tables as TAB
from voxlake.streaming import late as LATE

DAY = timedelta(days=1)


def stamped(spark, rows):
    return frame(spark, rows).withColumn("ingested_at", F.lit("2026-05-01").cast("timestamp"))


def build(spark, layout, rows, batch):
    L.build_lakehouse(spark, stamped(spark, rows), layout, batch=batch)


def stored(spark, layout):
    return {r.comment_id: (r.text, r.sentiment, r.landed_in)
            for r in N.silver_table(spark, layout).collect()}


def check_gold(spark, layout):
    """Gold is that of the whole Silver."""
    silver = N.silver_table(spark, layout)
    for path, schema, full in ((layout.summary, GOLD_SUMMARY, G.gold_summary),
                               (layout.breakdown, GOLD_BREAKDOWN, G.gold_breakdown)):
        made = TAB.read_table(spark, path, schema)
        assert sorted(map(str, made.collect())) == sorted(map(str, full(silver).collect()))


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


@pytest.mark.parametrize("names", [["in/a", "in_a", "in a", "in%2Fa", "IN/a"], ["001", "1", "1.0"],
                                   ["ä=b", "ä:b", "{x}", "[x]", "x?", "é"]])
def test_names_never_share_a_folder(spark, layout, names):
    for i, name in enumerate(names):
        TAB.ensure_tables(spark, layout)
        L.land_records(stamped(spark, [comment(str(i))]), layout, name)
    rows = TAB.read_table(spark, layout.bronze, BRONZE_STORED).collect()
    assert {r.batch_id: r.comment_id for r in rows} == {n: str(i) for i, n in enumerate(names)}
    with pytest.raises(ValueError):
        TAB.batch_name("")


def test_batches_of_odd_names_reach_silver(spark, layout):
    build(spark, layout, [comment("1", "good")], "in/a")
    build(spark, layout, [comment("2", "bad")], "in_a")
    assert {k: v[2] for k, v in stored(spark, layout).items()} == {"1": "in/a", "2": "in_a"}
    entries = {r.batch_id: (r.rows, r.done) for r in L.manifest(spark, layout).collect()}
    assert entries == {"in/a": (1, True), "in_a": (1, True)}
    check_gold(spark, layout)


def test_a_corrected_batch_replaces_its_rows(spark, layout):
    build(spark, layout, [comment("1", "good"), comment("2", "bad"),
                          comment("3", "ok", event_time=T0 + DAY, collected_at=T0 + DAY)], "one")
    build(spark, layout, [comment("2", "great"), comment("4", "poor")], "two")
    assert stored(spark, layout)["2"] == ("bad", "negative", "one")
    build(spark, layout, [comment("1", "awful")], "one")  # 2 and 3 are gone
    assert stored(spark, layout) == {"1": ("awful", "neutral", "one"), "4": ("poor", "negative", "two"),
                                     "2": ("great", "positive", "two")}
    check_gold(spark, layout)  # the day that had only 3 is gone from Gold
    build(spark, layout, [comment("4", "good")], "two")  # its row in the piece of batch one goes too
    assert stored(spark, layout) == {"1": ("awful", "neutral", "one"),
                                     "4": ("good", "positive", "two")}
    check_gold(spark, layout)


def test_the_same_content_changes_nothing(spark, layout):
    rows = [comment("1", "good"), comment("2", "bad")]
    build(spark, layout, rows, "one")
    before = files(layout.silver) | files(layout.summary)
    build(spark, layout, rows[::-1], "one")
    assert files(layout.silver) | files(layout.summary) == before


def test_a_run_after_a_failure_refreshes_what_changed(spark, layout, monkeypatch):
    build(spark, layout, [comment("1", "good"),
                          comment("2", "ok", event_time=T0 + DAY, collected_at=T0 + DAY)], "one")

    def fail(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as patched:
        patched.setattr(L, "merge_gold", fail)
        with pytest.raises(RuntimeError):
            build(spark, layout, [comment("1", "bad")], "one")
    assert TAB.read_table(spark, layout.summary, GOLD_SUMMARY).count() == 2  # not yet
    build(spark, layout, [comment("1", "bad")], "one")
    check_gold(spark, layout)


def test_a_swap_that_was_cut_off_is_finished(spark, layout, tmp_path):
    root = str(tmp_path / "r")
    for name in ("new", "old", "gone"):
        Path(root, name).mkdir(parents=True)
        Path(root, name, "f").write_text(name)
    journal = Path(root, "_swaps", "x.json")
    journal.parent.mkdir()
    journal.write_text(json.dumps({"moves": [[f"{root}/new", f"{root}/old"]], "drops": [f"{root}/gone"]}))
    Path(root, "_swaps", "cut.json").write_text('{"moves": [["')
    for _ in range(2):
        S.finish_swaps(spark, root)
        assert Path(root, "old", "f").read_text() == "new"
        assert not Path(root, "gone").exists() and not list(journal.parent.glob("*.json"))


def test_gold_is_merged_without_silver(spark, layout):
    build(spark, layout, [comment("1", "good"), comment("2", "bad", author="bob")], "one")
    Path(layout.silver).rename(layout.silver + "-away")  # old pieces cannot be read
    more = [comment("3", "poor", author="bob"), comment("4", "great", author="cy", is_reply=True,
                                                        parent_comment_id="1")]
    rows = L.silver_at_rest(L.silver_comments(stamped(spark, more)), "two")
    landing = N.Landing(spark, layout)
    landing.replace_batch(rows, "two")
    landing.finish()
    N.merge_gold(spark, layout, [T0.date()])
    for path in Path(layout.silver + "-away").iterdir():
        path.rename(Path(layout.silver, path.name))
    check_gold(spark, layout)
    only, = TAB.read_table(spark, layout.summary, GOLD_SUMMARY).collect()
    assert (only.total_comments, only.unique_author_count) == (4, 3)


def test_compaction_keeps_rows_and_origin(spark, layout):
    for i, name in enumerate(("a", "b", "c")):
        build(spark, layout, [comment(str(i), "good"), comment(
            f"late{i}", "bad", event_time=T0 + DAY, collected_at=T0 + DAY)], name)
    before, gold = stored(spark, layout), files(layout.summary)
    assert N.compact_silver(spark, layout, T0.date()) == []
    assert N.compact_silver(spark, layout, (T0 + DAY).date()) == [T0.date()]
    assert stored(spark, layout) == before and files(layout.summary) == gold
    pieces = N.pieces_of(N.silver_table(spark, layout))
    assert len([p for p in pieces if p[1] == T0.date()]) == 1 and len(pieces) == 4
    N.merge_gold(spark, layout, [T0.date(), (T0 + DAY).date()])
    check_gold(spark, layout)
    build(spark, layout, [comment("1", "awful")], "b")  # a batch whose rows are compacted
    assert stored(spark, layout) == {**{k: v for k, v in before.items() if k != "late1"},
                                     "1": ("awful", "neutral", "b")}
    check_gold(spark, layout)
    assert N.compact_silver(spark, layout, date(2030, 1, 1)) != []
    assert N.compact_silver(spark, layout, date(2030, 1, 1)) == []
    check_gold(spark, layout)


def test_a_replayed_epoch_changes_nothing(spark, layout):
    build(spark, layout, [comment("1", "good")], "batch")
    rows = L.silver_at_rest(L.silver_comments(stamped(spark, [comment("1", "bad"), comment("2", "bad")])))
    for _ in range(2):
        N.land_epoch(rows, layout, "q", 7)
        assert {k: v[2] for k, v in stored(spark, layout).items()} == {"1": "batch", "2": "q-7"}


def test_parts_of_a_lake_that_has_none(spark, layout):
    build(spark, layout, [comment("1", "good"), comment("2", "bad")], "one")
    build(spark, layout, [comment("3", "good")], "two")
    for path in (layout.sums, layout.authors):
        S.drop(spark, path)
    N.rebuild_parts(spark, layout)
    N.merge_gold(spark, layout, [T0.date()])
    check_gold(spark, layout)


def test_corrections_touch_only_their_pieces(spark, layout):
    build(spark, layout, [comment("1", "good"), comment("2", "bad")], "one")
    build(spark, layout, [comment("3", "good"), comment(
        "4", "good", event_time=T0 + DAY, collected_at=T0 + DAY)], "two")
    before = files(layout.silver)
    fixes = spark.createDataFrame([("3", "negative"), ("9", "positive"), ("3", "positive")],
                                  "comment_id string, sentiment string")
    for _ in range(2):
        assert N.correct_silver(spark, layout, fixes) == [T0.date()]
        assert {k: v[1] for k, v in stored(spark, layout).items()} == {
            "1": "positive", "2": "negative", "3": "negative", "4": "positive"}
        check_gold(spark, layout)
    changed = {f for f in before.items() if f not in set(files(layout.silver).items())}
    assert len(changed) == 1 and "batch_id=two/event_date=2026-04-11" in changed.pop()[0]
    assert N.correct_silver(spark, layout, fixes.where("comment_id = '9'")) == []


@pytest.mark.parametrize("words", [1 << 10, D.WORDS])
def test_a_sieve_loses_no_key_and_passes_few_others(spark, words):
    rows = spark.range(200_000).select(F.col("id").cast("string").alias("video_id"),
                                       (F.col("id") % 7).cast("string").alias("comment_id"))
    asked = rows.where("cast(video_id as long) % 500 = 3")
    passed = D.sieved(rows, asked, words=words)
    assert passed.join(asked, list(D.KEYS), "left_semi").count() == 400
    assert passed.count() <= 400 + 200_000 * (2 * 400 / (64 * words)) ** 2 * 2 + 20
    assert D.sieved(rows, asked.where("false"), words=words).count() == 0


def test_words_follow_the_keys():
    assert D.sieve_words(0) == D.sieve_words(100) == 1 << 10
    assert D.sieve_words(100_000) == 1 << 15 and D.sieve_words(10**12) == D.WORDS


def test_late_rows_are_kept_and_counted(spark, layout):
    TAB.ensure_tables(spark, layout)

    def epoch(n, *rows):
        LATE.split_epoch(stamped(spark, rows).select(*BRONZE.names), layout, "q", n)

    def at(key, days):
        moment = T0 + days * DAY
        return comment(key, event_time=moment, collected_at=moment)

    epoch(0, at("a", 0), at("b", 5))
    epoch(1, at("c", 2), at("d", 3), at("b", 5), comment("e", event_time=None, collected_at=None))
    for _ in range(2):  # repeated, also after a later one
        assert set(stored(spark, layout)) == {"a", "b", "d"}
        assert [r.comment_id for r in LATE.late_table(spark, layout).collect()] == ["c"]
        counts = {r.epoch: (r.rows, r.late) for r in LATE.progress(spark, layout).collect()}
        assert counts == {0: (2, 0), 1: (4, 1)}
        epoch(1, at("c", 2), at("d", 3), at("b", 5), comment("e", event_time=None, collected_at=None))


def test_sketches_of_pieces_unite(spark, layout):
    for i in range(2):
        build(spark, layout, [comment(f"{i}-{k}", author=f"a{(i + 1) * k}", event_time=T0 + 7 * i * DAY,
                                      collected_at=T0 + 7 * i * DAY) for k in range(30)], f"b{i}")
    sketches = spark.read.parquet(layout.sketches)
    by_month = G.distinct_estimates(sketches, "month").first()
    exact = G.distinct_exact(TAB.read_table(spark, layout.authors, N.GOLD_AUTHORS), "month").first()
    assert (exact.videos, exact.authors) == (1, 45)
    assert by_month.approx_videos == 1 and abs(by_month.approx_authors - 45) <= 2


def test_files_follow_dates_only_where_a_table_is_kept_by_date(spark, layout):
    """A date is one file of Silver and of Gold, whoever dealt the rows; what serves Gold has none."""
    TAB.ensure_tables(spark, layout)
    rows = [comment(f"{day}-{k}", event_time=T0 + day * DAY, collected_at=T0 + day * DAY)
            for day in range(40) for k in range(6)]
    dealt = stamped(spark, rows).repartition(6)
    N.land_epoch(L.silver_at_rest(L.silver_comments(dealt)), layout, "q", 0)
    assert len(files(layout.silver)) == 40
    for path in (layout.sums, layout.authors, layout.sketches):
        assert len(files(path)) <= 4
        assert TAB.read_table(spark, path, N._SCHEMAS[path.rpartition("/")[2]]).count() == 40
    N.merge_gold(spark, layout, [(T0 + day * DAY).date() for day in range(40)])
    assert len(files(layout.summary)) == len(files(layout.breakdown)) == 40
    assert len({Path(f).name.split("-")[1] for f in files(layout.summary)}) > 1  # more than one task
    check_gold(spark, layout)
    LATE.split_epoch(stamped(spark, [comment(f"l{r[2]}", event_time=r[0], collected_at=r[1])
                                     for r in rows]).repartition(6).select(*BRONZE.names), layout, "r", 0)
    assert len(files(layout.silver)) == 80


def test_a_piece_that_changes_leaves_what_serves_the_others(spark, layout):
    build(spark, layout, [comment(str(k), "good", event_time=T0 + k * DAY, collected_at=T0 + k * DAY)
                          for k in range(3)], "one")
    fixes = spark.createDataFrame([("1", "negative")], "comment_id string, sentiment string")
    assert N.correct_silver(spark, layout, fixes) == [(T0 + DAY).date()]
    N.merge_gold(spark, layout, [(T0 + k * DAY).date() for k in range(3)])
    check_gold(spark, layout)
    sums = TAB.read_table(spark, layout.sums, N.GOLD_SUMS).collect()
    assert sorted((r.event_date, r.sentiment) for r in sums) == [
        ((T0 + k * DAY).date(), "negative" if k == 1 else "positive") for k in range(3)]


def test_estimates_are_within_their_bound(spark):
    rows = spark.range(200_000).select(
        F.lit(T0.date()).alias("event_date"), F.col("id").cast("string").alias("author"),
        (F.col("id") % 20_000).cast("string").alias("video_id"),
        (F.col("id") % 8).alias("piece"))
    found = G.distinct_estimates(G.day_sketches(rows, ("event_date", "piece"))).first()
    assert abs(found.approx_authors - 200_000) < 0.05 * 200_000
    assert abs(found.approx_videos - 20_000) < 0.05 * 20_000
