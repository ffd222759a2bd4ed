import os
import time
from datetime import timedelta

import pytest
from comments import T0, comment, frame
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from voxlake.operators import reports as R
from voxlake.plans.ingestion import ingest_lines
from voxlake.sources import records as REC
from voxlake.sources import tables as TAB
from voxlake.streaming import pipeline as P
from voxlake.streaming.replay import replay_counts, replayed_messages, start_replay


def lines(spark, rows, broken=()):
    return [*[r.value for r in REC.keyed_messages(frame(spark, rows)).collect()], *broken]


def post(spark, folder, n, rows, broken=()):
    folder.mkdir(exist_ok=True)
    file = folder / f"{n:04}.txt"
    file.write_text("\n".join(lines(spark, rows, broken)))
    os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))


def test_broken_lines_are_counted(spark, tmp_path):
    rows = lines(spark, [comment("a"), comment("b"), comment("orphan", is_reply=True)], ["{bad", "", "[1]"])
    frame_ = spark.createDataFrame([(r,) for r in rows], "value string")
    out = str(tmp_path / "out")
    for _ in range(2):
        assert ingest_lines(frame_, out, skip_invalid=True) == {
            "incoming": 5, "published": 2, "quarantined": 1, "broken": 2}
    assert {r.value for r in spark.read.text(f"{out}/broken").collect()} == {"{bad", "[1]"}
    with pytest.raises(PySparkException, match="broken line"):
        ingest_lines(frame_.filter("value not like '%orphan%'"), str(tmp_path / "strict"))


def test_a_replay_goes_on_where_it_was_killed(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for n in range(5):
        post(spark, source, n, [comment(f"{n}a"), comment(f"{n}b")], ["{bad"] if n % 2 else [])
    calls = []

    query = start_replay(spark, str(source), out, skip_invalid=True, every="0 seconds")
    until = time.monotonic() + 120
    while query.lastProgress is None and time.monotonic() < until:
        time.sleep(0.02)
    query.stop()  # in the middle of an epoch, as likely as not
    calls += [p.batchId for p in query.recentProgress]
    start_replay(spark, str(source), out, skip_invalid=True, once=True).awaitTermination()
    start_replay(spark, str(source), out, skip_invalid=True, once=True).awaitTermination()
    counts = replay_counts(spark, out).collect()
    assert sorted(r.epoch for r in counts) == [0, 1, 2, 3, 4]
    assert (sum(r.incoming for r in counts), sum(r.published for r in counts),
            sum(r.broken for r in counts)) == (12, 10, 2)
    assert sorted(r.key for r in replayed_messages(spark, out).collect()) == sorted(
        f"{n}{x}" for n in range(5) for x in "ab")


def test_a_graceful_stop_ends_the_epoch(spark, layout, tmp_path):
    folder = tmp_path / "in"
    for n in range(4):
        post(spark, folder, n, [comment(f"{n}")])
    TAB.ensure_tables(spark, layout)
    stream = P.message_stream(spark, path=str(folder), maxFilesPerTrigger="1")
    first = P.start_bronze(stream, layout)
    until = time.monotonic() + 120
    while first.lastProgress is None and time.monotonic() < until:
        time.sleep(0.02)
    P.stop_gracefully([first])
    done = {p.batchId for p in first.recentProgress}
    again = P.start_bronze(stream, layout, once=True)
    again.awaitTermination()
    repeated = done & {p.batchId for p in again.recentProgress if p.numInputRows}
    assert not repeated and not first.isActive
    ids = [r.comment_id for r in spark.read.parquet(layout.bronze).collect()]
    assert sorted(ids) == ["0", "1", "2", "3"]


def test_databases(spark, layout):
    from dataclasses import replace
    layout = replace(layout, database="some_lake")
    TAB.ensure_tables(spark, layout)
    TAB.register_tables(spark, layout)
    try:
        assert "some_lake" in {r[0] for r in TAB.list_databases(spark).collect()}
        TAB.use_database(spark, "some_lake")
        assert spark.sql(f"SELECT count(*) n FROM {layout.silver_name}").first().n == 0
    finally:
        TAB.use_database(spark, "default")
        spark.sql("DROP DATABASE some_lake CASCADE")


def test_top_liked(spark, tmp_path):
    rows = spark.createDataFrame(
        [("v", "a", 5), ("v", "b", 5), ("v", "c", 5), ("v", "d", 9), ("w", "e", None), ("w", "f", 1)],
        "video_id string, comment_id string, like_count int").withColumn("event_time", F.lit(T0))
    top = {(r.comment_id, r.rank) for r in R.top_liked_comments(rows, 2).collect()}
    assert top == {("d", 1), ("a", 2), ("f", 1), ("e", 2)}
    ties = {(r.comment_id, r.rank) for r in R.top_liked_comments(rows, 2, keep_ties=True).collect()}
    assert ties == {("d", 1), ("a", 2), ("b", 2), ("c", 2), ("f", 1), ("e", 2)}


def test_a_giant_video_costs_k_rows_a_task(spark, tmp_path):
    path = str(tmp_path / "giant")
    (spark.range(40_000, numPartitions=4).select(
        F.lit("v").alias("video_id"), F.col("id").cast("string").alias("comment_id"),
        (F.col("id") % 1000).cast("int").alias("like_count"), F.lit(T0).alias("event_time"))
     .write.parquet(path))
    top = R.top_liked_comments(spark.read.parquet(path), 3)
    assert top.count() == 3
    plan = top._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(video_id"):]
    assert "WindowGroupLimit" in below.splitlines()[1]  # thinned before the shuffle


def test_trend_counts_a_late_row_in_batch_and_drops_it_in_a_stream(spark, tmp_path):
    schema = "comment_id string, event_time timestamp, sentiment string, like_count int"

    def rows(*days):
        return spark.createDataFrame(
            [(str(d), T0 + timedelta(days=d), "positive", 2) for d in days], schema)

    folder, out = str(tmp_path / "s"), str(tmp_path / "o")
    for days in ([0, 0], [6], [0, 5], [9]):  # the second 0 is late: the watermark is at day 4
        rows(*days).coalesce(1).write.mode("append").parquet(folder)
        stream = P.sentiment_trend_stream(spark.readStream.schema(schema).parquet(folder))
        (stream.writeStream.format("parquet").option("checkpointLocation", f"{out}_c")
         .trigger(availableNow=True).start(out).awaitTermination())
    closed = {(r.window_start.day, r.comment_count) for r in spark.read.parquet(out).collect()}
    assert closed == {(T0.day, 2), (T0.day + 5, 1), (T0.day + 6, 1)}
    whole = {(r.window_start.day, r.comment_count)
             for r in R.sentiment_trend(spark.read.parquet(folder)).collect()}
    assert whole == {(T0.day, 3), (T0.day + 5, 1), (T0.day + 6, 1), (T0.day + 9, 1)}
