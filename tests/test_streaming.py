import json
import os
from datetime import datetime, timedelta

import pytest
from comments import T0, comment, frame
from pyspark.sql import functions as F

from voxlake.operators import gold as G
from voxlake.operators import quality as Q
from voxlake.operators.scoring import KeywordPredictor, Scorer
from voxlake.plans.lakehouse import build_lakehouse, land_records, silver_comments
from voxlake.schemas import BRONZE, GOLD_BREAKDOWN, GOLD_SUMMARY, RECORD, SILVER_STORED
from voxlake.sources import records as REC
from voxlake.sources import tables as TAB
from voxlake.sources.swaps import children
from voxlake.streaming import pipeline as P
from voxlake.streaming.dedup import dedup_stream

KEPT = [n for n in RECORD.names] + ["text_clean", "text_length", "collected_delay_seconds",
                                    "positive_score", "negative_score", "sentiment"]


def post(spark, folder, rows, broken=()):
    """Put messages into the source folder, as one more file."""
    folder.mkdir(exist_ok=True)
    lines = [r.value for r in REC.keyed_messages(frame(spark, rows)).collect()]
    (folder / f"{len(list(folder.iterdir())):04}.txt").write_text("\n".join([*lines, *broken]))


def texts(rows):
    return sorted(map(str, rows.collect()))


@pytest.fixture
def posted(spark, tmp_path):
    folder = tmp_path / "messages"
    post(spark, folder, [comment("1", "good"), comment("2", "bad"), comment("1", "good"),
                         comment("3", "https://only.link"), comment("4", "x", is_reply=True)],
         ["{bad", ""])
    return folder


def run(spark, folder, layout, **how):
    P.run_available(spark, P.message_stream(spark, path=str(folder)), layout, **how)


@pytest.mark.parametrize("scorer", [Scorer("keyword"), Scorer("model", KeywordPredictor)])
def test_stream_equals_batch_and_resumes(spark, layout, posted, scorer):
    run(spark, posted, layout, scorer=scorer)
    post(spark, posted, [comment("2", "bad"), comment("5", "great", author="bob"),
                         comment("6", "ok", event_time=T0 + timedelta(days=1),
                                 collected_at=T0 + timedelta(days=1))])
    run(spark, posted, layout, scorer=scorer)
    run(spark, posted, layout, scorer=scorer)  # nothing new

    bronze = TAB.read_table(spark, layout.bronze, BRONZE)
    silver = TAB.read_table(spark, layout.silver, SILVER_STORED)
    assert bronze.count() == 8
    assert texts(silver.select(*KEPT)) == texts(silver_comments(bronze).select(*KEPT))
    for path, schema, full in ((layout.summary, GOLD_SUMMARY, G.gold_summary),
                               (layout.breakdown, GOLD_BREAKDOWN, G.gold_breakdown)):
        assert texts(TAB.read_table(spark, path, schema)) == texts(full(silver))
    assert Q.duplicate_key_count(silver).collect() == [(0,)]
    assert {r.scorer for r in silver.collect()} == {scorer.name}


def test_a_stream_writes_one_file_a_date(spark, layout, tmp_path):
    """The tasks of its dedup have rows of every date each; they are gathered before they are written."""
    when = [T0 + timedelta(days=day) for day in range(12)]
    post(spark, tmp_path / "m", [comment(f"{day}-{k}", event_time=at, collected_at=at)
                                 for day, at in enumerate(when) for k in range(8)])
    run(spark, tmp_path / "m", layout)
    for path, schema in ((layout.silver, SILVER_STORED), (layout.summary, GOLD_SUMMARY)):
        found = TAB.read_table(spark, path, schema)
        assert len(found.inputFiles()) == found.select("event_date").distinct().count() == 12


def test_malformed_messages_go_to_quarantine(spark, layout, posted):
    messages = P.message_stream(spark, path=str(posted))
    for _ in range(2):  # the second time there is nothing new
        P.start_bronze(messages, layout, once=True).awaitTermination()
    rows = spark.read.parquet(layout.quarantine).collect()
    assert [r.value for r in rows] == ["{bad"]
    bronze = TAB.read_table(spark, layout.bronze, BRONZE)
    assert bronze.count() == 5 and bronze.filter("comment_id is null").isEmpty()


def dedup_batches(spark, tmp_path, batches, **how):
    """Run one batch per posted file; return kept ids per batch and rows dropped as late."""
    folder = tmp_path / "in"
    for i, rows in enumerate(batches):
        post(spark, folder, rows)
        # the file source takes the oldest file first
        os.utime(folder / f"{i:04}.txt", (1_700_000_000 + i, 1_700_000_000 + i))
    stream = P.message_stream(spark, path=str(folder), maxFilesPerTrigger="1", latestFirst="false")
    spread = how.pop("spread", None)
    rows = REC.bronze_rows(stream)
    kept = dedup_stream(rows, spread=spread, **how).select("comment_id", "collected_at")
    seen = []

    def keep(batch, epoch):
        seen.extend((epoch, r.comment_id) for r in batch.collect())

    query = (kept.writeStream.foreachBatch(keep).trigger(availableNow=True)
             .option("checkpointLocation", str(tmp_path / "c")).start())
    query.awaitTermination()
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress
                  for op in json.loads(p.json)["stateOperators"])
    return [key for _, key in sorted(seen)], dropped


def at(key, days):
    moment = T0 + timedelta(days=days)
    return comment(key, event_time=moment, collected_at=moment)


# a watermark counts for late rows from the second batch after the one that moved it
BATCHES = [[at("a", 0), at("a", 0)], [at("b", 5)], [at("c", 6)], [at("e", 6), at("late", 1)],
           [at("a", 8)], [at("f", 12), at("late", 12)]]


@pytest.mark.parametrize("spread", [False, True])
def test_exact_dedup_remembers_and_drops_nothing_for_its_time(spark, tmp_path, spread):
    spread = F.pmod(F.xxhash64("author"), F.lit(4)) if spread else None
    kept, dropped = dedup_batches(spark, tmp_path, BATCHES, spread=spread)
    assert kept == ["a", "b", "c", "e", "late", "f"] and dropped == 0


@pytest.mark.parametrize("bounded", [False, True])
def test_a_row_from_the_future_costs_no_other(spark, tmp_path, bounded):
    today = (datetime.now(T0.tzinfo) - T0).days  # the watermark may reach the time of ingestion
    batches = [[at("a", today)], [at("future", 40_000)], [at("b", today)], [at("c", today - 1)],
               [at("d", today)]]
    kept, dropped = dedup_batches(spark, tmp_path, batches, bounded=bounded)
    assert kept == ["a", "future", "b", "c", "d"] and dropped == 0


def test_bounded_dedup_forgets(spark, tmp_path):
    kept, dropped = dedup_batches(spark, tmp_path, BATCHES, bounded=True)
    assert kept == ["a", "b", "c", "e", "a", "f", "late"] and dropped == 1


def test_hot_key_copies_are_spread_and_thinned(spark, layout):
    TAB.ensure_tables(spark, layout)
    rows = [comment("hot" if i % 3 == 0 else str(i)) for i in range(300)]
    stamped = frame(spark, rows).withColumn("ingested_at", F.current_timestamp())
    land_records(stamped, layout, "one")
    query = P.start_silver(spark, layout, spread=16, once=True)
    query.awaitTermination()
    assert P.late_rows(query) == 0
    assert TAB.read_table(spark, layout.silver, SILVER_STORED).count() == 201
    operators = [op for p in query.recentProgress if p.numInputRows
                 for op in json.loads(p.json)["stateOperators"]]
    assert sorted(op["numRowsUpdated"] for op in operators) == [201, 216]


def state_operators(query):
    return [op for p in query.recentProgress if p.numInputRows
            for op in json.loads(p.json)["stateOperators"]]


def test_open_stores_follow_the_cores_not_the_size(spark, layout, monkeypatch):
    """An open store takes memory of its executor, however few keys it has; an epoch is written as ever."""
    TAB.ensure_tables(spark, layout)
    seen, land = [], P.land_epoch
    monkeypatch.setattr(P, "land_epoch", lambda batch, *to: (
        seen.append(batch.sparkSession.conf.get(P.PARTITIONS)), land(batch, *to)))
    most = P.STATE_TASKS_A_CORE * spark.sparkContext.defaultParallelism
    for batch, partitions, ids in (("one", 8 * most, range(40)), ("two", 2, range(20, 60))):
        land_records(frame(spark, [comment(str(i)) for i in ids]).withColumn(
            "ingested_at", F.current_timestamp()), layout, batch)
        with P._settings(spark, {P.PARTITIONS: str(partitions)}):
            query = P.start_silver(spark, layout, once=True)
            query.awaitTermination()
        # the second run goes on with the stores of the first
        assert {op["numStateStoreInstances"] for op in state_operators(query)} == {most}
        assert set(seen) == {str(partitions)}
        seen.clear()
    assert TAB.read_table(spark, layout.silver, SILVER_STORED).count() == 60


def test_an_epoch_beside_other_batches_runs_its_state_once(spark, layout):
    """Its rows are asked for more than once when keys of others are looked up."""
    rows = [comment(str(i), event_time=T0 + timedelta(days=i % 3)) for i in range(40)]
    build_lakehouse(spark, frame(spark, rows[:20]), layout, batch="other")
    land_records(frame(spark, rows[10:] + rows[30:]).withColumn("ingested_at", F.current_timestamp()),
                 layout, "more")
    query = P.start_silver(spark, layout, once=True)
    query.awaitTermination()
    assert [op["numRowsUpdated"] for op in state_operators(query)
            if op["operatorName"] == "dedupe"] == [40]
    assert {op["numStateStoreInstances"] for op in state_operators(query)} == {P.state_tasks(spark)}
    silver = TAB.read_table(spark, layout.silver, SILVER_STORED)
    assert silver.groupBy("landed_in").count().orderBy("count").select("count").collect() == [(20,), (20,)]
    assert silver.select("comment_id").distinct().count() == 40
    assert not children(spark, f"{layout.root}/_staging")


def test_memory_of_a_store_is_bounded(spark):
    wanted = P.state_store(spark)
    named = {key.rpartition(".")[2]: key for key in wanted}
    assert wanted[named["writeBufferSizeMB"]] == wanted[named["blockCacheSizeMB"]] == str(P.STORE_MB)
    with P._settings(spark, {named["writeBufferSizeMB"]: "64"}):  # the user's stays
        assert named["writeBufferSizeMB"] not in P.state_store(spark)


def test_state_store_of_the_user_stays(spark):
    before = spark.conf.get(P.STATE_STORE)
    try:
        spark.conf.set(P.STATE_STORE, "my.Store")
        assert P.state_store(spark) == {}
    finally:
        spark.conf.set(P.STATE_STORE, before)


def test_settings_of_a_query_do_not_stay(spark, layout):
    TAB.ensure_tables(spark, layout)
    before = spark.conf.get(P.STATE_STORE)
    land_records(frame(spark, [comment("1")]), layout, "one")
    P.start_silver(spark, layout, once=True).awaitTermination()
    assert spark.conf.get(P.STATE_STORE) == before


def test_two_shuffles_at_most_carry_silver(spark, layout):
    TAB.ensure_tables(spark, layout)
    land_records(frame(spark, [comment("1")]), layout, "one")
    query = P.start_silver(spark, layout, once=True)
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert 1 <= plan.count("Exchange ") <= 2
