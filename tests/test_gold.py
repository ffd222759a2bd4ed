import re

import pytest
from comments import T0, comment, frame
from pyspark.sql import functions as F

from voxlake.operators import gold as G
from voxlake.operators import quality as Q
from voxlake.operators import reports as R
from voxlake.plans.lakehouse import (
    build_lakehouse, refresh_gold, scored_comments, silver_at_rest, silver_comments)
from voxlake.schemas import BRONZE_STORED, GOLD_BREAKDOWN, GOLD_SUMMARY, SILVER_STORED
from voxlake.sources import tables as TAB

LATER = T0.replace(day=12)


@pytest.fixture
def bronze(spark):
    return frame(spark, [
        comment("1", "good", like_count=4), comment("2", "bad", author="bob", like_count=-3),
        comment("3", "xyz", is_reply=True, parent_comment_id="1", reply_count=2),
        comment("1", "good", like_count=9),
        comment("4", "useful", video_id="v2", author=" "),
        comment("5", "great", event_time=LATER, collected_at=None)])


def as_set(rows, schema):
    return sorted(map(str, rows.select(*schema.names).collect()))


def test_summary(spark, bronze):
    rows = G.gold_summary(silver_comments(bronze)).orderBy("event_date", "video_id").collect()
    first = rows[0].asDict()
    assert len(rows) == 3
    assert first["total_comments"] == 3 and first["unique_author_count"] == 2
    assert first["total_likes"] == 5 and first["avg_likes_per_comment"] == 1.67
    assert first["positive_ratio"] == first["reply_ratio"] == 0.3333
    assert first["engagement_score"] == 6 and first["avg_collected_delay_seconds"] == 2.0
    assert rows[1].unique_author_count == 1  # the author 'unknown'
    assert rows[2].avg_collected_delay_seconds == 0.0


def test_schemas_match_the_contract(bronze):
    silver = silver_comments(bronze)
    for made, schema in ((G.gold_summary(silver), GOLD_SUMMARY),
                         (G.gold_breakdown(silver), GOLD_BREAKDOWN)):
        assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in schema]
    stored = silver_at_rest(silver.withColumn("ingested_at", F.current_timestamp()))
    assert [(f.name, f.dataType) for f in stored.schema] == [
        (f.name, f.dataType) for f in SILVER_STORED]


def test_breakdown_and_checks(bronze):
    silver = silver_comments(bronze).cache()
    summary, breakdown = G.gold_summary(silver), G.gold_breakdown(silver)
    assert breakdown.count() == 5
    assert Q.gold_invariants(summary).collect() == [(0, 0, 0)]
    assert Q.silver_invariants(silver).collect() == [(0, 0, 0, 0, 0)]
    assert Q.duplicate_key_count(silver).collect() == [(0,)]
    assert Q.duplicate_key_count(bronze).collect() == [(1,)]
    assert all(r.total_comments == r.breakdown_total
               for r in Q.gold_reconcile(summary, breakdown).collect())
    assert all(r.silver_count == r.gold_count
               for r in Q.silver_gold_agreement(silver, breakdown).collect())
    flow = Q.layer_flow_check(bronze, silver, summary, breakdown.filter("video_id = 'v2'"))
    assert [tuple(r) for r in flow.collect()] == [("v1", 5, 4, 2, None), ("v2", 1, 1, 1, 1)]


def test_one_scan_for_the_breakdown(spark, tmp_path, bronze):
    silver_comments(bronze).write.parquet(str(tmp_path / "s"))
    made = G.gold_breakdown(spark.read.parquet(str(tmp_path / "s")))
    assert made._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_summary_reads_only_its_columns(spark, tmp_path, bronze):
    silver_comments(bronze).write.parquet(str(tmp_path / "s"))
    made = G.gold_summary(spark.read.parquet(str(tmp_path / "s")))
    scan = made._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert "text_clean" not in scan and "text_length" in scan


def test_texts_are_not_shuffled_for_gold(bronze):
    plan = G.gold_summary(scored_comments(bronze))._jdf.queryExecution().executedPlan()
    shuffled = plan.toString().split("Exchange hashpartitioning(video_id")[1].splitlines()[1:4]
    assert not re.search(r"\btext(_clean)?#\d+[,\]]", shuffled[1])


def test_one_text_is_shuffled_for_silver(bronze):
    rows = silver_at_rest(silver_comments(
        bronze.withColumn("ingested_at", F.current_timestamp()), by_date=True))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "REBALANCE" in below and "text_clean#" not in below


def test_both_silver_plans_agree(bronze):
    assert scored_comments(bronze).exceptAll(
        silver_comments(bronze).select(*scored_comments(bronze).columns)).isEmpty()


def test_refresh_is_exact_repeatable_and_local(spark, layout, bronze):
    build_lakehouse(spark, bronze, layout)
    silver = TAB.read_table(spark, layout.silver, SILVER_STORED)
    before = as_set(TAB.read_table(spark, layout.summary, GOLD_SUMMARY), GOLD_SUMMARY)
    assert before == as_set(G.gold_summary(silver), GOLD_SUMMARY)

    more = frame(spark, [comment("6", "poor", event_time=LATER, author="cy")])
    arrival = silver_at_rest(silver_comments(more.withColumn("ingested_at", F.lit(T0))))
    TAB.append_table(arrival, layout.silver, gathered=False)
    kept = set(_files(layout.summary, "event_date=2026-04-11"))
    for _ in range(2):
        refresh_gold(spark, layout, G.touched_dates(arrival))
        for path, schema, full in ((layout.summary, GOLD_SUMMARY, G.gold_summary),
                                   (layout.breakdown, GOLD_BREAKDOWN, G.gold_breakdown)):
            now = TAB.read_table(spark, path, schema)
            whole = full(TAB.read_table(spark, layout.silver, SILVER_STORED))
            assert as_set(now, schema) == as_set(whole, schema)
    assert set(_files(layout.summary, "event_date=2026-04-11")) == kept


def _files(path, partition):
    from pathlib import Path
    return [str(p) for p in Path(path, partition).glob("*.parquet")]


def test_refresh_reads_only_the_touched_partitions(spark, layout, bronze):
    build_lakehouse(spark, bronze, layout)
    silver = TAB.read_table(spark, layout.silver, SILVER_STORED)
    days = silver.filter(F.col("event_date") == "2026-04-12")
    picked = G.rows_of_dates(silver, G.touched_dates(days))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan)
    assert picked.count() == 1
    many = spark.range(2000).select(F.date_add(F.lit("2022-01-01"), F.col("id").cast("int"))
                                    .alias("event_date"))
    picked = G.rows_of_dates(silver, many)
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", plan)
    assert picked.count() == silver.count()


def test_batches_may_overlap_and_repeat(spark, layout, bronze):
    rows = bronze.withColumn("ingested_at", F.lit("2026-05-01").cast("timestamp"))
    first = rows.filter("comment_id < '3'")
    for batch, part in (("one", first), ("two", rows), ("two", rows), ("one", first)):
        build_lakehouse(spark, part, layout, batch=batch)
    silver = TAB.read_table(spark, layout.silver, SILVER_STORED)
    assert silver.groupBy("video_id", "comment_id").count().filter("count > 1").isEmpty()
    assert silver.count() == silver_comments(rows).count()
    gold = TAB.read_table(spark, layout.summary, GOLD_SUMMARY)
    assert sorted(map(str, gold.collect())) == sorted(map(str, G.gold_summary(silver).collect()))
    assert TAB.read_table(spark, layout.bronze, BRONZE_STORED).count() == first.count() + rows.count()


def test_registered_tables_show_later_dates(spark, layout, bronze):
    dates = bronze.select(F.to_date("event_time").alias("d")).distinct()
    last = dates.agg(F.max("d")).first()[0]
    later = F.to_date("event_time") == F.lit(last)
    build_lakehouse(spark, bronze.filter(~later), layout)
    TAB.register_tables(spark, layout)
    name = f"{layout.database}.{layout.summary_name}"
    assert last not in {r.event_date for r in spark.table(name).collect()}
    build_lakehouse(spark, bronze.filter(later), layout)
    assert last in {r.event_date for r in spark.sql(f"SELECT * FROM {name}").collect()}
    spark.sql(f"DROP DATABASE {layout.database} CASCADE")


def test_bootstrap_and_catalog(spark, layout, bronze):
    TAB.ensure_tables(spark, layout)
    TAB.ensure_tables(spark, layout)
    assert [TAB.read_table(spark, p, s).count() for _, p, s in TAB.contracts(layout)] == [0] * 4
    build_lakehouse(spark, bronze, layout)
    TAB.ensure_tables(spark, layout)
    TAB.register_tables(spark, layout)
    TAB.register_tables(spark, layout)
    assert {r.tableName for r in TAB.list_tables(spark, layout.database).collect()} == {
        layout.bronze_name, layout.silver_name, layout.summary_name, layout.breakdown_name}
    described = [r.col_name for r in TAB.describe_table(
        spark, f"{layout.database}.{layout.silver_name}").collect()]
    assert described[:len(SILVER_STORED)] == SILVER_STORED.names
    assert layout.database in {d.name for d in spark.catalog.listDatabases()}
    counts = [spark.table(f"{layout.database}.{name}").count()
              for name, _, _ in TAB.contracts(layout)]
    assert counts == [6, 5, 3, 5]
    assert TAB.by_path(spark, layout.silver).count() == 5
    assert BRONZE_STORED.names[-1] in spark.table(f"{layout.database}.{layout.bronze_name}").columns
    spark.sql(f"DROP DATABASE {layout.database} CASCADE")


def test_reports(bronze):
    silver = silver_comments(bronze)
    assert [r.comment_id for r in R.latest(silver, 2, "collected_at", ["comment_id"]).collect()] == [
        "5", "1"]
    assert {r.sentiment: r.percentage for r in R.sentiment_share(silver).collect()} == {
        "positive": 60.0, "negative": 20.0, "neutral": 20.0}
    assert [tuple(r) for r in R.top_positive_authors(silver).collect()] == [
        ("ann", 2), ("unknown", 1)]
    assert [r.author for r in R.negative_sample(silver).collect()] == ["bob"]
