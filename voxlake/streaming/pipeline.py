"""Three chained queries: messages -> Bronze -> Silver -> Gold, each with its own checkpoint.

Messages are decoded once. Each table is written per epoch, and a retried epoch replaces what it wrote.
Silver and what Gold is made of are the same pieces that batch builds write, so both may feed one lake,
and dates may be compacted between runs. Gold is merged for the dates whose pieces are new;
repeating that changes nothing. `stop_gracefully` lets running epochs end; a query resumes from its
checkpoint.
"""

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from voxlake.fixed_values import LATENESS
from voxlake.functions.slang import SlangTerm
from voxlake.operators.cleaning import admit, with_clean_text
from voxlake.operators.reports import sentiment_trend
from voxlake.operators.scoring import Scorer, score
from voxlake.plans.lakehouse import KEYWORDS, land_messages, silver_at_rest
from voxlake.plans.landing import land_epoch, merge_gold
from voxlake.schemas import BRONZE, GOLD_SUMS, SILVER_STORED
from voxlake.settings import TableLayout
from voxlake.sources.swaps import finish_swaps
from voxlake.sources.tables import ensure_tables, show_written
from voxlake.streaming.dedup import dedup_stream
from voxlake.streaming.late import split_epoch


def message_stream(spark: SparkSession, source: str = "text", **options: str) -> DataFrame:
    """Raw messages with a `value` column: files (text) here, kafka where its connector is.

    message_stream(spark, path="...")
    message_stream(spark, "kafka", **{"kafka.bootstrap.servers": "...", "subscribe": "..."})
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        options = {"startingOffsets": "latest", **options}
    return reader.options(**options).load()


def table_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                 **options: str) -> DataFrame:
    """A lakehouse table as a stream of its new rows."""
    reader = spark.readStream.format(fmt).options(**options)
    return (reader if fmt == "delta" else reader.schema(schema)).load(path)


def _start(writer: DataStreamWriter, layout: TableLayout, name: str, once: bool,
           every: str | None = None) -> StreamingQuery:
    writer = writer.queryName(name).option("checkpointLocation", layout.checkpoint(name))
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


ADAPTIVE = "spark.sql.adaptive.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"
_IN_MEMORY = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE_MB = 4  # of memory for what a store has just been given, twice that at most, and for what it has read
STATE_TASKS_A_CORE = 4


def state_store(spark: SparkSession) -> dict[str, str]:
    """Settings for a query that remembers every key, more than executors have memory for.

    A store chosen by the user stays: then there are none.
    """
    if not spark.conf.get(STATE_STORE, _IN_MEMORY).endswith("HDFSBackedStateStoreProvider"):
        return {}
    # for each store by itself: one limit for all would let idle ones leave no room for those that write
    limits = {f"{_ROCKSDB}.{name}": str(value) for name, value in (
        ("writeBufferSizeMB", STORE_MB), ("maxWriteBufferNumber", 2), ("blockCacheSizeMB", STORE_MB))}
    return {STATE_STORE: _ON_DISK, f"{_ROCKSDB}.changelogCheckpointing.enabled": "true",
            **{key: value for key, value in limits.items() if spark.conf.get(key, None) is None}}


def state_tasks(spark: SparkSession) -> int:
    """Tasks of a step that remembers keys: by the cores there are, not by the size of the input.

    Each task of such a step has a store, which its executor keeps open between epochs. An open store takes
    a megabyte or more beside the heap, however few keys it has, so hundreds of them fill an executor.
    """
    return min(int(spark.conf.get(PARTITIONS)),
               STATE_TASKS_A_CORE * spark.sparkContext.defaultParallelism)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings while a query starts; it keeps them, other queries do not see them."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _as_batch(spark: SparkSession, batch: DataFrame):
    """While an epoch is written, its session plans as the user's does; a stream's own differs.

    The stream's own part, with its state, has been planned by then.
    """
    return _settings(batch.sparkSession, {key: spark.conf.get(key) for key in (ADAPTIVE, PARTITIONS)})


def _query_id(batch: DataFrame) -> str:
    """The same when the query goes on from its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def start_bronze(messages: DataFrame, layout: TableLayout, once: bool = False) -> StreamingQuery:
    """Well-formed messages into Bronze, malformed ones into quarantine, in one pass."""
    def land(batch: DataFrame, epoch: int) -> None:
        land_messages(batch, layout, f"{_query_id(batch)}-{epoch}")
        show_written(batch.sparkSession, layout)

    return _start(messages.writeStream.foreachBatch(land), layout, "bronze", once)


def silver_stream(bronze: DataFrame, scorer: Scorer = KEYWORDS, terms: Sequence[SlangTerm] = (),
                  bounded: bool = False, spread: Column | None = None) -> DataFrame:
    """Cleaned, deduplicated and scored stream, in stored column order."""
    comments = bronze if spread is None else bronze.withColumn("_spread_by", spread)
    unique = dedup_stream(admit(comments), bounded=bounded,
                          spread=None if spread is None else F.col("_spread_by"))
    return silver_at_rest(score(with_clean_text(unique), scorer, terms))


def start_silver(spark: SparkSession, layout: TableLayout, scorer: Scorer = KEYWORDS,
                 terms: Sequence[SlangTerm] = (), bounded: bool = False, spread: int | None = None,
                 once: bool = False, tasks: int | None = None, **options: str) -> StreamingQuery:
    """Bronze into Silver; texts are derived after the last shuffle, that of the dedup.

    spread   tasks that share the copies of one hot key, as many as the dedup has if none are given;
             0 turns that off
    tasks    of the dedup, `state_tasks` if none are given; a checkpoint keeps the number it began with
    """
    tasks = tasks or state_tasks(spark)
    if spread is None:
        spread = tasks
    bronze = table_stream(spark, layout.bronze, BRONZE, layout.fmt, **options)
    rows = silver_stream(bronze, scorer, terms, bounded,
                         _copy_number(layout.fmt, spread) if spread else None)

    def land(batch: DataFrame, epoch: int) -> None:
        with _as_batch(spark, batch):
            finish_swaps(batch.sparkSession, layout.root)
            land_epoch(batch, layout, _query_id(batch), epoch)
            show_written(batch.sparkSession, layout)

    with _settings(spark, {**state_store(spark), PARTITIONS: str(tasks)}):
        return _start(rows.writeStream.outputMode("append").foreachBatch(land), layout, "silver", once)


def start_silver_keeping_late(spark: SparkSession, layout: TableLayout, scorer: Scorer = KEYWORDS,
                              terms: Sequence[SlangTerm] = (), lateness: str = LATENESS,
                              once: bool = False, **options: str) -> StreamingQuery:
    """Bronze into Silver; rows behind the watermark go to the table of late rows instead.

    The watermark of an epoch is the latest time of collection that earlier epochs have seen, but not
    beyond their ingestion, less `lateness`. It is kept in the progress table, so a retried epoch finds
    the same. Keys are looked up in Silver; the query keeps no state of its own.
    """
    bronze = table_stream(spark, layout.bronze, BRONZE, layout.fmt, **options)

    def land(batch: DataFrame, epoch: int) -> None:
        session, query = batch.sparkSession, _query_id(batch)
        with _as_batch(spark, batch):
            finish_swaps(session, layout.root)
            split_epoch(batch, layout, query, epoch, scorer, terms, lateness)
            show_written(session, layout)

    return _start(bronze.writeStream.foreachBatch(land), layout, "silver", once)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query's recent batches have dropped behind the watermark."""
    return sum(operator["numRowsDroppedByWatermark"] for progress in query.recentProgress
               for operator in progress["stateOperators"])


def _copy_number(fmt: str, spread: int) -> Column:
    """A number below `spread` from where a row is stored, so a retry finds the same."""
    place = (F.col("_metadata.row_index") if fmt == "parquet"
             else F.xxhash64("_metadata.file_path"))
    return F.pmod(place, F.lit(spread))


def start_gold(spark: SparkSession, layout: TableLayout, once: bool = False,
               every: str | None = None, **options: str) -> StreamingQuery:
    """Merge Gold for the dates of each new piece of Silver.

    The stream is that of the pieces' sums: a row for each date, video and sentiment of an epoch or
    batch, wherever it came from. Silver itself is not read.
    """
    sums = table_stream(spark, layout.sums, GOLD_SUMS, layout.fmt,
                        **{"ignoreMissingFiles": "true", **options})

    def merge(batch: DataFrame, _epoch: int) -> None:
        with _as_batch(spark, batch):
            merge_gold(batch.sparkSession, layout, [
                r.event_date for r in batch.select("event_date").distinct().collect()])
            show_written(batch.sparkSession, layout)

    writer = sums.select("event_date").writeStream.outputMode("update").foreachBatch(merge)
    return _start(writer, layout, "gold", once, every)


def sentiment_trend_stream(silver: DataFrame, width: str = "1 day", lateness: str = LATENESS
                           ) -> DataFrame:
    """Windows of a stream of Silver that no more row can change, for output mode append."""
    return sentiment_trend(silver.withWatermark("event_time", lateness), width)


def start_trend(spark: SparkSession, layout: TableLayout, target: str, width: str = "1 day",
                lateness: str = LATENESS, once: bool = False, **options: str) -> StreamingQuery:
    """Append each closed window of Silver to a table at `target`."""
    silver = table_stream(spark, layout.silver, SILVER_STORED, layout.fmt,
                          **{"ignoreMissingFiles": "true", **options})
    writer = (sentiment_trend_stream(silver, width, lateness).writeStream.format(layout.fmt)
              .outputMode("append").option("path", target))
    return _start(writer, layout, "trend", once)


def stop_gracefully(queries: Sequence[StreamingQuery], patience: float = 600) -> None:
    """Let each query end the epoch it is in, in the given order, then stop it.

    What an earlier query has still written is left to the later ones' next start, or to the epochs
    that they run meanwhile. After `patience` seconds a query is stopped in its epoch, which is then
    repeated.
    """
    for query in queries:
        until = time.monotonic() + patience
        while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
            time.sleep(0.05)
        query.stop()


def run_available(spark: SparkSession, messages: DataFrame, layout: TableLayout,
                  scorer: Scorer = KEYWORDS, terms: Sequence[SlangTerm] = (),
                  **options: str) -> None:
    """Process everything there is through all three layers, then stop."""
    ensure_tables(spark, layout)
    start_bronze(messages, layout, once=True).awaitTermination()
    start_silver(spark, layout, scorer, terms, once=True, **options).awaitTermination()
    start_gold(spark, layout, once=True).awaitTermination()
