"""Replay files as a stream: some files an epoch, from where the last run stopped."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from voxlake.functions.cleaning import UNKNOWN
from voxlake.plans.ingestion import ingest_lines

COUNTS = "incoming long, published long, quarantined long, broken long"


def start_replay(spark: SparkSession, source: str, target: str, files: int = 1,
                 landed: DataFrame | None = None, expected_video: str | None = None,
                 skip_invalid: bool = False, default_source: str = UNKNOWN, every: str | None = None,
                 once: bool = False) -> StreamingQuery:
    """Ingest `files` files of JSON lines an epoch: messages, quarantine, broken lines and counts.

    Each epoch writes below epochs/<number> of the target and replaces what an attempt before left
    there, so a replay that was stopped or killed goes on without a gap or a repetition. `every`
    limits the rate in time. Records are compared with `landed`, not between epochs.
    """
    lines = (spark.readStream.format("text").option("maxFilesPerTrigger", files)
             .option("latestFirst", "false").load(source))

    def work(batch: DataFrame, epoch: int) -> None:
        folder = f"{target}/epochs/epoch={epoch}"
        counts = ingest_lines(batch.select("value"), folder, landed, expected_video, skip_invalid,
                              default_source)
        row = [counts.get(c.split()[0], 0) for c in COUNTS.split(", ")]
        (batch.sparkSession.createDataFrame([row], COUNTS).coalesce(1)
         .write.mode("overwrite").parquet(f"{target}/counts/epoch={epoch}"))

    writer = (lines.writeStream.queryName("replay").foreachBatch(work)
              .option("checkpointLocation", f"{target}/_checkpoint"))
    if once:
        writer = writer.trigger(availableNow=True)
    elif every:
        writer = writer.trigger(processingTime=every)
    return writer.start()


def replay_counts(spark: SparkSession, target: str) -> DataFrame:
    """What each finished epoch has taken in, sent on and set aside."""
    return spark.read.schema(f"{COUNTS}, epoch long").parquet(f"{target}/counts")


def replayed_messages(spark: SparkSession, target: str) -> DataFrame:
    """(key, value) of all epochs."""
    return spark.read.schema("key string, value string").json(f"{target}/epochs/*/messages")
