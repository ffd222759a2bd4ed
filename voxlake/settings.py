"""Explicit configuration and the few session-level helpers."""

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class ScoringSettings:
    """How Silver assigns sentiment.

    mode               "model" uses the predictor factory, "keyword" the built-in expression.
    fallback           use the keyword scorer when the model cannot be loaded.
    batch_size         texts handed to one predictor call.
    """

    mode: str = "keyword"
    fallback: bool = True
    batch_size: int = 16


@dataclass(frozen=True)
class TableLayout:
    """Where the tables live, what they are called, and in which format they are kept."""

    root: str
    database: str = "lakehouse"
    bronze_name: str = "bronze_comments"
    silver_name: str = "silver_comments"
    summary_name: str = "gold_comment_metrics"
    breakdown_name: str = "gold_sentiment_breakdown"
    fmt: str = "parquet"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def summary(self) -> str:
        return f"{self.root}/gold_summary"

    @property
    def breakdown(self) -> str:
        return f"{self.root}/gold_breakdown"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def late(self) -> str:
        """Rows that came behind the watermark."""
        return f"{self.root}/late"

    @property
    def sums(self) -> str:
        """Partial sums of Gold, one piece for each piece of Silver."""
        return f"{self.root}/gold_parts/sums"

    @property
    def authors(self) -> str:
        """Who commented where, one piece for each piece of Silver."""
        return f"{self.root}/gold_parts/authors"

    @property
    def sketches(self) -> str:
        """Sketches of videos and authors, one for each piece of Silver."""
        return f"{self.root}/gold_parts/sketches"

    @property
    def batches(self) -> str:
        """The manifest: an entry for each batch that has been taken in."""
        return f"{self.root}/batches"

    @property
    def progress(self) -> str:
        """An entry for each epoch of the Silver stream."""
        return f"{self.root}/progress"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/_checkpoints/{query}"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below spark.checkpoint.dir, which every executor must be able to reach."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def lend_shared_folder(spark: SparkSession) -> None:
    """For tests and tools on one machine: a checkpoint folder where the session names none."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("voxlake")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
