"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES  # noqa: E402
from voxlake.settings import lend_shared_folder, local_session, shared_folder  # noqa: E402

HEADLINES = ("gold_summary", "gold_breakdown", "silver_clean", "keyword_sentiment", "label_prf",
             "score_batches", "slang_sentiment", "dedup_first", "layer_flow_check",
             "hourly_volume")
RUNS = 3


def seconds(spark, name: str, folder: str) -> float:
    """Build, plan and run the whole query; the rows are produced and thrown away."""
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def in_pieces(spark, folder: str, cores: int) -> str:
    """The text tables as a lake holds them, in several files; not timed.

    Queries take their parallelism from the files. The given ones are single row groups.
    """
    target = f"{shared_folder(spark, 'bench')}/{Path(folder).name}"
    for path in Path(folder).glob("*.parquet"):
        rows = spark.read.parquet(str(path))
        pieces = 2 * cores if path.stem in ("documents", "conversations", "events", "pages") else 1
        rows.repartition(pieces).write.parquet(f"{target}/{path.name}")
    return target


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    lend_shared_folder(spark)
    folder = in_pieces(spark, folder, int(cores))
    timings = {}
    for name in HEADLINES:
        seconds(spark, name, folder)  # warm-up
        timings[name] = round(statistics.median(
            seconds(spark, name, folder) for _ in range(RUNS)), 3)
    scored = spark.read.parquet(f"{folder}/documents.parquet").count()
    print(json.dumps({
        "metric": "total of median seconds per query", "value": round(sum(timings.values()), 3),
        "unit": "sec", "queries": timings, "sf": Path(folder).name,
        "score_batches_rows_per_sec": round(scored / timings["score_batches"])}))
    spark.stop()


if __name__ == "__main__":
    main()
