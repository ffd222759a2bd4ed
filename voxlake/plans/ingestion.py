"""Raw records -> messages ready to be published."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlake.functions.cleaning import UNKNOWN
from voxlake.operators.dedup import new_records_only
from voxlake.operators.validation import require_valid, split_valid, with_defaults
from voxlake.schemas import RECORD
from voxlake.sources.records import decode_json, keyed_messages


def prepare_messages(records: DataFrame, landed: DataFrame | None = None,
                     expected_video: str | None = None, skip_invalid: bool = False,
                     default_source: str = UNKNOWN) -> tuple[DataFrame, DataFrame | None]:
    """(messages, quarantine).

    `landed` holds the comment ids already there; they are skipped, as are repeats. Without
    `skip_invalid` the first invalid record fails the run and there is no quarantine.
    """
    fresh = records if landed is None else new_records_only(records, landed)
    complete = with_defaults(fresh, default_source)
    if not skip_invalid:
        return keyed_messages(require_valid(complete, expected_video)), None
    valid, quarantined = split_valid(complete, expected_video)
    return keyed_messages(valid), quarantined


def ingest(records: DataFrame, target: str, landed: DataFrame | None = None,
           expected_video: str | None = None, skip_invalid: bool = False,
           default_source: str = UNKNOWN) -> dict[str, int]:
    """Write messages/ and, with `skip_invalid`, quarantine/ as JSON lines below `target`.

    Both replace what an earlier run of the same target wrote, so a run may be repeated. The
    counts of the records that came, went out and were set aside are returned.
    """
    messages, quarantine = prepare_messages(records, landed, expected_video, skip_invalid,
                                            default_source)
    spark = records.sparkSession
    messages.select("key", "value").write.mode("overwrite").json(f"{target}/messages")
    counts = {"incoming": records.count(), "published": _lines(spark, f"{target}/messages")}
    if quarantine is not None:
        quarantine.write.mode("overwrite").json(f"{target}/quarantine")
        counts["quarantined"] = _lines(spark, f"{target}/quarantine")
    return counts


def _lines(spark, path: str) -> int:
    return spark.read.text(path).count()


def ingest_lines(lines: DataFrame, target: str, landed: DataFrame | None = None,
                 expected_video: str | None = None, skip_invalid: bool = False,
                 default_source: str = UNKNOWN) -> dict[str, int]:
    """`ingest` of lines of JSON (column `value`): those that are no record are not lost either.

    With `skip_invalid` broken lines are written to broken/ and counted, as invalid records are;
    without it the first one fails the run. incoming counts records and broken lines; blank lines
    are neither.
    """
    decoded = decode_json(lines).select("value", "malformed", "record").persist()
    try:
        present = F.col("record").isNotNull()
        if not skip_invalid:  # in one predicate: of two Spark may ask the other first
            present = F.when(~F.col("malformed"), present).otherwise(F.raise_error(F.concat(
                F.lit("broken line: "), F.substring("value", 1, 200))).cast("boolean"))
        records = decoded.filter(present).select(
            *[F.col("record")[c].alias(c) for c in RECORD.names])
        counts = ingest(records, target, landed, expected_video, skip_invalid, default_source)
        if skip_invalid:
            decoded.filter("malformed").select("value").write.mode("overwrite").text(
                f"{target}/broken")
            counts["broken"] = _lines(lines.sparkSession, f"{target}/broken")
            counts["incoming"] += counts["broken"]
        return counts
    finally:
        decoded.unpersist()
