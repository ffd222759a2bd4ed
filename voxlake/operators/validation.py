"""Record defaults, validation with reasons, quarantine."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlake.fixed_values import REQUIRED_FIELDS
from voxlake.functions.cleaning import UNKNOWN, number_is_true, parse_bool, strip


def _absent(records: DataFrame, name: str) -> Column:
    if records.schema[name].dataType.simpleString() == "string":
        return F.coalesce(F.col(name) == "", F.lit(True))
    return F.col(name).isNull()


def _or_default(records: DataFrame, name: str, default: Column) -> Column:
    return F.when(_absent(records, name), default).otherwise(F.col(name))


def _flag(records: DataFrame, name: str) -> Column:
    kind = records.schema[name].dataType.simpleString()
    if kind == "boolean":
        return F.coalesce(F.col(name), F.lit(False))
    return parse_bool(F.col(name)) if kind == "string" else number_is_true(F.col(name))


def with_defaults(records: DataFrame, default_source: str = UNKNOWN) -> DataFrame:
    """Fill what a record may leave out, and give counts and flags their types."""
    def count(name: str) -> Column:
        return F.coalesce(F.nullif(F.col(name).cast("string"), F.lit("")).cast("int"), F.lit(0))

    return records.withColumns({
        "collected_at": _or_default(records, "collected_at", F.col("event_time")),
        "source": _or_default(records, "source", F.lit(default_source)),
        "lang": _or_default(records, "lang", F.lit(UNKNOWN)),
        "like_count": count("like_count"),
        "reply_count": count("reply_count"),
        "is_reply": _flag(records, "is_reply"),
        "text": strip(F.coalesce("text", F.lit(""))),
    })


def with_reasons(records: DataFrame, expected_video: str | None = None) -> DataFrame:
    """Add `reasons`: why a record is invalid; empty for a valid one."""
    no_parent = _absent(records, "parent_comment_id")
    checks = [F.when(_absent(records, f), F.lit(f"missing {f}")) for f in REQUIRED_FIELDS]
    checks += [
        F.when(F.col("collected_at") < F.col("event_time"), "collected before event"),
        F.when(~F.col("is_reply") & ~no_parent, "parent on a non-reply"),
        F.when(F.col("is_reply") & no_parent, "reply without parent"),
    ]
    if expected_video:
        checks.append(F.when(F.col("video_id") != expected_video, "unexpected video"))
    return records.withColumn("reasons", F.array_compact(F.array(*checks)))


def split_valid(records: DataFrame, expected_video: str | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """(valid records, quarantined records with their reasons)."""
    judged = with_reasons(records, expected_video)
    valid = judged.filter(F.size("reasons") == 0).drop("reasons")
    return valid, judged.filter(F.size("reasons") > 0)


def require_valid(records: DataFrame, expected_video: str | None = None) -> DataFrame:
    """Strict mode: the first invalid record fails the run, without an extra pass."""
    judged = with_reasons(records, expected_video)
    complaint = F.concat(F.lit("invalid record "), F.coalesce("comment_id", F.lit("?")),
                         F.lit(": "), F.concat_ws(", ", "reasons"))
    accepted = F.when(F.size("reasons") == 0, F.lit(True)).otherwise(
        F.raise_error(complaint).cast("boolean"))
    return judged.filter(accepted).drop("reasons")


def ingestion_counts(records: DataFrame, expected_video: str | None = None) -> DataFrame:
    """One row: how many records are sent on and how many are skipped."""
    valid = F.size("reasons") == 0
    return with_reasons(records, expected_video).agg(
        F.count_if(valid).alias("sent_count"), F.count_if(~valid).alias("skipped_invalid_count"))
