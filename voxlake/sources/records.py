"""Comment records as they arrive and leave: JSON lines, message values, labelled CSV."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlake.fixed_values import RECORD_TIME_FORMAT
from voxlake.functions.slang import SlangTerm, slang_terms
from voxlake.schemas import API_PAGE, EVALUATION_DETAIL, LABELLED, RECORD

_CORRUPT = "_corrupt_record"


def decode_json(raw: DataFrame, schema: T.StructType = RECORD, value: str = "value") -> DataFrame:
    """Add `record` (struct) and `malformed` to rows of JSON text.

    Null and empty text gives a null record. Text that is no JSON object is malformed. A field
    of the wrong type is only null; the rest of its record is kept.
    """
    options = {"timestampFormat": RECORD_TIME_FORMAT, "mode": "PERMISSIVE",
               "columnNameOfCorruptRecord": _CORRUPT}
    extended = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    # The condition is always true. As it is not deterministic, Spark keeps the parsing in one
    # place; otherwise every filter on a parsed field parses the message once more.
    text = F.when(F.spark_partition_id() >= 0, F.col(value).cast("string"))
    parsed = raw.withColumn("_p", F.from_json(text, extended, options))
    fields = [F.col("_p")[n] for n in schema.names]
    nothing_read = F.coalesce(*[f.cast("string") for f in fields]).isNull()
    # Only a suspicious row is parsed again: an object with nothing but bad fields is no broken text
    is_object = F.startswith(
        F.schema_of_variant(F.try_parse_json(F.col(value).cast("string"))), F.lit("OBJECT"))
    malformed = (F.col("_p")[_CORRUPT].isNotNull() & nothing_read
                 & ~F.coalesce(is_object, F.lit(False)))
    return (parsed.withColumn("malformed", F.coalesce(malformed, F.lit(False)))
            .withColumn("record", F.when(F.col("_p").isNotNull() & ~F.col("malformed"), F.struct(
                *[f.alias(n) for f, n in zip(fields, schema.names)])))
            .drop("_p"))


def bronze_rows(raw: DataFrame, schema: T.StructType = RECORD, value: str = "value") -> DataFrame:
    """Well-formed records, flat, stamped with the time of ingestion."""
    return (decode_json(raw, schema, value).filter(F.col("record").isNotNull())
            .select("record.*").withColumn("ingested_at", F.current_timestamp()))


def landing_rows(raw: DataFrame, schema: T.StructType = RECORD, value: str = "value") -> DataFrame:
    """Decoded messages with the time of ingestion, the malformed among them, for two outputs."""
    return decode_json(raw, schema, value).select(
        F.col(value).cast("string").alias("value"), "malformed", "record",
        F.current_timestamp().alias("ingested_at"))


def malformed_rows(raw: DataFrame, schema: T.StructType = RECORD, value: str = "value") -> DataFrame:
    """The text of malformed messages, for quarantine."""
    return (decode_json(raw, schema, value).filter("malformed")
            .select(F.col(value).cast("string").alias("value"),
                    F.current_timestamp().alias("ingested_at")))


def keyed_messages(records: DataFrame) -> DataFrame:
    """(key, value) messages: the comment id, and the record as JSON."""
    fields = F.struct(*[c for c in RECORD.names if c in records.columns])
    options = {"timestampFormat": RECORD_TIME_FORMAT, "ignoreNullFields": "false"}
    return records.select(F.coalesce("comment_id", F.lit("no-key")).alias("key"),
                          F.to_json(fields, options).alias("value"))


def publish(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Write (key, value) messages to a sink."""
    messages.write.format(fmt).mode("append").options(**options).save()


def message_lines(spark: SparkSession, path: str) -> DataFrame:
    """Replay file as messages: one per line, in a column `value`, like a stream's."""
    return spark.read.text(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """The well-formed records of a replay file; blank lines and broken ones are left out."""
    return (decode_json(message_lines(spark, path)).filter(F.col("record").isNotNull())
            .select("record.*"))


def read_api_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored API pages, one JSON document per line."""
    return (spark.read.schema(API_PAGE).option("timestampFormat", RECORD_TIME_FORMAT).json(path))


def read_slang(spark: SparkSession, path: str) -> list[SlangTerm]:
    """Lexicon file: a JSON array of {term, normalized}. A missing file is an error.

    Terms become part of the query: this is configuration, not data.
    """
    rows = (spark.read.option("multiLine", "true").schema("term string, normalized string")
            .json(path).collect())
    return slang_terms((row.term or "", row.normalized or "") for row in rows)


_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_labelled(spark: SparkSession, path: str, required: Sequence[str] = ("text",),
                  optional: Sequence[str] = tuple(LABELLED.names)) -> DataFrame:
    """Labelled comments: CSV with header, quoted text over several lines, optional BOM.

    Columns are found by the names in the header, in any order; all of them are kept, as text.
    A missing required column fails, a missing optional one is null.
    """
    rows = spark.read.options(**_CSV).csv(path)
    missing = [c for c in required if c not in rows.columns]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}: it has "
                         f"{', '.join(rows.columns)}")
    return rows.select("*", *[F.lit(None).cast("string").alias(c)
                              for c in optional if c not in rows.columns])


def write_detail(detail: DataFrame, path: str) -> None:
    (detail.select(*EVALUATION_DETAIL.names).write.mode("overwrite")
     .options(header="true", quoteAll="true", escape='"').csv(path))


def write_summary(summary: DataFrame, path: str) -> None:
    summary.select("value").write.mode("overwrite").text(path)
