"""Batch pipeline: Bronze -> Silver -> Gold, batch by batch, for the dates a batch touches."""

import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxlake.functions.slang import SlangTerm
from voxlake.operators.cleaning import admit, clean_comments, with_clean_text
from voxlake.operators.dedup import KEYS, first_per_key, sieved
from voxlake.operators.gold import (
    gold_breakdown, gold_summary, rows_of_dates, with_event_date)
from voxlake.operators.scoring import Scorer, score
from voxlake.plans.landing import (
    Landing, merge_gold, pieces_of, silver_table, without_known)
from voxlake.schemas import BATCHES, BRONZE, BRONZE_STORED, QUARANTINE, RECORD, SILVER_STORED
from voxlake.settings import TableLayout
from voxlake.sources.records import landing_rows
from voxlake.sources.swaps import finish_swaps
from voxlake.sources.tables import (
    ensure_tables, gather, overwrite_batch, overwrite_touched, read_table, show_written)

KEYWORDS = Scorer("keyword")


def silver_comments(bronze: DataFrame, scorer: Scorer = KEYWORDS,
                    terms: Sequence[SlangTerm] = (), by_date: bool = False,
                    known: DataFrame | None = None) -> DataFrame:
    """Cleaned, admitted, deduplicated and scored comments, as a table keeps them.

    Texts are normalised and scored last: the shuffles carry one text per row, and a slow scorer
    sees no copies. `by_date` gathers the rows by event date on the way, ready to be written.
    Comments whose key is in `known` are left out.
    """
    unique = first_per_key(admit(bronze))
    if known is not None:
        unique = unique.join(known.select(*KEYS), list(KEYS), "left_anti").select(*unique.columns)
    if by_date:
        unique = gather(with_event_date(unique))
    return score(with_clean_text(unique), scorer, terms)


def scored_comments(bronze: DataFrame, scorer: Scorer = KEYWORDS,
                    terms: Sequence[SlangTerm] = ()) -> DataFrame:
    """The same rows for a reader that wants no texts.

    Scored before the dedup shuffle, so that Spark can leave the texts out of it.
    """
    return first_per_key(score(clean_comments(bronze), scorer, terms))


def silver_at_rest(silver: DataFrame, batch: str = "unnamed") -> DataFrame:
    """Silver with processing time, origin and partition columns, in stored column order."""
    stamped = with_event_date(silver.withColumn("silver_processed_at", F.current_timestamp()))
    origin = F.col("landed_in") if "landed_in" in silver.columns else F.lit(batch)
    return stamped.withColumns({"landed_in": origin, "batch_id": F.lit(batch)}).select(
        *SILVER_STORED.names)


def refresh_gold(spark: SparkSession, layout: TableLayout, dates: DataFrame | None = None) -> None:
    """Recompute Gold for the given dates (all if none given) from the whole days in Silver.

    Whole days are recomputed, so distinct counts stay exact, and a repeat changes nothing.
    """
    silver = read_table(spark, layout.silver, SILVER_STORED, layout.fmt)
    days = silver if dates is None else rows_of_dates(silver, dates)
    overwrite_touched(gold_summary(days), layout.summary, layout.fmt)
    overwrite_touched(gold_breakdown(days), layout.breakdown, layout.fmt)


def land_messages(messages: DataFrame, layout: TableLayout, batch: str) -> None:
    """Decode messages (column `value`) once: records to Bronze, what is malformed to quarantine.

    The same batch again replaces what it wrote before.
    """
    rows = landing_rows(messages).persist()
    try:
        land_records(rows.filter(F.col("record").isNotNull()).select("record.*", "ingested_at"),
                     layout, batch)
        overwrite_batch(rows.filter("malformed").select(*QUARANTINE.names[:2]), layout.quarantine,
                        batch, layout.fmt)
    finally:
        rows.unpersist()


def land_records(records: DataFrame, layout: TableLayout, batch: str) -> None:
    stamped = records if "ingested_at" in records.columns else records.withColumn(
        "ingested_at", F.current_timestamp())
    overwrite_batch(
        stamped.select(*BRONZE.names, F.to_date("ingested_at").alias("ingested_date")),
        layout.bronze, batch, layout.fmt)


def manifest(spark: SparkSession, layout: TableLayout) -> DataFrame:
    """An entry for each batch: rows, checksum of its content, input files, dates, done."""
    return read_table(spark, layout.batches, BATCHES, layout.fmt)


def fingerprint(bronze: DataFrame) -> tuple[int, str]:
    """(rows, checksum) of a batch's records, in whatever order; the time of ingestion is left out."""
    fields = [F.col(c) for c in RECORD.names]
    found = bronze.agg(F.count("*"), F.sum(F.xxhash64(*fields).cast("decimal(20,0)"))).first()
    return found[0], str(found[1])


def _note(spark: SparkSession, layout: TableLayout, batch: str, content: tuple[int, str],
          files: list[str], dates: Iterable[date], done: bool) -> None:
    entry = spark.createDataFrame(
        [(*content, files, sorted(dates), done)], T.StructType(BATCHES.fields[:-1]))
    overwrite_batch(entry.coalesce(1), layout.batches, batch, layout.fmt)


def build_lakehouse(spark: SparkSession, incoming: DataFrame, layout: TableLayout,
                    scorer: Scorer = KEYWORDS, terms: Sequence[SlangTerm] = (),
                    batch: str | None = None) -> str:
    """Take one batch through the three layers; its name is returned.

    `incoming` are records, or messages with their JSON in `value`. Bronze keeps the batch under
    its name and replaces it when it comes again. Silver takes the comments whose key no other batch
    has brought; Gold follows for the dates that changed. A batch may overlap earlier ones, and may be
    repeated after a failure at any point. One that comes again with the same content changes nothing; with other
    content, its rows in Silver are replaced, and a key that it no longer has goes to the next batch in
    Bronze that has it.
    """
    batch = batch or uuid.uuid4().hex
    ensure_tables(spark, layout)
    finish_swaps(spark, layout.root)
    land = land_messages if "value" in incoming.columns else land_records
    land(incoming, layout, batch)
    bronze = read_table(spark, layout.bronze, BRONZE_STORED, layout.fmt)
    landed = bronze.filter(F.col("batch_id") == batch).select(*BRONZE.names)
    content, files = fingerprint(landed), incoming.inputFiles()
    entry = manifest(spark, layout).filter(F.col("batch_id") == batch).first()
    if not (entry and entry.done and (entry.rows, entry.content) == content):
        dates = _replace(spark, layout, batch, landed, content[0], bronze, entry, scorer, terms,
                         lambda dates: _note(spark, layout, batch, content, files, dates, False))
        merge_gold(spark, layout, dates)
        _note(spark, layout, batch, content, files, dates, True)
    show_written(spark, layout)
    return batch


def _replace(spark: SparkSession, layout: TableLayout, batch: str, landed: DataFrame,
             rows: int, bronze: DataFrame, entry, scorer: Scorer, terms: Sequence[SlangTerm],
             announce: Callable[[set[date]], None]) -> set[date]:
    """Put a batch's rows into Silver in place of those it brought before; the dates that change.

    They are announced before anything does, so that a run after a failure knows them.
    """
    silver = silver_table(spark, layout)
    unique = first_per_key(admit(landed)).withColumn("landed_in", F.lit(batch))
    fresh = without_known(unique, silver.filter(F.col("landed_in") != batch), admit(landed), rows)
    dates: set[date] = set() if entry is None else set(entry.dates or [])
    landing = Landing(spark, layout)
    if entry is not None:
        before = silver.filter(F.col("landed_in") == batch)
        pieces = pieces_of(before)
        dates |= {day for _, day in pieces}
        heirs = _heirs(before, unique, bronze.filter(F.col("batch_id") != batch))
        fresh = fresh.unionByName(heirs)
        others = [(b, d) for b, d in pieces if b != batch]
        rest = silver.filter(F.concat_ws("/", "batch_id", "event_date").isin(
            [f"{b}/{d}" for b, d in others]) & (F.col("landed_in") != batch))
        landing.replace_pieces(rest, others, "rest")
        guests = silver.filter((F.col("batch_id") == batch) & (F.col("landed_in") != batch))
        fresh = fresh.unionByName(guests.select(*fresh.columns))
    scored = score(with_clean_text(gather(with_event_date(fresh))), scorer, terms)
    landing.replace_batch(silver_at_rest(scored, batch), batch)
    dates |= landing.dates(batch)
    announce(dates)
    landing.finish()
    return dates


def _heirs(before: DataFrame, unique: DataFrame, others: DataFrame) -> DataFrame:
    """Rows of other batches for keys that a batch brought before and has no more."""
    freed = before.select(*KEYS).join(unique.select(*KEYS), list(KEYS), "left_anti")
    named = others.withColumnRenamed("batch_id", "landed_in").drop("ingested_date")
    wanted = sieved(admit(named), freed).join(freed, list(KEYS), "left_semi")
    return first_per_key(wanted).select(*unique.columns)
