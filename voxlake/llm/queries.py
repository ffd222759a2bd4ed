"""One registered query per operator: thin, over whole tables, with production parameters."""

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlake.llm.decontamination import contamination, covered
from voxlake.llm.near_duplicates import near_duplicates
from voxlake.llm.periodic_runs import periodic_runs, repeated_tails, run_digest
from voxlake.llm.quality_classifier import quality_scores
from voxlake.llm.repeated_passages import without_repeats
from voxlake.llm.sanitisation import KINDS, sanitisation, span_text
from voxlake.llm.source_mixing import mixing_rates
from voxlake.llm.storage import ship_package
from voxlake.llm.token_alignment import alignment
from voxlake.llm.token_counts import COUNTS, edit_aware_counts
from voxlake.llm.token_files import token_files
from voxlake.llm.top_k import top_k
from voxlake.llm.toxicity import toxicity_scores
from voxlake.llm.url_filter import Rule, url_host, url_verdicts
from voxlake.settings import lend_shared_folder, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        lend_shared_folder(spark)
        ship_package(spark)
        return build(spark, sf)

    QUERIES[build.__name__] = run
    return build


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op4_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), similarity=85)


@query
def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    names = F.transform("items", lambda i: i.cast("string"))
    return found.select(
        "doc_id", "n_words", covered("ranges").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(names), ","), 256).alias("items_sha256"),
        (F.size("ranges") > 0).alias("contaminated"))


RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
         Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
         Rule("block", "com", "/de/")]


@query
def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Listed: addresses with a hyphen in the host, or reached by a tracking link."""
    listing = url_host(F.col("url")).contains("-") | F.col("url").contains("utm_source=")
    return url_verdicts(table(spark, sf, "pages").select("page_id", "url"), listing, RULES).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op7_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op10_sanitisation(spark: SparkSession, sf: str) -> DataFrame:
    found = sanitisation(table(spark, sf, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, F.lit(kind).eqNullSafe)).cast("long").alias(f"n_{kind}")
              for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.concat("base", "added")).alias("spans"))


@query
def op3_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity_scores(table(spark, sf, "documents"), table(spark, sf, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


#: Domains of the labelled table: toxic, else poor, else plain; and their shares of the mixture.
DOMAIN = "CASE WHEN toxic = 1 THEN 2 WHEN quality = 0 THEN 1 WHEN quality = 1 THEN 0 END"
WEIGHTS = {"plain": 0.87, "poor": 0.08, "toxic": 0.05}


@query
def op1_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing_rates(table(spark, sf, "documents"), table(spark, sf, "labels"), F.expr(DOMAIN),
                        WEIGHTS)


@query
def op5_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    found = without_repeats(table(spark, sf, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    return found.select(
        "doc_id", "n_bytes", gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PRE_TOKENS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
              r"|\s+(?!\S)|\s+")
#: Edits of a cleaning pass: addresses hidden, runs of symbols taken out.
CLEANING = [(r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+", "<email>"), (r"([$%&#*!])\1+", "")]


@query
def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return edit_aware_counts(table(spark, sf, "documents"), CLEANING, TOKENIZER, PRE_TOKENS,
                             columns=COUNTS)


TOKENIZERS = "/opt/tokenizers"
END_OF_DOCUMENT = 2


def tokenizer_file(name: str, folder: str = TOKENIZERS) -> bytes:
    """A tokenizer's file, read by the driver; tasks get its content."""
    return Path(folder, name).read_bytes()


@query
def op11_token_files(spark: SparkSession, sf: str) -> DataFrame:
    found = token_files(table(spark, sf, "documents"), shared_folder(spark, "token-files"),
                        tokenizer_file("byte_bpe_50k.json"), END_OF_DOCUMENT)
    return found.select("doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


@query
def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return alignment(table(spark, sf, "documents"), tokenizer_file("byte_bpe_50k.json"),
                     tokenizer_file("piece_bpe_32k.model"))


@query
def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    return run_digest(periodic_runs(table(spark, sf, "documents"), prepared=repeated_tails))
