"""Jobs for spark-submit: python -m voxlake {ingest,replay,build,bronze,silver,gold,...} ..."""

import argparse
import importlib
import json
from datetime import date

from pyspark.sql import SparkSession

from voxlake.functions.slang import slang_terms
from voxlake.operators.scoring import Scorer, choose_scorer
from voxlake.operators.threads import flatten_threads
from voxlake.plans.evaluation import evaluate_file
from voxlake.plans.ingestion import ingest, ingest_lines
from voxlake.plans.lakehouse import build_lakehouse
from voxlake.plans.landing import compact_silver, correct_silver
from voxlake.settings import ScoringSettings, TableLayout
from voxlake.sources.records import message_lines, read_api_pages, read_slang
from voxlake.sources.tables import ensure_tables, register_tables
from voxlake.streaming import pipeline as P
from voxlake.streaming.replay import replay_counts, start_replay


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="voxlake")
    parser.add_argument("job", choices=(
        "ingest", "replay", "build", "bronze", "silver", "gold", "compact", "correct", "evaluate",
        "register"))
    parser.add_argument("--root", required=True, help="folder of the tables, or of the evaluation")
    parser.add_argument("--input", help="JSON lines, labelled CSV, or folder of messages")
    parser.add_argument("--kafka", nargs=2, metavar=("SERVERS", "TOPIC"))
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--slang", default="built-in", help="lexicon file, 'built-in' or 'none'")
    parser.add_argument("--once", action="store_true", help="process what is there, then stop")
    parser.add_argument("--every", help="time between Gold refreshes, such as '10 minutes'")
    parser.add_argument("--label-column", default="manual_label")
    parser.add_argument("--notes-column", default="reviewer_notes")
    parser.add_argument("--review-column")
    parser.add_argument("--batch", help="name of the batch to build; one of its own if not given. A "
                                        "batch of the same name replaces what it brought before")
    parser.add_argument("--files", type=int, default=1, help="files of an epoch of a replay")
    parser.add_argument("--before", help="compact dates before this one, such as 2026-05-01")
    parser.add_argument("--keep-late", action="store_true",
                        help="silver: late rows go to a table of their own")
    parser.add_argument("--pages", action="store_true", help="ingest API pages, not records")
    parser.add_argument("--landed", help="table with the comment_id values already there")
    parser.add_argument("--video", help="the only video that ingested records may belong to")
    parser.add_argument("--skip-invalid", action="store_true")
    parser.add_argument("--model", help="module:factory of a predictor or classifier")
    parser.add_argument("--no-fallback", action="store_true", help="fail if there is no model")
    parser.add_argument("--batch-size", type=int, default=16)
    return parser.parse_args()


def _terms(spark: SparkSession, choice: str):
    if choice == "none":
        return []
    return slang_terms() if choice == "built-in" else read_slang(spark, choice)


def _factory(name: str | None):
    if name is None:
        return None
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def _scorer(args: argparse.Namespace) -> Scorer:
    settings = ScoringSettings("model" if args.model else "keyword", not args.no_fallback,
                               args.batch_size)
    return choose_scorer(settings, _factory(args.model))


def main() -> None:
    args = _arguments()
    spark = (SparkSession.builder.appName(f"voxlake {args.job}")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    layout = TableLayout(args.root, fmt=args.format)
    if args.job == "evaluate":
        evaluate_file(spark, args.input, args.root, args.label_column, args.notes_column,
                      args.review_column, _terms(spark, args.slang), _factory(args.model),
                      args.batch_size, args.slang, args.model).show(truncate=False)
        return
    if args.job == "ingest":
        landed = spark.read.parquet(args.landed) if args.landed else None
        if args.pages:
            counts = ingest(flatten_threads(read_api_pages(spark, args.input)), args.root, landed,
                            args.video, args.skip_invalid)
        else:
            counts = ingest_lines(message_lines(spark, args.input), args.root, landed, args.video,
                                  args.skip_invalid)
        return print(json.dumps(counts))
    if args.job == "replay":
        start_replay(spark, args.input, args.root, args.files, expected_video=args.video,
                     skip_invalid=args.skip_invalid, once=args.once).awaitTermination()
        return replay_counts(spark, args.root).show(truncate=False)
    if args.job == "compact":
        finished = compact_silver(spark, layout, date.fromisoformat(args.before))
        return print(json.dumps([str(day) for day in finished]))
    if args.job == "correct":
        fixes = spark.read.option("header", "true").csv(args.input)
        return print(json.dumps([str(day) for day in correct_silver(spark, layout, fixes)]))
    if args.job == "register":
        return register_tables(spark, layout)
    if args.job == "build":
        build_lakehouse(spark, message_lines(spark, args.input), layout, _scorer(args),
                        _terms(spark, args.slang), args.batch)
        return
    ensure_tables(spark, layout)
    if args.job == "bronze":
        source = (P.message_stream(spark, "kafka", **{
            "kafka.bootstrap.servers": args.kafka[0], "subscribe": args.kafka[1]})
            if args.kafka else P.message_stream(spark, path=args.input))
        query = P.start_bronze(source, layout, args.once)
    elif args.job == "silver":
        start = P.start_silver_keeping_late if args.keep_late else P.start_silver
        query = start(spark, layout, _scorer(args), _terms(spark, args.slang), once=args.once)
    else:
        query = P.start_gold(spark, layout, args.once, args.every)
    query.awaitTermination()


if __name__ == "__main__":
    main()
