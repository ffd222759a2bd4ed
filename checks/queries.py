"""One registered query per operator. Dates leave as ISO text, times as epoch seconds."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import views as V
from voxlake.fixed_values import POSITIVE_KEYWORDS
from voxlake.functions import cleaning as C
from voxlake.functions import sentiment as M
from voxlake.functions import slang as S
from voxlake.functions import web as W
from voxlake.operators import corrections as COR
from voxlake.operators import dedup as D
from voxlake.operators import evaluation as E
from voxlake.operators import gold as G
from voxlake.operators import quality as Q
from voxlake.operators import reports as R
from voxlake.operators import scoring as SC
from voxlake.operators import validation as VAL
from voxlake.operators.cleaning import clean_comments, clean_fields
from voxlake.operators.dedup import first_per_key
from voxlake.operators.scoring import Scorer, score, with_hits
from voxlake.operators.threads import flatten_threads
from voxlake.plans.lakehouse import (
    build_lakehouse, land_messages, manifest, refresh_gold, scored_comments, silver_at_rest,
    silver_comments)
from voxlake.plans.landing import compact_silver, correct_silver, silver_table
from voxlake.schemas import (
    API_PAGE, BRONZE_STORED, GOLD_AUTHORS, GOLD_BREAKDOWN, GOLD_SKETCHES, GOLD_SUMMARY)
from voxlake.settings import TableLayout, lend_shared_folder, shared_folder
from voxlake.sources import records as REC
from voxlake.sources import tables as TAB
from voxlake.streaming.dedup import dedup_stream
from voxlake.streaming.late import late_table, progress
from voxlake.streaming.pipeline import (
    message_stream, run_available, sentiment_trend_stream, silver_stream, start_bronze,
    start_silver_keeping_late)
from voxlake.streaming.replay import replay_counts, start_replay

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name; the session runs in UTC."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        lend_shared_folder(spark)
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _portable(build(spark, sf))

    QUERIES[build.__name__] = run
    return build


def _portable(result: DataFrame) -> DataFrame:
    def plain(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DateType):
            return F.date_format(field.name, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.unix_timestamp(field.name).alias(field.name)
        return F.col(field.name)

    return result.select(*[plain(f) for f in result.schema.fields])


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver for readers of its numbers."""
    return scored_comments(V.duplicated(spark, sf))


def _silver_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Silver as it is written."""
    rows = V.duplicated(spark, sf).withColumn("ingested_at", F.current_timestamp())
    return silver_at_rest(silver_comments(rows, by_date=True))


# --- sources, sinks, catalog -------------------------------------------------------------------

@query
def json_decode(spark, sf):
    """JSON text by a fixed schema; some messages broken, empty or null."""
    n = F.col("event_id")
    raw = V.table(spark, sf, "events").select(
        "event_id", F.when(n % 50 == 0, "{bad").when(n % 50 == 1, "").when(n % 50 == 2, None)
        .when(n % 50 == 3, '{"k": "x"}').otherwise(F.col("props")).alias("value"))
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return REC.decode_json(raw, schema).select(
        "event_id", "malformed", F.col("record").isNotNull().alias("admitted"),
        F.col("record.k").alias("k"))


@query
def bootstrap_empty(spark, sf):
    """Create-if-missing leaves a filled table alone."""
    layout = TableLayout(shared_folder(spark, "bootstrap"))
    TAB.ensure_tables(spark, layout)
    TAB.append_table(_silver_rows(spark, sf), layout.silver, gathered=True)
    TAB.ensure_tables(spark, layout)
    return Q.layer_counts({
        name: TAB.read_table(spark, path, schema) for name, path, schema in TAB.contracts(layout)})


@query
def gold_incremental(spark, sf):
    """Two arrivals, top-level comments and then replies; the second refreshes its dates only."""
    layout = TableLayout(shared_folder(spark, "incremental"))
    TAB.ensure_tables(spark, layout)
    silver = _silver_rows(spark, sf)
    for arrival in (~F.col("is_reply"), F.col("is_reply")):
        TAB.append_table(silver.filter(arrival), layout.silver, gathered=True)
        refresh_gold(spark, layout, G.touched_dates(V.duplicated(spark, sf).filter(arrival)))
    return TAB.read_table(spark, layout.summary, GOLD_SUMMARY)


@query
def build_twice(spark, sf):
    """Two overlapping batches, the second of them twice."""
    layout = TableLayout(shared_folder(spark, "twice"))
    rows = V.duplicated(spark, sf).withColumn("ingested_at", F.timestamp_seconds(F.lit(V.START)))
    third = F.col("comment_id").cast("long") % 3
    build_lakehouse(spark, rows.filter(third < 2), layout, batch="one")
    for _ in range(2):
        build_lakehouse(spark, rows.filter(third > 0), layout, batch="two")
    return TAB.read_table(spark, layout.summary, GOLD_SUMMARY)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with the number their id ends in, stamped with one time of ingestion."""
    return rows.withColumn("ingested_at", F.timestamp_seconds(F.lit(V.START + 10_000_000)))


@query
def one_silver(spark, sf):
    """A stream, a batch build that overlaps it, a compaction, and the stream once more: one Silver."""
    layout = TableLayout(shared_folder(spark, "one_silver"))
    rows, third = V.copied(spark, sf), F.col("comment_id").cast("long") % 3
    folder = f"{layout.root}/messages"
    REC.keyed_messages(rows.filter(third == 0)).select("value").write.mode("append").text(folder)
    run_available(spark, message_stream(spark, path=folder), layout)
    build_lakehouse(spark, _numbered(rows.filter(third < 2)), layout, batch="overlapping")
    compact_silver(spark, layout, date(2024, 1, 5))
    REC.keyed_messages(rows.filter(third > 0)).select("value").write.mode("append").text(folder)
    run_available(spark, message_stream(spark, path=folder), layout)
    compact_silver(spark, layout, date(2030, 1, 1))
    return silver_table(spark, layout).select(
        "event_date", "video_id", "comment_id", "author", "like_count", "text_clean",
        "text_length", "collected_delay_seconds", "positive_score", "negative_score",
        "sentiment", "scorer")


@query
def gold_merged(spark, sf):
    """Old days get late rows: Gold is merged from the pieces' sums and authors."""
    layout = TableLayout(shared_folder(spark, "merged"))
    rows = _numbered(V.duplicated(spark, sf))
    late = F.col("comment_id").cast("long") % 5 == 0
    build_lakehouse(spark, rows.filter(~late), layout, batch="punctual")
    build_lakehouse(spark, rows.filter(late), layout, batch="late")
    return TAB.read_table(spark, layout.breakdown, GOLD_BREAKDOWN)


@query
def batch_names(spark, sf):
    """Batches whose names differ in one sign each keep their rows, and the manifest knows them."""
    layout = TableLayout(shared_folder(spark, "names"))
    rows = _numbered(V.sentiments(spark, sf))
    for i, name in enumerate(("in/a", "in_a", "in a", "in%2Fa")):
        build_lakehouse(spark, rows.filter(F.col("comment_id").cast("long") % 4 == i), layout,
                        batch=name)
    landed = TAB.read_table(spark, layout.bronze, BRONZE_STORED).groupBy("batch_id").agg(
        F.count("*").alias("bronze_rows"))
    kept = silver_table(spark, layout).groupBy("landed_in").agg(F.count("*").alias("silver_rows"))
    known = manifest(spark, layout).select("batch_id", F.col("rows").alias("manifest_rows"), "done")
    return landed.join(known, "batch_id").join(
        kept.withColumnRenamed("landed_in", "batch_id"), "batch_id")


@query
def corrected_batch(spark, sf):
    """A batch comes again with other texts and without some keys, which another batch has too."""
    layout = TableLayout(shared_folder(spark, "corrected"))
    rows = _numbered(V.sentiments(spark, sf))
    third = F.col("comment_id").cast("long") % 3
    build_lakehouse(spark, rows.filter(third < 2), layout, batch="one")
    build_lakehouse(spark, rows.filter(third > 0), layout, batch="two")
    compact_silver(spark, layout, date(2024, 1, 4))
    other = F.concat("text", F.lit(" love great"))
    build_lakehouse(spark, rows.filter(third == 0).withColumn("text", other), layout, batch="one")
    return TAB.read_table(spark, layout.summary, GOLD_SUMMARY)


@query
def distinct_by_week(spark, sf):
    """Videos and authors of each week, exact and from stored sketches, which must be within 5 %."""
    layout = TableLayout(shared_folder(spark, "sketches"))
    rows = _numbered(V.duplicated(spark, sf))
    for k in range(2):
        build_lakehouse(spark, rows.filter(F.col("comment_id").cast("long") % 2 == k), layout,
                        batch=f"half {k}")
    sketches, authors = [TAB.read_table(spark, path, schema) for path, schema in (
        (layout.sketches, GOLD_SKETCHES), (layout.authors, GOLD_AUTHORS))]
    return G.distinct_exact(authors).join(G.distinct_estimates(sketches), "period").select(
        "period", "videos", "authors",
        *[(F.abs(F.col(f"approx_{c}") - F.col(c)) <= 0.05 * F.col(c)).alias(f"{c}_close")
          for c in ("videos", "authors")])


@query
def correct_stored(spark, sf):
    """Corrections written into Silver, twice; Gold follows."""
    layout = TableLayout(shared_folder(spark, "correct"))
    build_lakehouse(spark, _numbered(V.duplicated(spark, sf)), layout, batch="one")
    for _ in range(2):
        correct_silver(spark, layout, V.corrections(spark, sf))
    stored = silver_table(spark, layout).groupBy("event_date", "video_id", "sentiment").agg(
        F.count("*").alias("silver_count"))
    return stored.join(TAB.read_table(spark, layout.breakdown, GOLD_BREAKDOWN),
                       ["event_date", "video_id", "sentiment"])


@query
def quarantine_rows(spark, sf):
    """Messages of two batches, one repeated: what is broken, and how much is well-formed."""
    layout = TableLayout(shared_folder(spark, "quarantine"))
    lines = REC.message_lines(spark, _message_folder(spark, V.duplicated(spark, sf), layout.root))
    for batch in ("one", "two", "two"):
        land_messages(lines, layout, batch)
    landed = spark.read.parquet(layout.bronze).groupBy("batch_id").agg(
        F.count("*").alias("records"), F.count("comment_id").alias("with_key"))
    broken = spark.read.parquet(layout.quarantine).groupBy("batch_id", "value").agg(
        F.count("*").alias("broken"))
    return landed.join(broken, "batch_id")


@query
def keyed_json_out(spark, sf):
    """Messages read back: the key, and what the JSON says."""
    rows = V.documents(spark, sf).withColumn("comment_id", F.expr(
        "CASE WHEN CAST(comment_id AS bigint) % 10 <> 0 THEN comment_id END"))
    value = F.from_json("value", "comment_id string, text string, like_count int, "
                                 "is_reply boolean, event_time string, collected_at string")
    return REC.keyed_messages(rows).select("key", value.alias("v")).select("key", "v.*")


@query
def thread_flatten(spark, sf):
    """Pages of one thread per turn: its first line on top, the other lines as replies."""
    lines = F.split("text", "\n")
    identity = F.concat_ws(":", "conv_id", "turn")
    when = F.timestamp_seconds(V.START + F.col("conv_id") * 3600 + F.col("turn") * 60)
    raw = V.table(spark, sf, "conversations").select(
        identity.alias("id"), when.alias("at"), F.concat(F.lit("v"), "conv_id").alias("video"),
        "role", lines.alias("lines"), F.col("turn").cast("int").alias("turn"))
    pages = raw.selectExpr("""
      array(named_struct(
        'snippet', named_struct(
          'topLevelComment', named_struct('id', id, 'snippet', named_struct(
            'publishedAt', at, 'videoId', video, 'authorDisplayName', role,
            'textOriginal', lines[0], 'textDisplay', 'unused', 'likeCount', turn,
            'parentId', CAST(NULL AS string))),
          'totalReplyCount', size(lines) - 1),
        'replies', CASE WHEN size(lines) > 1 THEN named_struct('comments',
          transform(slice(lines, 2, size(lines)), (line, i) -> named_struct(
            'id', concat(id, '.', i + 1), 'snippet', named_struct(
            'publishedAt', at, 'videoId', CAST(NULL AS string),
            'authorDisplayName', CAST(NULL AS string), 'textOriginal', '',
            'textDisplay', concat(' ', line, ' &amp; '), 'likeCount', CAST(NULL AS int),
            'parentId', id)))) END)) AS items
    """)
    assert pages.schema["items"].dataType.simpleString() == \
        API_PAGE["items"].dataType.simpleString()
    return flatten_threads(pages, F.timestamp_seconds(F.lit(V.START)), "fallback", "api")


@query
def eval_load(spark, sf):
    """Labelled rows written as CSV and read back: quotes and line breaks survive."""
    folder = shared_folder(spark, "labelled")
    rows = V.labelled(spark, sf).drop("lang").withColumn("text", F.concat(F.lit('"q", '), "text"))
    # another order of columns, and one more
    rows.select(F.lit("x").alias("extra"), *reversed(rows.columns)).write.options(
        header="true", quoteAll="true", escape='"').csv(folder)
    loaded = E.prepare_labelled(
        REC.read_labelled(spark, folder, ["text", "manual_label"]), "manual_label")
    return loaded.select("idx", "comment_id", "video_id", "text", "manual_label", "actual_label",
                         "reviewer_notes")


@query
def catalog_register(spark, sf):
    """Registered tables, asked by name in SQL."""
    layout = _catalog(spark, "catalog")
    rows = V.duplicated(spark, sf)
    later = F.col("comment_id").cast("long") % 2 == 0
    build_lakehouse(spark, rows.filter(~later), layout, batch="one")
    TAB.register_tables(spark, layout)
    build_lakehouse(spark, rows.filter(later), layout, batch="two")  # new dates among them
    return _by_name(spark, layout)


@query
def catalog_stream(spark, sf):
    """The same over a lake that a stream wrote."""
    layout = _catalog(spark, "catalog_stream")
    messages = message_stream(
        spark, path=_message_folder(spark, V.duplicated(spark, sf), layout.root))
    run_available(spark, messages, layout)
    TAB.register_tables(spark, layout)
    return _by_name(spark, layout)


def _catalog(spark: SparkSession, purpose: str) -> TableLayout:
    """A lake with a database of its own, named after its folder."""
    folder = shared_folder(spark, purpose)
    return TableLayout(folder, database=folder.rpartition("/")[2].replace("-", "_"))


def _by_name(spark: SparkSession, layout: TableLayout) -> DataFrame:
    return spark.sql(f"""
      SELECT s.video_id, s.silver_comments, g.gold_comments FROM (
        SELECT video_id, count(*) AS silver_comments
        FROM {layout.database}.{layout.silver_name} GROUP BY video_id) s
      JOIN (SELECT video_id, sum(total_comments) AS gold_comments
        FROM {layout.database}.{layout.summary_name} GROUP BY video_id) g
      ON s.video_id = g.video_id""")


@query
def path_table_count(spark, sf):
    """Tables addressed by path."""
    return Q.layer_counts({name: TAB.by_path(spark, f"{sf}/{name}.parquet")
                           for name in ("documents", "events", "conversations")})


@query
def apply_corrections(spark, sf):
    return COR.apply_corrections(_silver(spark, sf), V.corrections(spark, sf)).select(
        "video_id", "comment_id", "sentiment")


# --- projections and scalar functions ----------------------------------------------------------

@query
def clean_strings(spark, sf):
    return clean_fields(V.flawed(spark, sf)).select(
        "comment_id", "video_id", "author", "text", "lang", "source")


@query
def normalize_text(spark, sf):
    text = C.normalize_text(F.col("text"))
    return V.sentiments(spark, sf).select(
        "comment_id", text.alias("text_clean"), F.length(text).alias("text_length"))


@query
def clean_numbers(spark, sf):
    rows = V.documents(spark, sf).withColumn(
        "is_reply", F.when(F.col("reply_count") != 3, F.col("is_reply")))
    return clean_fields(rows).select("comment_id", "like_count", "reply_count", "is_reply")


@query
def collected_delay(spark, sf):
    return clean_fields(V.documents(spark, sf)).select(
        "comment_id", "collected_at", "collected_delay_seconds")


@query
def clean_parents(spark, sf):
    return clean_fields(V.flawed(spark, sf)).select("comment_id", "is_reply", "parent_comment_id")


@query
def keyword_hits(spark, sf):
    hits = M.keyword_hits(C.normalize_text(F.col("text")), POSITIVE_KEYWORDS)
    return V.sentiments(spark, sf).select("comment_id", hits.alias("positive_hits"))


@query
def keyword_sentiment(spark, sf):
    return score(clean_comments(V.sentiments(spark, sf)), Scorer("keyword")).select(
        "comment_id", "positive_score", "negative_score", "sentiment")


@query
def keyword_confidence(spark, sf):
    counted = SC.with_hits(clean_comments(V.sentiments(spark, sf)), "text_clean")
    return counted.select("comment_id", M.confidence_from_hits(
        F.col("_up"), F.col("_down")).alias("confidence"))


@query
def decode_escapes(spark, sf):
    return V.escaped(spark, sf).select(
        "comment_id", S.decode_escapes(F.col("text")).alias("decoded"))


@query
def elongation(spark, sf):
    return V.slangy(spark, sf).select("comment_id", S.expand_stretched(
        C.normalize_text(F.col("text"))).alias("expanded"))


@query
def slang_normalize(spark, sf):
    return V.slangy(spark, sf).select(
        "comment_id", S.scoring_text(F.col("text"), S.slang_terms()).alias("scoring_text"))


@query
def slang_hits(spark, sf):
    """How often some one-word terms occur as words."""
    rows = V.slangy(spark, sf).withColumn("clean", C.normalize_text(F.col("text")))
    return rows.select("comment_id", *[
        S.term_count(F.col("clean"), S.SlangTerm(t, t)).alias(f"hits_{t}")
        for t in ("w", "l", "fire", "goat", "bro")])


@query
def slang_sentiment(spark, sf):
    """Keyword scores after slang replacement."""
    return score(clean_comments(V.slangy(spark, sf)), Scorer("keyword"), S.slang_terms()).select(
        "comment_id", "positive_score", "negative_score", "sentiment")


@query
def normalize_label(spark, sf):
    return V.raw_labels(spark, sf).select(
        "doc_id", M.normalize_label(F.col("label")).alias("sentiment"))


@query
def score_argmax(spark, sf):
    """The strongest of three counts from the text: keyword hits, and question marks between."""
    rows = with_hits(clean_comments(V.sentiments(spark, sf)), "text_clean")
    marks = F.length("text") - F.length(F.replace("text", F.lit("?"), F.lit("")))
    best = M.strongest(F.col("_up").cast("double"), marks.cast("double"),
                       F.col("_down").cast("double"))
    return rows.select("comment_id", best.alias("sentiment"))


@query
def record_defaults(spark, sf):
    """Records whose counts and flags arrive as text."""
    n = F.col("comment_id").cast("long")
    raw = V.flawed(spark, sf).withColumns({
        "like_count": F.when(n % 6 != 0, F.col("like_count").cast("string")),
        "reply_count": F.when(n % 7 == 0, "").otherwise(F.col("reply_count").cast("string")),
        "is_reply": F.when(F.col("is_reply"), " Yes ").when(n % 3 == 0, "no"),
        "lang": F.when(n % 9 != 0, F.col("lang")),
        "text": F.concat(F.lit("\n\t "), "text", F.lit("  "))})
    return VAL.with_defaults(raw, "files").select(
        "comment_id", "collected_at", "source", "lang", "like_count", "reply_count", "is_reply",
        "text")


@query
def parse_bool(spark, sf):
    """Spellings chosen by the number in the event's JSON, and the event's value as a number."""
    flags = ["1", "TRUE", " yes ", "y", "On", "0", "no", "", "2", None]
    spelled = F.element_at(F.array(*[F.lit(x) for x in flags]), (F.get_json_object(
        "props", "$.k").cast("int") % 10 + 1))
    return V.table(spark, sf, "events").select(
        "event_id", C.parse_bool(spelled).alias("flag"),
        C.number_is_true(F.floor("value") % 3).alias("number_flag"))


@query
def html_unescape(spark, sf):
    return V.table(spark, sf, "pages").select(
        "page_id", W.unescape_entities(F.col("html")).alias("html"))


@query
def html_unescape_basic(spark, sf):
    return V.table(spark, sf, "pages").select(
        "page_id", W.unescape_basic_entities(F.col("html")).alias("html"))


@query
def url_key(spark, sf):
    """Page addresses, and watch and short links made from them."""
    n = F.col("page_id")
    watch = F.concat(F.lit("https://www.youtube.com/watch?list=a&v=p%20"), n, F.lit("&t=1#x"))
    short = F.concat(F.lit(" https://youtu.be/p"), n, F.lit("/more?si=2"))
    plain = F.concat(F.lit("p"), n, F.lit("&feature=1"))
    links = F.explode(F.array("url", watch, short, plain)).alias("link")
    return V.table(spark, sf, "pages").select("page_id", links).select(
        "page_id", "link", W.video_key(F.col("link")).alias("video_key"))


# --- filters, validation, joins ----------------------------------------------------------------

@query
def silver_clean(spark, sf):
    return clean_comments(V.sentiments(spark, sf)).select(
        "event_time", "collected_at", "comment_id", "video_id", "author", "like_count",
        "reply_count", "is_reply", "parent_comment_id", "lang", "source", "text_clean",
        "text_length", "collected_delay_seconds")


@query
def validate_reasons(spark, sf):
    judged = VAL.with_reasons(VAL.with_defaults(V.flawed(spark, sf), ""), "src3")
    return judged.select("comment_id", F.concat_ws("; ", "reasons").alias("reasons"))


@query
def quarantine_split(spark, sf):
    records = VAL.with_defaults(V.flawed(spark, sf), "")
    valid, quarantined = VAL.split_valid(records)
    return Q.layer_counts({"valid": valid, "quarantined": quarantined}).join(
        VAL.ingestion_counts(records).select(
            F.explode(F.array(
                F.struct(F.lit("valid").alias("layer"), F.col("sent_count").alias("counted")),
                F.struct(F.lit("quarantined").alias("layer"),
                         F.col("skipped_invalid_count").alias("counted")))).alias("c")
        ).select("c.*"), "layer")


@query
def dq_null_checks(spark, sf):
    return Q.null_checks({
        "bronze": (V.duplicated(spark, sf), ["comment_id", "collected_at", "parent_comment_id"]),
        "silver": (_silver(spark, sf), ["comment_id", "sentiment", "parent_comment_id"])})


@query
def attach_predictions(spark, sf):
    """Predictions for the labelled comments, joined to the whole of Silver."""
    comments = first_per_key(clean_comments(V.duplicated(spark, sf)))
    wanted = V.corrections(spark, sf).select("comment_id")
    scored = score(comments.join(wanted, "comment_id", "left_semi"), Scorer("keyword"))
    predictions = scored.select("video_id", "comment_id", "positive_score", "negative_score",
                                "sentiment")
    return SC.attach_predictions(comments.select("video_id", "comment_id", "author"), predictions)


@query
def new_records_only(spark, sf):
    """Incoming records with some blank ids, against the ids that have a label."""
    rows = V.duplicated(spark, sf)
    blank = F.col("comment_id").cast("long") % 10 == 0
    incoming = rows.withColumn("comment_id", F.when(~blank, F.col("comment_id")).otherwise(" "))
    return D.new_records_only(incoming, V.corrections(spark, sf)).select(
        "comment_id", "author", "like_count")


# --- gold and quality --------------------------------------------------------------------------

@query
def gold_summary(spark, sf):
    return G.gold_summary(_silver(spark, sf))


@query
def gold_breakdown(spark, sf):
    return G.gold_breakdown(_silver(spark, sf))


def _layers(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The layers as tables: each is computed once, from the one below, and then checked."""
    folder = shared_folder(spark, "layers")

    def table(name: str, rows: DataFrame) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    bronze = V.duplicated(spark, sf)
    silver = table("silver", scored_comments(bronze).drop("text", "text_clean"))
    return {"bronze": bronze, "silver": silver,
            "gold_summary": table("summary", G.gold_summary(silver)),
            "gold_breakdown": table("breakdown", G.gold_breakdown(silver))}


@query
def gold_reconcile(spark, sf):
    layers = _layers(spark, sf)
    return Q.gold_reconcile(layers["gold_summary"], layers["gold_breakdown"])


@query
def layer_flow_check(spark, sf):
    layers = _layers(spark, sf)
    return Q.layer_flow_check(layers["bronze"], layers["silver"].filter("video_id <> 'src3'"),
                              layers["gold_summary"], layers["gold_breakdown"])




@query
def layer_counts(spark, sf):
    return Q.layer_counts(_layers(spark, sf))


@query
def distinct_videos(spark, sf):
    return Q.distinct_videos(_layers(spark, sf))


@query
def duplicate_keys(spark, sf):
    return Q.duplicate_keys(V.duplicated(spark, sf))


@query
def duplicate_key_count(spark, sf):
    return Q.duplicate_key_count(V.duplicated(spark, sf), ["comment_id"])


@query
def silver_invariants(spark, sf):
    """Counted before admission, so that there is something to count."""
    return Q.silver_invariants(clean_fields(V.flawed(spark, sf)))


@query
def gold_invariants(spark, sf):
    """The summary, and beside it a copy with one total off per reply-free group."""
    summary = G.gold_summary(_silver(spark, sf))
    broken = summary.withColumn("total_comments", F.col("total_comments") + F.when(
        F.col("reply_comment_count") == 0, 1).otherwise(0))
    return Q.as_checks(Q.gold_invariants(summary.unionByName(broken)))


@query
def sentiment_distribution(spark, sf):
    return Q.sentiment_distribution(_silver(spark, sf), per_video=True)


@query
def silver_gold_agreement(spark, sf):
    layers = _layers(spark, sf)
    return Q.silver_gold_agreement(layers["silver"], layers["gold_breakdown"])


@query
def freshness(spark, sf):
    return Q.freshness(V.sentiments(spark, sf), "event_time", "collected_at")


# --- windows, sorts, limits, reports -----------------------------------------------------------

@query
def sentiment_share(spark, sf):
    return R.sentiment_share(_silver(spark, sf))


@query
def dedup_first(spark, sf):
    return first_per_key(V.duplicated(spark, sf)).select(
        "video_id", "comment_id", "like_count", "text")


@query
def latest_n(spark, sf):
    return R.latest(silver_comments(V.duplicated(spark, sf)), 20, "collected_at",
                    ["comment_id", "video_id", "author", "text_clean", "sentiment",
                     "collected_at"])


@query
def top_positive_authors(spark, sf):
    return R.top_positive_authors(_silver(spark, sf))


@query
def top_liked_comments(spark, sf):
    return R.top_liked_comments(_silver(spark, sf)).select(
        "video_id", "comment_id", "like_count", "rank")


@query
def top_liked_ties(spark, sf):
    """With those that tie, over sentiments of a video."""
    return R.top_liked_comments(_silver(spark, sf), 2, ["video_id", "sentiment"], keep_ties=True
                                ).select("video_id", "sentiment", "comment_id", "like_count", "rank")


@query
def replies_per_day(spark, sf):
    return R.replies_per_day(_silver(spark, sf))


@query
def sentiment_trend(spark, sf):
    return R.sentiment_trend(_silver(spark, sf), "6 hours")


@query
def negative_sample(spark, sf):
    return R.negative_sample(silver_comments(V.duplicated(spark, sf)))


@query
def comments_per_video(spark, sf):
    return R.comments_per_video(V.conversations(spark, sf))


@query
def reply_split(spark, sf):
    return R.reply_split(V.conversations(spark, sf))


@query
def hourly_volume(spark, sf):
    return R.hourly_volume(V.events(spark, sf), "event_time")


@query
def distinct_video_list(spark, sf):
    return R.distinct_video_list(V.events(spark, sf))


@query
def kpi_report(spark, sf):
    return R.kpi_report(G.gold_summary(_silver(spark, sf)))


@query
def breakdown_report(spark, sf):
    return R.breakdown_report(G.gold_breakdown(_silver(spark, sf)))


@query
def largest_breakdowns(spark, sf):
    return R.largest_breakdowns(G.gold_breakdown(_silver(spark, sf)))


# --- evaluation --------------------------------------------------------------------------------

def _detail(spark: SparkSession, sf: str) -> DataFrame:
    rows = E.prepare_labelled(V.labelled(spark, sf), "manual_label")
    return E.evaluation_detail(E.keyword_predictions(rows), review_column="lang")


@query
def eval_detail(spark, sf):
    return _detail(spark, sf)


@query
def eval_accuracy(spark, sf):
    return E.accuracy(_detail(spark, sf))


@query
def eval_distributions(spark, sf):
    return E.label_distributions(_detail(spark, sf))


@query
def confusion_matrix(spark, sf):
    return E.confusion_matrix(_detail(spark, sf))


@query
def label_prf(spark, sf):
    return E.label_metrics(_detail(spark, sf))


@query
def macro_f1(spark, sf):
    return E.macro_f1(_detail(spark, sf))


@query
def accuracy_by_bucket(spark, sf):
    return E.accuracy_by_bucket(_detail(spark, sf))


@query
def top_mismatches(spark, sf):
    return E.top_mismatches(_detail(spark, sf))


@query
def eval_summary(spark, sf):
    """The JSON summary, written, read back and taken apart."""
    folder = shared_folder(spark, "summary")
    REC.write_summary(E.evaluation_summary(_detail(spark, sf), evaluation_mode="keyword"), folder)
    parsed = F.from_json("value", "total_rows long, correct_rows long, mismatch_count long, "
                                  "evaluation_mode string, top_mismatches array<struct<idx:string>>")
    return spark.read.text(folder).select(parsed.alias("v")).select(
        "v.total_rows", "v.correct_rows", "v.mismatch_count", "v.evaluation_mode",
        F.size("v.top_mismatches").cast("long").alias("listed"))


def _pair_name(predicted: str) -> Callable[[Column], Column]:
    return lambda m: F.concat_ws(" as ", m["actual_label"], F.lit(predicted))


@query
def eval_summary_fields(spark, sf):
    """Every field of the written summary, and the bucket table beside it, a row for each value."""
    folder, detail = shared_folder(spark, "fields"), _detail(spark, sf)
    REC.write_summary(E.evaluation_summary(detail), f"{folder}/summary")
    E.accuracy_by_bucket(detail).write.json(f"{folder}/buckets")
    counts = "positive: long, neutral: long, negative: long"
    schema = (f"total_rows long, correct_rows long, agreement_accuracy double, macro_f1 double, "
              f"mismatch_count long, actual_distribution struct<{counts}>, "
              f"predicted_distribution struct<{counts}>, "
              f"confusion_matrix array<struct<actual_label: string, {counts}>>, "
              f"label_metrics array<struct<label: string, precision: double, recall: double, "
              f"f1_score: double, support: long>>, top_mismatches array<struct<idx: string>>")
    parsed = spark.read.text(f"{folder}/summary").select(
        F.from_json("value", schema).alias("v")).select("v.*")

    def entry(field, name, value):
        return F.struct(F.lit(field).alias("field"), name.alias("name"),
                        value.cast("double").alias("value"))

    def per_label(array, field, name, value):
        return F.transform(array, lambda m: entry(field, name(m), m[value]))

    sides = ("actual_distribution", "predicted_distribution")
    labels = ("positive", "neutral", "negative")
    values = F.concat(
        F.array(*[entry(c, F.lit(""), F.col(c)) for c in (
            "total_rows", "correct_rows", "agreement_accuracy", "macro_f1", "mismatch_count")]),
        F.array(*[entry(side, F.lit(s), F.col(side)[s]) for side in sides for s in labels]),
        *[per_label("label_metrics", c, lambda m: m["label"], c)
          for c in ("precision", "recall", "f1_score", "support")],
        *[per_label("confusion_matrix", "confusion", _pair_name(s), s) for s in labels],
        F.transform("top_mismatches", lambda m, i: entry("mismatch", m["idx"], i + 1)))
    buckets = spark.read.schema("review_bucket string, accuracy double").json(f"{folder}/buckets")
    return parsed.select(F.explode(values).alias("e")).select("e.*").unionByName(buckets.select(
        F.lit("bucket").alias("field"), F.col("review_bucket").alias("name"),
        F.col("accuracy").alias("value")))


# --- predictor and streams ---------------------------------------------------------------------

@query
def score_batches(spark, sf):
    """A predictor that is no built-in expression, run on the executors: it weighs vowels."""
    class Vowels:
        def predict(self, texts):
            rows = []
            for text in texts:
                share = 100 * sum(c in "aeiou" for c in text) // max(1, len(text))
                rows.append({"positive_score": share, "negative_score": 100 - share, "sentiment":
                             "positive" if share > 40 else "neutral" if share > 30 else "negative"})
            return rows

    comments = clean_comments(V.sentiments(spark, sf))
    return score(comments, Scorer("vowels", Vowels)).select(
        "comment_id", "positive_score", "negative_score", "sentiment")


def _message_folder(spark: SparkSession, rows: DataFrame, root: str) -> str:
    """Messages as lines of text, with a broken line for every fiftieth record."""
    broken = F.when(F.col("key").cast("long") % 50 == 0, F.array("value", F.lit("{bad")))
    lines = REC.keyed_messages(rows).select(
        F.explode(F.coalesce(broken, F.array("value"))).alias("value"))
    lines.write.text(f"{root}/messages")
    return f"{root}/messages"


def _drain(stream: DataFrame, root: str, name: str) -> DataFrame:
    """Run a stream over what there is, and read its output."""
    path = f"{root}/{name}"
    (stream.writeStream.format("parquet").option("checkpointLocation", f"{path}_checkpoint")
     .trigger(availableNow=True).start(path).awaitTermination())
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


@query
def stream_dedup(spark, sf):
    root = shared_folder(spark, "stream_dedup")
    messages = message_stream(spark, path=_message_folder(spark, V.duplicated(spark, sf), root))
    unique = dedup_stream(clean_comments(REC.bronze_rows(messages)))
    return _drain(unique.select("video_id", "comment_id", "text_clean"), root, "unique")


@query
def stream_silver(spark, sf):
    root = shared_folder(spark, "stream_silver")
    messages = message_stream(spark, path=_message_folder(spark, V.copied(spark, sf), root))
    silver = silver_stream(REC.bronze_rows(messages)).select(
        "event_date", "video_id", "comment_id", "author", "like_count", "text_clean",
        "text_length", "collected_delay_seconds", "positive_score", "negative_score",
        "sentiment", "scorer")
    return _drain(silver, root, "silver")


@query
def stream_end_to_end(spark, sf):
    """Messages through Bronze and Silver to Gold, three chained queries."""
    layout = TableLayout(shared_folder(spark, "stream"))
    messages = message_stream(
        spark, path=_message_folder(spark, V.copied(spark, sf), layout.root))
    run_available(spark, messages, layout)
    return TAB.read_table(spark, layout.summary, GOLD_SUMMARY)


def _arrival() -> Column:
    """Which of three arrivals a comment is in: half, the rest, and some that are very late."""
    n = F.col("comment_id").cast("long")
    return F.when(n % 50 == 7, 2).when(n % 1000 < 500, 0).otherwise(1)


@query
def late_rows_kept(spark, sf):
    """Three arrivals: what is two days late goes to a table of its own, and is counted."""
    layout = TableLayout(shared_folder(spark, "late"))
    rows, folder = V.sentiments(spark, sf), f"{layout.root}/messages"
    TAB.ensure_tables(spark, layout)
    for k in range(3):
        REC.keyed_messages(rows.filter(_arrival() == k)).select("value").write.mode("append").text(folder)
        start_bronze(message_stream(spark, path=folder), layout, once=True).awaitTermination()
        start_silver_keeping_late(spark, layout, once=True).awaitTermination()
    found = progress(spark, layout)
    return (silver_table(spark, layout).select(F.lit("main").alias("place"), "comment_id",
                                               F.lit(1).cast("long").alias("n"))
            .unionByName(late_table(spark, layout).select(
                F.lit("late").alias("place"), "comment_id", F.lit(1).cast("long").alias("n")))
            .unionByName(found.where("rows > 0").select(
                F.lit("metric").alias("place"),
                F.row_number().over(Window.orderBy("epoch")).cast("string").alias("comment_id"),
                F.col("late").alias("n"))))


@query
def sentiment_trend_stream_windows(spark, sf):
    """The trend of a stream in three arrivals: closed windows, late rows left out."""
    root = shared_folder(spark, "trend")
    rows = _silver(spark, sf).select("comment_id", "event_time", "sentiment", "like_count")
    for k in range(3):
        rows.filter(_arrival() == k).coalesce(1).write.mode("append").parquet(f"{root}/silver")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/silver")
        closed = _drain(sentiment_trend_stream(stream), root, "closed")
    return closed


@query
def replay_lines(spark, sf):
    """Lines in several files replayed two files an epoch, broken ones among them: what is counted."""
    root = shared_folder(spark, "replay")
    folder = _message_folder(spark, V.flawed(spark, sf).repartition(5, "comment_id"), root)
    start_replay(spark, folder, f"{root}/out", 2, skip_invalid=True, default_source="",
                 once=True).awaitTermination()
    return replay_counts(spark, f"{root}/out").agg(*[
        F.sum(c).alias(c) for c in ("incoming", "published", "quarantined", "broken")])
