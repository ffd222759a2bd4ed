"""DuckDB SQL that computes what each registered query computes, in its own way."""

from voxlake.fixed_values import NEGATIVE_KEYWORDS, POSITIVE_KEYWORDS, SENTIMENTS, SLANG

START = 1704067200
BLANK = r"[ \t\n\x0B\f\r]"
ANY_BLANK = r"[\t-\r\x1c-\x1f\x{85}\pZ]+"
WORD = r"[\p{L}\p{N}_]"
NO_WORD = r"[^\p{L}\p{N}_]"


# --- expressions -------------------------------------------------------------------------------

def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{BLANK}+', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{ANY_BLANK}|{ANY_BLANK}$', '', 'g')"


def normalized(x: str) -> str:
    no_blank = r"[^ \t\n\x0B\f\r]+"
    return squeeze(f"regexp_replace(lower(coalesce({x}, '')), "
                   rf"'https?://{no_blank}|www\.{no_blank}', ' ', 'g')")


def hits(x: str, keywords) -> str:
    return " + ".join(f"CAST(contains({x}, {quoted(k)}) AS INT)" for k in keywords)


def half_up(part: str, whole: str, digits: int) -> str:
    """part / whole rounded half up, in integers."""
    scale = 10 ** digits
    return (f"CAST((CAST({part} AS BIGINT) * {2 * scale} + {whole}) // (2 * {whole}) AS DOUBLE)"
            f" / CAST({scale} AS DOUBLE)")


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def seconds(x: str) -> str:
    return f"CAST(floor(epoch({x})) AS BIGINT)"


def moment(x: str) -> str:
    return f"make_timestamp(CAST(({x}) * 1000000 AS BIGINT))"


def case_of(values, index: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {quoted(v) if v is not None else 'NULL'}"
                    for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


# --- views -------------------------------------------------------------------------------------

C_DOC = f"""
SELECT doc_id, CAST(doc_id AS VARCHAR) comment_id, source video_id,
  'u' || CAST(doc_id % 97 AS VARCHAR) author, text,
  CAST(CASE WHEN doc_id % 11 = 0 THEN -1 ELSE n_chars % 100 END AS INT) like_count,
  CAST(doc_id % 5 AS INT) reply_count, doc_id % 4 = 0 is_reply,
  CASE WHEN doc_id % 4 = 0 AND doc_id % 20 <> 0 THEN CAST(doc_id + 1 AS VARCHAR) END parent_comment_id,
  lang, source, {moment(f'{START} + doc_id * 600')} event_time,
  CASE WHEN doc_id % 13 <> 0 THEN {moment(f'{START} + doc_id * 600 + doc_id % 300 - 10')} END collected_at
FROM documents"""

C_SENT = f"""
SELECT * REPLACE (text || CASE doc_id % 6 WHEN 0 THEN ' GREAT good awesome useful'
  WHEN 1 THEN ' https://ex.am/p?q=1 bad' WHEN 2 THEN ' www.ex.am  good' ELSE '' END AS text)
FROM ({C_DOC})"""

C_DUP = f"""
SELECT * FROM ({C_SENT}) UNION ALL
SELECT * REPLACE (like_count + 1 AS like_count) FROM ({C_SENT}) WHERE doc_id % 7 = 0"""

C_FLAWED = f"""
SELECT * REPLACE (
  CASE WHEN doc_id % 17 = 0 THEN '' ELSE author END AS author,
  CASE WHEN doc_id % 19 = 0 THEN '1' ELSE parent_comment_id END AS parent_comment_id,
  CASE WHEN doc_id % 23 <> 0 THEN source END AS source)
FROM ({C_DOC})"""

C_SLANG = f"""
SELECT * REPLACE (text || CASE doc_id % 8 WHEN 0 THEN ' huge w bro, w w w!'
  WHEN 1 THEN ' Niceeeee \U0001f525\U0001f525 sooo fire'
  WHEN 2 THEN ' ain''t no way... Éaaa loool_ xl l'
  WHEN 3 THEN ' ❤️ ❤ goated goat justice for x' ELSE '' END AS text)
FROM ({C_SENT})"""

C_CONV = """
SELECT conv_id || ':' || turn comment_id, CAST(conv_id AS VARCHAR) video_id, role author, text,
  turn > 0 is_reply FROM conversations"""

C_EVENT = "SELECT event_type video_id, ts event_time FROM events"


def or_unknown(x: str) -> str:
    return f"coalesce(nullif({squeeze(x)}, ''), 'unknown')"


def fields(view: str) -> str:
    """All fields cleaned."""
    collected = "greatest(collected_at, event_time)"
    return f"""
SELECT doc_id, event_time, {collected} collected_at, nullif({squeeze('comment_id')}, '') comment_id,
  nullif({squeeze('video_id')}, '') video_id, {or_unknown('author')} author,
  nullif({squeeze('text')}, '') text,
  CASE WHEN like_count >= 0 THEN like_count ELSE 0 END like_count,
  CASE WHEN reply_count >= 0 THEN reply_count ELSE 0 END reply_count,
  coalesce(is_reply, false) is_reply,
  CASE WHEN is_reply THEN nullif({squeeze('parent_comment_id')}, '') END parent_comment_id,
  lower({or_unknown('lang')}) lang, lower({or_unknown('source')}) source,
  {normalized('text')} text_clean,
  CAST({seconds(collected)} - {seconds('event_time')} AS BIGINT) collected_delay_seconds,
  CAST(length({normalized('text')}) AS INT) text_length
FROM ({view})"""


def admitted(view: str) -> str:
    return f"""
SELECT * FROM ({fields(view)})
WHERE event_time IS NOT NULL AND collected_at IS NOT NULL AND comment_id IS NOT NULL
  AND video_id IS NOT NULL AND text IS NOT NULL AND text_clean <> ''
  AND (NOT is_reply OR parent_comment_id IS NOT NULL)"""


def scored(rows: str, text: str = "text_clean") -> str:
    def percent(part: str) -> str:
        return (f"CASE WHEN p + n = 0 THEN 0 ELSE CAST(round_even(CAST({part} AS DOUBLE)"
                f" / (p + n) * 100, 0) AS INT) END")
    return f"""
SELECT * EXCLUDE (p, n), {percent('p')} positive_score, {percent('n')} negative_score,
  CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END sentiment
FROM (SELECT *, {hits(text, POSITIVE_KEYWORDS)} p, {hits(text, NEGATIVE_KEYWORDS)} n
  FROM ({rows}))"""


def silver(view: str = C_DUP) -> str:
    """Deduplicated: copies differ in like_count only, the lower one stays."""
    return f"""
SELECT *, CAST(event_time AS DATE) event_date FROM ({scored(admitted(view))})
QUALIFY row_number() OVER (PARTITION BY video_id, comment_id ORDER BY like_count) = 1"""


def summary(view: str = C_DUP) -> str:
    def share(x: str) -> str:
        return half_up(x, "count(*)", 4)

    def mean(x: str) -> str:
        return half_up(f"sum({x})", "count(*)", 2)

    by = {s: f"count(*) FILTER (sentiment = '{s}')" for s in SENTIMENTS}
    replies = "count(*) FILTER (is_reply)"
    return f"""
SELECT {iso('event_date')} event_date, video_id, count(*) total_comments,
  count(*) FILTER (NOT is_reply) top_level_comment_count, {replies} reply_comment_count,
  count(DISTINCT author) unique_author_count, CAST(sum(like_count) AS BIGINT) total_likes,
  {mean('like_count')} avg_likes_per_comment, {mean('reply_count')} avg_reply_count,
  {mean('text_length')} avg_text_length,
  {mean('collected_delay_seconds')} avg_collected_delay_seconds,
  {', '.join(f'{x} {s}_comment_count' for s, x in by.items())},
  {', '.join(f'{share(x)} {s}_ratio' for s, x in by.items())},
  {share(replies)} reply_ratio,
  CAST(sum(like_count) + {replies} AS BIGINT) engagement_score
FROM ({silver(view)}) GROUP BY event_date, video_id"""


def breakdown() -> str:
    def mean(x: str) -> str:
        return half_up(f"sum({x})", "count(*)", 2)
    return f"""
SELECT b.* EXCLUDE (n), {half_up('b.n', 't.total_comments', 4)} comment_ratio,
  b.n comment_count
FROM (SELECT {iso('event_date')} event_date, video_id, sentiment, count(*) n,
    {mean('like_count')} avg_likes, {mean('reply_count')} avg_replies,
    count(*) FILTER (is_reply) reply_comment_count, {mean('text_length')} avg_text_length
  FROM ({silver()}) GROUP BY 1, 2, 3) b
JOIN ({summary()}) t ON b.event_date = t.event_date AND b.video_id = t.video_id"""


def breakdown_of(rows: str) -> str:
    """The breakdown of given Silver rows."""
    def mean(x: str) -> str:
        return half_up(f"sum({x})", "count(*)", 2)
    return f"""
SELECT {iso('event_date')} event_date, video_id, sentiment, count(*) comment_count,
  {half_up('count(*)', 'sum(count(*)) OVER (PARTITION BY event_date, video_id)', 4)} comment_ratio,
  {mean('like_count')} avg_likes, {mean('reply_count')} avg_replies,
  count(*) FILTER (is_reply) reply_comment_count, {mean('text_length')} avg_text_length
FROM ({rows}) GROUP BY event_date, video_id, sentiment"""


#: Which of three arrivals a comment is in.
ARRIVAL = "CASE WHEN doc_id % 50 = 7 THEN 2 WHEN doc_id % 1000 < 500 THEN 0 ELSE 1 END"

C_THIRD_CORRECTED = f"""
SELECT * REPLACE (text || CASE WHEN doc_id % 3 = 0 THEN ' love great' ELSE '' END AS text)
FROM ({C_SENT})"""


# --- slang -------------------------------------------------------------------------------------

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def expanded(x: str) -> str:
    """Stretched words, without back-references: one alternative per letter."""
    runs = "|".join(f"{c}{c}{c}" for c in LETTERS)
    collapsed = "tok"
    for c in LETTERS:
        collapsed = f"regexp_replace({collapsed}, '{c}{c}{c}+', '{c}', 'g')"
    return f"""array_to_string(list_transform(
      regexp_extract_all({x}, '{WORD}+|{NO_WORD}+'),
      lambda tok: CASE WHEN regexp_full_match(tok, '[a-z]*({runs})[a-z]*')
        THEN tok || ' ' || {collapsed} ELSE tok END), '')"""


def slang_replaced(x: str) -> str:
    """Terms without look-around. Neighbours share a border, so every term is applied twice."""
    for term, replacement, _ in sorted(SLANG, key=lambda row: -len(row[0])):
        if any(c.isascii() and c.isalnum() for c in term):
            pattern = quoted(f"(^|{NO_WORD}){term}($|{NO_WORD})")
            inserted = quoted(rf"\1 {replacement} \2")
            for _ in range(2):
                x = f"regexp_replace({x}, {pattern}, {inserted}, 'g')"
        else:
            x = f"replace({x}, {quoted(term)}, {quoted(f' {replacement} ')})"
    return f"trim(regexp_replace({x}, '{ANY_BLANK}', ' ', 'g'))"


def scoring_text(x: str = "text") -> str:
    return slang_replaced(expanded(normalized(x)))


# --- evaluation --------------------------------------------------------------------------------

LABELLED = f"""
SELECT d.comment_id idx, d.comment_id, d.video_id, d.text, d.lang,
  CASE WHEN toxic = 1 THEN 'neg' WHEN quality = 1 THEN 'LABEL_2' ELSE '3 stars' END manual_label,
  CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END actual_label,
  'note ' || d.lang reviewer_notes
FROM labels l JOIN ({C_SENT}) d ON l.doc_id = d.doc_id"""

PREDICTED = f"""
SELECT *, {hits('t', POSITIVE_KEYWORDS)} p, {hits('t', NEGATIVE_KEYWORDS)} n
FROM (SELECT *, {expanded(normalized('text'))} t FROM ({LABELLED}))"""

DETAIL = f"""
SELECT idx, comment_id, video_id, text, actual_label,
  coalesce(nullif({squeeze('lang')}, ''), 'unbucketed') review_bucket, reviewer_notes notes,
  CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative' ELSE 'neutral' END predicted_label,
  printf('%.6f', CASE WHEN p + n = 0 THEN 0.0 ELSE CAST(greatest(p, n) AS DOUBLE) / (p + n) END)
    predicted_confidence,
  CASE WHEN actual_label = CASE WHEN p > n THEN 'positive' WHEN n > p THEN 'negative'
    ELSE 'neutral' END THEN 'yes' ELSE 'no' END is_match
FROM ({PREDICTED})"""

RATES = f"""
SELECT label, precision, recall, support,
  CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END f1_score
FROM (SELECT label, support,
    CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS precision,
    CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS recall
  FROM (SELECT label, count(*) FILTER (actual_label = label AND predicted_label = label) tp,
      count(*) FILTER (predicted_label = label) predicted,
      count(*) FILTER (actual_label = label) support
    FROM (SELECT unnest(['positive', 'neutral', 'negative']) label), ({DETAIL}) GROUP BY label))"""


# --- the registered queries --------------------------------------------------------------------

def layer_rows() -> dict[str, str]:
    return {"bronze": C_DUP, "silver": silver(), "gold_summary": summary(),
            "gold_breakdown": breakdown()}


def union(parts) -> str:
    return " UNION ALL ".join(parts)


def count_in(layers: dict[str, str]) -> str:
    return union(f"SELECT '{name}' layer, count(*) row_count FROM ({sql})"
                 for name, sql in layers.items())


REASONS = {
    "missing author": "coalesce(author, '') = ''",
    "missing text": f"{strip('text')} = ''",
    "missing source": "coalesce(source, '') = ''",
    "collected before event": "collected_at < event_time",
    "parent on a non-reply": "NOT is_reply AND parent_comment_id IS NOT NULL",
    "reply without parent": "is_reply AND parent_comment_id IS NULL",
    "unexpected video": "video_id <> 'src3'",
}


def judged(expected_video: bool) -> str:
    names = [r for r in REASONS if expected_video or r != "unexpected video"]
    tests = ", ".join(f"CASE WHEN {REASONS[r]} THEN '{r}' END" for r in names)
    return f"SELECT comment_id, concat_ws('; ', {tests}) reasons FROM ({C_FLAWED})"


def unescaped(x: str, entities: dict[str, str]) -> str:
    for entity, character in entities.items():
        x = f"replace({x}, {quoted(entity)}, {quoted(character)})"
    return x


BASIC_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}
# the pages hold no other entities than these, and cut-off ones: &amp without its end
PAGE_ENTITIES = {"&middot;": "·", "&copy;": "©", "&quot;": '"'}

FLAGS = ["1", "TRUE", " yes ", "y", "On", "0", "no", "", "2", None]
LABELS = ["POS", " neg ", "Neutral", "1 star", "3 stars", "5 stars", "LABEL_0", "1", "2"]
def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["json_decode"] = """
SELECT event_id, event_id % 50 = 0 malformed, event_id % 50 > 3 OR event_id % 50 = 3 admitted,
  CASE WHEN event_id % 50 > 3 THEN CAST(regexp_extract(props, ': *(-?[0-9]+)', 1) AS INT) END k
FROM events"""
    sql["bootstrap_empty"] = union((
        "SELECT 'bronze_comments' layer, 0 row_count",
        f"SELECT 'silver_comments' layer, count(*) row_count FROM ({silver()})",
        "SELECT 'gold_comment_metrics' layer, 0 row_count",
        "SELECT 'gold_sentiment_breakdown' layer, 0 row_count"))
    sql["gold_incremental"] = summary()
    stamp = "'%Y-%m-%dT%H:%M:%SZ'"
    sql["keyed_json_out"] = f"""
SELECT coalesce(comment_id, 'no-key') AS key, comment_id, text, like_count, is_reply,
  strftime(event_time, {stamp}) event_time, strftime(collected_at, {stamp}) collected_at
FROM (SELECT * REPLACE (CASE WHEN doc_id % 10 <> 0 THEN comment_id END AS comment_id)
  FROM ({C_DOC}))"""
    sql["thread_flatten"] = f"""
SELECT {START} + conv_id * 3600 + turn * 60 event_time, {START} collected_at,
  CASE WHEN i = 1 THEN id ELSE id || '.' || (i - 1) END comment_id,
  CASE WHEN i = 1 THEN 'v' || conv_id ELSE 'fallback' END video_id,
  CASE WHEN i = 1 THEN role ELSE 'unknown' END author,
  {strip("CASE WHEN i = 1 THEN CASE WHEN line = '' THEN 'unused' ELSE line END ELSE line || ' &' END")}
    AS text,
  CASE WHEN i = 1 THEN turn ELSE 0 END like_count,
  CASE WHEN i = 1 THEN size - 1 ELSE 0 END reply_count, i > 1 is_reply,
  CASE WHEN i > 1 THEN id END parent_comment_id, 'unknown' lang, 'api' source
FROM (SELECT conv_id, turn, role, conv_id || ':' || turn id,
    unnest(string_split(text, chr(10))) line, len(string_split(text, chr(10))) size,
    unnest(range(1, len(string_split(text, chr(10))) + 1)) i
  FROM conversations)"""
    sql["eval_load"] = f"""
SELECT idx, comment_id, video_id, '"q", ' || text AS text, manual_label, actual_label,
  reviewer_notes FROM ({LABELLED})"""
    sql["catalog_register"] = f"""
SELECT video_id, count(*) silver_comments, count(*) gold_comments
FROM ({silver()}) GROUP BY video_id"""
    sql["catalog_stream"] = sql["catalog_register"]
    sql["build_twice"] = summary()
    sql["quarantine_rows"] = f"""
SELECT batch_id, value, records, records with_key, broken
FROM (SELECT '{{bad' AS value, count(*) records, count(*) FILTER (doc_id % 50 = 0) broken FROM ({C_DUP})),
  (VALUES ('one'), ('two')) b(batch_id)"""
    sql["path_table_count"] = union(
        f"SELECT '{t}' layer, count(*) row_count FROM {t}"
        for t in ("documents", "events", "conversations"))
    sql["apply_corrections"] = f"""
SELECT s.video_id, s.comment_id, CASE WHEN l.doc_id IS NULL THEN s.sentiment
  WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END sentiment
FROM ({silver()}) s LEFT JOIN labels l ON s.doc_id = l.doc_id"""

    sql["clean_strings"] = (f"SELECT comment_id, video_id, author, text, lang, source "
                            f"FROM ({fields(C_FLAWED)})")
    sql["normalize_text"] = f"SELECT comment_id, text_clean, text_length FROM ({fields(C_SENT)})"
    sql["clean_numbers"] = f"""
SELECT comment_id, like_count, reply_count, is_reply FROM ({fields(
        f"SELECT * REPLACE (CASE WHEN reply_count <> 3 THEN is_reply END AS is_reply) FROM ({C_DOC})")})"""
    sql["collected_delay"] = (f"SELECT comment_id, {seconds('collected_at')} collected_at, "
                              f"collected_delay_seconds FROM ({fields(C_DOC)})")
    sql["clean_parents"] = (f"SELECT comment_id, is_reply, parent_comment_id "
                            f"FROM ({fields(C_FLAWED)})")
    sql["keyword_hits"] = (f"SELECT comment_id, {hits('text_clean', POSITIVE_KEYWORDS)} "
                           f"positive_hits FROM ({fields(C_SENT)})")
    scores = "comment_id, positive_score, negative_score, sentiment"
    sql["keyword_sentiment"] = f"SELECT {scores} FROM ({scored(admitted(C_SENT))})"
    sql["score_batches"] = f"""
SELECT comment_id, share positive_score, 100 - share negative_score, CASE WHEN share > 40
  THEN 'positive' WHEN share > 30 THEN 'neutral' ELSE 'negative' END sentiment
FROM (SELECT comment_id, CAST(100 * length(regexp_replace(text_clean, '[^aeiou]', '', 'g'))
  // length(text_clean) AS INT) share FROM ({admitted(C_SENT)}))"""
    sql["keyword_confidence"] = f"""
SELECT comment_id, CASE WHEN p + n = 0 THEN 0.0 ELSE CAST(greatest(p, n) AS DOUBLE) / (p + n) END
  confidence
FROM (SELECT comment_id, {hits('text_clean', POSITIVE_KEYWORDS)} p,
  {hits('text_clean', NEGATIVE_KEYWORDS)} n FROM ({admitted(C_SENT)}))"""
    sql["decode_escapes"] = r"""
SELECT CAST(doc_id AS VARCHAR) comment_id, text || CASE doc_id % 3 WHEN 0 THEN ' été \U0001f60a'
  WHEN 1 THEN ' \U00110000 \u12 C:\users' ELSE '' END decoded FROM documents""".replace(
        r"\U0001f60a", "\U0001f60a")
    sql["elongation"] = (f"SELECT comment_id, {expanded(normalized('text'))} expanded "
                         f"FROM ({C_SLANG})")
    sql["slang_normalize"] = f"SELECT comment_id, {scoring_text()} scoring_text FROM ({C_SLANG})"
    words = f"regexp_split_to_array(text_clean, '{NO_WORD}+')"
    sql["slang_hits"] = f"""
SELECT comment_id, {', '.join(
        f"CAST(len(list_filter({words}, lambda word: word = '{t}')) AS INT) hits_{t}"
        for t in ('w', 'l', 'fire', 'goat', 'bro'))} FROM ({fields(C_SLANG)})"""
    # a link-only or blank text is not admitted, so the cleaned text decides before slang does
    sql["slang_sentiment"] = f"""
SELECT {scores} FROM ({scored(
        f"SELECT *, {scoring_text()} reads FROM ({admitted(C_SLANG)})", 'reads')})"""
    sql["normalize_label"] = """
SELECT doc_id, CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive'
  ELSE 'neutral' END sentiment FROM documents JOIN labels USING (doc_id)"""
    up, down = hits("text_clean", POSITIVE_KEYWORDS), hits("text_clean", NEGATIVE_KEYWORDS)
    sql["score_argmax"] = f"""
SELECT comment_id, CASE WHEN p >= q AND p >= n THEN 'positive' WHEN q >= n THEN 'neutral'
  ELSE 'negative' END sentiment
FROM (SELECT comment_id, {up} p, {down} n, length(text) - length(replace(text, '?', '')) q
  FROM ({admitted(C_SENT)}))"""
    sql["record_defaults"] = f"""
SELECT comment_id, {seconds('coalesce(collected_at, event_time)')} collected_at,
  coalesce(source, 'files') source,
  CASE WHEN doc_id % 9 <> 0 THEN lang ELSE 'unknown' END lang,
  CASE WHEN doc_id % 6 <> 0 THEN like_count ELSE 0 END like_count,
  CASE WHEN doc_id % 7 = 0 THEN 0 ELSE reply_count END reply_count, is_reply,
  {strip('text')} AS text
FROM ({C_FLAWED})"""
    sql["parse_bool"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) % 10 < 5 flag, CAST(floor(value) AS BIGINT) % 3 <> 0 number_flag
FROM events"""
    sql["html_unescape"] = f"""
SELECT page_id, regexp_replace({unescaped('html', PAGE_ENTITIES)}, '&amp;?', '&', 'g') html
FROM pages"""
    sql["html_unescape_basic"] = (f"SELECT page_id, {unescaped('html', BASIC_ENTITIES)} html "
                                  f"FROM pages")
    sql["url_key"] = """
SELECT page_id, url link, string_split(string_split(url, '&')[1], '?')[1] video_key FROM pages
UNION ALL SELECT page_id, 'https://www.youtube.com/watch?list=a&v=p%20' || page_id || '&t=1#x',
  'p ' || page_id FROM pages
UNION ALL SELECT page_id, ' https://youtu.be/p' || page_id || '/more?si=2', 'p' || page_id FROM pages
UNION ALL SELECT page_id, 'p' || page_id || '&feature=1', 'p' || page_id FROM pages"""

    sql["silver_clean"] = f"""
SELECT {seconds('event_time')} event_time, {seconds('collected_at')} collected_at, comment_id,
  video_id, author, like_count, reply_count, is_reply, parent_comment_id, lang, source,
  text_clean, text_length, collected_delay_seconds FROM ({admitted(C_SENT)})"""
    sql["validate_reasons"] = judged(True)
    sql["quarantine_split"] = f"""
SELECT layer, count(*) row_count, count(*) counted FROM (
  SELECT CASE WHEN reasons = '' THEN 'valid' ELSE 'quarantined' END layer FROM ({judged(False)}))
GROUP BY layer"""

    def nulls(layer: str, rows: str, columns) -> str:
        return union(f"SELECT '{layer}_null_{c}' check_name, count(*) FILTER ({c} IS NULL) "
                     f"check_value FROM ({rows})" for c in columns)
    sql["dq_null_checks"] = union((
        nulls("bronze", C_DUP, ("comment_id", "collected_at", "parent_comment_id")),
        nulls("silver", silver(), ("comment_id", "sentiment", "parent_comment_id"))))
    sql["attach_predictions"] = f"""
SELECT video_id, comment_id, author, positive_score, negative_score, sentiment
FROM ({silver()}) WHERE doc_id IN (SELECT doc_id FROM labels)"""
    sql["new_records_only"] = f"""
SELECT ' ' comment_id, author, like_count FROM ({C_DUP}) WHERE doc_id % 10 = 0 UNION ALL
SELECT comment_id, author, min(like_count) like_count FROM ({C_DUP})
WHERE doc_id % 10 <> 0 AND doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY comment_id, author"""

    sql["gold_summary"] = summary()
    sql["gold_breakdown"] = breakdown()
    sql["gold_reconcile"] = f"""
SELECT {iso('event_date')} event_date, video_id, count(*) total_comments, count(*) breakdown_total
FROM ({silver()}) GROUP BY event_date, video_id"""
    sql["layer_flow_check"] = f"""
SELECT b.video_id, bronze_comments, silver_comments, metric_rows, breakdown_rows
FROM (SELECT video_id, count(*) bronze_comments FROM ({C_DUP}) GROUP BY 1) b
LEFT JOIN (SELECT video_id, count(*) silver_comments FROM ({silver()})
  WHERE video_id <> 'src3' GROUP BY 1) s ON s.video_id = b.video_id
LEFT JOIN (SELECT video_id, count(*) metric_rows FROM ({summary()}) GROUP BY 1) g
  ON g.video_id = b.video_id
LEFT JOIN (SELECT video_id, count(*) breakdown_rows FROM ({breakdown()}) GROUP BY 1) d
  ON d.video_id = b.video_id"""
    sql["layer_counts"] = count_in(layer_rows())
    sql["distinct_videos"] = union(
        f"SELECT '{name}_distinct_video_count' check_name, count(DISTINCT video_id) check_value "
        f"FROM ({rows})" for name, rows in layer_rows().items())
    sql["duplicate_keys"] = f"""
SELECT video_id, comment_id, count(*) row_count FROM ({C_DUP}) GROUP BY 1, 2 HAVING count(*) > 1"""
    sql["duplicate_key_count"] = f"""
SELECT count(*) duplicate_comment_rows FROM (
  SELECT comment_id FROM ({C_DUP}) GROUP BY 1 HAVING count(*) > 1)"""
    sql["silver_invariants"] = f"""
SELECT count(*) FILTER (comment_id IS NULL) null_comment_id_rows,
  count(*) FILTER (video_id IS NULL) null_video_id_rows,
  count(*) FILTER (text_clean IS NULL OR trim(text_clean) = '') empty_text_clean_rows,
  count(*) FILTER (is_reply AND parent_comment_id IS NULL) invalid_reply_rows,
  count(*) FILTER (collected_delay_seconds < 0) negative_delay_rows
FROM ({fields(C_FLAWED)})"""
    sql["gold_invariants"] = f"""
WITH s AS ({summary()}), broken AS (SELECT count(*) n FROM s WHERE reply_comment_count = 0)
SELECT 'invalid_comment_total_rows' check_name, n check_value FROM broken
UNION ALL SELECT 'invalid_sentiment_total_rows', n FROM broken
UNION ALL SELECT 'invalid_ratio_rows', 2 * count(*) FILTER (
  abs(positive_ratio + neutral_ratio + negative_ratio - 1.0) > 0.01) FROM s"""
    sql["sentiment_distribution"] = f"""
SELECT video_id, sentiment, count(*) comment_count FROM ({silver()}) GROUP BY 1, 2"""
    sql["silver_gold_agreement"] = f"""
SELECT sentiment, count(*) silver_count, count(*) gold_count FROM ({silver()}) GROUP BY 1"""
    sql["freshness"] = f"""
SELECT {seconds('max(event_time)')} latest_event_time,
  {seconds('max(collected_at)')} latest_collected_at FROM ({C_SENT})"""

    sql["sentiment_share"] = f"""
SELECT sentiment, n AS count, {half_up('n * 100', 't', 2)} percentage FROM (
  SELECT sentiment, count(*) n, CAST(sum(count(*)) OVER () AS BIGINT) t
  FROM ({silver()}) GROUP BY sentiment)"""
    sql["dedup_first"] = f"""
SELECT video_id, comment_id, min(like_count) like_count, text
FROM ({C_DUP}) GROUP BY video_id, comment_id, text"""
    sql["latest_n"] = f"""
SELECT comment_id, video_id, author, text_clean, sentiment, {seconds('collected_at')} collected_at
FROM (SELECT * FROM ({silver()}) ORDER BY collected_at DESC, video_id, comment_id LIMIT 20)"""
    sql["top_positive_authors"] = f"""
SELECT author, count(*) positive_count FROM ({silver()}) WHERE sentiment = 'positive'
GROUP BY author ORDER BY positive_count DESC, author LIMIT 5"""
    sql["negative_sample"] = f"""
SELECT author, text_clean FROM (SELECT * FROM ({silver()}) WHERE sentiment = 'negative'
  ORDER BY video_id, comment_id LIMIT 10)"""
    sql["comments_per_video"] = (f"SELECT video_id, count(*) comment_count FROM ({C_CONV}) "
                                 f"GROUP BY 1")
    sql["reply_split"] = f"SELECT is_reply, count(*) row_count FROM ({C_CONV}) GROUP BY 1"
    sql["hourly_volume"] = (f"SELECT CAST(hour(event_time) AS INT) AS hour, count(*) AS count "
                            f"FROM ({C_EVENT}) GROUP BY 1")
    sql["distinct_video_list"] = f"SELECT DISTINCT video_id FROM ({C_EVENT})"
    sql["kpi_report"] = f"""
SELECT event_date, video_id, total_comments, positive_comment_count, neutral_comment_count,
  negative_comment_count, positive_ratio, neutral_ratio, negative_ratio, engagement_score
FROM ({summary()})"""
    sql["breakdown_report"] = f"""
SELECT event_date, video_id, sentiment, comment_count, comment_ratio, avg_likes, avg_replies
FROM ({breakdown()})"""
    sql["largest_breakdowns"] = (f"SELECT video_id, sentiment, comment_count "
                                 f"FROM ({breakdown()})")

    sql["eval_detail"] = DETAIL
    sql["eval_accuracy"] = f"""
SELECT count(*) total_rows, count(*) FILTER (is_match = 'yes') correct_rows,
  CAST(count(*) FILTER (is_match = 'yes') AS DOUBLE) / count(*) agreement_accuracy,
  count(*) FILTER (is_match = 'no') mismatch_count FROM ({DETAIL})"""
    sql["eval_distributions"] = f"""
SELECT 'actual' side, actual_label AS label, count(*) row_count FROM ({DETAIL}) GROUP BY 2
UNION ALL SELECT 'predicted', predicted_label, count(*) FROM ({DETAIL}) GROUP BY 2"""
    sql["confusion_matrix"] = f"""
SELECT label actual_label, {', '.join(
        f"count(*) FILTER (actual_label = label AND predicted_label = '{s}') {s}"
        for s in SENTIMENTS)}
FROM (SELECT unnest(['positive', 'neutral', 'negative']) label), ({DETAIL}) GROUP BY label"""
    sql["label_prf"] = RATES
    sql["macro_f1"] = f"""
SELECT (max(f1_score) FILTER (label = 'positive') + max(f1_score) FILTER (label = 'neutral')
  + max(f1_score) FILTER (label = 'negative')) / 3 macro_f1 FROM ({RATES})"""
    sql["accuracy_by_bucket"] = f"""
SELECT review_bucket, count(*) total, count(*) FILTER (is_match = 'yes') correct,
  CAST(count(*) FILTER (is_match = 'yes') AS DOUBLE) / count(*) accuracy
FROM ({DETAIL}) GROUP BY 1"""
    sql["top_mismatches"] = f"""
SELECT * FROM ({DETAIL}) WHERE is_match = 'no'
ORDER BY review_bucket <> 'reviewed', CAST(predicted_confidence AS DOUBLE), CAST(idx AS BIGINT)
LIMIT 20"""
    sql["eval_summary"] = f"""
SELECT count(*) total_rows, count(*) FILTER (is_match = 'yes') correct_rows,
  count(*) FILTER (is_match = 'no') mismatch_count, 'keyword' evaluation_mode,
  least(count(*) FILTER (is_match = 'no'), 20) listed FROM ({DETAIL})"""

    def value(field: str, name: str, number: str, rows: str) -> str:
        return (f"SELECT '{field}' field, {name} AS name, CAST({number} AS DOUBLE) AS value "
                f"FROM ({rows})")

    matrix, labels = sql["confusion_matrix"], ("positive", "neutral", "negative")
    sql["eval_summary_fields"] = union([
        *[value(c, "''", c, sql["eval_accuracy"]) for c in (
            "total_rows", "correct_rows", "agreement_accuracy", "mismatch_count")],
        value("macro_f1", "''", "macro_f1", sql["macro_f1"]),
        value("actual_distribution", "actual_label", "positive + neutral + negative", matrix),
        *[value("predicted_distribution", f"'{s}'", f"sum({s})", matrix) for s in labels],
        *[value(c, "label", c, RATES) for c in ("precision", "recall", "f1_score", "support")],
        *[value("confusion", f"actual_label || ' as {s}'", s, matrix) for s in labels],
        value("mismatch", "idx", "row_number() OVER (ORDER BY review_bucket <> 'reviewed', "
              "CAST(predicted_confidence AS DOUBLE), CAST(idx AS BIGINT))", sql["top_mismatches"]),
        value("bucket", "review_bucket", "accuracy", sql["accuracy_by_bucket"])])
    sql["stream_dedup"] = f"""
SELECT DISTINCT video_id, comment_id, text_clean FROM ({admitted(C_DUP)})"""
    sql["stream_silver"] = f"""
SELECT {iso('event_date')} event_date, video_id, comment_id, author, like_count, text_clean,
  text_length, collected_delay_seconds, positive_score, negative_score, sentiment,
  'keyword' scorer FROM ({silver(C_SENT)})"""
    sql["stream_end_to_end"] = summary(C_SENT)
    sql["one_silver"] = sql["stream_silver"]
    sql["gold_merged"] = breakdown()
    names = "(VALUES (0, 'in/a'), (1, 'in_a'), (2, 'in a'), (3, 'in%2Fa')) names(i, batch_id)"
    sql["batch_names"] = f"""
SELECT batch_id, bronze_rows, bronze_rows manifest_rows, true done, silver_rows FROM {names}
JOIN (SELECT doc_id % 4 i, count(*) bronze_rows FROM documents GROUP BY 1) b USING (i)
JOIN (SELECT doc_id % 4 i, count(*) silver_rows FROM ({silver(C_SENT)}) GROUP BY 1) s USING (i)"""
    sql["corrected_batch"] = summary(C_THIRD_CORRECTED)
    corrected = f"""
SELECT s.* REPLACE (CASE WHEN l.doc_id IS NULL THEN s.sentiment WHEN toxic = 1 THEN 'negative'
  WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment)
FROM ({silver()}) s LEFT JOIN labels l ON s.doc_id = l.doc_id"""
    sql["correct_stored"] = f"SELECT *, comment_count silver_count FROM ({breakdown_of(corrected)})"
    sql["distinct_by_week"] = f"""
SELECT {iso("date_trunc('week', event_date)")} period, count(DISTINCT video_id) videos,
  count(DISTINCT author) authors, true videos_close, true authors_close
FROM ({silver()}) GROUP BY 1"""
    sql["replay_lines"] = f"""
SELECT count(*) + count(*) FILTER (CAST(comment_id AS BIGINT) % 50 = 0) incoming,
  count(*) FILTER (reasons = '') published, count(*) FILTER (reasons <> '') quarantined,
  count(*) FILTER (CAST(comment_id AS BIGINT) % 50 = 0) broken FROM ({judged(False)})"""
    best = "ORDER BY like_count DESC, event_time, comment_id"
    sql["top_liked_comments"] = f"""
SELECT video_id, comment_id, like_count,
  CAST(row_number() OVER (PARTITION BY video_id {best}) AS INT) AS rank
FROM ({silver()}) QUALIFY rank <= 3"""
    sql["top_liked_ties"] = f"""
SELECT video_id, sentiment, comment_id, like_count,
  CAST(rank() OVER (PARTITION BY video_id, sentiment ORDER BY like_count DESC) AS INT) AS rank
FROM ({silver()}) QUALIFY rank <= 2"""
    sql["replies_per_day"] = f"""
SELECT {iso('event_date')} event_date, count(*) comment_count,
  count(*) FILTER (is_reply) reply_count FROM ({silver()}) GROUP BY event_date"""

    def trend(rows: str, hours: int) -> str:
        width = hours * 3600
        start = f"{seconds('event_time')} // {width} * {width}"
        return f"""
SELECT CAST({start} AS BIGINT) window_start, CAST({start} + {width} AS BIGINT) window_end, sentiment,
  count(*) comment_count, {half_up('sum(like_count)', 'count(*)', 2)} avg_likes
FROM ({rows}) GROUP BY 1, 2, sentiment"""

    def arrivals(rows: str, when: str) -> str:
        """Rows with the watermark that earlier arrivals have left, in seconds; null at first."""
        return f"""
SELECT r.*, a.arrival, a.border, a.last FROM (SELECT *, {ARRIVAL} arrival FROM ({rows})) r JOIN (
  SELECT arrival, max(latest) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - 172800 border, max(latest) OVER () - 172800 AS last
  FROM (SELECT {ARRIVAL} arrival, max({seconds(when)}) latest FROM ({rows}) GROUP BY 1)) a USING (arrival)"""

    sql["sentiment_trend"] = trend(silver(), 6)
    timely = (f"SELECT * FROM ({arrivals(silver(), 'event_time')}) WHERE border IS NULL OR "
              f"({seconds('event_time')} // 86400 + 1) * 86400 > border")
    sql["sentiment_trend_stream_windows"] = (
        f"SELECT * FROM ({trend(timely, 24)}) WHERE window_end <= "
        f"(SELECT max(last) FROM ({arrivals(silver(), 'event_time')}))")
    seen = "greatest(collected_at, event_time)"
    marked = f"SELECT *, coalesce({seconds(seen)} < border, false) late FROM ({arrivals(C_SENT, seen)})"
    sql["late_rows_kept"] = f"""
WITH marked AS ({marked})
SELECT 'late' place, comment_id, CAST(1 AS BIGINT) n FROM marked WHERE late
UNION ALL SELECT 'main', comment_id, 1 FROM ({silver(C_SENT)})
  WHERE doc_id NOT IN (SELECT doc_id FROM marked WHERE late)
UNION ALL SELECT 'metric', CAST(row_number() OVER (ORDER BY arrival) AS VARCHAR),
  count(*) FILTER (late) FROM marked GROUP BY arrival"""
    return sql
