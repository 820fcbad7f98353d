"""Registered cleaning, text-function and integrity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.functions import text as T
from pulse.functions import times as TM
from pulse.functions import values as V
from pulse.operators import cleaning as C
from pulse.operators import integrity as I
from pulse.operators import ranking as R
from pulse.plans import pipelines as P
from pulse.plans.registry import query
from pulse.session import run_dir
from pulse.sources.sinks import append_run, read_runs
from pulse.plans.tables import CTE, labelled, posts, quoted, raw_posts, raw_users, social, table, users, with_

SP, NSP = X.SPACE, X.NON_SPACE


def lit(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def rx(expr: str, pattern: str, to: str) -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(to)}, 'g')"


def strip_sql(expr: str) -> str:
    return rx(expr, f"^{SP}+|{SP}+$", "")


def squeeze_sql(expr: str) -> str:
    return strip_sql(rx(expr, f"{SP}+", " "))


def number_sql(expr: str) -> str:
    return f"(CASE WHEN NOT isnan(TRY_CAST({expr} AS DOUBLE)) THEN TRY_CAST({expr} AS DOUBLE) END)"


def blank_out_sql(expr: str) -> str:
    return f"(CASE WHEN NOT regexp_matches({expr}, {lit(C.placeholder_pattern())}) THEN {expr} END)"


def mixed_ts_sql(expr: str) -> str:
    e = strip_sql(expr)
    return (
        f"(CASE WHEN regexp_matches({e}, '^[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?$') "
        f"THEN make_timestamp(CAST(CAST({e} AS DOUBLE) * 1000000 AS BIGINT)) "
        f"WHEN regexp_matches({e}, '^\\d\\d-\\d\\d-\\d{{4}}$') THEN try_strptime({e}, '%d-%m-%Y') "
        f"ELSE TRY_CAST({e} AS TIMESTAMP) END)"
    )


def clean_post_sql(e: str) -> str:
    e = rx(rx(e, "<[^>]+>", " "), "&amp;|&lt;|&gt;|&quot;", " ")
    e = strip_sql(rx(e, SP + "{2,}", " "))
    return f"(CASE WHEN {e} NOT IN ('nan', 'None', '') THEN {e} END)"


def clean_nlp_sql(e: str) -> str:
    e = rx(rx(rx(f"coalesce({e}, '')", X.MARKUP, " "), X.URL, " "), X.MENTION, " ")
    e = rx(rx(e, X.HASHTAG, r" \1 "), X.EMOJI, " ")
    return squeeze_sql(rx(f"lower({e})", X.PUNCTUATION, " "))


def clean_variant_sql(e: str, punct: bool, hashtags: bool, mentions: bool) -> str:
    e = rx(rx(f"coalesce({e}, '')", X.MARKUP, " "), X.URL, " URL ")
    if mentions:
        e = rx(e, X.MENTION, " ")
    e = f"lower({rx(e, X.HASHTAG, r' \1 ' if hashtags else r' #\1 ')})"
    return squeeze_sql(rx(e, X.PUNCTUATION, " ") if punct else e)


def clean_social_sql(e: str) -> str:
    e = rx(rx(f"coalesce({e}, '')", f"http{NSP}+", ""), X.MENTION, "")
    return squeeze_sql(rx(rx(e, X.HASHTAG, r"\1"), X.NON_ASCII, " "))


def clean_review_sql(e: str) -> str:
    return squeeze_sql(rx(rx(e, f"http{NSP}+", ""), X.NON_ASCII, " "))


def words_sql(e: str) -> str:
    return f"list_filter(string_split({squeeze_sql(f'coalesce({e}, {lit("")})')}, ' '), lambda w: w <> '')"


# Page source with a link, a mention, a tag and an emoji put in front, so that every rule has work.
CTE["marked"] = """
SELECT doc_id, source, '<p>@anna_' || doc_id || ' Caf' || chr(233) || ' &amp; #Tag_' || (doc_id % 9) || chr(128512)
  || ' http://x.example/' || doc_id || '?a=1 </p>' || "text" AS body FROM documents"""


def marked(spark, d):
    return table(spark, d, "documents").selectExpr(
        "doc_id",
        "source",
        r"""concat('<p>@anna_', doc_id, ' Caf', chr(233), ' &amp; #Tag_', doc_id % 9, decode(unhex('F09F9880'), 'UTF-8'),
            ' http://x.example/', doc_id, '?a=1 </p>', text) AS body""",
    )


for _name, _sql, _fn in [
    ("text_clean_post", clean_post_sql("body"), T.clean_post),
    ("text_clean_nlp", clean_nlp_sql("body"), T.clean_nlp),
    ("text_clean_social", clean_social_sql("body"), T.clean_social),
    ("text_clean_review", clean_review_sql("body"), T.clean_review),
]:

    def _run(spark, d, fn=_fn):
        return marked(spark, d).select("doc_id", fn("body").alias("cleaned"))

    query(_name, with_("marked") + f"SELECT doc_id, {_sql} AS cleaned FROM marked")(_run)


@query("text_clean_pages", f"SELECT page_id, {clean_nlp_sql('html')} AS cleaned FROM pages")
def text_clean_pages(spark, d):
    return table(spark, d, "pages").select("page_id", T.clean_nlp("html").alias("cleaned"))


@query("text_clean_variants", with_("marked") + f"""
SELECT doc_id, {clean_variant_sql('body', True, True, True)} AS full_clean,
  {clean_variant_sql('body', False, True, True)} AS with_punct, {clean_variant_sql('body', True, False, True)} AS raw_tags,
  {clean_variant_sql('body', True, True, False)} AS with_mentions FROM marked""")
def text_clean_variants(spark, d):
    return marked(spark, d).select(
        "doc_id",
        T.clean_variant("body").alias("full_clean"),
        T.clean_variant("body", remove_punct=False).alias("with_punct"),
        T.clean_variant("body", split_hashtags=False).alias("raw_tags"),
        T.clean_variant("body", strip_mentions=False).alias("with_mentions"),
    )


@query("text_casing", with_("marked") + f"""
SELECT doc_id, array_to_string(list_transform(regexp_extract_all(lower({strip_sql('body')}), '\\p{{L}}+|[^\\p{{L}}]+'),
  lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || w[2:]), '') AS title, lower({strip_sql('body')}) AS lowered FROM marked""")
def text_casing(spark, d):
    return marked(spark, d).select(
        "doc_id", T.casing("body", "city").alias("title"), T.casing("body", "body").alias("lowered")
    )


@query("text_counts", with_("marked") + f"""
SELECT doc_id, CAST(len({words_sql('body')}) AS INTEGER) AS word_count, CAST(length(body) AS INTEGER) AS char_count,
  CASE WHEN length(body) > 90 THEN substring(body, 1, 90) || '...' ELSE body END AS snippet FROM marked""")
def text_counts(spark, d):
    return marked(spark, d).select(
        "doc_id", T.word_count("body").alias("word_count"), T.char_count("body").alias("char_count"), T.snippet("body").alias("snippet")
    )


@query("top_hashtags", with_("marked") + """
SELECT hashtag, count(*) AS n FROM (SELECT unnest(regexp_extract_all(body, '#([A-Za-z0-9_]+)', 1)) AS hashtag FROM marked)
GROUP BY hashtag ORDER BY n DESC, hashtag LIMIT 15""")
def top_hashtags(spark, d):
    tags = marked(spark, d).select(F.explode(T.hashtags("body")).alias("hashtag"))
    return R.top_k(tags.groupBy("hashtag").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), F.col("hashtag")], 15)


# Common words of each language become cues, so that scopes open in all of them.
_CUED_SQL = r"""
cued AS (SELECT doc_id, regexp_replace(regexp_replace("text", '(^| )(the|les|und|que) ', '\1not ', 'g'), '(^| )(is|est|ist) ', '\1NEVER ', 'g') AS body
  FROM documents)"""


def _cued(spark, d):
    body = F.regexp_replace("text", "(^| )(the|les|und|que) ", "$1not ")
    return table(spark, d, "documents").select("doc_id", F.regexp_replace(body, "(^| )(is|est|ist) ", "$1NEVER ").alias("body"))


@query("negation_scope", f"""WITH {_CUED_SQL},
toks AS (SELECT doc_id, unnest({words_sql('body')}) AS w, generate_subscripts({words_sql('body')}, 1) AS i FROM cued),
kinds AS (SELECT *, lower(w) IN ({quoted(X.NEGATION_CUES)}) AS cue, regexp_matches(w, '[.!?,;:]') AS stop FROM toks),
pieces AS (SELECT *, coalesce(sum(CAST(stop AND NOT cue AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS piece FROM kinds),
opened AS (SELECT *, max(CAST(cue AS INTEGER)) OVER (PARTITION BY doc_id, piece ORDER BY i
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM pieces)
SELECT doc_id, string_agg(CASE WHEN cue OR stop OR coalesce(seen, 0) = 0 THEN w ELSE 'NEGATED_' || w END, ' ' ORDER BY i) AS tagged
FROM opened GROUP BY doc_id""")
def negation_scope(spark, d):
    return _cued(spark, d).select("doc_id", T.negation_scope("body").alias("tagged"))


_TOKS = "regexp_extract_all(lower(\"text\"), '[\\p{L}\\p{N}_]+')"


@query("linguistic_tags", f"""
SELECT doc_id, unnest(CASE WHEN len(tags) = 0 THEN ['{X.TAG_NAMES['none']}'] ELSE tags END) AS tag FROM (
  SELECT doc_id, list_filter([
    CASE WHEN list_has_any({_TOKS}, [{quoted(X.NEGATION_WORDS)}]) THEN '{X.TAG_NAMES['negation']}' END,
    CASE WHEN list_has_any({_TOKS}, [{quoted(X.MODALITY_WORDS)}]) THEN '{X.TAG_NAMES['modality']}' END,
    CASE WHEN list_has_any({_TOKS}, [{quoted(X.CONTRAST_WORDS)}]) THEN '{X.TAG_NAMES['contrast']}' END,
    CASE WHEN contains("text", '?') OR contains("text", '!') OR contains("text", '...') THEN '{X.TAG_NAMES['punctuation']}' END
  ], lambda t: t IS NOT NULL) AS tags FROM documents)""")
def linguistic_tags(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(T.linguistic_tags("text")).alias("tag"))


@query("corpus_hash", with_("marked") + f"""
SELECT count(*) AS n_texts, CAST(sum(CAST(('0x' || substring(md5({clean_nlp_sql('body')}), 1, 8))::BIGINT AS DECIMAL(20, 0))) AS VARCHAR) AS text_hash
FROM marked""")
def corpus_hash(spark, d):
    return T.corpus_hash(marked(spark, d).select(T.clean_nlp("body").alias("t")), "t")


@query("strip_accents", f"""
SELECT doc_id, translate("text", '{T.accent_table()[0]}', '{T.accent_table()[1]}') AS folded FROM documents""")
def strip_accents(spark, d):
    return table(spark, d, "documents").select("doc_id", T.strip_accents("text").alias("folded"))


# -- time ------------------------------------------------------------------------


@query("mixed_timestamps", with_("raw_posts") + f"""
SELECT ord, strftime({mixed_ts_sql('"timestamp"')}, '%Y-%m-%dT%H:%M:%S') AS ts FROM raw_posts""")
def mixed_timestamps(spark, d):
    parsed = TM.parse_mixed_ts("timestamp")
    return raw_posts(spark, d).select("ord", F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss").alias("ts"))


_SEVEN = ["yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy", "dd-MM-yyyy", "d MMMM yyyy", "MMMM d, yyyy", "yyyy/MM/dd"]
_SEVEN_DUCK = ["%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d-%m-%Y", "%-d %B %Y", "%B %-d, %Y", "%Y/%m/%d"]
CTE["dated"] = "SELECT o_orderkey, CASE " + " ".join(
    f"WHEN o_orderkey % 8 = {i} THEN strftime(o_orderdate, '{f}')" for i, f in enumerate(_SEVEN_DUCK)
) + " ELSE 'no date' END AS raw FROM orders"
_TRIES = ["%Y-%m-%d", "%m/%d/%Y", "%m-%d-%Y", "%d/%m/%Y", "%d-%m-%Y", "%d %B %Y", "%B %d, %Y", "%Y/%m/%d"]


@query("multi_format_dates", with_("dated") + f"""
SELECT o_orderkey, strftime(try_strptime(raw, [{quoted(_TRIES)}]), '%Y-%m-%d') AS day FROM dated""")
def multi_format_dates(spark, d):
    raw = F.lit(None)
    for i, f in enumerate(_SEVEN):
        raw = F.when(F.col("o_orderkey") % 8 == i, F.date_format("o_orderdate", f)).otherwise(raw)
    raw = F.coalesce(raw, F.lit("no date"))
    return table(spark, d, "orders").select("o_orderkey", TM.parse_date(raw).alias("day"))


@query("utc_iso", """
SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN strftime(date_trunc('second', ts) - to_hours(CAST(event_id % 4 AS INTEGER)),
  '%Y-%m-%dT%H:%M:%SZ') END AS iso FROM events""")
def utc_iso(spark, d):
    raw = F.expr(
        """CASE WHEN event_id % 11 = 0 THEN 'soon'
           ELSE concat(date_format(ts, 'yyyy-MM-dd HH:mm:ss'), '+0', event_id % 4, ':00') END"""
    )
    return table(spark, d, "events").select("event_id", TM.to_utc_iso(raw).alias("iso"))


# -- values ------------------------------------------------------------------------

_RAW = with_("raw_posts")


@query("replace_placeholders", _RAW + f"""
SELECT ord, {blank_out_sql('post_id')} AS post_id, {blank_out_sql('platform')} AS platform,
  {blank_out_sql('text_content')} AS text_content, {blank_out_sql('likes')} AS likes,
  {blank_out_sql('shares')} AS shares, {blank_out_sql('comments')} AS comments FROM raw_posts""")
def replace_placeholders(spark, d):
    return C.replace_placeholders(raw_posts(spark, d)).drop("user_id", "timestamp")


@query("coerce_numeric", f"""
SELECT l_orderkey, l_linenumber, {number_sql("regexp_replace('€ ' || replace(CAST(l_quantity * 1000 AS VARCHAR), '000.', ',000.') || ' %', '[,$€£%\\s]', '', 'g')")} AS amount
FROM lineitem""")
def coerce_numeric(spark, d):
    raw = F.concat(
        F.lit("€ "), F.regexp_replace((F.col("l_quantity") * 1000).cast("string"), r"000\.", ",000."), F.lit(" %")
    )
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", V.coerce_numeric(raw).alias("amount"))


_RAW_COLS = ["post_id", "user_id", "platform", "text_content", "timestamp", "likes", "shares", "comments"]


@query("numeric_share", _RAW + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({number_sql(f'"{c}"')}) / greatest(count("{c}"), 1) AS numeric_share FROM raw_posts"""
    for c in _RAW_COLS
))
def numeric_share(spark, d):
    return C.numeric_share(raw_posts(spark, d), _RAW_COLS)


@query("detect_roles")
def detect_roles(spark, d):
    roles = C.detect_roles(raw_posts(spark, d))
    return spark.createDataFrame(sorted(roles.items()), "column string, role string")


@query("standardise")
def standardise(spark, d):
    return C.standardise(C.replace_placeholders(raw_users(spark, d)))


@query("date_window", with_("social") + """
SELECT post_id, strftime("timestamp", '%Y-%m-%d %H') AS ts FROM social
WHERE "timestamp" >= TIMESTAMP '2021-01-01' AND "timestamp" <= TIMESTAMP '2021-02-15' + INTERVAL 1 DAY""")
def date_window(spark, d):
    kept = C.in_window(social(spark, d), "timestamp", "2021-01-01", "2021-02-15")
    return kept.select("post_id", F.date_format("timestamp", "yyyy-MM-dd HH").alias("ts"))


@query("rating_filter", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS VARCHAR) AS score FROM lineitem WHERE l_quantity <= 2""")
def rating_filter(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("string").alias("score"))
    return C.rating_filter(rows, "score", hi=2)


_WORDS = ["c++", "the ou", "LEAUX", "und (", "heren"]


@query("keyword_filter", f"""
SELECT doc_id FROM documents WHERE {" OR ".join(f'contains(lower("text"), {lit(w.lower())})' for w in _WORDS)}""")
def keyword_filter(spark, d):
    return C.keyword_filter(table(spark, d, "documents"), "text", _WORDS).select("doc_id")


@query("min_length", "SELECT conv_id, turn FROM conversations WHERE length(\"text\") >= 100")
def min_length(spark, d):
    return C.min_length(table(spark, d, "conversations"), "text", 100).select("conv_id", "turn")


@query("drop_blank", _RAW + f"SELECT ord FROM raw_posts WHERE text_content IS NOT NULL AND {strip_sql('text_content')} <> ''")
def drop_blank(spark, d):
    return C.drop_blank(raw_posts(spark, d), "text_content").select("ord")


@query("validate_enum", _RAW + f"""
SELECT ord, CASE WHEN platform IN ({quoted(X.PLATFORMS)}) THEN platform END AS platform,
  CAST(NOT coalesce(platform IN ({quoted(X.PLATFORMS)}), false) AS INTEGER) AS platform_was_null FROM raw_posts""")
def validate_enum(spark, d):
    return C.validate_enum(raw_posts(spark, d), "platform", X.PLATFORMS).select("ord", "platform", "platform_was_null")


@query("drop_all_null", "SELECT event_id, event_type, \"value\" FROM events")
def drop_all_null(spark, d):
    df = table(spark, d, "events").select("event_id", "event_type", "value", F.lit(None).cast("string").alias("nothing"))
    return C.drop_all_null(df)


@query("clip_negative", _RAW + f"SELECT ord, greatest(coalesce({number_sql('likes')}, 0), 0) AS likes FROM raw_posts")
def clip_negative(spark, d):
    return C.clip_negative(raw_posts(spark, d), "likes").select("ord", "likes")


_MAP = {"src1": "alpha", "src2": "alpha", "src3": "beta"}
_CASE = "CASE source " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _MAP.items()) + " ELSE source END"


@query("remap_values", f"SELECT doc_id, {_CASE} AS source FROM documents")
def remap_values(spark, d):
    return C.remap(table(spark, d, "documents").select("doc_id", "source"), "source", _MAP)


@query("remap_report", f"""
SELECT source AS old_value, {_CASE} AS new_value, count(*) AS n_rows FROM documents WHERE source IN ({quoted(_MAP)}) GROUP BY ALL""")
def remap_report(spark, d):
    return C.remap_report(table(spark, d, "documents"), "source", _MAP)


@query("sentiment_number", with_("social") + """
SELECT post_id, CASE WHEN sentiment_label = 'Neutral' THEN 0.5::DOUBLE WHEN sentiment_label = 'Positive' THEN 1.0::DOUBLE
  ELSE 0.5::DOUBLE END AS sentiment FROM social""")
def sentiment_number(spark, d):
    known = F.when(F.col("sentiment_label") != "Negative", F.col("sentiment_label"))
    return social(spark, d).select("post_id", V.sentiment_number(known).alias("sentiment"))


@query("label_conflict", with_("social") + """
SELECT post_id, CAST((sentiment_label = 'Positive' AND sentiment_score < -0.3) OR (sentiment_label = 'Negative' AND sentiment_score > 0.5)
  AS INTEGER) AS conflict FROM social""")
def label_conflict(spark, d):
    return social(spark, d).select("post_id", C.label_conflict().alias("conflict"))


@query("provenance_flags", with_("social") + """
SELECT post_id, CASE WHEN sentiment_label = 'Negative' THEN 'whatsapp' ELSE 'telegram' END AS source,
  CAST(sentiment_label = 'Negative' AS INTEGER) AS backlash_flag, CAST(sentiment_label = 'Positive' AS INTEGER) AS migration_flag
FROM social WHERE sentiment_label <> 'Neutral'""")
def provenance_flags(spark, d):
    s = social(spark, d).select("post_id", "sentiment_label")
    neg = C.with_provenance(s.where("sentiment_label = 'Negative'"), "whatsapp", "primary_dataset", "store_a", "backlash_flag")
    pos = C.with_provenance(s.where("sentiment_label = 'Positive'"), "telegram", "primary_dataset", "store_b", "migration_flag")
    both = C.fill_flags(I.stack(neg, pos), ["backlash_flag", "migration_flag"])
    return both.select("post_id", "source", "backlash_flag", "migration_flag")


@query("split_location", with_("raw_users") + f"""
SELECT ord, {strip_sql("string_split(location, ',')[1]")} AS city,
  CASE WHEN contains(location, ',') THEN {strip_sql("substring(location, strpos(location, ',') + 1)")} END AS country FROM raw_users""")
def split_location(spark, d):
    return C.split_location(raw_users(spark, d)).select("ord", "city", "country")


@query("sample_view", with_("social") + """
SELECT post_id, substring("text", 1, 150) || '...' AS "text" FROM social
WHERE contains(lower("text"), 'the') AND source = 'src1' ORDER BY "timestamp", post_id LIMIT 5""")
def sample_view(spark, d):
    s = social(spark, d)
    hits = C.keyword_filter(s, "text", ["the"]).where("source = 'src1'")
    first = R.top_k(hits, [F.col("timestamp"), F.col("post_id")], 5)
    return first.select("post_id", F.concat(F.substring("text", 1, 150), F.lit("...")).alias("text"))


# -- missing values and whole cleaning --------------------------------------------------

CTE["blanked_posts"] = f"""
SELECT ord, {blank_out_sql('post_id')} AS post_id, user_id, {blank_out_sql('platform')} AS platform,
  {blank_out_sql('text_content')} AS text_content, {blank_out_sql('"timestamp"')} AS "timestamp",
  {blank_out_sql('likes')} AS likes, {blank_out_sql('shares')} AS shares, {blank_out_sql('comments')} AS comments FROM raw_posts"""
CTE["blanked_users"] = f"""
SELECT ord, user_id, {blank_out_sql('"location"')} AS "location", {blank_out_sql('"language"')} AS "language",
  {blank_out_sql('account_created')} AS account_created, {blank_out_sql('follower_count')} AS follower_count FROM raw_users"""


@query("impute_median", with_("raw_posts", "blanked_posts") + f"""
SELECT ord, {", ".join(
    f"coalesce({number_sql(c)}, (SELECT median({number_sql(c)}) FROM blanked_posts)) AS {c}" for c in ("likes", "shares", "comments"))}
FROM blanked_posts""")
def impute_median(spark, d):
    df = C.replace_placeholders(raw_posts(spark, d)).select("ord", "likes", "shares", "comments")
    return C.impute_median(df, ["likes", "shares", "comments"])


@query("impute_median_approx")
def impute_median_approx(spark, d):
    df = C.replace_placeholders(raw_posts(spark, d)).select("ord", "likes")
    return C.impute_median(df, ["likes"], approx=True)


def _mode_sql(column: str, min_share: float) -> str:
    return f"""
SELECT ord, coalesce({column}, CASE WHEN share >= {min_share} THEN v END) AS {column},
  CAST({column} IS NULL AS INTEGER) AS {column}_was_null
FROM blanked_posts, (SELECT {column} AS v, count(*) / (SELECT count({column}) FROM blanked_posts) AS share
  FROM blanked_posts WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)"""


@query("impute_mode_common", with_("raw_posts", "blanked_posts") + _mode_sql("platform", 0.1))
def impute_mode_common(spark, d):
    df = C.replace_placeholders(raw_posts(spark, d)).select("ord", "platform")
    return C.impute_mode(df, "platform", 0.1)


@query("impute_mode_rare", with_("raw_posts", "blanked_posts") + _mode_sql("platform", 0.3))
def impute_mode_rare(spark, d):
    return C.impute_mode(C.replace_placeholders(raw_posts(spark, d)).select("ord", "platform"), "platform")


@query("drop_null_rows", with_("raw_posts", "blanked_posts") + "SELECT ord FROM blanked_posts WHERE likes IS NOT NULL")
def drop_null_rows(spark, d):
    return C.replace_placeholders(raw_posts(spark, d)).dropna(subset=["likes"]).select("ord")


@query("flag_nulls", with_("raw_posts", "blanked_posts") + """
SELECT ord, CAST(likes IS NULL AS INTEGER) AS likes_was_null, CAST(user_id IS NULL AS INTEGER) AS user_id_was_null FROM blanked_posts""")
def flag_nulls(spark, d):
    df = C.flag_nulls(C.replace_placeholders(raw_posts(spark, d)), ["likes", "user_id"])
    return df.select("ord", "likes_was_null", "user_id_was_null")


@query("handle_missing", with_("raw_users", "blanked_users") + f"""
SELECT ord, user_id, "location", "language",
  coalesce(follower_count, CAST((SELECT median({number_sql('follower_count')}) FROM blanked_users) AS VARCHAR)) AS follower_count,
  CAST("location" IS NULL AS INTEGER) AS location_was_null, CAST(user_id IS NULL AS INTEGER) AS user_id_was_null
FROM blanked_users WHERE "language" IS NOT NULL""")
def handle_missing(spark, d):
    df = C.replace_placeholders(raw_users(spark, d)).drop("account_created")
    out = C.handle_missing(df, {"location": "flag", "follower_count": "median", "language": "drop"})
    return out.withColumn("ord", F.col("ord").cast("long"))


@query("missing_report", _RAW + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ("{c}" IS NULL OR "{c}" = '') AS missing,
    round(count(*) FILTER ("{c}" IS NULL OR "{c}" = '') * 100.0::DOUBLE / count(*), 1) AS missing_pct FROM raw_posts"""
    for c in _RAW_COLS
))
def missing_report(spark, d):
    return C.missing_report(raw_posts(spark, d).drop("ord"))


@query("duplicate_count", _RAW + "SELECT CAST(count(post_id) - count(DISTINCT post_id) AS BIGINT) AS duplicates FROM raw_posts")
def duplicate_count(spark, d):
    return C.duplicate_count(raw_posts(spark, d), ["post_id"])


@query("keep_first", _RAW + "SELECT min(ord) AS ord, post_id FROM raw_posts GROUP BY post_id")
def keep_first(spark, d):
    return C.deduplicate(raw_posts(spark, d), ["post_id"], ["ord"]).select("ord", "post_id")


@query("drop_duplicates", """SELECT DISTINCT "text" FROM documents""")
def drop_duplicates(spark, d):
    return C.deduplicate(table(spark, d, "documents").select("text"))


_CLEAN_POSTS = f"""
SELECT ord, post_id, user_id, CASE WHEN platform IN ({quoted(X.PLATFORMS)}) THEN platform END AS platform,
  CAST(NOT coalesce(platform IN ({quoted(X.PLATFORMS)}), false) AS INTEGER) AS platform_was_null,
  {clean_post_sql('text_content')} AS text_content, strftime({mixed_ts_sql('"timestamp"')}, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
  {", ".join(f"coalesce({number_sql(c)}, (SELECT median({number_sql(c)}) FROM blanked_posts)) AS {c}" for c in ("likes", "shares", "comments"))}
FROM blanked_posts QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY ord) = 1"""
CTE["clean_posts"] = _CLEAN_POSTS
CTE["clean_users"] = f"""
SELECT ord, user_id, {strip_sql('"location"')} AS "location", lower({strip_sql('"language"')}) AS "language",
  strftime({mixed_ts_sql('account_created')}, '%Y-%m-%d') AS account_created,
  {number_sql(f"coalesce(follower_count, CAST((SELECT median({number_sql('follower_count')}) FROM blanked_users) AS VARCHAR))")} AS follower_count,
  CAST("location" IS NULL AS INTEGER) AS location_was_null, CAST("language" IS NULL AS INTEGER) AS language_was_null,
  CAST(account_created IS NULL AS INTEGER) AS account_created_was_null
FROM blanked_users QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ord) = 1"""


@query("clean_posts", with_("raw_posts", "blanked_posts", "clean_posts") + "SELECT * FROM clean_posts")
def clean_posts(spark, d):
    return P.clean_posts(raw_posts(spark, d))


@query("clean_users", with_("raw_users", "blanked_users", "clean_users") + "SELECT * FROM clean_users")
def clean_users(spark, d):
    return P.clean_users(raw_users(spark, d))


@query("clean_and_roll_up", with_("raw_posts", "blanked_posts", "clean_posts", "raw_users", "blanked_users", "clean_users") + """
SELECT u.user_id, u.location, u.follower_count, total_posts, total_likes, platforms_used,
  coalesce(avg_likes, 0) * 0.5::DOUBLE + coalesce(total_shares, 0) * 0.3::DOUBLE + coalesce(total_comments, 0) * 0.2::DOUBLE AS engagement_score
FROM clean_users u LEFT JOIN (
  SELECT user_id, count(post_id) AS total_posts, sum(likes) AS total_likes, sum(shares) AS total_shares, sum(comments) AS total_comments,
    avg(likes) AS avg_likes, count(DISTINCT platform) AS platforms_used FROM clean_posts GROUP BY user_id) a ON u.user_id = a.user_id""")
def clean_and_roll_up(spark, d):
    from pulse.operators.engagement import user_rollup

    merged = user_rollup(P.clean_posts(raw_posts(spark, d)), P.clean_users(raw_users(spark, d)))
    return merged.select("user_id", "location", "follower_count", "total_posts", "total_likes", "platforms_used", "engagement_score")


_CHANGES = with_("raw_posts", "blanked_posts") + f""", counts AS (
SELECT count(*) FILTER (NOT coalesce(platform IN ({quoted(X.PLATFORMS)}), false)) AS a,
  count({clean_post_sql('text_content')}) AS b, count({mixed_ts_sql('"timestamp"')}) AS c,
  count(*) - count({number_sql('likes')}) AS e, count(*) - count({number_sql('shares')}) AS f, count(*) - count({number_sql('comments')}) AS g
FROM blanked_posts)
SELECT 'missing' AS stage, 'platform' AS "column", 'flag_invalid' AS "method", a AS rows_affected,
  'Flagged ' || a || ' invalid or missing platform values' AS detail FROM counts
UNION ALL SELECT 'standardize', 'text_content', 'strip_html', b, 'Cleaned ' || b || ' texts' FROM counts
UNION ALL SELECT 'standardize', 'timestamp', 'multi_format_parse', c, 'Parsed ' || c || ' timestamps' FROM counts
UNION ALL SELECT 'missing', 'likes', 'median_impute', e, 'Imputed ' || e || ' null likes' FROM counts
UNION ALL SELECT 'missing', 'shares', 'median_impute', f, 'Imputed ' || f || ' null shares' FROM counts
UNION ALL SELECT 'missing', 'comments', 'median_impute', g, 'Imputed ' || g || ' null comments' FROM counts"""


@query("change_log", _CHANGES)
def change_log(spark, d):
    return P.posts_change_log(raw_posts(spark, d))


@query("change_log_runs", f"WITH log AS ({_CHANGES}) SELECT run_id, log.* FROM log, (VALUES ('run 1'), ('run/2')) r(run_id)")
def change_log_runs(spark, d):
    path, raw = run_dir(spark, "change-log"), raw_posts(spark, d)
    # The first run is stopped and repeated over all rows; the second stays.
    for run_id, rows in (("run 1", raw.where("platform IS NULL")), ("run/2", raw), ("run 1", raw)):
        append_run(P.posts_change_log(rows), path, run_id)
    return read_runs(spark, path)


@query("text_audit", with_("labelled") + """
SELECT count(*) AS raw_rows, count(*) - count(post_text) AS missing_text_rows, 0::BIGINT AS empty_text_rows,
  count(post_text) - count(DISTINCT post_text) AS duplicate_rows_removed, count(DISTINCT post_text) AS clean_rows FROM labelled""")
def text_audit(spark, d):
    return C.text_audit(labelled(spark, d))


# The scored record with repeated ids, bad times, odd source names and negative engagement.
CTE["dirty_social"] = """
SELECT doc_id AS ord, 'd' || (CASE WHEN doc_id % 30 = 29 THEN doc_id - 1 ELSE doc_id END) AS post_id,
  CASE WHEN doc_id % 27 = 0 THEN '  ' ELSE s."text" END AS "text",
  CASE WHEN doc_id % 25 = 0 THEN 'later' ELSE strftime("timestamp", '%Y-%m-%d %H:%M:%S') END AS "timestamp",
  CASE WHEN doc_id % 4 = 0 THEN 'whatsapp_playstore' WHEN doc_id % 4 = 1 THEN 'kaggle_telegram' ELSE 'web' END AS source_name,
  CASE WHEN doc_id % 22 = 0 THEN '-3' WHEN doc_id % 26 = 0 THEN 'x' ELSE CAST(n_chars AS VARCHAR) END AS engagement_metric,
  sentiment_label, sentiment_score
FROM social s JOIN documents d ON s.post_id = 'd' || d.doc_id"""


def dirty_social(spark, d):
    s = social(spark, d).withColumn("doc_id", F.substring("post_id", 2, 20).cast("long"))
    return s.selectExpr(
        "doc_id AS ord",
        "concat('d', CASE WHEN doc_id % 30 = 29 THEN doc_id - 1 ELSE doc_id END) AS post_id",
        "CASE WHEN doc_id % 27 = 0 THEN '  ' ELSE text END AS text",
        "CASE WHEN doc_id % 25 = 0 THEN 'later' ELSE date_format(timestamp, 'yyyy-MM-dd HH:mm:ss') END AS timestamp",
        """CASE WHEN doc_id % 4 = 0 THEN 'whatsapp_playstore' WHEN doc_id % 4 = 1 THEN 'kaggle_telegram'
           ELSE 'web' END AS source_name""",
        """CASE WHEN doc_id % 22 = 0 THEN '-3' WHEN doc_id % 26 = 0 THEN 'x'
           ELSE CAST(CAST(engagement_metric AS BIGINT) AS STRING) END AS engagement_metric""",
        "sentiment_label",
        "sentiment_score",
        "CAST(NULL AS STRING) AS country",
    )


_FIRSTS = with_("social", "dirty_social") + """, firsts AS (
SELECT * FROM dirty_social QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY ord) = 1),
kept AS (SELECT * FROM firsts WHERE trim("text") <> '')
"""
_CONFLICT = "(sentiment_label = 'Positive' AND sentiment_score < -0.3) OR (sentiment_label = 'Negative' AND sentiment_score > 0.5)"


@query("deep_clean", _FIRSTS + f"""
SELECT ord, post_id, "text", strftime(TRY_CAST("timestamp" AS TIMESTAMP), '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
  CASE source_name WHEN 'whatsapp_playstore' THEN 'whatsapp' WHEN 'kaggle_telegram' THEN 'telegram' ELSE source_name END AS source_name,
  greatest(coalesce(TRY_CAST(engagement_metric AS DOUBLE), 0), 0) AS engagement_metric, sentiment_label, sentiment_score,
  CAST({_CONFLICT} AS INTEGER) AS sentiment_conflict FROM kept""")
def deep_clean(spark, d):
    return P.deep_clean(dirty_social(spark, d), ["ord"])


@query("deep_clean_issues", _FIRSTS + f"""
SELECT 'duplicate_post_id' AS issue, (SELECT count(*) FROM dirty_social) - (SELECT count(*) FROM firsts) AS n_rows
UNION ALL SELECT 'empty_text', (SELECT count(*) FROM firsts) - (SELECT count(*) FROM kept)
UNION ALL SELECT 'unparseable_timestamps', count(*) FILTER (TRY_CAST("timestamp" AS TIMESTAMP) IS NULL) FROM kept
UNION ALL SELECT 'sentiment_conflicts', count(*) FILTER ({_CONFLICT}) FROM kept
UNION ALL SELECT 'source_names_folded', count(*) FILTER (source_name <> 'web') FROM kept
UNION ALL SELECT 'negative_engagement', count(*) FILTER (engagement_metric = '-3') FROM kept""")
def deep_clean_issues(spark, d):
    return P.deep_clean_issues(dirty_social(spark, d), ["ord"])


@query("merge_social", with_("social", "dirty_social") + f""", cleaned AS (
SELECT post_id, source_name AS source, {clean_social_sql('"text"')} AS "text", TRY_CAST("timestamp" AS TIMESTAMP) AS ts,
  coalesce(TRY_CAST(engagement_metric AS DOUBLE), 0) AS engagement_metric FROM dirty_social)
SELECT post_id, source, "text", engagement_metric, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp" FROM cleaned
WHERE length("text") >= 10 AND ts >= TIMESTAMP '2020-12-01' AND ts <= TIMESTAMP '2021-07-01' + INTERVAL 1 DAY
QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY ts, source) = 1""")
def merge_social(spark, d):
    raw = dirty_social(spark, d).withColumnRenamed("source_name", "source")
    merged = P.merge_social(raw, "2020-12-01", "2021-07-01")
    return merged.select("post_id", "source", "text", "engagement_metric", "timestamp")


# -- integrity ------------------------------------------------------------------------


@query("validation_metrics", with_("posts", "users") + """
SELECT 'users_count' AS metric, count(*) AS "value" FROM users
UNION ALL SELECT 'posts_count', count(*) FROM posts
UNION ALL SELECT 'duplicate_users', count(user_id) - count(DISTINCT user_id) FROM users
UNION ALL SELECT 'duplicate_posts', count(post_id) - count(DISTINCT post_id) FROM posts
UNION ALL SELECT 'null_platforms', count(*) FROM posts WHERE platform IS NULL
UNION ALL SELECT 'negative_likes', count(*) FROM posts WHERE likes < 0
UNION ALL SELECT 'max_shares', max(shares) FROM posts
UNION ALL SELECT 'min_shares', min(shares) FROM posts""")
def validation_metrics(spark, d):
    return I.validation_metrics(users(spark, d), posts(spark, d))


@query("integrity_report", with_("raw_posts", "blanked_posts", "clean_posts", "raw_users") + f""", u AS (
SELECT user_id, {number_sql('follower_count')} AS follower_count FROM raw_users)
SELECT 'users_primary_key' AS "check", (SELECT count(*) FROM (SELECT user_id FROM u GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'posts_primary_key', (SELECT count(*) FROM (SELECT post_id FROM raw_posts GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'posts_user_foreign_key', (SELECT count(*) FROM raw_posts WHERE user_id NOT IN (SELECT user_id FROM u))
UNION ALL SELECT 'followers_not_negative', (SELECT count(*) FROM u WHERE follower_count < 0)
UNION ALL SELECT 'shares_not_negative', (SELECT count(*) FROM raw_posts WHERE {number_sql('shares')} < 0)
UNION ALL SELECT 'comments_not_negative', (SELECT count(*) FROM raw_posts WHERE {number_sql('comments')} < 0)""")
def integrity_report(spark, d):
    u = raw_users(spark, d).withColumn("follower_count", V.to_double("follower_count"))
    p = raw_posts(spark, d).withColumns({c: V.to_double(c) for c in ("shares", "comments")})
    return I.integrity_report(u, p)


@query("union_all", """SELECT c_name AS "name", c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier""")
def union_all(spark, d):
    c = table(spark, d, "customer").selectExpr("c_name AS name", "c_nationkey AS nation")
    return c.union(table(spark, d, "supplier").selectExpr("s_name", "s_nationkey"))


@query("union_ragged", """SELECT c_name AS "name", c_acctbal AS balance, NULL::VARCHAR AS "kind" FROM customer
UNION ALL SELECT p_name, NULL, p_type FROM part""")
def union_ragged(spark, d):
    return I.stack(
        table(spark, d, "customer").selectExpr("c_name AS name", "c_acctbal AS balance"),
        table(spark, d, "part").selectExpr("p_name AS name", "p_type AS kind"),
    )


@query("common_rows", "SELECT c_nationkey AS nation FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def common_rows(spark, d):
    return I.common_rows(
        table(spark, d, "customer").selectExpr("c_nationkey AS nation"),
        table(spark, d, "supplier").selectExpr("s_nationkey AS nation"),
    )
