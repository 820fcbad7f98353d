"""Registered time-series, event-correlation, profiling and term queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.operators import correlation as K
from pulse.operators import engagement as E
from pulse.operators import profiling as Q
from pulse.operators import ranking as R
from pulse.operators import series as S
from pulse.operators import terms as M
from pulse.plans.registry import query
from pulse.plans.tables import CTE, labelled, posts, quoted, social, table, users, with_

# -- activity on events ---------------------------------------------------------------

CTE["acts"] = """
SELECT event_id AS post_id, ts AS "timestamp", event_type, floor("value" * 10) AS engagement_metric FROM events"""


def acts(spark, d):
    return table(spark, d, "events").selectExpr(
        "event_id AS post_id", "ts AS timestamp", "event_type", "CAST(floor(value * 10) AS DOUBLE) AS engagement_metric"
    )


def _activity_sql(freq: str, by: str = "") -> str:
    b = f"{by}, " if by else ""
    return f"""SELECT {b}date_trunc('{freq}', "timestamp") AS bucket, count(post_id) AS volume,
  sum(engagement_metric) AS engagement_sum, avg(engagement_metric) AS engagement_mean FROM acts GROUP BY ALL"""


def _rolled_sql(src: str, value: str, prefix: str, frame: str, by: str = "", minimum: int = 1) -> str:
    part = f"PARTITION BY {by} " if by else ""
    w = f"OVER ({part}ORDER BY bucket ROWS BETWEEN {frame})"
    return f"""SELECT *, ({value} - {prefix}_mean) / ({prefix}_std + 1e-9) AS {prefix}_zscore FROM (
  SELECT *, CASE WHEN count({value}) {w} >= {minimum} THEN avg({value}) {w} END AS {prefix}_mean,
    coalesce(CASE WHEN count({value}) {w} >= {minimum} THEN stddev_samp({value}) {w} END, 0) AS {prefix}_std FROM {src})"""


def _spikes_sql(freq: str, frame: str, by: str = "") -> str:
    return (
        with_("acts")
        + f""", series AS ({_activity_sql(freq, by)}), vol AS ({_rolled_sql('series', 'volume', 'vol', frame, by)}),
eng AS ({_rolled_sql('vol', 'engagement_sum', 'eng', frame, by)})
SELECT {by + ',' if by else ''} strftime(bucket, '%Y-%m-%d %H') AS bucket, volume, engagement_sum,
  round(vol_mean, 6) AS vol_mean, round(vol_std, 6) AS vol_std, round(vol_zscore, 6) + 0.0 AS vol_zscore,
  round(eng_zscore, 6) + 0.0 AS eng_zscore,
  coalesce(vol_zscore > 2.0, false) AS is_spike, coalesce(eng_zscore > 2.0, false) AS is_eng_spike FROM eng"""
    )


def _spike_columns(df, by=()):
    r = lambda c: F.round(c, 6).alias(c)
    return df.select(
        *by, F.date_format("bucket", "yyyy-MM-dd HH").alias("bucket"), "volume", "engagement_sum",
        r("vol_mean"), r("vol_std"), r("vol_zscore"), r("eng_zscore"), "is_spike", "is_eng_spike",
    )


@query("daily_activity", with_("acts") + f"""SELECT strftime(bucket, '%Y-%m-%d') AS bucket, volume, engagement_sum,
  round(engagement_mean, 6) AS engagement_mean FROM ({_activity_sql('day')})""")
def daily_activity(spark, d):
    a = S.activity(acts(spark, d))
    return a.select(
        F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), "volume", "engagement_sum",
        F.round("engagement_mean", 6).alias("engagement_mean"),
    )


@query("daily_spikes", _spikes_sql("day", "6 PRECEDING AND CURRENT ROW"))
def daily_spikes(spark, d):
    return _spike_columns(S.spikes(S.activity(acts(spark, d))))


@query("hourly_spikes", _spikes_sql("hour", "23 PRECEDING AND CURRENT ROW"))
def hourly_spikes(spark, d):
    return _spike_columns(S.spikes(S.activity(acts(spark, d), "hour"), "hour"))


@query("hourly_spikes_per_type", _spikes_sql("hour", "23 PRECEDING AND CURRENT ROW", "event_type"))
def hourly_spikes_per_type(spark, d):
    by = ["event_type"]
    return _spike_columns(S.spikes(S.activity(acts(spark, d), "hour", by=by), "hour", by=by), by)


@query("daily_spikes_exclusive", _spikes_sql("day", "7 PRECEDING AND 1 PRECEDING"))
def daily_spikes_exclusive(spark, d):
    return _spike_columns(S.spikes(S.activity(acts(spark, d)), exclude_current=True))


# -- sentiment ---------------------------------------------------------------------------

_SENT = """SELECT date_trunc('{freq}', "timestamp") AS bucket, avg(sentiment_numeric) AS sentiment_mean,
  stddev_samp(sentiment_numeric) AS sentiment_std, count(post_id) AS n,
  avg(CAST(sentiment_numeric = 0 AS INTEGER)) AS neg_frac, avg(CAST(sentiment_numeric = 1 AS INTEGER)) AS pos_frac
FROM social GROUP BY 1"""


def _shift_sql(freq: str, frame: str) -> str:
    return f"""shift_series AS ({_SENT.format(freq=freq)}), shifted AS (
SELECT *, CASE WHEN roll_zscore > 1.5 THEN 'positive' WHEN roll_zscore < -1.5 THEN 'negative' ELSE 'none' END AS shift_dir
FROM ({_rolled_sql('shift_series', 'sentiment_mean', 'roll', frame, minimum=3)}))"""


_SHIFT_OUT = """SELECT strftime(bucket, '%Y-%m-%d %H') AS bucket, round(sentiment_mean, 6) AS sentiment_mean,
  round(sentiment_std, 6) AS sentiment_std, n, round(neg_frac, 6) AS neg_frac, round(pos_frac, 6) AS pos_frac,
  round(roll_zscore, 6) + 0.0 AS roll_zscore, shift_dir, shift_dir <> 'none' AS is_shift FROM shifted"""


def _shift_columns(df):
    r = lambda c: F.round(c, 6).alias(c)
    return df.select(
        F.date_format("bucket", "yyyy-MM-dd HH").alias("bucket"), r("sentiment_mean"), r("sentiment_std"), "n",
        r("neg_frac"), r("pos_frac"), r("roll_zscore"), "shift_dir", "is_shift",
    )


@query("daily_shifts", with_("social") + ", " + _shift_sql("day", "3 PRECEDING AND 3 FOLLOWING") + _SHIFT_OUT)
def daily_shifts(spark, d):
    return _shift_columns(S.shifts(S.sentiment_series(social(spark, d))))


@query("hourly_shifts", with_("social") + ", " + _shift_sql("hour", "12 PRECEDING AND 11 FOLLOWING") + _SHIFT_OUT)
def hourly_shifts(spark, d):
    return _shift_columns(S.shifts(S.sentiment_series(social(spark, d), "hour"), "hour"))


_PHASE_CASE = "CASE " + " ".join(
    f"WHEN \"timestamp\" >= TIMESTAMP '{a}' AND \"timestamp\" {'<=' if c else '<'} TIMESTAMP '{b}' THEN '{n}'"
    for n, a, b, c in X.PHASES
) + " END"


@query("phase_counts", with_("social") + f"""SELECT {_PHASE_CASE} AS phase, count(*) AS n,
  avg(sentiment_numeric) AS sentiment FROM social GROUP BY 1""")
def phase_counts(spark, d):
    return S.label_phases(social(spark, d), X.PHASES).groupBy("phase").agg(
        F.count(F.lit(1)).alias("n"), F.avg("sentiment_numeric").alias("sentiment")
    )


# -- events, triggers, headlines ------------------------------------------------------------

TRIGGERS = [
    ("2020-11-10", "update announced"), ("2020-11-16", "rival app offers import"), ("2021-01-06", "new terms shown"),
    ("2021-01-08", "first complaints"), ("2021-02-08", "deadline moved"), ("2021-03-04", "regulator asks questions"),
    ("2021-05-15", "second deadline"), ("2021-06-25", "hearing"),
]
CTE["triggers"] = "SELECT CAST(d AS DATE) AS trigger_date, description FROM (VALUES " + ", ".join(
    f"('{a}', '{b}')" for a, b in TRIGGERS
) + ") t(d, description)"
CTE["headlines"] = """
SELECT conv_id * 100 + turn AS item_id,
  TIMESTAMP '2020-11-01' + to_days(CAST((conv_id * 3 + turn) % 273 AS INTEGER)) + to_hours(CAST(conv_id * 5 % 24 AS INTEGER)) AS ts,
  "text" AS title FROM conversations"""


def triggers(spark):
    rows = spark.createDataFrame(TRIGGERS, "d string, description string")
    return rows.select(F.to_date("d").alias("trigger_date"), "description")


def headlines(spark, d):
    return table(spark, d, "conversations").selectExpr(
        "conv_id * 100 + turn AS item_id",
        """CAST(TIMESTAMP_NTZ '2020-11-01 00:00:00' + make_dt_interval(CAST((conv_id * 3 + turn) % 273 AS INT),
           CAST(conv_id * 5 % 24 AS INT)) AS TIMESTAMP) AS ts""",
        "text AS title",
    )


# Event days: all days of the social record.
_DAYS = """days AS (SELECT DISTINCT CAST("timestamp" AS DATE) AS event_date FROM social)"""


def _days(spark, d):
    return social(spark, d).select(F.to_date("timestamp").alias("event_date")).distinct()


@query("nearest_trigger", with_("social", "triggers") + f""", {_DAYS}, near AS (
SELECT event_date, trigger_date, description, abs(event_date - trigger_date) AS days_apart FROM days JOIN triggers
  ON abs(event_date - trigger_date) <= 7
QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY days_apart, trigger_date) = 1)
SELECT CAST(event_date AS VARCHAR) AS event_date, CAST(trigger_date AS VARCHAR) AS trigger_date, description,
  CAST(days_apart AS INTEGER) AS days_apart FROM days LEFT JOIN near USING (event_date)""")
def nearest_trigger(spark, d):
    found = K.nearest_event(_days(spark, d), triggers(spark))
    return found.withColumns({c: F.col(c).cast("string") for c in ("event_date", "trigger_date")})


@query("headlines_near_days", with_("social", "headlines") + f""", {_DAYS}
SELECT CAST(event_date AS VARCHAR) AS event_date, item_id, title FROM days JOIN headlines
  ON ts BETWEEN CAST(event_date AS TIMESTAMP) - INTERVAL 48 HOURS AND CAST(event_date AS TIMESTAMP) + INTERVAL 48 HOURS
QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY ts DESC, item_id) <= 5""")
def headlines_near_days(spark, d):
    events = _days(spark, d).select(F.col("event_date").cast("timestamp").alias("event_ts"))
    found = K.within_interval(events, headlines(spark, d))
    return found.select(F.to_date("event_ts").cast("string").alias("event_date"), "item_id", "title")


CTE["social_acts"] = 'SELECT post_id, "timestamp", engagement_metric FROM social'
_EVENTS_SQL = (
    with_("social", "triggers", "headlines")
    + ", "
    + _shift_sql("day", "3 PRECEDING AND 3 FOLLOWING")
    + f""", acts AS (SELECT * FROM social), series AS ({_activity_sql('day')}),
vol AS ({_rolled_sql('series', 'volume', 'vol', '6 PRECEDING AND CURRENT ROW')}),
eng AS ({_rolled_sql('vol', 'engagement_sum', 'eng', '6 PRECEDING AND CURRENT ROW')}),
every AS (SELECT 1 AS prio, CAST(bucket AS DATE) AS event_date, 'sentiment_shift' AS event_type, roll_zscore AS z, shift_dir AS direction
  FROM shifted WHERE shift_dir <> 'none'
UNION ALL SELECT 2, CAST(bucket AS DATE), 'volume_spike', vol_zscore, '' FROM eng WHERE vol_zscore > 2.0
UNION ALL SELECT 3, CAST(bucket AS DATE), 'engagement_spike', eng_zscore, '' FROM eng WHERE eng_zscore > 2.0),
found AS (SELECT event_date, event_type, round(z, 3) + 0.0 AS zscore, direction FROM every
  QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY prio) = 1)"""
)


def _found(spark, d):
    s = social(spark, d)
    return K.merge_events(S.shifts(S.sentiment_series(s)), S.spikes(S.activity(s)))


@query("detected_events", _EVENTS_SQL + """
SELECT CAST(event_date AS VARCHAR) AS event_date, event_type, zscore, direction FROM found""")
def detected_events(spark, d):
    return _found(spark, d).withColumn("event_date", F.col("event_date").cast("string"))


@query("event_hypotheses", _EVENTS_SQL + """, near AS (
SELECT event_date, trigger_date, description FROM found JOIN triggers ON abs(event_date - trigger_date) <= 7
QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY abs(event_date - trigger_date), trigger_date) = 1),
heads AS (SELECT event_date, string_agg(title, ' / ' ORDER BY ts DESC, item_id) AS headlines FROM (
  SELECT event_date, ts, item_id, title FROM found JOIN headlines
    ON ts BETWEEN CAST(event_date AS TIMESTAMP) - INTERVAL 48 HOURS AND CAST(event_date AS TIMESTAMP) + INTERVAL 48 HOURS
  QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY ts DESC, item_id) <= 5) GROUP BY event_date)
SELECT CAST(f.event_date AS VARCHAR) AS event_date, event_type, CASE WHEN trigger_date IS NULL
  THEN 'Hypothesis: the ' || event_type || ' on ' || CAST(f.event_date AS VARCHAR) || ' has no known trigger nearby.'
  ELSE 'Hypothesis: the ' || event_type || ' on ' || CAST(f.event_date AS VARCHAR) || ' likely correlates with ''' || description
    || ''' (' || CAST(trigger_date AS VARCHAR) || ').' END AS hypothesis, coalesce(headlines, '') AS headlines
FROM found f LEFT JOIN near n ON f.event_date = n.event_date LEFT JOIN heads h ON f.event_date = h.event_date""")
def event_hypotheses(spark, d):
    out = K.correlate(_found(spark, d), triggers(spark), headlines(spark, d))
    return out.select(
        F.col("event_date").cast("string").alias("event_date"), "event_type", "hypothesis",
        F.array_join("headlines", " / ").alias("headlines"),
    )


# -- terms ---------------------------------------------------------------------------------------

_TERMS = ["the", "ent", "ou", "leaux", "schu", "nothere", "ing "]


@query("aspect_sentiment", with_("social") + f"""
SELECT aspect_term, count(*) AS total_mentions, round(avg(sentiment_numeric), 4) AS avg_sentiment,
  round(avg(CAST(sentiment_label = 'Negative' AS INTEGER)), 4) AS negative_ratio,
  round(avg(CAST(sentiment_label = 'Positive' AS INTEGER)), 4) AS positive_ratio,
  round(avg(sentiment_numeric) FILTER (source = 'src1'), 4) AS src1_avg_sentiment,
  round(avg(sentiment_numeric) FILTER (source = 'src2'), 4) AS src2_avg_sentiment
FROM social JOIN (SELECT unnest([{quoted(_TERMS)}]) AS aspect_term) ON contains(lower("text"), aspect_term) GROUP BY aspect_term""")
def aspect_sentiment(spark, d):
    return M.aspects(social(spark, d), _TERMS, ["src1", "src2"])


_STOP = ["the", "and", "of", "to", "in", "le", "la", "les", "de", "des", "un", "une", "et", "der", "die", "das", "und", "ein", "zu", "is", "it"]
_BAN = ["tion", "lich", "aux"]
_WEEKS = """weeks AS (SELECT *, CAST(date_trunc('week', "timestamp") AS DATE) AS bucket FROM social),
sizes AS (SELECT bucket, count(*) AS n_docs FROM weeks GROUP BY bucket),
toks AS (SELECT post_id, bucket, list_filter(regexp_extract_all(lower("text"), '[\\p{L}\\p{N}_]{2,}'), lambda t: t NOT IN (%s)) AS t FROM weeks),
grams AS (SELECT post_id, bucket, unnest(list_concat(t, list_transform(generate_series(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM toks),
stats AS (SELECT bucket, term, count(*) AS tf, count(DISTINCT post_id) AS df FROM grams GROUP BY ALL HAVING count(DISTINCT post_id) >= 2),
vocab AS (SELECT * FROM stats QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY tf DESC, term) <= 500),
few AS (SELECT bucket, unnest(string_split_regex(lower(trim(regexp_replace("text", '[\\s\\p{Z}]+', ' ', 'g'))), ' ')) AS term
  FROM weeks JOIN sizes USING (bucket) WHERE n_docs < 5)""" % quoted(_STOP)


def _trending_sql(score: str) -> str:
    banned = " OR ".join(f"contains(term, '{b}')" for b in _BAN)
    return f""", {_WEEKS}, scored AS (
SELECT bucket, term, {score} AS score FROM vocab JOIN sizes USING (bucket) WHERE n_docs >= 5 AND NOT ({banned})
UNION ALL SELECT bucket, term, CAST(count(*) AS DOUBLE) FROM few WHERE length(term) > 3 AND term NOT IN ({quoted(_BAN)}) GROUP BY ALL),
trend AS (SELECT bucket, term, round(score, 4) AS score FROM scored
  QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY score DESC, term) <= 20)"""


_IDF = "ln((1 + n_docs) / (1 + df)) + 1"


def _trending(spark, d, rank="idf"):
    return M.trending(M.weekly(social(spark, d)), rank=rank, stop_words=_STOP, stoplist=_BAN)


@query("trending_terms", with_("social") + _trending_sql(_IDF) + "SELECT CAST(bucket AS VARCHAR) AS bucket, term, score FROM trend")
def trending_terms(spark, d):
    return _trending(spark, d).withColumn("bucket", F.col("bucket").cast("string"))


@query("trending_terms_weighted", with_("social") + _trending_sql(f"tf * ({_IDF})")
       + "SELECT CAST(bucket AS VARCHAR) AS bucket, term, score FROM trend")
def trending_terms_weighted(spark, d):
    return _trending(spark, d, "tfidf").withColumn("bucket", F.col("bucket").cast("string"))


# Names to look for: the first two and the first four words of each benchmark passage.
CTE["gazetteer"] = """
SELECT alias, min('item ' || alias) AS entity, min(CASE item_id % 3 WHEN 0 THEN 'ORG' WHEN 1 THEN 'PERSON' ELSE 'DATE' END) AS "type"
FROM (SELECT item_id, unnest([array_to_string(w[1:2], ' '), array_to_string(w[1:4], ' ')]) AS alias
  FROM (SELECT item_id, regexp_extract_all(lower("text"), '[\\p{L}\\p{N}_]+') AS w FROM benchmark))
GROUP BY alias"""


def gazetteer(spark, d):
    from pulse.functions.text import tokens

    named = table(spark, d, "benchmark").select(
        F.explode(F.array(*[F.array_join(F.slice(tokens("text"), 1, n), " ") for n in (2, 4)])).alias("alias"),
        F.expr("CASE item_id % 3 WHEN 0 THEN 'ORG' WHEN 1 THEN 'PERSON' ELSE 'DATE' END").alias("type"),
    )
    return named.groupBy("alias").agg(F.min(F.concat(F.lit("item "), "alias")).alias("entity"), F.min("type").alias("type"))


_RUNS = """runs AS (SELECT bucket, unnest(list_concat(t, list_concat(
    list_transform(generate_series(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1]),
    list_transform(generate_series(1, len(t) - 3), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2] || ' ' || t[i + 3])))) AS alias
  FROM (SELECT CAST(date_trunc('week', "timestamp") AS DATE) AS bucket, regexp_extract_all(lower("text"), '[\\p{L}\\p{N}_]+') AS t FROM social)),
mentions AS (SELECT bucket, entity, "type", count(*) AS mentions FROM runs JOIN gazetteer USING (alias)
  WHERE "type" IN ('ORG', 'PERSON') GROUP BY ALL)"""


@query("entity_mentions", with_("social", "gazetteer") + f""", {_RUNS}
SELECT entity, "type", CAST(sum(mentions) AS BIGINT) AS mentions FROM mentions GROUP BY ALL""")
def entity_mentions(spark, d):
    return M.entities(social(spark, d), gazetteer(spark, d))


# Noise: every entity whose name holds "th".
@query("weekly_entities", with_("social", "gazetteer") + f""", {_RUNS}
SELECT CAST(bucket AS VARCHAR) AS bucket, entity, "type", mentions FROM mentions WHERE NOT contains(entity, 'th')
QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY mentions DESC, entity, "type") <= 15""")
def weekly_entities(spark, d):
    g = gazetteer(spark, d)
    noise = g.where(F.col("entity").contains("th")).select("entity")
    found = M.entities(M.weekly(social(spark, d)), g, ["bucket"], noise)
    top = R.top_k(found, [F.desc("mentions"), F.col("entity"), F.col("type")], 15, ["bucket"])
    return top.withColumn("bucket", F.col("bucket").cast("string"))


def _summary(spark, d):
    w = M.weekly(social(spark, d))
    return M.bucket_summary(w, _trending(spark, d), M.entities(w, gazetteer(spark, d), ["bucket"]))


_SUMMARY_SQL = (
    with_("social", "gazetteer")
    + _trending_sql(_IDF)
    + f""", {_RUNS}, named AS (
SELECT bucket, list(entity ORDER BY mentions DESC, entity, "type") AS top_entities FROM (SELECT * FROM mentions
  QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY mentions DESC, entity, "type") <= 15) GROUP BY bucket),
listed AS (SELECT bucket, list(term ORDER BY score DESC, term) AS trending_terms FROM trend GROUP BY bucket),
dist AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS n_posts, string_agg(sentiment_label || '=' || n, ';' ORDER BY sentiment_label) AS sentiment_dist
  FROM (SELECT bucket, sentiment_label, count(*) AS n FROM weeks GROUP BY ALL) GROUP BY bucket)"""
)


@query("weekly_summary", _SUMMARY_SQL + """
SELECT CAST(d.bucket AS VARCHAR) AS bucket, n_posts, sentiment_dist, coalesce(array_to_string(trending_terms, ', '), '') AS trending_terms,
  coalesce(array_to_string(top_entities, ', '), '') AS top_entities
FROM dist d LEFT JOIN listed l ON d.bucket = l.bucket LEFT JOIN named n ON d.bucket = n.bucket""")
def weekly_summary(spark, d):
    dist = F.array_sort(F.map_entries("sentiment_dist"))
    flat = F.transform(dist, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    text = lambda c: F.coalesce(F.array_join(c, ", "), F.lit("")).alias(c)
    return _summary(spark, d).select(
        F.col("bucket").cast("string").alias("bucket"), "n_posts", F.array_join(flat, ";").alias("sentiment_dist"),
        text("trending_terms"), text("top_entities"),
    )


@query("busy_weeks", _SUMMARY_SQL + """
SELECT CAST(d.bucket AS VARCHAR) AS bucket, n_posts, coalesce(array_to_string(trending_terms[1:3], ', '), '') AS key_terms,
  coalesce(array_to_string(top_entities[1:3], ', '), '') AS top_entities
FROM dist d LEFT JOIN listed l ON d.bucket = l.bucket LEFT JOIN named n ON d.bucket = n.bucket WHERE n_posts > 20""")
def busy_weeks(spark, d):
    return M.busy_buckets(_summary(spark, d), 20).withColumn("bucket", F.col("bucket").cast("string"))


# -- profiling ---------------------------------------------------------------------------------------


@query("value_counts", "SELECT lang, count(*) AS n, count(*) / (SELECT count(lang) FROM documents) AS share FROM documents GROUP BY lang")
def value_counts(spark, d):
    return Q.value_counts(table(spark, d, "documents"), "lang", normalise=True)


@query("source_distribution", with_("social") + "SELECT source, count(*) AS n FROM social GROUP BY source")
def source_distribution(spark, d):
    return Q.value_counts(social(spark, d), "source")


def _overview_sql(src: str, cols: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) - count("{c}") AS null_count,
  round((count(*) - count("{c}")) * 100.0::DOUBLE / count(*), 2) AS null_pct, count(DISTINCT "{c}") AS "unique" FROM {src}"""
        for c, t in cols.items()
    )


_POST_COLS = {"platform": "string", "likes": "double", "shares": "bigint", "comments": "bigint", "text_content": "string"}


@query("column_overview", with_("posts") + _overview_sql("posts", _POST_COLS))
def column_overview(spark, d):
    return Q.overview(posts(spark, d).select(*_POST_COLS))


@query("column_overview_approx")
def column_overview_approx(spark, d):
    return Q.overview(posts(spark, d).select(*_POST_COLS), approx=True)


_NUMS = ["likes", "shares", "comments"]
_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS "mean", round(stddev_samp({c}), 6) AS "std",
  CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max", quantile_cont({c}, 0.25)::DOUBLE AS q1,
  median({c})::DOUBLE AS "median", quantile_cont({c}, 0.75)::DOUBLE AS q3 FROM posts"""
    for c in _NUMS
)


@query("numeric_summary", with_("posts") + _DESCRIBE)
def numeric_summary(spark, d):
    s = Q.describe(posts(spark, d), _NUMS)
    return s.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query("profile_report", with_("posts") + f""", o AS ({_overview_sql('posts', _POST_COLS)}), s AS ({_DESCRIBE})
SELECT o.*, s."mean", s."std", s."min", s."max", s.q1, s."median", s.q3 FROM o LEFT JOIN s ON o."column" = s."column" """)
def profile_report(spark, d):
    p = Q.profile(posts(spark, d).select(*_POST_COLS))
    return p.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


_RAWC = {"platform": "string", "text_content": "string", "likes": "string"}


@query("profile_comparison", with_("raw_posts", "blanked_posts") + f""", b AS ({_overview_sql('raw_posts', _RAWC)}),
a AS ({_overview_sql('blanked_posts', _RAWC)})
SELECT "column", b.null_count AS nulls_before, b."unique" AS unique_before, a.null_count AS nulls_after, a."unique" AS unique_after,
  b.null_count - a.null_count AS nulls_removed FROM b FULL OUTER JOIN a USING ("column")""")
def profile_comparison(spark, d):
    from pulse.operators.cleaning import replace_placeholders
    from pulse.plans.tables import raw_posts

    raw = raw_posts(spark, d).select(*_RAWC)
    return Q.compare_profiles(Q.overview(raw), Q.overview(replace_placeholders(raw)))


@query("categorical_distributions", with_("posts") + """, long AS (
SELECT 'platform' AS "column", platform AS "value", count(*) AS n FROM posts WHERE platform IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'text_content', text_content, count(*) FROM posts WHERE text_content IS NOT NULL GROUP BY ALL)
SELECT * FROM long QUALIFY count(*) OVER (PARTITION BY "column") <= 20""")
def categorical_distributions(spark, d):
    return Q.categorical(posts(spark, d).select("platform", "text_content"))


_MERGED = ["follower_count", "total_posts", "avg_likes", "total_shares", "total_comments"]
_MERGED_SQL = with_("posts", "users") + """, merged AS (
SELECT follower_count, total_posts, avg_likes, total_shares, total_comments, 'same' AS flag FROM users LEFT JOIN (
  SELECT user_id, count(*) AS total_posts, avg(likes) AS avg_likes, sum(shares) AS total_shares, sum(comments) AS total_comments
  FROM posts GROUP BY user_id) USING (user_id)), pairs AS ("""
_MERGED_SQL += " UNION ALL ".join(
    f"""SELECT '{a}' AS col_a, '{b}' AS col_b, CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END AS r FROM merged"""
    for i, a in enumerate(_MERGED) for b in _MERGED[i + 1:]
) + ") "


def _corr(spark, d):
    merged = E.user_rollup(posts(spark, d), users(spark, d)).select(*_MERGED, F.lit(1.0).alias("constant"))
    return Q.correlations(merged)


@query("correlation_matrix", _MERGED_SQL + "SELECT col_a, col_b, round(r, 6) AS r FROM pairs")
def correlation_matrix(spark, d):
    return _corr(spark, d).withColumn("r", F.round("r", 6))


@query("top_correlations", _MERGED_SQL + "SELECT col_a, col_b, round(r, 6) AS r FROM pairs ORDER BY abs(r) DESC NULLS LAST, col_a, col_b LIMIT 5")
def top_correlations(spark, d):
    return Q.top_pairs(_corr(spark, d), 5).withColumn("r", F.round("r", 6))


@query("most_correlated", _MERGED_SQL + """SELECT c AS "column", round(sum(abs(r)) / (count(*) + 1), 6) AS mean_abs_r
FROM (SELECT col_a AS c, r FROM pairs UNION ALL SELECT col_b, r FROM pairs) GROUP BY c ORDER BY 2 DESC, 1 LIMIT 4""")
def most_correlated(spark, d):
    return Q.most_correlated(_corr(spark, d)).withColumn("mean_abs_r", F.round("mean_abs_r", 6))


@query("segment_medians", " UNION ALL ".join(
    f"""SELECT '{cat}' AS segment, {cat} AS category, '{num}' AS "column", median({num})::DOUBLE AS "median", count({num}) AS n
FROM orders WHERE {cat} IS NOT NULL GROUP BY {cat}"""
    for cat in ("o_orderstatus", "o_orderpriority") for num in ("o_totalprice", "o_custkey")
))
def segment_medians(spark, d):
    return Q.segment_medians(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"], ["o_totalprice", "o_custkey"])


@query("segment_medians_approx")
def segment_medians_approx(spark, d):
    return R.quantiles(table(spark, d, "orders"), ["o_totalprice"], {"median": 0.5}, ["o_orderstatus"], approx=True)


@query("length_histogram", with_("labelled") + """
SELECT sentiment_label, least(CAST(floor(least(len(string_split(post_text, ' ')), 400) / 10.0) AS INTEGER), 39) AS bin, count(*) AS n
FROM labelled GROUP BY ALL""")
def length_histogram(spark, d):
    length = F.least(F.size(F.split("post_text", " ")), F.lit(400))
    return Q.histogram(labelled(spark, d), length, 0, 400, 40, ["sentiment_label"])


@query("price_histogram", """SELECT least(CAST(floor((o_totalprice - 0) / 12500.0) AS INTEGER), 39) AS bin, count(*) AS n
FROM orders WHERE o_totalprice BETWEEN 0 AND 500000 GROUP BY ALL""")
def price_histogram(spark, d):
    return Q.histogram(table(spark, d, "orders"), F.col("o_totalprice"), 0, 500000, 40)


_OUT = ["l_quantity", "l_extendedprice", "l_tax"]


@query("outlier_summary", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS iqr_outliers,
  count(*) FILTER (abs(({c} - m) / nullif(s, 0)) > 3) AS z_outliers, count({c}) AS total_non_null,
  round(count(*) FILTER ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) * 100.0::DOUBLE / count({c}), 2) AS iqr_pct
FROM lineitem, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, avg({c}) AS m, stddev_pop({c}) AS s FROM lineitem)"""
    for c in _OUT
))
def outlier_summary(spark, d):
    return Q.outliers(table(spark, d, "lineitem"), _OUT)


@query("event_outliers", """SELECT 'value' AS "column", count(*) FILTER ("value" < q1 - 1.5 * (q3 - q1) OR "value" > q3 + 1.5 * (q3 - q1)) AS iqr_outliers,
  count(*) FILTER (abs(("value" - m) / s) > 3) AS z_outliers, count("value") AS total_non_null,
  round(count(*) FILTER ("value" < q1 - 1.5 * (q3 - q1) OR "value" > q3 + 1.5 * (q3 - q1)) * 100.0::DOUBLE / count("value"), 2) AS iqr_pct
FROM events, (SELECT quantile_cont("value", 0.25) AS q1, quantile_cont("value", 0.75) AS q3, avg("value") AS m, stddev_pop("value") AS s FROM events)""")
def event_outliers(spark, d):
    return Q.outliers(table(spark, d, "events"), ["value"])


@query("null_patterns", with_("posts") + """SELECT pattern, count(*) AS n FROM (
SELECT CAST(CAST(platform IS NULL AS INTEGER) AS VARCHAR) || CAST(likes IS NULL AS INTEGER) || CAST(shares IS NULL AS INTEGER) AS pattern FROM posts)
WHERE contains(pattern, '1') GROUP BY pattern""")
def null_patterns(spark, d):
    return Q.null_patterns(posts(spark, d).select("platform", "likes", "shares"))


# Verdicts derived from the labels table: 1/1 means the model was right, 0/1 ambiguous.
@query("verdict_share", """SELECT count(*) AS n_rows, count(*) FILTER (quality = 1 AND toxic = 1) AS model_right,
  count(*) FILTER (quality = 0 AND toxic = 1) AS ambiguous, count(*) FILTER (toxic = 1) / count(*) AS share FROM labels""")
def verdict_share(spark, d):
    v = table(spark, d, "labels").selectExpr(
        "CASE WHEN toxic = 0 THEN 'label_right' WHEN quality = 1 THEN 'model_right' ELSE 'ambiguous' END AS verdict"
    )
    return Q.verdict_share(v, "verdict", ["model_right", "ambiguous"])
