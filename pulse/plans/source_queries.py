"""Registered source, sink and streaming queries.

Files and streams are derived from the driver tables: written to the shared
folder first, or read as a stream straight from the table's file.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pulse.operators import integrity as I
from pulse.operators.models import fit_model
from pulse.plans import pipelines as P
from pulse.plans.model_queries import bayes, training
from pulse.plans.registry import query
from pulse.plans.series_queries import TRIGGERS, _rolled_sql, triggers
from pulse.plans.tables import PREDICTIONS, predictions, raw_posts, raw_users, social, table, with_
from pulse.sources import payloads as Y
from pulse.sources import readers as D
from pulse.sources import sinks as S
from pulse.session import run_dir, stored
from pulse.streaming import streams as T

_COLS = ["post_id", "user_id", "platform", "text_content", "timestamp", "likes", "shares", "comments"]
_RAW = with_("raw_posts") + "SELECT " + ", ".join(f'coalesce("{c}", \'\') AS "{c}"' for c in _COLS) + " FROM raw_posts"


@query("raw_csv", _RAW)
def raw_csv(spark, d):
    path = run_dir(spark, "csv")
    S.write_result(raw_posts(spark, d).select(*_COLS), path, "csv")
    return D.read_raw_csv(spark, path)


@query("raw_json", _RAW)
def raw_json(spark, d):
    path = run_dir(spark, "json")
    S.write_result(raw_posts(spark, d).select(*_COLS), path, "json")
    return D.read_raw_json(spark, path, _COLS, lines=True)


@query("typed_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def typed_csv(spark, d):
    path = run_dir(spark, "typed")
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    S.write_result(rows, path, "csv")
    return D.read_typed(spark, path, rows.schema)


@query("harmonised_files", with_("social") + """
SELECT post_id, source, '' AS "text", strftime("timestamp", '%Y-%m-%d') AS "timestamp", '' AS engagement_metric, lang, NULL::VARCHAR AS url FROM social
UNION ALL SELECT 'b' || item_id, '', 'item ' || item_id, '', CAST(item_id AS VARCHAR), NULL, 'u' || item_id FROM benchmark""")
def harmonised_files(spark, d):
    root = run_dir(spark, "files")
    a = social(spark, d).select("post_id", "source", "lang", F.date_format("timestamp", "yyyy-MM-dd").alias("timestamp"))
    b = table(spark, d, "benchmark").selectExpr(
        "concat('b', item_id) AS post_id", "concat('item ', item_id) AS text", "item_id AS engagement_metric", "concat('u', item_id) AS url"
    )
    S.write_result(a, f"{root}/a", "csv")
    S.write_result(b, f"{root}/b", "csv")
    return D.read_harmonised(spark, [f"{root}/a", f"{root}/absent", f"{root}/b"])


@query("merged_bonus_sources", with_("social") + """
SELECT post_id, source, 'bonus_live_scraped' AS source_type, source AS source_name, lang FROM social
UNION ALL SELECT 'b' || item_id, 'bench', CASE WHEN item_id % 2 = 0 THEN 'api' ELSE 'bonus_live_scraped' END,
  CASE WHEN item_id % 2 = 0 THEN 'named' ELSE 'bench' END, '' FROM benchmark""")
def merged_bonus_sources(spark, d):
    a = social(spark, d).select("post_id", "source", "lang")
    b = table(spark, d, "benchmark").selectExpr(
        "concat('b', item_id) AS post_id", "'bench' AS source",
        "CASE WHEN item_id % 2 = 0 THEN 'api' END AS source_type", "'named' AS source_name",
    )
    return D.merge_bonus([a, b]).select("post_id", "source", "source_type", "source_name", "lang")


@query("latest_run", with_("social") + "SELECT post_id, sentiment_label FROM social")
def latest_run(spark, d):
    root = run_dir(spark, "runs")
    rows = social(spark, d).select("post_id", "sentiment_label")
    S.write_run(rows.limit(3), root, "scored", "20240101T000000Z")
    S.write_run(rows, root, "scored", "20240201T000000Z")
    S.write_run(rows.limit(5), root, "merged", "20240301T000000Z")
    return D.latest_run(spark, root).drop("kind", "run_ts")


@query("source_stats", with_("social") + """SELECT source, count(*) AS n_rows, strftime(min("timestamp"), '%Y-%m-%d %H') AS first_ts,
  strftime(max("timestamp"), '%Y-%m-%d %H') AS last_ts FROM social GROUP BY source""")
def source_stats(spark, d):
    s = D.source_stats(social(spark, d))
    return s.withColumns({c: F.date_format(c, "yyyy-MM-dd HH") for c in ("first_ts", "last_ts")})


_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query("first_rows", f"SELECT {', '.join(_KEY)} FROM lineitem ORDER BY {', '.join(_KEY)} LIMIT 5000")
def first_rows(spark, d):
    return D.first_rows(table(spark, d, "lineitem").select(*_KEY), 5000, _KEY)


@query("bucketed_tables", """SELECT o_orderkey, count(*) AS n_lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def bucketed_tables(spark, d):
    folder = run_dir(spark, "bucketed")
    names = {}
    for t, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        names[t] = f"{t}_{folder.rsplit('/', 1)[1].replace('-', '_')}"
        S.save_bucketed(table(spark, d, t), names[t], key, 8, f"{folder}/{t}")
    joined = spark.table(names["orders"]).join(spark.table(names["lineitem"]), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").cast("double").alias("quantity")
    )


@query("predictions_table", with_(*PREDICTIONS) + "SELECT id, y_true, y_pred, p_neu FROM predictions")
def predictions_table(spark, d):
    path = run_dir(spark, "predictions")
    S.write_result(predictions(spark, d), path)
    return spark.read.parquet(path).select("id", "y_true", "y_pred", F.get("proba", 1).alias("p_neu"))


@query("result_documents")
def result_documents(spark, d):
    from pulse.operators.series import activity
    from pulse.plans.series_queries import acts

    path = run_dir(spark, "documents")
    S.write_result(S.as_json(activity(acts(spark, d))), path, "json")
    return spark.read.json(path)


@query("loaded_tables", with_("raw_posts", "raw_users") + """, u AS (SELECT DISTINCT user_id FROM raw_users),
f AS (SELECT TRY_CAST(follower_count AS DOUBLE) AS n FROM raw_users QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ord) = 1)
SELECT 'users_primary_key' AS "check", 0::BIGINT AS violations UNION ALL SELECT 'posts_primary_key', 0
UNION ALL SELECT 'posts_user_foreign_key', (SELECT count(*) FROM (
  SELECT * FROM raw_posts QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY ord) = 1) WHERE user_id NOT IN (SELECT user_id FROM u))
UNION ALL SELECT 'followers_not_negative', (SELECT count(*) FROM f WHERE n < 0)
UNION ALL SELECT 'shares_not_negative', 0 UNION ALL SELECT 'comments_not_negative', 0""")
def loaded_tables(spark, d):
    from pulse.operators.cleaning import split_location

    u = split_location(P.clean_users(raw_users(spark, d)))
    return S.load_tables(u, P.clean_posts(raw_posts(spark, d)), run_dir(spark, "tables"))


@query("engagement_sql_view", with_("posts") + """SELECT platform, sum(likes + shares + comments) AS total FROM posts WHERE platform IS NOT NULL GROUP BY platform""")
def engagement_sql_view(spark, d):
    from pulse.plans.tables import posts

    S.create_engagement_view(posts(spark, d))
    return spark.sql("SELECT platform, sum(total_engagement) AS total FROM v_post_engagement WHERE platform IS NOT NULL GROUP BY platform")


@query("ingest_log", """SELECT 'run-1' AS run_ts, source, lang AS "query", count(*) AS "count", 'OK' AS status FROM documents GROUP BY ALL""")
def ingest_log(spark, d):
    return I.ingest_log(table(spark, d, "documents"), "run-1", query="lang")


# -- payloads ------------------------------------------------------------------------------


@query("search_hits", """
SELECT conv_id || '-' || turn AS post_id, t AS "text", 'https://news.ycombinator.com/item?id=' || conv_id || '-' || turn AS url,
  CASE WHEN turn % 4 = 3 THEN 0 ELSE turn * 2 END::DOUBLE AS engagement_metric, role AS query_used FROM (
  SELECT *, CASE WHEN turn % 3 = 0 THEN ' a / "q" ' || "text" WHEN turn % 3 = 1 THEN "text" ELSE 'title ' || role END AS t FROM conversations)""")
def search_hits(spark, d):
    payload = table(spark, d, "conversations").selectExpr(
        "role AS query",
        """to_json(struct(array(struct(
            concat(conv_id, '-', turn) AS objectID,
            CASE WHEN turn % 3 = 0 THEN concat('<p>a &#x2F; &quot;q&quot;</p>', text) ELSE '' END AS comment_text,
            CASE WHEN turn % 3 = 1 THEN text END AS story_text,
            concat('title ', role) AS title,
            CASE WHEN turn % 4 = 3 THEN NULL ELSE turn * 2 END AS points)) AS hits)) AS payload""",
    )
    out = Y.normalise_hits(payload)
    return out.select("post_id", "text", "url", "engagement_metric", "query_used")


@query("news_articles", """
SELECT url AS post_id, 'page ' || page_id AS "text", '2021-01-0' || (1 + page_id % 9) || 'T10:20:30Z' AS "timestamp", 0.0::DOUBLE AS engagement_metric,
  CASE WHEN page_id % 2 = 0 THEN 'English' ELSE 'French' END AS lang FROM pages""")
def news_articles(spark, d):
    payload = table(spark, d, "pages").selectExpr(
        "'q' AS query",
        """to_json(struct(array(struct(url, concat('page ', page_id) AS title,
            concat('2021010', 1 + page_id % 9, 'T102030Z') AS seendate,
            CASE WHEN page_id % 2 = 1 THEN 'French' END AS language)) AS articles)) AS payload""",
    )
    return Y.normalise_articles(payload).select("post_id", "text", "timestamp", "engagement_metric", "lang")


_STAMP = "TIMESTAMP '2020-10-01' + to_days(CAST(conv_id % 400 AS INTEGER))"


@query("store_reviews", f"""
SELECT 'r' || conv_id || '-' || turn AS post_id, "text", strftime({_STAMP}, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", turn::DOUBLE AS engagement_metric
FROM conversations WHERE {_STAMP} BETWEEN TIMESTAMP '2020-11-01' AND TIMESTAMP '2021-07-31'""")
def store_reviews(spark, d):
    payload = table(spark, d, "conversations").selectExpr(
        "'en' AS lang", "'in' AS country",
        """to_json(struct(concat('r', conv_id, '-', turn) AS reviewId, text AS content, turn AS thumbsUpCount, 4 AS score,
            date_format(date_add(DATE '2020-10-01', CAST(conv_id % 400 AS INT)), 'yyyy-MM-dd') AS at)) AS payload""",
    )
    out = Y.normalise_reviews(payload, "2020-11-01", "2021-07-31")
    return out.select("post_id", "text", "timestamp", "engagement_metric")


@query("forum_posts", f"""
SELECT 'f' || conv_id || '-' || turn AS post_id, 'T' || turn || ' ' || "text" AS "text", strftime({_STAMP}, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
  turn AS num_comments FROM conversations WHERE {_STAMP} BETWEEN TIMESTAMP '2020-11-01' AND TIMESTAMP '2021-07-31'""")
def forum_posts(spark, d):
    payload = table(spark, d, "conversations").selectExpr(
        "'q' AS query", "'news' AS forum",
        """to_json(struct(concat('f', conv_id, '-', turn) AS id, concat('T', turn) AS title, text AS selftext, 1 AS score,
            turn AS num_comments, '/p' AS permalink,
            unix_timestamp(CAST(date_add(DATE '2020-10-01', CAST(conv_id % 400 AS INT)) AS TIMESTAMP)) AS created_utc)) AS payload""",
    )
    out = Y.normalise_forum(payload, "2020-11-01", "2021-07-31")
    return out.select("post_id", "text", "timestamp", "num_comments")


_REVIEW = """reviews AS (SELECT "text", min(rating) AS engagement_metric, stamp FROM (
  SELECT "text", CAST(n_chars AS DOUBLE) AS rating, strftime(TIMESTAMP '2020-12-01' + to_days(CAST(doc_id % 300 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS stamp
  FROM documents WHERE (contains(lower("text"), 'the') OR contains(lower("text"), 'les'))
    AND doc_id % 300 BETWEEN 31 AND 242) GROUP BY "text", stamp)"""


@query("review_table", f"""WITH {_REVIEW}
SELECT 'review_' || substring(md5("text" || '|' || stamp), 1, 16) AS post_id, "text", stamp AS "timestamp", engagement_metric FROM reviews""")
def review_table(spark, d):
    raw = table(spark, d, "documents").selectExpr(
        "text AS review", "date_format(date_add(DATE '2020-12-01', CAST(doc_id % 300 AS INT)), 'yyyy-MM-dd') AS date",
        "CAST(n_chars AS STRING) AS rating",
    )
    out = Y.normalise_review_csv(raw, "store", "2021-01-01", "2021-07-31", ["the", "les"], max_rows=None)
    return out.drop("source")


# -- streams ------------------------------------------------------------------------------------

_EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def event_stream(spark, d, pattern="events.parquet", max_files=1000):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(_EVENTS)
    s = T.ingest_stream(spark, d, schema, pattern=pattern, max_files=max_files)
    return s.selectExpr(
        "event_id AS post_id", "CAST(ts AS TIMESTAMP) AS ts", "event_type", "CAST(floor(value * 10) AS DOUBLE) AS engagement_metric",
        "concat('p', CASE WHEN event_id % 33 = 32 THEN event_id - 1 ELSE event_id END) AS dup_id",
    )


def finished(spark, stream, name, **options):
    """Run a stream over what is there now and read its output."""
    folder = run_dir(spark, name)
    T.write_batches(stream, folder, **options).awaitTermination()
    return T.read_batches(spark, folder)


_CLOSED = "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM events)"


@query("stream_daily_activity", f"""SELECT strftime(b, '%Y-%m-%d') AS bucket, count(*) AS volume, sum(floor("value" * 10)) AS engagement_sum FROM (
  SELECT *, date_trunc('day', ts) AS b FROM events) WHERE b + INTERVAL 1 DAY <= {_CLOSED} GROUP BY b""")
def stream_daily_activity(spark, d):
    folder = run_dir(spark, "activity")
    T.window_batches(event_stream(spark, d), folder, T.activity_sums()).awaitTermination()
    out = T.closed_windows(spark, folder)
    return out.select(F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), "volume", "engagement_sum")


@query("stream_weekly_activity", f"""SELECT strftime(b, '%Y-%m-%d') AS bucket, count(*) AS volume, sum(floor("value" * 10)) AS engagement_sum FROM (
  SELECT *, date_trunc('day', ts) - to_days(CAST(k AS INTEGER)) AS b FROM events, generate_series(0, 6) t(k))
WHERE b + INTERVAL 7 DAY <= {_CLOSED} GROUP BY b""")
def stream_weekly_activity(spark, d):
    folder = run_dir(spark, "weekly")
    T.window_batches(event_stream(spark, d), folder, T.activity_sums(), "7 days", "1 day").awaitTermination()
    out = T.closed_windows(spark, folder)
    return out.select(F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), "volume", "engagement_sum")


_PARTS = """SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS b, CASE
  WHEN event_id % 3 = 0 AND ts < (SELECT date_trunc('day', min(ts)) FROM events) + INTERVAL 20 DAY THEN 0 WHEN event_id % 3 = 1 THEN 1 ELSE 2 END AS part FROM events"""


def in_parts(spark, d):
    """Events landing in three parts, the third with rows of all days."""
    events = table(spark, d, "events")
    first = F.date_trunc("day", events.select(F.min("ts")).scalar())
    early = F.col("ts") < first + F.expr("INTERVAL 20 DAY")
    part = F.when((F.col("event_id") % 3 == 0) & early, 0).when(F.col("event_id") % 3 == 1, 1).otherwise(2)
    for k in range(3):
        yield events.where(part == k)


@query("stream_late_rows", f"""WITH p AS ({_PARTS}), m AS (SELECT 0 AS part, NULL::TIMESTAMP AS w UNION ALL
  SELECT k, (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY FROM p WHERE part < k) FROM (VALUES (1), (2)) v(k)),
c AS (SELECT part, coalesce(b + INTERVAL 1 DAY <= w, false) AS late FROM p JOIN m USING (part))
SELECT part AS batch, count(*) AS n_read, count(*) FILTER (NOT late) AS n_counted, count(*) FILTER (late) AS n_late FROM c GROUP BY part""")
def stream_late_rows(spark, d):
    landed, folder = run_dir(spark, "landed"), run_dir(spark, "late")
    for rows in in_parts(spark, d):
        rows.write.mode("append").parquet(landed)
        T.window_batches(event_stream(spark, landed, "*.parquet"), folder, T.activity_sums()).awaitTermination()
    late = T.late_rows(spark, folder).groupBy("batch").agg(F.count(F.lit(1)).alias("n_late"))
    counts = T.batch_counts(spark, folder).select("batch", "n_read", "n_counted")
    return counts.join(late, "batch", "left").select("batch", "n_read", "n_counted", F.coalesce("n_late", F.lit(0)).alias("n_late"))


@query("stream_dedup", "SELECT DISTINCT 'p' || (CASE WHEN event_id % 33 = 32 THEN event_id - 1 ELSE event_id END) AS dup_id FROM events")
def stream_dedup(spark, d):
    # files out of event order, copies far apart: every third event lands last
    landed, folder = run_dir(spark, "landed"), run_dir(spark, "dedup")
    events = table(spark, d, "events")
    for part in (1, 2, 0):
        events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(landed)
        T.dedup_history(event_stream(spark, landed, "*.parquet"), folder, "dup_id").awaitTermination()
    return T.read_batches(spark, folder).select("dup_id")


@query("stream_enriched", "WITH " + f"""triggers AS (SELECT CAST(d AS DATE) + 1150 AS trigger_date, description FROM (VALUES {", ".join(f"('{a}', '{b}')" for a, b in TRIGGERS)}) t(d, description)),
near AS (SELECT event_id, description FROM events JOIN triggers ON abs(CAST(ts AS DATE) - trigger_date) <= 7
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY abs(CAST(ts AS DATE) - trigger_date), trigger_date) = 1)
SELECT event_id AS post_id, description FROM events LEFT JOIN near USING (event_id)""")
def stream_enriched(spark, d):
    moved = triggers(spark).withColumn("trigger_date", F.date_add("trigger_date", 1150))
    return finished(spark, T.enrich_stream(event_stream(spark, d), moved), "enriched").select("post_id", "description")


@query("stream_spikes", f"""WITH series AS (SELECT b AS bucket, count(*) AS volume, sum(floor("value" * 10)) AS engagement_sum FROM (
  SELECT *, date_trunc('day', ts) AS b FROM events) WHERE b + INTERVAL 1 DAY <= {_CLOSED} GROUP BY b),
vol AS ({_rolled_sql('series', 'volume', 'vol', '6 PRECEDING AND CURRENT ROW')})
SELECT strftime(bucket, '%Y-%m-%d') AS bucket, volume, round(vol_zscore, 6) + 0.0 AS vol_zscore, coalesce(vol_zscore > 2.0, false) AS is_spike FROM vol""")
def stream_spikes(spark, d):
    folder = run_dir(spark, "spikes")
    T.spike_stream(T.activity_stream(event_stream(spark, d)), folder).awaitTermination()
    out = T.read_batches(spark, folder)
    return out.select(F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), "volume", F.round("vol_zscore", 6).alias("vol_zscore"), "is_spike")


@query("stream_keyed_spikes", f"""WITH series AS (SELECT b AS bucket, event_type, count(*) AS volume FROM (
  SELECT *, date_trunc('day', ts) AS b FROM events) WHERE b + INTERVAL 1 DAY <= {_CLOSED} GROUP BY b, event_type),
vol AS (SELECT *, avg(volume) OVER w AS m, coalesce(stddev_samp(volume) OVER w, 0) AS s FROM series
  WINDOW w AS (PARTITION BY event_type ORDER BY bucket ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT strftime(bucket, '%Y-%m-%d') AS bucket, event_type, volume, round((volume - m) / (s + 1e-9), 6) + 0.0 AS vol_zscore,
  coalesce((volume - m) / (s + 1e-9) > 2.0, false) AS is_spike FROM vol""")
def stream_keyed_spikes(spark, d):
    folder = run_dir(spark, "keyed-spikes")
    T.spike_stream(T.activity_stream(event_stream(spark, d), by=["event_type"]), folder, by=["event_type"]).awaitTermination()
    out = T.read_batches(spark, folder)
    return out.select(F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), "event_type", "volume", F.round("vol_zscore", 6).alias("vol_zscore"), "is_spike")


def document_stream(spark, d):
    schema = table(spark, d, "documents").schema
    s = T.ingest_stream(spark, d, schema, pattern="documents.parquet")
    return s.selectExpr(
        "concat('d', doc_id) AS post_id", "text",
        "CAST(TIMESTAMP_NTZ '2020-11-01 00:00:00' + make_dt_interval(CAST(doc_id * 7 % 273 AS INT)) AS TIMESTAMP) AS ts",
        "CAST(doc_id % 3 AS DOUBLE) / 2 AS sentiment_numeric",
    )


@query("stream_sentiment", """WITH docs AS (SELECT TIMESTAMP '2020-11-01' + to_days(CAST(doc_id * 7 % 273 AS INTEGER)) AS ts, (doc_id % 3) / 2 AS s FROM documents)
SELECT strftime(b, '%Y-%m-%d') AS bucket, round(avg(s), 6) AS sentiment_mean, count(*) AS n FROM (
  SELECT *, ts - to_days(CAST(k AS INTEGER)) AS b FROM docs, generate_series(0, 6) t(k))
WHERE b + INTERVAL 7 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM docs) GROUP BY b""")
def stream_sentiment(spark, d):
    folder = run_dir(spark, "sentiment")
    T.window_batches(document_stream(spark, d), folder, T.sentiment_sums(), "7 days", "1 day").awaitTermination()
    mean = F.round(F.col("sentiment_sum") / F.col("n"), 6).alias("sentiment_mean")
    return T.closed_windows(spark, folder).select(F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), mean, "n")


@query("stream_scored")
def stream_scored(spark, d):
    model = fit_model(bayes(), stored(training(spark, d)))
    rows = document_stream(spark, d).select("post_id", "text")
    return finished(spark, T.score_stream(rows, model), "scored").drop("text")


@query("stream_ingest_log", """SELECT 'run-1' AS run_ts, 'events' AS source, count(*) AS "count", 'OK' AS status FROM events
UNION ALL SELECT 'run-1', 'documents', count(*), 'OK' FROM documents UNION ALL SELECT 'run-1', 'nothing', 0, 'EMPTY'
UNION ALL SELECT 'run-1', 'broken', 0, 'ERROR' UNION ALL SELECT 'run-1', 'off', 0, 'SKIP'
UNION ALL SELECT 'run-2', s, 0, t FROM (VALUES ('events', 'EMPTY'), ('documents', 'EMPTY'), ('nothing', 'EMPTY'), ('broken', 'ERROR'), ('off', 'SKIP')) v(s, t)""")
def stream_ingest_log(spark, d):
    def broken():
        return T.ingest_stream(spark, f"{d}/absent", table(spark, d, "pages").schema)

    sources = {
        "events": lambda: event_stream(spark, d),
        "documents": lambda: document_stream(spark, d),
        "nothing": lambda: T.ingest_stream(spark, d, table(spark, d, "pages").schema, pattern="no_such_file.parquet"),
        "broken": broken,
        "off": None,
    }
    folder, log = run_dir(spark, "ingest"), run_dir(spark, "ingest-log")
    for run in ("run-1", "run-2"):  # the second finds nothing new
        T.isolated_ingest(spark, sources, folder, run, log_path=log)
    return spark.read.parquet(log)
