"""The driver tables seen as users, posts, labelled text and predictions.

The tables hold no corruption of their own, so views meant for cleaning
inject it with rules on the key. Each view exists twice, as a DataFrame and
as a SQL common table expression with the same rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.functions import fixed as X


# Tables whose rows are costly to work on, with their key.
_HEAVY = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table. A text table in fewer splits than there are cores is
    spread over them; one of many splits, as on a cluster, is left alone."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in _HEAVY and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, _HEAVY[name])
    return df


CTE: dict[str, str] = {}


def with_(*names: str) -> str:
    """``WITH`` clause for the named views."""
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in names) + "\n"


def quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


# -- posts and users -------------------------------------------------------

CTE["posts"] = r"""
SELECT 'p' || event_id AS post_id, 'u' || user_id AS user_id,
  CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_type = 'view' THEN 'YouTube'
       WHEN event_type = 'signup' THEN 'Facebook' WHEN event_type = 'error' THEN 'Twitter'
       WHEN event_type = 'purchase' THEN 'Reddit' ELSE 'Instagram' END AS platform,
  CASE WHEN event_id % 3 = 0 THEN '<p>Post about #' || event_type || ' &amp; #topic' || (event_id % 7) || '</p>'
       ELSE 'plain note on ' || event_type || ' by @user' || user_id END AS text_content,
  ts AS "timestamp",
  CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 23 = 0 THEN -floor(value * 10)
       ELSE floor(value * 10) END AS likes,
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(regexp_extract(props, '(\d+)', 1) AS BIGINT) END AS shares,
  CAST(event_id % 97 AS BIGINT) AS comments
FROM events"""


def posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "concat('p', event_id) AS post_id",
        "concat('u', user_id) AS user_id",
        """CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_type = 'view' THEN 'YouTube'
           WHEN event_type = 'signup' THEN 'Facebook' WHEN event_type = 'error' THEN 'Twitter'
           WHEN event_type = 'purchase' THEN 'Reddit' ELSE 'Instagram' END AS platform""",
        """CASE WHEN event_id % 3 = 0 THEN concat('<p>Post about #', event_type, ' &amp; #topic', event_id % 7, '</p>')
           ELSE concat('plain note on ', event_type, ' by @user', user_id) END AS text_content""",
        "ts AS timestamp",
        """CAST(CASE WHEN event_id % 29 = 0 THEN NULL WHEN event_id % 23 = 0 THEN -floor(value * 10)
           ELSE floor(value * 10) END AS DOUBLE) AS likes""",
        r"CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(regexp_extract(props, '(\\d+)', 1) AS BIGINT) END AS shares",
        "event_id % 97 AS comments",
    )


CTE["users"] = """
SELECT 'u' || c_custkey AS user_id, n_name AS city, r_name AS country,
  lower(c_mktsegment) AS "language",
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE floor(c_acctbal) END AS follower_count
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def users(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")
    )
    return (
        table(spark, folder, "customer")
        .join(nations, F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "concat('u', c_custkey) AS user_id",
            "n_name AS city",
            "r_name AS country",
            "lower(c_mktsegment) AS language",
            "CAST(CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE floor(c_acctbal) END AS DOUBLE) AS follower_count",
        )
    )


CTE["trend_posts"] = """
SELECT 'o' || o_orderkey AS post_id, o_orderpriority AS platform, o_orderdate AS "timestamp",
  CASE WHEN o_orderkey % 31 = 0 THEN -1.0 ELSE floor(o_totalprice / 100) END AS likes,
  CAST(o_orderkey % 50 AS BIGINT) AS shares, CAST(o_custkey % 30 AS BIGINT) AS comments
FROM orders"""


def trend_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as posts over several years, one platform per priority."""
    return table(spark, folder, "orders").selectExpr(
        "concat('o', o_orderkey) AS post_id",
        "o_orderpriority AS platform",
        "o_orderdate AS timestamp",
        "CAST(CASE WHEN o_orderkey % 31 = 0 THEN -1.0 ELSE floor(o_totalprice / 100) END AS DOUBLE) AS likes",
        "o_orderkey % 50 AS shares",
        "o_custkey % 30 AS comments",
    )


# -- raw (corrupted, all-string) forms ---------------------------------------

CTE["raw_posts"] = r"""
SELECT event_id AS ord,
  'p' || (CASE WHEN event_id % 33 = 32 THEN event_id - 1 ELSE event_id END) AS post_id,
  'u' || user_id AS user_id,
  CASE WHEN event_id % 10 = 0 THEN 'NULL' WHEN event_id % 17 = 0 THEN '?' WHEN event_id % 19 = 0 THEN 'twitter'
       WHEN event_type = 'view' THEN 'YouTube' WHEN event_type = 'signup' THEN 'Facebook'
       WHEN event_type = 'error' THEN 'Twitter' WHEN event_type = 'purchase' THEN 'Reddit' ELSE 'Instagram' END AS platform,
  CASE WHEN event_id % 40 = 0 THEN '  ' WHEN event_id % 41 = 0 THEN 'unknown'
       ELSE ' <b>Caf' || chr(233) || '</b> &amp;  #' || event_type || '   @user' || user_id || ' https://x.example/' || event_id || ' ' END AS text_content,
  CASE WHEN event_id % 50 = 7 THEN 'sometime' WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
       WHEN event_id % 3 = 1 THEN CAST(CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS VARCHAR)
       ELSE strftime(ts, '%d-%m-%Y') END AS "timestamp",
  CASE WHEN event_id % 13 = 0 THEN 'n/a' WHEN event_id % 23 = 0 THEN '-5' WHEN event_id % 47 = 0 THEN 'many'
       ELSE CAST(CAST(floor(value * 10) AS BIGINT) AS VARCHAR) END AS likes,
  CASE WHEN event_id % 14 = 0 THEN '' ELSE regexp_extract(props, '(\d+)', 1) END AS shares,
  CASE WHEN event_id % 15 = 0 THEN 'NIL' ELSE CAST(event_id % 97 AS VARCHAR) END AS comments
FROM events"""


def raw_posts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id AS ord",
        "concat('p', CASE WHEN event_id % 33 = 32 THEN event_id - 1 ELSE event_id END) AS post_id",
        "concat('u', user_id) AS user_id",
        """CASE WHEN event_id % 10 = 0 THEN 'NULL' WHEN event_id % 17 = 0 THEN '?' WHEN event_id % 19 = 0 THEN 'twitter'
           WHEN event_type = 'view' THEN 'YouTube' WHEN event_type = 'signup' THEN 'Facebook'
           WHEN event_type = 'error' THEN 'Twitter' WHEN event_type = 'purchase' THEN 'Reddit'
           ELSE 'Instagram' END AS platform""",
        """CASE WHEN event_id % 40 = 0 THEN '  ' WHEN event_id % 41 = 0 THEN 'unknown'
           ELSE concat(' <b>Caf', chr(233), '</b> &amp;  #', event_type, '   @user', user_id,
                       ' https://x.example/', event_id, ' ') END AS text_content""",
        """CASE WHEN event_id % 50 = 7 THEN 'sometime'
           WHEN event_id % 3 = 0 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
           WHEN event_id % 3 = 1 THEN CAST(unix_timestamp(ts) AS STRING)
           ELSE date_format(ts, 'dd-MM-yyyy') END AS timestamp""",
        """CASE WHEN event_id % 13 = 0 THEN 'n/a' WHEN event_id % 23 = 0 THEN '-5' WHEN event_id % 47 = 0 THEN 'many'
           ELSE CAST(CAST(floor(value * 10) AS BIGINT) AS STRING) END AS likes""",
        r"CASE WHEN event_id % 14 = 0 THEN '' ELSE regexp_extract(props, '(\\d+)', 1) END AS shares",
        "CASE WHEN event_id % 15 = 0 THEN 'NIL' ELSE CAST(event_id % 97 AS STRING) END AS comments",
    )


CTE["raw_users"] = """
SELECT c_custkey AS ord,
  'u' || (CASE WHEN c_custkey % 21 = 20 THEN c_custkey - 1 ELSE c_custkey END) AS user_id,
  CASE WHEN c_custkey % 9 = 0 THEN 'unknown' WHEN c_custkey % 8 = 0 THEN ' ' || n_name || ' '
       WHEN c_custkey % 7 = 0 THEN n_name || ', ' || c_mktsegment || ', ' || r_name
       ELSE n_name || ', ' || r_name END AS "location",
  CASE WHEN c_custkey % 6 = 0 THEN '' ELSE ' ' || c_mktsegment || ' ' END AS "language",
  CASE WHEN c_custkey % 25 = 0 THEN 'tbd' WHEN c_custkey % 26 = 0 THEN 'soon'
       WHEN c_custkey % 3 = 0 THEN strftime(DATE '2020-01-01' + CAST(c_custkey % 900 AS INTEGER), '%Y-%m-%d')
       WHEN c_custkey % 3 = 1 THEN CAST(1577836800 + (c_custkey % 900) * 86400 AS VARCHAR)
       ELSE strftime(DATE '2020-01-01' + CAST(c_custkey % 900 AS INTEGER), '%d-%m-%Y') END AS account_created,
  CASE WHEN c_custkey % 12 = 0 THEN 'n/a' WHEN c_custkey % 35 = 0 THEN 'lots'
       ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS follower_count
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def raw_users(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")
    )
    day = "date_add(DATE '2020-01-01', CAST(c_custkey % 900 AS INT))"
    return (
        table(spark, folder, "customer")
        .join(nations, F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            "c_custkey AS ord",
            "concat('u', CASE WHEN c_custkey % 21 = 20 THEN c_custkey - 1 ELSE c_custkey END) AS user_id",
            """CASE WHEN c_custkey % 9 = 0 THEN 'unknown' WHEN c_custkey % 8 = 0 THEN concat(' ', n_name, ' ')
               WHEN c_custkey % 7 = 0 THEN concat(n_name, ', ', c_mktsegment, ', ', r_name)
               ELSE concat(n_name, ', ', r_name) END AS location""",
            "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE concat(' ', c_mktsegment, ' ') END AS language",
            f"""CASE WHEN c_custkey % 25 = 0 THEN 'tbd' WHEN c_custkey % 26 = 0 THEN 'soon'
               WHEN c_custkey % 3 = 0 THEN date_format({day}, 'yyyy-MM-dd')
               WHEN c_custkey % 3 = 1 THEN CAST(1577836800 + (c_custkey % 900) * 86400 AS STRING)
               ELSE date_format({day}, 'dd-MM-yyyy') END AS account_created""",
            """CASE WHEN c_custkey % 12 = 0 THEN 'n/a' WHEN c_custkey % 35 = 0 THEN 'lots'
               ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS STRING) END AS follower_count""",
        )
    )


# -- scored social record ------------------------------------------------------

CTE["social"] = """
SELECT 'd' || doc_id AS post_id, source, lang, "text",
  TIMESTAMP '2020-11-01 00:00:00' + to_days(CAST(doc_id * 7 % 273 AS INTEGER)) + to_hours(CAST(doc_id * 5 % 24 AS INTEGER)) AS "timestamp",
  CAST(n_chars AS DOUBLE) AS engagement_metric,
  CASE WHEN doc_id * 31 % 7 < 3 THEN 'Negative' WHEN doc_id * 31 % 7 < 5 THEN 'Neutral' ELSE 'Positive' END AS sentiment_label,
  CAST(doc_id * 13 % 41 AS DOUBLE) / 20 - 1 AS sentiment_score,
  CASE WHEN doc_id * 31 % 7 < 3 THEN 0.0::DOUBLE WHEN doc_id * 31 % 7 < 5 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS sentiment_numeric
FROM documents"""


def social(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as scored posts spread over nine months."""
    return table(spark, folder, "documents").selectExpr(
        "concat('d', doc_id) AS post_id",
        "source",
        "lang",
        "text",
        """TIMESTAMP_NTZ '2020-11-01 00:00:00' + make_dt_interval(CAST(doc_id * 7 % 273 AS INT), CAST(doc_id * 5 % 24 AS INT))
           AS timestamp""",
        "CAST(n_chars AS DOUBLE) AS engagement_metric",
        """CASE WHEN doc_id * 31 % 7 < 3 THEN 'Negative' WHEN doc_id * 31 % 7 < 5 THEN 'Neutral'
           ELSE 'Positive' END AS sentiment_label""",
        "CAST(doc_id * 13 % 41 AS DOUBLE) / 20 - 1 AS sentiment_score",
        """CASE WHEN doc_id * 31 % 7 < 3 THEN 0.0D WHEN doc_id * 31 % 7 < 5 THEN 0.5D
           ELSE 1.0D END AS sentiment_numeric""",
    )


# -- labelled text and predictions ----------------------------------------------

CTE["labelled"] = """
SELECT d.doc_id AS text_id, d."text" AS post_text, d.source AS topic_category,
  CASE WHEN toxic = 1 THEN 'Negative' WHEN quality = 0 THEN 'Neutral' ELSE 'Positive' END AS sentiment_label
FROM labels l JOIN documents d ON l.doc_id = d.doc_id"""


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "labels")
        .join(table(spark, folder, "documents"), "doc_id")
        .selectExpr(
            "doc_id AS text_id",
            "text AS post_text",
            "source AS topic_category",
            """CASE WHEN toxic = 1 THEN 'Negative' WHEN quality = 0 THEN 'Neutral'
               ELSE 'Positive' END AS sentiment_label""",
        )
    )


# Three positive weights per row, pulled towards the true class, as shares.
CTE["weights"] = """
SELECT *, CAST(1 + text_id * 7919 % 101 + CASE WHEN sentiment_label = 'Negative' THEN 60 ELSE 0 END AS DOUBLE) AS a,
  CAST(1 + text_id * 104729 % 97 + CASE WHEN sentiment_label = 'Neutral' THEN 60 ELSE 0 END AS DOUBLE) AS b,
  CAST(1 + text_id * 1299709 % 89 + CASE WHEN sentiment_label = 'Positive' THEN 60 ELSE 0 END AS DOUBLE) AS c
FROM labelled"""

CTE["predictions"] = """
SELECT text_id AS id, sentiment_label AS y_true,
  CASE WHEN a >= b AND a >= c THEN 'Negative' WHEN b >= c THEN 'Neutral' ELSE 'Positive' END AS y_pred,
  CASE WHEN b >= a AND b >= c THEN 'Neutral' WHEN a >= c THEN 'Negative' ELSE 'Positive' END AS y_other,
  a / (a + b + c) AS p_neg, b / (a + b + c) AS p_neu, c / (a + b + c) AS p_pos,
  post_text AS "text", topic_category AS topic
FROM weights"""


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    weights = labelled(spark, folder).selectExpr(
        "*",
        "CAST(1 + text_id * 7919 % 101 + CASE WHEN sentiment_label = 'Negative' THEN 60 ELSE 0 END AS DOUBLE) AS a",
        "CAST(1 + text_id * 104729 % 97 + CASE WHEN sentiment_label = 'Neutral' THEN 60 ELSE 0 END AS DOUBLE) AS b",
        "CAST(1 + text_id * 1299709 % 89 + CASE WHEN sentiment_label = 'Positive' THEN 60 ELSE 0 END AS DOUBLE) AS c",
    )
    return weights.selectExpr(
        "text_id AS id",
        "sentiment_label AS y_true",
        "CASE WHEN a >= b AND a >= c THEN 'Negative' WHEN b >= c THEN 'Neutral' ELSE 'Positive' END AS y_pred",
        "CASE WHEN b >= a AND b >= c THEN 'Neutral' WHEN a >= c THEN 'Negative' ELSE 'Positive' END AS y_other",
        "array(a / (a + b + c), b / (a + b + c), c / (a + b + c)) AS proba",
        "post_text AS text",
        "topic_category AS topic",
    )


PREDICTIONS = ("labelled", "weights", "predictions")

LABELS_SQL = "(VALUES " + ", ".join(f"('{v}')" for v in X.LABELS) + ")"
