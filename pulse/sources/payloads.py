"""Payload normalisers: API responses to unified social records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.functions.times import iso
from pulse.functions.values import to_double
from pulse.operators.cleaning import in_window, keyword_filter
from pulse.operators.ranking import seeded_sample

HITS = (
    "struct<hits:array<struct<objectID:string,comment_text:string,story_text:string,"
    "title:string,created_at:string,points:double>>>"
)
ARTICLES = "struct<articles:array<struct<url:string,title:string,seendate:string,sourcecountry:string,language:string>>>"
REVIEW = "struct<reviewId:string,content:string,at:string,thumbsUpCount:double,score:double>"
FORUM = (
    "struct<id:string,title:string,selftext:string,created_utc:double,score:double,"
    "num_comments:bigint,permalink:string>"
)
SCRAPED = "bonus_live_scraped"


def _filled(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col != "", col)


def normalise_hits(df: DataFrame, payload: str = "payload", query: str = "query") -> DataFrame:
    """Search hits: the first text there is, light markup removed."""
    hits = df.select(F.col(query).alias("query_used"), F.explode(F.from_json(payload, HITS)["hits"]).alias("h"))
    text = F.coalesce(_filled("h.comment_text"), _filled("h.story_text"), _filled("h.title"), F.lit(""))
    # fixed values: markup this source returns, and what replaces it
    for mark, plain in [("<p>", " "), ("</p>", " "), ("&#x2F;", "/"), ("&quot;", '"')]:
        text = F.replace(text, F.lit(mark), F.lit(plain))
    out = hits.select(
        F.coalesce(F.col("h.objectID"), F.lit("")).alias("post_id"),
        F.lit("hacker_news").alias("source"),
        F.lit(SCRAPED).alias("source_type"),
        F.lit("hacker_news").alias("source_name"),
        text.alias("text"),
        F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("h.objectID")).alias("url"),
        F.coalesce(F.col("h.created_at"), F.lit("")).alias("timestamp"),
        F.coalesce(F.col("h.points"), F.lit(0.0)).alias("engagement_metric"),
        F.lit("Global").alias("country"),
        F.lit("en").alias("lang"),
        "query_used",
    )
    return out.where(F.trim("text") != "")


def normalise_articles(df: DataFrame, payload: str = "payload", query: str = "query") -> DataFrame:
    """News articles; the address is the id and there is no engagement."""
    rows = df.select(F.col(query).alias("query_used"), F.explode(F.from_json(payload, ARTICLES)["articles"]).alias("a"))
    seen = F.try_to_timestamp(F.col("a.seendate"), F.lit("yyyyMMdd'T'HHmmss'Z'"))
    text = lambda c, default="": F.coalesce(F.col(c), F.lit(default))
    return rows.select(
        text("a.url").alias("post_id"),
        F.lit("gdelt").alias("source"),
        F.lit(SCRAPED).alias("source_type"),
        F.lit("gdelt").alias("source_name"),
        text("a.title").alias("text"),
        text("a.url").alias("url"),
        iso(seen).alias("timestamp"),
        F.lit(0.0).alias("engagement_metric"),
        text("a.sourcecountry").alias("country"),
        text("a.language", "English").alias("lang"),
        "query_used",
    )


def normalise_reviews(
    df: DataFrame, start: str, end: str, payload: str = "payload", lang: str = "lang", country: str = "country"
) -> DataFrame:
    """Store reviews inside a date range closed at both ends."""
    rows = df.select(lang, country, F.from_json(payload, REVIEW).alias("r"))
    rows = rows.withColumn("at", F.col("r.at").try_cast("timestamp")).where(F.col("at").isNotNull())
    rows = in_window(rows, "at", start, end, end_inclusive_day=False)
    return rows.select(
        F.coalesce(F.col("r.reviewId"), F.lit("")).alias("post_id"),
        F.lit("google_play").alias("source"),
        F.lit(SCRAPED).alias("source_type"),
        F.lit("google_play").alias("source_name"),
        F.coalesce(F.col("r.content"), F.lit("")).alias("text"),
        iso("at").alias("timestamp"),
        F.coalesce(F.col("r.thumbsUpCount"), F.lit(0.0)).alias("engagement_metric"),
        F.coalesce(F.col("r.score"), F.lit(0.0)).alias("star_rating"),
        F.col(country).alias("country"),
        F.col(lang).alias("lang"),
        F.concat_ws("_", lang, country).alias("query_used"),
    )


def normalise_forum(
    df: DataFrame, start: str, end: str, payload: str = "payload", query: str = "query", forum: str = "forum"
) -> DataFrame:
    """Forum posts inside a date range: title and body as one text."""
    rows = df.select(F.col(query).alias("query_used"), F.col(forum).alias("subreddit"), F.from_json(payload, FORUM).alias("p"))
    rows = rows.withColumn("ts", F.timestamp_seconds("p.created_utc"))
    rows = in_window(rows, "ts", start, end, end_inclusive_day=False)
    out = rows.select(
        F.col("p.id").alias("post_id"),
        F.lit("reddit").alias("source"),
        F.trim(F.concat_ws(" ", "p.title", "p.selftext")).alias("text"),
        iso("ts").alias("timestamp"),
        F.coalesce(F.col("p.score"), F.lit(0.0)).alias("engagement_metric"),
        F.col("p.num_comments").alias("num_comments"),
        "subreddit",
        F.concat(F.lit("https://reddit.com"), F.col("p.permalink")).alias("url"),
        F.lit("").alias("country"),
        F.lit("en").alias("lang"),
        "query_used",
    )
    return out.where(F.col("text") != "")


def pick_column(df: DataFrame, names: list[str]) -> str | None:
    """The first of the names the table has."""
    return next((n for n in names if n in df.columns), None)


def normalise_review_csv(
    df: DataFrame,
    source: str,
    start: str,
    end: str,
    keywords: list[str],
    max_rows: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """A review table of unknown column names as social records.

    The id is a hash of the content, so it does not depend on row order;
    reviews alike in text and time are one record. The seeded sample caps the
    report only when ``max_rows`` is set.
    """
    text, date, rating = (pick_column(df, n) for n in (X.TEXT_COLUMNS, X.DATE_COLUMNS, X.SCORE_COLUMNS))
    if not text or not date:
        raise ValueError("no text or date column found")
    rows = df.select(
        F.col(text).alias("text"),
        F.col(date).try_cast("timestamp").alias("ts"),
        (to_double(F.col(rating).cast("string")) if rating else F.lit(1.0)).alias("engagement_metric"),
    ).where(F.col("ts").isNotNull())
    rows = keyword_filter(in_window(rows, "ts", start, end, end_inclusive_day=False), "text", keywords)
    stamp = iso("ts")
    rows = rows.withColumn(
        "post_id", F.concat(F.lit("review_"), F.substring(F.md5(F.concat_ws("|", "text", stamp)), 1, 16))
    )
    rows = rows.groupBy("post_id").agg(
        F.min(F.struct("text", "ts", "engagement_metric")).alias("r")
    ).select("post_id", "r.*")
    if max_rows:
        rows = seeded_sample(rows, "post_id", max_rows, seed)
    return rows.select(
        "post_id", F.lit(source).alias("source"), "text", stamp.alias("timestamp"), "engagement_metric"
    )
