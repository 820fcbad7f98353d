"""Whole cleaning and monitoring pipelines, composed of operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.functions.text import clean_post, clean_social, strip
from pulse.functions.times import parse_mixed_ts, to_utc_iso
from pulse.functions.values import to_double
from pulse.operators import cleaning as C
from pulse.operators import integrity as I
from pulse.operators.ranking import keep_first


def clean_users(raw: DataFrame, order: str = "ord") -> DataFrame:
    """Users: placeholders, flags, median followers, dates, first per id."""
    df = C.replace_placeholders(raw)
    df = C.flag_nulls(df, ["location", "language", "account_created"])
    df = C.impute_median(df, ["follower_count"], text=True)
    df = df.withColumns(
        {
            "account_created": F.date_format(parse_mixed_ts("account_created"), "yyyy-MM-dd"),
            "follower_count": to_double("follower_count"),
            "language": F.lower(strip("language")),
            "location": strip("location"),
        }
    )
    return keep_first(df, ["user_id"], [order])


def clean_posts(raw: DataFrame, order: str = "ord") -> DataFrame:
    """Posts: placeholders, known platforms, text, time, median counts,
    first per id."""
    df = C.replace_placeholders(raw)
    df = C.validate_enum(df, "platform", X.PLATFORMS)
    df = df.withColumns(
        {
            "text_content": clean_post("text_content"),
            "timestamp": F.date_format(parse_mixed_ts("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"),
        }
    )
    df = C.impute_median(df, ["likes", "shares", "comments"])
    return keep_first(df, ["post_id"], [order])


def posts_change_log(raw: DataFrame) -> DataFrame:
    """What ``clean_posts`` changes, counted in one pass over the raw rows."""
    df = C.replace_placeholders(raw)
    valid = F.coalesce(F.col("platform").isin(X.PLATFORMS), F.lit(False))
    rules = [
        ("missing", "platform", "flag_invalid", ~valid, "Flagged %d invalid or missing platform values"),
        ("standardize", "text_content", "strip_html", clean_post("text_content").isNotNull(), "Cleaned %d texts"),
        ("standardize", "timestamp", "multi_format_parse", parse_mixed_ts("timestamp").isNotNull(), "Parsed %d timestamps"),
    ]
    for c in ("likes", "shares", "comments"):
        rules.append(("missing", c, "median_impute", to_double(c).isNull(), f"Imputed %d null {c}"))
    return I.change_log(df, rules)


def merge_social(raw: DataFrame, start: str, end: str, order: list | None = None) -> DataFrame:
    """Harmonised social records: cleaned text of at least ten characters,
    readable time inside the window, one row per id, numeric engagement."""
    df = raw.withColumns({"text": clean_social("text"), "timestamp": to_utc_iso("timestamp")})
    df = C.min_length(df, "text", 10).where(F.col("timestamp").isNotNull())
    df = df.withColumn("ts", F.col("timestamp").try_cast("timestamp"))
    df = C.in_window(df, "ts", start, end)
    df = keep_first(df, ["post_id"], order or ["ts", "source"])
    number = F.coalesce(to_double(F.col("engagement_metric").cast("string")), F.lit(0.0))
    return df.withColumn("engagement_metric", number)



def deep_clean(df: DataFrame, order: list[str]) -> DataFrame:
    """First row per id, no blank text, UTC time, conflict flag, folded
    source names, engagement not below zero, no column without values."""
    df = keep_first(df, ["post_id"], order)
    df = C.drop_blank(df, "text")
    df = df.withColumn("timestamp", to_utc_iso("timestamp"))
    if {"sentiment_label", "sentiment_score"} <= set(df.columns):
        df = df.withColumn("sentiment_score", to_double(F.col("sentiment_score").cast("string")))
        df = df.withColumn("sentiment_conflict", C.label_conflict())
    if "source_name" in df.columns:
        df = C.remap(df, "source_name", X.SOURCE_NAMES)
    return C.drop_all_null(C.clip_negative(df, "engagement_metric"))


def deep_clean_issues(df: DataFrame, order: list[str]) -> DataFrame:
    """Issue counts of ``deep_clean``, ``(issue, n_rows)``."""
    firsts = keep_first(df, ["post_id"], order)
    blank = F.col("text").isNull() | (strip("text") == "")
    score = to_double(F.col("sentiment_score").cast("string"))
    label = F.col("sentiment_label")
    conflict = ((label == "Positive") & (score < -0.3)) | ((label == "Negative") & (score > 0.5))
    number = to_double(F.col("engagement_metric").cast("string"))
    kept = ~blank
    one = firsts.agg(
        F.count_if(blank).alias("empty_text"),
        F.count_if(kept & to_utc_iso("timestamp").isNull()).alias("unparseable_timestamps"),
        F.count_if(kept & conflict).alias("sentiment_conflicts"),
        F.count_if(kept & F.col("source_name").isin(list(X.SOURCE_NAMES))).alias("source_names_folded"),
        F.count_if(kept & (number < 0)).alias("negative_engagement"),
    )
    issues = one.unpivot([], one.columns, "issue", "n_rows")
    dups = C.duplicate_count(df, ["post_id"]).select(
        F.lit("duplicate_post_id").alias("issue"), F.col("duplicates").alias("n_rows")
    )
    return I.stack(dups, issues)
