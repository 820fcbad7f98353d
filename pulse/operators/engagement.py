"""Engagement: totals, roll-ups, rankings and growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.functions.times import month
from pulse.operators.ranking import quantiles, top_k, value_ranks
from pulse.session import stored

COMPONENTS = ["likes", "shares", "comments"]


def with_engagement(posts: DataFrame) -> DataFrame:
    """Total engagement, NULL when any part is NULL, and a flag for that."""
    missing = F.col("likes").isNull() | F.col("shares").isNull() | F.col("comments").isNull()
    return posts.withColumns(
        {
            "total_engagement": F.col("likes") + F.col("shares") + F.col("comments"),
            "has_null_component": missing.cast("int"),
        }
    )


def rated(posts: DataFrame) -> DataFrame:
    """Posts with a platform and likes that are not negative."""
    return posts.where(F.col("platform").isNotNull() & (F.col("likes") >= 0))


def join_users(posts: DataFrame, users: DataFrame, how: str = "inner") -> DataFrame:
    return posts.join(users, "user_id", how)


def lookup(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join to a dimension; Spark broadcasts it when its size allows."""
    return df.join(dim, key, "left")


def user_rollup(posts: DataFrame, users: DataFrame, approx: bool = False) -> DataFrame:
    """Per-user totals joined to the users, with the weighted score."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    agg = posts.groupBy("user_id").agg(
        F.count("post_id").alias("total_posts"),
        *[F.sum(c).alias(f"total_{c}") for c in COMPONENTS],
        F.avg("likes").alias("avg_likes"),
        distinct("platform").alias("platforms_used"),
    )
    zero = F.lit(0.0)
    score = (
        F.coalesce(F.col("avg_likes"), zero) * X.LIKES_WEIGHT
        + F.coalesce(F.col("total_shares").cast("double"), zero) * X.SHARES_WEIGHT
        + F.coalesce(F.col("total_comments").cast("double"), zero) * X.COMMENTS_WEIGHT
    )
    return users.join(agg, "user_id", "left").withColumn("engagement_score", score)


def platform_averages(posts: DataFrame) -> DataFrame:
    return (
        rated(with_engagement(posts))
        .groupBy("platform")
        .agg(
            F.count("post_id").alias("post_count"),
            *[F.round(F.avg(c), 2).alias(f"avg_{c}") for c in COMPONENTS],
            F.round(F.avg("total_engagement"), 2).alias("avg_total_engagement"),
        )
        .orderBy(F.desc("avg_total_engagement"), "platform")
    )


def platform_means(posts: DataFrame) -> DataFrame:
    """Mean of each component over every post of a platform."""
    return (
        posts.where(F.col("platform").isNotNull())
        .groupBy("platform")
        .agg(*[F.avg(c).alias(f"mean_{c}") for c in COMPONENTS])
    )


def location_engagement(posts: DataFrame, users: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` locations with most engagement.

    Posts are summed per user before the join, so the join sees one row
    per user however active that user is.
    """
    per_user = (
        with_engagement(posts)
        .where(F.col("likes") >= 0)
        .groupBy("user_id")
        .agg(
            F.count("post_id").alias("n"),
            F.sum("total_engagement").alias("s"),
            F.count("total_engagement").alias("known"),
        )
    )
    located = (
        join_users(per_user, users.select("user_id", "city", "country"))
        .groupBy("city", "country")
        .agg(F.sum("n").alias("post_count"), F.sum("s").alias("total_engagement"), F.sum("known").alias("_known"))
        .withColumn("avg_engagement_per_post", F.round(F.try_divide("total_engagement", "_known"), 2))
        .drop("_known")
    )
    return top_k(located, [F.desc_nulls_last("total_engagement"), F.col("city"), F.col("country")], k)


def threshold_diagnostic(posts: DataFrame, factor: float = 2.0) -> DataFrame:
    """Can any post reach ``factor`` times its platform's mean at all?"""
    return (
        rated(with_engagement(posts))
        .groupBy("platform")
        .agg(
            F.count(F.lit(1)).alias("n_posts"),
            F.avg("total_engagement").alias("_avg"),
            F.max("total_engagement").alias("max_engagement"),
        )
        .select(
            "platform",
            "n_posts",
            F.round("_avg", 1).alias("avg_engagement"),
            F.round(F.lit(factor) * F.col("_avg"), 1).alias("threshold"),
            "max_engagement",
            F.round(F.try_divide(F.col("max_engagement").cast("double"), F.col("_avg")), 3).alias("max_to_mean_ratio"),
        )
        .orderBy(F.desc("avg_engagement"), "platform")
    )


def _with_platform_mean(posts: DataFrame) -> DataFrame:
    """Each post beside its platform's mean: aggregate then join, because a
    window would put a whole platform into one task."""
    base = rated(with_engagement(posts))
    means = base.groupBy("platform").agg(F.avg("total_engagement").alias("platform_avg"))
    return base.join(stored(means), "platform")


def above_group_average(posts: DataFrame, factor: float = 2.0) -> DataFrame:
    """Posts at or above ``factor`` times their own platform's mean."""
    hit = _with_platform_mean(posts).where(F.col("total_engagement") >= F.lit(factor) * F.col("platform_avg"))
    return hit.select(
        "post_id", "platform", "total_engagement", F.round("platform_avg", 2).alias("platform_avg")
    ).orderBy("platform", F.desc("total_engagement"), "post_id")


def _at_least(posts: DataFrame, top: DataFrame) -> DataFrame:
    """Posts not below the smallest value listed for their platform. The rank
    grows with the value, so the rest cannot match and need not be moved."""
    lowest = top.groupBy("platform").agg(F.min("total_engagement").alias("lowest"))
    return posts.join(lowest, "platform").where(F.col("total_engagement") >= F.col("lowest")).drop("lowest")


def top_percentile(posts: DataFrame, p: float = 0.95) -> DataFrame:
    """Posts in the top share of their platform, by percent rank."""
    base = rated(with_engagement(posts))
    top = value_ranks(base, "total_engagement", ["platform"]).where(F.col("pct_rank") >= p)
    top = stored(top.select("platform", "total_engagement", "pct_rank"))
    hit = _at_least(base, top).join(top, ["platform", "total_engagement"])
    return hit.select(
        "post_id", "platform", "total_engagement", F.round("pct_rank", 4).alias("relative_rank")
    ).orderBy("platform", F.desc("total_engagement"), "post_id")


def relative_leaders(posts: DataFrame, p: float = 0.99) -> DataFrame:
    """Leaders of each platform with their ratio to the platform's mean."""
    base = rated(with_engagement(posts))
    ranks = value_ranks(base, "total_engagement", ["platform"])
    means = base.groupBy("platform").agg(F.avg("total_engagement").alias("platform_avg"))
    top = stored(ranks.where(F.col("pct_rank") >= p).join(means, "platform"))
    hit = _at_least(base.select("post_id", "platform", "total_engagement"), top).join(top, ["platform", "total_engagement"])
    return hit.select(
        "post_id",
        "platform",
        "total_engagement",
        F.round("platform_avg", 2).alias("platform_avg"),
        F.round(F.try_divide("total_engagement", "platform_avg"), 3).alias("ratio_to_platform_avg"),
        F.round(F.col("pct_rank") * 100, 2).alias("percentile_in_platform"),
    ).orderBy("platform", F.desc("ratio_to_platform_avg"), "post_id")


def monthly_engagement(posts: DataFrame, ts: str = "timestamp") -> DataFrame:
    return (
        rated(with_engagement(posts))
        .groupBy("platform", month(ts).alias("month"))
        .agg(F.sum("total_engagement").alias("monthly_engagement"))
    )


def growth(monthly: DataFrame) -> DataFrame:
    """Change against the previous month; runs on monthly rows only."""
    w = Window.partitionBy("platform").orderBy("month")
    now, prev = F.col("monthly_engagement"), F.col("prev_month_engagement")
    return (
        monthly.withColumn("prev_month_engagement", F.lag("monthly_engagement").over(w))
        .withColumn("mom_growth_pct", F.round(F.try_divide((now - prev) * 100.0, prev), 2))
        .orderBy("platform", "month")
    )


def _markup(text: Column) -> Column:
    return text.ilike("%&amp;%") | text.ilike("%<%>%")


def anomaly_type(posts: DataFrame, limit: int | None = 20) -> DataFrame:
    """Suspect posts with the first rule that fits each."""
    text = F.col("text_content")
    named = (
        F.when(F.col("likes") < 0, X.ANOMALY_NEGATIVE)
        .when(F.col("platform").isNull(), X.ANOMALY_PLATFORM)
        .when(_markup(text), X.ANOMALY_MARKUP)
        .otherwise(X.ANOMALY_OTHER)
    )
    suspect = (F.col("likes") < 0) | F.col("platform").isNull() | _markup(text)
    out = posts.where(suspect).select("post_id", named.alias("anomaly_type"))
    return out.orderBy("post_id").limit(limit) if limit else out


def kpis(users: DataFrame, posts: DataFrame) -> DataFrame:
    """One row of headline figures."""
    per_user = posts.groupBy("user_id").agg(F.count(F.lit(1)).alias("posts_per_user"))
    active = (
        users.join(per_user, "user_id", "left")
        .agg(F.avg((F.coalesce("posts_per_user", F.lit(0)) > 0).cast("double")).alias("active_rate"))
        .scalar()
    )
    mid = {"median": 0.5}
    post_stats = per_user.agg(
        F.sum("posts_per_user").alias("posts"), F.avg("posts_per_user").alias("avg_posts_per_user")
    )
    return users.agg(F.count(F.lit(1)).alias("users"), F.avg("follower_count").alias("avg_followers")).select(
        "users",
        post_stats.select("posts").scalar().alias("posts"),
        active.alias("active_rate"),
        post_stats.select("avg_posts_per_user").scalar().alias("avg_posts_per_user"),
        quantiles(per_user, ["posts_per_user"], mid).select("median").scalar().alias("median_posts_per_user"),
        "avg_followers",
        quantiles(users, ["follower_count"], mid).select("median").scalar().alias("median_followers"),
    )
