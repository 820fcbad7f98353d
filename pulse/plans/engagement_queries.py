"""Registered engagement queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.operators import engagement as E
from pulse.operators import ranking as R
from pulse.plans.registry import query
from pulse.plans.tables import CTE, posts, trend_posts, users, with_

CTE["engaged"] = """
SELECT *, likes + shares + comments AS total_engagement,
  CAST(likes IS NULL OR shares IS NULL OR comments IS NULL AS INTEGER) AS has_null_component
FROM posts"""
CTE["rated"] = "SELECT * FROM engaged WHERE platform IS NOT NULL AND likes >= 0"
_P = with_("posts", "engaged")
_R = with_("posts", "engaged", "rated")
_U = with_("posts", "engaged", "users")


@query("engagement_view", _P + """
SELECT post_id, platform, likes, shares, comments, total_engagement, has_null_component FROM engaged""")
def engagement_view(spark, d):
    return E.with_engagement(posts(spark, d)).select(
        "post_id", "platform", "likes", "shares", "comments", "total_engagement", "has_null_component"
    )


@query("platform_averages", _R + """
SELECT platform, count(post_id) AS post_count, round(avg(likes), 2) AS avg_likes,
  round(avg(shares), 2) AS avg_shares, round(avg(comments), 2) AS avg_comments,
  round(avg(total_engagement), 2) AS avg_total_engagement
FROM rated GROUP BY platform""")
def platform_averages(spark, d):
    return E.platform_averages(posts(spark, d))


@query("platform_means", _P + """
SELECT platform, avg(likes) AS mean_likes, avg(shares) AS mean_shares, avg(comments) AS mean_comments
FROM posts WHERE platform IS NOT NULL GROUP BY platform""")
def platform_means(spark, d):
    return E.platform_means(posts(spark, d))


@query("location_engagement", _U + """
SELECT city, country, count(post_id) AS post_count, sum(total_engagement) AS total_engagement,
  round(avg(total_engagement), 2) AS avg_engagement_per_post
FROM users JOIN engaged USING (user_id) WHERE likes >= 0
GROUP BY city, country ORDER BY total_engagement DESC NULLS LAST, city, country LIMIT 10""")
def location_engagement(spark, d):
    return E.location_engagement(posts(spark, d), users(spark, d))


@query("users_posts_join", _U + """
SELECT e.user_id, city, country, post_id, total_engagement FROM users u JOIN engaged e ON u.user_id = e.user_id""")
def users_posts_join(spark, d):
    joined = E.join_users(E.with_engagement(posts(spark, d)), users(spark, d))
    return joined.select("user_id", "city", "country", "post_id", "total_engagement")


@query("threshold_diagnostic", _R + """
SELECT platform, count(*) AS n_posts, round(avg(total_engagement), 1) AS avg_engagement,
  round(2 * avg(total_engagement), 1) AS threshold, max(total_engagement) AS max_engagement,
  round(max(total_engagement) / avg(total_engagement), 3) AS max_to_mean_ratio
FROM rated GROUP BY platform""")
def threshold_diagnostic(spark, d):
    return E.threshold_diagnostic(posts(spark, d))


@query("above_platform_average", _R + """
SELECT post_id, platform, total_engagement, round(a, 2) AS platform_avg FROM (
  SELECT *, avg(total_engagement) OVER (PARTITION BY platform) AS a FROM rated)
WHERE total_engagement >= 2 * a""")
def above_platform_average(spark, d):
    return E.above_group_average(posts(spark, d))


@query("top_five_percent", _R + """
SELECT post_id, platform, total_engagement, round(r, 4) AS relative_rank FROM (
  SELECT *, percent_rank() OVER (PARTITION BY platform ORDER BY total_engagement NULLS FIRST) AS r
  FROM rated) WHERE r >= 0.95""")
def top_five_percent(spark, d):
    return E.top_percentile(posts(spark, d), 0.95)


@query("relative_leaders", _R + """
SELECT post_id, platform, total_engagement, round(a, 2) AS platform_avg,
  round(total_engagement / a, 3) AS ratio_to_platform_avg, round(r * 100, 2) AS percentile_in_platform FROM (
  SELECT *, avg(total_engagement) OVER (PARTITION BY platform) AS a,
    percent_rank() OVER (PARTITION BY platform ORDER BY total_engagement NULLS FIRST) AS r
  FROM rated) WHERE r >= 0.99""")
def relative_leaders(spark, d):
    return E.relative_leaders(posts(spark, d))


CTE["trend_rated"] = """
SELECT platform, strftime("timestamp", '%Y-%m') AS "month", likes + shares + comments AS total_engagement
FROM trend_posts WHERE platform IS NOT NULL AND likes >= 0"""


@query("monthly_engagement", with_("trend_posts", "trend_rated") + """
SELECT platform, "month", sum(total_engagement) AS monthly_engagement FROM trend_rated GROUP BY ALL""")
def monthly_engagement(spark, d):
    return E.monthly_engagement(trend_posts(spark, d))


@query("monthly_growth", with_("trend_posts", "trend_rated") + """
SELECT platform, "month", monthly_engagement, prev_month_engagement,
  round((monthly_engagement - prev_month_engagement) * 100.0 / nullif(prev_month_engagement, 0), 2) AS mom_growth_pct
FROM (SELECT *, lag(monthly_engagement) OVER (PARTITION BY platform ORDER BY "month") AS prev_month_engagement
  FROM (SELECT platform, "month", sum(total_engagement) AS monthly_engagement FROM trend_rated GROUP BY ALL))""")
def monthly_growth(spark, d):
    return E.growth(E.monthly_engagement(trend_posts(spark, d)))


@query("anomalies", with_("posts") + f"""
SELECT post_id, CASE WHEN likes < 0 THEN '{X.ANOMALY_NEGATIVE}' WHEN platform IS NULL THEN '{X.ANOMALY_PLATFORM}'
  ELSE '{X.ANOMALY_MARKUP}' END AS anomaly_type
FROM posts WHERE likes < 0 OR platform IS NULL OR text_content ILIKE '%&amp;%' OR text_content ILIKE '%<%>%'
ORDER BY post_id LIMIT 20""")
def anomalies(spark, d):
    return E.anomaly_type(posts(spark, d))


@query("anomalies_all", with_("posts") + f"""
SELECT post_id, CASE WHEN likes < 0 THEN '{X.ANOMALY_NEGATIVE}' WHEN platform IS NULL THEN '{X.ANOMALY_PLATFORM}'
  ELSE '{X.ANOMALY_MARKUP}' END AS anomaly_type
FROM posts WHERE likes < 0 OR platform IS NULL OR text_content ILIKE '%&amp;%' OR text_content ILIKE '%<%>%'""")
def anomalies_all(spark, d):
    return E.anomaly_type(posts(spark, d), limit=None)


@query("user_rollup", with_("posts", "users") + """
SELECT u.*, total_posts, total_likes, total_shares, total_comments, avg_likes, platforms_used,
  coalesce(avg_likes, 0) * 0.5::DOUBLE + coalesce(total_shares, 0)::DOUBLE * 0.3::DOUBLE
    + coalesce(total_comments, 0)::DOUBLE * 0.2::DOUBLE AS engagement_score
FROM users u LEFT JOIN (
  SELECT user_id, count(post_id) AS total_posts, sum(likes) AS total_likes, sum(shares)::BIGINT AS total_shares,
    sum(comments)::BIGINT AS total_comments, avg(likes) AS avg_likes, count(DISTINCT platform) AS platforms_used
  FROM posts GROUP BY user_id) a ON u.user_id = a.user_id""")
def user_rollup(spark, d):
    return E.user_rollup(posts(spark, d), users(spark, d))


@query("user_rollup_approx")
def user_rollup_approx(spark, d):
    return E.user_rollup(posts(spark, d), users(spark, d), approx=True)


@query("kpis", with_("posts", "users") + """, per_user AS (SELECT user_id, count(*) AS n FROM posts GROUP BY user_id)
SELECT (SELECT count(*) FROM users) AS users, (SELECT count(*) FROM posts) AS posts,
  (SELECT avg(CAST(coalesce(n, 0) > 0 AS INTEGER)) FROM users LEFT JOIN per_user USING (user_id)) AS active_rate,
  (SELECT avg(n) FROM per_user) AS avg_posts_per_user, (SELECT median(n) FROM per_user) AS median_posts_per_user,
  (SELECT avg(follower_count) FROM users) AS avg_followers, (SELECT median(follower_count) FROM users) AS median_followers""")
def kpis(spark, d):
    return E.kpis(users(spark, d), posts(spark, d))


@query("sorted_posts", _P + """
SELECT post_id, platform, total_engagement FROM engaged ORDER BY platform NULLS FIRST, total_engagement DESC, post_id""")
def sorted_posts(spark, d):
    return (
        E.with_engagement(posts(spark, d))
        .select("post_id", "platform", "total_engagement")
        .orderBy("platform", F.desc("total_engagement"), "post_id")
    )


@query("top_posts", _P + """
SELECT post_id, platform, total_engagement FROM engaged ORDER BY total_engagement DESC NULLS LAST, post_id LIMIT 25""")
def top_posts(spark, d):
    e = E.with_engagement(posts(spark, d)).select("post_id", "platform", "total_engagement")
    return R.top_k(e, [F.desc_nulls_last("total_engagement"), F.col("post_id")], 25)


@query("top_posts_per_platform", _P + """
SELECT post_id, platform, total_engagement FROM engaged WHERE platform IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY platform ORDER BY total_engagement DESC NULLS LAST, post_id) <= 5""")
def top_posts_per_platform(spark, d):
    e = E.with_engagement(posts(spark, d)).where(F.col("platform").isNotNull())
    best = R.top_k(e, [F.desc_nulls_last("total_engagement"), F.col("post_id")], 5, ["platform"])
    return best.select("post_id", "platform", "total_engagement")


@query("label_lookup", with_("posts") + """
SELECT post_id, platform, CASE platform WHEN 'YouTube' THEN 'video' WHEN 'Instagram' THEN 'photo'
  WHEN 'Twitter' THEN 'text' END AS "kind" FROM posts""")
def label_lookup(spark, d):
    kinds = spark.createDataFrame(
        [("YouTube", "video"), ("Instagram", "photo"), ("Twitter", "text")], "platform string, kind string"
    )
    return E.lookup(posts(spark, d).select("post_id", "platform"), kinds, "platform")
