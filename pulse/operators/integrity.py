"""Integrity metrics, constraint reports and change logs as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stack(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def common_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def _metrics(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    one = df.agg(*[c.cast("long").alias(n) for n, c in metrics.items()])
    return one.unpivot([], list(metrics), "metric", "value")


def validation_metrics(users: DataFrame, posts: DataFrame) -> DataFrame:
    """Load checks, one pass per table."""

    def extra(c: str) -> Column:
        return F.count(c) - F.count_distinct(c)

    rows = F.count(F.lit(1))
    return stack(
        _metrics(users, {"users_count": rows, "duplicate_users": extra("user_id")}),
        _metrics(
            posts,
            {
                "posts_count": rows,
                "duplicate_posts": extra("post_id"),
                "null_platforms": F.count_if(F.col("platform").isNull()),
                "negative_likes": F.count_if(F.col("likes") < 0),
                "max_shares": F.max("shares"),
                "min_shares": F.min("shares"),
            },
        ),
    )


def _repeated(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def integrity_report(users: DataFrame, posts: DataFrame) -> DataFrame:
    """Broken rows per constraint; orphans are counted per user id first."""
    authors = posts.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    orphans = authors.join(users.select("user_id"), "user_id", "left_anti")

    def row(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(F.coalesce(value, F.lit(0)).cast("long").alias("violations")).select(
            F.lit(name).alias("check"), "violations"
        )

    return stack(
        row("users_primary_key", _repeated(users, "user_id"), F.count(F.lit(1))),
        row("posts_primary_key", _repeated(posts, "post_id"), F.count(F.lit(1))),
        row("posts_user_foreign_key", orphans, F.sum("n")),
        row("followers_not_negative", users, F.count_if(F.col("follower_count") < 0)),
        row("shares_not_negative", posts, F.count_if(F.col("shares") < 0)),
        row("comments_not_negative", posts, F.count_if(F.col("comments") < 0)),
    )


LOG_COLUMNS = ["stage", "column", "method", "rows_affected", "detail"]


def change_log(df: DataFrame, rules: list[tuple[str, str, str, Column, str]]) -> DataFrame:
    """Log rows ``(stage, column, method, rows_affected, detail)``.

    ``rules`` hold ``(stage, column, method, condition, detail)``; all of
    them are counted in one pass. ``%d`` in a detail becomes the count.
    """
    one = df.agg(F.array(*[F.count_if(cond) for _, _, _, cond, _ in rules]).alias("n"))
    names = F.array(
        *[
            F.struct(F.lit(s).alias("stage"), F.lit(c).alias("column"), F.lit(m).alias("method"), F.lit(d).alias("detail"))
            for s, c, m, _, d in rules
        ]
    )
    rows = one.select(F.explode(F.arrays_zip(names.alias("r"), F.col("n"))).alias("z"))
    return rows.select(
        "z.r.stage",
        "z.r.column",
        "z.r.method",
        F.col("z.n").alias("rows_affected"),
        F.replace(F.col("z.r.detail"), F.lit("%d"), F.col("z.n").cast("string")).alias("detail"),
    )


def ingest_log(df: DataFrame, run_ts: str, source: str = "source", query: str = "query_used") -> DataFrame:
    """Collected rows per source and query with an ``OK`` status."""
    return df.groupBy(F.col(source).alias("source"), F.col(query).alias("query")).agg(
        F.count(F.lit(1)).alias("count")
    ).select(F.lit(run_ts).alias("run_ts"), "source", "query", "count", F.lit("OK").alias("status"))
