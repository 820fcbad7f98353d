"""Sinks: result files, runs, tables with constraints, append logs."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.operators.engagement import with_engagement
from pulse.operators.integrity import integrity_report


def write_result(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace a result; nested columns go to JSON or Parquet."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(header=True, escape='"', **keep).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def as_json(df: DataFrame) -> DataFrame:
    """One JSON document per row."""
    return df.select(F.to_json(F.struct("*")).alias("document"))


def write_run(df: DataFrame, folder: str, kind: str, run_ts: str) -> None:
    """Store rows as one run, read back by ``latest_run``."""
    df.write.mode("overwrite").parquet(f"{folder}/kind={kind}/run_ts={run_ts}")


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Add one run's rows to a log, under the run's own key: a run that is
    repeated replaces its rows, and no other run is read or rewritten."""
    df.write.mode("overwrite").parquet(f"{path}/run_id={quote(run_id, safe='')}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs of a log with their ``run_id``, as text whatever it looks like."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField("run_id", T.StringType()) if f.name == "run_id" else f for f in found]
    return spark.read.schema(T.StructType(fields)).parquet(path)


USER_COLUMNS = [
    "user_id", "city", "country", "language", "account_created", "follower_count",
    "location_was_null", "language_was_null", "account_created_was_null",
]
POST_COLUMNS = [
    "post_id", "user_id", "platform", "text_content", "timestamp", "likes", "shares", "comments", "platform_was_null",
]


def load_tables(users: DataFrame, posts: DataFrame, folder: str, buckets: int | None = None) -> DataFrame:
    """Write users and posts in table order and report broken constraints.

    Posts are clustered by user within files of one platform, so filters on
    the platform skip files and Parquet statistics narrow the user. The number
    of files of a platform follows the shuffle width unless ``buckets`` is set.
    """
    spark = users.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    u, p = users.select(*USER_COLUMNS), posts.select(*POST_COLUMNS)
    u.write.mode("overwrite").parquet(f"{folder}/users")
    # one platform may hold most rows: the user id spreads it over many files
    spread = p.repartition("platform", F.pmod(F.xxhash64("user_id"), F.lit(buckets)))
    spread.sortWithinPartitions("platform", "user_id").write.mode("overwrite").partitionBy("platform").parquet(
        f"{folder}/posts"
    )
    return integrity_report(spark.read.parquet(f"{folder}/users"), spark.read.parquet(f"{folder}/posts"))


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int = 64, path: str | None = None) -> None:
    """A catalog table bucketed on a key, for joins without a shuffle."""
    writer = df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def create_engagement_view(posts: DataFrame, name: str = "v_post_engagement") -> None:
    """The engagement view under a name SQL can use."""
    with_engagement(posts).createOrReplaceTempView(name)
