"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.session import stored


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked to its smallest one."""
    both = e.union(e.select("v", "u").toDF("u", "v"))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are linked to the smallest one."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.toDF("u", "v")).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(u, v)``: each linked vertex ``u`` but the smallest of its component,
    and that smallest vertex ``v``.

    A vertex with any number of links never meets them in one task: each
    step is a partial minimum and a join. The links of each round are written
    to the shared folder, so the lineage stays short and a lost executor
    costs a task; about log(longest path) rounds are needed. Only a count and
    a checksum of each round reach the driver.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    e = stored(links.select(u, v).where("u <> v").distinct(), "links")

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(e)
    while before[0]:
        e = stored(_small_star(_large_star(e)), "links")
        now = mark(e)
        if now == before:
            break
        before = now
    return e
