"""Shuffle rows into shards with a Feistel permutation of global row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.llm.common import packed
from pulse.llm.registry import query, read

SLICE_BITS = 12
ROUNDS = 6
WALKS = 64


def number_rows(df: DataFrame, id_col: str, ties: list[str]) -> DataFrame:
    """Add ``_row`` (from 0) and ``_rows``: the place of each row in the order
    of the id's hash, then the id, then ``ties``; and the number of rows.

    The leading bits of the hash cut the order into slices of about equal
    size whatever the ids are, so no task numbers more than its slices. The
    offsets are one row per slice, at most ``2 ** SLICE_BITS``, which bounds
    the broadcast. The order does not depend on the cluster. Rows that agree
    in id and ties are the same to every output, so their order is free.
    """
    hashed = F.xxhash64(F.col(id_col))
    cut = F.shiftrightunsigned(hashed, 64 - SLICE_BITS)
    sizes = df.select(cut.alias("_slice")).groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(F.lit(0))
    ahead = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_slice", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"), F.sum("_n").over(whole).alias("_rows")
    )
    inside = Window.partitionBy("_slice").orderBy("_h", id_col, *ties)
    placed = df.withColumns({"_h": hashed, "_slice": cut}).withColumn("_place", F.row_number().over(inside))
    out = placed.join(F.broadcast(offsets), "_slice")
    return out.withColumn("_row", F.col("_ahead") + F.col("_place") - 1).drop("_h", "_slice", "_ahead", "_place")


def feistel(x: Column, a: Column, b: Column, seed: int) -> Column:
    """One pass of an alternating Feistel network on ``0 .. a * b - 1``.

    The number is split into a digit below ``a`` and one below ``b``; each
    round adds a keyed hash of one digit to the other, which can be undone,
    so the whole is a permutation.
    """
    state = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, b).alias("r"))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        left = F.when(even, F.pmod(s["l"] + F.pmod(F.xxhash64(s["r"], i, F.lit(seed)), a), a)).otherwise(s["l"])
        right = F.when(even, s["r"]).otherwise(F.pmod(s["r"] + F.pmod(F.xxhash64(s["l"], i, F.lit(seed)), b), b))
        return F.struct(left.alias("l"), right.alias("r"))

    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
    return F.aggregate(rounds, state, turn, lambda s: s["l"] * b + s["r"])


def permute(row: Column, rows: Column, seed: int) -> tuple[Column, Column]:
    """A seeded permutation of ``0 .. rows - 1``: the first pass, to be stored
    as ``_first``, and the place that a walk from there ends at.

    ``a * b`` exceeds ``rows`` by less than the root of ``rows``, and a walk
    along its cycle ends at the first number below ``rows``. Up to 4096 rows
    a walk has at most ``WALKS`` steps; beyond, each step goes on with a
    chance below 1/64, so ``WALKS`` steps always suffice.
    """
    a = F.ceil(F.sqrt(rows.cast("double"))).cast("long")
    b = F.ceil(rows / a).cast("long")
    first = feistel(row, a, b, seed)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)),
        F.col("_first"),
        lambda x, _: F.when(x < rows, x).otherwise(feistel(x, a, b, seed)),
    )
    return first, F.when(F.col("_first") < rows, F.col("_first")).otherwise(walk)


def shard_rows(
    df: DataFrame, id_col: str = "doc_id", ties: list[str] | None = None, shards: int = 24, seed: int = 8
) -> DataFrame:
    """All rows of ``df`` with ``law``, ``shard`` (int), ``slot`` (long) and
    ``grown_shard`` (always NULL: the law is ``rows``).

    Row number ``i`` goes to place ``p = permute(i)``, shard ``p % shards``
    and slot ``p / shards``: shard sizes differ by one at most and slots have
    no gap. A NULL id is numbered like any other id. Repeated rows get places
    of their own. Input columns with an output's name are replaced. An empty
    table gives no rows.
    """
    made = ["law", "shard", "slot", "grown_shard"]
    keys = {f"_tie{k}": c for k, c in enumerate(ties or [])}
    numbered = number_rows(packed(df, made, _id=id_col, **keys), "_id", list(keys))
    first, place = permute(F.col("_row"), F.col("_rows"), seed)
    return (
        numbered.withColumn("_first", first)
        .withColumn("_p", place)
        .select(
            "_in.*",
            F.lit("rows").alias("law"),
            F.pmod("_p", F.lit(shards)).cast("int").alias("shard"),
            F.floor(F.col("_p") / shards).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def sized(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``size`` (UTF-8 bytes plus 8) and ``text_crc32``; NULL counts as empty."""
    return df.withColumns(
        {
            "size": (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long"),
            "text_crc32": F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")),
        }
    )


@query("op8_sharding")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = sized(read(spark, folder, "documents", "doc_id", "text")).select("doc_id", "size", "text_crc32")
    return shard_rows(docs, ties=["text_crc32", "size"])
