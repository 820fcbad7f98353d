"""Seeded splits and folds, exact per class and without hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.operators.ranking import number_by_hash


def stratified_split(
    df: DataFrame, label: str, id_col: str, fractions: dict[str, float], seed: int = 42
) -> DataFrame:
    """Add ``split``: within each class the rows are put in seeded hash order
    and cut at the rounded cumulative shares, so splits never overlap."""
    numbered = number_by_hash(df, id_col, [label], seed)
    names = list(fractions)
    split: Column = F.lit(names[-1])
    done = sum(fractions.values()) - fractions[names[-1]]
    for name in reversed(names[:-1]):
        split = F.when(F.col("row_no") <= F.round(F.col("group_n") * F.lit(done)), F.lit(name)).otherwise(split)
        done -= fractions[name]
    return numbered.withColumn("split", split).drop("row_no", "group_n")


def assign_folds(df: DataFrame, label: str, id_col: str, k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Add a fold number 0..k-1, balanced within each class."""
    numbered = number_by_hash(df, id_col, [label], seed)
    return numbered.withColumn(name, ((F.col("row_no") - 1) % k).cast("int")).drop("row_no", "group_n")


def halves(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    """Add ``half`` 0 or 1: the first half of the seeded order is 0."""
    flat = number_by_hash(df.withColumn("_all", F.lit(1)), id_col, ["_all"], seed)
    return flat.withColumn("half", (F.col("row_no") > F.floor(F.col("group_n") / 2)).cast("int")).drop(
        "_all", "row_no", "group_n"
    )
