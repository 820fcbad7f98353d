"""Exact ranks, running totals, quantiles and top-k on groups of any size.

A window over one group runs in one task. Where a group can hold a large
share of all rows, the group is first cut into value-ordered slices; only
one total per slice is summed up across slices, and a window runs inside
each slice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions.values import stable_hash
from pulse.session import slices

HASH_BITS = 60
HASH_SLICE_BITS = 12


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys; keeps the left key columns."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def _value_slices(df: DataFrame, order: str, values: list[str], by: list[str], few: bool) -> DataFrame:
    """Add ``_slice`` and the group's totals. Both come from one aggregate, so
    every branch reads the same columns of ``df`` and its shuffle is reused."""
    n = slices(df.sparkSession)
    marks = F.percentile_approx(order, [i / n for i in range(1, n)], F.lit(10 * n)).alias("_cuts")
    facts = [marks, *[F.sum(v).alias(f"{v}_total") for v in values]]
    if by:
        groups = df.groupBy(*by).agg(*facts)
        cut = join_on(df, F.broadcast(groups) if few else groups, by)
    else:
        one = df.agg(*facts).select(F.struct("*")).scalar()
        cut = df.withColumn("_one", one).select("*", "_one.*").drop("_one")
    return cut.withColumn("_slice", F.size(F.filter("_cuts", lambda m: m < F.col(order)))).drop("_cuts")


def running_totals(
    df: DataFrame, order: str, values: list[str], by: list[str] | None = None, few_groups: bool = False
) -> DataFrame:
    """Add ``{v}_before`` and ``{v}_total``: the sum over smaller ``order``
    values of the group, and over the whole group.

    ``few_groups`` says that the groups are listed in the code, such as column
    names or class labels, so that one row for each may be broadcast.

    ``df`` holds one row for each ``(by, order)``, as after a ``groupBy``, so
    equal values cannot pile up in one slice.
    """
    by = list(by or [])
    cut = _value_slices(df, order, values, by, few_groups)
    keys = [*by, "_slice"]
    sums = cut.groupBy(*keys).agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    ahead = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, *[F.coalesce(F.sum(f"_s_{v}").over(ahead), F.lit(0)).alias(f"_a_{v}") for v in values])
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    out = join_on(cut, sums, keys)
    for v in values:
        local = F.coalesce(F.sum(v).over(inside), F.lit(0))
        out = out.withColumn(f"{v}_before", F.col(f"_a_{v}") + local)
    return out.drop("_slice", *[f"_a_{v}" for v in values])


def value_ranks(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """One row per distinct value of a group with its ``percent_rank``.

    NULLs rank first, as in SQL: they get no row but count as rows below.
    """
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    blanks = counts.groupBy(*by).agg(F.coalesce(F.sum(F.when(F.col(value).isNull(), F.col("n"))), F.lit(0)).alias("_blank"))
    ranked = join_on(running_totals(counts.where(F.col(value).isNotNull()), value, ["n"], by), blanks, by)
    below, rows = F.col("n_before") + F.col("_blank"), F.col("n_total") + F.col("_blank")
    share = F.when(rows > 1, below / (rows - 1)).otherwise(F.lit(0.0))
    return ranked.select(*by, value, "n", rows.alias("group_n"), share.alias("pct_rank"))


def melt(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """``(by, column, value)`` rows, numbers as double."""
    return df.select(*(by or []), *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(by or []), cols, "column", "value"
    )


def quantiles(
    df: DataFrame,
    cols: list[str],
    probs: dict[str, float],
    by: list[str] | None = None,
    approx: bool = False,
) -> DataFrame:
    """Interpolated quantiles, one row per ``(by, column)``.

    Exact: equal values are counted first and the positions are read off
    running totals, so no task holds a whole column. ``approx`` trades that
    shuffle for a sketch.
    """
    by = list(by or [])
    long = melt(df, cols, by).where(F.col("value").isNotNull())
    keys = [*by, "column"]
    if approx:
        return long.groupBy(*keys).agg(
            *[F.percentile_approx("value", p, F.lit(10000)).alias(name) for name, p in probs.items()],
            F.count("value").alias("n"),
        )
    counts = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    run = running_totals(counts, "value", ["n"], keys, few_groups=not by)

    def at(index: Column) -> Column:
        return F.max(F.when((F.col("n_before") <= index) & (index < F.col("n_before") + F.col("n")), F.col("value")))

    aggs = []
    for name, p in probs.items():
        pos = F.lit(p) * (F.col("n_total") - 1)
        aggs += [
            at(F.floor(pos)).alias(f"_lo_{name}"),
            at(F.ceil(pos)).alias(f"_hi_{name}"),
            F.max(pos - F.floor(pos)).alias(f"_w_{name}"),
        ]
    found = run.groupBy(*keys).agg(*aggs, F.max("n_total").alias("n"))
    return found.select(
        *keys,
        *[
            (F.col(f"_lo_{q}") + (F.col(f"_hi_{q}") - F.col(f"_lo_{q}")) * F.col(f"_w_{q}")).alias(q)
            for q in probs
        ],
        "n",
    )


def number_by_hash(df: DataFrame, id_col: str, by: list[str], seed: int = 42) -> DataFrame:
    """Add ``row_no`` (1-based, in seeded hash order) and ``group_n``.

    The hash is uniform, so its leading bits are the slices: no group, however
    large, is numbered in one task.
    """
    keyed = df.withColumn("_h", stable_hash(id_col, seed))
    keyed = keyed.withColumn("_slice", F.shiftright("_h", HASH_BITS - HASH_SLICE_BITS))
    keys = [*by, "_slice"]
    sizes = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    ahead = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *keys,
        F.coalesce(F.sum("_c").over(ahead), F.lit(0)).alias("_a"),
        F.sum("_c").over(Window.partitionBy(*by)).alias("group_n"),
    )
    inside = Window.partitionBy(*keys).orderBy("_h", id_col)
    out = join_on(keyed, sizes, keys)
    return out.withColumn("row_no", F.row_number().over(inside) + F.col("_a")).drop("_h", "_slice", "_a")


def top_k(df: DataFrame, order: list[Column], k: int, by: list[str] | None = None) -> DataFrame:
    """The first ``k`` rows, overall or per group; ``order`` must be total.

    Spark keeps only ``k`` rows per group and task before the shuffle.
    """
    if not by:
        return df.orderBy(*order).limit(k)
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.where(F.col("_rn") <= k).drop("_rn")


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in an explicit order."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return top_k(df, cols, 1, keys)


def seeded_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in seeded hash order; the same rows on every run."""
    return df.orderBy(stable_hash(id_col, seed), F.col(id_col)).limit(n)
