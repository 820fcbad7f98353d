"""Profiles, distributions, correlations, outliers, missing patterns."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions.values import bin_index
from pulse.operators.ranking import quantiles, running_totals
from pulse.session import stored


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def value_counts(df: DataFrame, c: str, normalise: bool = False) -> DataFrame:
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    if normalise:
        counts = counts.withColumn("share", F.col("n") / df.agg(F.count(c)).scalar())
    return counts


def overview(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, NULLs and distinct values of each column.

    Distinct values are counted over 64-bit hashes, one row per column and
    value after the partial aggregate, so no cell is moved as it is; with
    ``approx`` a sketch counts them in one scan.
    """
    types = dict(df.dtypes)
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.struct(F.count(c).alias("filled"), (F.approx_count_distinct(c) if approx else F.lit(0)).alias("distinct")).alias(c) for c in df.columns],
    )
    rows = one.unpivot(["_rows"], df.columns, "column", "s")
    if approx:
        rows = rows.withColumn("unique", F.col("s.distinct"))
    else:
        hashes = df.select(*[F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias(c) for c in df.columns])
        long = hashes.unpivot([], df.columns, "column", "h").where(F.col("h").isNotNull())
        counts = long.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("unique"))
        rows = rows.join(counts, "column", "left").withColumn("unique", F.coalesce("unique", F.lit(0)))
    kinds = F.create_map(*[F.lit(v) for pair in types.items() for v in pair])
    nulls = F.col("_rows") - F.col("s.filled")
    return rows.select(
        "column",
        F.element_at(kinds, F.col("column")).alias("dtype"),
        nulls.alias("null_count"),
        F.round(F.try_divide(nulls * 100.0, F.col("_rows")), 2).alias("null_pct"),
        "unique",
    )


def describe(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of numeric columns."""
    cols = cols or numeric_columns(df)
    one = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    basic = one.unpivot([], cols, "column", "s").select("column", "s.*")
    mid = quantiles(df, cols, {"q1": 0.25, "median": 0.5, "q3": 0.75}, approx=approx).drop("n")
    return basic.join(mid, "column", "left")


def profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Overview and description of every column in one table."""
    return overview(df, approx).join(describe(df, approx=approx).drop("count"), "column", "left")


def compare_profiles(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two overviews side by side, by column name."""
    b = before.select("column", F.col("null_count").alias("nulls_before"), F.col("unique").alias("unique_before"))
    a = after.select("column", F.col("null_count").alias("nulls_after"), F.col("unique").alias("unique_after"))
    return b.join(a, "column", "full_outer").withColumn("nulls_removed", F.col("nulls_before") - F.col("nulls_after"))


def categorical(df: DataFrame, max_values: int = 20) -> DataFrame:
    """Value counts of the text columns with few distinct values.

    Columns a sketch puts far above the limit are dropped before anything is
    shuffled; the rest are counted exactly.
    """
    cols = text_columns(df)
    sketch = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    cols = [c for c in cols if sketch[c] <= 10 * max_values]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, n long")
    long = df.select(*cols).unpivot([], cols, "column", "value").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    small = counts.groupBy("column").agg(F.count(F.lit(1)).alias("d")).where(F.col("d") <= max_values)
    return counts.where(F.array_contains(small.agg(F.collect_list("column")).scalar(), F.col("column")))


def _pearson(a: str, b: str) -> Column:
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def correlations(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson's r for each pair of columns with more than two values.

    A column has more than two values when one lies strictly between its
    extremes. All pairs come from one pass; NULLs are dropped per pair.
    """
    cols = cols or numeric_columns(df)
    ends = df.agg(*[F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias(c) for c in cols])
    span = ends.select(F.struct(*cols)).scalar()
    one = df.agg(
        *[F.count_if((F.col(c) > span[c]["lo"]) & (F.col(c) < span[c]["hi"])).alias(f"mid_{c}") for c in cols],
        *[_pearson(a, b).alias(f"r_{i}") for i, (a, b) in enumerate(combinations(cols, 2))],
    )
    pairs = [
        F.struct(
            F.lit(a).alias("col_a"),
            F.lit(b).alias("col_b"),
            F.col(f"r_{i}").alias("r"),
            ((F.col(f"mid_{a}") > 0) & (F.col(f"mid_{b}") > 0)).alias("ok"),
        )
        for i, (a, b) in enumerate(combinations(cols, 2))
    ]
    return one.select(F.explode(F.array(*pairs)).alias("p")).where("p.ok").select("p.col_a", "p.col_b", "p.r")


def top_pairs(corr: DataFrame, k: int = 10) -> DataFrame:
    return corr.orderBy(F.desc_nulls_last(F.abs("r")), "col_a", "col_b").limit(k)


def most_correlated(corr: DataFrame, k: int = 4) -> DataFrame:
    """Columns by mean absolute correlation; the column itself counts as 0."""
    both = corr.select(F.col("col_a").alias("column"), "r").union(corr.select("col_b", "r"))
    means = both.groupBy("column").agg(
        (F.sum(F.abs("r")) / (F.count(F.lit(1)) + 1)).alias("mean_abs_r")
    )
    return means.orderBy(F.desc_nulls_last("mean_abs_r"), "column").limit(k)


def segment_medians(df: DataFrame, cats: list[str], nums: list[str]) -> DataFrame:
    """Median and count of each number within each category value."""
    long = df.select(*nums, *cats).unpivot(nums, cats, "segment", "category").where(F.col("category").isNotNull())
    return quantiles(long, nums, {"median": 0.5}, ["segment", "category"])


def histogram(df: DataFrame, value: Column, lo: float, hi: float, bins: int, by: list[str] | None = None) -> DataFrame:
    """Counts per equal-width bin, only bins that hold rows."""
    binned = df.withColumn("bin", bin_index(value, lo, hi, bins)).where(F.col("bin").isNotNull())
    return binned.groupBy(*(by or []), "bin").agg(F.count(F.lit(1)).alias("n"))


# Rank error of the sketch, as a share of the rows, is one in ACCURACY.
ACCURACY = 10_000


def _bracketed(probs: list[float], sketch: list[float], n: int) -> list[tuple[float, float]]:
    """For each quantile two values it lies between. The sketch was asked two
    errors to either side, so its answers are on the right side by one error,
    which is a row or more from ``2 * ACCURACY`` rows on; shorter columns are
    taken whole."""
    if n <= 2 * ACCURACY:
        return [(float("-inf"), float("inf"))] * len(probs)
    return [(sketch[2 * k], sketch[2 * k + 1]) for k in range(len(probs))]


def outliers(df: DataFrame, cols: list[str], k: float = 1.5, z: float = 3.0) -> DataFrame:
    """Rows beyond the quartile fences and beyond ``z`` deviations.

    Exact in two scans, and no column is shuffled. The first takes moments and
    a sketch that brackets the quartiles, which brackets the fences too. In
    the second, cells outside all brackets are only counted by where they lie;
    cells inside one are counted by value. Quartiles and counts are read off
    that table, whose rows follow the sketch's error and not the data.
    """
    probs, err = [0.25, 0.75], 2.0 / ACCURACY
    asked = [x for p in probs for x in (p - err, p + err)]
    numbers = {c: F.col(c).cast("double") for c in cols}
    facts = df.agg(
        *[
            F.struct(
                F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.count(v).alias("n"),
                F.percentile_approx(v, asked, F.lit(ACCURACY)).alias("sketch"),
            ).alias(c)
            for c, v in numbers.items()
        ]
    ).first()
    cells, bounds = [], []
    for c, v in numbers.items():
        one = facts[c]
        (l1, h1), (l3, h3) = _bracketed(probs, one["sketch"], one["n"])
        # Wide enough for the rounding of the fences' own formula.
        pad = 1e-9 * max(map(abs, (l1, h1, l3, h3)), default=0.0) if one["n"] > 2 * ACCURACY else 0.0
        low = (l1 * (1 + k) - k * h3 - pad, h1 * (1 + k) - k * l3 + pad)
        high = (l3 * (1 + k) - k * h1 - pad, h3 * (1 + k) - k * l1 + pad)
        spans = [low, (l1, h1), (l3, h3), high] if one["n"] > 2 * ACCURACY else [(l1, h1)] * 4
        inside = reduce(lambda x, y: x | y, [(v >= F.lit(a)) & (v <= F.lit(b)) for a, b in spans])
        over = sum((F.when(v > F.lit(b), 1 << i).otherwise(0) for i, (_, b) in enumerate(spans)), F.lit(0))
        far = F.coalesce(F.abs(F.try_divide(v - F.lit(one["mean"]), F.lit(one["std"]))) > z, F.lit(False))
        cells.append(
            F.struct(F.lit(c).alias("column"), F.when(inside, v).alias("value"), F.when(inside, -1).otherwise(over).alias("over"), far.alias("far"), v.isNotNull().alias("some"))
        )
        bounds.append((c, *(float(x) for s in spans[1:3] for x in s)))
    seen = df.select(F.explode(F.array(*cells)).alias("c")).where("c.some").select("c.*")
    counted = stored(seen.groupBy("column", "value", "over", "far").agg(F.count(F.lit(1)).alias("n")), "brackets")
    spark = df.sparkSession
    near = spark.createDataFrame(bounds, "column string, l1 double, h1 double, l3 double, h3 double")  # one row a column
    table = counted.join(F.broadcast(near), "column")
    quartile = {}
    for p, lo, hi, bit, name in ((0.25, "l1", "h1", 1, "q1"), (0.75, "l3", "h3", 2, "q3")):
        before = (F.col("value") < F.col(lo)) | ((F.col("over") >= 0) & (F.col("over").bitwiseAND(1 << bit) == 0))
        ahead = table.groupBy("column").agg(F.sum(F.when(before, F.col("n")).otherwise(0)).alias("ahead"), F.sum("n").alias("rows"))
        held = table.where(F.col("value").between(F.col(lo), F.col(hi))).groupBy("column", "value").agg(F.sum("n").alias("n"))
        run = running_totals(held, "value", ["n"], ["column"], few_groups=True).join(F.broadcast(ahead), "column")
        first, at = F.col("ahead") + F.col("n_before"), F.lit(p) * (F.col("rows") - 1)

        def value(index: Column, first=first) -> Column:
            return F.max(F.when((first <= index) & (index < first + F.col("n")), F.col("value")))

        ends = run.groupBy("column").agg(value(F.floor(at)).alias("lo"), value(F.ceil(at)).alias("hi"), F.max(at - F.floor(at)).alias("w"))
        quartile[name] = ends.select("column", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("w")).alias(name))
    fences = quartile["q1"].join(quartile["q3"], "column")
    reach = F.lit(k) * (F.col("q3") - F.col("q1"))
    below = F.when(F.col("over") < 0, F.col("value") < F.col("q1") - reach).otherwise(F.col("over") == 0)
    above = F.when(F.col("over") < 0, F.col("value") > F.col("q3") + reach).otherwise(F.col("over").bitwiseAND(8) > 0)
    rows = counted.join(F.broadcast(fences), "column").groupBy("column").agg(
        F.sum(F.when(below | above, F.col("n")).otherwise(0)).alias("iqr_outliers"),
        F.sum(F.when(F.col("far"), F.col("n")).otherwise(0)).alias("z_outliers"),
        F.sum("n").alias("total_non_null"),
    )
    rows = spark.createDataFrame([(c,) for c in cols], "column string").join(rows, "column", "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("iqr_outliers", "z_outliers", "total_non_null")]
    rows = rows.select("column", *counts)
    return rows.withColumn("iqr_pct", F.round(F.try_divide(F.col("iqr_outliers") * 100.0, F.col("total_non_null")), 2))


def null_patterns(df: DataFrame) -> DataFrame:
    """Which columns are NULL together: pattern (1 = NULL) and row count."""
    bits = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in df.columns])
    return df.select(bits.alias("pattern")).where(F.col("pattern").contains("1")).groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n")
    )


def verdict_share(df: DataFrame, c: str, good: list[str]) -> DataFrame:
    """Rows per verdict, and the share of the named verdicts in all rows."""
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("n_rows"),
        *[F.count_if(F.col(c) == v).alias(v) for v in good],
        (F.count_if(F.col(c).isin(good)) / total).alias("share"),
    )
