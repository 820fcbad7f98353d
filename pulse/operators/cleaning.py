"""Cleaning: placeholders, filters, validation, imputation, de-duplication."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions import fixed as X
from pulse.functions.text import casing, contains_any, strip
from pulse.functions.times import parse_date
from pulse.functions.values import coerce_numeric, to_double
from pulse.operators.ranking import keep_first, quantiles


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def _is_number(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.NumericType)


# -- values --------------------------------------------------------------------


def _regex_literal(s: str) -> str:
    return re.sub(r"([.?/#\-+*()\[\]{}|^$\\])", r"\\\1", s)


def placeholder_pattern(values: list[str] = X.PLACEHOLDERS, ignore_case: bool = False) -> str:
    body = "|".join(_regex_literal(v) for v in values)
    return f"{'(?i)' if ignore_case else ''}^{X.SPACE}*({body}){X.SPACE}*$"


def replace_placeholders(
    df: DataFrame, values: list[str] = X.PLACEHOLDERS, ignore_case: bool = False
) -> DataFrame:
    """Sentinel strings and blanks become NULL in every string column."""
    pattern = placeholder_pattern(values, ignore_case)
    return df.withColumns({c: F.when(~F.col(c).rlike(pattern), F.col(c)) for c in _text_columns(df)})


def numeric_share(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Share of the non-null values of each column that are numbers."""
    cols = cols or df.columns
    one = df.agg(
        *[
            (
                F.count(to_double(F.col(c).cast("string"))) / F.greatest(F.count(c), F.lit(1))
            ).alias(c)
            for c in cols
        ]
    )
    return one.unpivot([], cols, "column", "numeric_share")


def detect_roles(df: DataFrame, threshold: float = X.NUMERIC_MIN_SHARE) -> dict[str, str]:
    """``date``, ``numeric`` or ``text`` for each column; one aggregate row."""
    share = {r["column"]: r["numeric_share"] for r in numeric_share(df).collect()}

    def role(c: str) -> str:
        low = c.lower()
        if any(k in low for k in X.DATE_KEYWORDS):
            return "date"
        if share[c] > threshold or any(k in low for k in X.NUMERIC_KEYWORDS):
            return "numeric"
        return "text"

    return {c: role(c) for c in df.columns}


def standardise(df: DataFrame, roles: dict[str, str] | None = None) -> DataFrame:
    """Dates as ISO, numbers as double, text in its column's casing."""
    roles = roles or detect_roles(df)
    build = {
        "date": lambda c: parse_date(F.col(c).cast("string")),
        "numeric": lambda c: coerce_numeric(F.col(c).cast("string")),
        "text": lambda c: casing(F.col(c), c) if c in _text_columns(df) else F.col(c),
    }
    return df.withColumns({c: build[r](c) for c, r in roles.items()})


# -- filters -------------------------------------------------------------------


def in_window(df: DataFrame, ts: str, start: str, end: str, end_inclusive_day: bool = True) -> DataFrame:
    """Rows from ``start`` to ``end``, both closed; by default the end is
    moved on by one day, so that the whole last day is inside."""
    last = f"TIMESTAMP '{end}' + INTERVAL 1 DAY" if end_inclusive_day else f"TIMESTAMP '{end}'"
    return df.where((F.col(ts) >= F.expr(f"TIMESTAMP '{start}'")) & (F.col(ts) <= F.expr(last)))


def rating_filter(df: DataFrame, c: str = "score", lo: float | None = None, hi: float | None = None) -> DataFrame:
    number = to_double(F.col(c).cast("string"))
    if lo is not None:
        df = df.where(number >= lo)
    if hi is not None:
        df = df.where(number <= hi)
    return df


def keyword_filter(df: DataFrame, c: str, words: list[str]) -> DataFrame:
    return df.where(contains_any(c, words))


def min_length(df: DataFrame, c: str, n: int) -> DataFrame:
    return df.where(F.length(c) >= n)


def drop_blank(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNotNull() & (strip(c) != ""))


def drop_all_null(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value; one aggregate row decides."""
    seen = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c in df.columns if seen[c] == 0])


# -- validation and mapping ----------------------------------------------------


def validate_enum(df: DataFrame, c: str, allowed: list[str]) -> DataFrame:
    """Keep allowed values, else NULL; ``{c}_was_null`` marks the rest."""
    ok = F.coalesce(F.col(c).isin(allowed), F.lit(False))
    return df.withColumns({f"{c}_was_null": (~ok).cast("int"), c: F.when(ok, F.col(c))})


def clip_negative(df: DataFrame, c: str) -> DataFrame:
    """Bad numbers become 0, negative ones too."""
    number = F.coalesce(to_double(F.col(c).cast("string")), F.lit(0.0))
    return df.withColumn(c, F.greatest(number, F.lit(0.0)))


def remap(df: DataFrame, c: str, mapping: dict[str, str]) -> DataFrame:
    return df.replace(mapping, subset=[c])


def remap_report(df: DataFrame, c: str, mapping: dict[str, str]) -> DataFrame:
    """Rows touched by each entry of a mapping that occurs."""
    return (
        df.where(F.col(c).isin(list(mapping)))
        .groupBy(F.col(c).alias("old_value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("new_value", F.col("old_value"))
        .replace(mapping, subset=["new_value"])
    )


def label_conflict(label="sentiment_label", score="sentiment_score", pos: float = -0.3, neg: float = 0.5) -> Column:
    """1 where a label contradicts its score, else 0."""
    hit = ((F.col(label) == "Positive") & (F.col(score) < pos)) | (
        (F.col(label) == "Negative") & (F.col(score) > neg)
    )
    return F.coalesce(hit, F.lit(False)).cast("int")


def with_provenance(df: DataFrame, source: str, source_type: str, source_name: str, flag: str | None = None) -> DataFrame:
    """Constant provenance columns, and a flag column set to 1."""
    cols = {"source": F.lit(source), "source_type": F.lit(source_type), "source_name": F.lit(source_name)}
    if flag:
        cols[flag] = F.lit(1)
    return df.withColumns(cols)


def fill_flags(df: DataFrame, flags: list[str]) -> DataFrame:
    """Missing flags, or a missing flag column, count as 0."""
    have = set(df.columns)
    return df.withColumns({f: F.coalesce(F.col(f), F.lit(0)) if f in have else F.lit(0) for f in flags})


def split_location(df: DataFrame, c: str = "location") -> DataFrame:
    """``city`` before the first comma, ``country`` after it."""
    parts = F.split(F.col(c), ",", 2)
    return df.withColumns({"city": strip(F.get(parts, 0)), "country": strip(F.get(parts, 1))}).drop(c)


# -- missing values --------------------------------------------------------------


def flag_nulls(df: DataFrame, cols: list[str]) -> DataFrame:
    """``{c}_was_null`` for each column, whether or not it has NULLs."""
    return df.withColumns({f"{c}_was_null": F.col(c).isNull().cast("int") for c in cols})


def impute_median(df: DataFrame, cols: list[str], approx: bool = False, text: bool = False) -> DataFrame:
    """NULLs become the column's median.

    With ``text`` the columns stay strings and only NULL cells are filled, so
    text that is no number survives for a later step to judge.
    """
    return df.withColumns(_median_fills(df, cols, approx, text))


def _median_fills(df: DataFrame, cols: list[str], approx: bool = False, text: bool = False) -> dict[str, Column]:
    numbers = df.select(*[to_double(F.col(c).cast("string")).alias(c) for c in cols])
    found = quantiles(numbers, cols, {"median": 0.5}, approx=approx)
    lookup = found.agg(F.map_from_entries(F.collect_list(F.struct("column", "median")))).scalar()

    def fill(c: str) -> Column:
        median = F.try_element_at(lookup, F.lit(c))
        if text:
            return F.coalesce(F.col(c), median.cast("string"))
        return F.coalesce(to_double(F.col(c).cast("string")), median)

    return {c: fill(c) for c in cols}


def mode_of(df: DataFrame, c: str) -> DataFrame:
    """One row: most frequent value (smallest on a tie) and its share."""
    counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col(c).alias("v"))).alias("best"), F.sum("n").alias("t")).select(
        F.col("best.v").alias("mode_value"), (-F.col("best.neg") / F.col("t")).alias("mode_share")
    )


def impute_mode(df: DataFrame, c: str, min_share: float = X.MODE_MIN_SHARE) -> DataFrame:
    """NULLs become the mode when it is common enough; always flagged."""
    return flag_nulls(df, [c]).withColumn(c, _mode_fill(df, c, min_share))


def _mode_fill(df: DataFrame, c: str, min_share: float = X.MODE_MIN_SHARE) -> Column:
    best = mode_of(df, c).select(F.struct("mode_value", "mode_share")).scalar()
    return F.coalesce(F.col(c), F.when(best["mode_share"] >= min_share, best["mode_value"]))


def handle_missing(df: DataFrame, config: dict[str, str] | None = None) -> DataFrame:
    """Per-column strategy: ``drop``, ``flag``, ``median`` or ``mode``.

    Columns without a strategy get the median when they are numeric, else the
    mode. One aggregate row tells which columns are numeric and which have
    NULLs; medians and modes come from all rows, before any is dropped, and
    are computed only where there is something to fill. The columns that come
    out do not depend on that: a column with ``flag`` or ``mode`` always has
    its flag, a numeric column with ``median`` is always a double.
    """
    config = config or {}
    cols, text = df.columns, set(_text_columns(df))
    profile = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(cols)],
        *[
            (F.count(to_double(F.col(c).cast("string"))) / F.greatest(F.count(c), F.lit(1))).alias(f"share_{i}")
            for i, c in enumerate(cols)
        ],
    ).first()
    holes = {c: profile[f"null_{i}"] for i, c in enumerate(cols)}
    numeric = {c: profile[f"share_{i}"] > X.NUMERIC_MIN_SHARE for i, c in enumerate(cols)}
    plan = {c: config.get(c, "median" if numeric[c] else "mode") for c in cols}
    named = lambda kind: [c for c in cols if plan[c] == kind]

    out = flag_nulls(df, [c for c in cols if plan[c] in ("flag", "mode")])
    out = out.withColumns({c: to_double(F.col(c).cast("string")) for c in named("median") if c not in text and not holes[c]})
    for kind in (True, False):
        filled = [c for c in named("median") if holes[c] and (c in text) == kind]
        if filled:
            out = out.withColumns(_median_fills(df, filled, text=kind))
    out = out.withColumns({c: _mode_fill(df, c) for c in named("mode") if holes[c]})
    return out.dropna(subset=named("drop")) if named("drop") else out


# -- duplicates and reports ------------------------------------------------------


def duplicate_count(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row: rows beyond the first of each key (all columns by default)."""
    groups = df.groupBy(*(keys or df.columns)).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def deduplicate(df: DataFrame, keys: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """First row per key in ``order``; any row when the order is open."""
    if order:
        return keep_first(df, keys or df.columns, order)
    return df.dropDuplicates(keys)


def missing_report(df: DataFrame) -> DataFrame:
    """Missing (NULL or empty) count and percent for each column."""
    blank = {
        c: F.count_if(F.col(c).isNull() | (F.col(c) == "") if c in _text_columns(df) else F.col(c).isNull())
        for c in df.columns
    }
    one = df.agg(*[blank[c].alias(c) for c in df.columns], F.count(F.lit(1)).alias("_rows"))
    return one.unpivot(["_rows"], df.columns, "column", "missing").select(
        "column", "missing", F.round(F.try_divide(F.col("missing") * 100.0, F.col("_rows")), 1).alias("missing_pct")
    )


def text_audit(df: DataFrame, c: str = "post_text") -> DataFrame:
    """One row: raw, missing, empty, duplicate and clean row counts.

    Texts are counted by a digest first, so no text is moved and copies cost
    nothing more.
    """
    digest = F.sha2(F.col(c), 256).alias("_digest")
    groups = df.select(digest, (strip(c) == "").alias("_blank")).groupBy("_digest", "_blank").agg(F.count(F.lit(1)).alias("n"))
    blank, missing = F.col("_blank"), F.col("_digest").isNull()
    kept = ~missing & ~blank
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("missing_text_rows"),
        F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("empty_text_rows"),
        F.coalesce(F.sum(F.when(kept, F.col("n") - 1)), F.lit(0)).alias("duplicate_rows_removed"),
        F.count_if(kept).alias("clean_rows"),
    )
