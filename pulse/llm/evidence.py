"""What a labelled table says about a text: binned features, naive Bayes.

Everything here is a column expression or a grouped aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signs that join or decorate words.
SIGNS = "#*$%&|<>!"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÊÇÑÍÓ"

ENDS = ".,;:!?\"'()"

MARKER_CUTS = [0.5, 1.5, 2.5, 4.5, 8.5]
BINS = {
    "signs": [0.0005, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15],
    "upper": [0.005, 0.01, 0.02, 0.03, 0.05, 0.1, 0.3, 0.6],
    "fresh": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9],
    "length": [2.0, 4.0, 8.0, 16.0, 32.0, 64.0, 128.0, 512.0, 2048.0],
    "word": [2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 10.0, 15.0],
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named,
    also where a filter on the result is pushed below the projection."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Runs of other characters than blanks."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def bare(words: Column) -> Column:
    """Words in lower case without the punctuation around them."""
    return F.transform(words, lambda w: F.lower(F.btrim(w, F.lit(ENDS))))


def text_bins(text: str, markers: list[list[str]] | None = None) -> Column:
    """A struct with the bin number of each feature and ``n``, the words of
    the text; NULL counts as an empty text.

    The features: share of signs, share of capitals, share of words that are
    new in the text, number of words, letters per word; and for each list of
    ``markers`` how many words are in it (``m0``, ``m1``, ...).
    """

    def values(t: Column, w: Column) -> Column:
        size, n = F.greatest(F.length(t), F.lit(1)), F.greatest(F.size(w), F.lit(1))
        return F.struct(
            ((F.length(t) - F.length(F.translate(t, SIGNS, ""))) / size).alias("signs"),
            ((F.length(t) - F.length(F.translate(t, UPPER, ""))) / size).alias("upper"),
            (F.size(F.array_distinct(w)) / n).alias("fresh"),
            F.size(w).cast("double").alias("length"),
            (F.length(t) / n).alias("word"),
        )

    def bins(t: Column, w: Column) -> Column:
        lists = [_among(m) for m in markers or []]
        plain = lambda v: [_bin(v[k], BINS[k]).alias(k) for k in BINS]
        if not lists:
            return let(values(t, w), lambda v: F.struct(*plain(v), F.size(w).cast("long").alias("n")))
        hits = lambda b: F.array(*[f(b) for f in lists])
        marked = lambda h: [_bin(F.get(h, F.lit(k)), MARKER_CUTS).alias(f"m{k}") for k in range(len(lists))]
        return let(
            values(t, w),
            lambda v: let(
                let(bare(w), hits), lambda h: F.struct(*plain(v), *marked(h), F.size(w).cast("long").alias("n"))
            ),
        )

    return let(F.coalesce(F.col(text), F.lit("")), lambda t: let(words_of(t), lambda w: bins(t, w)))


def _among(listed: list[str]) -> Callable[[Column], Column]:
    """How many of some words are listed."""
    return lambda words: F.size(F.filter(words, lambda w: w.isin(listed))) if listed else F.lit(0)


def _bin(value: Column, cuts: list[float]) -> Column:
    """The number of cuts that a value reaches."""
    out = F.lit(len(cuts))
    for i in range(len(cuts) - 1, -1, -1):
        out = F.when(value < cuts[i], F.lit(i)).otherwise(out)
    return out


def log_likelihoods(
    labelled: DataFrame, domain: str, names: list[str], columns: dict[str, int]
) -> tuple[dict[str, dict[str, list[float]]], dict[str, float]]:
    """Smoothed ``log p(bin | domain)`` per column, and each domain's share.

    One grouped count over all labelled rows; the driver gets one row per
    domain, column and bin. ``columns`` tells the number of bins of each field
    of ``_f``.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("c"), F.col("_f")[c].cast("int").alias("b")) for c in columns])
    rows = labelled.select(F.col(domain).alias("d"), F.explode(pairs).alias("x"))
    counts = {(r.d, r.c, r.b): r.n for r in rows.groupBy("d", "x.c", "x.b").agg(F.count(F.lit(1)).alias("n")).collect()}
    first = next(iter(columns))
    total = {d: sum(n for (e, c, _), n in counts.items() if e == d and c == first) for d in names}
    whole = sum(total.values())
    logs = {
        c: {d: [math.log((counts.get((d, c, b), 0) + 1.0) / (total[d] + bins)) for b in range(bins)] for d in names}
        for c, bins in columns.items()
    }
    return logs, {d: (total[d] + 1.0) / (whole + len(names)) for d in names}


def log_evidence(bins: Column, logs: dict[str, dict[str, list[float]]], domain: str) -> Column:
    """The naive Bayes log-likelihood of a domain for a struct of bins."""
    out = F.lit(0.0)
    for name, by in logs.items():
        out = out + F.get(F.array(*[F.lit(x) for x in by[domain]]), bins[name])
    return out
