"""Numeric and label functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.functions.text import _col


def to_double(c) -> Column:
    """Number or NULL; never NaN."""
    number = _col(c).try_cast("double")
    return F.when(~F.isnan(number), number)


def coerce_numeric(c) -> Column:
    """Number after dropping currency signs, commas, percent and spaces."""
    return to_double(F.regexp_replace(_col(c), r"[,$€£%\s]", ""))


def sentiment_number(c, scale: dict[str, float] = X.SENTIMENT_SCALE) -> Column:
    """Label on the numeric scale; unknown labels sit in the middle."""
    lookup = F.create_map(*[F.lit(v) for pair in scale.items() for v in pair])
    return F.coalesce(F.try_element_at(lookup, _col(c)), F.lit(X.UNKNOWN_SENTIMENT))


def softmax(margins) -> Column:
    """Probabilities from an array of margins."""
    m = _col(margins)
    shifted = F.transform(m, lambda x: F.exp(x - F.array_max(m)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x)
    return F.transform(shifted, lambda x: x / total)


def stable_hash(c, seed: int = 42) -> Column:
    """A 60-bit number from a key and a seed; the same on every engine."""
    text = F.concat_ws(":", _col(c).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def bin_index(c, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin number; the last bin is closed, outside is NULL."""
    x = _col(c)
    width = (hi - lo) / bins
    raw = F.floor((x - F.lit(lo)) / F.lit(width)).cast("int")
    return F.when((x >= lo) & (x <= hi), F.least(raw, F.lit(bins - 1)))
