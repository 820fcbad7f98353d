"""Time functions: mixed timestamps, multi-format dates, ISO output.

The session time zone is UTC (see ``pulse.session``), so text without
an offset is read as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.functions.text import _col, strip

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DAY_FIRST = r"^\d\d-\d\d-\d{4}$"


def parse_mixed_ts(c) -> Column:
    """Epoch seconds, ``dd-MM-yyyy``, else ISO; each row on its own."""
    raw = strip(c)
    return (
        F.when(raw.rlike(_NUMBER), F.timestamp_seconds(raw.try_cast("double")))
        .when(raw.rlike(_DAY_FIRST), F.try_to_timestamp(raw, F.lit("dd-MM-yyyy")))
        .otherwise(raw.try_cast("timestamp"))
    )


def parse_date(c, formats: list[str] = X.DATE_FORMATS) -> Column:
    """The first format that fits, as ``yyyy-MM-dd``; NULL when none does."""
    raw = strip(c)
    tries = [F.try_to_timestamp(raw, F.lit(f)) for f in formats]
    return F.date_format(F.coalesce(*tries), "yyyy-MM-dd")


def to_utc_iso(c) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ``; NULL for text that is no timestamp."""
    return iso(strip(c).try_cast("timestamp"))


def iso(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def month(c) -> Column:
    return F.date_format(_col(c), "yyyy-MM")
