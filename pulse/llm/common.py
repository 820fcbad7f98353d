"""Small helpers shared by the text-preparation operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = re.compile(r"[^\W\d_]+")
SMALL_BYTES = 64 << 20


def letter_words(text: bytes) -> list[str]:
    """The lower-cased runs of letters of a UTF-8 text."""
    return LETTERS.findall(text.decode("utf-8", "replace").lower())


def fold(id_col: str, folds: int) -> Column:
    """``crc32`` of the id written as text, modulo ``folds``; a NULL id counts as ''."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def packed(df: DataFrame, without: list[str], **named: str | Column) -> DataFrame:
    """The columns of ``df`` but those in ``without`` as one struct ``_in``, and
    ``named`` columns beside it: no input name can meet one made later."""
    rest = [F.col(c) for c in df.columns if c not in without]
    cols = [(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in named.items()]
    return df.select(F.struct(*rest).alias("_in"), *cols)


def with_small_side(df: DataFrame, side: DataFrame, key: str, row_bytes: int, how: str = "inner") -> DataFrame:
    """``df`` joined to ``side``; a side counted to be at most ``SMALL_BYTES``
    is broadcast, which spares a shuffle of texts, a larger one is not."""
    if side.count() * row_bytes <= SMALL_BYTES:
        side = F.broadcast(side)
    return df.join(side, key, how)
