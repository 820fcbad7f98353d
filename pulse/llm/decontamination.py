"""Benchmark decontamination: pigeonhole pieces and Myers' bit-parallel distance."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.hashing import chunks
from pulse.llm.registry import query, read
from pulse.session import stored

ERROR_RATE = 0.05
BLOCK_CHARS = 8_000_000

Hit = tuple[int, int, int, int]


def normal(text: str) -> str:
    """Lower case, single blanks."""
    return " ".join(text.lower().split())


def budget(length: int, rate: float) -> int:
    """Edits allowed for an item of so many characters."""
    return int(length * rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces with their offsets: of any place within
    ``errors`` edits of the item, one of them is left untouched."""
    cuts = [len(item) * k // (errors + 1) for k in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def nearest(item: str, text: str) -> tuple[int, int]:
    """Smallest edit distance of the item to any part of the text, and where
    the first such part ends: Myers' algorithm on whole numbers as bit rows."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    has: dict[str, int] = {}
    for k, c in enumerate(item):
        has[c] = has.get(c, 0) | 1 << k
    plus, minus, score, best, end = full, 0, m, m, 0
    for k, c in enumerate(text):
        eq = has.get(c, 0)
        down = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(across | plus) & full
        less = plus & across
        if up & top:
            score += 1
        elif less & top:
            score -= 1
            if score < best:
                best, end = score, k + 1
        up, less = up << 1, less << 1
        plus = (less | ~(down | up)) & full
        minus = up & down
    return best, end


class Finder:
    """The items of one block, with an automaton over all their pieces."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(i, normal(t)) for i, t in items]
        self.errors = [budget(len(t), rate) for _, t in self.items]
        self.automaton = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, t) in enumerate(self.items):
            for offset, piece in pieces(t, self.errors[k]) if t else []:
                where.setdefault(piece, []).append((k, offset))
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def hits(self, text: str, first_only: bool = False) -> list[Hit]:
        """``(item, distance, start, end)`` of each item found in a normalised
        text, the nearest place of each; places are those of the normalised text."""
        if self.empty or not text:
            return []
        starts: dict[int, list[int]] = {}
        for end, (length, at) in self.automaton.iter(text):
            for k, offset in at:
                starts.setdefault(k, []).append(end + 1 - length - offset)
        out: list[Hit] = []
        for k, found in starts.items():
            item, e = self.items[k][1], self.errors[k]
            best: Hit | None = None
            for lo, hi in _windows(sorted(found), len(item), e, len(text)):
                distance, end = nearest(item, text[lo:hi])
                if distance <= e and (best is None or distance < best[1]):
                    back = text[max(lo, lo + end - len(item) - e) : lo + end][::-1]
                    best = (self.items[k][0], distance, lo + end - nearest(item[::-1], back)[1], lo + end)
            if best:
                out.append(best)
                if first_only:
                    break
        return out


def _windows(starts: list[int], length: int, e: int, size: int) -> Iterator[tuple[int, int]]:
    """Parts of the text that hold every place a piece speaks for; parts that
    overlap are one."""
    lo, hi = starts[0] - e, starts[0] + length + e
    for s in starts[1:]:
        if s - e > hi:
            yield max(0, lo), min(size, hi)
            lo = s - e
        hi = s + length + e
    yield max(0, lo), min(size, hi)


def item_blocks(benchmark: DataFrame, item_id: str, text: str, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``limit`` characters; the driver holds
    one block at a time. Items without text, or a NULL id, are left out."""
    block, size = [], 0
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t"))
    for row in rows.where("i IS NOT NULL AND t IS NOT NULL").toLocalIterator():
        if block and size + len(row.t) > limit:
            yield block
            block, size = [], 0
        block.append((row.i, row.t))
        size += len(row.t)
    if block:
        yield block


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``(id, item_id, distance, start, end)``: each test item found in a
    document within ``rate`` of its length in edits, at its nearest place.

    Both sides are compared in lower case with single blanks. An item is cut
    into one piece more than its edits, so a place within the budget holds
    one piece unchanged; whole texts are searched for all pieces at once and
    every place they point to is verified. NULL and empty texts and items are
    never found. Rows that repeat an id are searched each. Other columns are
    not read. The items pass in blocks of ``block_chars``, one broadcast and
    one scan of the documents each.
    """
    spark = df.sparkSession
    src = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("text"))
    schema = "_id long, item_id long, distance int, start int, end int"
    out = spark.createDataFrame([], schema)
    for block in item_blocks(benchmark, item_id, item_text, block_chars):
        shared = spark.sparkContext.broadcast(Finder(block, rate))
        out = out.unionByName(stored(src.mapInArrow(_hits(shared), schema), "contaminated"))
        shared.unpersist()
    return out.withColumnRenamed("_id", id_col)


def _hits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            ids, found = part.column(0).to_pylist(), []
            for i, t in zip(ids, texts, strict=True):
                found += [(i, *h) for h in shared.value.hits(normal(t.decode()))]
            names = ["_id", "item_id", "distance", "start", "end"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
            cells = list(zip(*found, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=names)

    return run


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    rate: float = ERROR_RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``df`` in which :func:`contaminated` finds no item, with all
    their columns. Rows are judged where they are read: nothing is shuffled
    and no id is needed."""
    for block in item_blocks(benchmark, item_id, item_text, block_chars):
        shared = df.sparkSession.sparkContext.broadcast(Finder(block, rate))
        df = df.mapInArrow(_clean(shared, text), df.schema)
    return df


def _clean(shared, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, text):
            yield part.filter(pa.array([not shared.value.hits(normal(t.decode()), True) for t in texts], pa.bool_()))

    return run


@query("op3_decontamination")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "benchmark"))
