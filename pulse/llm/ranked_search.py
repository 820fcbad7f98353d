"""Ranked lexical search over FP-trees of the documents' term vectors.

The items' terms restrict every document to a short term vector. A task sorts
the vectors of its documents by term frequency, rarest first, so that
documents with the same rare terms share a path, and cuts the resulting trie
into buckets. Every node knows the largest frequency of each term and the
smallest length measure below it; together they bound the score of any
document in its subtree, and each item's best documents are found depth first,
leaving out subtrees whose bound is below the worst document kept so far.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.llm.hashing import chunks
from pulse.llm.registry import query, read
from pulse.session import stored

TOP = 20
ITEM_CHARS = 4_000_000
BLOCK_ENTRIES = 1 << 22
BUCKET = 32
MAX_DEPTH = 48
NO_ID = (1 << 63) - 1

_LETTER = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if b in _LETTER else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, digits and anything beyond ASCII, A-Z lower-cased."""
    return text.translate(FOLD).split()


def measure(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    """The length measure ``m`` of documents of ``n`` terms."""
    return 75 + 25 * n * docs // total


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score, before its weight: grows with ``tf`` and
    falls with ``m``, which makes maxima and minima of them a bound."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Branch(NamedTuple):
    """The children of an inner node: their buckets or branches, and for each
    the largest ``tf`` of every term, the least ``m`` and the least id."""

    below: list
    start: np.ndarray
    term: np.ndarray
    tf: np.ndarray
    m: np.ndarray
    ids: np.ndarray


class Tree:
    """The documents of one block. Rows come as terms by rank, rarest first."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, ends: np.ndarray, term: np.ndarray, tf: np.ndarray, top: int):
        size = np.diff(ends, prepend=0)
        order = np.argsort((np.repeat(np.arange(len(ids)), size) << 32) | term, kind="stable")
        term, tf = term[order], tf[order]
        path, often = term.astype(">u4").tobytes(), tf.astype(">u4").tobytes()
        cut = [0, *(4 * ends).tolist()]
        key = [(path[a:b], often[a:b], x, i) for a, b, x, i in zip(cut, cut[1:], m.tolist(), ids.tolist(), strict=False)]
        rows = sorted(range(len(key)), key=key.__getitem__)
        # Documents alike in terms, frequencies and length tie in any search,
        # so no more than ``top`` of them, by id, can ever be returned.
        keep, run = [], 0
        for a, b in zip([None, *rows], rows, strict=False):
            run = run + 1 if a is not None and key[a][:3] == key[b][:3] else 0
            if run < top:
                keep.append(b)
        keep = np.array(keep, np.int64)
        self.ids, self.m, size = ids[keep], m[keep], size[keep]
        self.ends = np.cumsum(size)
        self.starts = self.ends - size
        at = np.repeat((ends - np.diff(ends, prepend=0))[keep] - self.starts, size) + np.arange(int(size.sum()))
        self.term, self.tf = term[at], tf[at]
        self.root = self._grow(0, len(keep), 0, 0)[0] if len(keep) else None

    def _cut(self, lo: int, hi: int, depth: int, level: int) -> tuple[list[tuple[int, int]], int]:
        """Ranges of the children of a trie node; neighbours that fit one
        bucket share it."""
        last = int(self.ends[hi - 1] - self.starts[hi - 1])
        a, b = (self.term[self.starts[k] : self.ends[k]] for k in (lo, hi - 1))
        while depth < min(len(a), last) and a[depth] == b[depth]:
            depth += 1
        # Rows are in order, so what the first and the last share, all share.
        size = self.ends[lo:hi] - self.starts[lo:hi]
        if level >= MAX_DEPTH or (size == depth).all():
            return [(k, min(hi, k + BUCKET)) for k in range(lo, hi, BUCKET)], depth
        next_term = np.where(size > depth, self.term[np.minimum(self.starts[lo:hi] + depth, len(self.term) - 1)].astype(np.int64), -1)
        edges = [lo, *(lo + 1 + np.flatnonzero(np.diff(next_term))).tolist(), hi]
        ranges: list[tuple[int, int]] = []
        for x, y in zip(edges[:-1], edges[1:], strict=True):
            if ranges and y - ranges[-1][0] <= BUCKET:
                ranges[-1] = (ranges[-1][0], y)
            else:
                ranges.append((x, y))
        return ranges, depth

    def _grow(self, lo: int, hi: int, depth: int, level: int) -> tuple:
        """``(node, terms, largest tf, least m, least id)`` of a range of rows."""
        if hi - lo <= BUCKET:
            first, last = int(self.starts[lo]), int(self.ends[hi - 1])
            term, tf = _maxima(self.term[first:last], self.tf[first:last])
            return (lo, hi), term, tf, int(self.m[lo:hi].min()), int(self.ids[lo:hi].min())
        ranges, depth = self._cut(lo, hi, depth, level)
        below = [self._grow(a, b, depth, level + 1) for a, b in ranges]
        start = np.cumsum([0, *(len(x[1]) for x in below[:-1])])
        branch = Branch(
            [x[0] for x in below],
            start,
            np.concatenate([x[1] for x in below]),
            np.concatenate([x[2] for x in below]),
            np.array([x[3] for x in below], np.int64),
            np.array([x[4] for x in below], np.int64),
        )
        term, tf = _maxima(branch.term, branch.tf)
        return branch, term, tf, int(branch.m.min()), int(branch.ids.min())

    def bounds(self, node: Branch, weight: np.ndarray) -> np.ndarray:
        """An upper bound of the score below each child."""
        hit = np.flatnonzero(weight[node.term])
        child = np.searchsorted(node.start, hit, side="right") - 1
        out = np.zeros(len(node.below), np.int64)
        np.add.at(out, child, weight[node.term[hit]] * part(node.tf[hit], node.m[child]))
        return out

    def scores(self, lo: int, hi: int, weight: np.ndarray) -> np.ndarray:
        first, last = int(self.starts[lo]), int(self.ends[hi - 1])
        hit = first + np.flatnonzero(weight[self.term[first:last]])
        row = np.searchsorted(self.ends[lo:hi], hit, side="right")
        out = np.zeros(hi - lo, np.int64)
        np.add.at(out, row, weight[self.term[hit]] * part(self.tf[hit], self.m[lo:hi][row]))
        return out

    def search(self, weight: np.ndarray, best: list[tuple[int, int]], top: int) -> tuple[list[tuple[int, int]], int]:
        """The ``top`` best ``(-score, id)`` of ``best`` and this tree, in
        order, and how many buckets were scored. ``weight`` is by term."""
        stack, opened = [(NO_ID, -1, self.root)] if self.root is not None else [], 0
        while stack:
            bound, least, node = stack.pop()
            # Below a bound that ties with the worst kept, a smaller id may be.
            if len(best) == top and (-bound, least) >= best[-1] or not bound:
                continue
            if isinstance(node, Branch):
                found = self.bounds(node, weight)
                order = np.lexsort((-node.ids, found)).tolist()
                stack += [(b, i, node.below[k]) for k in order for b, i in [(int(found[k]), int(node.ids[k]))] if b]
                continue
            opened += 1
            lo, hi = node
            got = self.scores(lo, hi, weight)
            some = np.flatnonzero(got >= max(1, -best[-1][0] if len(best) == top else 1))
            if len(some):
                best = sorted(best + list(zip((-got[some]).tolist(), self.ids[lo + some].tolist(), strict=True)))[:top]
        return best, opened


def _maxima(term: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(term, kind="stable")
    term, tf = term[order], tf[order]
    first = np.flatnonzero(np.diff(term, prepend=-1))
    return term[first], np.maximum.reduceat(tf, first) if len(first) else tf


# -- Spark -----------------------------------------------------------------


def _vectors(words):
    """Each document's length and its terms among ``words`` with frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = words.value
        for rows, texts in chunks(batches):
            ids, n, term, tf = [], [], [], []
            for i, t in zip(rows.column(0).to_pylist(), texts, strict=True):
                found = terms(t)
                if found:
                    known = np.array([k for k in map(number.get, found) if k is not None], np.int64)
                    own, count = np.unique(known, return_counts=True)
                    ids.append(i)
                    n.append(len(found))
                    term.append(own.astype("<u4").tobytes())
                    tf.append(count.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(term, pa.binary()), pa.array(tf, pa.binary())],
                names=["_id", "n", "terms", "tfs"],
            )

    return run


def _document_counts(size: int):
    """How many documents of the task hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4"), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["term", "df"])

    return run


def _searcher(shared, docs: int, total: int, top: int):
    """Trees over the rows of a task, each searched for every item. What was
    found in one tree raises the bar in the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, items = shared.value
        best: list[list[tuple[int, int]]] = [[] for _ in items]
        held: list[tuple] = []

        def flush():
            ids, n, size, term, tf = (np.concatenate(x) for x in zip(*held, strict=True))
            m = measure(n, docs, total)
            some = size > 0
            tree = Tree(ids[some], m[some], np.cumsum(size[some]), rank[term], tf, top)
            weight = np.zeros(len(rank), np.int64)
            for k, (own, w) in enumerate(items):
                weight[own] = w
                best[k] = tree.search(weight, best[k], top)[0]
                weight[own] = 0
            held.clear()

        entries = 0
        for batch in batches:
            ids = np.array([NO_ID if i is None else i for i in batch.column(0).to_pylist()], np.int64)
            raw = batch.column(2).to_pylist()
            term, tf = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in (raw, batch.column(3).to_pylist()))
            held.append((ids, batch.column(1).to_numpy(), np.array([len(x) // 4 for x in raw], np.int64), term, tf))
            entries += len(term)
            if entries >= BLOCK_ENTRIES:
                flush()
                entries = 0
        if held:
            flush()
        rows = [(k, None if i == NO_ID else i, -s) for k, own in enumerate(best) for s, i in own]
        cells = list(zip(*rows, strict=True)) or [()] * 3
        kinds = [pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, kinds, strict=True)], names=["item", "_id", "score"])

    return run


def _item_blocks(items: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """Items with a term, in blocks of about ``limit`` characters; the driver
    holds one block at a time."""
    block, size = [], 0
    for i, t in items.select(F.col(item_id).cast("long"), F.col(text)).where(F.col(text).isNotNull()).toLocalIterator():
        if found := terms(t.encode()):
            if block and size + len(t) > limit:
                yield block
                block, size = [], 0
            block.append((i, found))
            size += len(t)
    if block:
        yield block


def ranked_search(
    df: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    item_chars: int = ITEM_CHARS,
) -> DataFrame:
    """``(item_id, rank, id, score)``: the ``top`` best documents of each item.

    All documents are ranked; a document's score sums, over the item's terms
    with repeats, the term's weight times :func:`part`. Equal scores go by
    ascending id, NULL ids last; documents without a common term are not
    returned. Every row of ``df`` counts as a document and every row of
    ``items`` with a term as an item, repeated and NULL ids included. NULL and
    empty texts have no terms. Long texts are read whole. Empty tables give no
    rows. Other columns are not read.

    Items pass in blocks of ``item_chars`` characters, whose terms are
    broadcast; for each block the documents are read once and their term
    vectors written. A task's result is ``top`` rows an item.
    """
    spark = df.sparkSession
    src = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("text"))
    out = spark.createDataFrame([], f"{item_id} long, rank int, {id_col} long, score long")
    for block in _item_blocks(items, item_id, item_text, item_chars):
        out = out.unionByName(_best(src, block, top).select(F.col("item_id").alias(item_id), "rank", F.col("_id").alias(id_col), "score"))
    return out


def _best(src: DataFrame, block: list[tuple[int | None, list[bytes]]], top: int) -> DataFrame:
    spark = src.sparkSession
    number = {t: k for k, t in enumerate(sorted({t for _, own in block for t in own}))}
    words = spark.sparkContext.broadcast(number)
    vectors = stored(src.mapInArrow(_vectors(words), "_id long, n long, terms binary, tfs binary"), "vectors")
    docs, total = vectors.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = vectors.select("terms").mapInArrow(_document_counts(len(number)), "term int, df long")
    df = dict(counted.groupBy("term").agg(F.sum("df")).collect())  # terms of one block of items
    weight = {k: math.floor(1000 * math.log((2 * docs + 2) / (2 * n + 1))) for k, n in df.items()}
    rank = np.zeros(len(number), np.int64)
    rank[sorted(range(len(number)), key=lambda k: (df.get(k, 0), k))] = np.arange(len(number))
    own = []
    for _, found in block:
        pairs = [(rank[k], n * weight[k]) for t, n in Counter(found).items() if (k := number[t]) in weight]
        own.append(tuple(np.array(x, np.int64) for x in zip(*pairs, strict=True)) or (np.empty(0, np.int64),) * 2)
    shared = spark.sparkContext.broadcast((rank, own))
    rows = vectors.mapInArrow(_searcher(shared, docs, total, top), "item int, _id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("_id"))
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], "item int, item_id long")
    return ranked.join(F.broadcast(names), "item")  # one row an item of the block


SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id,
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents),
sizes AS (SELECT rid, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
whole AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM sizes),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) GROUP BY rid, term),
w AS (
    SELECT term, CAST(floor(1000 * ln((2 * nd + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
i AS (
    SELECT iid, item_id, term, count(*) AS qtf FROM (
        SELECT iid, item_id, unnest(terms) AS term FROM (
            SELECT row_number() OVER () AS iid, item_id,
                regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM benchmark))
    GROUP BY iid, item_id, term),
s AS (
    SELECT iid, item_id, rid, doc_id,
        CAST(sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nt)))) AS BIGINT) AS score
    FROM i JOIN w USING (term) JOIN tf USING (term) JOIN sizes USING (rid), whole
    GROUP BY iid, item_id, rid, doc_id)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS r FROM s WHERE score > 0)
WHERE r <= 20
"""


@query("op12_ranked_search", SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "benchmark"))
