"""Toxicity by class-conditional Kneser-Ney language models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.common import fold, letter_words, with_small_side
from pulse.llm.hashing import chunks, mix
from pulse.llm.registry import query, read
from pulse.session import stored

ORDER = 6
SHORT = 3
BITS = 10
LISTED = 500_000
PIECE_CHARS = 1 << 22
CALIBRATION_ROWS = 20_000
FLUSH = 4_000_000
WINDOW = 24
EXCESS = 3.0
THRESHOLD = 0.3


class Table:
    """Numbers by 60-bit code: a table of slots, with a sorted rest."""

    def __init__(self, codes: np.ndarray, values: np.ndarray):
        self.codes, self.values = np.append(codes, -1), np.append(values, 0.0)
        self.bits = max(8, int(np.ceil(np.log2(len(codes) + 1))) + 2)
        self.slots = np.full(1 << self.bits, len(codes), np.int32)
        at = self._slot(codes)
        self.slots[at] = np.arange(len(codes))
        lost = np.flatnonzero(self.codes[self.slots[at]] != codes)
        order = lost[np.argsort(codes[lost])]
        self.rest, self.rest_values = codes[order], values[order]

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (mix(codes.view(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each code, 0 if unknown, and whether it is known."""
        at = self.slots[self._slot(codes)]
        hit = self.codes[at] == codes
        out = np.where(hit, self.values[at], 0.0)
        if len(self.rest):
            k = np.minimum(np.searchsorted(self.rest, codes), len(self.rest) - 1)
            more = self.rest[k] == codes
            out[more], hit[more] = self.rest_values[k[more]], True
        return out, hit


@dataclass
class Model:
    """Log-likelihood ratios, toxic to ordinary: of the listed grams, and of
    any other gram after a context that has listed ones. Elsewhere both models
    are the shared one, and the ratio is 0."""

    grams: Table
    contexts: Table


def gram_codes(text: bytes) -> np.ndarray:
    """A code for each letter or word gap of a text, with the ``ORDER - 1``
    before it. Words are lower-cased runs of letters; letters from U+0400 on
    are told apart by their lowest ``BITS`` bits."""
    words = letter_words(text)
    if not words:
        return np.empty(0, np.int64)
    line = " " * ORDER + " ".join(words) + " "
    ids = np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.int64) & ((1 << BITS) - 1)
    n = len(ids) - ORDER
    out = np.zeros(n, np.int64)
    for k in range(1, ORDER + 1):
        out = (out << BITS) | ids[k : k + n]
    return out


def _gram_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(code, n0, n1)`` sums of a task: texts of each class that hold a gram."""
    held: list[np.ndarray] = []

    def out():
        both, n = np.unique(np.concatenate(held), return_counts=True)
        code = np.unique(both >> 1)
        sums = np.zeros((2, len(code)), np.int64)
        np.add.at(sums, (both & 1, np.searchsorted(code, both >> 1)), n)
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(sums[0]), pa.array(sums[1])], names=["code", "n0", "n1"])

    for part, texts in chunks(batches):
        for toxic, t in zip(part.column(1).to_pylist(), texts, strict=True):
            held.append((np.unique(gram_codes(t)) << 1) | toxic)
        if sum(map(len, held)) > FLUSH:
            yield out()
            held.clear()
    if held:
        yield out()


def fit(train: DataFrame, text: str = "text", toxic: str = "toxic") -> DataFrame:
    """Kneser-Ney letter models of the toxic and the ordinary rows of ``train``.

    A class's estimate for a letter after ``ORDER - 1`` others is discounted
    and interpolated with the continuation counts of the last ``SHORT``
    letters (in how many different longer grams they end) of both classes
    together, which smooth rare expressions alike in both. A gram counts once
    in a text, however often the text repeats it. The absolute discount, from
    the counts seen once and twice, is raised by what the shared counts let
    one expect of the class and by ``EXCESS`` times its random spread: only a
    clear excess stays in a class.

    All rows and all their letters are counted: tasks sum before the shuffle,
    and the sums, contexts and continuation counts stay distributed. The
    result has ``(code, after, ratio)`` of every gram with an excess and, where
    ``after`` holds, of every context that has one: the ratio of its others.
    """
    rows = train.select(F.col(text).alias("text"), F.col(toxic).cast("int").alias("toxic"))
    grams = rows.mapInArrow(_gram_counter, "code long, n0 long, n1 long")
    grams = stored(grams.groupBy("code").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "grams")
    n = F.col("n0") + F.col("n1")
    once, twice = grams.agg(F.count_if(n == 1), F.count_if(n == 2)).first()
    cut = once / (once + 2 * twice) if once and twice else 0.75

    grams = grams.withColumn("context", F.shiftright("code", BITS))
    sums = grams.groupBy("context").agg(F.sum("n0").alias("c0"), F.sum("n1").alias("c1"))
    both = grams.join(sums, "context")
    whole = [float(x or 0) for x in grams.agg(F.sum("n0"), F.sum("n1")).first()]
    for c in "01":
        want = n * F.lit(whole[int(c)] / max(sum(whole), 1.0))
        left = F.col(f"n{c}") - want - EXCESS * F.sqrt(want) - cut
        both = both.withColumn(f"p{c}", F.when(left > 0, left / F.col(f"c{c}")).otherwise(0.0))
    both = stored(both.where("p0 + p1 > 0").select("code", "context", "p0", "p1"), "excess")

    low = F.col("code").bitwiseAND(F.lit((1 << (BITS * SHORT)) - 1))
    ends = grams.groupBy(low.alias("low")).agg(F.count(F.lit(1)).alias("k"))
    ends = ends.withColumn("before", F.shiftright("low", BITS))
    total = ends.groupBy("before").agg(F.sum("k").alias("of"))
    shared = ends.join(total, "before").select("low", (F.col("k") / F.col("of")).alias("shared"))
    back = stored(both.groupBy("context").agg((1 - F.sum("p0")).alias("b0"), (1 - F.sum("p1")).alias("b1")), "back")
    got = both.withColumn("low", low).join(shared, "low").join(back, "context")
    ratio = F.log((F.col("p1") + F.col("b1") * F.col("shared")) / (F.col("p0") + F.col("b0") * F.col("shared")))
    own = got.select("code", F.lit(False).alias("after"), ratio.alias("ratio"))
    others = back.select(F.col("context").alias("code"), F.lit(True).alias("after"), F.log(F.col("b1") / F.col("b0")).alias("ratio"))
    return stored(own.unionByName(others), "ratios")


def gathered(rows: DataFrame) -> Model:
    got = rows.toPandas()
    return Model(*(Table(x["code"].to_numpy(np.int64), x["ratio"].to_numpy(float)) for x in (got[~got["after"]], got[got["after"]])))


def features(codes: list[np.ndarray], model: Model) -> np.ndarray:
    """Per text: mean log-likelihood ratio per letter, the largest mean over
    windows of ``WINDOW`` letters, the ratio's sum over the root of the length."""
    flat = np.concatenate(codes)
    ratio, known = model.grams.find(flat)
    other = np.flatnonzero(~known)
    ratio[other] = model.contexts.find(flat[other] >> BITS)[0]
    sums = np.concatenate(([0.0], np.cumsum(ratio)))
    ends = np.cumsum([len(c) for c in codes])
    out = np.zeros((len(codes), 3))
    for k, (a, b) in enumerate(zip(np.concatenate(([0], ends[:-1])), ends, strict=True)):
        if b > a:
            total, wide = sums[b] - sums[a], min(WINDOW, b - a)
            best = (sums[a + wide : b + 1] - sums[a : b + 1 - wide]).max()
            out[k] = total / (b - a), best / wide, total / np.sqrt(b - a)
    return out


SCORED = "doc_id long, n long, mean double, peak double, root double"


def _scored(ids: pa.Array, texts: list[bytes], model: Model) -> pa.RecordBatch:
    codes = [gram_codes(t) for t in texts]
    got = features(codes, model)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([len(c) for c in codes], pa.int64()), *[pa.array(got[:, k].copy()) for k in range(3)]],
        names=["doc_id", "n", "mean", "peak", "root"],
    )


def _ratios(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            yield _scored(part.column(0), texts, shared.value)

    return run


def _needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct ``(piece, code)`` of some texts."""
    for part, texts in chunks(batches):
        piece, codes = part.column(0).to_numpy(), [gram_codes(t) for t in texts]
        for p in np.unique(piece):
            code = np.unique(np.concatenate([codes[k] for k in np.flatnonzero(piece == p)]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), p, np.int32)), pa.array(code)], names=["piece", "code"])


def _piecewise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores the texts of each piece, which follow the ratios of its codes."""
    now, held, model, empty = None, [], None, Table(np.empty(0, np.int64), np.empty(0))
    for part, texts in chunks(batches):
        piece, is_text = part.column(0).to_numpy(), part.column(3).is_null().to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(piece * 2 + is_text)) + 1).tolist(), len(piece)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if piece[a] != now:
                now, held, model = piece[a], [], None
            some = part.slice(a, b - a)
            if not is_text[a]:
                held.append((some.column(3).to_numpy(), some.column(4).to_numpy()))
                continue
            if model is None:
                flat = [np.concatenate(x) for x in zip(*held, strict=True)]
                model, held = Model(Table(*flat) if flat else empty, empty), []
            yield _scored(some.column(1), texts[a:b], model)


def _spread_ratios(src: DataFrame, rows: DataFrame) -> DataFrame:
    """The texts in bounded pieces: a piece's distinct codes meet the
    distributed ratios in a join, and the found ones travel to its texts."""
    whole = src.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + int(whole) // PIECE_CHARS
    src = src.withColumn("piece", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))
    needed = src.select("piece", "text").repartition(n, "piece").mapInArrow(_needed, "piece int, code long").distinct()
    own = rows.where("NOT after").select("code", F.col("ratio").alias("own"))
    others = rows.where("after").select(F.col("code").alias("context"), F.col("ratio").alias("other"))
    found = needed.withColumn("context", F.shiftright("code", BITS)).join(others, "context").join(own, "code", "left")
    found = found.selectExpr("piece", "CAST(NULL AS long) AS doc_id", "CAST(NULL AS string) AS text", "code", "coalesce(own, other) AS ratio")
    texts = src.selectExpr("piece", "doc_id", "text", "CAST(NULL AS long) AS code", "CAST(NULL AS double) AS ratio")
    both = found.unionByName(texts).repartition(n, "piece").sortWithinPartitions("piece", F.col("code").isNull())
    return both.mapInArrow(_piecewise, SCORED)


def ratios(df: DataFrame, rows: DataFrame, id_col: str, text: str, listed: int = LISTED) -> DataFrame:
    """``(doc_id, n, mean, peak, root)`` of every row; ``n`` letters and gaps.

    Up to ``listed`` ratios are broadcast; more stay distributed and are
    joined to the texts' codes, with the same result.
    """
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    if rows.count() > listed:
        return _spread_ratios(src, rows)
    return src.mapInArrow(_ratios(df.sparkSession.sparkContext.broadcast(gathered(rows))), SCORED)


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights for the three features, their scale included."""
    scale = x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), x / scale])
    w, ridge = np.zeros(4), np.diag([1e-6, 1.0, 1.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge
        w = w + np.linalg.solve(hess, z.T @ (y - p) - ridge @ w)
    return np.concatenate(([w[0]], w[1:] / scale))


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    toxic: str = "toxic",
    calibration_rows: int = CALIBRATION_ROWS,
    listed: int = LISTED,
) -> DataFrame:
    """``(id, score, predicted)`` of every row of ``df``.

    ``labels`` has the ids that may be learnt from and ``toxic`` 0 or 1; of
    several labels of an id the largest counts, NULL labels are left out. The
    logistic curve that turns length-normalised ratios into a score is fitted
    on a fifth of the labelled rows by a hash of the id, ``calibration_rows``
    at most in hash order; the models are fitted on all others, where equal
    texts of a class count once. Ratios beyond ``listed`` are not gathered.
    A text without words, NULL included, scores 0, and so does every
    text when one of the classes has no labelled row. Columns other than id
    and text are not read; repeated rows are scored alike.
    """
    known = labels.where(F.col(toxic).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(id_col).agg(F.max(toxic).cast("int").alias("_toxic"))
    known = known.withColumn("_part", F.pmod(F.xxhash64(id_col, F.lit("calibrate")), F.lit(5)))
    rows = with_small_side(df.select(id_col, text), known, id_col, 24)
    # Of equal texts of one class one is learnt from, so copies do not weigh.
    once = rows.groupBy("_toxic", F.xxhash64(text).alias("_h")).agg(F.min(id_col).alias(id_col)).select(id_col)
    known = stored(known.join(once, id_col, "left_semi"), "labels")
    held = known.where("_part = 0").orderBy(F.xxhash64(id_col), id_col).limit(calibration_rows)
    held = stored(held.select(id_col, F.lit(True).alias("_held")), "held")
    known = known.join(F.broadcast(held), id_col, "left").withColumn("_held", F.coalesce("_held", F.lit(False)))
    rows = with_small_side(df.select(id_col, text), known, id_col, 24)
    model = fit(rows.where("NOT _held"), text, "_toxic")
    tested = ratios(rows.where("_held"), model, id_col, text, listed).withColumnRenamed("doc_id", id_col)
    tested = with_small_side(tested.where("n > 0"), known, id_col, 24)
    got = tested.orderBy(F.xxhash64(id_col), id_col, "n", "mean").limit(calibration_rows).toPandas()
    weights = None
    if got["_toxic"].nunique() == 2:
        weights = calibrate(got[["mean", "peak", "root"]].to_numpy(), got["_toxic"].to_numpy(float))
    out = ratios(df, model, id_col, text, listed)
    if weights is None:
        score = F.lit(0.0)
    else:
        b, *w = [float(x) for x in weights]
        line = F.lit(b) + F.lit(w[0]) * F.col("mean") + F.lit(w[1]) * F.col("peak") + F.lit(w[2]) * F.col("root")
        score = F.when(F.col("n") > 0, 1 / (1 + F.exp(-line))).otherwise(0.0)
    return out.select(F.col("doc_id").alias(id_col), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


@query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    labels = read(spark, folder, "labels", "doc_id", "toxic").where(fold("doc_id", 4) != 2)
    out = toxicity(docs, labels)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")
