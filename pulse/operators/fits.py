"""Linear classifiers of many splits fitted side by side.

Every step of every fit is one aggregate over the same written blocks of gram
counts, so the number of Spark jobs follows the longest fit and not the sum of
all fits, and no vector is written per split. The executors sum losses and
gradients; the driver holds a bounded vocabulary and the coefficients.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes, OneVsRest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.session import stored

CHUNK = 300_000  # gram counts worked on at once
MEMORY = 10  # steps that shape the next direction
NARROW = 6  # columns that are worked on one by one
COLUMNS = 96  # coefficient columns fitted side by side
DIRECT = 1 << 25  # bytes of sums that the driver takes from the tasks at once
STATE = 96 << 20  # bytes of points, slopes and past steps that the driver keeps at once
_SLICE = 1 << 19  # numbers of a gradient summed together


# -- what is fitted -----------------------------------------------------------------


@dataclass
class Problem:
    """One classifier on one split, with a column of coefficients per class."""

    split: int
    kind: str  # hinge, softmax, multinomial or complement
    reg: float = 0.0  # smoothing, for the two kinds of naive Bayes
    weighted: bool = False
    steps: int = 0
    tolerance: float = 0.0


def problem(classifier: Estimator, split: int) -> Problem:
    """The settings of an MLlib classifier as a problem."""
    if isinstance(classifier, NaiveBayes):
        return Problem(split, classifier.getModelType(), classifier.getSmoothing())
    kind, inner = ("hinge", classifier.getClassifier()) if isinstance(classifier, OneVsRest) else ("softmax", classifier)
    if not isinstance(inner, (LinearSVC, LogisticRegression)) or inner.getStandardization() or not inner.getFitIntercept():
        raise ValueError(f"no fit for {classifier}")
    weighted = classifier.isDefined("weightCol") or inner.isDefined("weightCol")
    return Problem(split, kind, inner.getRegParam(), weighted, inner.getMaxIter(), inner.getTol())


# -- sums over blocks -----------------------------------------------------------------


def _csr(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["ptr"], np.int64), np.frombuffer(row["idx"], np.int32), np.frombuffer(row["tf"], np.float32)


def _times(ptr: np.ndarray, index: np.ndarray, tf: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """The sparse rows times a dense matrix."""
    out = np.zeros((len(ptr) - 1, dense.shape[1]), np.float32)
    full = np.flatnonzero(np.diff(ptr))
    if len(full):
        out[full] = _reduced(dense, index, tf, ptr[full])
    return out


def _reduced(dense: np.ndarray, index: np.ndarray, tf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``dense[index] * tf`` over the runs that begin at ``starts``."""
    if dense.shape[1] > NARROW:
        products = dense[index]
        products *= tf[:, None]
        return np.add.reduceat(products, starts, axis=0)
    lines = (np.ascontiguousarray(line)[index] for line in dense.T)
    return np.stack([np.add.reduceat(np.multiply(line, tf, out=line), starts) for line in lines], axis=1)


def _residuals(z: np.ndarray, row: dict, problems: list[Problem], n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row what the loss changes by with each margin, and the summed
    losses; for naive Bayes the class marks."""
    label, weight, mask = np.array(row["label"], int), np.array(row["weight"], np.float32), np.array(row["train"], np.int64)
    hit = label[:, None] == np.arange(n_classes)
    out, losses = np.zeros((len(label), len(problems) * n_classes), np.float32), np.zeros(len(problems) * n_classes)
    for i, p in enumerate(problems):
        at = slice(i * n_classes, (i + 1) * n_classes)
        inside = ((mask >> p.split) & 1).astype(np.float32)
        w = (inside * weight if p.weighted else inside)[:, None]
        own = z[:, at]
        if p.kind == "hinge":
            sign = np.where(hit, 1, -1).astype(np.float32)
            lack = 1 - sign * own
            losses[at] = (w * np.maximum(lack, 0)).sum(0, dtype=float)
            out[:, at] = np.where(lack > 0, -sign * w, 0)
        elif p.kind == "softmax":
            top = own.max(1, keepdims=True)
            e = np.exp(own - top)
            total = e.sum(1, keepdims=True)
            losses[at.start] = (w[:, 0] * (np.log(total[:, 0]) + top[:, 0] - (own * hit).sum(1))).sum(dtype=float)
            out[:, at] = w * (e / total - hit)
        else:
            out[:, at] = w * hit
    return out, losses


def _margins(row: dict, dense: np.ndarray, bias: np.ndarray, parts: list[tuple[int, int]], places: np.ndarray) -> np.ndarray:
    """Margins of each row under each column. ``parts`` are the index ranges
    of the vocabularies, ``places`` the split of each column."""
    ptr, index, tf = _csr(row)
    norms = np.frombuffer(row["norm"], np.float32).reshape(len(parts), len(ptr) - 1, -1)
    if len(parts) == 1:
        return _times(ptr, index, tf, dense) * norms[0][:, places] + bias
    z = np.tile(bias, (len(ptr) - 1, 1))
    for (lo, hi), norm in zip(parts, norms, strict=True):
        inside = (index >= lo) & (index < hi)
        ends = np.concatenate(([0], np.cumsum(inside)))[ptr]
        z += _times(ends, index[inside], tf[inside], dense) * norm[:, places]
    return z


def _gradients(problems: list[Problem], shared, n_classes: int, parts: list[tuple[int, int]], width: int):
    """Sums of losses, of residuals and of residuals times counts, cut into
    slices of grams; one set per task."""
    places = np.repeat([p.split for p in problems], n_classes)
    flat = all(p.kind in ("multinomial", "complement") for p in problems)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, bias = shared.value
        total, sums = np.zeros((width, len(places)), np.float32), np.zeros((2, len(places)))
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["label"])
                z = np.zeros((n, len(places)), np.float32) if flat else _margins(row, dense, bias, parts, places)
                r, losses = _residuals(z, row, problems, n_classes)
                sums += np.stack([losses, r.sum(0, dtype=float)])
                starts, rows, tf = (np.frombuffer(row[k], t) for k, t in (("starts", np.int64), ("rows", np.int32), ("by_gram", np.float32)))
                grams = np.frombuffer(row["grams"], np.int32)
                if not len(grams):
                    continue
                norms = np.frombuffer(row["norm"], np.float32).reshape(len(parts), n, -1)
                edges = np.searchsorted(grams, [hi for _, hi in parts])
                lo = 0
                for norm, hi in zip(norms, edges, strict=True):
                    if hi > lo:
                        first, last = starts[lo], starts[hi] if hi < len(starts) else len(rows)
                        total[grams[lo:hi]] += _reduced(r * norm[:, places], rows[first:last], tf[first:last], starts[lo:hi] - first)
                    lo = hi
        step = max(1, _SLICE // len(places))
        pieces = [(-1, sums.tobytes())] + [(at // step, total[at : at + step].tobytes()) for at in range(0, width, step)]
        for piece in pieces:
            yield pa.RecordBatch.from_pydict({"slice": pa.array([piece[0]], pa.int32()), "part": pa.array([piece[1]], pa.binary())})

    return run


def _added(table: pa.Table) -> pa.Table:
    """One slice, summed over the tasks."""
    at = table.column("slice")[0].as_py()
    parts = (np.frombuffer(x.as_buffer(), float if at < 0 else np.float32) for x in table.column("part"))
    out = next(parts).astype(float)
    for p in parts:
        out += p
    return pa.table({"slice": pa.array([at], pa.int32()), "part": pa.array([out.tobytes()], pa.binary())})


class Blocks:
    """The rows of some splits as blocks of gram counts, with the weight that
    each split gives to each gram.

    ``data`` has per block ``id, y_true, label, weight, train, test`` as
    arrays, the counts by row (``ptr, idx, tf``) and by gram (``grams, starts,
    rows, by_gram``), and per split and vocabulary one over the length of each
    row (``norm``). ``idf[split]`` is 0 for a gram outside its vocabulary.
    """

    def __init__(self, data: DataFrame, idf: np.ndarray, parts: list[tuple[int, int]], labels: list[str]):
        self.data, self.idf, self.parts, self.labels = stored(data, "blocks"), idf, parts, labels
        self.width = idf.shape[1]
        cores = data.sparkSession.sparkContext.defaultParallelism
        # A task sends one set of sums, so there are no more tasks than cores.
        self.steps, self.steps_at_once = self.data.drop("id", "y_true", "test").coalesce(cores), cores
        self.classes = {}

    def _shared(self, problems: list[Problem], found: list[tuple[np.ndarray, np.ndarray]]):
        """Coefficients times gram weights, one column per class of a problem."""
        k = len(self.labels)
        dense, bias = np.zeros((self.width, len(problems) * k), np.float32), np.zeros(len(problems) * k, np.float32)
        for i, (p, (w, b)) in enumerate(zip(problems, found, strict=True)):
            dense[:, i * k : (i + 1) * k] = (w * self.idf[p.split]).T
            bias[i * k : (i + 1) * k] = b
        if dense.shape[1] <= NARROW:
            dense = np.asfortranarray(dense)
        return self.data.sparkSession.sparkContext.broadcast((dense, bias))

    def sums(self, problems: list[Problem], found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Losses and residual sums per column, and gradients, over the rows
        to learn from."""
        k = len(self.labels)
        shared = self._shared(problems, found)
        made = self.steps.mapInArrow(_gradients(problems, shared, k, self.parts, self.width), "slice int, part binary")
        # Small sums of the tasks are added here, which saves a shuffle a step.
        if self.steps_at_once * self.width * len(problems) * k * 4 > DIRECT:
            made = made.groupBy("slice").applyInArrow(_added, "slice int, part binary")
            got = {r["slice"]: r["part"] for r in made.collect()}
        else:
            parts: dict[int, list[bytes]] = {}
            for r in made.collect():
                parts.setdefault(r["slice"], []).append(r["part"])
            got = {at: sum(np.frombuffer(x, float if at < 0 else np.float32).astype(float) for x in own).tobytes() for at, own in parts.items()}
        shared.destroy()
        losses, residuals = np.frombuffer(got.pop(-1)).reshape(2, -1)
        total = np.concatenate([np.frombuffer(got[i]) for i in sorted(got)]) if got else np.zeros(0)
        total = total.reshape(self.width, -1).T.copy()
        for i, p in enumerate(problems):
            total[i * k : (i + 1) * k] *= self.idf[p.split]
        return losses, residuals, total

    def _totals(self, p: Problem) -> np.ndarray:
        """Weight of each class among the rows a problem learns from."""
        key = (p.split, p.weighted)
        if not self.classes:
            each = F.explode(F.arrays_zip("label", "weight", "train"))
            seen = self.data.select(each.alias("r")).select("r.*").groupBy("train", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("w"))
            rows = seen.collect()
            for split in range(len(self.idf)):
                for weighted in (False, True):
                    own = np.zeros(len(self.labels))
                    for r in rows:
                        if r["train"] >> split & 1:
                            own[int(r["label"])] += r["w"] if weighted else r["n"]
                    self.classes[split, weighted] = own
        return self.classes[key]

    def fit(self, problems: list[Problem]) -> list[tuple[np.ndarray, np.ndarray]]:
        """``(weights, intercepts)`` of each problem, a line per class."""
        # Kept near the executors for the passes; what does not fit goes to their disks.
        self.steps.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._fit(problems)
        finally:
            self.steps.unpersist()

    def _fit(self, problems: list[Problem]) -> list[tuple[np.ndarray, np.ndarray]]:
        k = len(self.labels)
        found: list = [None] * len(problems)
        counted = [i for i, p in enumerate(problems) if not p.steps]
        iterated = [i for i, p in enumerate(problems) if p.steps]
        per = max(1, COLUMNS // k)
        for lo in range(0, len(counted), per):
            own = counted[lo : lo + per]
            _, n, sums = self.sums([problems[i] for i in own], [(np.zeros((k, self.width)), np.zeros(k)) for _ in own])
            for j, i in enumerate(own):
                p, at = problems[i], slice(j * k, (j + 1) * k)
                found[i] = _bayes(p, n[at], sums[at], self.idf[p.split] > 0)
        per = min(per, self._at_once([problems[i] for i in iterated]))
        for lo in range(0, len(iterated), per):
            own = iterated[lo : lo + per]
            for i, solution in zip(own, self._descend([problems[i] for i in own]), strict=True):
                found[i] = solution
        return found

    def _at_once(self, problems: list[Problem]) -> int:
        """How many problems the driver descends side by side: their state
        follows the vocabulary, and a pass costs what its columns do."""
        longest = max((np.count_nonzero(self.idf[p.split]) + 1 for p in problems), default=1)
        # Past steps and slopes as float, two points and slopes, and two more on the way.
        each = len(self.labels) * longest * (MEMORY * 2 * 4 + 6 * 8)
        return max(1, STATE // each)

    def _descend(self, problems: list[Problem]) -> list[tuple[np.ndarray, np.ndarray]]:
        """All problems by L-BFGS, one aggregate for the next point of each."""
        k = len(self.labels)
        known = [np.flatnonzero(self.idf[p.split]) for p in problems]
        at = [(np.zeros((k, self.width)), np.zeros(k)) for _ in problems]
        # A softmax has one course for its classes, hinge losses one each.
        courses = {}
        for i, p in enumerate(problems):
            d = len(known[i])
            if p.kind == "softmax":
                start = np.zeros((k, d + 1))
                start[:, d] = np.log(np.maximum(self._totals(p), 1e-300))
                start[:, d] -= start[:, d].mean()
                courses[i, slice(0, k)] = descend(start.ravel(), p.steps, p.tolerance)
            else:
                for c in range(k):
                    courses[i, slice(c, c + 1)] = descend(np.zeros(d + 1), p.steps, p.tolerance)

        def place(i: int, lines: slice, x: np.ndarray) -> np.ndarray:
            x = x.reshape(lines.stop - lines.start, -1)
            at[i][0][lines, known[i]] = x[:, :-1]
            at[i][1][lines] = x[:, -1]
            return x

        points = {key: place(*key, next(course)) for key, course in courses.items()}
        while points:
            active = sorted({i for i, _ in points})
            losses, residuals, total = self.sums([problems[i] for i in active], [at[i] for i in active])
            for (i, lines), x in list(points.items()):
                p, j = problems[i], active.index(i) * k
                n = self._totals(p).sum()
                own = slice(j + lines.start, j + lines.stop)
                w = x[:, :-1]
                f = losses[own].sum() / n + p.reg / 2 * (w * w).sum()
                slope = np.column_stack([total[own][:, known[i]] / n + p.reg * w, residuals[own] / n])
                try:
                    points[i, lines] = place(i, lines, courses[i, lines].send((f, slope.ravel())))
                except StopIteration as end:
                    place(i, lines, end.value)
                    del points[i, lines]
        for i, p in enumerate(problems):
            if p.kind == "softmax":
                at[i][1][:] -= at[i][1].mean()
        return at

    def judged(self, problem: Problem, found: tuple[np.ndarray, np.ndarray], part: str = "test") -> DataFrame:
        """The rows of one part of the split, with ``y_pred``, ``margins`` and,
        but for hinge losses, ``proba``."""
        shared = self._shared([problem], [found])
        labels, parts, split = self.labels, self.parts, problem.split
        kinds = {f.name: f.dataType.elementType for f in self.data.select("id", "y_true", "label", "weight").schema}
        proba = problem.kind != "hinge"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dense, bias = shared.value
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    own = np.flatnonzero(np.array(row[part], np.int64) >> split & 1)
                    z = _margins(row, dense, bias, parts, np.repeat(split, len(labels)))[own].astype(float)
                    keep = [batch.column(batch.schema.names.index(c))[at].values.take(pa.array(own)) for c in kinds]
                    best = pa.array([labels[i] for i in z.argmax(1)], pa.string())
                    e = np.exp(z - z.max(1, keepdims=True)) if len(z) else z
                    shares = [pa.array(list(e / e.sum(1, keepdims=True)), pa.list_(pa.float64()))] if proba else []
                    yield pa.RecordBatch.from_arrays(
                        [*keep, best, *shares, pa.array(list(z), pa.list_(pa.float64()))],
                        names=[*kinds, "y_pred", *(["proba"] if proba else []), "margins"],
                    )

        schema = ", ".join([*(f"{c} {t.simpleString()}" for c, t in kinds.items()), "y_pred string", *(["proba array<double>"] if proba else []), "margins array<double>"])
        return self.data.drop("train" if part == "test" else "test", "grams", "starts", "rows", "by_gram").mapInArrow(run, schema)

    def confusions(self, problems: list[Problem], found: list[tuple[np.ndarray, np.ndarray]], parts: tuple[str, ...] = ("test",)) -> DataFrame:
        """``(problem, part, y_true, y_pred, n)`` for all problems, from one reading."""
        k, labels, ranges = len(self.labels), self.labels, self.parts
        out = []
        per = max(1, COLUMNS // k)
        for lo in range(0, len(problems), per):
            own = problems[lo : lo + per]
            shared = self._shared(own, found[lo : lo + per])
            places = np.repeat([p.split for p in own], k)

            def run(batches: Iterator[pa.RecordBatch], own=own, shared=shared, places=places, lo=lo) -> Iterator[pa.RecordBatch]:
                dense, bias = shared.value
                cells = np.zeros((len(own), len(parts), k, k), np.int64)
                for batch in batches:
                    for row in batch.to_pylist():
                        z, label = _margins(row, dense, bias, ranges, places), np.array(row["label"], int)
                        for i, p in enumerate(own):
                            best = z[:, i * k : (i + 1) * k].argmax(1)
                            for j, part in enumerate(parts):
                                inside = (np.array(row[part], np.int64) >> p.split & 1).astype(bool)
                                np.add.at(cells[i, j], (label[inside], best[inside]), 1)
                i, j, a, b = np.nonzero(cells)
                yield pa.RecordBatch.from_pydict(
                    {
                        "problem": pa.array(i + lo, pa.int32()), "part": pa.array([parts[x] for x in j], pa.string()),
                        "y_true": pa.array([labels[x] for x in a], pa.string()), "y_pred": pa.array([labels[x] for x in b], pa.string()),
                        "n": pa.array(cells[i, j, a, b], pa.int64()),
                    }
                )

            slim = self.data.select("label", *parts, "ptr", "idx", "tf", "norm")
            out.append(slim.mapInArrow(run, "problem int, part string, y_true string, y_pred string, n bigint"))
        whole = out[0]
        for other in out[1:]:
            whole = whole.unionByName(other)
        return whole.groupBy("problem", "part", "y_true", "y_pred").agg(F.sum("n").alias("n"))


def _bayes(p: Problem, n: np.ndarray, sums: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms as in MLlib; the complement of a class speaks against it."""
    if p.kind == "complement":
        sums = sums.sum(0) - sums
    theta = np.log(sums + p.reg) - np.log(sums.sum(1) + known.sum() * p.reg)[:, None]
    theta = np.where(known, theta, 0)
    if p.kind == "complement":
        return -theta, np.zeros(len(n))
    return theta, np.log(n + p.reg) - np.log(n.sum() + len(n) * p.reg)


# -- descent ------------------------------------------------------------------------------


def descend(x: np.ndarray, steps: int, tolerance: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Minimise by L-BFGS: yields points, is sent value and slope, returns the
    last point. It ends as MLlib's fits do: when twenty steps gain less than
    ``tolerance`` of the first value, or the slope is as small as that."""
    f, g = yield x
    first, values, pairs = abs(f), [f], []
    for _ in range(steps):
        if np.linalg.norm(g) <= max(tolerance * abs(f), 1e-8):
            return x
        d = _direction(g, pairs)
        slope = float(g @ d)
        if slope >= 0:
            pairs, d = [], -g
            slope = float(g @ d)
        low, high, t = 0.0, np.inf, 1.0 if pairs else 1 / np.linalg.norm(g)
        best = None
        for _ in range(20):  # bisection for a sufficient fall and a flatter slope
            there = x + t * d
            f2, g2 = yield there
            if f2 > f + 1e-4 * t * slope:
                high = t
            else:
                best = (there, f2, g2)
                if g2 @ d >= 0.9 * slope:
                    break
                low = t
            t = (low + high) / 2 if np.isfinite(high) else 2 * low
        if best is None:
            return x
        there, f, new = best
        s, y = there - x, new - g
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs[1 - MEMORY :], (s.astype(np.float32), y.astype(np.float32), 1 / float(s @ y))]
        x, g = there, new
        values = [*values[-19:], f]
        if max(values) - f <= tolerance * first:
            return x
    return x


def _direction(g: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    q, shares = g.copy(), []
    for s, y, rho in reversed(pairs):
        shares.append(rho * float(s @ q))
        q -= shares[-1] * y
    if pairs:
        s, y, rho = pairs[-1]
        q /= rho * float(y @ y)
    for (s, y, rho), a in zip(pairs, reversed(shares), strict=True):
        q += (a - rho * float(y @ q)) * s
    return -q


# -- packing -----------------------------------------------------------------------------------


def packer(shared: list, names: list[str], kept: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Turns rows of ``(gram hash, count)`` arrays into blocks. ``shared``
    holds per vocabulary its sorted hashes, the gram weights of each split,
    and whether counts are dampened."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, index, value, norms, width = [], [], [], [], 0
            for (terms, sublinear), name in zip(shared, names, strict=True):
                hashes, idf = terms.value
                column = batch.column(batch.schema.names.index(name))
                flat = column.flatten()
                gram, n = flat.field("h").to_numpy(), flat.field("n").to_numpy().astype(np.float32)
                r = np.repeat(np.arange(batch.num_rows), column.value_lengths().to_numpy())
                at = np.minimum(np.searchsorted(hashes, gram), max(len(hashes) - 1, 0))
                known = hashes[at] == gram if len(hashes) else np.zeros(len(gram), bool)
                r, at, n = r[known], at[known], n[known]
                if sublinear:
                    n = 1 + np.log(n)
                squares = np.stack([np.bincount(r, (n * own[at]) ** 2, batch.num_rows) for own in idf], axis=1)
                norms.append(np.divide(1, np.sqrt(squares), out=np.zeros_like(squares), where=squares > 0))
                row.append(r)
                index.append(at + width)
                value.append(n)
                width += len(hashes)
            row, index, value = (np.concatenate(x) for x in (row, index, value))
            order = np.lexsort((index, row))
            row, index, value = row[order], index[order].astype(np.int32), value[order].astype(np.float32)
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=batch.num_rows))))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + CHUNK, "right")) - 1)
                a, b = ends[lo], ends[hi]
                idx, tf, rows = index[a:b], value[a:b], (row[a:b] - lo).astype(np.int32)
                by = np.argsort(idx, kind="stable")
                grams, starts = np.unique(idx[by], return_index=True)
                blobs = {
                    "ptr": (ends[lo : hi + 1] - a).astype(np.int64), "idx": idx, "tf": tf, "grams": grams.astype(np.int32),
                    "starts": starts.astype(np.int64), "rows": rows[by], "by_gram": tf[by],
                    "norm": np.stack([n[lo:hi] for n in norms]).astype(np.float32),
                }
                own = batch.slice(lo, hi - lo)
                arrays = [pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), own.column(own.schema.names.index(c))) for c in kept]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, *(pa.array([x.tobytes()], pa.binary()) for x in blobs.values())], names=[*(c.lstrip("_") for c in kept), *blobs]
                )
                lo = hi

    return pack
