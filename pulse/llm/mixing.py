"""Mixing to target weights with soft domain membership.

DataFrame expressions and aggregates only.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.common import packed
from pulse.llm.evidence import BINS, MARKER_CUTS, bare, let, log_evidence, log_likelihoods, text_bins, words_of
from pulse.llm.registry import query, read
from pulse.session import stored

SAMPLE_ROWS = 20_000
MARKERS = 48
MARKER_DOCS = 5
CLOSE = 1e-6
GAIN = 0.01
STEPS = 60
LENGTHS = [1.0, 0.5, 0.2, 0.05]


@dataclass
class Domains:
    """A naive Bayes classifier of domains: marker words, bin likelihoods, shares."""

    names: list[str]
    markers: dict[str, list[str]]
    logs: dict = field(default_factory=dict)
    shares: dict[str, float] = field(default_factory=dict)

    def bins(self, text: str) -> Column:
        return text_bins(text, [self.markers[d] for d in self.names])


def marker_words(texts: DataFrame, names: list[str]) -> dict[str, list[str]]:
    """Per domain the words whose document counts speak most for it.

    ``texts`` holds ``domain`` and ``_words`` of a bounded labelled sample;
    a word weighs by its documents in the domain times the logarithm of its
    odds against the other domains.
    """
    sizes = {r.domain: r.n for r in texts.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    seen = texts.select("domain", F.explode(F.array_distinct(bare(F.col("_words")))).alias("w")).where("w <> ''")
    counts = seen.groupBy("w").agg(*[F.count_if(F.col("domain") == d).alias(f"c{k}") for k, d in enumerate(names)])
    counts = stored(counts.where(" + ".join(f"c{k}" for k in range(len(names))) + f" >= {MARKER_DOCS}"), "markers")
    whole, out = sum(sizes.values()), {}
    for k, d in enumerate(names):
        mine, rest = sizes.get(d, 0), whole - sizes.get(d, 0)
        others = sum((F.col(f"c{j}") for j in range(len(names)) if j != k), F.lit(0))
        odds = F.log(((F.col(f"c{k}") + 0.5) / (mine + 1)) / ((others + 0.5) / (rest + 1)))
        top = counts.select("w", (F.col(f"c{k}") * odds).alias("g"), odds.alias("o")).where("o > 1")
        out[d] = [r.w for r in top.orderBy(F.desc("g"), "w").limit(MARKERS).collect()]
    return out


def learn_domains(
    df: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> Domains:
    """A classifier from ``labelled`` (id, ``domain``).

    It is fitted on the first ``sample_rows`` labelled ids in hash order, a
    bounded sample whose ids are broadcast; rows that repeat an id all count.
    """
    known = labelled.where(F.col(id_col).isNotNull() & F.col("domain").isNotNull())
    known = known.groupBy(id_col).agg(F.min("domain").alias("domain"))
    known = stored(known.orderBy(F.xxhash64(id_col, F.lit("mix")), id_col).limit(sample_rows), "sample")
    names = [r.domain for r in known.select("domain").distinct().orderBy("domain").collect()]
    texts = df.select(id_col, text).join(F.broadcast(known), id_col)
    words = texts.select("domain", words_of(F.coalesce(F.col(text), F.lit(""))).alias("_words"))
    domains = Domains(names, marker_words(words, names) if names else {})
    if names:
        columns = {k: len(v) + 1 for k, v in BINS.items()}
        columns |= {f"m{k}": len(MARKER_CUTS) + 1 for k in range(len(names))}
        rows = stored(texts.select("domain", domains.bins(text).alias("_f")), "mixing-sample")
        domains.logs, domains.shares = log_likelihoods(rows, "domain", names, columns)
    return domains


def with_posteriors(df: DataFrame, domains: Domains, text: str = "text") -> DataFrame:
    """Add ``_t`` (words of the text, its tokens here) and ``_p``, the
    posterior of each domain in the order of their names."""

    def posteriors(f: Column) -> Column:
        logs = F.array(*[log_evidence(f, domains.logs, d) + math.log(domains.shares[d]) for d in domains.names])
        total = lambda e: F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
        parts = let(logs, lambda x: let(F.array_max(x), lambda top: F.transform(x, lambda v: F.exp(v - top))))
        return let(parts, lambda e: let(total(e), lambda s: F.transform(e, lambda x: x / s)))

    found = let(domains.bins(text), lambda f: F.struct(f["n"].alias("t"), posteriors(f).alias("p")))
    return df.withColumn("_m", found).select(*df.columns, F.col("_m.t").alias("_t"), F.col("_m.p").alias("_p"))


@dataclass
class Rates:
    """What turns posteriors into a rate: a start and the steps taken.

    A step is a vector over the domains; a document moves by its product with
    the document's ``features`` (the posteriors, or their excess over what the
    ``whole`` domain allows). ``residual`` is the largest miss as a share of
    the tokens asked for, ``met`` whether it is within the tolerance.
    """

    start: float
    steps: list[list[float]]
    totals: dict[str, float]
    cap: float | None = None
    ratios: list[float] | None = None
    whole: int | None = None
    residual: float = 0.0
    met: bool = True

    def features(self, p: Column) -> list[Column]:
        parts = [F.get(p, F.lit(i)) for i in range(len(self.totals))]
        if self.whole is None:
            return parts
        return [x - F.lit(float(r)) * parts[self.whole] for x, r in zip(parts, self.ratios, strict=True)]

    def inside(self, x: Column) -> Column:
        least = F.greatest(F.lit(0.0), x)
        return least if self.cap is None else F.least(F.lit(self.cap), least)

    def column(self, p: str = "_p") -> Column:
        if not self.steps:
            return F.lit(self.start)
        moves = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in self.steps])

        def dot(s: Column, q: Column) -> Column:
            return F.aggregate(F.zip_with(s, q, lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)

        def walk(q: Column) -> Column:
            return F.aggregate(moves, F.lit(self.start), lambda x, s: self.inside(x + dot(s, q)))

        return let(F.array(*self.features(F.col(p))), walk)


def fit_rates(
    rows: DataFrame,
    names: list[str],
    targets: dict[str, float],
    budget: float | None = None,
    whole: str | None = None,
    steps: int = STEPS,
) -> Rates:
    """Nonnegative rates ``x`` of the documents so that the expected tokens of
    each domain, ``sum x * t * p``, match ``budget`` times its target share.

    With ``whole``, rates start at one and never exceed it, and each other
    domain keeps at most as many expected tokens as its target allows beside
    what the whole domain then has; a domain with less is left as it is.

    Projected gradient for least squares: the gradient of a document is its
    features times the residual of the domains, and a rate outside its bounds
    is put back on them. A step weighs the residual with the inverse second
    moments of the documents that are free to move along the gradient, or of
    all, at several lengths; the one that leaves the least residual is taken.
    It ends when the residual is below ``CLOSE`` of the tokens asked for, or
    when no step lowers it by ``GAIN`` of itself, or after ``steps`` (targets
    out of reach or nearly so), which ``met`` and a warning tell. A step takes two aggregates over all documents, of which the driver
    sees a few numbers per domain.
    """
    k = len(names)
    p = [F.get("_p", F.lit(i)) for i in range(k)]
    sums = rows.agg(F.sum("_t").cast("double"), *[F.sum(F.col("_t") * p[i]) for i in range(k)]).first()
    tokens = sums[0] or 0.0
    if not tokens or not k:
        return Rates(1.0, [], {})
    totals = dict(zip(names, map(float, sums[1:]), strict=True))
    share = np.array([max(0.0, targets.get(d, 0.0)) for d in names])
    share = share / share.sum() if share.sum() else np.full(k, 1.0 / k)
    if whole is None:
        want = share * (tokens if budget is None else budget)
        rates = Rates(float(want.sum() / tokens), [], totals)
    else:
        w = names.index(whole)
        ratios = share / share[w]
        ratios[w] = 1.0  # no feature of its own
        want, rates = np.zeros(k), Rates(1.0, [], totals, 1.0, ratios.tolist(), w)
    scale = float(want.sum()) if whole is None else tokens
    bound = np.full(k, whole is None)  # domains whose total is asked for

    def moments(x: Column, toward: np.ndarray) -> np.ndarray:
        q = [F.get("_q", F.lit(i)) for i in range(k)]
        slope = sum((q[i] * F.lit(float(toward[i])) for i in range(k)), F.lit(0.0))
        free = (F.col("_x") > 0) | (slope > 0)
        if rates.cap is not None:
            free &= (F.col("_x") < rates.cap) | (slope < 0)
        at = rows.select("_t", F.array(*rates.features(F.col("_p"))).alias("_q"), x.alias("_x"))
        pairs = [(i, j) for i in range(k) for j in range(i + 1)]
        cells = [F.col("_t") * q[i] * q[j] for i, j in pairs]
        got = at.agg(*[F.sum(c) for c in cells], *[F.sum(F.when(free, c)) for c in cells]).first()
        grams = np.zeros((2, k, k))
        for n, v in enumerate(got):
            i, j = pairs[n % len(pairs)]
            grams[n // len(pairs), i, j] = grams[n // len(pairs), j, i] = v or 0.0
        return grams

    def totals_after(moves: list[np.ndarray]) -> np.ndarray:
        at = rows.select("_t", F.array(*rates.features(F.col("_p"))).alias("_q"), rates.column().alias("_x"))
        q = [F.get("_q", F.lit(i)) for i in range(k)]
        cells = []
        for s in moves:
            x = rates.inside(F.col("_x") + sum((q[i] * F.lit(float(s[i])) for i in range(k)), F.lit(0.0)))
            cells += [F.sum(F.col("_t") * x * q[i]) for i in range(k)]
        return np.array([float(v) for v in at.agg(*cells).first()]).reshape(len(moves), k)

    def missing(got: np.ndarray) -> np.ndarray:
        return np.where(bound, want - got, 0.0)

    got = totals_after([np.zeros(k)])[0]
    for _ in range(steps):
        bound |= got > want + CLOSE * scale
        miss = missing(got)
        rates.residual = float(np.abs(miss).max() / scale)
        if rates.residual <= CLOSE:
            break
        tries = []
        for gram in moments(rates.column(), miss):
            asked = np.where(np.outer(bound, bound), gram, 0.0)
            move = np.linalg.pinv(asked + 1e-12 * np.trace(asked) * np.eye(k)) @ miss
            tries += [length * np.where(bound, move, 0.0) for length in LENGTHS]
        after = totals_after(tries)
        best = min(range(len(tries)), key=lambda n: float(np.linalg.norm(missing(after[n]))))
        if np.linalg.norm(missing(after[best])) >= (1 - GAIN) * np.linalg.norm(miss):
            break
        rates.steps.append(tries[best].tolist())
        got = after[best]
    rates.residual = float(np.abs(missing(got)).max() / scale)
    rates.met = rates.residual <= CLOSE
    if not rates.met:
        warnings.warn(f"mixing misses its targets by {rates.residual:.2%} of the tokens asked for", stacklevel=2)
    return rates


def copies(rate: Column, *key: str, seed: int = 7) -> Column:
    """A whole number whose mean over documents is the rate: the part after
    the point is drawn by a hash of ``key``."""
    draw = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 30)) / (1 << 30)
    return let(rate, lambda x: (F.floor(x) + (draw < x - F.floor(x)).cast("long")).cast("int"))


def mix(
    df: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    id_col: str = "doc_id",
    text: str = "text",
    budget: float | None = None,
) -> DataFrame:
    """All rows of ``df`` without the text: ``tokens`` (words), ``posteriors``
    (a map by domain), ``rate`` and ``copies``, how often to take the row.

    ``labelled`` holds ids and their ``domain``, ``targets`` the wanted share
    of tokens of each domain, ``budget`` all tokens wanted, by default as many
    as there are. A domain without labels cannot be predicted and its target
    goes to the others. A text without words, NULL included, has no tokens
    and still gets a rate; without labels every rate is 1. Rows with equal
    ids and texts get equal copies. Input columns with an output's name are
    replaced; an empty table gives no rows.
    """
    made = ["tokens", "posteriors", "rate", "copies"]
    domains = learn_domains(df, labelled, id_col, text)
    rows = packed(df, [*made, text], _id=id_col, _text=text)
    if not domains.names:
        none = F.lit(None).cast("map<string,double>")
        rows = rows.withColumns({"tokens": text_bins("_text")["n"], "posteriors": none, "rate": F.lit(1.0), "copies": F.lit(1)})
        return rows.select("_in.*", *made)
    rows = stored(with_posteriors(rows, domains, "_text").drop("_text"), "posteriors")
    rates = fit_rates(rows, domains.names, targets, budget)
    names = F.array(*[F.lit(d) for d in domains.names])
    rows = rows.withColumns({"tokens": F.col("_t"), "posteriors": F.map_from_arrays(names, F.col("_p")), "rate": rates.column()})
    return rows.withColumn("copies", copies(F.col("rate"), "_id")).select("_in.*", *made)


def mix_rows(
    df: DataFrame,
    labelled: DataFrame,
    targets: dict[str, float],
    id_col: str = "doc_id",
    text: str = "text",
    whole: str | None = None,
) -> DataFrame:
    """The rows of ``df``, each as often as its ``copies`` say.

    With ``whole``, a domain with a target, no rate exceeds one: nothing is
    repeated, its documents stay at a rate of about one, and each other domain
    is thinned to its target beside them; one that is below its target stays
    as it is. Rates are fitted on ids, tokens and posteriors; the texts are
    judged again where they are read, so they are
    not shuffled.
    """
    domains = learn_domains(df, labelled, id_col, text)
    if not domains.names:
        return df
    slim = stored(with_posteriors(df.select(id_col, text), domains, text).drop(text), "posteriors")
    kept = whole if whole in domains.names and targets.get(whole) else None
    rates = fit_rates(slim, domains.names, targets, whole=kept)
    if whole is not None and kept is None:
        rates = Rates(1.0, [], {})
    rows = with_posteriors(packed(df, [], _id=id_col, _text=text), domains, "_text")
    rows = rows.withColumn("_copies", copies(rates.column(), "_id")).where("_copies > 0")
    if whole is None:
        rows = rows.withColumn("_copies", F.explode(F.sequence(F.lit(1), "_copies")))
    return rows.select("_in.*")


def label_domains(labels: DataFrame) -> DataFrame:
    """Domains of the labelled table: ``low`` quality, ``toxic``, else ``clean``."""
    kind = F.when(F.col("quality") == 0, "low").when(F.col("toxic") == 1, "toxic")
    known = labels.where("quality IS NOT NULL OR toxic IS NOT NULL")
    return known.select("doc_id", kind.otherwise("clean").alias("domain"))


TARGETS = {"clean": 0.94, "low": 0.03, "toxic": 0.03}


@query("op7_mixing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text")
    return mix(docs, label_domains(read(spark, folder, "labels")), TARGETS)
