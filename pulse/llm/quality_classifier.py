"""Quality classifier: hierarchical empirical Bayes over hosts and paths."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.common import SMALL_BYTES, packed
from pulse.llm.evidence import BINS, let, log_evidence, log_likelihoods, text_bins
from pulse.llm.registry import query, read
from pulse.session import stored

THRESHOLD = 0.25
LEAST, MOST = 1.0, 1e6


@dataclass
class Fit:
    """Evidence of the bins, the global share of good documents, and a table
    ``(host, path, host_rate, path_rate)`` of shrunken shares."""

    logs: dict
    share: float
    sites: DataFrame


def _evidence(logs: dict) -> Column:
    """Log odds of the bins in ``_f``; a text without words has none."""

    def odds(f: Column) -> Column:
        return F.when(f["n"] > 0, log_evidence(f, logs, "good") - log_evidence(f, logs, "bad")).otherwise(0.0)

    return let(F.col("_f"), odds)


def _strength(groups: DataFrame, share: float) -> float:
    """Prior counts that explain how far group means spread: the method of
    moments for a beta-binomial, from ``(n, s)`` per group."""
    p = share * (1 - share)
    mean = F.col("s") / F.col("n")
    row = groups.agg(F.sum("n"), F.sum(F.col("n") * (mean - share) * (mean - share)), F.count(F.lit(1))).first()
    if not row[0] or not row[1] or not p:
        return MOST
    spread = row[1] / row[0] - p * row[2] / row[0]
    return MOST if spread <= 0 else min(MOST, max(LEAST, p / spread - 1))


def fit(df: DataFrame, labels: DataFrame, id_col: str, text: str, host: str, path: str, quality: str) -> Fit:
    """Learn from all rows of ``df`` and all labels.

    1. Naive Bayes counts of the labelled rows give each document's evidence.
    2. A document's evidence and the global share give its expected goodness;
       labelled rows count as labelled. Summed by host and by path of a host.
    3. A host's share is shrunk to the global one, a path's to its host's,
       with as many prior counts as the spread between groups calls for. A
       site with few documents stays near its prior.

    Labels and documents meet as ids and bins, never as texts; the sums are
    partial in each task, so a host with a third of all rows does no harm.
    """
    cols = [F.col(id_col).alias("_id"), F.col(host).alias("_host"), F.col(path).alias("_path"), F.col(text).alias("_text")]
    bins = df.select(*cols).withColumn("_f", text_bins("_text")).drop("_text")
    known = labels.where(F.col(quality).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(quality).cast("int").alias("_good"))
    rows = stored(bins.join(known, "_id", "left"), "quality")

    label = F.when(F.col("_good") == 1, "good").otherwise("bad").alias("d")
    labelled = rows.where("_good IS NOT NULL AND _f.n > 0")
    logs, shares = log_likelihoods(labelled.select("*", label), "d", ["good", "bad"], {k: len(v) + 1 for k, v in BINS.items()})
    share = shares["good"]

    odds = F.log(F.lit(share / (1 - share)))
    guess = 1 / (1 + F.exp(-(_evidence(logs) + odds)))
    soft = rows.select("_host", "_path", F.coalesce(F.col("_good").cast("double"), guess).alias("g"))
    paths = stored(soft.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("n"), F.sum("g").alias("s")), "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    whole = hosts.agg(F.sum("s") / F.sum("n")).first()[0]
    base = min(max(whole if whole is not None else share, 1e-4), 1 - 1e-4)
    k1, k2 = _strength(hosts, base), _strength(paths, base)
    hosts = hosts.select(F.col("_host").alias("_h"), ((F.col("s") + k1 * base) / (F.col("n") + k1)).alias("host_rate"))
    sites = paths.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h")
    rate = (F.col("s") + k2 * F.col("host_rate")) / (F.col("n") + k2)
    return Fit(logs, share, stored(sites.select("_host", "_path", "host_rate", rate.alias("path_rate")), "sites"))


def judge(df: DataFrame, fitted: Fit, text: str, host: str, path: str, threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``evidence`` (log odds of the text alone), ``host_rate``,
    ``path_rate`` (prior shares), ``score`` (posterior) and ``kept``.

    Sites are joined as a broadcast when their counted size is small, else by
    a shuffle on host and path, in which Spark splits a hot host.
    """
    made = ["evidence", "host_rate", "path_rate", "score", "kept"]
    rows = packed(df, made, _f=text_bins(text), _host=host, _path=path)
    rows = rows.select("_in", "_host", "_path", _evidence(fitted.logs).alias("evidence"))
    sites = fitted.sites.withColumnsRenamed({"_host": "_h", "_path": "_p"})
    if sites.count() * 64 <= SMALL_BYTES:
        sites = F.broadcast(sites)
    on = F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_p"))
    joined = rows.join(sites, on, "left").drop("_h", "_p")
    prior = F.least(F.greatest(F.coalesce("path_rate", F.lit(fitted.share)), F.lit(1e-4)), F.lit(1 - 1e-4))
    score = 1 / (1 + F.exp(-(F.col("evidence") + let(prior, lambda p: F.log(p / (1 - p))))))
    return joined.withColumn("score", score).withColumn("kept", F.col("score") >= threshold).select("_in.*", *made)


def classify(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    quality: str = "quality",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """All rows of ``df`` with the columns of :func:`judge`.

    ``host`` and ``path`` name the levels of the hierarchy; documents without
    a path column take any finer grouping, here the language. Of several
    labels of an id the smallest counts; NULL labels and ids are not learnt
    from. A text without words has no evidence and gets its site's share as
    score. NULL hosts and paths form a site of their own. Without labels
    every evidence is 0, every score one half, and all rows are kept. Input columns with an
    output's name are replaced; repeated rows are judged alike; an empty
    table gives no rows.
    """
    return judge(df, fit(df, labels, id_col, text, host, path, quality), text, host, path, threshold)


@query("op6_quality_classifier")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents", "doc_id", "text", "source", "lang")
    labels = read(spark, folder, "labels", "doc_id", "quality")
    return classify(docs, labels).drop("text")
