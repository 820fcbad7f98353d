"""Evaluation of predictions: a predictions table in, a table out.

Nearly all figures follow from the confusion counts, which one pass over
the predictions yields; the rest is arithmetic on a handful of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions import fixed as X
from pulse.functions.text import error_category, linguistic_tags, snippet
from pulse.functions.values import bin_index
from pulse.operators.ranking import running_totals, seeded_sample, top_k


def ratio(a: Column, b: Column) -> Column:
    """Division that is 0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, labels: list[str] = X.LABELS, true: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Counts for the whole label grid, and each count's share of its row."""
    cells = [(a, b) for a in labels for b in labels]
    one = df.agg(
        F.array(*[F.count_if((F.col(true) == a) & (F.col(pred) == b)) for a, b in cells]).alias("n")
    )
    grid = F.array(*[F.struct(F.lit(a).alias("y_true"), F.lit(b).alias("y_pred")) for a, b in cells])
    rows = one.select(F.explode(F.arrays_zip(grid.alias("g"), F.col("n"))).alias("z")).select(
        "z.g.y_true", "z.g.y_pred", F.col("z.n").alias("n")
    )
    whole = F.sum("n").over(Window.partitionBy("y_true"))
    return rows.withColumn("row_share", ratio(F.col("n"), whole))


def per_class(conf: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support of each class; 0 where undefined."""
    keys = keys or []
    sides = conf.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("y_true").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
                F.struct(F.col("y_pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
            )
        ).alias("s"),
        (F.col("y_true") == F.col("y_pred")).alias("same"),
    )
    totals = sides.groupBy(*keys, F.col("s.label").alias("label")).agg(
        F.sum("s.support").alias("support"),
        F.sum("s.predicted").alias("predicted"),
        F.sum(F.when(F.col("same"), F.col("s.support")).otherwise(F.lit(0))).alias("tp"),
    )
    p, r = ratio(F.col("tp"), F.col("predicted")), ratio(F.col("tp"), F.col("support"))
    scored = totals.withColumns({"precision": p, "recall": r})
    return scored.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def metrics(conf: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Accuracy, macro and weighted scores, from confusion counts.

    A class that is neither true nor predicted anywhere has no say.
    """
    keys = keys or []
    total = F.sum("support")
    seen = per_class(conf, keys).where((F.col("support") > 0) | (F.col("predicted") > 0))
    return seen.groupBy(*keys).agg(
        (F.sum("tp") / total).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("precision") * F.col("support")) / total).alias("weighted_precision"),
        (F.sum(F.col("recall") * F.col("support")) / total).alias("weighted_recall"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("weighted_f1"),
        total.alias("n"),
    )


def lift(scores: DataFrame, baseline: DataFrame) -> DataFrame:
    """Scores next to a one-row baseline, with the gains."""
    b = baseline.select(F.struct("accuracy", "macro_f1")).scalar()
    return scores.withColumns(
        {
            "baseline_accuracy": b["accuracy"],
            "baseline_macro_f1": b["macro_f1"],
            "lift_accuracy": F.round(F.col("accuracy") - b["accuracy"], 4),
            "lift_macro_f1": F.round(F.col("macro_f1") - b["macro_f1"], 4),
        }
    )


def agreement(conf: DataFrame) -> DataFrame:
    """Cohen's kappa and the multiclass correlation coefficient."""
    c = per_class(conf).agg(
        F.sum(F.col("support").cast("double")).alias("s"),
        F.sum(F.col("tp").cast("double")).alias("c"),
        F.sum(F.col("support").cast("double") * F.col("predicted")).alias("tp"),
        F.sum(F.col("support").cast("double") * F.col("support")).alias("tt"),
        F.sum(F.col("predicted").cast("double") * F.col("predicted")).alias("pp"),
    )
    s, hit, tp, tt, pp = (F.col(x) for x in ("s", "c", "tp", "tt", "pp"))
    expected = tp / (s * s)
    return c.select(
        F.try_divide(hit / s - expected, 1 - expected).alias("kappa"),
        ratio(hit * s - tp, F.sqrt((s * s - pp) * (s * s - tt))).alias("mcc"),
    )


def taxonomy(df: DataFrame, labels: list[str] = X.LABELS) -> DataFrame:
    """Per class: error counts, scores, mean confidence of hits and misses."""
    rows = []
    for i, name in enumerate(labels):
        t, p = F.col("y_true") == name, F.col("y_pred") == name
        conf = F.get(F.col("proba"), i)
        rows.append(
            F.struct(
                F.lit(name).alias("label"),
                F.count_if(t).alias("support"),
                F.count_if(t & p).alias("tp"),
                F.count_if(~t & p).alias("fp"),
                F.count_if(t & ~p).alias("fn"),
                F.coalesce(F.avg(F.when(t & p, conf)), F.lit(0.0)).alias("avg_conf_tp"),
                F.coalesce(F.avg(F.when(t & ~p, conf)), F.lit(0.0)).alias("avg_conf_fn"),
            )
        )
    flat = df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    out = flat.withColumns({"precision": p, "recall": r})
    return out.withColumns(
        {
            "f1": ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
            "conf_gap": F.col("avg_conf_tp") - F.col("avg_conf_fn"),
        }
    )


def error_pairs(conf: DataFrame) -> DataFrame:
    """Confusion pairs with their share of all errors and of their class."""
    wrong = F.col("y_true") != F.col("y_pred")
    errors = F.sum(F.when(wrong, F.col("n"))).over(Window.partitionBy())
    whole = F.sum("n").over(Window.partitionBy("y_true"))
    return (
        conf.withColumns({"_e": errors, "_w": whole})
        .where(wrong & (F.col("n") > 0))
        .select(
            "y_true",
            "y_pred",
            "n",
            F.round(F.col("n") * 100.0 / F.col("_e"), 1).alias("pct_of_errors"),
            F.round(F.col("n") * 100.0 / F.col("_w"), 1).alias("pct_of_class"),
        )
    )


def errors(df: DataFrame) -> DataFrame:
    return df.where(F.col("y_true") != F.col("y_pred"))


def error_sample(df: DataFrame, n: int = 20, seed: int = 42) -> DataFrame:
    """A seeded sample of errors with snippet and likely cause."""
    picked = seeded_sample(errors(df), "id", n, seed)
    return picked.select(
        "id", snippet("text").alias("snippet"), "y_true", "y_pred", error_category("y_true", "y_pred", "text").alias("category")
    )


def confident_errors(df: DataFrame, k: int = 20) -> DataFrame:
    """The errors the model was surest of."""
    wrong = errors(df).withColumn("confidence", F.array_max("proba"))
    best = top_k(wrong, [F.desc("confidence"), F.col("id")], k)
    return best.select("id", "y_true", "y_pred", F.round("confidence", 4).alias("confidence"), F.substring("text", 1, 120).alias("text"))


def error_tags(df: DataFrame) -> DataFrame:
    """Share of errors that show each linguistic pattern."""
    wrong = errors(df)
    total = wrong.agg(F.count(F.lit(1))).scalar()
    tagged = wrong.select(F.explode(linguistic_tags("text")).alias("tag"))
    return tagged.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "share", F.round(F.col("n") / total, 4)
    )


def _score_counts(df: DataFrame, labels: list[str]) -> DataFrame:
    """Positives and negatives per class and distinct score, one-vs-rest,
    with the totals above each score. Equal scores are one row."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("label"),
                (-F.get(F.col("proba"), i)).alias("neg_score"),
                (F.col("y_true") == c).cast("long").alias("hit"),
            )
            for i, c in enumerate(labels)
        ]
    )
    counts = (
        df.select(F.explode(rows).alias("r"))
        .groupBy("r.label", "r.neg_score")
        .agg(F.sum("r.hit").alias("pos"), F.sum(1 - F.col("r.hit")).alias("neg"))
    )
    return running_totals(counts, "neg_score", ["pos", "neg"], ["label"], few_groups=True)


def roc(df: DataFrame, labels: list[str] = X.LABELS) -> DataFrame:
    """ROC points: one per distinct score of a class."""
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    return _score_counts(df, labels).select(
        "label",
        (-F.col("neg_score")).alias("threshold"),
        ratio(tp, F.col("pos_total")).alias("tpr"),
        ratio(fp, F.col("neg_total")).alias("fpr"),
    )


def precision_recall(df: DataFrame, labels: list[str] = X.LABELS) -> DataFrame:
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    return _score_counts(df, labels).select(
        "label",
        (-F.col("neg_score")).alias("threshold"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, F.col("pos_total")).alias("recall"),
    )


def ranking_scores(df: DataFrame, labels: list[str] = X.LABELS) -> DataFrame:
    """Area under the ROC curve and average precision of each class."""
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    wins = F.col("neg") * (F.col("pos_before") + F.col("pos") / 2.0)
    return (
        _score_counts(df, labels)
        .groupBy("label")
        .agg(
            F.try_divide(F.sum(wins), F.max("pos_total").cast("double") * F.max("neg_total")).alias("auc"),
            F.try_divide(F.sum(F.col("pos") * ratio(tp, tp + fp)), F.max("pos_total")).alias("average_precision"),
        )
    )


def bootstrap_ci(conf: DataFrame, n: int = 1000, seed: int = 42, alpha: float = 0.05) -> DataFrame:
    """Percentile interval of accuracy and macro-F1.

    Resampling rows and counting the confusion cells is one multinomial draw
    of the cells, so replicates never touch the predictions again.
    """
    cells = conf.agg(F.sort_array(F.collect_list(F.struct("y_true", "y_pred", "n"))).alias("cells"))
    reps = cells.select("cells", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("rep"))

    def draw(batches):
        for pdf in batches:
            out = []
            for cell, rep in zip(pdf["cells"], pdf["rep"]):
                counts = np.array([c["n"] for c in cell], dtype="int64")
                names = sorted({c["y_true"] for c in cell} | {c["y_pred"] for c in cell})
                rng = np.random.default_rng([seed, int(rep)])
                drawn = rng.multinomial(counts.sum(), counts / counts.sum())
                grid = np.zeros((len(names), len(names)))
                for c, d in zip(cell, drawn):
                    grid[names.index(c["y_true"]), names.index(c["y_pred"])] = d
                hit, rows, cols = np.diag(grid), grid.sum(1), grid.sum(0)
                seen = (rows + cols) > 0
                f1 = np.divide(2 * hit, rows + cols, out=np.zeros(len(names)), where=seen)
                out.append((int(rep), hit.sum() / grid.sum(), f1[seen].mean()))
            yield pd.DataFrame(out, columns=["rep", "accuracy", "macro_f1"])

    runs = reps.repartition(8).mapInPandas(draw, "rep long, accuracy double, macro_f1 double")
    long = runs.unpivot(["rep"], ["accuracy", "macro_f1"], "metric", "score")
    ordered = long.groupBy("metric").agg(F.sort_array(F.collect_list("score")).alias("s"))
    lo, hi = int(alpha / 2 * n), min(n - 1, int((1 - alpha / 2) * n))
    total = F.aggregate("s", F.lit(0.0), lambda a, x: a + x)
    return ordered.select(
        "metric", (total / n).alias("mean"), F.get("s", lo).alias("lower"), F.get("s", hi).alias("upper")
    )


def calibration_bins(df: DataFrame, bins: int = 10) -> DataFrame:
    """Bins ``(lo, hi]`` of the top probability with accuracy and mean."""
    conf = F.array_max("proba")
    edges = F.array(*[F.lit(float(e)) for e in np.linspace(0, 1, bins + 1)])
    rows = df.select(
        conf.alias("conf"),
        (F.col("y_true") == F.col("y_pred")).cast("double").alias("ok"),
        F.size(F.filter(edges, lambda e: e < conf)).alias("bin"),
    )
    return rows.where(F.col("bin") > 0).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("ok").alias("accuracy"), F.avg("conf").alias("confidence")
    )


def calibration(df: DataFrame, bins: int = 10) -> DataFrame:
    """Expected and maximum calibration error."""
    gap = F.abs(F.col("accuracy") - F.col("confidence"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return calibration_bins(df, bins).agg(
        F.sum(F.col("n") * gap / total).alias("ece"), F.max(gap).alias("mce")
    )


def reliability(df: DataFrame, lo: float = 0.3, width: float = 0.05, bins: int = 14, more_than: int = 10) -> DataFrame:
    """Accuracy per confidence bin ``[lo, hi)``, well-filled bins only."""
    edges = np.linspace(lo, lo + width * bins, bins + 1)
    conf = F.array_max("proba")
    listed = F.array(*[F.lit(float(e)) for e in edges])
    rows = df.select(
        conf.alias("conf"),
        (F.col("y_true") == F.col("y_pred")).cast("double").alias("ok"),
        (F.size(F.filter(listed, lambda e: e <= conf)) - 1).alias("bin"),
    )
    inside = rows.where(F.col("bin").between(0, bins - 1))
    binned = inside.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("ok").alias("accuracy"), F.avg("conf").alias("confidence")
    )
    return binned.where(F.col("n") > more_than)


def confidence_histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    """Top probability in equal bins, right and wrong apart."""
    binned = df.select(
        (F.col("y_true") == F.col("y_pred")).alias("correct"), bin_index(F.array_max("proba"), 0.0, 1.0, bins).alias("bin")
    )
    return binned.groupBy("correct", "bin").agg(F.count(F.lit(1)).alias("n"))


def threshold_sweep(df: DataFrame, thresholds: list[float] | None = None, labels: list[str] = X.LABELS) -> DataFrame:
    """Scores when the middle class is predicted at or above a threshold.

    A row's prediction changes once along the thresholds, so rows are counted
    by the number of thresholds they reach; the sweep runs on those counts.
    """
    steps = [float(t) for t in (np.linspace(0.2, 0.6, 41) if thresholds is None else thresholds)]
    low, mid, high = labels
    p = [F.get(F.col("proba"), i) for i in range(3)]
    listed = F.array(*[F.lit(t) for t in steps])
    counts = (
        df.select(
            "y_true",
            F.when(p[0] > p[2], low).otherwise(high).alias("other"),
            F.size(F.filter(listed, lambda t: p[1] >= t)).alias("reached"),
        )
        .groupBy("y_true", "other", "reached")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    at = counts.select(
        "*", F.posexplode(listed).alias("step", "threshold")
    ).withColumn("y_pred", F.when(F.col("step") < F.col("reached"), mid).otherwise(F.col("other")))
    conf = at.groupBy("threshold", "y_true", "y_pred").agg(F.sum("n").alias("n"))
    middle = per_class(conf, ["threshold"]).where(F.col("label") == mid).select("threshold", F.col("f1").alias("middle_f1"))
    return metrics(conf, ["threshold"]).select("threshold", "accuracy", "macro_f1").join(middle, "threshold", "left")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """Highest macro-F1, the smallest threshold on a tie."""
    return sweep.orderBy(F.desc("macro_f1"), "threshold").limit(1)


def mutual_information(df: DataFrame, a: str, b: str) -> DataFrame:
    """Mutual information of two columns, in nats."""
    joint = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    total = joint.agg(F.sum("n")).scalar()
    pa = joint.groupBy(a).agg(F.sum("n").alias("na"))
    pb = joint.groupBy(b).agg(F.sum("n").alias("nb"))
    every = joint.join(pa, a).join(pb, b)
    part = F.col("n") / total * F.log(F.col("n") * total.cast("double") / (F.col("na").cast("double") * F.col("nb")))
    return every.agg(F.sum(part).alias("mutual_information"))


def error_rate(df: DataFrame, by: str) -> DataFrame:
    wrong = (F.col("y_true") != F.col("y_pred")).cast("double")
    return df.groupBy(by).agg(F.avg(wrong).alias("error_rate"), F.count(F.lit(1)).alias("n"))


def mcnemar(df: DataFrame, a: str = "y_pred", b: str = "y_other", true: str = "y_true") -> DataFrame:
    """McNemar's chi-squared with continuity correction and its p-value."""
    only_a = (F.col(a) == F.col(true)) & (F.col(b) != F.col(true))
    only_b = (F.col(a) != F.col(true)) & (F.col(b) == F.col(true))
    counts = df.agg(F.count_if(only_a).alias("n01"), F.count_if(only_b).alias("n10"))
    gap = F.abs(F.col("n01") - F.col("n10")) - 1
    chi2 = F.try_divide((gap * gap).cast("double"), (F.col("n01") + F.col("n10")).cast("double"))
    return counts.withColumn("chi2", chi2).withColumn("p_value", F.coalesce(chi2_tail("chi2"), F.lit(1.0)))


@F.pandas_udf(T.DoubleType())
def chi2_tail(chi2: pd.Series) -> pd.Series:
    """Upper tail of chi-squared with one degree of freedom."""
    return chi2.map(lambda x: math.erfc(math.sqrt(x / 2)), na_action="ignore")


def verify_metrics(df: DataFrame, expected: DataFrame, tol: float = 1e-4) -> DataFrame:
    """Recomputed figures against published ``(metric, expected)`` rows."""
    conf = confusion(df)
    both = metrics(conf).withColumns(
        {n: agreement(conf).select(n).scalar() for n in ("kappa", "mcc")}
    )
    names = ["accuracy", "macro_f1", "weighted_f1", "macro_precision", "macro_recall", "kappa", "mcc"]
    actual = both.select(*names).unpivot([], names, "metric", "actual")
    return expected.join(actual, "metric", "left").withColumn(
        "ok", F.coalesce(F.abs(F.col("actual") - F.col("expected")) <= tol, F.lit(False))
    )
