"""Registered split, similarity and evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.functions.values import softmax, stable_hash
from pulse.operators import evaluation as V
from pulse.operators import ranking as R
from pulse.operators import similarity as Z
from pulse.operators import splits as L
from pulse.plans.registry import query
from pulse.plans.tables import CTE, LABELS_SQL, PREDICTIONS, labelled, predictions, quoted, social, table, with_


def hash_sql(e: str, seed: int = 42) -> str:
    return f"('0x' || substring(md5({e} || ':{seed}'), 1, 15))::BIGINT"


# -- samples and splits --------------------------------------------------------------------


@query("seeded_sample", f"""SELECT doc_id, source FROM documents ORDER BY {hash_sql('doc_id')}, doc_id LIMIT 50""")
def seeded_sample(spark, d):
    return R.seeded_sample(table(spark, d, "documents"), "doc_id", 50).select("doc_id", "source")


def _split_sql(parts: list[tuple[str, float]]) -> str:
    whens = " ".join(f"WHEN rn <= round(n * {c!r}::DOUBLE) THEN '{p}'" for p, c in parts[:-1])
    return f"""SELECT text_id, sentiment_label, post_text, topic_category, CASE {whens} ELSE '{parts[-1][0]}' END AS "split" FROM (
  SELECT *, row_number() OVER (PARTITION BY sentiment_label ORDER BY {hash_sql('text_id')}, text_id) AS rn,
    count(*) OVER (PARTITION BY sentiment_label) AS n FROM labelled)"""


CTE["split2"] = _split_sql([("train", 0.8), ("test", 1.0)])
_THREE = {"train": 0.7, "validation": 0.1, "test": 0.2}
_CUTS = sum(_THREE.values()) - 0.2
CTE["split3"] = _split_sql([("train", _CUTS - 0.1), ("validation", _CUTS), ("test", 1.0)])


@query("split_80_20", with_("labelled", "split2") + 'SELECT text_id, sentiment_label, "split" FROM split2')
def split_80_20(spark, d):
    s = L.stratified_split(labelled(spark, d), "sentiment_label", "text_id", {"train": 0.8, "test": 0.2})
    return s.select("text_id", "sentiment_label", "split")


@query("split_70_10_20", with_("labelled", "split3") + 'SELECT text_id, sentiment_label, "split" FROM split3')
def split_70_10_20(spark, d):
    s = L.stratified_split(labelled(spark, d), "sentiment_label", "text_id", _THREE)
    return s.select("text_id", "sentiment_label", "split")


@query("folds", with_("labelled") + f"""SELECT text_id, sentiment_label, CAST((row_number() OVER (PARTITION BY sentiment_label
  ORDER BY {hash_sql('text_id')}, text_id) - 1) % 5 AS INTEGER) AS fold FROM labelled""")
def folds(spark, d):
    return L.assign_folds(labelled(spark, d), "sentiment_label", "text_id").select("text_id", "sentiment_label", "fold")


@query("halves", f"""SELECT doc_id, CAST(row_number() OVER (ORDER BY {hash_sql('doc_id', 7)}, doc_id) > floor((SELECT count(*) FROM documents) / 2) AS INTEGER) AS half
FROM documents""")
def halves(spark, d):
    return L.halves(table(spark, d, "documents").select("doc_id"), "doc_id", 7)


@query("split_overlap", with_("labelled", "split2") + """SELECT DISTINCT post_text FROM split2 WHERE "split" = 'test'
  AND post_text IN (SELECT post_text FROM split2 WHERE "split" = 'train')""")
def split_overlap(spark, d):
    s = L.stratified_split(labelled(spark, d), "sentiment_label", "text_id", {"train": 0.8, "test": 0.2})
    return Z.split_overlap(s.where("split = 'test'"), s.where("split = 'train'"), "post_text")


# -- similarity: a fifth of the documents, by hash, against the rest ---------------------------

_TOKS = "regexp_extract_all(lower(\"text\"), '[\\p{L}\\p{N}_]{2,}')"
CTE["sets"] = f"""
SELECT doc_id AS id, {hash_sql('doc_id')} % 5 = 0 AS is_test,
  list_sort(list_distinct(list_transform(generate_series(1, len(t) - 2), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]))) AS grams
FROM (SELECT doc_id, {_TOKS} AS t FROM documents) WHERE len(t) >= 3"""
CTE["gram_rows"] = "SELECT id, is_test, len(grams) AS size, unnest(grams) AS gram FROM sets"
CTE["known"] = """SELECT id, gram, count(*) OVER (PARTITION BY id) AS size FROM gram_rows WHERE is_test
  AND gram IN (SELECT gram FROM gram_rows WHERE NOT is_test)"""


def _pairs_sql(left: str) -> str:
    return f"""SELECT a.id AS l, b.id AS r, count(*) / (any_value(a.size) + any_value(b.size) - count(*)) AS jaccard
FROM {left} a JOIN gram_rows b ON a.gram = b.gram AND NOT b.is_test GROUP BY a.id, b.id
HAVING count(*) / (any_value(a.size) + any_value(b.size) - count(*)) >= 0.8"""


CTE["near"] = _pairs_sql("(SELECT * FROM gram_rows WHERE is_test)")
CTE["near_known"] = _pairs_sql("known")
_SETS = ("sets", "gram_rows", "near")


def _sides(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    chosen = stable_hash("id") % 5 == 0
    return docs.where(chosen), docs.where(~chosen)


@query("near_duplicate_sets", with_(*_SETS) + """, members AS (SELECT id, is_test, md5(array_to_string(grams, '|')) AS sig FROM sets),
reps AS (SELECT sig, is_test, min(id) AS rep, count(*) AS copies FROM members GROUP BY ALL)
SELECT l AS left_id, r AS right_id, jaccard, a.copies AS left_copies, b.copies AS right_copies
FROM near JOIN reps a ON a.rep = l AND a.is_test JOIN reps b ON b.rep = r AND NOT b.is_test""")
def near_duplicate_sets(spark, d):
    test, train = _sides(spark, d)
    return Z.similar_sets(test, train)


@query("leaked_rows", with_(*_SETS) + """SELECT l AS id, max(jaccard) AS jaccard,
  arg_min(r, (-jaccard, r)) AS nearest_id, count(*) AS n_near FROM near GROUP BY l""")
def leaked_rows(spark, d):
    test, train = _sides(spark, d)
    return Z.leaked_rows(test, train)


@query("leaked_ids", with_(*_SETS) + "SELECT DISTINCT l AS id FROM near")
def leaked_ids(spark, d):
    test, train = _sides(spark, d)
    return Z.leaked_ids(test, train)


@query("leaked_rows_known_vocab", with_("sets", "gram_rows", "known", "near_known") + """SELECT l AS id, max(jaccard) AS jaccard,
  arg_min(r, (-jaccard, r)) AS nearest_id, count(*) AS n_near FROM near_known GROUP BY l""")
def leaked_rows_known_vocab(spark, d):
    test, train = _sides(spark, d)
    return Z.leaked_rows(test, train, known_vocab_only=True)


@query("leakage_summary", with_(*_SETS) + """, members AS (SELECT id, is_test, md5(array_to_string(grams, '|')) AS sig FROM sets)
SELECT count(*) AS n_pairs, count(DISTINCT (a.sig, b.sig)) AS n_set_pairs, max(jaccard) AS max_jaccard
FROM near JOIN members a ON a.id = l JOIN members b ON b.id = r""")
def leakage_summary(spark, d):
    test, train = _sides(spark, d)
    return Z.leakage_summary(Z.similar_sets(test, train))


@query("purged_test_rows", with_(*_SETS) + f"""SELECT doc_id AS id, lang FROM documents WHERE {hash_sql('doc_id')} % 5 = 0
  AND doc_id NOT IN (SELECT l FROM near)""")
def purged_test_rows(spark, d):
    test, train = _sides(spark, d)
    return Z.purge(test, Z.leaked_ids(test, train)).select("id", "lang")


@query("near_duplicate_counts", with_(*_SETS) + "SELECT l AS id, count(*) AS n_near FROM near GROUP BY l")
def near_duplicate_counts(spark, d):
    test, train = _sides(spark, d)
    return Z.near_counts(test, train)


@query("near_duplicate_sets_lsh")
def near_duplicate_sets_lsh(spark, d):
    test, train = _sides(spark, d)
    return Z.similar_pairs_lsh(test, train)


@query("append_new_rows", with_("social") + """SELECT post_id, source FROM social
UNION ALL SELECT 'd' || (item_id * 2), 'extra' FROM benchmark WHERE 'd' || (item_id * 2) NOT IN (SELECT post_id FROM social)""")
def append_new_rows(spark, d):
    new = table(spark, d, "benchmark").select(
        F.concat(F.lit("d"), F.col("item_id") * 2).alias("post_id"), F.lit("extra").alias("source")
    )
    return Z.append_new(social(spark, d).select("post_id", "source"), new, "post_id", ["source"])


# -- evaluation -----------------------------------------------------------------------------------

CTE["cells"] = f"""SELECT a.l AS y_true, b.l AS y_pred, (SELECT count(*) FROM predictions p WHERE p.y_true = a.l AND p.y_pred = b.l) AS n
FROM {LABELS_SQL} a(l), {LABELS_SQL} b(l)"""
CTE["classes"] = f"""SELECT l AS label, sum(CASE WHEN y_true = l THEN n ELSE 0 END) AS support,
  sum(CASE WHEN y_pred = l THEN n ELSE 0 END) AS predicted, sum(CASE WHEN y_true = l AND y_pred = l THEN n ELSE 0 END) AS tp
FROM cells, {LABELS_SQL} c(l) GROUP BY l"""
CTE["scored"] = """SELECT *, coalesce(tp / nullif(predicted, 0), 0)::DOUBLE AS p, coalesce(tp / nullif(support, 0), 0)::DOUBLE AS r FROM classes"""
CTE["f"] = "SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM scored"
CTE["totals"] = """SELECT (sum(tp) / sum(support))::DOUBLE AS accuracy, avg(p) AS macro_precision, avg(r) AS macro_recall, avg(f1) AS macro_f1,
  sum(p * support) / sum(support) AS weighted_precision, sum(r * support) / sum(support) AS weighted_recall,
  sum(f1 * support) / sum(support) AS weighted_f1, CAST(sum(support) AS BIGINT) AS n FROM f"""
CTE["agree"] = """SELECT (c / s - e) / (1 - e) AS kappa, (c * s - tp) / sqrt((s * s - pp) * (s * s - tt)) AS mcc FROM (
  SELECT *, tp / (s * s) AS e FROM (SELECT sum(support)::DOUBLE AS s, sum(tp)::DOUBLE AS c, sum(support * predicted)::DOUBLE AS tp,
    sum(support * support)::DOUBLE AS tt, sum(predicted * predicted)::DOUBLE AS pp FROM classes))"""
_CELLS = (*PREDICTIONS, "cells")
_F = (*_CELLS, "classes", "scored", "f")
_TOTALS = (*_F, "totals")
_SCORES = ["accuracy", "macro_precision", "macro_recall", "macro_f1", "weighted_precision", "weighted_recall", "weighted_f1"]


def six(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def six_sql(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in cols)


@query("confusion_matrix", with_(*_CELLS) + """
SELECT y_true, y_pred, n, coalesce(n / nullif(sum(n) OVER (PARTITION BY y_true), 0), 0)::DOUBLE AS row_share FROM cells""")
def confusion_matrix(spark, d):
    return V.confusion(predictions(spark, d))


@query("class_report", with_(*_F) + """SELECT label, CAST(support AS BIGINT) AS support, CAST(predicted AS BIGINT) AS predicted,
  CAST(tp AS BIGINT) AS tp, p AS "precision", r AS recall, f1 FROM f""")
def class_report(spark, d):
    return V.per_class(V.confusion(predictions(spark, d)))


@query("overall_metrics", with_(*_TOTALS) + f"SELECT {six_sql(*_SCORES)}, n FROM totals")
def overall_metrics(spark, d):
    return six(V.metrics(V.confusion(predictions(spark, d))), *_SCORES)


CTE["majority"] = "SELECT y_true AS label, count(*) AS n FROM predictions GROUP BY y_true ORDER BY n DESC, label LIMIT 1"


@query("lift_over_majority", with_(*_TOTALS, "majority") + """, base AS (
SELECT n / (SELECT count(*) FROM predictions) AS a, n FROM majority)
SELECT round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1, round(a, 6) AS baseline_accuracy,
  round(2 * a / (1 + a) / 3, 6) AS baseline_macro_f1, round(accuracy - a, 4) AS lift_accuracy,
  round(macro_f1 - 2 * a / (1 + a) / 3, 4) AS lift_macro_f1 FROM totals, base""")
def lift_over_majority(spark, d):
    from pulse.operators.cleaning import mode_of

    p = predictions(spark, d)
    most = mode_of(p, "y_true").select("mode_value").scalar()
    base = V.metrics(V.confusion(p.withColumn("y_pred", most)))
    out = V.lift(V.metrics(V.confusion(p)), base)
    return six(
        out.select("accuracy", "macro_f1", "baseline_accuracy", "baseline_macro_f1", "lift_accuracy", "lift_macro_f1"),
        "accuracy", "macro_f1", "baseline_accuracy", "baseline_macro_f1",
    )


@query("kappa_and_mcc", with_(*_CELLS, "classes", "agree") + f"SELECT {six_sql('kappa', 'mcc')} FROM agree")
def kappa_and_mcc(spark, d):
    return six(V.agreement(V.confusion(predictions(spark, d))), "kappa", "mcc")


_P = with_(*PREDICTIONS)
_CONF = {"Negative": "p_neg", "Neutral": "p_neu", "Positive": "p_pos"}


@query("class_taxonomy", with_(*_F) + """, t AS (
SELECT label, CAST(support AS BIGINT) AS support, CAST(tp AS BIGINT) AS tp, CAST(predicted - tp AS BIGINT) AS fp,
  CAST(support - tp AS BIGINT) AS fn, p AS "precision", r AS recall, f1, coalesce(avg_conf_tp, 0) AS avg_conf_tp, coalesce(avg_conf_fn, 0) AS avg_conf_fn
FROM f JOIN (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS label, avg({p}) FILTER (y_pred = '{c}') AS avg_conf_tp, avg({p}) FILTER (y_pred <> '{c}') AS avg_conf_fn
FROM predictions WHERE y_true = '{c}'""" for c, p in _CONF.items()) + """) USING (label))
SELECT label, support, tp, fp, fn, "precision", recall, f1, round(avg_conf_tp, 6) AS avg_conf_tp, round(avg_conf_fn, 6) AS avg_conf_fn,
  round(avg_conf_tp - avg_conf_fn, 6) AS conf_gap FROM t""")
def class_taxonomy(spark, d):
    return six(V.taxonomy(predictions(spark, d)), "avg_conf_tp", "avg_conf_fn", "conf_gap")


@query("error_pairs", with_(*_CELLS) + """SELECT * FROM (SELECT y_true, y_pred, n,
  round(n * 100.0::DOUBLE / sum(CASE WHEN y_true <> y_pred THEN n END) OVER (), 1) AS pct_of_errors,
  round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY y_true), 1) AS pct_of_class FROM cells) WHERE y_true <> y_pred AND n > 0""")
def error_pairs(spark, d):
    return V.error_pairs(V.confusion(predictions(spark, d)))


_WORDS = "len(list_filter(string_split_regex(\"text\", '[\\s\\p{Z}]+'), lambda w: w <> ''))"
_CATEGORY = (
    f"CASE WHEN {_WORDS} <= 4 THEN '{X.ERROR_SHORT}' WHEN "
    + " OR ".join("contains(lower(\"text\"), '" + m.replace("'", "''") + "')" for m in X.NEGATION_MARKS)
    + f" THEN '{X.ERROR_NEGATION}' "
    + " ".join(f"WHEN y_true = '{t}' AND y_pred = '{p}' THEN '{n}'" for (t, p), n in X.ERROR_NAMES.items())
    + f" ELSE '{X.ERROR_OTHER}' END"
)


@query("error_sample", _P + f"""SELECT id, CASE WHEN length("text") > 90 THEN substring("text", 1, 90) || '...' ELSE "text" END AS snippet,
  y_true, y_pred, {_CATEGORY} AS category FROM predictions WHERE y_true <> y_pred ORDER BY {hash_sql('id')}, id LIMIT 20""")
def error_sample(spark, d):
    return V.error_sample(predictions(spark, d))


@query("error_categories", _P + f"SELECT category, count(*) AS n FROM (SELECT {_CATEGORY} AS category FROM predictions WHERE y_true <> y_pred) GROUP BY category")
def error_categories(spark, d):
    from pulse.functions.text import error_category

    wrong = V.errors(predictions(spark, d)).select(error_category("y_true", "y_pred", "text").alias("category"))
    return wrong.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("confident_errors", _P + """SELECT id, y_true, y_pred, round(greatest(p_neg, p_neu, p_pos), 4) AS confidence, substring("text", 1, 120) AS "text"
FROM predictions WHERE y_true <> y_pred ORDER BY greatest(p_neg, p_neu, p_pos) DESC, id LIMIT 20""")
def confident_errors(spark, d):
    return V.confident_errors(predictions(spark, d))


_T = "regexp_extract_all(lower(\"text\"), '[\\p{L}\\p{N}_]+')"


@query("error_tags", _P + f""", wrong AS (SELECT * FROM predictions WHERE y_true <> y_pred), tagged AS (
SELECT list_filter([CASE WHEN list_has_any({_T}, [{quoted(X.NEGATION_WORDS)}]) THEN '{X.TAG_NAMES['negation']}' END,
    CASE WHEN list_has_any({_T}, [{quoted(X.MODALITY_WORDS)}]) THEN '{X.TAG_NAMES['modality']}' END,
    CASE WHEN list_has_any({_T}, [{quoted(X.CONTRAST_WORDS)}]) THEN '{X.TAG_NAMES['contrast']}' END,
    CASE WHEN contains("text", '?') OR contains("text", '!') OR contains("text", '...') THEN '{X.TAG_NAMES['punctuation']}' END
  ], lambda t: t IS NOT NULL) AS tags FROM wrong),
flat AS (SELECT unnest(CASE WHEN len(tags) = 0 THEN ['{X.TAG_NAMES['none']}'] ELSE tags END) AS tag FROM tagged)
SELECT tag, count(*) AS n, round(count(*) / (SELECT count(*) FROM wrong), 4) AS share FROM flat GROUP BY tag""")
def error_tags(spark, d):
    return V.error_tags(predictions(spark, d))


CTE["ovr"] = " UNION ALL ".join(
    f"SELECT '{c}' AS label, {p} AS score, CAST(y_true = '{c}' AS INTEGER) AS hit FROM predictions" for c, p in _CONF.items()
)
CTE["points"] = """SELECT label, score AS threshold, sum(sum(hit)) OVER w AS tp, sum(sum(1 - hit)) OVER w AS fp,
  sum(sum(hit)) OVER (PARTITION BY label) AS pos, sum(sum(1 - hit)) OVER (PARTITION BY label) AS neg, sum(hit) AS h, sum(1 - hit) AS g
FROM ovr GROUP BY label, score WINDOW w AS (PARTITION BY label ORDER BY score DESC)"""
_PTS = with_(*PREDICTIONS, "ovr", "points")


@query("roc_points", _PTS + "SELECT label, threshold, (tp / pos)::DOUBLE AS tpr, (fp / neg)::DOUBLE AS fpr FROM points")
def roc_points(spark, d):
    return V.roc(predictions(spark, d))


@query("precision_recall_points", _PTS + 'SELECT label, threshold, (tp / (tp + fp))::DOUBLE AS "precision", (tp / pos)::DOUBLE AS recall FROM points')
def precision_recall_points(spark, d):
    return V.precision_recall(predictions(spark, d))


@query("ranking_scores", _PTS + """, pairs AS (SELECT a.label, sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)
    / count(*) AS auc FROM ovr a JOIN ovr b ON a.label = b.label AND a.hit = 1 AND b.hit = 0 GROUP BY a.label),
ap AS (SELECT label, sum(h * (tp / (tp + fp))) / max(pos) AS average_precision FROM points GROUP BY label)
SELECT label, round(auc::DOUBLE, 6) AS auc, round(average_precision::DOUBLE, 6) AS average_precision FROM pairs JOIN ap USING (label)""")
def ranking_scores(spark, d):
    return six(V.ranking_scores(predictions(spark, d)), "auc", "average_precision")


@query("bootstrap_interval")
def bootstrap_interval(spark, d):
    return V.bootstrap_ci(V.confusion(predictions(spark, d)))


CTE["topped"] = "SELECT *, greatest(p_neg, p_neu, p_pos) AS conf, CAST(y_true = y_pred AS INTEGER) AS ok FROM predictions"
CTE["ece_bins"] = """SELECT i AS bin, count(*) AS n, avg(ok) AS accuracy, avg(conf) AS confidence FROM topped
JOIN (SELECT unnest(generate_series(1, 10)) AS i) ON conf > (i - 1) * 0.1::DOUBLE AND conf <= CASE i WHEN 3 THEN 0.30000000000000004 WHEN 6 THEN 0.6000000000000001 WHEN 7 THEN 0.7000000000000001 ELSE i / 10.0::DOUBLE END
GROUP BY i"""
_BINS = with_(*PREDICTIONS, "topped", "ece_bins")


@query("calibration_bins", _BINS + f"SELECT CAST(bin AS INTEGER) AS bin, n, {six_sql('accuracy', 'confidence')} FROM ece_bins")
def calibration_bins(spark, d):
    return six(V.calibration_bins(predictions(spark, d)), "accuracy", "confidence")


@query("calibration_error", _BINS + """SELECT round(sum(n * abs(accuracy - confidence) / (SELECT count(*) FROM predictions)), 6) AS ece,
  round(max(abs(accuracy - confidence)), 6) AS mce FROM ece_bins""")
def calibration_error(spark, d):
    return six(V.calibration(predictions(spark, d)), "ece", "mce")


@query("reliability_bins", with_(*PREDICTIONS, "topped") + """SELECT bin, n, round(accuracy, 6) AS accuracy, round(confidence, 6) AS confidence FROM (
SELECT CAST(floor((conf - 0.3) / 0.05 + 1e-9) AS INTEGER) AS bin, count(*) AS n, avg(ok) AS accuracy, avg(conf) AS confidence
FROM topped WHERE conf >= 0.3 AND conf < 1.0 GROUP BY 1) WHERE n > 10""")
def reliability_bins(spark, d):
    return six(V.reliability(predictions(spark, d)), "accuracy", "confidence")


@query("confidence_histogram", with_(*PREDICTIONS, "topped") + """SELECT ok = 1 AS correct, least(CAST(floor(conf / 0.05) AS INTEGER), 19) AS bin, count(*) AS n
FROM topped GROUP BY ALL""")
def confidence_histogram(spark, d):
    return V.confidence_histogram(predictions(spark, d))


CTE["steps"] = "SELECT unnest([" + ", ".join(f"{t!r}::DOUBLE" for t in __import__("numpy").linspace(0.2, 0.6, 41).tolist()) + "]) AS threshold"
CTE["swept"] = """SELECT threshold, y_true, CASE WHEN p_neu >= threshold THEN 'Neutral' WHEN p_neg > p_pos THEN 'Negative' ELSE 'Positive' END AS y_pred
FROM predictions, steps"""
CTE["sweep_classes"] = f"""SELECT threshold, l AS label, count(*) FILTER (y_true = l) AS support, count(*) FILTER (y_pred = l) AS predicted,
  count(*) FILTER (y_true = l AND y_pred = l) AS tp FROM swept, {LABELS_SQL} c(l) GROUP BY ALL"""
CTE["sweep"] = """SELECT threshold, sum(tp) / sum(support) AS accuracy, avg(2 * tp / (support + predicted)) AS macro_f1,
  max(CASE WHEN label = 'Neutral' THEN 2 * tp / (support + predicted) END) AS middle_f1 FROM sweep_classes GROUP BY threshold"""
_SWEEP = with_(*PREDICTIONS, "steps", "swept", "sweep_classes", "sweep")


@query("threshold_sweep", _SWEEP + f"SELECT threshold, {six_sql('accuracy', 'macro_f1', 'middle_f1')} FROM sweep")
def threshold_sweep(spark, d):
    return six(V.threshold_sweep(predictions(spark, d)), "accuracy", "macro_f1", "middle_f1")


@query("best_threshold", _SWEEP + "SELECT threshold, round(macro_f1, 6) AS macro_f1 FROM sweep ORDER BY sweep.macro_f1 DESC, threshold LIMIT 1")
def best_threshold(spark, d):
    return six(V.best_threshold(V.threshold_sweep(predictions(spark, d))).select("threshold", "macro_f1"), "macro_f1")


@query("topic_error_information", _P + """, j AS (SELECT topic, y_true <> y_pred AS wrong, count(*) AS n FROM predictions GROUP BY ALL),
t AS (SELECT sum(n)::DOUBLE AS t FROM j)
SELECT round(sum(n / t * ln(n * t / (a * b))), 6) AS mutual_information FROM (
  SELECT n, sum(n) OVER (PARTITION BY topic)::DOUBLE AS a, sum(n) OVER (PARTITION BY wrong)::DOUBLE AS b FROM j), t""")
def topic_error_information(spark, d):
    p = predictions(spark, d).withColumn("wrong", F.col("y_true") != F.col("y_pred"))
    return six(V.mutual_information(p, "topic", "wrong"), "mutual_information")


@query("topic_error_rate", _P + "SELECT topic, avg(CAST(y_true <> y_pred AS INTEGER)) AS error_rate, count(*) AS n FROM predictions GROUP BY topic")
def topic_error_rate(spark, d):
    return V.error_rate(predictions(spark, d), "topic")


@query("mcnemar", _P + """SELECT n01, n10, (abs(n01 - n10) - 1) * (abs(n01 - n10) - 1) / nullif(n01 + n10, 0) AS chi2 FROM (
SELECT count(*) FILTER (y_pred = y_true AND y_other <> y_true) AS n01, count(*) FILTER (y_pred <> y_true AND y_other = y_true) AS n10 FROM predictions)""")
def mcnemar(spark, d):
    return V.mcnemar(predictions(spark, d)).drop("p_value")


@query("mcnemar_p_value")
def mcnemar_p_value(spark, d):
    return V.mcnemar(predictions(spark, d))


# Published figures to verify: two that hold at sf 0.01 and one that does not.
_PUBLISHED = [("accuracy", 0.5), ("kappa", 0.25), ("weighted_f1", 0.9)]


@query("verify_metrics", with_(*_TOTALS, "agree") + """, both_rows AS (SELECT 'accuracy' AS metric, 0.5::DOUBLE AS expected, accuracy AS actual FROM totals
UNION ALL SELECT 'kappa', 0.25, kappa FROM agree UNION ALL SELECT 'weighted_f1', 0.9, weighted_f1 FROM totals)
SELECT metric, expected, round(actual, 6) AS actual, abs(actual - expected) <= 1e-4 AS ok FROM both_rows""")
def verify_metrics(spark, d):
    expected = spark.createDataFrame(_PUBLISHED, "metric string, expected double")
    return six(V.verify_metrics(predictions(spark, d), expected), "actual")


@query("softmax", with_(*PREDICTIONS) + """SELECT id, round(exp(p_neg) / (exp(p_neg) + exp(p_neu) + exp(p_pos)), 6) AS s_neg,
  round(exp(p_pos) / (exp(p_neg) + exp(p_neu) + exp(p_pos)), 6) AS s_pos FROM predictions""")
def softmax_margins(spark, d):
    s = predictions(spark, d).select("id", softmax("proba").alias("s"))
    return s.select("id", F.round(F.get("s", 0), 6).alias("s_neg"), F.round(F.get("s", 2), 6).alias("s_pos"))
