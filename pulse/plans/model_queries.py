"""Registered feature and model queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.functions.text import accent_table
from pulse.operators import features as G
from pulse.operators import models as M
from pulse.operators.series import label_phases
from pulse.operators.splits import stratified_split
from pulse.plans.registry import query
from pulse.plans.tables import labelled, social, table, with_
from pulse.session import run_dir, stored


def training(spark, d):
    rows = labelled(spark, d).selectExpr("text_id AS id", "post_text AS text", "sentiment_label AS y_true")
    return M.training_set(rows)


def split(spark, d):
    """The labelled rows, four fifths to learn from and one fifth to judge."""
    rows = stored(stratified_split(training(spark, d), "y_true", "id", {"train": 0.8, "test": 0.2}))
    return rows.where("split = 'train'").drop("split"), rows.where("split = 'test'").drop("split")


def logistic(n: int) -> Pipeline:
    return M.candidates(n)["Logistic Regression"]


def bayes() -> Pipeline:
    return M.candidates(1)["Multinomial Naive Bayes"]


def svm(n: int, c: float = 1.0) -> Pipeline:
    return M.candidates(n, c)["Linear SVM"]


# -- features ------------------------------------------------------------------------

_FOLD = "translate(post_text, '{}', '{}')".format(*accent_table())
_GRAMS = f"""toks AS (SELECT text_id, regexp_extract_all(lower({_FOLD}), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS t FROM labelled),
grams AS (SELECT text_id, unnest(list_concat(t, list_transform(generate_series(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM toks),
counts AS (SELECT text_id, term, count(*) AS tf FROM grams GROUP BY ALL),
vocab AS (SELECT term, count(*) AS df FROM counts GROUP BY term HAVING count(*) >= 2 AND count(*) <= 0.9::DOUBLE * (SELECT count(*) FROM labelled))"""


def _tfidf_sql(tf: str) -> str:
    return with_("labelled") + f""", {_GRAMS},
raw AS (SELECT text_id, term, {tf} * (ln((1 + (SELECT count(*) FROM labelled)) / (1 + df)) + 1) AS w FROM counts JOIN vocab USING (term))
SELECT text_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY text_id)), 6) AS weight FROM raw"""


@query("tfidf", _tfidf_sql("(1 + ln(tf))"))
def tfidf(spark, d):
    t = G.tfidf(labelled(spark, d), "text_id", "post_text", max_df=0.9, max_features=None)
    return t.withColumn("weight", F.round("weight", 6))


@query("tfidf_plain_counts", _tfidf_sql("tf"))
def tfidf_plain_counts(spark, d):
    t = G.tfidf(labelled(spark, d), "text_id", "post_text", max_df=0.9, max_features=None, sublinear=False)
    return t.withColumn("weight", F.round("weight", 6))


@query("vocabulary_size", with_("labelled") + """SELECT count(*) AS vocab_size FROM (
SELECT term FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(post_text), '[\\p{L}\\p{N}_]{2,}'))) AS term FROM labelled)
GROUP BY term HAVING count(*) >= 3 AND count(*) <= 0.85::DOUBLE * (SELECT count(*) FROM labelled))""")
def vocabulary_size(spark, d):
    return G.vocab_size(labelled(spark, d), "post_text")


_CUT = " UNION ALL ".join(
    f"""SELECT w[i:i + {n - 1}] AS gram FROM (SELECT w, unnest(generate_series(1, greatest(1, len(w) - {n - 1}))) AS i FROM padded{'' if n == 3 else f' WHERE len(w) >= {n}'})"""
    for n in (3, 4, 5)
)


@query("char_grams", f"""WITH padded AS (SELECT ' ' || w || ' ' AS w FROM (
SELECT unnest(string_split_regex(lower("text"), '[\\s\\p{{Z}}]+')) AS w FROM conversations) WHERE w <> '')
SELECT gram, count(*) AS n FROM ({_CUT}) GROUP BY gram""")
def char_grams(spark, d):
    long = table(spark, d, "conversations").select(F.explode(G.char_grams(F.col("text"))).alias("gram"))
    return long.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


@query("majority_baseline", with_("labelled") + """SELECT text_id AS id, sentiment_label AS y_true,
  (SELECT sentiment_label FROM labelled GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS y_pred FROM labelled""")
def majority_baseline(spark, d):
    rows = training(spark, d)
    return M.majority(rows, rows).select("id", "y_true", "y_pred")


@query("class_weights", with_("labelled") + """SELECT sentiment_label AS y_true, round((SELECT count(*) FROM labelled)
  / ((SELECT count(DISTINCT sentiment_label) FROM labelled) * count(*)), 6) AS weight FROM labelled GROUP BY 1""")
def class_weights(spark, d):
    return training(spark, d).select("y_true", F.round("weight", 6).alias("weight")).distinct()


# -- models ----------------------------------------------------------------------------


@query("model_comparison")
def model_comparison(spark, d):
    return M.comparison(M.cross_validate(M.candidates, training(spark, d)))


@query("candidate_predictions")
def candidate_predictions(spark, d):
    train, test = split(spark, d)
    found = M.fit_all(M.candidates(train.count()), train, test)
    return M._stack([p.select(F.lit(n).alias("model"), "id", "y_true", "y_pred") for n, p in found.items()])


@query("char_union_predictions")
def char_union_predictions(spark, d):
    train, test = split(spark, d)
    return M.fit_all({"svm": M.char_union_svm(train.count())}, train, test)["svm"].select("id", "y_true", "y_pred")


@query("tuned_model")
def tuned_model(spark, d):
    rows = stored(training(spark, d))
    n = rows.count() * 2 // 3
    *features, classifier = logistic(n).getStages()
    draws = M.log_uniform(*X.SEARCH_RANGE, X.SEARCH_DRAWS)
    found = M.search(features, classifier, "regParam", [1 / (c * n) for c in draws], rows)
    return found.withColumnRenamed("value", "reg")


@query("negation_feature_gain")
def negation_feature_gain(spark, d):
    from pulse.functions.text import negation_scope

    rows = training(spark, d)
    plain = M.cross_validate(lambda n: {"plain": bayes()}, rows, baseline=False)
    tagged = rows.withColumn("text", negation_scope("text"))
    negated = M.cross_validate(lambda n: {"negation": bayes()}, tagged, baseline=False)
    return M.keep_if_better(plain.union(negated), "plain", "negation")


@query("class_weight_gain")
def class_weight_gain(spark, d):
    rows = stored(training(spark, d))

    def make(n):
        return {"unweighted": Pipeline(stages=[*M.word_features(), M._svm(1.0, n, weighted=False)]), "balanced": svm(n)}

    return M.keep_if_better(M.cross_validate(make, rows, baseline=False), "unweighted", "balanced")


@query("char_union_gain")
def char_union_gain(spark, d):
    folds = M.cross_validate(lambda n: {"words": svm(n), "words and characters": M.char_union_svm(n)}, training(spark, d), baseline=False)
    return M.keep_if_better(folds, "words", "words and characters")


@query("calibrated_probabilities")
def calibrated_probabilities(spark, d):
    train, test = split(spark, d)
    n = train.count() * 2 // 3
    out = M.calibrate(lambda: svm(n), train, test)
    return out.select("id", "y_true", "y_pred", "proba")


@query("scored_posts")
def scored_posts(spark, d):
    path = run_dir(spark, "model")
    rows = stored(training(spark, d))
    M.save_model(M.fit_model(logistic(rows.count()), rows), path)
    posts = social(spark, d).select("post_id", "text")
    return M.score(posts, M.load_model(path)).drop("text")


@query("feature_weights")
def feature_weights(spark, d):
    rows = stored(training(spark, d))
    return M.feature_weights(M.fit_model(logistic(rows.count()), rows), spark)


@query("seed_stability")
def seed_stability(spark, d):
    return M.stability_summary(M.seed_stability(bayes, training(spark, d), X.SEEDS))


@query("learning_curve")
def learning_curve(spark, d):
    return M.learning_curve(bayes, training(spark, d), X.TRAINING_SHARES)


@query("cleaning_ablation")
def cleaning_ablation(spark, d):
    tag = F.concat(F.lit("@u_"), F.col("id") % 3, F.lit(" ! #Tag_"), F.col("id") % 5, F.lit(" "), F.col("text"))
    rows = stored(training(spark, d).withColumn("text", tag))
    n = rows.count() * 4 // 5

    def make(grams):
        return Pipeline(stages=[*M.word_features(grams, min_df=3.0, max_df=0.85, max_features=M.NO_LIMIT), M._svm(X.ABLATION_C, n)])

    return M.ablate(make, rows)


@query("paired_test_5x2")
def paired_test_5x2(spark, d):
    rows = stored(training(spark, d))
    n = rows.count() // 2
    return M.paired_5x2_test(M.paired_5x2(bayes, lambda: logistic(n), rows))


@query("phase_topics")
def phase_topics(spark, d):
    docs = label_phases(social(spark, d), X.PHASES)
    return M.topics(docs, [p[0] for p in X.PHASES])
