"""Aspects, trending terms, entities and weekly summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.functions.text import squeeze, tokens, word_grams
from pulse.operators.features import english_stop_words
from pulse.operators.ranking import top_k
from pulse.session import stored


def aspects(df: DataFrame, terms: list[str] = X.ASPECT_TERMS, sources: list[str] | None = None) -> DataFrame:
    """Sentiment of the posts that mention each term, overall and by source.

    A post is turned into one row per term it holds; nothing is joined.
    """
    low = F.lower("text")
    listed = F.array(*[F.lit(t.lower()) for t in terms])
    hits = df.withColumn("low", low).withColumn(
        "aspect_term", F.explode(F.filter(listed, lambda t: F.col("low").contains(t)))
    )
    s, label = F.col("sentiment_numeric"), F.col("sentiment_label")
    return hits.groupBy("aspect_term").agg(
        F.count(F.lit(1)).alias("total_mentions"),
        F.round(F.avg(s), 4).alias("avg_sentiment"),
        F.round(F.avg((label == "Negative").cast("double")), 4).alias("negative_ratio"),
        F.round(F.avg((label == "Positive").cast("double")), 4).alias("positive_ratio"),
        *[
            F.round(F.avg(F.when(F.col("source") == src, s)), 4).alias(f"{src}_avg_sentiment")
            for src in sources or []
        ],
    )


def _counted(df: DataFrame, keys: list[str], grams: Column) -> DataFrame:
    """``tf`` and ``df`` of every gram of the arrays ``grams``, per group.

    Sorting the grams inside each text makes term and document frequencies
    come from a single shuffle on the gram.
    """
    base = df.select(*keys, F.sort_array(grams).alias("grams"))
    flagged = F.transform(
        "grams",
        lambda g, i: F.struct(
            g.alias("term"), F.when(F.get("grams", i - 1) == g, 0).otherwise(1).alias("first")
        ),
    )
    rows = base.select(*keys, F.explode(flagged).alias("g")).select(*keys, "g.term", "g.first")
    return rows.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"), F.sum("first").alias("df"))


# Distinct words that a plan may hold as one set.
WORD_SET = 20_000


def frequent_grams(df: DataFrame, keys: list[str], stop_words: list[str], most: int, min_chars: int = 2, limit: int = WORD_SET) -> DataFrame:
    """``tf`` and ``df`` of the words and word pairs found in two texts of a
    group, among them the ``most`` most frequent ones and their ties.

    A pair is no more frequent than either of its words. So single words are
    counted first, and a pair is made only where both words are as frequent
    as the word of rank ``most``; rare pairs, which are nearly all, are
    neither made nor shuffled. With more than ``limit`` such words the set
    would outgrow a plan, and every pair is counted.
    """
    toks = tokens("text", min_chars)
    if stop_words:
        toks = F.filter(toks, lambda t: ~t.isin(stop_words))
    base = df.select(*keys, toks.alias("toks"))
    place = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("tf")))
    words = _counted(base, keys, F.col("toks")).where(F.col("df") >= 2)
    words = stored(words.withColumn("_place", place).where(F.col("_place") <= most).drop("_place"), "words")
    common = [r[0] for r in words.select("term").distinct().limit(limit + 1).collect()]
    if len(common) <= limit:
        base = base.select(*keys, F.transform("toks", lambda t: F.when(t.isin(common), t)).alias("toks"))
    pair = F.transform("toks", lambda t, i: F.concat(t, F.lit(" "), F.get("toks", i + 1)))
    pairs = _counted(base, keys, F.filter(pair, lambda g: g.isNotNull())).where(F.col("df") >= 2)
    return words.unionByName(pairs)


def trending(
    df: DataFrame,
    k: int = 20,
    vocabulary: int = 500,
    rank: str = "idf",
    stop_words: list[str] | None = None,
    stoplist: list[str] = X.TERM_STOPLIST,
    min_docs: int = 5,
) -> DataFrame:
    """Top terms per ``bucket``; needs columns ``bucket`` and ``text``.

    The vocabulary is the ``vocabulary`` most frequent grams found in at least
    two posts. ``rank='idf'`` puts the rarest of those first, ``'tfidf'``
    weighs them by frequency. English stop words are left out unless other
    ``stop_words`` are given. Terms holding a stop-list string are left out.
    Buckets with fewer than ``min_docs`` posts fall back to word counts.
    """
    sizes = stored(df.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_docs")))
    banned = F.lit(False)
    for s in stoplist:
        banned = banned | F.col("term").contains(s)

    stats = frequent_grams(df, ["bucket"], english_stop_words() if stop_words is None else stop_words, vocabulary)
    vocab = top_k(stats, [F.desc("tf"), F.col("term")], vocabulary, ["bucket"])
    idf = F.log((1 + F.col("n_docs")) / (1 + F.col("df"))) + 1
    score = idf if rank == "idf" else F.col("tf") * idf
    scored = (
        vocab.where(~banned)
        .join(sizes.where(F.col("n_docs") >= min_docs), "bucket")
        .select("bucket", "term", F.round(score, 4).alias("score"), score.alias("exact"))
    )
    few = df.join(sizes.where(F.col("n_docs") < min_docs), "bucket")
    listed = F.filter(F.split(F.lower(squeeze("text")), " "), lambda w: (F.length(w) > 3) & ~w.isin(stoplist))
    counted = (
        few.select("bucket", F.explode(listed).alias("term"))
        .groupBy("bucket", "term")
        .agg(F.count(F.lit(1)).cast("double").alias("score"))
        .withColumn("exact", F.col("score"))
    )
    best = top_k(scored.union(counted), [F.desc("exact"), F.col("term")], k, ["bucket"])
    return best.select("bucket", "term", "score")


# Distinct first words of aliases that a plan may hold as one set.
FIRST_WORDS = 20_000


def _alias_runs(runs: DataFrame, names: DataFrame, by: list[str], limit: int) -> DataFrame:
    """``(by, alias)``: the word runs of ``toks`` that may be an alias.

    The index is the set of first words, looked up for each word inside the
    row, and the lengths that aliases have; a row is made only where a first
    word stands. With more than ``limit`` first words the set would outgrow a
    plan, so every run is made and the join decides.
    """
    lengths = sorted(r[0] for r in names.select(F.size("words")).distinct().collect() if r[0] > 0)
    firsts = [r[0] for r in names.where(F.size("words") > 0).select(F.element_at("words", 1)).distinct().limit(limit + 1).collect()]
    if len(firsts) > limit:
        return runs.select(*by, F.explode(word_grams("toks", 1, max(lengths))).alias("alias"))
    reach = max(lengths, default=1)
    spots = F.transform("toks", lambda w, i: F.when(w.isin(firsts), F.slice("toks", i + 1, reach)))
    found = runs.select(*by, F.explode(F.filter(spots, lambda r: r.isNotNull())).alias("run"))
    heads = [F.when(F.size("run") >= n, F.array_join(F.slice("run", 1, n), " ")) for n in lengths]
    own = F.filter(F.array(*heads), lambda a: a.isNotNull()) if heads else F.array().cast("array<string>")
    return found.select(*by, F.explode(own).alias("alias"))


def entities(
    df: DataFrame,
    gazetteer: DataFrame,
    by: list[str] | None = None,
    noise: DataFrame | None = None,
    first_words: int = FIRST_WORDS,
) -> DataFrame:
    """Mentions of gazetteer entries ``(alias, entity, type)`` per group.

    Aliases may have any number of words. Only runs that begin with the first
    word of an alias and have the length of one meet the gazetteer; the join
    on the alias comes before the counting.
    """
    by = list(by or [])
    names = stored(
        gazetteer.where(F.col("type").isin(X.ENTITY_TYPES)).select(
            tokens("alias").alias("words"), F.lower("entity").alias("entity"), "type"
        ),
        "aliases",
    )
    runs = _alias_runs(df.select(*by, tokens("text").alias("toks")), names, by, first_words)
    names = names.select(F.array_join("words", " ").alias("alias"), "entity", "type")
    found = runs.join(names, "alias").groupBy(*by, "entity", "type").agg(F.count(F.lit(1)).alias("mentions"))
    if noise is not None:
        found = found.join(noise.select(F.lower("entity").alias("entity")), "entity", "left_anti")
    return found


def weekly(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Posts with the Monday that starts their week as ``bucket``."""
    return df.where(F.col(ts).isNotNull()).withColumn("bucket", F.to_date(F.date_trunc("week", ts)))


def bucket_summary(df: DataFrame, terms: DataFrame, found: DataFrame, k_entities: int = 15) -> DataFrame:
    """Per bucket: posts, top terms, top entities and sentiment counts."""
    per_label = df.groupBy("bucket", "sentiment_label").agg(F.count(F.lit(1)).alias("n"))
    posts = per_label.groupBy("bucket").agg(
        F.sum("n").alias("n_posts"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("sentiment_label").isNotNull(), F.struct("sentiment_label", "n")))
        ).alias("sentiment_dist"),
    )
    listed = terms.groupBy("bucket").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), "term"))), lambda t: t["term"]
        ).alias("trending_terms")
    )
    top = top_k(found, [F.desc("mentions"), F.col("entity"), F.col("type")], k_entities, ["bucket"])
    named = top.groupBy("bucket").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct((-F.col("mentions")).alias("o"), "entity", "type"))),
            lambda e: e["entity"],
        ).alias("top_entities")
    )
    return posts.join(listed, "bucket", "left").join(named, "bucket", "left")


def busy_buckets(summary: DataFrame, more_than: int = 500, k: int = 3) -> DataFrame:
    """Summaries of buckets with many posts, first names joined as text."""

    def head(c: str):
        return F.concat_ws(", ", F.slice(F.coalesce(F.col(c), F.array().cast("array<string>")), 1, k))

    return summary.where(F.col("n_posts") > more_than).select(
        "bucket", "n_posts", head("top_entities").alias("top_entities"), head("trending_terms").alias("key_terms")
    )
