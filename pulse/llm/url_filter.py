"""URL filter: host and path rules, else gradient-boosted trees on lexical features."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.common import packed
from pulse.llm.registry import query, read
from pulse.session import stored

SAMPLE_ROWS = 20_000
TREES = 20
DEPTH = 3
BLOCK_FROM = 0.5
PRIOR_URLS = 20.0

# Rules of the registered query, as (verdict, host and path).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

# Parts of host names that label a URL as unwanted for training.
UNWANTED = ["adult", "ads", "bets", "casino", "pills", "porn", "spam", "track", "xxx"]

FEATURES = [
    "url_length", "host_length", "path_length", "path_depth", "host_labels", "longest_label", "hyphens", "digits",
    "digit_ratio", "host_digits", "entropy", "parameters", "fragment", "suffix_rate", "suffix_share",
]


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (after the first ``://``, A-Z lower-cased) and ``path`` (up
    to ``?`` or ``#``); a NULL url or one without ``://`` has both empty."""
    after = F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return df.withColumns({"host": F.translate(host, upper, lower), "path": F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)})


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, else NULL. A rule fits its
    host and all subdomains when the path starts with the rule's path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        site, slash, rest = rule.partition("/")
        fits = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(path, F.lit(slash + rest))
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, said).otherwise(verdict)
    return name, verdict


def suffix(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def _entropy(text: str) -> Column:
    chars = F.array_distinct(F.split(F.col(text), ""))
    size = F.greatest(F.length(text), F.lit(1))
    share = F.transform(chars, lambda c: (F.length(text) - F.length(F.replace(F.col(text), c, F.lit("")))) / size)
    return F.aggregate(F.filter(share, lambda p: p > 0), F.lit(0.0), lambda a, p: a - p * F.log2(p))


def with_features(df: DataFrame, url: str, suffixes: DataFrame) -> DataFrame:
    """Add the lexical features of rows with ``host`` and ``path``.

    ``suffixes`` holds the share of unwanted and of all labelled URLs by host
    suffix; an unknown suffix gets the overall figures, in its NULL row.
    """
    whole = F.coalesce(F.col(url), F.lit(""))
    labels = F.split("host", r"\.")
    digits = lambda c: F.length(c) - F.length(F.translate(c, "0123456789", ""))
    asked = F.regexp_extract(whole, r"(?s)\?([^#]*)", 1)
    rows = df.withColumns(
        {
            "url_length": F.length(whole),
            "host_length": F.length("host"),
            "path_length": F.length("path"),
            "path_depth": F.size(F.filter(F.split("path", "/"), lambda s: s != "")),
            "host_labels": F.size(labels),
            "longest_label": F.array_max(F.transform(labels, F.length)),
            "hyphens": F.length("host") - F.length(F.replace(F.col("host"), F.lit("-"), F.lit(""))),
            "digits": digits(whole),
            "digit_ratio": digits(whole) / F.greatest(F.length(whole), F.lit(1)),
            "host_digits": digits(F.col("host")),
            "entropy": _entropy("host"),
            "parameters": F.when(asked == "", 0).otherwise(F.size(F.split(asked, "&"))),
            "fragment": F.contains(whole, F.lit("#")).cast("int"),
            "_suffix": suffix(F.col("host")),
        }
    )
    named = suffixes.where("suffix IS NOT NULL").withColumnsRenamed({"suffix": "_s", "rate": "_r", "share": "_n"})
    rest = suffixes.where("suffix IS NULL").select(F.struct("rate", "share"))
    rows = rows.join(F.broadcast(named), F.col("_suffix") == F.col("_s"), "left").withColumn("_rest", rest.scalar())
    rows = rows.withColumn("suffix_rate", F.coalesce("_r", "_rest.rate")).withColumn("suffix_share", F.coalesce("_n", "_rest.share"))
    rows = rows.drop("_suffix", "_s", "_r", "_n", "_rest")
    return rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES})


def train(labelled: DataFrame, url: str, label: str, sample_rows: int = SAMPLE_ROWS) -> tuple[GBTClassificationModel | None, DataFrame]:
    """Trees and suffix statistics from labelled URLs (``label`` 0 or 1).

    Fitted on the first ``sample_rows`` labelled rows in the order of the
    URL's hash: a bounded sample, so the suffix table is bounded too. Equal
    URLs count once. No model if the sample lacks one of the labels.
    """
    known = labelled.where(F.col(url).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(url).agg(F.max(label).cast("int").alias("label"))
    known = stored(known.orderBy(F.xxhash64(url), url).limit(sample_rows), "urls")
    rows = with_parts(known, url)
    base = rows.agg(F.avg("label").alias("p"), F.count(F.lit(1)).alias("n")).first()
    by = rows.groupBy(suffix(F.col("host")).alias("suffix")).agg(F.sum("label").alias("k"), F.count(F.lit(1)).alias("n"))
    p, n = base.p or 0.0, max(base.n, 1)
    rate = (F.col("k") + PRIOR_URLS * p) / (F.col("n") + PRIOR_URLS)
    suffixes = by.where("suffix IS NOT NULL").select("suffix", rate.alias("rate"), (F.col("n") / n).alias("share"))
    overall = known.sparkSession.range(1).select(F.lit(None).cast("string").alias("suffix"), F.lit(p).alias("rate"), F.lit(0.0).alias("share"))
    suffixes = stored(suffixes.unionByName(overall), "suffixes")
    if not 0 < p < 1:
        return None, suffixes
    made = stored(_vectors(with_features(rows, url, suffixes)).select("features", "label"), "url-features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, checkpointInterval=-1)
    return trees.fit(made), suffixes


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def filter_urls(
    df: DataFrame,
    labelled: DataFrame,
    rules: list[tuple[str, str]],
    url: str = "url",
    label: str = "label",
    block_from: float = BLOCK_FROM,
) -> DataFrame:
    """All rows of ``df`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict``.

    The longest rule that fits decides; ``rules`` is a short list in the code.
    Else a URL is blocked if the trees give it a probability of ``block_from``
    or more. A NULL url, one without a host, and every url when there is
    nothing to learn from, scores 0 and is allowed unless a rule says
    otherwise. Input columns with an output's name are replaced. Repeated rows
    are judged alike; an empty table gives no rows.
    """
    made = ["host", "path", "rule", "score", "verdict"]
    model, suffixes = train(labelled, url, label)
    rows = with_parts(packed(df, made, _url=url), "_url")
    if model is None:
        rows = rows.withColumn("score", F.lit(0.0))
    else:
        judged = model.transform(_vectors(with_features(rows, "_url", suffixes)))
        chance = F.get(vector_to_array("probability"), F.lit(1))
        rows = judged.withColumn("score", F.when(F.col("host") == "", 0.0).otherwise(chance))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    by_score = F.when(F.col("score") >= block_from, "block").otherwise("allow")
    return rows.withColumn("rule", rule).withColumn("verdict", F.coalesce(said, by_score)).select("_in.*", *made)


def label_urls(df: DataFrame, url: str = "url", terms: list[str] | None = None) -> DataFrame:
    """URLs labelled 1 if a listed term is a word of the host name, else 0."""
    words = F.split("host", "[^a-z]+")
    hit = F.arrays_overlap(words, F.array(*[F.lit(t) for t in terms or UNWANTED]))
    return with_parts(df.select(url), url).select(url, F.coalesce(hit.cast("int"), F.lit(0)).alias("label"))


@query("op2_url_filter")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages", "page_id", "url")
    labelled = label_urls(pages.where(F.col("url").isNotNull()))
    out = filter_urls(pages, labelled, RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", "score")
