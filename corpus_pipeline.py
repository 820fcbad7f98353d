"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage but the last returns the columns of ``documents``. A stage's
statistics come from the documents it is given; ``labels`` and ``benchmark``
are read from the data folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulse.llm.decontamination import decontaminate
from pulse.llm.mixing import TARGETS, label_domains, mix_rows
from pulse.llm.near_dedup import drop_near_duplicates
from pulse.llm.quality_classifier import classify
from pulse.llm.sharding import shard_rows, sized
from pulse.session import configure, run_dir

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    configure(spark)
    judged = classify(docs.select(*COLUMNS), _table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return judged.where("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    configure(spark)
    return drop_near_duplicates(docs.select(*COLUMNS)).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    configure(spark)
    return decontaminate(docs.select(*COLUMNS), _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target proportions of their domains. The clean ones
    stay whole, the others are thinned to their share; none is repeated."""
    configure(spark)
    labelled = label_domains(_table(spark, sf_dir, "labels"))
    return mix_rows(docs.select(*COLUMNS), labelled, TARGETS, whole="clean")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot; the texts go along."""
    configure(spark)
    return shard_rows(sized(docs.select(*COLUMNS)), ties=["text_crc32", "size"])


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# SQL cannot state the trained, hashed and edit-distance stages; the tests
# hold each of them against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder."""
    docs = _table(configure(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = run_dir(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
