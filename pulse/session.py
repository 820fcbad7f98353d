"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan here relies on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session.

    Python workers get the folder of this package on their path, so that
    stages that use its functions run wherever the caller was started.
    """
    env, home = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        env["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pulse")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.

    Only a local session that names none gets a folder of its own; on a
    cluster a machine-local folder would not be seen by the executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="pulse-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_made: list[str] = []


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one; :func:`drop_intermediates` removes it."""
    jvm = spark.sparkContext._jvm
    _made.append(f"{shared_dir(spark)}/{name}-{jvm.java.util.UUID.randomUUID()}")
    return _made[-1]


def drop_intermediates(spark: SparkSession) -> int:
    """Remove the folders this session made so far and return their number.

    For callers that are done with the results built on them.
    """
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), len(_made)
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)
    return n


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Rows written to the shared folder and read back.

    For rows that several jobs read: they survive a lost executor, are not
    computed again, and cannot go stale as a cached plan over the same path
    can. The planner also knows their real size, so a small side is broadcast
    when it fits Spark's limit and is not when it does not fit.
    """
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(spark: SparkSession) -> int:
    """How many pieces to cut one group into: follows the shuffle width."""
    return min(256, max(16, int(spark.conf.get("spark.sql.shuffle.partitions"))))
