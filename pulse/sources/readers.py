"""Readers: raw text tables, harmonised files, latest run, table stats."""

from __future__ import annotations

import csv
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.functions import fixed as X
from pulse.operators.integrity import stack


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_raw_csv(
    spark: SparkSession, path: str | list[str], columns: list[str] | None = None, multi_line: bool = True
) -> DataFrame:
    """Every column as text, blanks kept as empty strings.

    With ``columns`` no pass over the file is needed to learn its header.
    Cells may hold line breaks; where none do, ``multi_line=False`` lets large
    files be split over tasks.
    """
    reader = spark.read.options(header=True, multiLine=multi_line, escape='"')
    if columns:
        reader = reader.schema(_text_schema(columns))
    return reader.csv(path).na.fill("")


def read_raw_json(
    spark: SparkSession, path: str | list[str], columns: list[str] | None = None, lines: bool = False
) -> DataFrame:
    """JSON records as text; missing values are empty.

    Files hold one array of records, or one record per line with ``lines``,
    which lets large files be split over tasks.
    """
    reader = spark.read.options(multiLine=not lines, primitivesAsString=True)
    if columns:
        reader = reader.schema(_text_schema(columns))
    return reader.json(path).na.fill("").replace("nan", "")


def read_typed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with types: given ones, else inferred by an extra pass."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def harmonise(df: DataFrame, required: list[str] = X.REQUIRED_COLUMNS) -> DataFrame:
    """Required columns first, missing ones as empty text."""
    have = set(df.columns)
    extra = [c for c in df.columns if c not in required]
    return df.select(*[F.col(c) if c in have else F.lit("").alias(c) for c in required], *extra)


def _header(spark: SparkSession, file) -> tuple[str, ...]:
    """The column names in the first line of a CSV file, compressed or not."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    stream = file.getFileSystem(conf).open(file)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(file)
        plain = codec.createInputStream(stream) if codec is not None else stream
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()
    if line is None:
        raise ValueError("empty file")
    return tuple(next(csv.reader([line.lstrip("\ufeff")])))


def _files(spark: SparkSession, path: str) -> list:
    """The data files a path or pattern stands for, without markers."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    home = jvm.org.apache.hadoop.fs.Path(path)
    fs, out = home.getFileSystem(conf), []
    for found in fs.globStatus(home) or []:
        inside = fs.listStatus(found.getPath()) if found.isDirectory() else [found]
        out += [f.getPath() for f in inside if f.isFile() and f.getPath().getName()[0] not in "._"]
    if not out:
        raise FileNotFoundError(path)
    return out


def _readable(spark: SparkSession, files: list[str], on_skip: Callable[[str, str], None]) -> list[str]:
    """The files that can be read to their end. All are tried in one job; only
    if it fails is each of them tried alone."""

    def broken(some: list[str]) -> str | None:
        try:
            spark.read.option("ignoreCorruptFiles", False).text(some).agg(F.sum(F.length("value"))).collect()
        except Exception as e:  # noqa: BLE001 - the report is where a failing file shows
            return str(e).split("\n", 1)[0]
        return None

    if broken(files) is None:
        return files
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda f: broken([f]), files))
    for f, why in zip(files, found, strict=True):
        if why is not None:
            on_skip(f, why)
    return [f for f, why in zip(files, found, strict=True) if why is None]


def read_harmonised(
    spark: SparkSession,
    paths: list[str],
    required: list[str] = X.REQUIRED_COLUMNS,
    on_skip: Callable[[str, str], None] | None = None,
    probe: bool = True,
    multi_line: bool = True,
) -> DataFrame:
    """Files of differing columns stacked into one table.

    A path that does not exist, and a file that is empty or breaks while it is
    read, such as a truncated archive, is left out and reported to
    ``on_skip(path, reason)``; the other files of its folder stay. Files with
    one header are read together, so the plan has a branch per header and not
    per file. ``probe=False`` saves the pass that looks for broken files; then
    one gives the rows that can be read of it, which may be none.
    """
    report = on_skip or (lambda path, why: None)

    def headers(path: str) -> list[tuple[str, tuple[str, ...] | Exception]]:
        try:
            files = _files(spark, path)
        except Exception as e:  # noqa: BLE001
            return [(path, e)]
        out = []
        for f in files:
            try:
                out.append((f.toString(), _header(spark, f)))
            except Exception as e:  # noqa: BLE001
                out.append((f.toString(), e))
        return out

    with ThreadPoolExecutor(8) as pool:
        found = [x for own in pool.map(headers, paths) for x in own]
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in found:
        if isinstance(header, Exception):
            report(path, str(header).split("\n", 1)[0])
        else:
            groups.setdefault(header, []).append(path)
    frames = []
    for header, files in groups.items():
        files = _readable(spark, files, report) if probe else files
        if files:
            options = {"header": True, "multiLine": multi_line, "escape": '"', "ignoreCorruptFiles": not probe}
            rows = spark.read.options(**options).schema(_text_schema(list(header))).csv(files)
            frames.append(harmonise(rows.na.fill(""), required))
    if not frames:
        raise ValueError("no file could be read")
    return stack(*frames)


def merge_bonus(frames: list[DataFrame]) -> DataFrame:
    """Scraped sources in one shape; unnamed ones get default names."""
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    out = stack(*[harmonise(f, X.BONUS_COLUMNS) for f in frames])
    return out.withColumns(
        {
            "source_name": F.when(blank("source_type") | blank("source_name"), F.col("source")).otherwise(F.col("source_name")),
            "source_type": F.when(blank("source_type"), "bonus_live_scraped").otherwise(F.col("source_type")),
        }
    )


def first_rows(df: DataFrame, n: int = 5000, order: list[str] | None = None) -> DataFrame:
    """A quick look at up to ``n`` rows: the first in ``order``, else any."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def latest_run(spark: SparkSession, folder: str, kinds: tuple[str, ...] = ("scored", "merged")) -> DataFrame:
    """Rows of the newest run of the first kind that has any, with ``kind``
    and ``run_ts``.

    Runs are folders ``kind=.../run_ts=...``. Their names are listed, newest
    first; no other run's rows are read.
    """
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for kind in kinds:
        home = jvm.org.apache.hadoop.fs.Path(f"{folder}/kind={kind}")
        names = [f.getPath().getName() for f in fs.listStatus(home)] if fs.exists(home) else []
        for name in sorted((n for n in names if n.startswith("run_ts=")), reverse=True):
            rows = spark.read.parquet(f"{folder}/kind={kind}/{name}")
            if not rows.isEmpty():
                return rows.withColumns({"kind": F.lit(kind), "run_ts": F.lit(name.removeprefix("run_ts="))})
    raise FileNotFoundError(f"no run of {kinds} below {folder}")


def source_stats(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Rows and first and last time per source; reads two columns only."""
    return df.select("source", ts).groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )
