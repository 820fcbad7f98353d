"""Structured Streaming: ingest, de-duplication, activity, spikes, scoring.

A stream of landed files is read, never polled. State is bounded by
watermarks or kept per key in RocksDB. Results go to files in the shared
folder, written per batch under the batch's own number, so a batch that runs
again after a failure replaces its rows and adds none.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pulse.functions import fixed as X
from pulse.operators.correlation import nearest_event
from pulse.operators.models import score
from pulse.operators.series import spikes
from pulse.sources.sinks import append_log


def ingest_stream(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", pattern: str | None = None, max_files: int = 1000
) -> DataFrame:
    """Files landing in a folder as a stream; ``pattern`` selects names, of
    files or of folders of files, as a table of several parts is one."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(fmt)
    if not pattern:
        return reader.load(folder)
    # Braces make a plain name a pattern too: only then may it name a single file.
    return reader.load(f"{folder}/{{{pattern}}}")


def dedup_stream(df: DataFrame, key: str = "post_id", ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """The first row of each key within ``delay``, with bounded state: keys
    are forgotten after it, and rows later than the watermark are dropped.
    :func:`dedup_history` keeps every key for good."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, on disk and with
    look-ups by key, whatever the session uses otherwise."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class FirstRow(StatefulProcessor):
    """Lets the first row of each key through, once."""

    def __init__(self, order: list[str]):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if not self.seen.exists():
            self.seen.update((True,))
            # NULLs come first, as in an ascending sort.
            first = min(rows, key=lambda r: [(r[c] is not None, r[c]) for c in self.order])
            yield Row(**{c: first[c] for c in first.__fields__ if c != "_key"})


def dedup_history(
    df: DataFrame, folder: str, key: str = "post_id", order: list[str] | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """The first row of each key over the whole history, whatever the order in
    which files arrive.

    The keys seen so far are the state of the query, so a batch looks up its
    own keys only: no row written before and no other key is read. NULL counts
    as one key, of which one row stays. With ``order`` the first row of the
    key's first batch is kept, which compares that key's rows in Python;
    without it Spark's own operator keeps any of them.
    """
    if order:
        keyed = df.withColumn("_key", F.col(key)).groupBy("_key")
        out = keyed.transformWithState(FirstRow(order), outputStructType=df.schema, outputMode="append", timeMode="none")
    else:
        out = df.dropDuplicates([key])
    with rocksdb_state(df.sparkSession):
        return write_batches(out, folder, trigger)


def activity_stream(
    df: DataFrame, size: str = "1 day", slide: str | None = None, delay: str = "1 day", ts: str = "ts", by: list[str] | None = None
) -> DataFrame:
    """Volume and engagement per time window, once the window is closed.

    Windows that slide follow the calendar, unlike the row windows of the
    batch series, which skip empty buckets.
    """
    return (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, size, slide), *(by or []))
        .agg(
            F.count("post_id").alias("volume"),
            F.sum("engagement_metric").alias("engagement_sum"),
            F.avg("engagement_metric").alias("engagement_mean"),
        )
        .select(F.col("window.start").alias("bucket"), *(by or []), "volume", "engagement_sum", "engagement_mean")
    )


def sentiment_stream(df: DataFrame, size: str = "7 days", slide: str = "1 day", delay: str = "1 day", ts: str = "ts") -> DataFrame:
    """Sentiment per sliding window."""
    s = F.col("sentiment_numeric")
    return (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, size, slide))
        .agg(F.avg(s).alias("sentiment_mean"), F.count(s).alias("n"))
        .select(F.col("window.start").alias("bucket"), "sentiment_mean", "n")
    )


def score_stream(df: DataFrame, model: PipelineModel) -> DataFrame:
    return score(df, model)


def enrich_stream(df: DataFrame, triggers: DataFrame, ts: str = "ts", max_days: int = 7) -> DataFrame:
    """Each event with the nearest known trigger, by a stream-static join."""
    return nearest_event(df.withColumn("event_date", F.to_date(ts)), triggers, max_days)


def _start(df: DataFrame, write: Callable[[DataFrame, int], None], folder: str, trigger: dict | None) -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def write_batches(
    df: DataFrame,
    folder: str,
    trigger: dict | None = None,
    per_batch: Callable[[DataFrame], DataFrame] | None = None,
    on_batch: Callable[[int, int], None] | None = None,
) -> StreamingQuery:
    """Start a query that writes every batch to ``folder/rows/batch=N``;
    ``on_batch`` is told the number of the batch and its rows."""

    def write(rows: DataFrame, batch: int) -> None:
        out = per_batch(rows) if per_batch else rows
        path = f"{folder}/rows/batch={batch}"
        out.write.mode("overwrite").parquet(path)
        if on_batch:
            on_batch(batch, rows.sparkSession.read.schema(out.schema).parquet(path).count())

    return _start(df, write, folder, trigger)


def read_batches(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/rows").drop("batch")


def activity_sums() -> dict[str, Column]:
    """Volume and engagement as sums for :func:`window_batches`."""
    return {
        "volume": F.count("post_id"),
        "engagement_sum": F.sum("engagement_metric"),
        "engagement_n": F.count("engagement_metric"),
    }


def sentiment_sums() -> dict[str, Column]:
    return {"sentiment_sum": F.sum("sentiment_numeric"), "n": F.count("sentiment_numeric")}


MARKS = "watermark timestamp, n_read long, n_counted long, n_late long"


def window_batches(
    df: DataFrame,
    folder: str,
    sums: dict[str, Column],
    size: str = "1 day",
    slide: str | None = None,
    delay: str = "1 day",
    ts: str = "ts",
    by: list[str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Sums per time window, final once the window is closed, and the rows that
    came too late for theirs as a side output: read = counted + late.

    The watermark of a batch is the newest ``ts`` of the batches before it less
    ``delay``; a window that ends at or before it is closed. A row without
    ``ts``, or all of whose windows were closed before its batch, is late and
    goes as it is to ``folder/late/batch=N``; any other row counts in those of
    its windows that are open. ``folder/rows/batch=N`` holds the windows the
    batch closes and, not ``closed``, the partial sums of those it leaves open,
    which are all that the next batch reads of the past. ``folder/marks/batch=N``
    holds the watermark and the counts. Everything goes by the batch's number,
    so a batch that runs again starts from the same state and replaces what it
    wrote. ``sums`` must be aggregates that add up.
    """
    keys, slide = list(by or []), slide or size
    long, step = (F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {x}")) for x in (size, slide))
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    newest_start = at - F.pmod(at, step)

    def write(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        past = spark.read.schema(MARKS).parquet(f"{folder}/marks/batch={batch - 1}").first() if batch else None
        mark = F.lit(past["watermark"] if past else None).cast("timestamp")
        shut = F.coalesce(F.unix_micros(mark), F.lit(-(1 << 62)))
        late = at.isNull() | (newest_start + long <= shut)
        kept = rows.persist(StorageLevel.DISK_ONLY)
        try:
            facts = kept.agg(F.count(F.lit(1)).alias("n"), F.count_if(late).alias("late"), F.max(at).alias("newest")).first()
            kept.where(late).write.mode("overwrite").parquet(f"{folder}/late/batch={batch}")
            starts = F.sequence(newest_start - (F.ceil(long / step) - 1).cast("long") * step, newest_start, step)
            own = kept.where(~late).withColumn("_start", F.explode(starts))
            own = own.where((F.col("_start") + long > at) & (F.col("_start") + long > shut))
            own = own.groupBy(*keys, F.timestamp_micros("_start").alias("bucket")).agg(*[c.alias(n) for n, c in sums.items()])
            if batch:
                before = spark.read.parquet(f"{folder}/rows/batch={batch - 1}").where("NOT closed").drop("closed")
                own = own.unionByName(before).groupBy(*keys, "bucket").agg(*[F.sum(n).alias(n) for n in sums])
            newest = F.timestamp_micros(F.lit(facts["newest"]).cast("long")) - F.expr(f"INTERVAL {delay}")
            now = F.greatest(newest, mark)
            own = own.withColumn("closed", F.coalesce(F.unix_micros("bucket") + long <= F.unix_micros(now), F.lit(False)))
            own.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")
            counts = [F.lit(n).cast("long").alias(c) for c, n in (("n_read", facts["n"]), ("n_counted", facts["n"] - facts["late"]), ("n_late", facts["late"]))]
            one = spark.range(1, numPartitions=1).select(now.alias("watermark"), *counts)
            one.write.mode("overwrite").parquet(f"{folder}/marks/batch={batch}")
        finally:
            kept.unpersist()

    return _start(df, write, folder, trigger)


def closed_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The final windows that :func:`window_batches` wrote."""
    return read_batches(spark, folder).where("closed").drop("closed")


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that came too late, with the ``batch`` they came in."""
    return spark.read.parquet(f"{folder}/late")


def batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    """``batch, watermark, n_read, n_counted, n_late``."""
    return spark.read.parquet(f"{folder}/marks")


SPIKE_ROW = (
    "bucket timestamp, volume long, engagement_sum double, engagement_mean double, vol_mean double, vol_std double, vol_zscore double, "
    "eng_mean double, eng_std double, eng_zscore double, is_spike boolean, is_eng_spike boolean"
)
RING_ROW = "bucket timestamp, volume long, engagement_sum double, engagement_mean double"


class SpikeRing(StatefulProcessor):
    """Keeps the newest buckets of a key and rates each new one against them."""

    def __init__(self, rows: int, z: float, by: list[str]):
        self.rows, self.z, self.by = rows, z, by

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.ring = handle.getListState("ring", RING_ROW)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in RING_ROW.split(", ")]
        new = pd.concat(list(rows))[names].sort_values("bucket")
        old = pd.DataFrame(list(self.ring.get()), columns=names)
        every = pd.concat([old, new], ignore_index=True) if len(old) else new.reset_index(drop=True)
        out = every.copy()
        for value, prefix, flag in (("volume", "vol", "is_spike"), ("engagement_sum", "eng", "is_eng_spike")):
            window = every[value].astype(float).rolling(self.rows, min_periods=1)
            mean, std = window.mean(), window.std().fillna(0.0)
            score = (every[value] - mean) / (std + X.STD_GUARD)
            out[f"{prefix}_mean"], out[f"{prefix}_std"], out[f"{prefix}_zscore"], out[flag] = mean, std, score, score > self.z
        newest = every.tail(self.rows - 1)
        self.ring.put([(r[0].to_pydatetime(), int(r[1]), *(None if pd.isna(x) else float(x) for x in r[2:])) for r in newest.itertuples(index=False)])
        for c, v in zip(self.by, key, strict=False):
            out[c] = v
        columns = [*self.by, *(c.split()[0] for c in SPIKE_ROW.split(", "))]
        yield out.iloc[len(old) :][columns]


def spike_stream(
    buckets: DataFrame,
    folder: str,
    freq: str = "day",
    z: float = X.SPIKE_Z,
    trigger: dict | None = None,
    by: list[str] | None = None,
) -> StreamingQuery:
    """Flag spikes as buckets close, each key of ``by`` against its own past.

    ``buckets`` is a stream of closed buckets as :func:`activity_stream` gives
    them, with the columns of ``by``; buckets of a key arrive in order of time,
    whatever the order of the files. The state of a key is a ring of its newest
    buckets, one rolling window less one, so no batch reads or lists what
    earlier ones wrote. A key whose value is NULL is a key like others.
    """
    own = list(by or [])
    ring = SpikeRing(X.DAILY_WINDOW if freq == "day" else X.HOURLY_WINDOW, z, own)
    schema = T.StructType([*[buckets.schema[c] for c in own], *T.StructType.fromDDL(SPIKE_ROW).fields])
    keyed = buckets.groupBy(*own) if own else buckets.withColumn("_all", F.lit(0)).groupBy("_all")
    flagged = keyed.transformWithStateInPandas(
        ring, outputStructType=schema, outputMode="append", timeMode="none"
    )
    with rocksdb_state(buckets.sparkSession):
        return write_batches(flagged, folder, trigger)


def isolated_ingest(
    spark: SparkSession,
    sources: dict[str, Callable[[], DataFrame] | None],
    folder: str,
    run_ts: str,
    timeout: float | None = None,
    log_path: str | None = None,
) -> DataFrame:
    """One query per source, all at once; a source that fails does not stop
    the others, and a slow one does not hold them up.

    Returns the log ``(run_ts, source, count, status)`` of this run: rows that
    it wrote, and ``OK``, ``EMPTY``, ``ERROR``, ``TIMEOUT`` for a source
    stopped after ``timeout`` seconds, or ``SKIP`` for one given as None. With
    ``log_path`` the log is appended there too.
    """
    counts: dict[str, dict[int, int]] = {name: {} for name in sources}
    status: dict[str, str] = {}
    queries: dict[str, StreamingQuery] = {}
    for name, make in sources.items():
        if make is None:
            status[name] = "SKIP"
            continue
        try:
            queries[name] = write_batches(make(), f"{folder}/{name}", on_batch=counts[name].__setitem__)
        except Exception:  # noqa: BLE001 - the log is where a failing source shows
            status[name] = "ERROR"
    deadline = None if timeout is None else time.monotonic() + timeout
    for name, q in queries.items():
        try:
            ended = q.awaitTermination() if deadline is None else q.awaitTermination(max(0.001, deadline - time.monotonic()))
            if deadline is not None and not ended:
                q.stop()
                status[name] = "TIMEOUT"
        except Exception:  # noqa: BLE001
            status[name] = "ERROR"
    log = []
    for name in sources:
        n = sum(counts[name].values())
        log.append((run_ts, name, n, status.get(name, "OK" if n else "EMPTY")))
    out = spark.createDataFrame(log, "run_ts string, source string, count long, status string")
    if log_path:
        append_log(out, log_path)
    return out
