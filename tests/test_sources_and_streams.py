"""Round trips through files, and streams against their batch form."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulse.operators import series as S
from pulse.plans.all_queries import ORACLES, QUERIES
from pulse.session import run_dir, shared_dir
from pulse.sources import payloads as Y
from pulse.sources import readers as D
from pulse.sources import sinks
from pulse.streaming import streams as T


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    (tmp_path / "a.csv").write_text('post_id,text\n1,"two\nlines, ""quoted"""\n2,\n3,NULL\n4,nan\n')
    got = {r.post_id: r.text for r in D.read_raw_csv(spark, str(tmp_path / "a.csv")).collect()}
    assert got == {"1": 'two\nlines, "quoted"', "2": "", "3": "NULL", "4": "nan"}


def test_json_array(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": 1, "x": None}, {"id": 2, "x": "nan"}, {"id": 3, "x": 1.5}]))
    rows = D.read_raw_json(spark, str(tmp_path / "a.json")).collect()
    assert [(r.id, r.x) for r in rows] == [("1", ""), ("2", ""), ("3", "1.5")]


def test_unreadable_file_is_reported(spark, tmp_path):
    (tmp_path / "a.csv").write_text("post_id\n1\n")
    skipped = []
    df = D.read_harmonised(spark, [str(tmp_path / "a.csv"), str(tmp_path / "none.csv")], on_skip=lambda p, e: skipped.append(p))
    assert df.columns[:5] == ["post_id", "source", "text", "timestamp", "engagement_metric"]
    assert df.first().text == "" and skipped == [str(tmp_path / "none.csv")]


def test_files_that_break_are_left_out_and_headers_share_a_branch(spark, tmp_path):
    import gzip

    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(6):
        (folder / f"a{k}.csv").write_text("post_id,text\n" + "".join(f"{k}-{i},t{i}\n" for i in range(50)))
    (folder / "b.csv").write_text('source,"post_id"\nweb,b-0\n')
    (folder / "empty.csv").write_text("")
    packed = gzip.compress("post_id,text\n".encode() + "".join(f"z{i},{'x' * 50}{i * 7919}\n" for i in range(20_000)).encode())
    (folder / "whole.csv.gz").write_bytes(packed)
    (folder / "cut.csv.gz").write_bytes(packed[: len(packed) // 2])
    skipped = {}
    df = D.read_harmonised(spark, [str(folder), str(tmp_path / "none")], on_skip=lambda p, why: skipped.__setitem__(p.rsplit("/", 1)[-1], why))
    assert set(skipped) == {"cut.csv.gz", "empty.csv", "none"}
    assert df.count() == 6 * 50 + 1 + 20_000
    assert df.where("post_id = 'b-0'").first().asDict() == {"post_id": "b-0", "source": "web", "text": "", "timestamp": "", "engagement_metric": ""}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    kept = D.read_harmonised(spark, [str(folder)], probe=False)
    assert df.count() <= kept.count() < df.count() + 20_000


def test_a_repeated_run_replaces_its_rows(spark, tmp_path):
    log = str(tmp_path / "log")
    for run_id, n in (("007", 2), ("a+b/c %", 5), ("007", 3)):
        sinks.append_run(spark.range(n).withColumn("stage", F.lit("s")), log, run_id)
    counts = {r.run_id: r["count"] for r in sinks.read_runs(spark, log).groupBy("run_id").count().collect()}
    assert counts == {"007": 3, "a+b/c %": 5}


def test_latest_run_prefers_scored(spark, tmp_path):
    df = spark.range(2)
    sinks.write_run(df, str(tmp_path), "merged", "2024-02")
    assert D.latest_run(spark, str(tmp_path)).count() == 2
    sinks.write_run(df.limit(1), str(tmp_path), "scored", "2024-01")
    assert D.latest_run(spark, str(tmp_path)).count() == 1


def test_hits_without_text_are_dropped(spark):
    body = json.dumps({"hits": [{"objectID": "1", "title": " "}, {"objectID": "2", "comment_text": "", "title": "T", "points": None}]})
    rows = Y.normalise_hits(spark.createDataFrame([("q", body)], "query string, payload string")).collect()
    assert [(r.post_id, r.text, r.engagement_metric) for r in rows] == [("2", "T", 0.0)]


def test_review_range_is_closed(spark):
    rows = [("en", "in", json.dumps({"reviewId": str(i), "content": "c", "at": at})) for i, at in enumerate(
        ["2021-01-01", "2021-01-31", "2021-01-31 00:00:01", "bad"])]
    df = spark.createDataFrame(rows, "lang string, country string, payload string")
    assert [r.post_id for r in Y.normalise_reviews(df, "2021-01-01", "2021-01-31").collect()] == ["0", "1"]


def test_shared_folder_is_the_clusters(spark):
    assert run_dir(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert spark.conf.get("spark.checkpoint.dir") == shared_dir(spark)


SCHEMA = "post_id string, ts timestamp, engagement_metric double"


def _land(spark, path, rows):
    spark.createDataFrame(rows, "post_id string, ts string, engagement_metric double").withColumn(
        "ts", F.col("ts").cast("timestamp")
    ).coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_batch_and_drops_late_rows(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = [(f"a{d}{i}", f"2024-01-{d:02d} 0{i}:00:00", 1.0) for d in range(1, 11) for i in range(d % 3 + 1)]
    _land(spark, src, first)

    def run():
        stream = T.ingest_stream(spark, src, StructType.fromDDL(SCHEMA))
        T.write_batches(T.activity_stream(stream), out).awaitTermination()
        return {str(r.bucket.date()): r.volume for r in T.read_batches(spark, out).collect()}

    batch = S.activity(spark.read.parquet(src), ts="ts").where("bucket < timestamp'2024-01-09'").collect()
    assert run() == {str(r.bucket.date()): r.volume for r in batch}
    _land(spark, src, [("late", "2024-01-02 12:00:00", 1.0), ("new", "2024-01-20 00:00:00", 1.0)])
    got = run()
    assert got["2024-01-02"] == 3  # the late row came after its day was closed
    assert got["2024-01-10"] == 2


def test_stream_dedup_keeps_one(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _land(spark, src, [("a", "2024-01-01 00:00:00", 1.0), ("a", "2024-01-01 05:00:00", 2.0), ("b", "2024-01-01 06:00:00", 1.0)])
    T.write_batches(T.dedup_stream(T.ingest_stream(spark, src, StructType.fromDDL(SCHEMA))), out).awaitTermination()
    assert sorted(r.post_id for r in T.read_batches(spark, out).collect()) == ["a", "b"]


def test_pattern_names_files_and_folders_of_files(spark, tmp_path):
    _land(spark, str(tmp_path / "rows.parquet"), [("a", "2024-01-01 00:00:00", 1.0)])
    _land(spark, str(tmp_path / "rows.parquet"), [("b", "2024-01-02 00:00:00", 1.0)])
    _land(spark, str(tmp_path / "rows.parquet.old"), [("c", "2024-01-02 00:00:00", 1.0)])
    one = next((tmp_path / "rows.parquet").glob("part-*.parquet"))

    def read(folder, pattern, name):
        stream = T.ingest_stream(spark, str(folder), StructType.fromDDL(SCHEMA), pattern=pattern)
        counts = {}
        T.write_batches(stream, str(tmp_path / name), on_batch=counts.__setitem__).awaitTermination()
        return sum(counts.values())

    assert read(tmp_path, "rows.parquet", "folder") == 2
    assert read(tmp_path / "rows.parquet", one.name, "file") == 1
    assert read(tmp_path, "absent.parquet", "absent") == 0


def test_history_keeps_late_keys_and_drops_distant_copies(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    files = [[("a", "2024-03-01 00:00:00", 1.0)], [("late", "2024-01-01 00:00:00", 1.0)], [("a", "2024-06-01 00:00:00", 1.0), ("b", "2024-06-01 00:00:00", 1.0)]]
    for rows in files:
        _land(spark, src, rows)
        stream = T.ingest_stream(spark, src, StructType.fromDDL(SCHEMA), max_files=1)
        T.dedup_history(stream, out, order=["ts"]).awaitTermination()
    got = sorted((r.post_id, r.ts.month) for r in T.read_batches(spark, out).collect())
    assert got == [("a", 3), ("b", 6), ("late", 1)]


def test_landings_are_written_and_read_in_parallel(spark, folder, tmp_path, monkeypatch):
    import pulse.plans.source_queries as Q

    whole = Q.table
    monkeypatch.setattr(Q, "table", lambda *a: whole(*a).repartition(4))
    monkeypatch.setattr(Q, "run_dir", lambda spark, name: str(tmp_path / name))
    keys = [r.dup_id for r in QUERIES["stream_dedup"](spark, folder).collect()]
    want = {i - (i % 33 == 32) for (i,) in whole(spark, folder, "events").select("event_id").collect()}
    assert sorted(keys) == sorted(f"p{i}" for i in want)
    assert len(list((tmp_path / "landed").glob("*.parquet"))) == 12
    assert len(list((tmp_path / "dedup" / "rows").glob("batch=*"))) == 3


def test_ingest_counts_the_run_and_tells_timeouts(spark, tmp_path):
    src, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    _land(spark, src, [("a", "2024-01-01 00:00:00", 1.0), ("b", "2024-01-01 05:00:00", 2.0)])

    def slow(rows):
        return rows.withColumn("post_id", F.udf(lambda x: __import__("time").sleep(30) or x)("post_id"))

    sources = {"s": lambda: T.ingest_stream(spark, src, StructType.fromDDL(SCHEMA))}
    for run, want in (("r1", (2, "OK")), ("r2", (0, "EMPTY"))):
        got = T.isolated_ingest(spark, sources, out, run, log_path=log).first()
        assert (got["count"], got["status"]) == want
    assert spark.read.parquet(log).count() == 2
    late = {"s": lambda: slow(T.ingest_stream(spark, src, StructType.fromDDL(SCHEMA)))}
    got = T.isolated_ingest(spark, late, str(tmp_path / "slow"), "r3", timeout=2).first()
    assert (got["count"], got["status"]) == (0, "TIMEOUT")


def test_spike_stream_over_two_runs_equals_batch(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    days = [3, 3, 3, 3, 3, 3, 60, 3, 3, 3, 3, 50, 3, 3]

    def rows(lo, hi):
        return [(f"p{d}-{i}", f"2024-01-{d + 1:02d} 00:00:00", 1.0) for d in range(lo, hi) for i in range(days[d])]

    def run():
        T.spike_stream(T.activity_stream(T.ingest_stream(spark, src, StructType.fromDDL(SCHEMA))), out).awaitTermination()

    _land(spark, src, rows(0, 9))
    run()
    _land(spark, src, rows(9, 14))
    run()
    got = {str(r.bucket.date()): (r.volume, r.is_spike) for r in T.read_batches(spark, out).collect()}
    batch = S.spikes(S.activity(spark.read.parquet(src), ts="ts")).collect()
    want = {str(r.bucket.date()): (r.volume, r.is_spike) for r in batch}
    assert got and all(want[day] == v for day, v in got.items())
    assert any(v[1] for v in got.values()) and len(got) >= 12


def test_keyed_spikes_over_files_out_of_order_equal_the_batch_query(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "post_id string, ts timestamp, engagement_metric double, source string"
    size = {"a": [3, 4, 3, 3, 5, 3, 60, 3, 3, 2, 3, 50, 3, 3], "b": [9, 9, 8, 9, 9, 70, 9, 9, 9, 9, 9, 1, 9, 90], None: [1, 1, 1, 1, 1, 1, 1, 1, 9, 1, 1, 1, 1, 1]}
    rows = [(f"{k}{d}-{i}", f"2024-01-{d + 1:02d} {i % 24:02d}:00:00", float(i % 3), k) for k, n in size.items() for d in range(14) for i in range(n[d])]
    made = spark.createDataFrame(rows, "post_id string, ts string, engagement_metric double, source string")
    made = made.withColumn("ts", F.col("ts").cast("timestamp"))
    # Three landings; inside the first two the later days come in the earlier files.
    for lo, hi in ((1, 6), (6, 11), (11, 15)):
        part = made.where((F.dayofmonth("ts") >= lo) & (F.dayofmonth("ts") < hi))
        part.repartitionByRange(3, F.col("ts").desc()).write.mode("append").parquet(src)
        stream = T.ingest_stream(spark, src, StructType.fromDDL(schema))
        T.spike_stream(T.activity_stream(stream, by=["source"]), out, by=["source"]).awaitTermination()
    columns = ["source", "bucket", "volume", "vol_zscore", "eng_zscore", "is_spike", "is_eng_spike"]
    got = T.read_batches(spark, out)
    batch = S.spikes(S.activity(made, ts="ts", by=["source"]), by=["source"]).where("bucket < timestamp'2024-01-13'")

    def rounded(df):
        return sorted(map(str, (tuple(round(x, 6) + 0.0 if isinstance(x, float) else x for x in r) for r in df.select(*columns).collect())))

    assert rounded(got) == rounded(batch) and got.where("is_spike").count() >= 3
    assert len(list((tmp_path / "out" / "rows").glob("batch=*"))) >= 3


def test_late_rows_are_kept_aside_and_counted(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    days = {0: [5, 6, 7], 1: [1, 6, 9, 12], 2: [2, 8, 11, 13]}
    everything = []
    for k, own in days.items():
        rows = [(f"{k}-{d}-{i}", f"2024-01-{d:02d} 0{i}:00:00", 1.0) for d in own for i in range(3)] + [(f"{k}-none", None, 1.0)]
        everything += [(k, *r) for r in rows]
        _land(spark, src, rows)
        stream = T.ingest_stream(spark, src, StructType.fromDDL(SCHEMA))
        T.window_batches(stream, out, T.activity_sums(), "2 days", "1 day").awaitTermination()
    # After part 0 the watermark is Jan 6, 02:00; after part 1 Jan 11, 02:00.
    late = {(r.batch, r.post_id) for r in T.late_rows(spark, out).collect()}
    want = {(k, i) for k, i, t, _ in everything if t is None or (k == 1 and t < "2024-01-05") or (k == 2 and t < "2024-01-10")}
    assert late == want
    counts = {r.batch: (r.n_read, r.n_counted, r.n_late) for r in T.batch_counts(spark, out).collect()}
    assert all(n == c + b for n, c, b in counts.values())
    assert counts == {k: (n := sum(e[0] == k for e in everything), n - (b := sum(x[0] == k for x in want)), b) for k in days}
    closed = {str(r.bucket.date()): r.volume for r in T.closed_windows(spark, out).collect()}
    # A row that lost one of its windows still counts in the other.
    assert closed["2024-01-05"] == 6 + 3 and closed["2024-01-08"] == 3 and closed["2024-01-09"] == 3
    assert max(closed) == "2024-01-10" and len(closed) == len(T.closed_windows(spark, out).collect())


def test_history_reads_keys_of_the_batch_only(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    progress = []
    for k in range(3):
        rows = [(f"k{i}", f"2024-01-0{k + 1} 00:00:00", float(k)) for i in range(100 * k, 100 * k + 110)] + [(None, "2024-01-01 00:00:00", 1.0)] * 2
        _land(spark, src, rows)
        q = T.dedup_history(T.ingest_stream(spark, src, StructType.fromDDL(SCHEMA)), out)
        q.awaitTermination()
        progress.append([p for p in q.recentProgress if p["numInputRows"]][-1])
    keys = [r.post_id for r in T.read_batches(spark, out).collect()]
    assert len(keys) == len(set(keys)) == 311 and keys.count(None) == 1
    # The state holds all keys; a batch reads its own rows and adds its new keys.
    assert [p["numInputRows"] for p in progress] == [112, 112, 112]
    assert [p["stateOperators"][0]["numRowsUpdated"] for p in progress] == [111, 100, 100]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] == 311
    assert "rocksdbGetCount" in progress[-1]["stateOperators"][0]["customMetrics"]


# Fitting several models on the driver data takes minutes, so only the quick ones run here.
QUICK = [
    "negation_feature_gain", "seed_stability", "feature_weights", "scored_posts", "stream_scored", "phase_topics",
    "bootstrap_interval", "near_duplicate_sets_lsh", "detect_roles", "standardise", "impute_median_approx",
    "column_overview_approx", "segment_medians_approx", "user_rollup_approx", "mcnemar_p_value", "result_documents",
]


@pytest.mark.parametrize("name", QUICK)
def test_queries_without_oracle_yield_rows(spark, folder, name):
    assert name not in ORACLES
    assert QUERIES[name](spark, folder).count() > 0


def test_stream_scored_reads_a_table_of_several_parts(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").repartition(2).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = QUERIES["stream_scored"](spark, str(tmp_path))
    assert got.count() == got.select("post_id").distinct().count() == spark.read.parquet(f"{folder}/documents.parquet").count()
