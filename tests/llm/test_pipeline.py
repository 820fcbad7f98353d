from collections import Counter

import pytest
from test_near_dedup import brute

import corpus_pipeline as P
from pulse.llm import decontamination as D


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    """The rows before and after each stage, written and read as ``run`` does."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "rows")
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs.collect(), after.collect(), after.columns))
        docs = after
    return out


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "near duplicates", "decontamination", "mixing", "sharding"]
    assert all(c == P.COLUMNS for _, _, c in steps[:-1])
    assert steps[-1][2] == [*P.COLUMNS, "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    for before, after, _ in steps:
        assert {tuple(r)[:5] for r in after} <= {tuple(r) for r in before}


def test_quality_rejects_bad_and_keeps_good(spark, folder, steps):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[0][1]}
    good, bad = ([i for i, q in label.items() if q == v] for v in (1, 0))
    assert sum(i in kept for i in good) >= 0.97 * len(good) and sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_one_of_each_group_stays(steps):
    before, after, _ = steps[1]
    root = brute([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted({i for i, c in root.items() if i == c})


def test_no_benchmark_passage_is_left(spark, folder, steps):
    items = [D.normal(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    before, after, _ = steps[2]

    def dirty(text):
        t = D.normal(text)
        return any(x in t or D.nearest(x, t)[0] <= D.budget(len(x), D.ERROR_RATE) for x in items)

    assert {r.doc_id for r in after} == {r.doc_id for r in before if not dirty(r.text)}


def test_mixing_thins_toxic_and_keeps_clean(spark, folder, steps):
    label = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    before, after, _ = steps[3]
    kept, clean = {r.doc_id for r in after}, [r.doc_id for r in before if label.get(r.doc_id) == (1, 0)]
    assert len(kept) == len(after) and sum(i in kept for i in clean) >= 0.9 * len(clean)


def test_shards_are_even_and_gapless(steps):
    before, after, _ = steps[4]
    counts = Counter(r.shard for r in after)
    assert len(before) == len(after) and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in after if r.shard == s) == list(range(n)) for s, n in counts.items())


def test_stages_on_odd_and_on_no_rows(spark, folder, odd_docs):
    docs = odd_docs.selectExpr("doc_id", "text", "lang", "source", "CAST(length(text) AS BIGINT) AS n_chars", "extra", "_f", "kept")
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        rows = out.collect()
        assert out.columns[:5] == P.COLUMNS, name
        assert len(rows) <= docs.count() and (name != "sharding" or len(rows) == docs.count())
        assert stage(spark, docs.limit(0), folder).count() == 0, name
