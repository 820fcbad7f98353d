"""Operators on small tables: NULLs, ties, single rows, hot groups."""

import collections
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from pulse.operators import cleaning as C
from pulse.operators import correlation as K
from pulse.operators import engagement as E
from pulse.operators import evaluation as V
from pulse.operators import integrity as I
from pulse.operators import profiling as Q
from pulse.operators import ranking as R
from pulse.operators import series as S
from pulse.operators import similarity as Z
from pulse.operators import splits as L
from pulse.operators import terms as M

POSTS = "post_id string, user_id string, platform string, likes double, shares long, comments long"


def posts(spark, rows):
    return spark.createDataFrame(rows, POSTS)


def test_engagement_is_null_when_a_part_is(spark):
    df = posts(spark, [("a", "u", "X", 1.0, 2, 3), ("b", "u", "X", None, 2, 3)])
    got = {r.post_id: (r.total_engagement, r.has_null_component) for r in E.with_engagement(df).collect()}
    assert got == {"a": (6.0, 0), "b": (None, 1)}


def test_above_average_may_be_empty(spark):
    df = posts(spark, [("a", "u", "X", 1.0, 0, 0), ("b", "u", "X", 2.0, 0, 0)])
    assert E.above_group_average(df).count() == 0
    assert [r.post_id for r in E.above_group_average(df, 1.2).collect()] == ["b"]


def test_percentile_counts_nulls_and_ties(spark):
    rows = [(str(i), "u", "X", float(v), 0 if v < 9 else None, 0) for i, v in enumerate([1, 1, 2, 9])]
    ranks = {r.total_engagement: r.pct_rank for r in R.value_ranks(E.with_engagement(posts(spark, rows)), "total_engagement", ["platform"]).collect()}
    assert ranks == {1.0: 1 / 3, 2.0: 1.0}  # the NULL total ranks first


def test_one_row_platform(spark):
    df = posts(spark, [("a", "u", "X", 1.0, 0, 0)])
    assert E.top_percentile(df).count() == 0
    assert E.top_percentile(df, 0.0).first().relative_rank == 0.0


def test_growth_handles_zero_and_first_month(spark):
    m = spark.createDataFrame(
        [("X", "2024-01", 0.0), ("X", "2024-02", 5.0), ("X", "2024-03", 10.0)],
        "platform string, month string, monthly_engagement double",
    )
    got = [r.mom_growth_pct for r in E.growth(m).collect()]
    assert got == [None, None, 100.0]


def test_running_totals_on_a_hot_group(spark):
    rnd = random.Random(1)
    rows = [("hot" if rnd.random() < 0.9 else f"g{i % 3}", rnd.randint(0, 400)) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, v long").groupBy("g", "v").count().withColumnRenamed("count", "n")
    got = {(r.g, r.v): (r.n_before, r.n_total) for r in R.running_totals(df, "v", ["n"], ["g"]).collect()}
    for (g, v), (before, total) in got.items():
        same = [x for h, x in rows if h == g]
        assert before == sum(x < v for x in same)
        assert total == len(same)


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0, 3.0, 3.0], [1.0, 5.0, 9.0, 100.0], list(range(101))])
def test_quantiles_match_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    r = R.quantiles(df, ["x"], {"q1": 0.25, "m": 0.5, "p9": 0.9}).first()
    assert [r.q1, r.m, r.p9] == pytest.approx(list(np.percentile(values, [25, 50, 90])))


def test_placeholders_are_case_sensitive_unless_told(spark):
    df = spark.createDataFrame([(" n/a ",), ("N/A",), ("",), ("nay",)], "x string")
    assert [r.x for r in C.replace_placeholders(df).collect()] == [None, "N/A", None, "nay"]
    assert [r.x for r in C.replace_placeholders(df, ignore_case=True).collect()] == [None, None, None, "nay"]


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "x string")
    assert C.mode_of(df, "x").first() == Row(mode_value="a", mode_share=0.5)
    assert sorted(r.x for r in C.impute_mode(df, "x").collect()) == ["a", "a", "b"]


def test_median_of_text_keeps_odd_cells(spark):
    df = spark.createDataFrame([("1",), ("3",), (None,), ("lots",)], "x string")
    assert [r.x for r in C.impute_median(df, ["x"], text=True).collect()] == ["1", "3", "2.0", "lots"]


def test_cleaning_twice_changes_nothing(spark, folder):
    from pulse.plans import pipelines as P
    from pulse.plans.tables import raw_posts

    once = P.clean_posts(raw_posts(spark, folder))
    again = P.clean_posts(once.select(*[F.col(c).cast("string") for c in once.columns if c != "platform_was_null"]))
    cols = ["post_id", "platform", "text_content", "timestamp", "likes"]
    assert sorted(map(str, once.select(*cols).collect())) == sorted(map(str, again.select(*cols).collect()))


def test_split_location(spark):
    df = spark.createDataFrame([("A, B",), ("A",), ("A, B, C",), (None,)], "location string")
    assert [(r.city, r.country) for r in C.split_location(df).collect()] == [("A", "B"), ("A", None), ("A", "B, C"), (None, None)]


def test_drop_all_null_and_flags(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    assert C.drop_all_null(df).columns == ["a"]
    assert C.flag_nulls(df, ["a", "b"]).first().b_was_null == 1


def test_integrity_report(spark):
    users = spark.createDataFrame([("u", -1.0), ("u", 2.0)], "user_id string, follower_count double")
    df = posts(spark, [("a", "u", "X", 1.0, -1, 0), ("a", "z", "X", 1.0, 1, 0)])
    got = {r.check: r.violations for r in I.integrity_report(users, df).collect()}
    assert got == {
        "users_primary_key": 1, "posts_primary_key": 1, "posts_user_foreign_key": 1,
        "followers_not_negative": 1, "shares_not_negative": 1, "comments_not_negative": 0,
    }


def _series(spark, values):
    return spark.createDataFrame(
        [(i, float(v), float(v)) for i, v in enumerate(values)], "bucket int, volume double, engagement_sum double"
    )


def test_spike_bound_and_first_possible_bucket(spark):
    out = S.spikes(_series(spark, [1, 1, 1, 1, 1, 1, 1000])).orderBy("bucket").collect()
    assert max(r.vol_zscore for r in out) <= 6 / math.sqrt(7) + 1e-6
    assert [r.is_spike for r in out] == [False] * 6 + [True]
    early = S.spikes(_series(spark, [1, 1, 1, 1, 1000])).collect()
    assert not any(r.is_spike for r in early)


def test_exclusive_window_sees_early_spikes(spark):
    out = S.spikes(_series(spark, [1, 2, 1, 50]), exclude_current=True).orderBy("bucket").collect()
    assert out[-1].is_spike and not out[0].is_spike


def test_centred_window_needs_three_buckets(spark):
    two = spark.createDataFrame([(0, 0.5), (1, 0.7)], "bucket int, sentiment_mean double")
    assert [r.roll_mean for r in S.shifts(two).collect()] == [None, None]
    assert {r.shift_dir for r in S.shifts(two).collect()} == {"none"}


def test_rolling_matches_pandas(spark):
    import pandas as pd

    values = [random.Random(2).randint(0, 50) for _ in range(60)]
    got = S.rolling_z(_series(spark, values), "volume", 24, "r", centred=True, min_periods=3).orderBy("bucket").toPandas()
    roll = pd.Series(values, dtype=float).rolling(24, min_periods=3, center=True)
    assert got.r_mean.tolist() == pytest.approx(roll.mean().tolist())
    assert got.r_std.tolist() == pytest.approx(roll.std().fillna(0).tolist())


def test_nearest_event_ties_and_reach(spark):
    events = spark.sql("select explode(array(date'2024-01-10', date'2024-01-30')) event_date")
    trig = spark.sql("select explode(array(date'2024-01-08', date'2024-01-12')) trigger_date").withColumn("description", F.col("trigger_date").cast("string"))
    got = {str(r.event_date): str(r.trigger_date) for r in K.nearest_event(events, trig).collect()}
    assert got == {"2024-01-10": "2024-01-08", "2024-01-30": "None"}


def test_interval_is_closed_and_newest_first(spark):
    events = spark.sql("select timestamp'2024-01-10 00:00:00' event_ts")
    items = spark.sql(
        """select * from values (1, timestamp'2024-01-08 00:00:00'), (2, timestamp'2024-01-12 00:00:00'),
           (3, timestamp'2024-01-12 00:00:01'), (4, timestamp'2024-01-10 05:00:00') as t(item_id, ts)"""
    )
    assert sorted(r.item_id for r in K.within_interval(events, items).collect()) == [1, 2, 4]
    assert sorted(r.item_id for r in K.within_interval(events, items, k=2).collect()) == [2, 4]


def test_events_that_share_a_time_have_lists_of_their_own(spark):
    events = spark.sql("select * from values ('a', timestamp'2024-01-10 00:00:00'), ('b', timestamp'2024-01-10 00:00:00') as t(name, event_ts)")
    items = spark.sql("select id as item_id, timestamp'2024-01-10 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) as ts from range(6)")
    got = K.within_interval(events, items, k=5).collect()
    assert sorted((r.name, r.item_id) for r in got) == [(n, i) for n in "ab" for i in range(1, 6)]


def test_aliases_of_many_words_are_found(spark):
    from pulse.operators import terms as M

    df = spark.sql("select 'The United States of America and the states' as text")
    names = spark.sql("select * from values ('united states of america', 'usa', 'GPE'), ('states', 'state', 'GPE') as t(alias, entity, type)")
    assert {r.entity: r.mentions for r in M.entities(df, names).collect()} == {"usa": 1, "state": 2}


def test_missing_values_keep_the_columns(spark):
    from pulse.operators import cleaning as C

    config = {"a": "median", "b": "flag", "c": "drop", "d": "mode"}
    schema = "a double, b string, c string, d string, e long"
    full = C.handle_missing(spark.createDataFrame([(1.0, "x", "y", "z", 1)] * 3, schema), config)
    holes = C.handle_missing(
        spark.createDataFrame([(1.0, "x", "y", "z", 1), (3.0, None, "y", None, None), (None, "x", None, "z", 3), (None, "x", "y", "z", 5)], schema), config
    )
    assert full.dtypes == holes.dtypes and {"b_was_null", "d_was_null"} <= set(full.columns)
    rows = sorted(tuple(r[c] for c in ("a", "b_was_null", "d", "d_was_null", "e")) for r in holes.collect())
    assert rows == [(1.0, 0, "z", 0, 1.0), (2.0, 0, "z", 0, 5.0), (3.0, 1, "z", 1, 3.0)]


def _jaccard(a, b):
    grams = lambda t: {tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)}
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y) if x and y else 0.0


@pytest.fixture(scope="module")
def crowd():
    """Near copies of one text hold most rows, next to unrelated texts."""
    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 30)}x" for _ in range(60)]
    texts = []
    for i in range(60):
        if i % 3:
            t = list(base)
            for _ in range(rnd.randint(0, 3)):
                t[rnd.randrange(60)] = f"n{rnd.randint(0, 99)}y"
        else:
            t = [f"w{rnd.randint(0, 300)}x" for _ in range(rnd.randint(1, 40))]
        texts.append(" ".join(t))
    return texts + texts[:6]


def test_similarity_against_brute_force(spark, crowd):
    df = spark.createDataFrame(list(enumerate(crowd)), "id long, text string")
    test, train = df.where("id % 4 = 0"), df.where("id % 4 <> 0")
    want = {
        (i, j)
        for i, a in enumerate(crowd) for j, b in enumerate(crowd)
        if i % 4 == 0 and j % 4 and _jaccard(a, b) >= 0.8
    }
    pairs = Z.similar_sets(test, train)
    assert Z.leakage_summary(pairs).first().n_pairs == len(want)
    leaked = {i for i, _ in want}
    assert {r.id for r in Z.leaked_ids(test, train).collect()} == leaked
    rows = {r.id: (r.n_near, r.nearest_id) for r in Z.leaked_rows(test, train).collect()}
    assert {i: n for i, (n, _) in rows.items()} == {i: sum(1 for a, _ in want if a == i) for i in leaked}
    left = {r.id for r in Z.purge(test, Z.leaked_ids(test, train)).collect()}
    assert left == {i for i in range(len(crowd)) if i % 4 == 0} - leaked


def test_prefixes_leave_out_common_grams_without_a_shuffle(spark, tmp_path):
    rows = [(f"s{k}", sorted([*range(5), *range(10 * k + 10, 10 * k + 15)])) for k in range(200)]
    spark.createDataFrame(rows, "sig string, grams array<long>").write.parquet(str(tmp_path / "sets"))
    sets = spark.read.parquet(str(tmp_path / "sets"))
    counts = spark.sparkContext.broadcast(Z._bucket_counts(sets))
    assert [counts.value[k] for k in (0, 4, 5, 10, 14)] == [200, 200, 0, 1, 1]
    first = Z._rare_first(sets, counts, 0.8)
    assert "Exchange" not in first._jdf.queryExecution().executedPlan().toString()
    got = first.collect()
    assert len(got) == 200 * 3 and all(r["size"] == 10 and r.gram >= 10 for r in got)


def test_lsh_reports_no_false_pair(spark, crowd):
    df = spark.createDataFrame(list(enumerate(crowd)), "id long, text string")
    for r in Z.similar_pairs_lsh(df.where("id % 4 = 0"), df.where("id % 4 <> 0")).collect():
        assert _jaccard(crowd[r.left_id], crowd[r.right_id]) >= 0.8


@pytest.mark.parametrize("n", [0, 1, 7, 500, 60_000])
def test_outliers_from_brackets_are_exact(spark, tmp_path, n):
    rng = np.random.default_rng(n)
    cols = {
        "normal": rng.normal(50, 9, n), "heavy": rng.standard_cauchy(n), "same": np.full(n, 4.0),
        "steps": rng.integers(0, 6, n).astype(float), "skewed": np.where(rng.random(n) < 0.3, 7.0, rng.exponential(3, n)),
    }
    rows = [tuple(float(v) if (i + k) % 11 else None for k, v in enumerate(r)) for i, r in enumerate(zip(*cols.values(), strict=True))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(6)
    df.write.parquet(str(tmp_path / "t"))
    got = {r["column"]: r for r in Q.outliers(spark.read.parquet(str(tmp_path / "t")), list(cols)).collect()}
    assert set(got) == set(cols)
    for k, c in enumerate(cols):
        v = np.array([r[k] for r in rows if r[k] is not None])
        if not len(v):
            assert tuple(got[c])[1:] == (0, 0, 0, None)
            continue
        q1, q3 = np.quantile(v, [0.25, 0.75])
        beyond = int(((v < q1 - 1.5 * (q3 - q1)) | (v > q3 + 1.5 * (q3 - q1))).sum())
        far = int((np.abs(v - v.mean()) > 3 * v.std()).sum()) if v.std() else 0
        assert tuple(got[c])[1:4] == (beyond, far, len(v)), c


def test_brackets_leave_few_cells_to_shuffle(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(2)
    spark.createDataFrame([(float(x),) for x in rng.normal(0, 1, 60_000)], "x double").write.parquet(str(tmp_path / "t"))
    kept = []
    monkeypatch.setattr(Q, "stored", lambda df, name: kept.append(df) or df)
    Q.outliers(spark.read.parquet(str(tmp_path / "t")), ["x"])
    assert kept[0].count() < 600  # distinct rows after the map-side count, of 60,000 cells


def test_hot_bins_are_split_and_stay_exact(spark):
    rnd = random.Random(4)
    hot = [f"2024-01-10 {rnd.randrange(24):02d}:{rnd.randrange(60):02d}:00" for _ in range(900)]
    cold = [f"2024-01-{rnd.randrange(1, 30):02d} 12:00:00" for _ in range(100)]
    items = spark.createDataFrame(list(enumerate(hot + cold)), "item_id long, t string").selectExpr("item_id", "CAST(t AS timestamp) AS ts")
    times = ["2024-01-09 12:00:00", "2024-01-11 00:00:00", "2024-01-11 00:00:00", "2024-01-25 00:00:00", None, "1969-12-31 23:00:00"]
    events = spark.createDataFrame([(t,) for t in times], "t string").selectExpr("CAST(t AS timestamp) AS event_ts")
    rows = [(r.item_id, r.ts) for r in items.collect()]
    want = []
    for (t,) in events.collect():
        near = [(i, ts) for i, ts in rows if t is not None and abs((ts - t).total_seconds()) <= 48 * 3600]
        want += [(i, ts, t) for i, ts in sorted(near, key=lambda x: (-x[1].timestamp(), x[0]))[:7]]
    for limit in (50, 10_000):
        got = K.within_interval(events, items, k=7, bin_rows=limit)
        assert got.columns == ["item_id", "ts", "event_ts"]
        assert sorted(map(tuple, got.collect())) == sorted(want)
    split = K.within_interval(events, items, k=7, bin_rows=50)
    assert "_split" in split._jdf.queryExecution().optimizedPlan().toString()


def test_alias_index_equals_all_runs(spark):
    words = ["new", "york", "city", "time", "a"]
    rnd = random.Random(9)
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(40))) for _ in range(60)] + [None, ""]
    df = spark.createDataFrame([(k % 3, t) for k, t in enumerate(texts)], "g int, text string")
    names = [("New York", "ny", "GPE"), ("new york city", "nyc", "GPE"), ("time", "time", "DATE"), ("new", "n", "ORG"), ("new", "n2", "ORG"), ("!!", "none", "ORG")]
    gaz = spark.createDataFrame(names, "alias string, entity string, type string")
    got = [sorted(map(tuple, M.entities(df, gaz, ["g"], first_words=n).collect())) for n in (0, 100)]
    assert got[0] == got[1] and got[0]
    runs = M._alias_runs(df.select("g", M.tokens("text").alias("toks")), gaz.select(M.tokens("alias").alias("words")), ["g"], 100)
    total = sum(len((t or "").split()) for t in texts)
    assert runs.count() < 2.2 * total < 3 * total  # three lengths where "new" stands, one or none elsewhere
    assert M.entities(df, gaz.limit(0)).count() == 0


def _links(members, pairs):
    """All pairs that a crowd result stands for, as smallest ids of sets."""
    sides = {side: [r for r in members if r.side == side] for side in ("left", "right")}
    inside = {(a.id, b.id) for a in sides["left"] for b in sides["right"] if a.crowd == b.crowd}
    listed = {(r.left_id, r.right_id) for r in pairs}
    assert len(listed) == len(pairs) and not inside & listed
    return inside | listed


@pytest.mark.parametrize("known", [False, True])
def test_crowds_stand_for_all_pairs(spark, crowd, known):
    df = spark.createDataFrame(list(enumerate(crowd)), "id long, text string")
    test, train = df.where("id % 4 = 0"), df.where("id % 4 <> 0")
    want = {(r.left_id, r.right_id) for r in Z.similar_sets(test, train, known_vocab_only=known).collect()}
    members, pairs = Z.similar_crowds(test, train, known_vocab_only=known)
    assert _links(members.collect(), pairs.collect()) == want
    counts = {r.id: r.n_near for r in Z.near_counts(test, train, known_vocab_only=known).collect()}
    assert counts == {r.id: r.n_near for r in Z.leaked_rows(test, train, known_vocab_only=known).collect()}


def test_a_large_crowd_takes_linear_rows(spark):
    rnd = random.Random(11)
    base = [f"w{k}x" for k in range(150)]
    texts = []
    for k in range(5000):
        t = list(base)
        t[rnd.randrange(150)] = f"own{k}y"
        texts.append(" ".join(t))
    texts += [" ".join(f"other{k}z{j}" for j in range(30)) for k in range(20)] * 2
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    test, train = df.where("id % 5 = 0"), df.where("id % 5 <> 0")
    members, pairs = Z.similar_crowds(test, train)
    members, pairs = members.collect(), pairs.collect()
    assert len(members) <= len(texts) and len(pairs) <= 40
    counts = {r.id: r.n_near for r in Z.near_counts(test, train).collect()}
    # Two texts with one word changed in 150 share 142 of 154 grams at least.
    assert all(counts[k] == 4000 for k in range(0, 5000, 5))
    far = [k for k in range(5000, len(texts)) if k % 5 == 0]
    twin = {k: k + 20 if k < 5020 else k - 20 for k in far}
    assert {k: n for k, n in counts.items() if k >= 5000} == {k: 1 for k in far if twin[k] % 5}


def test_banded_minhash_finds_most_and_compares_few(spark):
    rnd = random.Random(5)
    boiler = [f"b{k}x" for k in range(12)]
    texts = []
    for _ in range(150):
        own = [f"w{rnd.randrange(5000)}x" for _ in range(80)]
        for _ in range(3):
            t = list(own)
            for _ in range(rnd.randrange(3)):
                t[rnd.randrange(80)] = f"n{rnd.randrange(9999)}y"
            texts.append(" ".join(boiler + t))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    test, train = df.where("id % 3 = 0"), df.where("id % 3 <> 0")
    exact = {(r.left_id, r.right_id) for r in Z.similar_sets(test, train).collect()}
    near = {(r.left_id, r.right_id) for r in Z.similar_pairs_lsh(test, train).collect()}
    assert near <= exact and len(near) >= 0.9 * len(exact) > 100
    sets = [Z._bands(Z._groups(Z._gram_sets(x, "id", "text", 3)), 16, 5, 42) for x in (test, train)]
    compared = sets[0].toDF("l", "band").join(sets[1].toDF("r", "band"), "band").select("l", "r").distinct().count()
    assert compared <= 2 * len(exact)  # of 150 x 300 pairs that share the boilerplate


def test_append_new_keeps_existing(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("b", 4), ("b", 3)], "k string, v int")
    assert sorted(map(tuple, Z.append_new(old, new, "k", ["v"]).collect())) == [("a", 1), ("b", 3)]


def test_splits_are_disjoint_exact_and_repeatable(spark):
    df = spark.range(1000).withColumn("y", F.when(F.col("id") < 900, "hot").otherwise("cold"))
    s = L.stratified_split(df, "y", "id", {"train": 0.7, "val": 0.1, "test": 0.2})
    counts = {(r.y, r.split): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert counts == {
        ("hot", "train"): 630, ("hot", "val"): 90, ("hot", "test"): 180,
        ("cold", "train"): 70, ("cold", "val"): 10, ("cold", "test"): 20,
    }
    again = L.stratified_split(df.repartition(7), "y", "id", {"train": 0.7, "val": 0.1, "test": 0.2})
    assert s.select("id", "split").exceptAll(again.select("id", "split")).count() == 0
    folds = {(r.y, r.fold): r["count"] for r in L.assign_folds(df, "y", "id", 5).groupBy("y", "fold").count().collect()}
    assert set(folds.values()) == {180, 20}


def test_trending_falls_back_on_few_posts(spark):
    rows = [("w1", "apple banana banana cat")] * 2 + [("w2", f"common word{i % 2}") for i in range(6)]
    df = spark.createDataFrame(rows, "bucket string, text string")
    got = {}
    for r in M.trending(df, stoplist=["cat"]).collect():
        got.setdefault(r.bucket, {})[r.term] = r.score
    assert got["w1"] == {"banana": 4.0, "apple": 2.0}
    assert got["w2"]["common"] == 1.0 and "common word0" in got["w2"]


@pytest.mark.parametrize("most, limit", [(6, 100), (6, 0), (1, 100), (500, 100)])
def test_frequent_grams_against_brute_force(spark, most, limit):
    draw = random.Random(most)
    texts = [(f"w{i % 3}", " ".join(draw.choices([f"t{j}" for j in range(40)], [1 / (j + 1) for j in range(40)], k=30))) for i in range(60)]
    tf, docs = collections.Counter(), collections.Counter()
    for week, text in texts:
        toks = [t for t in text.split() if t != "t3"]
        grams = [(week, g) for g in [*toks, *map(" ".join, zip(toks, toks[1:]))]]
        tf.update(grams)
        docs.update(set(grams))
    found = M.frequent_grams(spark.createDataFrame(texts, "bucket string, text string"), ["bucket"], ["t3"], most, limit=limit).collect()
    got = {(r.bucket, r.term): (r.tf, r.df) for r in found}
    assert len(got) == len(found)
    for week in ("w0", "w1", "w2"):
        own = sorted((-n, g) for (w, g), n in tf.items() if w == week and docs[w, g] >= 2)[:most]
        assert {g: -n for n, g in own}.items() <= {g: n for (w, g), (n, _) in got.items() if w == week}.items()
    assert all(tf[g] == n and docs[g] == d for g, (n, d) in got.items())
    if most == 6 and limit:  # no pair of rare words
        assert sum(" " in g for _, g in got) < sum(" " in g and docs[w, g] >= 2 for w, g in docs)


def test_aspects_leave_out_unmentioned_terms(spark):
    df = spark.createDataFrame(
        [("Privacy matters", "whatsapp", "Negative", 0.0), ("no PRIVACY", "telegram", "Positive", 1.0)],
        "text string, source string, sentiment_label string, sentiment_numeric double",
    )
    r = M.aspects(df, sources=["whatsapp", "telegram"]).collect()
    assert len(r) == 1
    assert (r[0].total_mentions, r[0].avg_sentiment, r[0].whatsapp_avg_sentiment, r[0].telegram_avg_sentiment) == (2, 0.5, 0.0, 1.0)


def test_correlation_skips_flat_and_binary_columns(spark):
    rows = [(float(i), float(-i), 1.0, float(i % 2), None if i == 3 else float(i * i)) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    got = {(r.col_a, r.col_b): r.r for r in Q.correlations(df).collect()}
    assert set(got) == {("a", "b"), ("a", "e"), ("b", "e")}
    assert got[("a", "b")] == pytest.approx(-1.0)
    keep = [i for i in range(10) if i != 3]
    assert got[("a", "e")] == pytest.approx(statistics.correlation(keep, [i * i for i in keep]))


def test_null_patterns(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, 2)], "a int, b int")
    assert {r.pattern: r.n for r in Q.null_patterns(df).collect()} == {"01": 1, "11": 1}


PRED = "id long, y_true string, y_pred string, proba array<double>"


def preds(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], PRED)


def test_perfect_and_hopeless_predictions(spark):
    names = ["Negative", "Neutral", "Positive"]
    good = preds(spark, [(n, n, [1.0 if n == m else 0.0 for m in names]) for n in names])
    m = V.metrics(V.confusion(good)).first()
    assert (m.accuracy, m.macro_f1) == (1.0, 1.0)
    a = V.agreement(V.confusion(good)).first()
    assert (a.kappa, a.mcc) == (1.0, 1.0)
    assert {r.auc for r in V.ranking_scores(good).collect()} == {1.0}
    assert V.calibration(good).first().ece == 0.0
    bad = preds(spark, [("Negative", "Neutral", [0.2, 0.7, 0.1])])
    assert V.metrics(V.confusion(bad)).first().macro_f1 == 0.0


def test_class_never_predicted_scores_zero(spark):
    rows = [("Negative", "Negative", [0.8, 0.1, 0.1]), ("Neutral", "Negative", [0.6, 0.4, 0.0])]
    got = {r.label: (r.precision, r.recall, r.f1) for r in V.per_class(V.confusion(preds(spark, rows))).collect()}
    assert got["Neutral"] == (0.0, 0.0, 0.0)
    assert got["Negative"] == (0.5, 1.0, pytest.approx(2 / 3))
    # the absent class has no say in the mean
    assert V.metrics(V.confusion(preds(spark, rows))).first().macro_f1 == pytest.approx(1 / 3)


def test_confidence_on_a_bin_edge(spark):
    rows = [("Negative", "Negative", [0.5, 0.3, 0.2]), ("Negative", "Negative", [0.50001, 0.3, 0.2])]
    assert sorted(r.bin for r in V.calibration_bins(preds(spark, rows)).collect()) == [5, 6]


def test_tied_scores_share_one_roc_point(spark):
    rows = [("Negative", "Negative", [0.5, 0.5, 0.0]), ("Neutral", "Negative", [0.5, 0.5, 0.0])]
    got = {r.label: r.auc for r in V.ranking_scores(preds(spark, rows)).collect()}
    assert got["Negative"] == 0.5 and got["Neutral"] == 0.5 and got["Positive"] is None


def test_mcnemar(spark):
    rows = [(i, "Negative", "Negative" if i < 12 else "Neutral", "Negative" if i >= 10 else "Neutral") for i in range(14)]
    df = spark.createDataFrame(rows, "id long, y_true string, y_pred string, y_other string")
    r = V.mcnemar(df).first()
    assert (r.n01, r.n10) == (10, 2)
    assert r.chi2 == pytest.approx(49 / 12)
    assert r.p_value == pytest.approx(math.erfc(math.sqrt(49 / 24)))
    same = V.mcnemar(df.withColumn("y_other", F.col("y_pred"))).first()
    assert same.chi2 is None and same.p_value == 1.0


def test_bootstrap_is_seeded_and_covers_the_score(spark):
    rows = [("Negative", "Negative" if i % 4 else "Positive", [0.6, 0.2, 0.2]) for i in range(40)]
    rows += [("Positive", "Positive", [0.1, 0.2, 0.7])] * 40
    conf = V.confusion(preds(spark, rows))
    got = {r.metric: (r.lower, r.upper) for r in V.bootstrap_ci(conf, 200).collect()}
    lo, hi = got["accuracy"]
    assert lo <= V.metrics(conf).first().accuracy <= hi
    assert got == {r.metric: (r.lower, r.upper) for r in V.bootstrap_ci(conf, 200).collect()}


def test_threshold_sweep_against_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    for _ in range(50):
        p = [rnd.random() for _ in range(3)]
        rows.append((rnd.choice(["Negative", "Neutral", "Positive"]), "Negative", [x / sum(p) for x in p]))
    got = {r.threshold: r.accuracy for r in V.threshold_sweep(preds(spark, rows)).collect()}
    for t in np.linspace(0.2, 0.6, 41):
        hits = 0
        for y, _, p in rows:
            guess = "Neutral" if p[1] >= t else ("Negative" if p[0] > p[2] else "Positive")
            hits += guess == y
        assert got[float(t)] == pytest.approx(hits / 50)


def test_gram_sets_are_not_shuffled_as_a_whole(spark, monkeypatch):
    """Only texts of candidate pairs are cut again, only prefixes are written."""
    rnd = random.Random(8)
    texts = [" ".join(f"w{rnd.randrange(9999)}x" for _ in range(100)) for _ in range(200)]
    texts += [t + " tail" for t in texts[:4]]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    written, stored = {}, Z.stored

    def watched(rows, name="stored"):
        out = stored(rows, name)
        written.setdefault(name, []).append(out)
        return out

    monkeypatch.setattr(Z, "stored", watched)
    got = {(r.left_id, r.right_id) for r in Z.similar_sets(df.where("id < 100"), df.where("id >= 100")).collect()}
    assert got == {(k, 200 + k) for k in range(4)}
    # 98 or 99 grams a set, of which 20 are its prefix.
    assert all(max(len(r.prefix) for r in x.collect()) <= 21 and "grams" not in x.columns for x in written["sets"])
    assert sum(x.count() for x in written["chosen"]) <= 16 and "grams" not in written


def test_a_sieve_lets_all_its_numbers_through(spark):
    marked = spark.range(0, 4000, 2).select(F.xxhash64("id").alias("h"))
    rows = spark.range(4000).select("id", F.xxhash64("id").alias("h"))
    got = {r.id for r in Z._sifted(rows, "h", Z._sieve(marked)).collect()}
    assert got >= set(range(0, 4000, 2)) and len(got) < 2600
    empty = Z._sieve(marked.where("h = 0 AND h = 1"))
    assert Z._sifted(rows, "h", empty).count() == 0


def test_similar_sets_with_repeated_and_missing_ids(spark):
    """A set is found by the id of one of its rows; other texts of that id do not disturb."""
    a, b = (" ".join(f"{c}{k}x" for k in range(30)) for c in "ab")
    rows = [(1, a), (1, b), (1, a), (None, a + " z9"), (2, "one two"), (3, None)]
    left = spark.createDataFrame(rows, "id long, text string")
    right = spark.createDataFrame([(7, a), (7, b), (None, b), (8, a)], "id long, text string")
    got = {(r.left_id, r.right_id, round(r.jaccard, 3), r.left_copies, r.right_copies) for r in Z.similar_sets(left, right).collect()}
    assert got == {(1, 7, 1.0, 2, 2), (1, 7, 1.0, 1, 2), (None, 7, 0.966, 1, 2)}
    known = {(r.left_id, r.right_id, round(r.jaccard, 3), r.left_copies, r.right_copies) for r in Z.similar_sets(left, right, known_vocab_only=True).collect()}
    assert known == {(1, 7, 1.0, 3, 2), (1, 7, 1.0, 1, 2)}
    assert sorted((r.id or 0, r.n_near) for r in Z.near_counts(left, right).collect()) == [(0, 2), (1, 2), (1, 2), (1, 2)]
