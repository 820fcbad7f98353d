import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from pulse.llm import quality_rules as Q
from pulse.llm import sharding as S


def spark_hash(x: int, seed: int = 42) -> int:
    h = xxhash.xxh64_intdigest(x.to_bytes(8, "little", signed=True), seed)
    return h - (1 << 64) if h >> 63 else h


def int_hash(x: int, seed: int) -> int:
    """Spark's hash of an int: the one of its 4 bytes, by the public XXH64 form."""
    m, p1, p2, p3, p5 = (1 << 64) - 1, 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5
    h = (seed + p5 + 4) & m
    h ^= ((x & 0xFFFFFFFF) * p1) & m
    h = (((h << 23) | (h >> 41)) & m) * p2 + p3 & m
    h ^= h >> 33
    h = h * p2 & m
    h ^= h >> 29
    h = h * p3 & m
    return h ^ (h >> 32)


def keyed(x: int, i: int, seed: int) -> int:
    h = int_hash(seed, int_hash(i, spark_hash(x) & ((1 << 64) - 1)))
    return h - (1 << 64) if h >> 63 else h


def brute_place(row: int, rows: int, seed: int) -> int:
    a = int(-(-(rows**0.5) // 1))
    b = -(-rows // a)
    x = row
    while True:
        left, right = divmod(x, b)
        for i in range(S.ROUNDS):
            if i % 2 == 0:
                left = (left + keyed(right, i, seed) % a) % a
            else:
                right = (right + keyed(left, i, seed) % b) % b
        x = left * b + right
        if x < rows:
            return x


def test_permutation_matches_brute_force(spark):
    for n in (1, 2, 3, 7, 97, 1000):
        first, place = S.permute(F.col("id"), F.lit(n).cast("long"), 8)
        got = [r.p for r in spark.range(n).withColumn("_first", first).withColumn("p", place).orderBy("id").collect()]
        assert sorted(got) == list(range(n))
        assert got == [brute_place(i, n, 8) for i in range(n)]


def test_shards_are_gapless_and_even(spark, odd_docs):
    out = S.shard_rows(S.sized(odd_docs.drop("size")), ties=["text_crc32", "size"], shards=4)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and "extra" in out.columns
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))
    for r in rows:
        raw = (r.text or "").encode()
        assert r["size"] == len(raw) + 8 and r.text_crc32 == zlib.crc32(raw)


def test_order_does_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    one = {tuple(r) for r in S.shard_rows(df.repartition(1)).collect()}
    assert one == {tuple(r) for r in S.shard_rows(df.repartition(7)).collect()}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert S.shard_rows(empty).count() == 0
    assert Q.quality_rules(empty).count() == 0


def test_rules_on_odd_rows(odd_docs):
    got = Q.quality_rules(odd_docs).collect()
    assert len(got) == odd_docs.count() and "extra" in got[0]
    for r in got:
        if r.doc_id in (5, 6, 7):
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (0, 0, 0, 0, 0)
            assert r.base_failed and not r.kept
        if r.doc_id == 13:
            assert r.n_dup_lines == 1 and r.base_failed
        if r.doc_id == 10:
            assert r.n_words == 30_000


def test_lines_above_the_limit_deplete(spark):
    own = lambda i: " ".join(f"own{i}x{k}" for k in range(60))
    menu = "  Shared MENU line of the   site " + " ".join(f"m{k}" for k in range(200))
    rows = [(i, "h", own(i) + "\n" + menu.upper() * (i % 2) + menu * (1 - i % 2)) for i in range(8)]
    rows += [(10 + i, "other", own(10 + i) + "\n" + menu) for i in range(3)] + [(20, None, own(20) + "\nx y")]
    got = {r.doc_id: r for r in Q.quality_rules(spark.createDataFrame(rows, "doc_id long, source string, text string"), max_docs=5).collect()}
    assert all(not got[i].kept and got[i].removed_words == 206 and not got[i].base_failed for i in range(8))
    assert all(got[10 + i].kept and got[10 + i].removed_words == 0 for i in range(3)) and got[20].kept
