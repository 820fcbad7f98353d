"""Near-duplicate documents: SuperMinHash, banding, exact verification, union-find."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.components import components
from pulse.llm.hashing import GOLDEN, chunks, long_lists, mix, shingle_sets
from pulse.llm.registry import query, read
from pulse.session import stored

WORDS = 5
SHARE = 75
BANDS = 36
BAND_ROWS = 4
BLOCK = 2048
BLOCK_GRAMS = 1 << 20


def super_minhash(values: np.ndarray, owner: np.ndarray, n: int, m: int) -> np.ndarray:
    """SuperMinHash signatures ``(n, m)`` of ``n`` sets; ``owner`` tells the set
    of each value.

    In step ``j`` every value draws the ``j``-th place of its own random
    permutation of the ``m`` places (a lazy shuffle) and a random rank above
    all ranks of earlier steps. So a place once taken keeps its rank, and a
    set is done, and its values leave, as soon as all its places are taken:
    after one or two steps for long texts.
    """
    sig = np.full(n * m, np.iinfo(np.uint64).max, np.uint64)
    taken = np.zeros(n * m, bool)
    perm = None
    for j in range(m):
        if not len(values):
            break
        draw = mix(values + np.uint64((j + 1) * int(GOLDEN) % (1 << 64)))
        k = j + ((draw >> np.uint64(32)) % np.uint64(m - j)).astype(np.int64)
        row = np.arange(len(values))
        if perm is None:
            place = k
        else:
            place = perm[row, k].astype(np.int64)
            perm[row, k] = perm[row, j]
            perm[row, j] = place
        slot = owner * m + place
        free = ~taken[slot]
        np.minimum.at(sig, slot[free], mix(draw[free] ^ GOLDEN))
        taken[slot[free]] = True
        stays = ~taken.reshape(n, m).all(1)[owner]
        if perm is None:
            perm = np.tile(np.arange(m, dtype=np.uint16), (int(stays.sum()), 1))
            row = np.arange(len(perm))
            perm[row, k[stays]] = 0
            perm[row, 0] = k[stays]
        else:
            perm = perm[stays]
        values, owner = values[stays], owner[stays]
    return sig.reshape(n, m)


def band_hashes(sig: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each band of ``rows`` signature places, with its number."""
    n, m = sig.shape
    cut = sig.reshape(n, m // rows, rows)
    out = np.broadcast_to(np.arange(m // rows, dtype=np.uint64), cut.shape[:2]).copy()
    for r in range(rows):
        out = mix((out ^ cut[:, :, r]) + GOLDEN)
    return out


def _set_keys(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name a set: equal sets agree, others do not."""
    return np.add.reduceat(mix(values + GOLDEN), starts), np.add.reduceat(mix(values ^ GOLDEN) * values, starts)


def _signer(words: int, bands: int, rows: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            sets = shingle_sets(texts, words)
            size = np.array([len(s) for s in sets])
            full = np.flatnonzero(size)
            ids = part.column(0)
            rest = np.flatnonzero(size == 0)
            flat = np.concatenate([sets[i] for i in full]) if len(full) else np.empty(0, np.uint64)
            if len(full):
                owner = np.repeat(np.arange(len(full)), size[full])
                keys = _set_keys(flat, np.concatenate(([0], np.cumsum(size[full])[:-1])))
                found = band_hashes(super_minhash(flat, owner, len(full), bands * rows), rows)
            else:
                keys, found = (flat, flat), np.empty((0, bands), np.uint64)
            order = pa.array(np.concatenate([full, rest]))
            blank = [None] * len(rest)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(order),
                    pa.array(size[order.to_numpy()].astype(np.int64)),
                    pa.concat_arrays([pa.array(keys[0].view(np.int64)), pa.array(blank, pa.int64())]),
                    pa.concat_arrays([pa.array(keys[1].view(np.int64)), pa.array(blank, pa.int64())]),
                    long_lists([*found, *[np.empty(0, np.uint64)] * len(rest)]),
                ],
                names=["id", "n", "k1", "k2", "bands"],
            )

    return sign


def _shingler(words: int):
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column(0), long_lists(shingle_sets(texts, words))], names=["id", "grams"])

    return shingle


def _near(left_n, right_n, share: int):
    """Sizes that allow the wanted similarity."""
    return 100 * F.least(left_n, right_n) >= share * F.greatest(left_n, right_n)


def _settle(share: int):
    """Links of one block of a bucket that join components not yet joined.

    Pairs are looked at in the first band that they share only. A block holds
    about ``BLOCK`` sets of about ``BLOCK_GRAMS`` shingles together at most,
    and what leaves it is a forest.
    """

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids, root, side = pdf["id"].to_numpy(), pdf["comp"].to_numpy().copy(), pdf["block"].to_numpy()
        grams = [np.asarray(g) for g in pdf["grams"]]
        grams = [np.sort(g) for g in grams]
        n = np.array([len(g) for g in grams])
        bands = np.stack([np.asarray(b) for b in pdf["bands"]])
        band, across = int(pdf["band"].iloc[0]), bool(pdf["bi"].iloc[0] != pdf["bj"].iloc[0])
        out = []
        for i in range(len(ids) - 1):
            ok = root[i + 1 :] != root[i]
            if across:
                ok &= side[i + 1 :] != side[i]
            ok &= 100 * np.minimum(n[i + 1 :], n[i]) >= share * np.maximum(n[i + 1 :], n[i])
            js = np.flatnonzero(ok) + i + 1
            if not len(js):
                continue
            js = js[(bands[js] == bands[i]).argmax(1) == band]
            if not len(js):
                continue
            flat = np.concatenate([grams[j] for j in js])
            at = np.minimum(np.searchsorted(grams[i], flat), n[i] - 1)
            both = np.add.reduceat((grams[i][at] == flat).astype(np.int64), np.concatenate(([0], np.cumsum(n[js])[:-1])))
            for j in js[100 * both >= share * (n[js] + n[i] - both)]:
                if root[j] != root[i]:
                    out.append((ids[i], ids[j]))
                    root[root == root[j]] = root[i]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return settle


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    share: int = SHARE,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per row of ``df``: the id, ``n_shingles`` (long), ``component_id``
    and ``kept``.

    Documents whose sets of ``words``-word shingles have a Jaccard similarity
    of ``share`` percent or more are linked; ``component_id`` is the smallest
    id reachable. A text without words, NULL included, is linked with nothing;
    a NULL id gives a NULL ``component_id`` and is kept. Rows that repeat an
    id count as one document. Input columns other than id and text are not
    read. An empty table gives no rows.

    * Equal sets are one vertex, so copies take part once.
    * A pair of similarity 0.75 shares one of 36 bands of 4 places but for a
      chance of 1e-6, and a single lost link seldom parts a component.
    * Each bucket's members are first checked against one centre. Buckets
      that then still hold several components are settled in blocks of bounded
      size, pair by pair, but only a forest of links leaves a block. No list of all pairs of a group is ever made and no bucket is
      cut short.
    * All links are confirmed on full sets (64-bit hashes of shingles).
    """
    spark = df.sparkSession
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, n long, k1 long, k2 long, bands array<long>"
    sigs = stored(src.mapInArrow(_signer(words, bands, rows), schema), "signatures")

    full = sigs.where("n > 0 AND id IS NOT NULL")
    first = F.min_by(F.struct("n", "bands"), "id").alias("s")
    reps = full.groupBy("k1", "k2").agg(F.min("id").alias("id"), first).select("k1", "k2", "id", "s.n", "s.bands")
    reps = stored(reps, "sets")

    spread = reps.select("id", "n", F.posexplode("bands").alias("band", "bucket"))
    centre = F.min(F.struct(F.xxhash64("id").alias("h"), F.col("id").alias("c"), F.col("n").alias("cn"))).alias("m")
    members, grams = F.count(F.lit(1)).alias("members"), F.sum("n").alias("grams")
    crowds = spread.groupBy("bucket").agg(members, grams, centre).where("members > 1")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("grams") / BLOCK_GRAMS)).cast("int")
    crowds = crowds.select("bucket", "members", blocks.alias("blocks"), "m.c", "m.cn")
    shared = stored(spread.join(crowds, "bucket"), "buckets")

    wanted = shared.select("id").distinct()
    sets = stored(src.join(wanted, "id", "left_semi").mapInArrow(_shingler(words), "id long, grams array<long>"), "grams")
    sets = sets.dropDuplicates(["id"])

    pairs = shared.where(F.col("id") != F.col("c")).where(_near(F.col("n"), F.col("cn"), share))
    pairs = pairs.select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()
    checked = pairs.join(sets.toDF("a", "ga"), "a").join(sets.toDF("b", "gb"), "b")
    both = F.size(F.array_intersect("ga", "gb"))
    links = checked.where(100 * both >= share * (F.size("ga") + F.size("gb") - both)).select("a", "b")
    first = components(links, "a", "b")

    label = F.coalesce("v", "id").alias("comp")
    left = shared.where("members > 2").join(first, F.col("id") == F.col("u"), "left")
    left = stored(left.select("id", "band", "bucket", "blocks", label), "unsettled")
    open_ = left.groupBy("bucket").agg((F.min("comp") != F.max("comp")).alias("open")).where("open").select("bucket")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rest = left.join(open_, "bucket", "left_semi").withColumn("block", block)
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")})
    rest = rest.join(sets, "id").join(reps.select("id", "bands"), "id")
    more = rest.groupBy("bucket", "band", "bi", "bj").applyInPandas(_settle(share), "a long, b long")
    joined = components(first.toDF("a", "b").union(more), "a", "b")

    verts = reps.join(joined, F.col("id") == F.col("u"), "left")
    verts = verts.select("k1", "k2", F.coalesce("v", "id").alias("root"))
    out = sigs.select("id", "n", "k1", "k2").join(verts, ["k1", "k2"], "left")
    root = F.coalesce("root", "id")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), root).alias("component_id"),
        F.coalesce(F.col("id") == root, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that represent their group of near duplicates; of
    rows that repeat an id one stays, rows with a NULL id all stay."""
    marks = near_duplicates(df, id_col, text, **options).where(F.col("kept") & F.col(id_col).isNotNull())
    kept = df.join(marks.select(id_col).distinct(), id_col, "left_semi").dropDuplicates([id_col])
    return kept.unionByName(df.where(F.col(id_col).isNull()))


SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(list_transform(range(1, greatest(len(ws) - 3, 2)),
    lambda i: array_to_string(ws[i:i + 4], ' '))) AS g FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= {SHARE} * (a.n + b.n - c)),
r(id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.id),
m AS (SELECT id, min(root) AS root FROM r GROUP BY id)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(m.root, d.doc_id) AS component_id,
  d.doc_id = coalesce(m.root, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.id = d.doc_id"""


@query("op1_minhash_dedup", SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents", "doc_id", "text"))
