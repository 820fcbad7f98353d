"""TF-IDF vectors and blocks of many training parts from one reading of the texts.

Parts overlap (folds, seeds, nested sizes), so texts are cut into grams once
and kept as counts of 64-bit gram hashes. A part then costs sums of numbers
for its vocabulary and one pass that weighs the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import DenseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulse.operators.fits import Blocks, packer
from pulse.session import run_dir, stored

KEPT = ["id", "y_true", "label", "weight"]
MAX_SPLITS = 62  # one bit each
SIDE_BY_SIDE = 5  # vocabularies collected at the same time
_VECTOR = "struct<type:tinyint,size:int,indices:array<int>,values:array<double>>"


def spelled(stages: list) -> str:
    """The stages and their settings as text, whatever their names."""
    return "|".join(
        type(x).__name__ + str(sorted((p.name, str(v)) for p, v in x.extractParamMap().items())) for x in stages
    )


class _Block:
    """One vocabulary of a list of feature stages: the stages that cut a row
    into grams, the limits of the vocabulary and the kind of weight."""

    def __init__(self, cutters: list, counter: CountVectorizer):
        self.cutters, self.counter, self.sublinear = cutters, counter, False
        self.key = spelled(cutters)

    def grams(self, df: DataFrame) -> DataFrame:
        """``df`` with the hashes of a row's grams, sorted, as ``_g``."""
        made = df
        for stage in self.cutters:
            made = stage.transform(made)
        hashed = F.transform(F.col(self.counter.getInputCol()), lambda g: F.xxhash64(g))
        hashed = F.coalesce(F.sort_array(hashed), F.array().cast("array<long>"))
        return made.select(*df.columns, hashed.alias("_g"))

    def terms(self, sums: DataFrame, split: int, rows: int) -> DataFrame:
        """``(gram, df)`` of the vocabulary, as a CountVectorizer limits it."""
        lo, hi = (x * rows if x < 1 else x for x in (self.counter.getMinDF(), self.counter.getMaxDF()))
        kept = sums.select("gram", F.col(f"df{split}").alias("df"), F.col(f"total{split}").alias("total"))
        kept = kept.where((F.col("df") > 0) & (F.col("df") >= lo) & (F.col("df") <= hi))
        if self.counter.getVocabSize() < 2**31 - 1:
            kept = kept.orderBy(F.desc("total"), "gram").limit(self.counter.getVocabSize())
        return kept.select("gram", "df")


def _blocks(features: list) -> list[_Block]:
    found, cutters = [], []
    for stage in features:
        kind = type(stage).__name__
        if isinstance(stage, CountVectorizer):
            found.append(_Block(cutters, stage))
            cutters = []
        elif kind == "SublinearTf":
            found[-1].sublinear = True
        elif kind in ("SmoothIdf", "Normalizer", "VectorAssembler") or (found and kind == "SQLTransformer"):
            continue  # weights, and columns put side by side: see _weigher
        else:
            cutters.append(stage)
    return found


def _starts(grams: str) -> Column:
    """Where the runs of equal values of a sorted array begin, and its end."""
    g = F.col(grams)
    return F.filter(F.sequence(F.lit(0), F.size(g)), lambda i: F.get(g, i).isNull() | ~F.get(g, i).eqNullSafe(F.get(g, i - 1)))


def _runs(grams: str, starts: str) -> Column:
    """The distinct values of a sorted array, and how often each occurs."""
    g, starts = F.col(grams), F.col(starts)
    return F.transform(
        F.slice(starts, 1, F.size(starts) - 1), lambda s, k: F.struct(F.get(g, s).alias("h"), (F.get(starts, k + 1) - s).alias("n"))
    )


def grams_counted(df: DataFrame, grams: str) -> DataFrame:
    """``df`` with the hashes of a text array and their counts as ``counts``."""
    hashed = F.coalesce(F.sort_array(F.transform(grams, lambda g: F.xxhash64(g))), F.array().cast("array<long>"))
    made = df.withColumn("_g", hashed).withColumn("_starts", _starts("_g"))
    return made.withColumn("counts", _runs("_g", "_starts")).drop("_g", "_starts")


def _weigher(blocks: list, names: list[str]):
    """Weighs the counts of each block, scales them to length one and puts
    the blocks side by side."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at_row, index, value, width = batch.num_rows, [], [], [], 0
            for (terms, sublinear), name in zip(blocks, names, strict=True):
                hashes, idf = terms.value
                column = batch.column(batch.schema.names.index(name))
                flat = column.flatten()
                gram, n = flat.field("h").to_numpy(), flat.field("n").to_numpy().astype(float)
                row = np.repeat(np.arange(rows), column.value_lengths().to_numpy())
                at = np.minimum(np.searchsorted(hashes, gram), max(len(hashes) - 1, 0))
                known = hashes[at] == gram if len(hashes) else np.zeros(len(gram), bool)
                row, at, n = row[known], at[known], n[known]
                w = (1 + np.log(n) if sublinear else n) * idf[at]
                w /= np.sqrt(np.bincount(row, w * w, rows))[row]
                at_row.append(row)
                index.append(at + width)
                value.append(w)
                width += len(hashes)
            row, ids, w = (np.concatenate(x) for x in (at_row, index, value))
            order = np.argsort(row, kind="stable")
            ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows)))).astype(np.int32)
            vector = pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(rows, np.int8)),
                    pa.array(np.full(rows, width, np.int32)),
                    pa.ListArray.from_arrays(ends, pa.array(ids[order].astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(w[order])),
                ],
                names=["type", "size", "indices", "values"],
            )
            rest = [batch.column(batch.schema.names.index(c)) for c in KEPT]
            yield pa.RecordBatch.from_arrays([*rest, vector], names=[*KEPT, "word_vec"])

    return weigh


class SplitVectors:
    """The vectors of every split of ``data`` under lists of feature stages.

    ``splits`` are pairs of conditions: the rows to learn from, vocabulary and
    document frequencies included, and the rows to judge. ``data`` has the
    columns ``id, text, y_true, label, weight`` and those of the conditions.
    The driver holds one vocabulary at a time, as a CountVectorizer does. With
    ``spelling`` each gram is kept with a row to read it from, for :meth:`stages`.
    """

    def __init__(self, data: DataFrame, features: list[list], splits: list[tuple[Column, Column]], spelling: bool = False):
        if len(splits) > MAX_SPLITS:
            raise ValueError(f"at most {MAX_SPLITS} splits")

        def bits(k: int) -> Column:
            marks = [F.when(s[k], F.lit(1 << i)).otherwise(0).cast("long") for i, s in enumerate(splits)]
            return sum(marks[1:], marks[0])

        self.data, self.splits = data, splits
        self.lists, self.n_splits = {spelled(f): _blocks(f) for f in features}, len(splits)
        by_key = {b.key: b for blocks in self.lists.values() for b in blocks}
        self.names = {key: f"grams{i}" for i, key in enumerate(by_key)}
        rows = data.select(*KEPT, "text", bits(0).alias("_train"), bits(1).alias("_test"))
        for key, block in by_key.items():
            rows = block.grams(rows).withColumn("_starts", _starts("_g"))
            rows = rows.withColumn(self.names[key], _runs("_g", "_starts")).drop("_g", "_starts")
        self.rows = stored(rows.drop("text").where("_train <> 0 OR _test <> 0"), "grams")
        self.sizes = {r["_train"]: r["n"] for r in self.rows.groupBy("_train").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.sums = {}
        for key, name in self.names.items():
            each = self.rows.where("_train <> 0").select("id", "_train", F.explode(name).alias("g")).select("id", "_train", "g.h", "g.n")
            per = []
            for i in range(len(splits)):
                inside = F.col("_train").bitwiseAND(1 << i) != 0
                per += [F.count_if(inside).alias(f"df{i}"), F.sum(F.when(inside, F.col("n")).otherwise(0)).alias(f"total{i}")]
                per += [F.min(F.when(inside, F.col("id"))).alias(f"id{i}")] if spelling else []
            # A gram of one row is in no vocabulary that asks for two.
            least = min(b.counter.getMinDF() for blocks in self.lists.values() for b in blocks if b.key == key)
            sums = each.groupBy(F.col("h").alias("gram")).agg(F.count(F.lit(1)).alias("_rows"), *per)
            self.sums[key] = stored(sums.where(F.col("_rows") >= (least if least >= 1 else 1)).drop("_rows"), "sums")

    def _terms(self, block: _Block, split: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted hashes of a vocabulary and ``ln((1 + n) / (1 + df)) + 1``."""
        rows = sum(n for mask, n in self.sizes.items() if mask >> split & 1)
        found = block.terms(self.sums[block.key], split, rows).toArrow()
        gram, df = found.column("gram").to_numpy(), found.column("df").to_numpy()
        order = np.argsort(gram)
        return gram[order], np.log((1 + rows) / (1 + df[order])) + 1

    def vectors(self, features: list, split: int) -> tuple[DataFrame, DataFrame]:
        """``id, y_true, label, weight, word_vec`` of the rows to learn from
        and of those to judge, written and read back."""
        blocks = self.lists[spelled(features)]
        spark = self.rows.sparkSession
        terms = [(spark.sparkContext.broadcast(self._terms(b, split)), b.sublinear) for b in blocks]
        names = [self.names[b.key] for b in blocks]
        inside = [F.col(c).bitwiseAND(1 << split) != 0 for c in ("_train", "_test")]
        path = run_dir(spark, "vectors")
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.rows.select(*KEPT).schema)
        # A row both learnt from and judged is written once for each.
        for part, chosen in zip(("train", "test"), inside, strict=True):
            own = self.rows.where(chosen).select(*KEPT, *dict.fromkeys(names))
            made = own.mapInArrow(_weigher(terms, names), f"{kinds}, word_vec {_VECTOR}")
            made.write.parquet(f"{path}/{part}")
        schema = T.StructType([*self.rows.select(*KEPT).schema.fields, T.StructField("word_vec", VectorUDT())])
        return tuple(spark.read.schema(schema).parquet(f"{path}/{part}") for part in ("train", "test"))

    def stages(self, features: list, split: int = 0) -> list[Transformer]:
        """The feature stages as fitted transformers. Their vectors are those of
        :meth:`vectors`; the driver holds the terms of the vocabularies. Needs
        a count with ``spelling``."""
        blocks, out, idf = iter(self.lists[spelled(features)]), [], None
        for stage in features:
            if isinstance(stage, CountVectorizer):
                block = next(blocks)
                hashes, idf = self._terms(block, split)
                terms = self._spelling(block, hashes, split)
                out.append(CountVectorizerModel.from_vocabulary(terms, stage.getInputCol(), stage.getOutputCol()))
            elif type(stage).__name__ == "SmoothIdf":
                out.append(ElementwiseProduct(scalingVec=DenseVector(idf), inputCol=stage.getInputCol(), outputCol=stage.getOutputCol()))
            else:
                out.append(stage)
        return out

    def _spelling(self, block: _Block, hashes: np.ndarray, split: int) -> list[str]:
        """The grams of a vocabulary in the order of their hashes. At most one
        row is cut again for each, so no more rows than the vocabulary has terms."""
        known = self.data.sparkSession.createDataFrame(pa.table({"gram": hashes}))
        ids = self.sums[block.key].join(F.broadcast(known), "gram").select(F.col(f"id{split}").alias("_id")).distinct()
        made = self.data.where(self.splits[split][0])
        made = made.join(F.broadcast(ids), F.col("id").eqNullSafe(F.col("_id")), "left_semi")
        for stage in block.cutters:
            made = stage.transform(made)
        grams = made.select(F.explode(block.counter.getInputCol()).alias("term")).select(F.xxhash64("term").alias("gram"), "term")
        found = grams.join(F.broadcast(known), "gram").groupBy("gram").agg(F.min("term").alias("term")).orderBy("gram").toArrow()
        return found.column("term").to_pylist()

    def blocks(self, features: list, labels: list[str]) -> Blocks:
        """All rows as blocks of counts over the union of the vocabularies of
        the splits, for fits side by side. ``label`` is a place in ``labels``."""
        found = self.lists[spelled(features)]
        spark = self.rows.sparkSession
        jobs = [(b, split) for b in found for split in range(self.n_splits)]
        with ThreadPool(SIDE_BY_SIDE) as pool:
            terms = pool.starmap(self._terms, jobs, chunksize=1)
        shared, weights, parts, width = [], [], [], 0
        for i, block in enumerate(found):
            own = terms[i * self.n_splits : (i + 1) * self.n_splits]
            hashes = np.unique(np.concatenate([h for h, _ in own]))
            idf = np.zeros((self.n_splits, len(hashes)))
            for line, (h, w) in zip(idf, own, strict=True):
                line[np.searchsorted(hashes, h)] = w
            shared.append((spark.sparkContext.broadcast((hashes, idf)), block.sublinear))
            weights.append(idf)
            parts.append((width, width + len(hashes)))
            width += len(hashes)
        names, kept = [self.names[b.key] for b in found], [*KEPT, "_train", "_test"]
        kinds = [f"{f.name.lstrip('_')} array<{f.dataType.simpleString()}>" for f in self.rows.select(*kept).schema]
        blobs = [f"{c} binary" for c in ("ptr", "idx", "tf", "grams", "starts", "rows", "by_gram", "norm")]
        made = self.rows.select(*kept, *dict.fromkeys(names)).mapInArrow(packer(shared, names, kept), ", ".join([*kinds, *blobs]))
        return Blocks(made, np.concatenate(weights, axis=1), parts, labels)
