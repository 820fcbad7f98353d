"""Language identification with unigrams summed over all segmentations."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.common import fold, letter_words
from pulse.llm.hashing import BYTE_VALUES, GOLDEN, chunks, mix
from pulse.llm.registry import query, read

LONGEST = 16
WORD_BYTES = 48
SLOT_BITS = 19
SCALE = 1000.0
SMOOTHING = 200.0
FLUSH_WORDS = 400_000
CACHE_WORDS = 800_000
_BASE = np.uint64(0x5851F42D4C957F2D)


class Pieces:
    """A fixed vocabulary of byte strings that finds many substrings at once.

    A piece is found by its 64-bit hash in a table of slots; pieces whose slot
    is taken are in a second table. All 256 single bytes belong to it, so
    every word has a segmentation.
    """

    def __init__(self, pieces: list[bytes]):
        self.pieces = sorted({p for p in pieces if 0 < len(p) <= LONGEST} | {bytes([b]) for b in range(256)})
        self.size = np.array([len(p) for p in self.pieces])
        self.keys = np.zeros(len(self.pieces), np.uint64)
        for n in range(1, LONGEST + 1):
            at = np.flatnonzero(self.size == n)
            if len(at):
                self.keys[at] = self.prefixes(np.array([list(self.pieces[i]) for i in at], np.uint8))[:, n]
        self.tables = [np.zeros(1 << SLOT_BITS, np.int32) for _ in range(2)]
        left = np.arange(len(self.keys))
        for turn, table in enumerate(self.tables):
            slots = self._slots(self.keys[left], turn)
            table[slots[::-1]] = left[::-1]
            left = left[table[slots] != left]
        self.rest = {int(self.keys[i]): int(i) for i in left}

    @staticmethod
    def prefixes(words: np.ndarray) -> np.ndarray:
        """Hash of every prefix of equally long words, as ``(words, bytes + 1)``."""
        out = np.zeros((len(words), words.shape[1] + 1), np.uint64)
        for j in range(words.shape[1]):
            out[:, j + 1] = out[:, j] * _BASE + BYTE_VALUES[words[:, j]]
        return out

    @staticmethod
    def _slots(keys: np.ndarray, turn: int) -> np.ndarray:
        return mix(keys + np.uint64(turn) * GOLDEN) >> np.uint64(64 - SLOT_BITS)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of the piece with each hash, or -1."""
        at = self.tables[0][self._slots(keys, 0)]
        miss = np.flatnonzero(self.keys[at] != keys)
        if len(miss):
            again = self.tables[1][self._slots(keys[miss], 1)]
            again[self.keys[again] != keys[miss]] = -1
            at[miss] = again
            for key, i in self.rest.items():
                at[keys == np.uint64(key)] = i
        return at


def vocabulary(model: str) -> list[bytes]:
    """Pieces of a public sentencepiece model; its word mark becomes a blank."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
    return [sp.id_to_piece(i).replace("▁", " ").lower().encode() for i in ids]


def cut(word: str) -> list[bytes]:
    """A blank and the word; of a longer word, parts of ``WORD_BYTES`` bytes at most."""
    whole = (" " + word).encode()
    if len(whole) <= WORD_BYTES:
        return [whole]
    step = WORD_BYTES // 4
    return [(" " * (not i) + word[i : i + step - 1]).encode() for i in range(0, len(word), step - 1)]


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and byte matrix of the words of each length."""
    size = np.array([len(w) for w in words])
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, np.frombuffer(b"".join([words[i] for i in at]), np.uint8).reshape(len(at), n)


def lattice(words: np.ndarray, vocab: Pieces) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Where pieces lie in equally long words: start, end, words, pieces; by end."""
    h, n, power = vocab.prefixes(words), words.shape[1], [np.uint64(1)]
    for _ in range(min(n, LONGEST)):
        power.append(np.uint64(int(power[-1]) * int(_BASE) % (1 << 64)))
    out = []
    for j in range(1, n + 1):
        for i in range(max(0, j - LONGEST), j):
            at = vocab.find(h[:, j] - h[:, i] * power[j - i])
            hit = np.flatnonzero(at >= 0)
            if len(hit):
                out.append((i, j, hit, at[hit]))
    return out


def forward(words: np.ndarray, vocab: Pieces, weight: np.ndarray) -> np.ndarray:
    """Log-probability of equally long words under each language, summed over
    every segmentation. ``weight`` holds piece probabilities times ``SCALE``
    per byte, which keeps the sums inside the range of a double."""
    n = words.shape[1]
    alpha = np.zeros((n + 1, len(words), weight.shape[1]))
    alpha[0] = 1.0
    for i, j, hit, piece in lattice(words, vocab):
        alpha[j][hit] += alpha[i][hit] * weight[piece]
    return np.log(alpha[n]) - n * np.log(SCALE)


def expected(words: np.ndarray, counts: np.ndarray, vocab: Pieces, weight: np.ndarray) -> np.ndarray:
    """Expected piece counts ``(pieces, languages)`` of counted words: forward
    and backward sums under one model."""
    n, steps = words.shape[1], lattice(words, vocab)
    alpha, beta = np.zeros((n + 1, len(words))), np.zeros((n + 1, len(words)))
    alpha[0] = beta[n] = 1.0
    for i, j, hit, piece in steps:
        alpha[j][hit] += alpha[i][hit] * weight[piece]
    out = np.zeros((len(vocab.pieces), counts.shape[1]))
    for i, j, hit, piece in reversed(steps):
        part = beta[j][hit] * weight[piece]
        beta[i][hit] += part
        share = alpha[i][hit] * part / alpha[n][hit]
        for k in range(counts.shape[1]):
            out[:, k] += np.bincount(piece, share * counts[hit, k], len(vocab.pieces))
    return out


def _counter(vocab):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Pieces = vocab.value
        weight = np.full(len(v.pieces), 1.0 / len(v.pieces)) * SCALE**v.size
        total: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def settle():
            langs = sorted(words)
            every = list(set().union(*words.values()))
            counts = np.array([[words[x][w] for x in langs] for w in every], float).reshape(len(every), len(langs))
            for at, mat in by_length(every):
                got = expected(mat, counts[at], v, weight)
                for k, x in enumerate(langs):
                    total[x] = total.get(x, 0) + got[:, k]
            words.clear()

        for part, texts in chunks(batches):
            for lang, text in zip(part.column(1).to_pylist(), texts, strict=True):
                words.setdefault(lang, Counter()).update(letter_words(text))
            if sum(map(len, words.values())) > FLUSH_WORDS:
                words.update({x: _cut_counts(c) for x, c in words.items()})
                settle()
        if words:
            words.update({x: _cut_counts(c) for x, c in words.items()})
            settle()
        for lang, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(c[at])],
                names=["lang", "piece", "n"],
            )

    return run


def _cut_counts(counts: Counter) -> Counter:
    out: Counter = Counter()
    for w, n in counts.items():
        for p in cut(w):
            out[p] += n
    return out


def learn(train: DataFrame, model: str, text: str = "text", lang: str = "lang") -> tuple[list[str], Pieces, np.ndarray]:
    """Languages, vocabulary and piece probabilities ``(pieces, languages)``.

    One step of expectation maximisation from equal piece probabilities over
    all rows of ``train``: the texts of a task are reduced to at most one sum
    per language and piece before the shuffle. What the driver gets is
    bounded by the vocabulary times the number of languages.
    """
    vocab = Pieces(vocabulary(model))
    shared = train.sparkSession.sparkContext.broadcast(vocab)
    rows = train.where(F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    sums = rows.mapInArrow(_counter(shared), "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    got = sums.orderBy("lang", "piece").toPandas()
    langs = sorted(got["lang"].unique())
    counts = np.zeros((len(vocab.pieces), len(langs)))
    counts[got["piece"], got["lang"].map({x: k for k, x in enumerate(langs)})] = got["n"]
    pooled = (counts.sum(1) + 1.0) / (counts.sum() + len(vocab.pieces))
    probs = (counts + SMOOTHING * pooled[:, None]) / (counts.sum(0) + SMOOTHING)
    return langs, vocab, probs


_words: dict[int, tuple[dict[str, int], np.ndarray]] = {}


def _scorer(shared, key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, v, probs = shared.value
        weight = probs * (SCALE**v.size)[:, None]
        if key not in _words:
            _words.clear()
            _words[key] = ({}, np.zeros((1024, len(langs))))
        known, table = _words[key]
        for part, texts in chunks(batches):
            found = [letter_words(t) for t in texts]
            if len(known) > CACHE_WORDS:
                known.clear()
            new = list(set().union(*found).difference(known))
            if new and langs:
                pieces = [cut(w) for w in new]
                owner = np.repeat(np.arange(len(new)), [len(p) for p in pieces])
                flat = [x for p in pieces for x in p]
                logs = np.zeros((len(new), len(langs)))
                for at, mat in by_length(flat):
                    np.add.at(logs, owner[at], forward(mat, v, weight))
                first, last = len(known), len(known) + len(new)
                if last > len(table):  # twice the room, so growing costs little
                    table = np.concatenate([table, np.zeros((last, len(langs)))])
                table[first:last] = logs
                known.update(zip(new, range(first, last), strict=True))
            best, score = [], []
            for words in found:
                if not words or not langs:
                    best.append("und")
                    score.append(0.0)
                    continue
                s = table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].sum(0)
                k = int(s.argmax())
                best.append(langs[k])
                score.append(float(1.0 / np.exp(s - s[k]).sum()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )
        _words[key] = (known, table)

    return run


def identify(df: DataFrame, fitted: tuple[list[str], Pieces, np.ndarray], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, lang_pred, score)`` of every row of ``df`` for a model of :func:`learn`.

    A text is the sum of its words, lower-cased runs of letters with a blank
    before; a word of more than ``WORD_BYTES`` bytes is scored in parts. The
    score is the posterior of the best language with equal priors; among
    equals the first in the alphabet wins. A NULL text, one without a letter,
    or a model without languages gives ``und`` and 0. Every row is judged by
    its text alone; nothing but id and text is read.
    """
    shared = df.sparkSession.sparkContext.broadcast(fitted)
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    out = src.mapInArrow(_scorer(shared, uuid.uuid4().int), "doc_id long, lang_pred string, score double")
    return out.withColumnRenamed("doc_id", id_col)


@query("op9_language_id")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, folder, "documents", "doc_id", "text", "lang")
    fitted = learn(docs.where(fold("doc_id", 3) != 1), public_tokenizers.path("piece_bpe_32k.model"))
    out = identify(docs, fitted)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
