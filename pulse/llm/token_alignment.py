"""Alignment of two tokenizers over inverted bitmaps of their id pairs.

A text is cut by both tokenizers. Where tokens of both end at one byte, a
group ends; two tokens whose bytes overlap are linked. For every linked pair
of ids the index holds compressed bitmaps of the documents: one of the
documents that hold the pair and, for pairs linked more than once in a text,
one bitmap per binary digit of the links beyond the first (the multiplicity
planes). Popcounts give document and link counts; the postings, walked once
more with those counts, give each document its scores.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.hashing import chunks
from pulse.llm.registry import query, read
from pulse.session import stored

# Documents and bitmap words that one block of the index holds at most.
BLOCK_DOCS = 1 << 16
BLOCK_WORDS = 1 << 21
WORD_BITS = 4
CACHE_BYTES = 96 << 20
ENTRY_BYTES = 400

ROW = (
    "block long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a int, b int, plane int, n_docs long, places binary, words binary"
)
_KINDS = pa.schema(
    [("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("plane", pa.int32()), ("n_docs", pa.int64())]
    + [("places", pa.binary()), ("words", pa.binary())]
)

PART = re.compile(r"\s*\S+|\s+")
# Blanks other than space and line feed may sit inside one token of either side.
OTHER_BLANK = re.compile(r"[^\S \n]")
NOTHING = (0, 0, 0, b"", b"")


def _byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if
    it is a visible Latin-1 letter, else the next free one from U+0100 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Pair:
    """Both tokenizers, the bytes of every id, and the parts seen so far."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letter, vocab = _byte_letters(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (1 + max(vocab.values()))
        for piece, i in vocab.items():
            self.a_bytes[i] = bytes(letter[c] for c in piece) if set(piece) <= letter.keys() else piece.encode()
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.blank = self.b.piece_to_id("▁")
        # Texts may be cut before a blank if no piece reaches from a letter
        # into a blank, nor from a blank into a line feed.
        plain = [p.replace("▁", " ") for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        self.cuts = not any(re.search(r"\S[ \n]| \n", p) for p in plain)
        self.a_long = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_long = np.array([len(x) for x in self.b_bytes], np.int64)
        # Each id in decimal, followed by what may come after it.
        self.written = [b"%d%c" % (i, c) for c in b",|;" for i in range(max(len(self.a_bytes), size))]
        self.known: dict[str, tuple | None] = {}
        self.held = 0

    def align(self, units: list[str], a: list[list[int]], b: list[list[int]]) -> list[tuple | None]:
        """``(n_a, n_b, n_groups, groups, links)`` of each unit, all of them
        in one pass; None if the tokens of one side do not spell the unit.
        ``links`` are codes ``a * ids of B + b`` as bytes of 64-bit numbers."""
        out: list[tuple | None] = [None] * len(units)
        fit = [
            k
            for k, u in enumerate(units)
            if (raw := u.encode()) and b"".join(map(self.a_bytes.__getitem__, a[k])) == raw == b"".join(map(self.b_bytes.__getitem__, b[k]))
        ]
        if not fit:
            return out
        n_a, n_b = (np.array([len(x[k]) for k in fit]) for x in (a, b))
        a_ids, b_ids = (np.fromiter((i for k in fit for i in x[k]), np.int64, int(n.sum())) for x, n in ((a, n_a), (b, n_b)))
        a_end, b_end = np.cumsum(self.a_long[a_ids]), np.cumsum(self.b_long[b_ids])
        # Every cut of either side ends one link; a cut of both ends a group.
        both = np.zeros((2, int(a_end[-1]) + 1), np.int32)
        both[0, a_end], both[1, b_end] = 1, 1
        cut = np.flatnonzero(both.any(0))
        shared = both[:, cut].all(0)
        link_a, link_b = (np.cumsum(both, axis=1)[:, cut] - both[:, cut])
        codes = a_ids[link_a] * len(self.b_bytes) + b_ids[link_b]
        group_a, group_b = link_a[shared], link_b[shared]  # last token of each group
        # A token's place in the written form: groups before it, then A before B.
        a_group = np.searchsorted(group_a, np.arange(len(a_ids)))
        b_group = np.searchsorted(group_b, np.arange(len(b_ids)))
        b_before = np.concatenate(([0], group_b[:-1] + 1))
        order = np.empty(len(a_ids) + len(b_ids), np.int64)
        step, a_after, b_after = len(self.written) // 3, np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        a_after[group_a], b_after[group_b] = 1, 2
        order[np.arange(len(a_ids)) + b_before[a_group]] = a_ids + step * a_after
        order[np.arange(len(b_ids)) + group_a[b_group] + 1] = b_ids + step * b_after
        texts = list(map(self.written.__getitem__, order.tolist()))
        ends = np.cumsum(n_a + n_b).tolist()
        # Units end where both sides end, so their groups and links are runs.
        last = np.cumsum(n_a) - 1
        groups = np.diff(a_group[last], prepend=-1).tolist()
        links = (n_a + n_b - groups).tolist()
        raw, at, start = codes.tobytes(), 0, 0
        for k, na, nb, ng, nl, end in zip(fit, n_a.tolist(), n_b.tolist(), groups, links, ends, strict=True):
            out[k] = (na, nb, ng, b"".join(texts[start:end])[:-1], raw[at : at + 8 * nl])
            at, start = at + 8 * nl, end
        return out

    def whole(self, text: str) -> tuple | None:
        """Alignment of a whole text that may not be cut into parts."""
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        return self.align([" " + text], [ids], [self.b.encode(text)])[0]

    def _learn(self, parts: list[str]) -> None:
        for at in range(0, len(parts), 4096):
            some = parts[at : at + 4096]
            a = [e.ids for e in self.a.encode_batch_fast(some, add_special_tokens=False)]
            # The tokenizer puts a blank before what it is given; a part that
            # has none of its own loses the token of that blank again.
            own = [p[0] == " " for p in some]
            b = self.b.encode([p[1:] if o else p for p, o in zip(some, own, strict=True)], num_threads=1)
            for k, (p, o) in enumerate(zip(some, own, strict=True)):
                if p == " ":
                    b[k] = [self.blank]
                elif not o:
                    b[k] = b[k][1:] if b[k][:1] == [self.blank] else []
            for p, got in zip(some, self.align(some, a, b), strict=True):
                self.known[p] = got
                self.held += ENTRY_BYTES + 4 * len(p) + (len(got[3]) + len(got[4]) if got else 0)

    def texts(self, texts: list[str]) -> list[list[tuple]]:
        """The aligned units of each text, in order; an empty list if the text
        is empty or one side's tokens do not spell a blank and the text.

        Neither tokenizer joins a letter and a blank after it, so a text of
        plain blanks is the sequence of its parts, each worked out once while
        it stays in the worker's cache. The cache is emptied when it holds
        ``CACHE_BYTES``.
        """
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.held = 0
        cut = [PART.findall(" " + t) if t and self.cuts and not OTHER_BLANK.search(t) else None for t in texts]
        self._learn(sorted(set().union(*(p for p in cut if p)).difference(self.known)))
        out = []
        for t, parts in zip(texts, cut, strict=True):
            if parts:
                units = list(map(self.known.__getitem__, parts))
                if None in units:
                    units = [self.whole(t)]
            else:
                units = [self.whole(t)] if t else []
            out.append([] if None in units else units)
        return out


@lru_cache(maxsize=2)
def _pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


# -- index -----------------------------------------------------------------


def planes(codes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bitmap words of the links ``(code, place)``: sorted keys of code, plane
    and word, and 16 bits each. Plane 0 marks the documents that hold the
    pair; plane k + 1 has digit k of the number of further links."""
    key, n = np.unique((codes << 16) | places, return_counts=True)
    code, place, more = key >> 16, key & 0xFFFF, n - 1
    keys, bits = [], []
    for plane in range(1 + int(more.max(initial=0)).bit_length()):
        on = (more >> (plane - 1)) & 1 == 1 if plane else np.ones(len(key), bool)
        keys.append((((code[on] << 6) | plane) << (16 - WORD_BITS)) | (place[on] >> WORD_BITS))
        bits.append(np.uint16(1) << (place[on] & 15).astype(np.uint16))
    return merge(keys, bits)


def merge(keys: list[np.ndarray], bits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The bitwise OR of several lists of bitmap words."""
    key, bit = np.concatenate([*keys, np.empty(0, np.int64)]), np.concatenate([*bits, np.empty(0, np.uint16)])
    if not len(key):
        return key.astype(np.int64), bit.astype(np.uint16)
    order = np.argsort(key, kind="stable")
    key, bit = key[order], bit[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
    return key[first], np.bitwise_or.reduceat(bit, first)


def _binary(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], ends * flat.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def _table(**columns: pa.Array) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in _KINDS], schema=_KINDS
    )


def _posting_rows(block: int, keys: np.ndarray, bits: np.ndarray, n_b: int) -> Iterator[pa.RecordBatch]:
    """One row per pair and plane of a block, its words in ascending places."""
    whole = keys >> (16 - WORD_BITS)
    ends = np.append(np.flatnonzero(np.diff(whole)) + 1, len(whole)) if len(whole) else np.empty(0, np.int64)
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    count = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))
    place = (keys & ((1 << (16 - WORD_BITS)) - 1)).astype(np.uint16)
    for at in range(0, len(ends), 50_000):
        lo, hi = starts[at : at + 50_000], ends[at : at + 50_000]
        code, first, last = whole[lo], int(lo[0]), int(hi[-1])
        yield _table(
            block=pa.array(np.full(len(lo), block)),
            a=pa.array((code >> 6) // n_b),
            b=pa.array((code >> 6) % n_b),
            plane=pa.array(code & 63),
            n_docs=pa.array(count[hi] - count[lo]),
            places=_binary(place[first:last], hi - first),
            words=_binary(bits[first:last], hi - first),
        )


def _indexer(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, task = _pair(a_path, b_path), TaskContext.get().partitionId()
        n_b = len(pair.b_bytes)
        block, used, keys, bits, held = task << 32, 0, [], [], 0
        for rows, raw in chunks(batches):
            ids = rows.column(0).to_pylist()
            for at in range(0, len(ids), BLOCK_DOCS):
                found = pair.texts([t.decode("utf-8", "replace") for t in raw[at : at + BLOCK_DOCS]])
                if used and (used + len(found) > BLOCK_DOCS or held > BLOCK_WORDS):
                    yield from _posting_rows(block, *merge(keys, bits), n_b)
                    block, used, keys, bits, held = block + 1, 0, [], [], 0
                sums = [tuple(map(sum, list(zip(*u, strict=True))[:3])) if u else (0, 0, 0) for u in found]
                n_links = np.array([x + y - z for x, y, z in sums], np.int64)
                codes = np.frombuffer(b"".join(u[4] for units in found for u in units), np.int64)
                more = planes(codes, np.repeat(used + np.arange(len(found)), n_links))
                keys.append(more[0])
                bits.append(more[1])
                held += len(more[0])
                n_a, n_bs, n_groups = (pa.array(c, pa.int64()) for c in zip(*sums, strict=True))
                yield _table(
                    block=pa.array([block] * len(found)),
                    place=pa.array(range(used, used + len(found))),
                    doc_id=pa.array(ids[at : at + BLOCK_DOCS], pa.int64()),
                    n_a=n_a,
                    n_b=n_bs,
                    n_groups=n_groups,
                    n_links=pa.array(n_links),
                    groups_sha256=pa.array([hashlib.sha256(b";".join(x[3] for x in u)).hexdigest() if u else "" for u in found]),
                )
                used += len(found)
        if keys:
            yield from _posting_rows(block, *merge(keys, bits), n_b)

    return run


def pair_index(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(documents, postings)``, both from one pass that is written once.

    ``documents``: ``block, place, doc_id, n_a, n_b, n_groups, n_links,
    groups_sha256``, one row per input row. ``postings``: ``block, a, b,
    plane, n_docs, places, words``: of the documents of a block, those that
    hold the pair (plane 0) or have digit plane - 1 set in their links beyond
    the first; ``words`` are the non-zero 16-bit words of the bitmap and
    ``places`` their numbers. A block is a run of at most ``BLOCK_DOCS`` rows
    of one task, so a frequent pair has many rows of bounded size.

    A text that is NULL, empty or not spelled back by both tokenizers has
    zeros, '' as hash, and no postings. Very long texts are aligned whole.
    NULL and repeated ids are rows like others. Other columns are not read.
    """
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = stored(src.mapInArrow(_indexer(a_path, b_path), ROW), "pairs")
    documents = rows.where("a IS NULL").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return documents, rows.where("a IS NOT NULL").select("block", "a", "b", "plane", "n_docs", "places", "words")


def pair_counts(postings: DataFrame) -> DataFrame:
    """``a, b, docs, links`` of each pair over all documents. Blocks hold
    different documents, so popcounts of their bitmaps add up."""
    weight = F.when(F.col("plane") == 0, F.lit(1).cast("long")).otherwise(F.expr("shiftleft(1L, plane - 1)"))
    return postings.groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n_docs")).otherwise(F.lit(0))).alias("docs"),
        F.sum(F.col("n_docs") * weight).alias("links"),
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores of the documents of each block, from rows sorted by block."""
    now, best, total = None, None, None

    def rows():
        place = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(place), now)), pa.array(place.astype(np.int32)), pa.array(best[place]), pa.array(total[place])],
            names=["block", "place", "n_best", "count_sum"],
        )

    for batch in batches:
        block = batch.column(0).to_numpy()
        plane, links, top = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 4, 5))
        each = np.where(plane > 0, np.int64(1) << np.maximum(plane - 1, 0).astype(np.int64), 1)
        size = np.array([len(x) // 2 for x in batch.column(2).to_pylist()], np.int64)
        places, words = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16) for k in (2, 3))
        ends = np.cumsum(size)
        for lo in [0, *(np.flatnonzero(np.diff(block)) + 1).tolist()] if len(block) else []:
            hi = int(np.searchsorted(block, block[lo], side="right"))
            if block[lo] != now:
                if now is not None:
                    yield rows()
                now, best, total = block[lo], np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
            first, last = int(ends[lo] - size[lo]), int(ends[hi - 1])
            on = np.flatnonzero(np.unpackbits(words[first:last].view(np.uint8), bitorder="little"))
            word = on >> WORD_BITS
            docs = (places[first:last][word].astype(np.int64) << WORD_BITS) | (on & 15)
            row = np.repeat(np.arange(lo, hi), size[lo:hi])[word]
            np.add.at(total, docs, (each * links)[row])
            np.add.at(best, docs, (each * top)[row])
    if now is not None:
        yield rows()


def document_scores(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """``block, place, n_best, count_sum`` of each document with a link.

    Every posting meets the count of its pair and goes back, as bitmap, to its
    block; there the counts are added to the documents whose bits are set. No
    row per document and pair is made.
    """
    best = counts.groupBy("b").agg(F.max("links").alias("most"))
    known = counts.join(best, "b").select("a", "b", "links", (F.col("links") == F.col("most")).cast("long").alias("top"))
    rows = postings.join(known, ["a", "b"]).select("block", "plane", "places", "words", "links", "top")
    rows = rows.repartition("block").sortWithinPartitions("block")
    return rows.mapInArrow(_walk, "block long, place int, n_best long, count_sum long")


def align_tokenizers(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: id, tokens of A and B, groups, links, links whose
    pair is the most linked one of its B id, and the sum of the links' counts.

    ``a_path`` is a byte-level vocabulary, ``b_path`` a piece model that puts
    a blank before the text; see :func:`pair_index` for odd rows. An empty
    table gives no rows.
    """
    documents, postings = pair_index(df, a_path, b_path, id_col, text)
    counts = stored(pair_counts(postings), "pair-counts")
    out = documents.join(document_scores(postings, counts), ["block", "place"], "left")
    return out.select(
        F.col("doc_id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")), "groups_sha256",
    )


@query("op11_token_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers as P

    docs = read(spark, folder, "documents", "doc_id", "text")
    return align_tokenizers(docs, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"))
