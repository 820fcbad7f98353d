"""Token ids in Re-Pair compressed blocks with random access by document."""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulse.llm.hashing import chunks
from pulse.llm.registry import query, read
from pulse.session import run_dir

END_ID = 2
BLOCK_TOKENS = 1 << 20
BIN_BITS = 20
FALL = 4
FEW = 1 << 15
CACHE_WORDS = 1_500_000
CHUNK = 1 << 22  # bytes of text encoded at once

# A run of Latin letters that neither composition nor lower-casing splits,
# then ASCII signs: the shape whose two pieces the tokenizer cuts apart.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([!-/:-@\[-`{-~]*)")
SIGNS = string.punctuation

# Byte-level vocabularies spell bytes as printable signs: the others, in
# ascending order, are moved up to 256.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_SIGNS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}

FORMAT = (
    "part int, block int, n_tokens long, doc_ids array<long>, doc_tokens array<long>, doc_symbols array<long>, "
    "base int, width int, rules binary, rule_lengths binary, symbols binary"
)

_cache: dict[str, dict[str, bytes]] = {}


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _whole(parts: list[str], tok) -> Iterator[tuple[str, bytes]]:
    for at in range(0, len(parts), 10_000):
        some = parts[at : at + 10_000]
        for part, e in zip(some, tok.encode_batch_fast(some, add_special_tokens=False), strict=True):
            yield part, np.array(e.ids, "<u4").tobytes()


def _learn(new: set[str], known: dict[str, bytes], tok) -> None:
    """Encode parts not yet known. A part of letters and punctuation is a
    lower-cased word and a run of signs to this vocabulary, so the words go
    straight to the tokenizer's model; any other part takes its whole way."""
    pieces, odd = {}, set()
    for part in new:
        word = part.rstrip(SIGNS)
        if word.isascii() and word.isalpha():
            pieces[part] = (word.lower(), part[len(word) :])
        elif m := PLAIN.fullmatch(part):
            pieces[part] = (m[1].lower(), m[2])
        else:
            odd.add(part)
    words = {w for w, _ in pieces.values()}.difference(known)
    odd.update({p for _, p in pieces.values()}.difference(known))
    known.update(_whole(sorted(odd), tok))
    model = tok.model.tokenize
    for w in words:
        form = w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_SIGNS)
        known[w] = struct.pack(f"<{len(t)}I", *[x.id for x in t]) if (t := model(form)) else b""
    for part, (w, p) in pieces.items():
        known[part] = known[w] + known[p]


def encode(texts: list[str], path: str) -> list[np.ndarray]:
    """Token ids of each text (uint32), without special tokens.

    The vocabulary drops blanks and never joins across them, so a text's ids
    are those of its parts between blanks and line ends. Arrow cuts the texts
    and numbers the distinct parts, so a part is looked up once for all texts
    given. Each part is encoded once while it stays in the worker's cache; the
    cache is emptied when it holds ``CACHE_WORDS`` parts.
    """
    if not texts:
        return []
    known = _cache.setdefault(path, {"": b""})
    if len(known) > CACHE_WORDS:
        known.clear()
        known[""] = b""
    spaced = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " ")
    cut = pc.split_pattern(spaced, " ")
    numbered = cut.values.dictionary_encode()
    distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
    codes = list(map(known.get, distinct))
    if new := {p for p, ids in zip(distinct, codes, strict=True) if ids is None}:
        _learn(new, known, _tokenizer(path))
        codes = list(map(known.__getitem__, distinct))
    size = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
    which = numbered.indices.to_numpy()
    ids = _spread(np.frombuffer(b"".join(codes), "<u4"), np.cumsum(size) - size, size, which)
    ends = np.concatenate(([0], np.cumsum(size[which])))[cut.offsets.to_numpy()]
    return [ids[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


# -- grammar ---------------------------------------------------------------


def _every_second(places: np.ndarray) -> np.ndarray:
    """Of each run of neighbouring places the second, the fourth, and so on."""
    group = places - np.arange(len(places))
    first = np.flatnonzero(np.diff(group, prepend=-1))
    inside = np.arange(len(places)) - np.repeat(first, np.diff(np.append(first, len(places))))
    return places[inside % 2 == 1]


def _bins(pairs: np.ndarray) -> np.ndarray:
    mixed = pairs * np.uint64(0x9E3779B97F4A7C15)
    mixed >>= np.uint64(64 - BIN_BITS)
    return mixed.view(np.int64)


def _order(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted pairs and their places before. Places go into the bits that
    the symbols leave free, since plain numbers are sorted faster."""
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    left, right = values >> half, values & low
    bits, room = (int(right.max(initial=0)).bit_length(), len(values).bit_length())
    if int(left.max(initial=0)).bit_length() + bits + room > 64:
        order = np.argsort(values)
        return values[order], order
    bits, room = np.uint64(bits), np.uint64(room)
    left <<= bits
    left |= right
    left <<= room
    left |= np.arange(len(values), dtype=np.uint64)
    left.sort()
    order = (left & ((np.uint64(1) << room) - np.uint64(1))).view(np.int64)
    return values[order], order


def _groups(code: np.ndarray, rules: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct pairs: ``(pairs, count, rule, group)`` in the order of the
    pairs; ``rule`` is -1 without one, ``group`` is the pair of each place."""
    both = np.concatenate([rules, code])
    ordered, order = _order(both)
    first = np.diff(ordered, prepend=~ordered[:1]) != 0
    group = np.empty(len(both), np.int32)
    group[order] = np.cumsum(first, dtype=np.int32) - 1
    pairs = ordered[first]
    rule = np.full(len(pairs), -1, np.int32)
    rule[group[: len(rules)]] = np.arange(len(rules))
    group = group[len(rules) :]
    return pairs, np.bincount(group, minlength=len(pairs)), rule, group


def compress(ids: np.ndarray, last: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair in rounds: ``(symbols, last, rules)``, a rule being a pair of
    symbols of 32 bits each.

    Each round gives a nonterminal to the most frequent adjacent pairs and
    replaces their occurrences, from the left in a run of one symbol; where
    two pairs overlap, the earlier rule wins, the other waits for a round. A
    rule that is left with less than two places in its round is not made. The
    least count falls by ``FALL`` a round down to 2; the end is reached when
    no pair occurs twice and none has a rule. A pair never reaches past the
    end of a document (``last``).
    """
    s, last, rules = ids.astype(np.uint32), last.copy(), np.empty(0, np.uint64)
    ruled, least, whole = np.zeros(1 << BIN_BITS, bool), len(s), True
    live = np.ones(len(s), bool)  # places whose pair may occur twice or have a rule
    while len(s) > 1:
        # In a run of one symbol every second place overlaps the one before.
        inner = ~last[:-1]
        twin = (s[1:] == s[:-1]) & inner
        same = np.flatnonzero(twin[1:] & twin[:-1]) + 1
        inner[same] = False
        inner[_every_second(same)] = True
        at = np.flatnonzero(inner & live[:-1])
        code = s[at].astype(np.uint64)
        code <<= np.uint64(32)
        code |= s[1:][at]
        bins, least = _bins(code), max(2, least // FALL)
        if len(at) > FEW:
            full = np.bincount(bins, minlength=1 << BIN_BITS)
            least = max(2, min(least, int(full.max()) // FALL))
            # A pair alone in its bin occurs once, and again only with new symbols.
            kind = (((full >= least) | ruled).view(np.int8) - ((full == 1) & ~ruled).view(np.int8))[bins]
            live[at[np.flatnonzero(kind < 0)]] = False
            often = np.flatnonzero(kind > 0)
            at, code, bins = at[often], code[often], bins[often]
        met = np.zeros(1 << BIN_BITS, bool)
        met[bins] = True
        known = np.flatnonzero(met[_bins(rules)])
        pairs, count, rule, group = _groups(code, rules[known])
        live[at[((count == 1) & (rule < 0))[group]]] = False
        fresh = np.flatnonzero((rule < 0) & (count >= least))
        fresh = fresh[np.lexsort((fresh, -count[fresh]))]
        none = len(rules) + len(fresh)
        of = np.full(len(pairs), none, np.int32)
        of[rule >= 0] = known[rule[rule >= 0]]
        of[fresh] = len(rules) + np.arange(len(fresh))
        rank = np.full(len(s) + 1, none, np.int32)
        own = of[group]
        rank[1:][at] = own
        won = np.flatnonzero(own < none)
        hit, own = at[won], own[won]
        won = np.flatnonzero((own < rank[hit]) & (own < rank[2:][hit]))
        hit, own = hit[won], own[won]
        made = np.bincount(own, minlength=none) > 1
        made[: len(rules)] = True
        used = np.flatnonzero(made[own])
        hit, own = hit[used], own[used]
        # The first rule has every place of its pair, so a round with any pair
        # to replace makes the text shorter. The last one looks at all places.
        if not len(hit):
            if least == 2 and whole:
                break
            if least == 2:
                live[:], whole = True, True
            continue
        new = pairs[fresh[made[len(rules) :]]]
        s[hit] = base + (np.cumsum(made) - 1)[own]
        rules, whole = np.concatenate([rules, new]), False
        ruled[_bins(new)] = True
        last[hit] = last[hit + 1]
        live[hit], live[np.maximum(hit, 1) - 1] = True, True
        keep = np.ones(len(s), bool)
        keep[hit + 1] = False
        keep = np.flatnonzero(keep)
        s, last, live = s[keep], last[keep], live[keep]
    return s, last, rules


def expand(symbols: np.ndarray, base: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The terminals that a short run of symbols stands for, step by step."""
    while len(symbols) and symbols.max() >= base:
        wide = symbols >= base
        place = np.cumsum(1 + wide) - 1 - wide
        out = np.empty(len(symbols) + int(wide.sum()), np.int64)
        out[place[~wide]] = symbols[~wide]
        rule = symbols[wide] - base
        out[place[wide]], out[place[wide] + 1] = left[rule], right[rule]
        symbols = out
    return symbols


def _spread(flat: np.ndarray, start: np.ndarray, size: np.ndarray, symbols: np.ndarray) -> np.ndarray:
    """The parts of ``flat`` that the symbols name, one after the other."""
    n = size[symbols]
    ends = np.cumsum(n)
    shift = np.repeat(start[symbols] - (ends - n), n)
    return flat[shift + np.arange(len(shift), dtype=shift.dtype)]


def expand_all(symbols: np.ndarray, base: int, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The terminals of a whole block: every rule is written out once, the
    ones of each depth together, then all symbols are looked up in one step."""
    total = base + int(lengths.sum(dtype=np.int64))
    kind = np.int32 if max(total, int(lengths.max(initial=1)) * len(symbols)) < 1 << 31 else np.int64
    size = np.concatenate([np.ones(base, kind), lengths.astype(kind)])
    start = np.concatenate([np.arange(base, dtype=kind), np.zeros(len(rules), kind)])
    depth, flat = np.zeros(base + len(rules), np.int32), np.empty(total, np.uint32)
    flat[:base] = np.arange(base)
    while len(rules):
        new = 1 + depth[rules].max(1)
        if (new == depth[base:]).all():
            break
        depth[base:] = new
    done = base
    for own in np.split(np.argsort(depth[base:], kind="stable"), np.cumsum(np.bincount(depth[base:])[1:])[:-1]) if len(rules) else []:
        ends = np.cumsum(size[base + own], dtype=kind)
        start[base + own] = done + ends - size[base + own]
        flat[done : done + ends[-1]] = _spread(flat, start, size, rules[own].ravel())
        done += int(ends[-1])
    return _spread(flat, start, size, symbols)


def _lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Expansion length of each rule. A rule uses symbols of earlier rules only."""
    out = np.ones(base + len(rules), np.int64)
    while len(rules):
        new = out[rules].sum(1)
        if (new == out[base:]).all():
            break
        out[base:] = new
    return out[base:]


def _to_bytes(symbols: np.ndarray, width: int) -> bytes:
    return symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def _from_bytes(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 4), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u4").ravel().astype(np.int64)


def pack(ids: list[np.ndarray], base: int) -> dict:
    """One block: the grammar of a run of documents. Its symbols have as many
    bytes (2 to 4) as the number of its rules asks for."""
    sizes = np.array([len(x) for x in ids], np.int64)
    flat = np.concatenate(ids)
    last = np.zeros(len(flat), bool)
    last[np.cumsum(sizes) - 1] = True
    symbols, ends, codes = compress(flat, last, base)
    width = max(2, -(-(base + len(codes) - 1).bit_length() // 8))
    rules = np.stack([codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)], 1)
    return {
        "n_tokens": int(sizes.sum()),
        "doc_tokens": sizes,
        "doc_symbols": np.diff(np.concatenate(([0], np.flatnonzero(ends) + 1))),
        "base": base,
        "width": width,
        "rules": _to_bytes(rules, width),
        "rule_lengths": _lengths(rules.astype(np.int64), base).astype("<u4").tobytes(),
        "symbols": _to_bytes(symbols, width),
    }


def unpack(block: dict, doc: int | None = None) -> np.ndarray:
    """Ids of a block, or of its ``doc``-th document only: then only that
    document's symbols are read and expanded."""
    width, base = block["width"], block["base"]
    rules = _from_bytes(block["rules"], width).reshape(-1, 2)
    if doc is None:
        return expand_all(_from_bytes(block["symbols"], width), base, rules, np.frombuffer(block["rule_lengths"], "<u4"))
    start = int(np.sum(block["doc_symbols"][:doc]))
    symbols = block["symbols"][start * width : (start + int(block["doc_symbols"][doc])) * width]
    return expand(_from_bytes(symbols, width), base, rules[:, 0], rules[:, 1])


def token_at(block: dict, place: int) -> int:
    """The id at a place of the block: stored expansion lengths lead to it
    without decoding what lies before."""
    width, base = block["width"], block["base"]
    rules = _from_bytes(block["rules"], width).reshape(-1, 2)
    long = np.concatenate([np.ones(base, np.int64), np.frombuffer(block["rule_lengths"], "<u4").astype(np.int64)])
    symbols = _from_bytes(block["symbols"], width)
    ends = np.cumsum(long[symbols])
    i = int(np.searchsorted(ends, place, side="right"))
    rest, s = place - int(ends[i] - long[symbols[i]]), int(symbols[i])
    while s >= base:
        a, b = rules[s - base]
        s, rest = (int(a), rest) if rest < long[a] else (int(b), rest - int(long[a]))
    return s


# -- Spark -----------------------------------------------------------------


def _packer(path: str, base: int, block_tokens: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, ids, docs, held = TaskContext.get().partitionId(), 0, [], [], 0
        schema = pa.schema(
            [("part", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64())]
            + [(c, pa.list_(pa.int64())) for c in ("doc_ids", "doc_tokens", "doc_symbols")]
            + [("base", pa.int32()), ("width", pa.int32())]
            + [(c, pa.binary()) for c in ("rules", "rule_lengths", "symbols")]
        )

        def block():
            row = {"part": part, "block": number, "doc_ids": docs, **pack(ids, base)}
            return pa.RecordBatch.from_pylist([row], schema)

        end = np.array([end_id], np.uint32)
        for rows, texts in chunks(batches, limit=CHUNK):
            for doc, x in zip(rows.column(0).to_pylist(), encode([t.decode() for t in texts], path), strict=True):
                if held and held + len(x) + 1 > block_tokens:
                    yield block()
                    number, ids, docs, held = number + 1, [], [], 0
                ids.append(np.concatenate([x, end]))
                docs.append(doc)
                held += len(x) + 1
        if held:
            yield block()

    return run


def write_tokens(
    df: DataFrame,
    out: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    block_tokens: int = BLOCK_TOKENS,
) -> None:
    """Write the token ids of all documents to ``out`` in ascending id order.

    A block holds whole documents, about ``block_tokens`` ids, and a grammar
    of its own; blocks are the rows of Parquet files, so Spark's writer
    commits them on any file system and a lost task writes its files anew. A
    longer document has a block to itself. NULL texts count as empty, NULL
    ids come first, equal ids in the order of their texts; every row is a
    document. Other columns are not read.
    """
    base = _tokenizer(tokenizer).get_vocab_size(with_added_tokens=True)
    src = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    # Equal ids meet in one part; ids are keys, so no part grows with them.
    ranged = src.repartitionByRange("id").sortWithinPartitions("id", "text")
    ranged.mapInArrow(_packer(tokenizer, base, block_tokens, end_id), FORMAT).write.parquet(out)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row).astype("<u4", copy=False)
            ends = np.cumsum(row["doc_tokens"])
            starts = ends - row["doc_tokens"]
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
            n = len(crc)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * n, pa.int32()),
                    pa.array([row["block"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(row["doc_tokens"], pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["part", "block", "doc_id", "place", "n_tokens", "ids_crc32"],
            )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: ``doc_id``, ``start`` (ids before
    it), ``n_tokens`` and ``ids_crc32`` of its decoded ids.

    Offsets are summed in two steps, over parts and over the blocks of a
    part, and meet the documents' rows, never the payload, in a join.
    """
    files = spark.read.schema(FORMAT).parquet(path)
    sizes = files.select("part", "block", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sizes.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).drop("n_tokens")
    offsets = blocks.join(parts, "part").select("part", "block", (F.col("ahead") + F.col("within")).alias("offset"))
    rows = files.mapInArrow(_digest, "part int, block int, doc_id long, place long, n_tokens long, ids_crc32 long")
    return rows.join(offsets, ["part", "block"]).select(
        "doc_id", (F.col("offset") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


@query("op5_token_grammar")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    out = run_dir(spark, "tokens")
    write_tokens(read(spark, folder, "documents", "doc_id", "text"), out, public_tokenizers.path("word_bpe_49k.json"))
    return read_digests(spark, out)
