"""Word and shingle hashes of many texts at once, as numpy arrays.

Used inside Spark tasks; every function works on a bounded chunk of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

GOLDEN = np.uint64(0x9E3779B97F4A7C15)
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit numbers (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# A random number for each byte, and the same with A-Z as a-z.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = FOLDED_VALUES[97:123]
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x5851F42D4C957F2D
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def _pieces(buf: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about ``CHUNK_BYTES`` that end after a blank."""
    at, end = 0, len(buf)
    while at < end:
        to = min(end, at + CHUNK_BYTES)
        while to < end and not BLANK[buf[to - 1]]:
            more = np.flatnonzero(BLANK[buf[to : to + 4096]])
            to = to + int(more[0]) + 1 if len(more) else min(end, to + 4096)
        yield at, to
        at = to


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, A-Z lower-cased, and the number of
    its text. Words are runs of bytes other than blank, tab to CR."""
    joined = b" ".join(texts) + b" "
    buf = np.frombuffer(joined, np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    hashes, places = [], []
    for lo, hi in _pieces(buf):
        part = buf[lo:hi]
        inside = np.concatenate(([False], ~BLANK[part], [False]))
        turn = np.flatnonzero(inside[1:] != inside[:-1])
        start, stop = turn[::2], turn[1::2]
        power, back = _power_tables(len(part) + 1)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(FOLDED_VALUES[part] * power[: len(part)], out=total[1:])
        h = (total[stop] - total[start]) * back[start]
        hashes.append(mix(h + (stop - start).astype(np.uint64) * GOLDEN))
        places.append(start + lo)
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.searchsorted(ends, np.concatenate(places), side="right")


def _folded(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` words."""
    size = max(0, len(words) - n + 1)
    out = np.full(size, n, np.uint64)
    for k in range(n):
        out = mix((out ^ words[k : k + size]) + GOLDEN)
    return out


def shingle_sets(texts: list[bytes], n: int = 5) -> list[np.ndarray]:
    """The sorted distinct ``n``-word shingles of each text as 64-bit hashes;
    a text of fewer words has its whole sequence as one, without words none."""
    words, text = word_hashes(texts)
    bounds = np.searchsorted(text, np.arange(len(texts) + 1))
    runs = _folded(words, n)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(runs[a : b - n + 1]))
        else:
            out.append(_folded(words[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches of about ``limit`` bytes of text, with the texts
    as bytes; NULL counts as empty."""
    for batch in batches:
        column = batch.column(batch.schema.names.index(text)).cast(pa.large_binary())
        lengths = np.nan_to_num(np.array(pa.compute.binary_length(column).to_numpy(zero_copy_only=False), float))
        part = (np.cumsum(lengths) // limit).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a), [t or b"" for t in column.slice(a, b - a).to_pylist()]


def long_lists(values: list[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit hashes as an Arrow column of signed longs."""
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
