"""Secrets found by regular expressions behind a trigram index.

Each rule's expression gives a Boolean query over three-byte strings that any
match must contain. Documents are indexed in blocks by their trigrams, the
postings of a query are intersected and united, and only the documents left
are searched with the expression itself. A rule that no trigram must occur in
searches every document.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Iterator
from functools import lru_cache
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm.hashing import chunks
from pulse.llm.registry import query, read

with warnings.catch_warnings():
    warnings.simplefilter("ignore", DeprecationWarning)
    from re import _constants as K
    from re import _parser as P


class Rule(NamedTuple):
    """An expression whose matches count if their ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def either_case(word: str) -> str:
    """An expression for the word in any mixture of cases."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])
BASE = [
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Its matches are whole runs, so those of 32 and more are the ones to keep.
    Rule("hex", r"[0-9a-f]{32,}"),
]
# Fixed prefixes and forms by which public services mark their credentials.
MORE = [
    Rule("forge", r"gh[opsu]_[A-Za-z0-9]{36}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("maps", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("login", r"[a-z][a-z0-9]{1,15}://[A-Za-z0-9_.]{1,64}:[^\x00-\x20/@:]{1,128}@"),
]
RULES = BASE + MORE

# -- queries ---------------------------------------------------------------

# A query is True (all documents), a trigram, or ("and" | "or", parts).
Query = bool | bytes | tuple

SET_LIMIT = 24
CLASS_LIMIT = 8
KEEP = 8


class Known(NamedTuple):
    """What is known of the strings an expression matches: all of them
    (``exact``), else how they begin and end, and a query they satisfy."""

    exact: frozenset | None
    first: frozenset
    last: frozenset
    match: Query


NONE = frozenset([b""])
ANY = Known(None, NONE, NONE, True)
EMPTY = Known(NONE, NONE, NONE, True)


def both(*parts: Query) -> Query:
    own = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not own else own[0] if len(own) == 1 else ("and", tuple(own))


def any_of(*parts: Query) -> Query:
    if any(p is True for p in parts):
        return True
    own = list(dict.fromkeys(parts))
    return own[0] if len(own) == 1 else ("or", tuple(own))


def holds_one(strings: frozenset) -> Query:
    """A text that holds one of the strings holds all trigrams of that one."""
    if any(len(s) < 3 for s in strings):
        return True
    return any_of(*(both(*(s[k : k + 3] for k in range(len(s) - 2))) for s in sorted(strings)))


def _bounded(x: Known) -> Known:
    """Long or many strings become part of the query; two bytes at each end
    stay, so that trigrams across the seam to a neighbour are still found."""
    exact, first, last, match = x
    if exact is not None and (len(exact) > SET_LIMIT or max(map(len, exact)) > KEEP):
        exact, first, last = None, exact, exact
    if exact is not None:
        return Known(exact, exact, exact, match)
    match = both(match, holds_one(first), holds_one(last))
    first, last = frozenset(s[:2] for s in first), frozenset(s[-2:] for s in last)
    return Known(None, first if len(first) <= SET_LIMIT else NONE, last if len(last) <= SET_LIMIT else NONE, match)


def _pairs(x: frozenset, y: frozenset) -> frozenset:
    return frozenset(a + b for a, b in product(x, y))


def _then(x: Known, y: Known) -> Known:
    if x.exact is not None and y.exact is not None and len(x.exact) * len(y.exact) <= SET_LIMIT * 4:
        exact = _pairs(x.exact, y.exact)
        return _bounded(Known(exact, exact, exact, both(x.match, y.match)))
    seam = holds_one(_pairs(x.last, y.first))
    first = _pairs(x.exact, y.first) if x.exact is not None else x.first
    last = _pairs(x.last, y.exact) if y.exact is not None else y.last
    return _bounded(Known(None, first, last, both(x.match, y.match, seam)))


def _or(x: Known, y: Known) -> Known:
    if x.exact is not None and y.exact is not None:
        exact = x.exact | y.exact
        return _bounded(Known(exact, exact, exact, any_of(x.match, y.match) if x.match is not y.match else x.match))
    match = any_of(*(both(k.match, holds_one(k.first), holds_one(k.last)) for k in (x, y)))
    return _bounded(Known(None, x.first | y.first, x.last | y.last, match))


def _one_of(letters: set[int], fold: bool) -> Known:
    if len(letters) > 2 * CLASS_LIMIT or fold and any(c > 127 for c in letters):
        return ANY
    strings = frozenset(chr(c).lower().encode() if c < 128 else chr(c).encode() for c in letters)
    return Known(strings, strings, strings, True)


def _class(items: list) -> set[int] | None:
    out: set[int] = set()
    for op, arg in items:
        if op is K.LITERAL:
            out.add(arg)
        elif op is K.RANGE and arg[1] - arg[0] <= 2 * CLASS_LIMIT:
            out.update(range(arg[0], arg[1] + 1))
        else:
            return None
    return out


def _known(tree, fold: bool) -> Known:
    """What is known of the matches of a parsed expression, piece by piece."""
    out = EMPTY
    for op, arg in tree:
        if op is K.LITERAL:
            own = _one_of({arg}, fold)
        elif op is K.IN:
            letters = _class(arg)
            own = ANY if letters is None else _one_of(letters, fold)
        elif op is K.BRANCH:
            own = _known(arg[1][0], fold)
            for other in arg[1][1:]:
                own = _or(own, _known(other, fold))
        elif op is K.SUBPATTERN:
            own = _known(arg[3], fold or bool(arg[1] & re.IGNORECASE))
        elif op is K.ATOMIC_GROUP:
            own = _known(arg, fold)
        elif op in (K.MAX_REPEAT, K.MIN_REPEAT, K.POSSESSIVE_REPEAT):
            least, most, inner = arg
            once, own = _known(inner, fold), EMPTY
            for _ in range(min(least, 3)):
                own = _then(own, once)
            if (least, most) == (0, 1):
                own = _or(once, EMPTY)
            elif most > min(least, 3):
                # More may follow or stand between: only the ends and what is inside stay.
                own = Known(None, own.first, own.last, both(own.match, holds_one(own.first), holds_one(own.last))) if least else ANY
        elif op in (K.AT, K.ASSERT, K.ASSERT_NOT):
            continue
        else:
            own = ANY
        out = _then(out, own)
    return out


@lru_cache(maxsize=1024)
def trigram_query(pattern: str, flags: int = 0) -> Query:
    """A query that every text with a match of ``pattern`` satisfies; trigrams
    are of UTF-8 bytes, A-Z lower-cased. True if no trigram must occur."""
    parsed = P.parse(pattern, flags)
    known = _known(parsed, bool(parsed.state.flags & re.IGNORECASE))
    if known.exact is not None:
        return both(known.match, holds_one(known.exact))
    return both(known.match, holds_one(known.first), holds_one(known.last))


def trigrams_of(q: Query) -> set[bytes]:
    return set() if q is True else {q} if isinstance(q, bytes) else set().union(*map(trigrams_of, q[1]))


# -- index -----------------------------------------------------------------


def postings(texts: list[bytes], wanted: np.ndarray | None = None) -> dict[bytes, np.ndarray]:
    """Documents of each trigram, as sorted numbers of the list; with
    ``wanted``, a table over all codes, of those trigrams only."""
    buf = np.frombuffer(b"".join(texts).lower(), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    wide = buf.astype(np.int32)
    code = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    at = np.flatnonzero(wanted[code]) if wanted is not None else np.arange(len(code))
    doc = np.searchsorted(ends, at, side="right")
    inside = at + 3 <= ends[doc] if len(at) else np.empty(0, bool)
    pair = np.unique((code[at[inside]].astype(np.int64) << 32) | doc[inside])
    codes, first = np.unique(pair >> 32, return_index=True)
    lists = np.split(pair & 0xFFFFFFFF, first[1:])
    return {int(c).to_bytes(3, "big"): own for c, own in zip(codes, lists, strict=False)}


def candidates(q: Query, index: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Numbers of the documents that satisfy a query."""
    if q is True:
        return np.arange(n)
    if isinstance(q, bytes):
        return index.get(q, np.empty(0, np.int64))
    kind, parts = q
    if kind == "or":
        return np.unique(np.concatenate([candidates(p, index, n) for p in parts]))
    found = candidates(parts[0], index, n)
    for p in parts[1:]:
        if not len(found):
            break
        found = np.intersect1d(found, candidates(p, index, n), assume_unique=True)
    return found


class Scanner:
    """Compiled rules with their queries and the trigrams these ask for."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(k, r, re.compile(r.pattern), trigram_query(r.pattern)) for k, r in enumerate(rules)]
        self.wanted = np.zeros(1 << 24, bool)
        self.wanted[[int.from_bytes(t, "big") for _, _, _, q in self.rules for t in trigrams_of(q)]] = True

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int, str]]]:
        """``(start, rule, end, match)`` of each text in order, in code points."""
        index, out = postings(texts, self.wanted), [[] for _ in texts]
        plain: dict[int, str] = {}
        for k, rule, pattern, q in self.rules:
            for d in candidates(q, index, len(texts)).tolist():
                if d not in plain:
                    plain[d] = texts[d].decode("utf-8", "replace")
                for m in pattern.finditer(plain[d]):
                    if len(m[rule.group]) >= rule.least:
                        out[d].append((m.start(), k, m.end(), m[0]))
        for own in out:
            own.sort()
        return out


@lru_cache(maxsize=4)
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("match", pa.string())]))


def _scan(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(rules)
        for rows, texts in chunks(batches):
            found = [[{"kind": rules[k].kind, "start": a, "end": b, "match": m} for a, k, b, m in own] for own in scanner.spans(texts)]
            yield pa.RecordBatch.from_arrays([rows.column(0).cast(pa.int64()), pa.array(found, SPANS)], names=["_id", "_spans"])

    return run


def find_secrets(df: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, spans)`` per row of ``df``: the matches of all rules, each with
    ``kind, start, end, match`` in code points, by start and order of rules.

    Matches of a rule are leftmost and do not overlap; those whose group is
    too short are dropped afterwards. The index of a task's block (about a
    megabyte of texts) lives as long as that block; nothing is shuffled. A
    NULL or empty text, or one without a match, has an empty list; very long
    texts are a block of their own. NULL and repeated ids are rows like
    others, an empty table gives no rows, other columns are not read.
    """
    src = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("text"))
    out = src.mapInArrow(_scan(tuple(rules)), "_id long, _spans array<struct<kind:string,start:int,end:int,match:string>>")
    return out.select(F.col("_id").alias(id_col), F.col("_spans").alias("spans"))


def _index_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    for rows, texts in chunks(batches):
        ids, index = rows.column(0).to_numpy(zero_copy_only=False), postings(texts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([block] * len(index), pa.int64()),
                pa.array(list(index), pa.binary()),
                pa.array([ids[own] for own in index.values()], pa.list_(pa.int64())),
            ],
            names=["block", "trigram", "ids"],
        )
        block += 1


def trigram_index(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The whole index as ``(block, trigram, ids)``, for rules not known yet:
    a block is about a megabyte of texts, so no list grows with the table.
    Rows without an id or text are left out."""
    src = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("text")).where("_id IS NOT NULL AND text IS NOT NULL")
    return src.mapInArrow(_index_rows, "block long, trigram binary, ids array<long>")


def _digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, and the spans as text and as hash."""
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in BASE]
    return found.select(id_col, *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def _sql() -> str:
    """Matches and the text between them give every match its place."""
    kinds = []
    for k, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        kinds.append(
            f"SELECT rid, text, {k} AS k, '{r.kind}' AS kind, {r.least} AS least, regexp_extract_all(text, '{p}', 0) AS m, "
            f"regexp_extract_all(text, '{p}', {r.group}) AS g, string_split_regex(text, '{p}') AS s FROM d WHERE regexp_matches(text, '{p}')"
        )
    base = ", ".join(f"'{r.kind}'" for r in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
m AS ({" UNION ALL ".join(kinds)}),
e AS (SELECT rid, k, kind, least, unnest(m) AS m, unnest(g) AS g, unnest(s[1:len(m)]) AS s, generate_subscripts(m, 1) AS i FROM m),
p AS (SELECT *, CAST(sum(length(s) + length(m)) OVER (PARTITION BY rid, k ORDER BY i) AS BIGINT) AS b FROM e),
f AS (SELECT rid, k, kind, b - length(m) AS a, kind || ':' || (b - length(m)) || ':' || b AS span FROM p WHERE length(g) >= least),
o AS (
    SELECT rid, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
        string_agg(span, ',' ORDER BY a, k) FILTER (kind IN ({base})) AS b, string_agg(span, ',' ORDER BY a, k) AS spans
    FROM f GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
    sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN o USING (rid)
"""


@query("op13_secret_scan", _sql())
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return _digests(find_secrets(read(spark, folder, "documents", "doc_id", "text")))
