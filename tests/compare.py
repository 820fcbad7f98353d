"""Compare Spark results with DuckDB: names, types by kind, rows, values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = Path(folder) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(_cell, v)) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_cell(v[k])}" for k in sorted(v)) + "}"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{v + 0.0:.9g}"
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted("|".join(_cell(r[i]) for i in order) for r in rows)


def _kind(t: str) -> str:
    t = t.lower()
    for kind, words in {
        "list": ["[]", "array"],
        "int": ["int", "long"],
        "float": ["double", "float", "decimal"],
        "text": ["varchar", "string", "char"],
        "time": ["timestamp", "date"],
        "bool": ["bool"],
    }.items():
        if any(w in t for w in words):
            return kind
    return t


def compare(df, con, sql: str) -> list[str]:
    """Differences found; empty when both sides agree."""
    res = con.execute(sql)
    desc = [(c[0], str(c[1])) for c in res.description]
    expected = res.fetchall()
    actual = [_plain(r) for r in df.collect()]
    problems = []
    if sorted(df.columns) != sorted(n for n, _ in desc):
        return [f"columns {sorted(df.columns)} != {sorted(n for n, _ in desc)}"]
    mine = {f.name: _kind(f.dataType.simpleString()) for f in df.schema}
    for n, t in desc:
        if mine[n] != _kind(t):
            problems.append(f"type of {n}: {mine[n]} != {_kind(t)} ({t})")
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    a, b = _rows(df.columns, actual), _rows([n for n, _ in desc], expected)
    if a != b:
        diff = sorted(set(a) ^ set(b))
        problems.append(f"{len(diff)} differing rows, e.g. {[x[:300] for x in diff[:4]]}")
    return problems


def _plain(v):
    if hasattr(v, "asDict"):
        return [_plain(x) for x in v]
    if isinstance(v, list):
        return [_plain(x) for x in v]
    return v
