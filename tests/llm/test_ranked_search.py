import math
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from pulse.llm import ranked_search as R

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    """All scores of all documents, sorted."""
    rows = [(i, Counter(t), len(t)) for i, text in docs if (t := split(text))]
    n, total = len(rows), sum(x for _, _, x in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, size in rows:
            m = 75 + 25 * size * n // total
            score = 0
            for t in split(text):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score:
                scored.append((-score, i is None, i or 0))
        out += [(item, k + 1, None if null else i, -s) for k, (s, null, i) in enumerate(sorted(scored)[:top])]
    return out


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_terms(text):
    assert [t.decode() for t in R.terms(text.encode())] == split(text)


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_tree_returns_the_best(data):
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    n, v, top = int(rng.integers(1, 900)), int(rng.integers(1, 30)), int(rng.integers(1, 12))
    dense = rng.integers(0, 4, (n, v)) * (rng.random((n, v)) < rng.random(v))
    dense[rng.random(n) < 0.4] = dense[0]
    dense = dense[dense.any(1)]
    if not len(dense):
        return
    m, ids = rng.integers(75, 78, len(dense)), rng.permutation(len(dense))
    row, term = np.nonzero(dense)
    tree = R.Tree(ids, m, np.cumsum(np.bincount(row, minlength=len(dense))), term, dense[row, term], top)
    for _ in range(4):
        weight = rng.integers(0, 50, v) * (rng.random(v) < 0.5)
        score = (weight * R.part(dense, m[:, None])).sum(1)
        want = sorted((-int(s), int(i)) for s, i in zip(score, ids, strict=True) if s)[:top]
        assert tree.search(weight, [], top)[0] == want


def test_bounds_leave_subtrees_out():
    rng = np.random.default_rng(5)
    n, topics = 6000, 100
    # Two of ten terms of a document's topic, rarer ones first, and eight of twenty that all share.
    rare = np.array([10 * t + rng.choice(10, 2, replace=False) for t in rng.integers(0, topics, n)])
    shared = 10 * topics + np.stack([rng.choice(20, 8, replace=False) for _ in range(n)])
    pick = np.sort(np.concatenate([rare, shared], 1), 1)
    tree = R.Tree(np.arange(n), np.full(n, 100), 10 * np.arange(1, n + 1), pick.ravel(), np.ones(10 * n, np.int64), 5)
    weight = np.zeros(10 * topics + 20, np.int64)
    weight[10 * topics :], weight[30:40] = 30, 3000
    best, opened = tree.search(weight, [], 5)
    score = (weight[pick] * R.part(np.int64(1), np.int64(100))).sum(1)
    assert best == sorted((-int(x), k) for k, x in enumerate(score))[:5] and opened < n / R.BUCKET / 8


def test_odd_rows_against_brute_force(spark, odd_docs):
    docs = [(r.doc_id, r.text) for r in odd_docs.collect()]
    items = [(1, docs[0][1][:80]), (2, None), (3, ""), (4, "a text without an id"), (None, "Two WORDS two"), (4, "line again"), (5, "nowhere"), (6, "!!")]
    bench = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, score string")

    def key(r):
        return tuple((x is None, x or 0) for x in r)

    want = sorted(brute(docs, items), key=key)
    for chars, parts in ((10, 1), (10_000, 5)):
        got = R.ranked_search(odd_docs.repartition(parts), bench, item_chars=chars)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=key) == want
    assert R.ranked_search(odd_docs.limit(0), bench).count() == R.ranked_search(odd_docs, bench.limit(0)).count() == 0


def test_small_blocks_and_ties(spark, monkeypatch):
    docs = [(k, f"red fox {'den ' * (k % 3)}") for k in range(400)] + [(None, "red fox")] * 30
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(1, "fox den"), (2, "red")], "item_id long, text string")
    monkeypatch.setattr(R, "BLOCK_ENTRIES", 50)
    assert sorted(map(tuple, R.ranked_search(df, bench).collect())) == sorted(brute(docs, [(1, "fox den"), (2, "red")]))
