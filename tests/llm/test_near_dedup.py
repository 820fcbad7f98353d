import re

import numpy as np
import pytest
from compare import compare, connect

from pulse.llm import near_dedup as N
from pulse.llm.components import components
from pulse.llm.hashing import shingle_sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, n=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(grams(t))
    root = {i: i for i in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(root)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            for s in sets[a]:
                for t in sets[b]:
                    if s and t and 100 * len(s & t) >= 75 * len(s | t):
                        p, q = find(a), find(b)
                        root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def test_odd_rows_match_brute_force(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = brute(rows)
    got = N.near_duplicates(odd_docs).collect()
    assert sorted(r.n_shingles for r in got) == sorted(len(grams(t)) for _, t in rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id])


def test_crowd_of_near_copies_matches_brute_force(spark):
    """A group whose pairs lie on both sides of the threshold, with chains."""
    rng = np.random.default_rng(3)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for k in rng.choice(120, rng.integers(0, 12), replace=False):
            w[k] = f"r{rng.integers(1000)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_blocks_do_not_change_the_result(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(k * (1 + (i % 9 == k % 40))) % 97}" for k in range(90))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    monkeypatch.setattr(N, "BLOCK", 4)
    assert {r.doc_id: r.component_id for r in N.near_duplicates(df).collect()} == want


def test_empty_table(spark):
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_one_document_of_each_group_stays(odd_docs):
    kept = N.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns or set(kept.columns) == set(odd_docs.columns)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 8, 10, 11, 12, 13] and ids.count(None) == 1


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (600, 200, 200))
    x, y = np.concatenate([common, a]), np.concatenate([common, b])
    sig = N.super_minhash(np.concatenate([x, y]), np.repeat([0, 1], 800), 2, 144)
    assert abs((sig[0] == sig[1]).mean() - 0.6) < 0.12
    assert len(np.unique(sig[0])) == 144


def test_small_sets_fill_every_place():
    sig = N.super_minhash(np.array([5, 5, 9], np.uint64), np.array([0, 1, 1]), 2, 144)
    assert (sig != np.iinfo(np.uint64).max).all() and 0.2 < (sig[0] == sig[1]).mean() < 0.8


def test_shingles_survive_piece_borders(monkeypatch):
    from pulse.llm import hashing

    text = ("Some WORDS and ünïcode " * 4000).encode()
    whole = shingle_sets([text, b"x y"])
    monkeypatch.setattr(hashing, "CHUNK_BYTES", 64)
    assert all((a == b).all() for a, b in zip(whole, shingle_sets([text, b"x y"]), strict=True))


def test_components_of_a_path_and_a_star(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7)]
    got = {r.u: r.v for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {k: 0 for k in range(1, 41)} | {100 + k: 100 for k in range(1, 50)}


@pytest.mark.parametrize("name", ["op1_minhash_dedup", "op4_quality_rules"])
def test_oracle(spark, folder, name):
    from pulse.llm.all_queries import ORACLES, QUERIES

    assert compare(QUERIES[name](spark, folder), connect(folder), ORACLES[name]) == []
