import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulse.llm import decontamination as D
from pulse.llm import token_grammar as G
from pulse.llm import url_filter as U
from pulse.llm.all_queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")

# -- decontamination -------------------------------------------------------


def brute_nearest(item: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=120))
def test_myers_matches_dynamic_programming(item, text):
    distance, end = D.nearest(item, text)
    assert distance == brute_nearest(item, text)
    assert brute_nearest(item, text[:end]) == distance


@settings(max_examples=100, deadline=None)
@given(st.data())
def test_every_place_within_the_budget_is_found(data):
    item = data.draw(st.text("abcdefgh ", min_size=40, max_size=80))
    item = D.normal(item) or "a"
    changed = list(item)
    for _ in range(D.budget(len(item), 0.1)):
        k = data.draw(st.integers(0, max(0, len(changed) - 1)))
        kind = data.draw(st.sampled_from(["swap", "cut", "add"]))
        if kind == "cut" and changed:
            del changed[k]
        elif kind == "add":
            changed.insert(k, "z")
        elif changed:
            changed[k] = "z"
    text = data.draw(st.text("xyz ", max_size=60)) + "".join(changed) + data.draw(st.text("xyz ", max_size=60))
    got = D.Finder([(7, item)], 0.1).hits(text)
    want = brute_nearest(D.normal(item), text)
    assert want <= D.budget(len(item), 0.1)
    assert [(g[0], g[1]) for g in got] == [(7, want)]
    assert brute_nearest(item, text[got[0][2] : got[0][3]]) == want


def test_contaminated_rows(spark, odd_docs):
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    bench = spark.createDataFrame(
        [(1, texts[1][40:240].upper()), (2, None), (3, ""), (4, "a text without an id"), (5, "nowhere to be seen in here"), (None, "two words")],
        "item_id long, text string",
    )
    for chars in (10, 1000):
        got = {(r.doc_id, r.item_id, r.distance) for r in D.contaminated(odd_docs, bench, block_chars=chars).collect()}
        assert {(1, 1, 0), (3, 1, 0), (None, 4, 0)} <= got and {i for _, i, _ in got} == {1, 4}
        clean = D.decontaminate(odd_docs, bench, block_chars=chars)
        assert clean.columns == odd_docs.columns
        assert clean.count() == odd_docs.count() - len({(i, texts.get(i)) for i, _, _ in got})
    assert D.contaminated(odd_docs.limit(0), bench).count() == 0
    assert D.contaminated(odd_docs, bench.limit(0)).count() == 0
    assert D.decontaminate(odd_docs, bench.limit(0)).count() == odd_docs.count()


def test_table_against_brute_force(spark, folder):
    docs = {r.doc_id: D.normal(r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    items = {r.item_id: D.normal(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op3_decontamination"](spark, folder).collect()}
    verbatim = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert verbatim <= set(got) and all(got[k] == 0 for k in verbatim)
    assert all(D.nearest(items[i], docs[d])[0] == n for (d, i), n in got.items())


# -- token files -----------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_encoding_equals_the_library(text):
    tok = Tokenizer.from_file(PATH)
    assert G.encode([text], PATH)[0].tolist() == tok.encode(text, add_special_tokens=False).ids


def test_encoding_of_special_shapes():
    tok = Tokenizer.from_file(PATH)
    for text in ["İstanbul ΣΑΣ it's WE'LL", "a <|endoftext|> b<|startoftext|>", "naïve, Straße. ÑANDÚ!?", "x\x01 y\u0085z", "'s 'tis don't"]:
        assert G.encode([text], PATH)[0].tolist() == tok.encode(text, add_special_tokens=False).ids


def test_encoding_of_many_texts_and_all_letters():
    tok = Tokenizer.from_file(PATH)
    letters = [chr(k) for k in range(0xC0, 0x250)]
    texts = ["", " ", "\n", *(f"{c}b{c} a{c}?! {c}" for c in letters), "a\n\nb  c\0d", *(f"Ab{s}{s}" for s in G.SIGNS), "a?b!"]
    got = G.encode(texts, PATH)
    assert [x.tolist() for x in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(x.dtype == np.uint32 for x in got) and G.encode([], PATH) == []


@pytest.mark.parametrize("top", [3, 2**19, 2**32 - 1])
def test_pairs_are_ordered_with_their_places(top):
    rng = np.random.default_rng(1)
    pairs = (rng.integers(0, top, 999, dtype=np.uint64) << np.uint64(32)) | rng.integers(0, top, 999, dtype=np.uint64)
    before = pairs.copy()
    ordered, order = G._order(pairs)
    assert (pairs == before).all() and (ordered == np.sort(pairs)).all()
    assert (pairs[order] == ordered).all() and len(set(order.tolist())) == 999


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 9), max_size=200), min_size=1, max_size=12), st.sampled_from([12, 70_000]))
def test_grammar_round_trip(docs, base):
    ids = [np.array([*d, 2], np.uint32) for d in docs]
    block = G.pack(ids, base)
    whole = np.concatenate(ids)
    assert (G.unpack(block) == whole).all()
    assert all((G.unpack(block, k) == x).all() for k, x in enumerate(ids))
    assert all(G.token_at(block, k) == whole[k] for k in range(len(whole)))


def test_repeats_are_compressed():
    ids = [np.array([1, 5, 7, 9] * 500 + [2], np.uint32)] * 4
    block = G.pack(ids, 12)
    assert len(block["symbols"]) < 2 * 8004 / 8


def test_no_pair_is_left_twice():
    rng = np.random.default_rng(3)
    passage = rng.integers(3, 5000, 3000)
    ids = [np.append(np.concatenate([rng.integers(3, 5000, 40), passage]), 2).astype(np.uint32) for _ in range(2)]
    ids += [np.array([*([7] * k), 2], np.uint32) for k in (1, 2, 3, 9, 700)]
    ids += [np.array([11, 12, *rng.integers(3, 5000, 20), 2], np.uint32) for _ in range(2)]
    for base in (5000, 65_530):
        block = G.pack(ids, base)
        width = block["width"]
        symbols = G._from_bytes(block["symbols"], width)
        rules = G._from_bytes(block["rules"], width).reshape(-1, 2).tolist()
        docs = np.split(symbols, np.cumsum(block["doc_symbols"])[:-1])
        seen: set[tuple[int, int]] = set()
        for doc in docs:
            k = 0
            while k + 1 < len(doc):
                pair = (int(doc[k]), int(doc[k + 1]))
                assert pair not in seen and list(pair) not in rules
                seen.add(pair)
                k += 1 + (len(doc) > k + 2 and doc[k] == doc[k + 1] == doc[k + 2])
        assert np.frombuffer(block["rule_lengths"], "<u4").max() >= 3000
        used = np.bincount(np.concatenate([symbols, np.ravel(rules)]), minlength=base + len(rules))
        assert (used[base:] > 0).all() and width == (2 if base == 5000 else 3)
        assert (G.unpack(block) == np.concatenate(ids)).all()


def test_files_of_odd_rows(spark, odd_docs, tmp_path):
    out = str(tmp_path / "tokens")
    G.write_tokens(odd_docs, out, PATH, block_tokens=2000)
    tok = Tokenizer.from_file(PATH)
    rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in odd_docs.collect()))
    want, start = [], 0
    for known, i, t in rows:
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], "<u4")
        want.append((i if known else None, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in G.read_digests(spark, out).collect()]
    assert sorted(got, key=lambda r: r[1]) == want


def test_files_of_an_empty_table(spark, tmp_path):
    out = str(tmp_path / "tokens")
    G.write_tokens(spark.createDataFrame([], "doc_id long, text string"), out, PATH)
    assert G.read_digests(spark, out).count() == 0


# -- urls ------------------------------------------------------------------


def test_parts_and_rules(spark):
    urls = [
        ("http://A.Example.ORG/es/x?y#z", "a.example.org", "/es/x", "example.org/es/", "block"),
        ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("https://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
        ("x://b.com/de/1://c.org/", "b.com", "/de/1://c.org/", "com/de/", "block"),
        ("http://org?q=/", "org", "", None, "allow"),
        ("http://Ünï.com#a", "Ünï.com", "", None, "allow"),
        ("no address", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
        ("http:///org/", "", "/org/", None, "allow"),
        ("http://a.org/" + "p/" * 40_000, "a.org", "/" + "p/" * 40_000, "org/", "allow"),
    ]
    df = spark.createDataFrame([(k, u[0], "clash") for k, u in enumerate(urls)], "page_id long, url string, score string")
    none = spark.createDataFrame([], "url string, label int")
    got = U.filter_urls(df, none, U.RULES).orderBy("page_id").collect()
    assert [(r.url, r.host, r.path, r.rule, r.verdict) for r in got] == urls
    some = spark.createDataFrame([(u[0], k % 2) for k, u in enumerate(urls)] * 2, "url string, label int")
    assert U.filter_urls(df, some, U.RULES).count() == len(urls)
    assert U.filter_urls(df.limit(0), some, U.RULES).count() == 0


def test_trees_judge_unseen_urls(spark, folder):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    labelled = U.label_urls(pages)
    out = U.filter_urls(pages.where("page_id % 2 = 0"), labelled.join(pages.where("page_id % 2 = 1"), "url", "left_semi"), [])
    truth = {r.url: r.label for r in labelled.collect()}
    rows = out.collect()
    assert sum((r.verdict == "block") == bool(truth[r.url]) for r in rows) >= 0.98 * len(rows)


def test_entropy(spark):
    df = spark.createDataFrame([("aabb",), ("abcd",), ("",)], "host string").withColumn("e", U._entropy("host"))
    assert [r.e for r in df.collect()] == pytest.approx([1.0, 2.0, 0.0])
