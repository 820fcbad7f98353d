import hashlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pulse.llm import token_alignment as T
from pulse.llm.all_queries import QUERIES

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
A = Tokenizer.from_file(A_PATH)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
LETTER = T._byte_letters()
A_TOKEN = {i: p for p, i in A.get_vocab().items()}


def token_bytes(text):
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_bytes = [bytes(LETTER[c] for c in A_TOKEN[i]) for i in a]
    b_bytes = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i in b for p in [B.id_to_piece(i)]]
    return a, b, a_bytes, b_bytes


def brute_text(text):
    """Groups and links of one text, byte by byte."""
    if not text:
        return [], []
    a, b, a_bytes, b_bytes = token_bytes(text)
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], []
    owner = [[k for k, x in enumerate(raw) for _ in x] for raw in (a_bytes, b_bytes)]
    pairs = list(dict.fromkeys(zip(*owner, strict=True)))  # the two tokens of every byte
    groups = [([], [])]
    for k, (i, j) in enumerate(pairs):
        more = pairs[k + 1] if k + 1 < len(pairs) else (None, None)
        groups[-1][0].extend([a[i]] if more[0] != i else [])
        groups[-1][1].extend([b[j]] if more[1] != j else [])
        if more[0] != i and more[1] != j and k + 1 < len(pairs):
            groups.append(([], []))
    links = [(a[i], b[j]) for i, j in pairs]
    return groups, links


def brute(texts):
    each = [brute_text(t) for t in texts]
    count = Counter(x for _, links in each for x in links)
    top = {}
    for (_, j), n in count.items():
        top[j] = max(top.get(j, 0), n)
    out = []
    for groups, links in each:
        form = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        n_a, n_b = (sum(len(g[k]) for g in groups) for k in (0, 1))
        best, total = sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links)
        out.append((n_a, n_b, len(groups), len(links), best, total, hashlib.sha256(form.encode()).hexdigest() if groups else ""))
    docs = Counter(x for _, links in each for x in set(links))
    return out, count, docs


ODD = [
    None, "", " ", "\n", "a", "naïve  café\n\n\tx", "日本語のテキスト 🙂🙂", "a▁b", "x\x00y", "<|endoftext|> <s></s> <0x41>", "tab\tand\r\nline; \n",
    "a   b    c\n\n  d", "it's we'll 12345 !!!???", "word " * 300, "é" * 50, "Ǆ ﬁ ½ Ａ", "  \xa0x\x1cy", " lead", "trail ", "‍﻿",
]


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("ab' ;)\n\r▁é日", max_size=40)))
def test_parts_give_the_libraries_tokens(text):
    units = T._pair(A_PATH, B_PATH).texts([text])[0]
    groups, links = brute_text(text)
    form = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    assert b";".join(u[3] for u in units).decode() == form
    got = np.frombuffer(b"".join(u[4] for u in units), np.int64)
    assert sorted(got.tolist()) == sorted(i * B.get_piece_size() + j for i, j in links)


def test_planes_count_links():
    code = np.array([5, 5, 5, 5, 7, 5, 7, 7], np.int64)
    place = np.array([0, 0, 0, 17, 17, 0, 17, 17], np.int64)
    key, bits = T.planes(code, place)
    got = {(int(k) >> 18, int(k) >> 12 & 63, int(k) & 4095): int(w) for k, w in zip(key, bits, strict=True)}
    # Pair 5: four links at place 0 (3 more: digits 1 and 2), one at 17; pair 7: three at 17.
    assert got == {(5, 0, 0): 1, (5, 0, 1): 2, (5, 1, 0): 1, (5, 2, 0): 1, (7, 0, 1): 2, (7, 2, 1): 2}
    again = T.merge([key, key], [bits, bits])
    assert (again[0] == key).all() and (again[1] == bits).all()


def test_odd_rows_against_brute_force(spark, odd_docs, monkeypatch):
    rows = [(k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (3, "a")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, block string, n_a int").repartition(3)
    want, count, docs = brute([t for _, t in rows])
    got = T.align_tokenizers(df, A_PATH, B_PATH)
    assert Counter(map(tuple, got.collect())) == Counter((i, *w) for (i, _), w in zip(rows, want, strict=True))
    counts = T.pair_counts(T.pair_index(df, A_PATH, B_PATH)[1]).collect()
    assert {(r.a, r.b): (r.docs, r.links) for r in counts} == {x: (docs[x], n) for x, n in count.items()}
    assert T.align_tokenizers(df.limit(0), A_PATH, B_PATH).count() == 0
    assert T.align_tokenizers(odd_docs, A_PATH, B_PATH).count() == odd_docs.count()


def test_blocks_and_tasks_do_not_matter(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    one = T.align_tokenizers(docs.coalesce(1), A_PATH, B_PATH)
    many = T.align_tokenizers(docs.repartition(40), A_PATH, B_PATH)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_table_against_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    want = {r.doc_id: w for r, w in zip(rows, brute([r.text for r in rows])[0], strict=True)}
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op11_token_alignment"](spark, folder).collect()} == want
