import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from pulse.llm import language_id as L
from pulse.llm import mixing as M
from pulse.llm import quality_classifier as C
from pulse.llm import toxicity as T
from pulse.llm.all_queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")


# -- language --------------------------------------------------------------


def every_segmentation(word: bytes, prob: dict[bytes, float]) -> float:
    if not word:
        return 1.0
    return sum(prob[word[:k]] * every_segmentation(word[k:], prob) for k in range(1, len(word) + 1) if word[:k] in prob)


def test_forward_sums_all_segmentations():
    vocab = L.Pieces([b" th", b"the", b"he", b"t", b" the", b"hea"])
    probs = np.random.default_rng(0).random((len(vocab.pieces), 2))
    probs /= probs.sum(0)
    weight = probs * (L.SCALE**vocab.size)[:, None]
    for word in (b" the", b" thea", b" x"):
        got = L.forward(np.frombuffer(word, np.uint8)[None, :], vocab, weight)[0]
        for k in range(2):
            want = every_segmentation(word, dict(zip(vocab.pieces, probs[:, k], strict=True)))
            assert got[k] == pytest.approx(math.log(want))


def test_expected_counts_weigh_segmentations():
    vocab = L.Pieces([b" ab", b"ab", b" a"])
    p = np.full(len(vocab.pieces), 1 / len(vocab.pieces))
    got = L.expected(np.frombuffer(b" ab", np.uint8)[None, :], np.array([[2.0]]), vocab, p * L.SCALE**vocab.size)[:, 0]
    q = dict(zip(vocab.pieces, p, strict=True))
    whole = every_segmentation(b" ab", q)
    assert got[vocab.pieces.index(b" ab")] == pytest.approx(2 * q[b" ab"] / whole)
    assert got[vocab.pieces.index(b" a")] == pytest.approx(2 * q[b" a"] * q[b"b"] / whole)


def test_pieces_are_found_by_hash():
    vocab = L.Pieces(L.vocabulary(MODEL))
    assert (vocab.find(vocab.keys) == np.arange(len(vocab.keys))).all()
    assert (vocab.find(np.arange(1, 50, dtype=np.uint64)) == -1).all()


def test_languages_of_odd_rows(spark, odd_docs):
    train = spark.createDataFrame([("the house and the garden", "en"), ("das haus und der garten", "de"), (None, "de"), ("x", None)], "text string, lang string")
    fitted = L.learn(train, MODEL)
    assert fitted[0] == ["de", "en"]
    got = L.identify(odd_docs, fitted).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (r.doc_id in (5, 6, 7, 11))
    two = spark.createDataFrame([(1, "The garden, and the house"), (2, "der garten und das haus")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in L.identify(two, fitted).collect()} == {1: "en", 2: "de"}
    nothing = L.learn(train.limit(0), MODEL)
    assert {r.lang_pred for r in L.identify(odd_docs, nothing).collect()} == {"und"}
    assert L.identify(two.limit(0), fitted).count() == 0


def test_held_out_languages(spark, folder):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op9_language_id"](spark, folder).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and sum(docs[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)


# -- toxicity --------------------------------------------------------------


def test_gram_codes_tell_letters_and_gaps():
    a, b = T.gram_codes(b"Bad word"), T.gram_codes("bad, word!".encode())
    assert len(a) == len("bad word ") and (a == b).all() and not len(T.gram_codes(b"12 !"))


def test_table_finds_all_codes():
    codes = np.unique(np.random.default_rng(2).integers(0, 1 << 60, 5000))
    values, hit = T.Table(codes, np.arange(len(codes)) + 1.0).find(np.concatenate([codes, codes[:100] + 1]))
    assert (values[: len(codes)] == np.arange(len(codes)) + 1).all() and hit[: len(codes)].all()
    assert not hit[len(codes) :].any() and not values[len(codes) :].any()
    assert not T.Table(codes[:0], codes[:0].astype(float)).find(codes)[1].any()


def test_toxic_words_are_learnt(spark, odd_docs):
    rng = random.Random(4)
    plain = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(900):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 80))]
        if i % 8 == 0:
            words[rng.randrange(len(words))] = rng.choice(["jerkface", "dimwit"])
            words[rng.randrange(len(words))] = "jerkface"
        rows.append((i, " ".join(words), int(i % 8 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = T.toxicity(df.drop("toxic"), df.where("doc_id % 3 <> 0").select("doc_id", "toxic")).toPandas()
    held = got[got.doc_id % 3 == 0].set_index("doc_id")
    truth = held.index % 8 == 0
    assert ((held.predicted == 1) == truth).mean() > 0.97 and held.score.between(0, 1).all()
    out = T.toxicity(odd_docs, spark.createDataFrame([(1, 1), (4, 0), (10, 0), (None, 1), (8, None)], "doc_id long, toxic int")).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 for r in out)
    assert T.toxicity(odd_docs.limit(0), df.select("doc_id", "toxic")).count() == 0


def marked(spark, n=300):
    rng = random.Random(9)
    plain = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(200)]
    rows = [(i, " ".join([*rng.choices(plain, k=30), *(["jerkface", "dimwit"] if i % 5 == 0 else [])]), int(i % 5 == 0)) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, 0), (n + 1, "12 !", 0)], "doc_id long, text string, toxic int")


def test_distributed_ratios_score_alike(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE_CHARS", 9000)
    df = marked(spark)
    one, many = (T.toxicity(df, df.select("doc_id", "toxic"), listed=k).toPandas().set_index("doc_id").sort_index() for k in (T.LISTED, 0))
    assert one.predicted.sum() >= 50 and len(many) == 302
    assert (many.predicted == one.predicted).all() and many.score.to_numpy() == pytest.approx(one.score.to_numpy(), abs=1e-9)


def test_rows_not_held_back_are_learnt_from(spark, monkeypatch):
    df, seen, fit = marked(spark), [], T.fit
    monkeypatch.setattr(T, "fit", lambda train, *a: seen.append(train.count()) or fit(train, *a))
    assert T.toxicity(df, df.select("doc_id", "toxic"), calibration_rows=10).count() == 302
    assert seen == [292]


# -- quality and mixing ----------------------------------------------------


def labelled(spark, n=600):
    rng = random.Random(5)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(20, 90))]
        good = i % 6 != 0
        rows.append((i, " ".join(words if good else [w + "$$$" for w in words]), f"h{i % 3}" if i else None, "p", int(good)))
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, quality int")


def test_quality_of_held_out_rows(spark):
    df = labelled(spark)
    got = C.classify(df.drop("quality"), df.where("doc_id % 2 = 0").select("doc_id", "quality")).toPandas()
    assert (got.kept == (got.doc_id % 6 != 0)).mean() > 0.98 and len(got) == 600


def test_sites_shrink_to_their_priors(spark):
    df = labelled(spark)
    big = df.where("source = 'h1'")
    lone = big.limit(1).selectExpr("9999L AS doc_id", "text", "'lone' AS source", "lang", "quality")
    fitted = C.fit(df.drop("quality").unionByName(lone.drop("quality")), df.select("doc_id", "quality"), "doc_id", "text", "source", "lang", "quality")
    rates = {r._host: r for r in fitted.sites.collect()}
    raw = {h: df.where(f"source = '{h}'").agg({"quality": "avg"}).first()[0] for h in ("h0", "h1", "h2")}
    assert rates["h0"].host_rate < rates["h2"].host_rate and raw["h0"] < raw["h2"]
    assert 0.5 < rates["lone"].host_rate < 1


def test_quality_of_odd_rows(spark, odd_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = C.classify(odd_docs, none).collect()
    assert len(got) == odd_docs.count() and all(r.kept and r.score == pytest.approx(0.5) for r in got)
    some = spark.createDataFrame([(1, 1), (1, 0), (4, 1), (13, 0), (None, 1), (8, None)], "doc_id long, quality int")
    out = C.classify(odd_docs, some)
    assert out.count() == odd_docs.count() and "extra" in out.columns
    assert C.classify(odd_docs.limit(0), some).count() == 0


def mixed_rows(spark, n=400):
    rng = np.random.default_rng(6)
    p = rng.dirichlet([0.3, 0.3, 0.3], n)
    t = rng.integers(10, 500, n)
    rows = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(t, p, strict=True)], "_t long, _p array<double>")
    return rows, t, p


def plain_solver(t, p, goal, steps=20_000):
    """Brute force: least squares over rates of 0 or more by plain gradient steps in the rates."""
    moves = p * t[:, None]
    y, size = np.full(len(t), goal.sum() / t.sum()), 1 / np.linalg.norm(moves, 2) ** 2
    for _ in range(steps):
        y = np.maximum(0, y + size * (moves @ (goal - y @ moves)))
    return y @ moves


@pytest.mark.parametrize("share", [[0.6, 0.1, 0.3], [0.05, 0.05, 0.9]])
def test_rates_meet_the_targets(spark, share):
    rows, t, p = mixed_rows(spark)
    rates = M.fit_rates(rows, ["a", "b", "c"], dict(zip("abc", share, strict=True)))
    x = np.array([r.x for r in rows.select(rates.column().alias("x")).collect()])
    goal = np.array(share) * t.sum()
    assert (x >= 0).all()
    best = plain_solver(t, p, goal)
    assert ((x * t) @ p) / t.sum() == pytest.approx(best / t.sum(), abs=1e-3)
    miss = np.abs(goal - (x * t) @ p).max() / goal.sum()
    assert rates.residual == pytest.approx(miss, abs=1e-9)
    assert rates.met


def test_targets_out_of_reach_are_told(spark):
    rows = spark.createDataFrame([(10, [0.5, 0.5]), (30, [0.5, 0.5])], "_t long, _p array<double>")
    with pytest.warns(UserWarning, match="misses its targets"):
        rates = M.fit_rates(rows, ["a", "b"], {"a": 0.9, "b": 0.1})
    assert not rates.met and rates.residual == pytest.approx(0.4)


def test_rates_beside_a_whole_domain(spark):
    rows, t, p = mixed_rows(spark)
    rates = M.fit_rates(rows, ["a", "b", "c"], {"a": 0.6, "b": 0.1, "c": 0.3}, whole="a")
    x = np.array([r.x for r in rows.select(rates.column().alias("x")).collect()])
    got = (x * t) @ p
    assert rates.met and (x >= 0).all() and (x <= 1).all()
    assert got / got.sum() == pytest.approx([0.6, 0.1, 0.3], abs=1e-4)
    assert (x[p[:, 0] > 0.9] > 0.9).all()
    # Domains below their targets are left as they are.
    scarce = M.fit_rates(rows, ["a", "b", "c"], {"a": 0.1, "b": 0.45, "c": 0.45}, whole="a")
    assert scarce.met and not scarce.steps and scarce.start == 1.0


def test_mixing_of_odd_rows(spark, odd_docs):
    known = spark.createDataFrame([(1, "a"), (4, "b"), (10, "a"), (None, "a"), (8, None)], "doc_id long, domain string")
    out = M.mix(odd_docs, known, {"a": 0.5, "b": 0.5})
    rows = out.collect()
    assert len(rows) == odd_docs.count() and "extra" in out.columns
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 and sum(r.posteriors.values()) == pytest.approx(1) for r in rows)
    assert {r.copies for r in M.mix(odd_docs, known.limit(0), {"a": 1.0}).collect()} == {1}
    assert M.mix(odd_docs.limit(0), known, {"a": 1.0}).count() == 0
    assert M.mix_rows(odd_docs, known, {"a": 0.9, "b": 0.1}, whole="a").columns == odd_docs.columns
    assert M.mix_rows(odd_docs, known, {"b": 1.0}, whole="a").count() == odd_docs.count()


def test_mixed_totals_on_the_table(spark, folder):
    rows = QUERIES["op7_mixing"](spark, folder).toPandas()
    whole = rows.tokens.sum()
    for d, share in M.TARGETS.items():
        got = sum(t * r * p[d] for t, r, p in zip(rows.tokens, rows.rate, rows.posteriors, strict=True)) / whole
        assert got == pytest.approx(share, abs=1e-4)
