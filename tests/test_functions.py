"""Column functions on literal cases with answers worked out by hand."""

import pytest
from pyspark.sql import functions as F

from pulse.functions import fixed as X
from pulse.functions import text as T
from pulse.functions import times as TM
from pulse.functions import values as V
from pulse.operators.features import char_grams


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "c string").select(fn("c").alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        (" <b>Hi</b> &amp; you ", "Hi you"),
        ("a\t\tb", "a b"),
        ("nan", None),
        ("None", None),
        ("<br>", None),
        (None, None),
    ],
)
def test_clean_post(spark, raw, want):
    assert one(spark, raw, T.clean_post) == want


def test_mojibake_is_opt_in(spark):
    assert one(spark, "cafÃ© x", T.clean_post) == "cafÃ© x"
    assert one(spark, "cafÃ© x", lambda c: T.clean_post(c, fix_mojibake=True)) == "caf x"


@pytest.mark.parametrize(
    "raw, want",
    [
        ("See https://x.y/z @bob #Big_Deal! 😀 Café", "see big_deal café"),
        ("www.site.org only", "only"),
        ("@a @b", ""),
        (None, ""),
    ],
)
def test_clean_nlp(spark, raw, want):
    assert one(spark, raw, T.clean_nlp) == want


def test_clean_variant_switches(spark):
    raw = "Go #Win! @me http://a.b"
    assert one(spark, raw, T.clean_variant) == "go win url"
    assert one(spark, raw, lambda c: T.clean_variant(c, remove_punct=False, split_hashtags=False)) == "go #win ! url"
    assert one(spark, raw, lambda c: T.clean_variant(c, strip_mentions=False)) == "go win me url"


def test_white_space_and_words_are_those_of_the_fixed_classes(spark):
    codes = [*range(1, 0x3100), 0xFEFF, 0xFF10, 0x1D7D8, 0x1F600, 0x10FFFF]
    texts = [(f"{x}{x} a{x}b {x} c{x}{x}d{x} ",) for x in map(chr, codes)]
    df = spark.createDataFrame([*texts, ("",), (" ",), ("a b",), (None,)], "c string")

    def plain(c):
        return F.regexp_replace(F.regexp_replace(c, rf"{X.SPACE}+", " "), rf"^{X.SPACE}+|{X.SPACE}+$", "")

    got = df.select(T.squeeze("c").alias("a"), plain("c").alias("b"), T.clean_variant("c").alias("x"),
                    plain(F.regexp_replace(F.lower(F.coalesce("c", F.lit(""))), X.PUNCTUATION, " ")).alias("y"),
                    T.tokens("c", 2).alias("s"), F.regexp_extract_all(F.lower("c"), F.lit(f"({X.WORD}{{2,}})"), 1).alias("t"))
    assert got.where("NOT a <=> b OR NOT s <=> t").count() == 0
    # "#" and "@" before a letter have rules of their own.
    assert got.where("NOT x <=> y").count() <= 2


def test_cleaning_reads_a_text_once_for_words_and_spaces(spark):
    steps = str(T.clean_variant(F.col("c"))).count("regexp_replace")
    whole = str(F.regexp_replace(F.col("c"), "a", "b")).count("regexp_replace")
    assert steps == 5 * whole


def test_word_pairs_and_accents_of_odd_rows(spark):
    df = spark.createDataFrame([("abc",), ("é",), ("aÉ ç b",), ("",), (None,), ("日本 é",)], "c string")
    assert [r[0] for r in df.select(T.strip_accents("c")).collect()] == ["abc", "e", "aE c b", "", None, "日本 e"]
    toks = df.select(F.array(F.lit("a"), F.lit("b"), F.lit("a")).alias("t")).limit(1)
    none = F.lit(None).cast("array<string>")
    got = toks.select(T.word_grams("t", 1, 3), T.word_grams(F.slice("t", 1, 1), 2, 2), T.word_grams(F.slice("t", 1, 0), 2, 2), T.word_grams(none, 2, 2)).first()
    assert list(got) == [["a", "b", "a", "a b", "b a", "a b a"], [], [], []]


def test_social_and_review(spark):
    assert one(spark, "né @x #tag http://q w", T.clean_social) == "n tag w"
    assert one(spark, "né  http://q w", T.clean_review) == "n w"


@pytest.mark.parametrize("raw, want", [("", 0), ("   ", 0), ("a  b c", 3), (None, 0)])
def test_word_count(spark, raw, want):
    assert one(spark, raw, T.word_count) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("not good at all, fine", "not NEGATED_good NEGATED_at all, fine"),
        ("I never said no more", "I never NEGATED_said no NEGATED_more"),
        ("plain words. here", "plain words. here"),
        ("not, good", "not, good"),
        ("DONT go! stay not here", "DONT go! stay not NEGATED_here"),
        ("", ""),
    ],
)
def test_negation_scope(spark, raw, want):
    assert one(spark, raw, T.negation_scope) == want


def test_linguistic_tags(spark):
    assert one(spark, "No, but maybe?", T.linguistic_tags) == [
        "Explicit Negation",
        "Modality/Hypothetical",
        "Contrast/Shift",
        "Punctuation Intensive (Possible Sarcasm/Emotion)",
    ]
    assert one(spark, "fine", T.linguistic_tags) == ["No Distinct Linguistic Pattern"]


def test_error_category(spark):
    rows = [
        ("Negative", "Positive", "one two three four"),
        ("Negative", "Positive", "this was not what we paid for"),
        ("Negative", "Positive", "great job breaking my phone again"),
        ("Neutral", "Odd", "five words are in here"),
    ]
    df = spark.createDataFrame(rows, "t string, p string, x string")
    got = [r[0] for r in df.select(T.error_category("t", "p", "x")).collect()]
    assert got == [
        "Extremely short text", "Negation handling failure", "Missed negation / sarcasm", "Other / Label noise",
    ]


@pytest.mark.parametrize("raw, want", [("new york-city o'neil", "New York-City O'Neil"), ("ABC", "Abc"), ("", "")])
def test_title_case(spark, raw, want):
    assert one(spark, raw, T.title_case) == want


def test_casing_by_name(spark):
    assert one(spark, " pARIS ", lambda c: T.casing(c, "home_city")) == "Paris"
    assert one(spark, " pARIS ", lambda c: T.casing(c, "code")) == "paris"


def test_grams(spark):
    assert one(spark, "a bb cc dd", lambda c: T.word_grams(T.tokens(c, 2), 1, 2)) == ["bb", "cc", "dd", "bb cc", "cc dd"]
    assert one(spark, "bb", lambda c: T.word_grams(T.tokens(c), 2, 3)) == []


def test_char_grams(spark):
    got = one(spark, "ab c", lambda c: char_grams(F.col(c)))
    assert sorted(got) == sorted([" ab", "ab ", " ab ", " c "])


@pytest.mark.parametrize(
    "raw, want",
    [
        ("2024-03-05T01:02:03", "2024-03-05 01:02:03"),
        ("05-03-2024", "2024-03-05 00:00:00"),
        ("1709600523", "2024-03-05 01:02:03"),
        ("32-13-2024", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_mixed_timestamps(spark, raw, want):
    got = one(spark, raw, lambda c: F.date_format(TM.parse_mixed_ts(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("2024-03-05", "2024-03-05"),
        ("03/05/2024", "2024-03-05"),
        ("25/12/2024", "2024-12-25"),
        ("5 March 2024", "2024-03-05"),
        ("March 5, 2024", "2024-03-05"),
        ("2024/03/05", "2024-03-05"),
        ("tomorrow", None),
    ],
)
def test_parse_date(spark, raw, want):
    assert one(spark, raw, TM.parse_date) == want


@pytest.mark.parametrize("raw, want", [("$1,234.5", 1234.5), ("7 %", 7.0), ("nan", None), ("x", None), (None, None)])
def test_coerce_numeric(spark, raw, want):
    assert one(spark, raw, V.coerce_numeric) == want


def test_sentiment_number_and_softmax(spark):
    assert one(spark, "Positive", V.sentiment_number) == 1.0
    assert one(spark, "Odd", V.sentiment_number) == 0.5
    assert one(spark, None, V.sentiment_number) == 0.5
    p = spark.sql("select array(1000D, 1000D) m").select(V.softmax("m").alias("p")).first()["p"]
    assert p == [0.5, 0.5]


@pytest.mark.parametrize("x, want", [(0.0, 0), (9.99, 0), (10.0, 1), (100.0, 9), (100.1, None), (-0.1, None)])
def test_bins_close_at_the_top(spark, x, want):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(V.bin_index(F.col("x"), 0, 100, 10).alias("b")).first()["b"] == want
