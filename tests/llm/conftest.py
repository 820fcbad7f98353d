import pytest

WORDS = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]


def prose(start: int, n: int, step: int = 7) -> str:
    return " ".join(WORDS[(start + k * step + k * k) % 300] for k in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents of every awkward kind, with columns whose names clash."""
    base = prose(1, 120)
    near = base.replace(WORDS[1], "other", 1)
    rows = [
        (1, base, "en", "a", "x"),
        (2, near, "en", "a", "x"),
        (3, base.upper(), "en", "b", "x"),
        (4, prose(5, 80, 11), "de", "b", "x"),
        (5, None, None, None, None),
        (6, "", "en", "a", "x"),
        (7, " \n\t ", "en", "a", "x"),
        (8, "two words", "en", "a", "x"),
        (9, "two words", "en", "a", "x"),
        (9, "two words", "en", "a", "x"),
        (10, prose(3, 30_000, 13), "fr", "a", "x"),
        (11, "1234 5678 !!", "fr", "a", "x"),
        (None, "a text without an id", "en", None, "x"),
        (12, "x" * 70_000, "en", "a", "x"),
        (13, "line one\nline one\n\n" + "again and " * 40, "en", "a", "x"),
    ]
    names = "doc_id long, text string, lang string, source string"
    clash = ["size", "score", "kept", "rule", "id", "n", "grams", "k1", "rate", "u", "v", "code", "_f", "_h"]
    df = spark.createDataFrame(rows, names + ", extra string").coalesce(2)
    for c in clash:
        df = df.selectExpr("*", f"'clash' AS {c}")
    return df
