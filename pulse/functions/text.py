"""Text functions, ``Column -> Column``.

Every pattern names its character classes explicitly, so that a
Unicode word or space means the same thing in any regex engine.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.functions import fixed as X


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Trim any Unicode white space from both ends."""
    return F.regexp_replace(_col(c), rf"^{X.SPACE}+|{X.SPACE}+$", "")


# What the patterns of ``fixed`` match, written for Java: what may begin a
# match is looked at first, letters before classes, and a single plain space,
# which would be replaced by itself, is left out.
_SPACES = rf"[\t-\r\x1C-\x1F\x{{85}}\p{{Z}}&&[^ ]]{X.SPACE}*| {X.SPACE}+"
_LOW_WORD = r"[a-z_0-9\p{L}\p{N}]"
_NO_WORD = r"[^a-z _0-9\p{L}\p{N}][^a-z_0-9\p{L}\p{N}]*| [^a-z_0-9\p{L}\p{N}]+"
_MARKUP = rf"(?=[<&])(?:{X.MARKUP})"
_URL = rf"(?=[hw])(?:{X.URL})"


def squeeze(c) -> Column:
    """One space for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), _SPACES, " "))


def _only_words(c) -> Column:
    """As :func:`squeeze`, with punctuation as white space."""
    return F.trim(F.regexp_replace(_col(c), _NO_WORD, " "))


def clean_post(c, fix_mojibake: bool = False) -> Column:
    """Post text without tags and entities; NULL when nothing is left."""
    out = F.regexp_replace(_col(c), r"<[^>]+>", " ")
    out = F.regexp_replace(out, r"&amp;|&lt;|&gt;|&quot;", " ")
    if fix_mojibake:
        out = F.regexp_replace(out, X.MOJIBAKE, "")
    out = strip(F.regexp_replace(out, rf"{X.SPACE}{{2,}}", " "))
    return F.when(~out.isin("nan", "None", ""), out)


def clean_nlp(c) -> Column:
    """Classifier input: no markup, links, mentions, emoji or punctuation."""
    out = F.coalesce(_col(c), F.lit(""))
    out = F.regexp_replace(out, _MARKUP, " ")
    out = F.regexp_replace(out, _URL, " ")
    out = F.regexp_replace(out, X.MENTION, " ")
    out = F.regexp_replace(out, X.HASHTAG, " $1 ")
    out = F.regexp_replace(out, X.EMOJI, " ")
    return _only_words(F.lower(out))


def clean_variant(
    c,
    remove_punct: bool = True,
    split_hashtags: bool = True,
    strip_mentions: bool = True,
) -> Column:
    """Classifier input with switches; a link becomes the token ``url``."""
    out = F.coalesce(_col(c), F.lit(""))
    out = F.regexp_replace(out, _MARKUP, " ")
    out = F.regexp_replace(out, _URL, " URL ")
    if strip_mentions:
        out = F.regexp_replace(out, X.MENTION, " ")
    out = F.regexp_replace(out, X.HASHTAG, " $1 " if split_hashtags else " #$1 ")
    out = F.lower(out)
    return _only_words(out) if remove_punct else squeeze(out)


def clean_social(c) -> Column:
    """Social record text: links and mentions dropped, ASCII only."""
    out = F.coalesce(_col(c), F.lit(""))
    out = F.regexp_replace(out, rf"http{X.NON_SPACE}+", "")
    out = F.regexp_replace(out, X.MENTION, "")
    out = F.regexp_replace(out, X.HASHTAG, "$1")
    return squeeze(F.regexp_replace(out, X.NON_ASCII, " "))


def clean_review(c) -> Column:
    """Store review text: links dropped, ASCII only."""
    out = F.regexp_replace(_col(c), rf"http{X.NON_SPACE}+", "")
    return squeeze(F.regexp_replace(out, X.NON_ASCII, " "))


def words(c) -> Column:
    """White-space separated words; an empty array for blank text."""
    trimmed = squeeze(F.coalesce(_col(c), F.lit("")))
    return F.filter(F.split(trimmed, " "), lambda w: w != "")


def word_count(c) -> Column:
    return F.size(words(c))


def char_count(c) -> Column:
    return F.length(_col(c))


def tokens(c, min_chars: int = 1) -> Column:
    """Lower-case word tokens of at least ``min_chars`` characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(rf"{_LOW_WORD}{{{max(min_chars, 1)},}}+"), 0)


def word_grams(tokens_col, lo: int, hi: int) -> Column:
    """All runs of ``lo..hi`` neighbouring tokens, joined by a space."""
    toks = _col(tokens_col)

    def run(n: int) -> Column:
        if n == 1:
            return toks
        if n == 2:
            heads = F.slice(toks, 1, F.greatest(F.size(toks) - 1, F.lit(0)))
            pairs = F.transform(heads, lambda t, i: F.concat(t, F.lit(" "), F.get(toks, i + 1)))
            return F.coalesce(pairs, F.array().cast("array<string>"))
        starts = F.when(F.size(toks) >= n, F.sequence(F.lit(1), F.size(toks) - n + 1))
        grams = F.transform(starts, lambda i: F.array_join(F.slice(toks, i, n), " "))
        return F.coalesce(grams, F.array().cast("array<string>"))

    return F.concat(*[run(n) for n in range(lo, hi + 1)])


def hashtags(c) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(r"#([A-Za-z0-9_]+)"), 1)


def snippet(c, n: int = 90) -> Column:
    """The first ``n`` characters, with an ellipsis when text was cut."""
    col = _col(c)
    return F.when(F.length(col) > n, F.concat(F.substring(col, 1, n), F.lit("..."))).otherwise(col)


def title_case(c) -> Column:
    """Capital after every non-letter, so ``o'neil`` becomes ``O'Neil``."""
    runs = F.regexp_extract_all(F.lower(_col(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)

    def titled(r: Column) -> Column:
        first = F.upper(F.substring(r, 1, 1))  # one letter may become two, as ß does
        rest = r.substr(F.lit(2), F.length(r))
        return F.concat(F.substring(first, 1, 1), F.lower(first.substr(F.lit(2), F.lit(2))), rest)

    return F.array_join(F.transform(runs, titled), "")


def casing(c, name: str) -> Column:
    """Title case for name-like columns, lower case for the rest."""
    trimmed = strip(c)
    if any(k in name.lower() for k in X.TITLE_KEYWORDS):
        return title_case(trimmed)
    return F.lower(trimmed)


def contains_any(c, terms: list[str]) -> Column:
    """Case-insensitive test for any of the literal terms."""
    low = F.lower(_col(c))
    hit = F.lit(False)
    for t in terms:
        hit = hit | low.contains(t.lower())
    return hit


def negation_scope(c, cues: list[str] = X.NEGATION_CUES) -> Column:
    """Prefix ``NEGATED_`` to words between a cue and the next stop mark.

    The text is cut after every word with a stop mark. Inside a piece the
    scope opens at its first cue, so the work is linear in the text.
    """
    cue_set = F.array(*[F.lit(w) for w in cues])
    cut = F.regexp_replace(F.array_join(words(c), " "), rf"([^ ]*{X.SCOPE_END}[^ ]*)(?: |$)", "$1\u0001")
    pieces = F.filter(F.split(cut, "\u0001"), lambda p: p != "")
    opened = F.transform(
        F.transform(pieces, lambda p: F.split(p, " ")),
        lambda ws: F.struct(
            ws.alias("ws"),
            F.array_position(
                F.transform(ws, lambda w: F.array_contains(cue_set, F.lower(w))), F.lit(True)
            ).alias("first"),
        ),
    )
    tagged = F.transform(
        opened,
        lambda s: F.transform(
            s["ws"],
            lambda w, i: F.when(
                (s["first"] > 0)
                & (i >= s["first"])
                & ~F.array_contains(cue_set, F.lower(w))
                & ~F.rlike(w, F.lit(X.SCOPE_END)),
                F.concat(F.lit("NEGATED_"), w),
            ).otherwise(w),
        ),
    )
    return F.array_join(F.flatten(tagged), " ")


def linguistic_tags(c) -> Column:
    """Names of the linguistic patterns found in a text, as an array."""
    col = F.coalesce(_col(c), F.lit(""))
    toks = tokens(col)

    def overlap(ws: list[str]) -> Column:
        return F.arrays_overlap(toks, F.array(*[F.lit(w) for w in ws]))

    found = F.array_compact(
        F.array(
            F.when(overlap(X.NEGATION_WORDS), F.lit(X.TAG_NAMES["negation"])),
            F.when(overlap(X.MODALITY_WORDS), F.lit(X.TAG_NAMES["modality"])),
            F.when(overlap(X.CONTRAST_WORDS), F.lit(X.TAG_NAMES["contrast"])),
            F.when(
                col.contains("?") | col.contains("!") | col.contains("..."),
                F.lit(X.TAG_NAMES["punctuation"]),
            ),
        )
    )
    return F.when(F.size(found) == 0, F.array(F.lit(X.TAG_NAMES["none"]))).otherwise(found)


def error_category(true, pred, text) -> Column:
    """Why a prediction may have failed: length, negation, then label pair."""
    pairs = F.create_map(
        *[F.lit(v) for (t, p), name in X.ERROR_NAMES.items() for v in (f"{t}>{p}", name)]
    )
    by_pair = F.coalesce(
        F.try_element_at(pairs, F.concat(_col(true), F.lit(">"), _col(pred))), F.lit(X.ERROR_OTHER)
    )
    return (
        F.when(word_count(text) <= X.SHORT_TEXT_WORDS, F.lit(X.ERROR_SHORT))
        .when(contains_any(text, X.NEGATION_MARKS), F.lit(X.ERROR_NEGATION))
        .otherwise(by_pair)
    )


def accent_table() -> tuple[str, str]:
    """Accented Latin letters and their base letters, position by position.

    Rule: a letter of the Latin blocks whose compatibility decomposition is
    one base letter followed by combining marks.
    """
    src, dst = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        base, *marks = unicodedata.normalize("NFKD", chr(code))
        if marks and all(unicodedata.combining(m) for m in marks):
            src.append(chr(code))
            dst.append(base)
    return "".join(src), "".join(dst)


def strip_accents(c) -> Column:
    """Fold accented Latin letters to their base letter; a text of one byte a
    letter has none and is left as it is."""
    src, dst = accent_table()
    plain = F.octet_length(_col(c)) == F.length(_col(c))
    return F.when(plain, _col(c)).otherwise(F.translate(_col(c), src, dst))


def corpus_hash(df: DataFrame, c: str) -> DataFrame:
    """One row that tells two corpora apart; independent of row order."""
    piece = F.conv(F.substring(F.md5(F.coalesce(F.col(c), F.lit(""))), 1, 8), 16, 10)
    return df.agg(
        F.count(F.lit(1)).alias("n_texts"),
        F.sum(piece.cast("decimal(20,0)")).cast("string").alias("text_hash"),
    )
