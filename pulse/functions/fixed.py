"""Word lists, patterns, formats and thresholds.

Results depend on these exact values; they are data, not logic.
"""

# -- fixed values: strings that stand for "no value" (lower case, matched as written)
PLACEHOLDERS = [
    "", "n/a", "na", "n.a.", "none", "null", "nan", "?", "-", "–",
    "unknown", "missing", "not available", "tbd", "#n/a", "nil",
]

# -- fixed values: known platforms
PLATFORMS = ["YouTube", "Facebook", "Twitter", "Reddit", "Instagram"]

# -- fixed values: sentiment labels and their numeric scale
LABELS = ["Negative", "Neutral", "Positive"]
SENTIMENT_SCALE = {"Negative": 0.0, "Neutral": 0.5, "Positive": 1.0}
UNKNOWN_SENTIMENT = 0.5

# -- fixed values: engagement score weights
LIKES_WEIGHT, SHARES_WEIGHT, COMMENTS_WEIGHT = 0.5, 0.3, 0.2

# -- fixed values: detection thresholds
SPIKE_Z = 2.0
SHIFT_Z = 1.5
STD_GUARD = 1e-9
DAILY_WINDOW, HOURLY_WINDOW = 7, 24
MODE_MIN_SHARE = 0.30
NUMERIC_MIN_SHARE = 0.70

# -- fixed values: date patterns, tried in this order (month first when ambiguous)
DATE_FORMATS = [
    "yyyy-M-d", "M/d/yyyy", "M-d-yyyy", "d/M/yyyy", "d-M-yyyy",
    "d MMMM yyyy", "MMMM d, yyyy", "yyyy/M/d",
]

# -- fixed values: column-name keywords that decide a column's role or casing
DATE_KEYWORDS = ["date", "time", "dob", "year", "month", "day"]
NUMERIC_KEYWORDS = ["age", "salary", "income", "amount", "price", "score", "count", "num", "qty"]
TITLE_KEYWORDS = ["name", "city", "country", "region", "title"]

# -- fixed values: source names folded together
SOURCE_NAMES = {
    "whatsapp_playstore": "whatsapp",
    "kaggle_whatsapp": "whatsapp",
    "kaggle_telegram": "telegram",
}

# -- fixed values: unified social record
REQUIRED_COLUMNS = ["post_id", "source", "text", "timestamp", "engagement_metric"]
BONUS_COLUMNS = [
    "post_id", "source", "source_type", "source_name",
    "text", "timestamp", "engagement_metric", "lang",
]

# -- fixed values: review files, candidate column names in order of preference
TEXT_COLUMNS = ["content", "review", "text", "body", "comment", "Review"]
DATE_COLUMNS = ["at", "date", "created_at", "timestamp", "Time", "Date"]
SCORE_COLUMNS = ["score", "rating", "star", "stars", "Rating"]

# -- fixed values: cues that open a negation scope, and the marks that close it
NEGATION_CUES = [
    "not", "no", "never", "neither", "nor", "nobody", "nothing",
    "nowhere", "hardly", "barely", "scarcely", "n't", "nt",
    "without", "cannot", "cant", "wont", "dont", "doesnt",
    "didnt", "isnt", "wasnt", "shouldnt", "wouldnt", "couldnt",
]
SCOPE_END = "[.!?,;:]"

# -- fixed values: linguistic tag word lists
NEGATION_WORDS = [
    "not", "no", "never", "none", "nobody", "nowhere", "neither", "barely",
    "hardly", "scarcely", "without", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "won't", "wouldn't", "don't", "doesn't",
    "didn't", "can't", "couldn't", "shouldn't", "mightn't", "mustn't",
]
MODALITY_WORDS = [
    "would", "could", "should", "might", "may", "if", "wish", "hope",
    "wonder", "perhaps", "maybe", "probably",
]
CONTRAST_WORDS = [
    "but", "however", "although", "though", "even though", "despite",
    "in spite of", "yet", "still",
]
TAG_NAMES = {
    "negation": "Explicit Negation",
    "modality": "Modality/Hypothetical",
    "contrast": "Contrast/Shift",
    "punctuation": "Punctuation Intensive (Possible Sarcasm/Emotion)",
    "none": "No Distinct Linguistic Pattern",
}

# -- fixed values: error categories
SHORT_TEXT_WORDS = 4
NEGATION_MARKS = ["not", "no ", "never", "n't", "isn't", "wasn't", "won't", "can't"]
ERROR_NAMES = {
    ("Negative", "Positive"): "Missed negation / sarcasm",
    ("Positive", "Negative"): "Overly negative framing detected",
    ("Neutral", "Positive"): "Weak positive signal misread as Neutral",
    ("Neutral", "Negative"): "Weak negative signal misread as Neutral",
    ("Positive", "Neutral"): "Ambiguous boundary (Positive ≈ Neutral)",
    ("Negative", "Neutral"): "Ambiguous boundary (Negative ≈ Neutral)",
}
ERROR_SHORT = "Extremely short text"
ERROR_NEGATION = "Negation handling failure"
ERROR_OTHER = "Other / Label noise"

# -- fixed values: anomaly names
ANOMALY_NEGATIVE = "Negative Likes (Imputation Artifact)"
ANOMALY_PLATFORM = "Missing Platform"
ANOMALY_MARKUP = "HTML/Entity Corruption"
ANOMALY_OTHER = "Other"

# -- fixed values: aspect terms, term stop list and entity types
ASPECT_TERMS = [
    "privacy", "metadata", "facebook", "policy", "terms",
    "switch", "security", "signal", "telegram",
]
TERM_STOPLIST = [
    "whatsapp", "privacy", "policy", "app", "use", "using", "used",
    "like", "just", "one", "would", "also", "new", "even", "know",
    "people", "time", "thing", "way", "get", "got", "much", "many",
]
ENTITY_TYPES = ["ORG", "PERSON", "GPE", "PRODUCT", "LAW", "NORP", "EVENT"]

# -- fixed values: character classes that mean the same to Java and RE2
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
NON_SPACE = r"[^\s\x0B\x1C-\x1F\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
MARKUP = r"<[^>]+>|&amp;|&lt;|&gt;|&nbsp;|&quot;"
URL = rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+"
MENTION = rf"@{WORD}+"
HASHTAG = rf"#({WORD}+)"
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}"
    r"\x{1F1E0}-\x{1F1FF}\x{2600}-\x{26FF}\x{2700}-\x{27BF}]+"
)
PUNCTUATION = r"[^\p{L}\p{N}_\s\x0B\x1C-\x1F\x{85}\p{Z}]"
NON_ASCII = r"[^\x00-\x7F]+"
MOJIBAKE = r"Ã©|Ã\x{A0}|Ã¨"

# -- fixed values: phases (name, start, end, end is inside)
PHASES = [
    ("T-0 (Baseline: Nov-Dec 2020)", "2020-11-01", "2021-01-01", False),
    ("T+1 (Shock Phase: Jan 2021)", "2021-01-01", "2021-02-01", False),
    ("T+2 (Fallout Phase: Feb-Jul 2021)", "2021-02-01", "2021-07-31", True),
]

# -- fixed values: evaluation protocol (split seeds, training shares, randomised search)
SEEDS = [0, 7, 13, 21, 42, 99, 123, 256, 314, 999]
TRAINING_SHARES = [0.1, 0.325, 0.55, 0.775, 1.0]
SEARCH_RANGE = (0.01, 10.0)
SEARCH_DRAWS = 40

# -- fixed values: cleaning ablation (label: cleaning switches and word-gram sizes; regularisation)
ABLATIONS = {
    "A: Champion pipeline (remove punct, split hashtags, strip mentions)": ({}, (1, 1)),
    "B: Keep punctuation": ({"remove_punct": False}, (1, 1)),
    "C: Keep hashtag symbol + keep punct (no split, # survives)": ({"remove_punct": False, "split_hashtags": False}, (1, 1)),
    "D: Retain mention token (@user)": ({"strip_mentions": False}, (1, 1)),
    "E: Bigrams only (ngram=(2,2)) — same text as A, model variant": ({}, (2, 2)),
}
ABLATION_C = 0.133
