"""Imports every query module so that the registry is complete."""

from pulse.llm import decontamination, language_id, mixing, near_dedup, quality_classifier, quality_rules, ranked_search, secret_scan, sharding, token_alignment, token_grammar, toxicity, url_filter  # noqa: F401
from pulse.llm.registry import ORACLES, QUERIES  # noqa: F401
