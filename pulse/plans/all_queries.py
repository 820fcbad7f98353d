"""Imports every query module so that the registry is complete."""

from pulse.plans import (  # noqa: F401
    cleaning_queries,
    engagement_queries,
    evaluation_queries,
    model_queries,
    series_queries,
    source_queries,
)
from pulse.plans.registry import ORACLES, QUERIES  # noqa: F401
