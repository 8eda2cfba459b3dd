"""Operators for training-data pipelines. Nothing else in the library imports this package."""

from . import (  # noqa: F401
    compression_licenses,
    context_mixing,
    conversation_repair,
    exact_topk,
    jaccard_join,
    language_codes,
    length_buckets,
    periodic_runs,
    quality_rules,
    revisits,
    subsequence_toxicity,
    templates,
    token_scan,
)
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
