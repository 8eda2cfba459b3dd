"""All registered queries."""

from . import (  # noqa: F401
    clusters,
    metrics,
    models,
    preparation,
    sampling,
    sources,
    tuning,
    workflows,
)
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
