"""The registered queries, one module per part of the inventory."""

from cohortlens.catalog import (  # noqa: F401
    decisions,
    explanations,
    frames,
    metrics,
    models,
    profiles,
    sources,
    splits,
)
from cohortlens.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
