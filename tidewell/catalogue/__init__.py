"""Registered queries over the given tables, each with the SQL it must equal."""

from tidewell.catalogue import (  # noqa: F401 - importing registers the queries
    business,
    cleaning,
    curated,
    ingest,
    merging,
    metrics,
    quality,
    references,
)
from tidewell.catalogue.base import registered

__all__ = ["registered"]
