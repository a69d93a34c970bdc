"""All named queries. Importing a query module registers its queries."""

from __future__ import annotations

from tracemill.plans import (  # noqa: F401
    discovery_queries,
    io_queries,
    model_queries,
    profile_queries,
    quality_queries,
    training,
    view_queries,
)
from tracemill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
