"""Import every plan module so its queries register; expose the registry."""

from __future__ import annotations

from heliolake.plans import connectors, dashboards, decoding, filesq, keyed, lookups, scalars, streams  # noqa: F401  (registers queries)
from heliolake.plans.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
