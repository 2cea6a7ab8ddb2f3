"""The queries over the driver's tables and their SQL."""

from __future__ import annotations

from tessaria.plans import table_queries  # noqa: F401  registers its queries
from tessaria.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
