"""All registered queries."""

from dayledger.plans import kpi_queries, quality_queries  # noqa: F401
from dayledger.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
