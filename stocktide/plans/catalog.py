"""All registered queries; importing this module registers them."""

from stocktide.plans import io_queries, quality_queries, queries, run_queries  # noqa: F401
from stocktide.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
