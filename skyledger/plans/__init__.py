"""Queries of the plate-archive operators bound to the test tables, with their SQL."""

from skyledger.plans import exposure_queries, log_queries, plate_queries, sky_queries, solution_queries  # noqa: F401
from skyledger.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
