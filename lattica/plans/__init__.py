"""Queries over the given tables."""

from lattica.plans import geometry_queries, image_queries, log_queries, model_queries, more_queries, record_queries, registry_queries, sparse_queries, surface_queries  # noqa: F401
from lattica.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
