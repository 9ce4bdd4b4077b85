"""All registered queries."""

from . import analytics_queries, model_queries, table_queries, text_queries  # noqa: F401
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
