"""Queries over the driver's tables."""

from . import queries_models, queries_stages, queries_tables  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
