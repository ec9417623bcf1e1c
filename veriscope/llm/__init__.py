"""Operators for preparing training data, with their queries over the given tables."""

from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
