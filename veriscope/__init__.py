"""Forecast verification on Spark: from provider JSON to accuracy marts."""

from .session import build_session

__all__ = ["build_session"]
