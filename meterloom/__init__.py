"""Metered time-series analytics on Spark: ingest, clean, feature, forecast, report."""

from meterloom.config import HOUSEHOLD, Roles, Splits

__all__ = ["HOUSEHOLD", "Roles", "Splits"]
