"""Every registered query with its oracle SQL."""

from holdfast.catalog import checks, closed_forms, metrics, modeling, models, scans, summary  # noqa: F401
from holdfast.catalog.entries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
