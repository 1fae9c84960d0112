"""Registered queries on the driver's tables."""

from tallyline.catalog import basics, comparing, domain, files, grouping, joining  # noqa: F401
from tallyline.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
