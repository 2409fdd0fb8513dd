"""Registered queries with the SQL that checks them."""

from tablemend.checks import comparison, conversion, counting, files, further, loading, mended, streams, windows
from tablemend.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "comparison", "conversion", "counting", "files", "further", "loading", "mended", "streams", "windows"]
