"""Imports every module that registers queries."""

from checks import fusion, records, resolution, search, stored  # noqa: F401
from checks.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
