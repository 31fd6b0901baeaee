"""Importing this module registers every query."""

from bankspark.checks import contracts, layers, marts, quality, streams  # noqa: F401
from bankspark.checks.context import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
