"""Retail-bank analytics on PySpark: staging, marts, fraud, data quality, history, governance."""

from bankspark.config import Params

__all__ = ["Params"]
