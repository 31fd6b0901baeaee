"""The calendar as a source: one row per day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from bankspark.functions.dates import fiscal_quarter, fiscal_year, lit_date


def calendar(spark: SparkSession, start: date, end: date, fy_start: int = 4) -> DataFrame:
    """All days from start to end."""
    bounds = spark.range(1).select(lit_date(start).alias("lo"), lit_date(end).alias("hi"))
    return calendar_between(bounds, "lo", "hi", fy_start)


def calendar_of(df: DataFrame, day: str, fy_start: int = 4) -> DataFrame:
    """All days from the first to the last that `df` has."""
    bounds = df.agg(
        F.min(F.col(day).cast("date")).alias("lo"), F.max(F.col(day).cast("date")).alias("hi")
    )
    return calendar_between(bounds, "lo", "hi", fy_start)


def calendar_between(bounds: DataFrame, lo: str, hi: str, fy_start: int = 4) -> DataFrame:
    """Calendar attributes for each day of the one-row frame's range."""
    d = F.col("date_key")
    return bounds.select(F.explode(F.sequence(F.col(lo), F.col(hi))).alias("date_key")).select(
        d,
        F.month(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.concat(
            F.lit("FY"), fiscal_year(d, fy_start).cast("string"),
            F.lit("-Q"), fiscal_quarter(d, fy_start).cast("string"),
        ).alias("fiscal_period"),
    )
