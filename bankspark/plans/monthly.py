"""Aggregates of the transaction fact that are kept by month and follow the months the fact was written in."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from bankspark.config import Params
from bankspark.functions.dates import month_start
from bankspark.plans import fraud, marts
from bankspark.sources.sinks import materialize, part_label
from bankspark.sources.touched import Touched, follow, month_away, month_of, months_of

MONTH = "month"


def _revenue(fct: DataFrame) -> DataFrame:
    return marts.revenue_monthly(fct).withColumn(MONTH, part_label("revenue_month", MONTH))


def _branches(fct: DataFrame) -> DataFrame:
    return marts.branch_months(fct).withColumn(MONTH, part_label("performance_month", MONTH))


def _customers(fct: DataFrame) -> DataFrame:
    return marts.customer_txn_agg(fct, MONTH)


AGGREGATES = {"revenue": _revenue, "branches": _branches, "customers": _customers}


def refresh(spark: SparkSession, folder: str, fact: str, touched: Touched, p: Params, scratch: str) -> dict[str, DataFrame]:
    """Bring the monthly aggregates and the flagged transactions up to the fact: only the months
    written since they were last brought up are read and worked out again. They mirror the fact
    whether or not the marts made of them are published, so a build that stops in between leaves
    nothing to catch up with."""
    parts, n = touched.since("monthly")
    months = None if parts is None else months_of(parts)
    out = {
        name: follow(spark, os.path.join(folder, name), fact, MONTH, months, work, month_of).drop(MONTH)
        for name, work in AGGREGATES.items()
    }
    out["flags"] = _flags(spark, os.path.join(folder, "flags"), fact, months, p, scratch)
    touched.reached("monthly", n)
    return out


def _flags(spark: SparkSession, path: str, fact: str, months: list[str] | None, p: Params, scratch: str) -> DataFrame:
    """Flagged transactions by month. A row counts for the rapid-fire rule of those up to a window after it, so
    the month after a written one is worked out again too, and of the month before only the last
    window is looked at."""
    mine = None if months is None else sorted({month_away(m, k) for m in months for k in (0, 1)})
    also = sorted({month_away(m, -1) for m in mine} - set(mine)) if mine else []
    ts = F.col("transaction_timestamp")

    def work(rows: DataFrame) -> DataFrame:
        if also:
            last = ts >= F.add_months(month_start(ts), 1).cast("timestamp_ntz") - F.make_dt_interval(mins=F.lit(p.rapid_fire_minutes))
            rows = rows.filter(F.col(MONTH).isin(*mine) | last)
        hits = materialize(fraud.rapid_fire_hits(rows, p), scratch, "rapid_fire_hits")
        flagged = fraud.fraud_indicators(rows, p, hits)
        return flagged.withColumn(MONTH, part_label("transaction_date", MONTH))

    return follow(spark, path, fact, MONTH, mine, work, month_of, also).drop(MONTH)
