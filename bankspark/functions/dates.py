"""Date arithmetic that counts crossed boundaries, not elapsed whole units."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def lit_date(d: date) -> Column:
    return F.lit(d.isoformat()).cast("date")


def lit_ts(t: datetime) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "quarter")


def months_between_boundaries(start: Column, end: Column) -> Column:
    """Month boundaries crossed from start to end (negative when end is earlier)."""
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))


def epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch, session time zone UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def minutes_between_boundaries(start: Column, end: Column) -> Column:
    def minute(ts: Column) -> Column:
        return F.floor(F.unix_seconds(ts.cast("timestamp")) / 60)

    return minute(end) - minute(start)


def fiscal_year(d: Column, start_month: int = 4) -> Column:
    return F.year(d) - F.when(F.month(d) < start_month, 1).otherwise(0)


def fiscal_quarter(d: Column, start_month: int = 4) -> Column:
    return F.floor(F.pmod(F.month(d) - start_month, F.lit(12)) / 3).cast("int") + 1
