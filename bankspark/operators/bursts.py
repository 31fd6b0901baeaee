"""Rapid-fire detection: how many rows of a key fall into the window that ends at a row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from bankspark.functions.dates import epoch_micros

MICROS_PER_MINUTE = 60_000_000


def burst_counts(
    df: DataFrame, key: str, ts: str, minutes: int = 60, bucket_windows: int = 4
) -> DataFrame:
    """One row per (key, ts) with `txn_count`: rows of the key in [ts - minutes, ts].

    Rows at the same instant are counted before anything is shuffled, and a key's timeline is
    cut into buckets of `bucket_windows` windows. Instants within one window of a bucket's end
    are also handed to the next bucket, so each bucket counts on its own: no key, however hot,
    is sorted by a single task. Null keys form one group, as a window partition would.
    """
    window_us = minutes * MICROS_PER_MINUTE
    width_us = window_us * bucket_windows
    instants = (
        df.groupBy(F.col(key).alias("_key"), F.col(ts).alias("_ts"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_us", epoch_micros(F.col("_ts")))
        .withColumn("_own", F.floor(F.col("_us") / width_us))
        .withColumn("_last", F.floor((F.col("_us") + window_us) / width_us))
        .withColumn(
            "_bucket",
            F.explode(F.array_distinct(F.array(F.col("_own"), F.col("_last")))),
        )
    )
    frame = (
        Window.partitionBy("_key", "_bucket").orderBy("_us").rangeBetween(-window_us, 0)
    )
    return (
        instants.withColumn("txn_count", F.sum("_n").over(frame))
        .filter(F.col("_bucket").eqNullSafe(F.col("_own")))
        .select("_key", "_ts", "txn_count")
    )


def with_burst_count(
    df: DataFrame, key: str, ts: str, minutes: int = 60, name: str = "txn_count_60min"
) -> DataFrame:
    """Every row with the number of its key's rows in the window ending at it."""
    counts = burst_counts(df, key, ts, minutes)
    return (
        df.join(counts, _same(df, key, ts), "left")
        .withColumnRenamed("txn_count", name)
        .drop("_key", "_ts")
    )


def burst_hits(
    df: DataFrame, key: str, ts: str, minutes: int = 60, at_least: int = 3
) -> DataFrame:
    """The (key, ts) instants whose window holds at least `at_least` rows."""
    return burst_counts(df, key, ts, minutes).filter(F.col("txn_count") >= at_least)


def with_burst_flag(
    df: DataFrame, key: str, ts: str, minutes: int = 60, at_least: int = 3,
    name: str = "is_rapid_fire_flag", hits: DataFrame | None = None,
) -> DataFrame:
    """Every row with a 0/1 flag: at least `at_least` rows in the window ending at it.

    Only the instants that reach the count are joined back, which are few. Pass the written
    `burst_hits` as `hits` where `df` is large: their size is then known when the join is
    planned, and if it is small `df` is not shuffled at all.
    """
    if hits is None:
        hits = burst_hits(df, key, ts, minutes, at_least)
    return (
        df.join(hits, _same(df, key, ts), "left")
        .withColumn(name, F.when(F.col("txn_count").isNotNull(), 1).otherwise(0))
        .drop("_key", "_ts", "txn_count")
    )


def _same(df: DataFrame, key: str, ts: str):
    return F.col(key).eqNullSafe(F.col("_key")) & F.col(ts).eqNullSafe(F.col("_ts"))
