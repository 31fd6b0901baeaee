"""Slowly-changing history (type 2) kept as rows with [valid_from, valid_to)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from bankspark.functions.cleanse import surrogate_key
from bankspark.functions.dates import lit_ts


def start_history(current: DataFrame, run_ts: datetime) -> DataFrame:
    """First run: every row opens at run_ts."""
    return current.withColumn("valid_from", lit_ts(run_ts)).withColumn(
        "valid_to", F.lit(None).cast("timestamp_ntz")
    )


def snapshot_check(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: datetime,
    invalidate_hard_deletes: bool = True,
    type1_cols: Sequence[str] = (),
) -> DataFrame:
    """History after one more run of the `check` strategy.

    A row whose check columns changed is closed at run_ts and a new version opened; unchanged
    rows stay as they are even when other columns differ; keys new to the history open; open
    keys gone from the source are closed if `invalidate_hard_deletes`. `type1_cols` are
    overwritten in every version of a key that is still in the source.

    Closed versions only pass through, so a history partitioned by open/closed needs no
    rewrite of the closed part.
    """
    data_cols = list(current.columns)
    closed = history.filter(F.col("valid_to").isNotNull())
    opened = history.filter(F.col("valid_to").isNull())

    old = opened.select(F.struct(*data_cols, "valid_from").alias("old"))
    new = current.select(F.struct(*data_cols).alias("new"))
    pair = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    run = lit_ts(run_ts)
    open_end = F.lit(None).cast("timestamp_ntz")

    def version(side: str, valid_from, valid_to):
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in data_cols],
            valid_from.alias("valid_from"),
            valid_to.alias("valid_to"),
        )

    changed = ~F.struct(*[F.col(f"old.{c}") for c in check_cols]).eqNullSafe(
        F.struct(*[F.col(f"new.{c}") for c in check_cols])
    )
    keep = version("old", F.col("old.valid_from"), open_end)
    close = version("old", F.col("old.valid_from"), run)
    begin = version("new", run, open_end)
    gone = F.array(close) if invalidate_hard_deletes else F.array(keep)

    versions = pair.select(
        F.explode(
            F.when(F.col("old").isNull(), F.array(begin))
            .when(F.col("new").isNull(), gone)
            .when(changed, F.array(close, begin))
            .otherwise(F.array(keep))
        ).alias("v")
    ).select("v.*")

    result = closed.select(*data_cols, "valid_from", "valid_to").unionByName(versions)
    return overwrite_type1(result, current, key, type1_cols) if type1_cols else result


def overwrite_type1(
    history: DataFrame, current: DataFrame, key: str, cols: Sequence[str]
) -> DataFrame:
    """The latest value of `cols` in all versions of the keys the source still has."""
    latest = current.select(
        F.col(key), F.lit(True).alias("_known"), *[F.col(c).alias(f"_new_{c}") for c in cols]
    )
    joined = history.join(latest, key, "left")
    picked = [
        F.when(F.col("_known"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in cols else F.col(c)
        for c in history.columns
    ]
    return joined.select(*picked)


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter(F.col("valid_to").isNull())


def with_version_key(history: DataFrame, key: str, name: str = "version_sk") -> DataFrame:
    """Surrogate key of one version: natural key plus its start."""
    return history.withColumn(name, surrogate_key(F.col(key), F.col("valid_from")))
