"""Incremental slices, merges by key, and change records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from bankspark.functions.dates import lit_ts

# Fixed value: the columns a change of kind UPDATE may set on a stored transaction.
CDC_UPDATE_COLS = ("amount", "currency", "merchant_category", "transaction_status", "loaded_at")


def high_water_mark(target: DataFrame, ts: str, overlap_hours: int) -> datetime | None:
    """Lower bound of the next load: newest stored time less the overlap; None if no time is
    stored, so that nothing is left out.

    One value is fetched so that the bound reaches the source scan as a literal and whole
    files and row groups are skipped.
    """
    newest = target.agg(F.max(ts).alias("m")).first()["m"]
    return None if newest is None else newest - timedelta(hours=overlap_hours)


def incremental_slice(
    src: DataFrame, ts: str, target: DataFrame | None = None, overlap_hours: int = 24,
    backfill_from: datetime | None = None, loaded: str | None = None, loaded_since: datetime | None = None,
) -> DataFrame:
    """Source rows at or after the target's high-water mark, or an explicit bound; all rows, also
    those without a time, if there is neither. With `loaded_since` also rows of any time that
    were loaded (column `loaded`) since then, which finds what arrived later than the overlap."""
    if backfill_from is None and target is not None:
        backfill_from = high_water_mark(target, ts, overlap_hours)
    if backfill_from is None:
        return src
    bound = F.col(ts) >= lit_ts(backfill_from)
    if loaded is not None and loaded_since is not None:
        bound = bound | (F.col(loaded) >= lit_ts(loaded_since))
    return src.filter(bound)


def sync_columns(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Target reshaped to the incoming columns: new ones null, dropped ones removed."""
    have = set(target.columns)
    return target.select(
        *[
            F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in incoming.schema.fields
        ]
    )


def merge_by_key(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Matched rows replaced, unmatched updates added, the rest of the target kept."""
    kept = sync_columns(target, updates).join(updates.select(key), key, "left_anti")
    return kept.unionByName(updates)


def latest_change(changes: DataFrame, key: str, order_col: str, action: str) -> DataFrame:
    """The newest change per key; of a DELETE + INSERT pair at one time the INSERT image."""
    newest = Window.partitionBy(key).orderBy(
        F.col(order_col).desc_nulls_first(), F.col(action).desc_nulls_last()
    )
    return (
        changes.withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") == 1)
        .drop("_rn")
    )


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    now: Column,
    update_cols: Sequence[str] = CDC_UPDATE_COLS,
) -> DataFrame:
    """Target after a batch of changes (one per key, with `cdc_operation`).

    Known key + DELETE: removed. Known key + UPDATE: only `update_cols` are set, and the row is
    stamped. Unknown key + INSERT: added. Everything else is ignored, so that applying the same
    batch twice equals applying it once.
    """
    cols = list(target.columns)
    tgt = target.select(F.struct(*cols).alias("tgt"))
    src = changes.select(F.struct(*changes.columns).alias("src"))
    op = F.col("src.cdc_operation")
    known = F.col("tgt").isNotNull()
    updated = known & (op == "UPDATE")

    def value(c: str) -> Column:
        if c == "ingested_at":
            return F.when(known & ~F.coalesce(updated, F.lit(False)), F.col("tgt.ingested_at")).otherwise(now)
        if c == "cdc_operation" or c in update_cols:
            return F.when(updated | ~known, F.col(f"src.{c}")).otherwise(F.col(f"tgt.{c}"))
        return F.when(known, F.col(f"tgt.{c}")).otherwise(F.col(f"src.{c}"))

    survives = (known & (op.isNull() | (op != "DELETE"))) | (~known & (op == "INSERT"))
    return (
        tgt.join(src, F.col(f"tgt.{key}") == F.col(f"src.{key}"), "full_outer")
        .filter(survives)
        .select(*[value(c).alias(c) for c in cols])
    )


def table_changes(before: DataFrame | None, after: DataFrame, key: str) -> DataFrame:
    """Change records between two states of a table.

    `action` INSERT or DELETE, `is_update` true for both halves of an updated row. Without a
    `before` every row is an INSERT.
    """
    cols = list(after.columns)
    if before is None:
        return after.withColumn("action", F.lit("INSERT")).withColumn("is_update", F.lit(False))
    old = before.select(F.struct(*cols).alias("old"))
    new = after.select(F.struct(*cols).alias("new"))

    def record(side: str, action: str, is_update: bool) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in cols],
            F.lit(action).alias("action"),
            F.lit(is_update).alias("is_update"),
        )

    return (
        old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
        .filter(~F.col("old").eqNullSafe(F.col("new")))
        .select(
            F.explode(
                F.when(F.col("old").isNull(), F.array(record("new", "INSERT", False)))
                .when(F.col("new").isNull(), F.array(record("old", "DELETE", False)))
                .otherwise(
                    F.array(record("old", "DELETE", True), record("new", "INSERT", True))
                )
            ).alias("r")
        )
        .select("r.*")
    )
