"""Row selection: latest per key, row filters, ranks, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from bankspark.schemas import DELETED, SYNCED


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] | str,
    order_col: str = SYNCED,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the greatest `order_col` (a missing one counts as newest), ties broken
    by the `tiebreak` columns.

    Spark prunes each map task to one row per key before the shuffle (WindowGroupLimit), so a
    key that holds a large part of the table arrives as one row per input split.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [F.col(order_col).desc_nulls_first()]
    order += [F.col(c).desc_nulls_last() for c in tiebreak]
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", newest).filter(F.col("_rn") == 1).drop("_rn")


def drop_deleted(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(DELETED))


def not_deleted(df: DataFrame) -> DataFrame:
    """Like drop_deleted, but a missing marker counts as not deleted."""
    return df.filter(~F.coalesce(F.col(DELETED), F.lit(False)))


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def non_empty(df: DataFrame, array_col: str) -> DataFrame:
    return df.filter(F.size(array_col) > 0)


def rank_by(
    df: DataFrame, measure: str, part: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """League-table rank, highest first, ties share a rank.

    Without `part` the frame must already be an aggregate: one task ranks it.
    """
    window = Window.partitionBy(*part) if part else Window.partitionBy()
    return df.withColumn(name, F.rank().over(window.orderBy(F.col(measure).desc_nulls_last())))


def top_n(df: DataFrame, n: int, measure: str, tiebreak: Sequence[str]) -> DataFrame:
    order = [F.col(measure).desc_nulls_last(), *[F.col(c).asc() for c in tiebreak]]
    return df.orderBy(*order).limit(n)


def bottom_n(df: DataFrame, n: int, measure: str, tiebreak: Sequence[str]) -> DataFrame:
    order = [F.col(measure).asc_nulls_last(), *[F.col(c).asc() for c in tiebreak]]
    return df.orderBy(*order).limit(n)


def in_order(df: DataFrame, *order: Column | str, position: str = "position") -> DataFrame:
    """The rows of a report in the order it is shown, numbered. For aggregates: one task numbers
    them."""
    return df.withColumn(position, F.row_number().over(Window.orderBy(*order))).orderBy(position)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Any n rows, for looking at data."""
    return df.limit(n)
