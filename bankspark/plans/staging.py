"""Cleansed, deduplicated staging of each raw feed.

`variant="warehouse"` gives the plain-SQL twins: surrogate keys over the raw id, no null-key
filter on accounts and loans, loans not deduplicated and without the active flag, zero
amounts as null.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bankspark.config import RISK_LEVELS
from bankspark.functions import rules
from bankspark.functions.cleanse import (
    canonical, default_unknown, md5_key, norm_code, norm_name, surrogate_key, zero_to_null,
)
from bankspark.functions.dates import lit_ts
from bankspark.functions.numbers import flag
from bankspark.operators.rows import drop_deleted, latest_per_key, require
from bankspark.schemas import DELETED, SYNCED
from bankspark.session import work_dir
from bankspark.sources import sinks

MODELED, WAREHOUSE = "modeled", "warehouse"


def _sk(df: DataFrame, name: str, key: str, variant: str) -> DataFrame:
    """Surrogate key as the first column; the raw id is still at hand as `_raw_<key>`."""
    sk = md5_key(F.col(f"_raw_{key}")) if variant == WAREHOUSE else surrogate_key(F.col(key))
    rest = [c for c in df.columns if not c.startswith("_raw_")]
    return df.select(sk.alias(name), *rest)


def _source(raw: DataFrame, *required: str) -> DataFrame:
    rows = drop_deleted(raw)
    return require(rows, required) if required else rows


def stg_customers(raw: DataFrame, variant: str = MODELED) -> DataFrame:
    rows = _source(raw, "customer_id").select(
        F.col("customer_id").alias("_raw_customer_id"),
        norm_code(F.col("customer_id")).alias("customer_id"),
        norm_name(F.col("customer_name")).alias("customer_name"),
        default_unknown(F.col("customer_segment")).alias("customer_segment"),
        canonical(F.col("risk_category"), RISK_LEVELS).alias("risk_category"),
        norm_name(F.col("region")).alias("region"),
        "onboarding_date",
        F.col(SYNCED).alias("loaded_at"),
    )
    ties = ["customer_segment", "risk_category", "region", "customer_name", "onboarding_date"]
    return _sk(
        latest_per_key(rows, "customer_id", "loaded_at", ties), "customer_sk", "customer_id", variant
    )


def stg_accounts(raw: DataFrame, variant: str = MODELED) -> DataFrame:
    required = () if variant == WAREHOUSE else ("account_id",)
    rows = _source(raw, *required).select(
        F.col("account_id").alias("_raw_account_id"),
        norm_code(F.col("account_id")).alias("account_id"),
        norm_code(F.col("customer_id")).alias("customer_id"),
        norm_code(F.col("account_type")).alias("account_type"),
        norm_code(F.col("branch_id")).alias("branch_id"),
        default_unknown(F.col("account_status")).alias("account_status"),
        "open_date",
        F.col(SYNCED).alias("loaded_at"),
    )
    ties = ["account_status", "customer_id", "branch_id", "account_type", "open_date"]
    return _sk(
        latest_per_key(rows, "account_id", "loaded_at", ties), "account_sk", "account_id", variant
    )


def cleanse_transactions(
    raw: DataFrame, amount: Column | None = None, extra: tuple[str, ...] = ()
) -> DataFrame:
    """The transaction cleansing that batch and change stream share."""
    return raw.select(
        *extra,
        F.col("transaction_id").alias("_raw_transaction_id"),
        norm_code(F.col("transaction_id")).alias("transaction_id"),
        norm_code(F.col("account_id")).alias("account_id"),
        norm_code(F.col("transaction_type")).alias("transaction_type"),
        (F.col("amount") if amount is None else amount).alias("amount"),
        norm_code(F.col("currency")).alias("currency"),
        norm_code(F.col("merchant_category")).alias("merchant_category"),
        "transaction_timestamp",
        F.col("transaction_timestamp").cast("date").alias("transaction_date"),
        default_unknown(F.col("transaction_status")).alias("transaction_status"),
        F.col(SYNCED).alias("loaded_at"),
    )


TXN_TIES = (
    "transaction_status", "amount", "transaction_timestamp", "account_id", "transaction_type",
    "currency", "merchant_category",
)


def stg_transactions(raw: DataFrame, variant: str = MODELED) -> DataFrame:
    amount = zero_to_null(F.col("amount")) if variant == WAREHOUSE else None
    rows = cleanse_transactions(_source(raw, "transaction_id", "amount"), amount)
    return _sk(
        latest_per_key(rows, "transaction_id", "loaded_at", TXN_TIES),
        "transaction_sk", "transaction_id", variant,
    )


def stg_transactions_since(raw: DataFrame, bound: datetime) -> DataFrame:
    """The staged transactions at or after `bound`, without staging the whole history.

    Only ids with some version at or after the bound can qualify, so the others are dropped
    before the deduplicating shuffle; all versions of the rest take part in it, since the
    newest version may have moved before the bound.
    """
    ts = F.col("transaction_timestamp")
    code = norm_code(F.col("transaction_id"))
    recent = raw.filter(ts >= lit_ts(bound)).select(code.alias("_id")).distinct()
    versions = raw.join(recent, code == F.col("_id"), "left_semi")
    return stg_transactions(versions).filter(ts >= lit_ts(bound))


SYNCS = "_syncs"  # newest sync time of each refresh, beside the partitions


def _note_sync(fresh: DataFrame, path: str) -> None:
    sinks.append_log(fresh.agg(F.max("loaded_at").alias("newest")), os.path.join(path, SYNCS))


def _newest_sync(stored: DataFrame, path: str) -> datetime | None:
    """Newest stored sync time, from the notes of the refreshes; a table without them is scanned."""
    notes = sinks.read_if_exists(stored.sparkSession, os.path.join(path, SYNCS))
    found = stored.agg(F.max("loaded_at")) if notes is None else notes.agg(F.max("newest"))
    return found.first()[0]  # one value


def refresh_staged_transactions(
    spark: SparkSession, path: str, raw: DataFrame, overlap_hours: int = 24, grain: str = "month",
    before: Callable[[list[str] | None], None] | None = None,
) -> DataFrame:
    """Bring the stored staging of transactions, clustered by date, up to the raw feed.

    The first time everything is staged. Later only raw rows synced since the newest stored sync,
    less the overlap, or without a sync time, are cleansed and deduplicated; of them and the
    stored versions of their ids the newest stays. Ids deleted since are staged again from all
    their versions. Only partitions that these touch are written; `before` is told which (None: all).
    """
    sinks.finish_move(spark, path)
    stored = sinks.read_if_exists(spark, path)
    if stored is None or sinks.PART not in stored.columns:
        if before is not None:
            before(None)
        sinks.write_clustered(stg_transactions(raw), path, "transaction_date", grain)
        whole = sinks.read_clustered(spark, path)
        _note_sync(whole, path)
        return whole
    newest = _newest_sync(stored, path)
    recent = raw
    if newest is not None:
        since = lit_ts(newest - timedelta(hours=overlap_hours))
        recent = raw.filter((F.col(SYNCED) >= since) | F.col(SYNCED).isNull())
    code = norm_code(F.col("transaction_id"))
    work = work_dir(spark, "staged")
    try:
        gone_path, fresh_path = os.path.join(work, "gone"), os.path.join(work, "fresh")
        recent.filter(F.col(DELETED)).select(code.alias("_id")).distinct().write.parquet(gone_path)
        gone = spark.read.parquet(gone_path)
        fresh = stg_transactions(recent)
        if not gone.isEmpty():
            # An older version of a deleted row may stand again, so all its versions are read.
            versions = raw.join(gone, code == F.col("_id"), "left_semi")
            kept = fresh.join(gone, F.col("transaction_id") == F.col("_id"), "left_anti")
            fresh = kept.unionByName(stg_transactions(versions))
        fresh.write.parquet(fresh_path)
        fresh = spark.read.schema(fresh.schema).parquet(fresh_path)
        keys = fresh.select("transaction_sk").union(gone.select(surrogate_key(F.col("_id"))))

        def merge(old: DataFrame, new: DataFrame) -> DataFrame:
            left = old.join(gone, F.col("transaction_id") == F.col("_id"), "left_anti")
            return latest_per_key(left.unionByName(new), "transaction_id", "loaded_at", TXN_TIES)

        sinks.rewrite_partitions(spark, path, "transaction_date", "transaction_sk", grain, keys, fresh, merge, before)
        _note_sync(fresh, path)
    finally:
        sinks.discard(spark, work)
    return sinks.read_clustered(spark, path)


def stg_loans(raw: DataFrame, variant: str = MODELED) -> DataFrame:
    required = () if variant == WAREHOUSE else ("loan_id",)
    rows = _source(raw, *required).select(
        F.col("loan_id").alias("_raw_loan_id"),
        norm_code(F.col("loan_id")).alias("loan_id"),
        norm_code(F.col("customer_id")).alias("customer_id"),
        norm_code(F.col("loan_type")).alias("loan_type"),
        "loan_amount",
        "interest_rate",
        "emi_amount",
        norm_code(F.col("loan_status")).alias("loan_status"),
        "disbursement_date",
        F.col(SYNCED).alias("loaded_at"),
    )
    if variant != WAREHOUSE:
        ties = ["loan_status", "loan_amount", "emi_amount", "interest_rate", "disbursement_date"]
        rows = latest_per_key(rows, "loan_id", "loaded_at", ties)
    return loan_flags(_sk(rows, "loan_sk", "loan_id", variant), active=variant != WAREHOUSE)


def loan_flags(df: DataFrame, active: bool = True) -> DataFrame:
    """Status flags placed after the status column."""
    status = F.col("loan_status")
    flags = [
        rules.loan_default(status).alias("is_default_flag"),
        rules.loan_delinquent(status).alias("is_delinquent_flag"),
    ]
    if active:
        flags.append(rules.loan_active(status).alias("is_active_flag"))
    at = df.columns.index("loan_status") + 1
    return df.select(*df.columns[:at], *flags, *df.columns[at:])


def stg_branches(raw: DataFrame, variant: str = MODELED) -> DataFrame:
    required = () if variant == WAREHOUSE else ("branch_id",)
    rows = _source(raw, *required).select(
        F.col("branch_id").alias("_raw_branch_id"),
        norm_code(F.col("branch_id")).alias("branch_id"),
        norm_name(F.col("branch_name")).alias("branch_name"),
        norm_name(F.col("city")).alias("city"),
        norm_code(F.col("state")).alias("state"),
        norm_name(F.col("region")).alias("region"),
        F.col(SYNCED).alias("loaded_at"),
    )
    staged = _sk(rows, "branch_sk", "branch_id", variant)
    return staged.drop("loaded_at") if variant == WAREHOUSE else staged


def calendar_attrs(df: DataFrame) -> DataFrame:
    """Weekday (0 = Sunday), names, weekend flag, month and quarter ends."""
    d = F.col("date_key")
    dow = F.dayofweek(d) - 1
    return df.select(
        "*",
        dow.alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        F.monthname(d).alias("month_name"),
        flag(dow.isin(0, 6)).alias("is_weekend"),
        F.last_day(d).alias("month_end_date"),
        F.last_day(F.add_months(F.trunc(d, "quarter"), 2)).alias("quarter_end_date"),
    )


def stg_calendar_dim(raw: DataFrame, variant: str = MODELED) -> DataFrame:
    required = () if variant == WAREHOUSE else ("date_key",)
    cols = ["date_key", "month", "quarter", "year", "fiscal_period"]
    rows = _source(raw, *required).select(*cols)
    if variant == WAREHOUSE:
        return rows.select(md5_key(F.col("date_key")).alias("date_sk"), *cols)
    return calendar_attrs(rows.select(surrogate_key(F.col("date_key")).alias("date_sk"), *cols))


STAGERS = {
    "customers": stg_customers,
    "accounts": stg_accounts,
    "transactions": stg_transactions,
    "loans": stg_loans,
    "branches": stg_branches,
    "calendar": stg_calendar_dim,
}


def stage(raw: dict[str, DataFrame], variant: str = MODELED) -> dict[str, DataFrame]:
    return {name: STAGERS[name](df, variant) for name, df in raw.items()}
