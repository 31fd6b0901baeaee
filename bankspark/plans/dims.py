"""Conformed dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from bankspark.config import Params
from bankspark.functions.cleanse import surrogate_key
from bankspark.functions.dates import lit_date
from bankspark.operators.history import snapshot_check
from bankspark.operators.joins import overlay_current

# The columns whose change opens a new version.
CUSTOMER_CHECK_COLS = ("customer_segment", "risk_category", "region")
ACCOUNT_CHECK_COLS = ("account_status", "branch_id", "account_type")


def dim_customer(stg: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The currently effective customer: tracked columns from the open snapshot row, the name
    (overwritten in place, never versioned) from staging."""
    tracked = [*CUSTOMER_CHECK_COLS, "onboarding_date"]
    base = stg.select(
        "customer_sk", "customer_id", "customer_name", "customer_segment", "risk_category",
        "region", "onboarding_date",
    )
    return overlay_current(base, snapshot.filter(F.col("valid_to").isNull()), "customer_id", tracked).select(
        "customer_sk", "customer_id", "customer_name", "customer_segment", "risk_category",
        "region", "onboarding_date", "scd_valid_from", "scd_valid_to",
    )


def dim_account(acct: DataFrame, branch: DataFrame, p: Params) -> DataFrame:
    b = branch.select(
        F.col("branch_id").alias("_b_id"), "branch_name", F.col("region").alias("branch_region")
    )
    return acct.join(b, acct.branch_id == b["_b_id"], "left").select(
        "account_sk", "account_id", "customer_id", "account_type", "account_status", "branch_id",
        "branch_name", "branch_region", "open_date",
        F.date_diff(lit_date(p.as_of_date), F.col("open_date")).alias("account_age_days"),
    )


def dim_account_history(history: DataFrame, acct: DataFrame, run_ts: datetime) -> DataFrame:
    """Account versions (status, branch and type tracked) after one more run."""
    return snapshot_check(history, acct, "account_id", ACCOUNT_CHECK_COLS, run_ts)


def dim_branch(branch: DataFrame) -> DataFrame:
    return branch.select("branch_sk", "branch_id", "branch_name", "city", "state", "region")


def dim_date(calendar: DataFrame) -> DataFrame:
    return calendar.select(
        "date_sk", "date_key", "year", "quarter", "month", "month_name", "day_of_week",
        "day_name", "is_weekend", "fiscal_period", "month_end_date", "quarter_end_date",
    )


def dim_derived(df: DataFrame, column: str, sk: str) -> DataFrame:
    """A dimension of the distinct values of one column."""
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return values.select(surrogate_key(F.col(column)).alias(sk), column)


def dim_loan_type(loans: DataFrame) -> DataFrame:
    return dim_derived(loans, "loan_type", "loan_type_sk")


def dim_merchant_category(txn: DataFrame) -> DataFrame:
    return dim_derived(txn, "merchant_category", "mcat_sk")
