"""Transactions with account, customer and branch context, amounts in USD and rule flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bankspark.config import Params
from bankspark.functions import rules
from bankspark.functions.dates import lit_ts
from bankspark.operators.fx import fx_as_of, fx_exact_month, to_usd


def account_context(acct: DataFrame, cust: DataFrame, branch: DataFrame) -> DataFrame:
    """Accounts with their customer and branch.

    Joining the dimensions to each other first leaves one join, and so one shuffle, for the
    transactions instead of three.
    """
    a = acct.select("account_sk", "account_id", "customer_id", "account_type", "account_status", "branch_id")
    c = cust.select(
        F.col("customer_id").alias("_c_id"), "customer_sk", "customer_segment",
        F.col("risk_category").alias("customer_risk_category"),
        F.col("region").alias("customer_region"),
    )
    b = branch.select(
        F.col("branch_id").alias("_b_id"), "branch_sk", "branch_name",
        F.col("region").alias("branch_region"), F.col("state").alias("branch_state"),
    )
    joined = a.join(c, a.customer_id == c["_c_id"], "left").join(b, a.branch_id == b["_b_id"], "left")
    return joined.select(
        F.col("account_id").alias("_acct_id"), "account_sk", "account_type", "account_status",
        "customer_sk", F.col("_c_id").alias("customer_id"), "customer_segment",
        "customer_risk_category", "customer_region",
        "branch_sk", F.col("_b_id").alias("branch_id"), "branch_name", "branch_region",
        "branch_state",
    )


ENRICHED_COLS = (
    "transaction_sk", "transaction_id", "transaction_timestamp", "transaction_date",
    "transaction_type", "transaction_status", "merchant_category", "amount_local", "currency",
    "amount_usd", "account_sk", "account_id", "account_type", "account_status", "customer_sk",
    "customer_id", "customer_segment", "customer_risk_category", "branch_sk", "branch_id",
    "branch_name", "branch_region", "branch_state", "customer_region", "is_blocked_flag",
    "is_failed_flag", "is_round_high_value_flag", "is_high_value_flag",
)


def enrich_transactions(
    txn: DataFrame, acct: DataFrame, cust: DataFrame, branch: DataFrame, fx: DataFrame, p: Params,
    fx_mode: str = "exact_month",
) -> DataFrame:
    """One row per staged transaction.

    A transaction without a known account has no account, customer or branch. `fx_mode`
    "exact_month" needs a rate for the very month, "as_of" takes the latest one before.
    """
    convert = {"exact_month": fx_exact_month, "as_of": fx_as_of}[fx_mode]
    context = account_context(acct, cust, branch)
    rated = convert(txn, fx, "currency", "transaction_date").withColumn(
        "amount_usd", to_usd(F.col("amount"), F.col("rate_to_usd"))
    )
    status, usd = F.col("transaction_status"), F.col("amount_usd")
    joined = rated.withColumnRenamed("account_id", "_txn_account").join(
        context, F.col("_txn_account") == F.col("_acct_id"), "left"
    )
    return joined.select(
        "*",
        F.col("amount").alias("amount_local"),
        F.col("_acct_id").alias("account_id"),
        rules.is_blocked(status).alias("is_blocked_flag"),
        rules.is_failed(status).alias("is_failed_flag"),
        rules.is_round_high_value(usd, p.fraud_round_high_value_usd).alias(
            "is_round_high_value_flag"
        ),
        rules.is_high_value(usd, p.fraud_high_value_usd).alias("is_high_value_flag"),
    ).select(*ENRICHED_COLS)


FACT_COLS = (
    "transaction_sk", "transaction_id", "transaction_timestamp", "transaction_date",
    "transaction_type", "transaction_status", "merchant_category", "amount_local", "currency",
    "amount_usd", "account_sk", "account_id", "customer_sk", "customer_id", "customer_segment",
    "customer_risk_category", "branch_sk", "branch_id", "branch_region", "branch_state",
    "is_failed_flag", "is_blocked_flag", "is_high_value_flag", "is_round_high_value_flag",
)


def fct_transactions(enriched: DataFrame, p: Params) -> DataFrame:
    """The transaction fact, stamped with its load time."""
    return enriched.select(*FACT_COLS).withColumn("loaded_at", lit_ts(p.as_of))
