"""Loan amortisation estimates, the loan fact and the portfolio views on it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from bankspark.config import Params
from bankspark.functions import rules
from bankspark.functions.dates import (
    lit_date, lit_ts, month_start, months_between_boundaries, quarter_start,
)
from bankspark.functions.numbers import (
    divide, greatest_strict, least_strict, mean, ratio_pct, share_pct, sum_when,
)


def tenure_months(amount: Column, emi: Column) -> Column:
    """Instalments needed to repay the principal, at least 0; null without an instalment."""
    return greatest_strict(F.round(divide(amount, emi, 8), 0).cast("int"), F.lit(0))


def outstanding(amount: Column, emi: Column, months_paid: Column) -> Column:
    """Principal less the instalments paid, floored at 0."""
    left = F.round(amount - emi * months_paid.cast("decimal(9,0)"), 2).cast("decimal(18,2)")
    return greatest_strict(left, F.lit(0).cast("decimal(18,2)"))


def amortize_loans(loans: DataFrame, p: Params) -> DataFrame:
    """Months on book, tenure, months paid, repaid and outstanding amounts as of `p.as_of`."""
    amount, emi = F.col("loan_amount"), F.col("emi_amount")
    since = months_between_boundaries(F.col("disbursement_date"), lit_date(p.as_of_date))
    return (
        loans.withColumn("months_since_disbursement", since)
        .withColumn("loan_tenure_months_estimate", tenure_months(amount, emi))
        .withColumn(
            "effective_months_paid",
            least_strict(F.col("months_since_disbursement"), F.col("loan_tenure_months_estimate")),
        )
        .withColumn(
            "estimated_total_repaid",
            F.round(emi * F.col("effective_months_paid").cast("decimal(9,0)"), 2).cast("decimal(18,2)"),
        )
        .withColumn("outstanding_balance_est", outstanding(amount, emi, F.col("effective_months_paid")))
        .drop("loaded_at")
    )


def fct_loans(amortized: DataFrame, dim_customer: DataFrame, p: Params) -> DataFrame:
    """Loans with the current attributes of their customer."""
    c = dim_customer.select(
        F.col("customer_id").alias("_c_id"), "customer_sk", "customer_segment",
        F.col("risk_category").alias("customer_risk_category"),
        F.col("region").alias("customer_region"),
    )
    return amortized.join(c, F.col("customer_id") == F.col("_c_id"), "left").select(
        "loan_sk", "loan_id", "loan_type", "customer_sk", "customer_id", "customer_segment",
        "customer_risk_category", "customer_region", "loan_amount", "interest_rate",
        "emi_amount", "loan_status", "disbursement_date", "months_since_disbursement",
        "loan_tenure_months_estimate", "effective_months_paid", "estimated_total_repaid",
        "outstanding_balance_est", "is_default_flag", "is_delinquent_flag", "is_active_flag",
        lit_ts(p.as_of).alias("loaded_at"),
    )


def loan_portfolio(loans: DataFrame) -> DataFrame:
    """Exposure and default rate (by principal) per loan type, region, segment and risk."""
    principal, n = F.sum("loan_amount"), F.count(F.lit(1))
    return loans.groupBy(
        "loan_type", "customer_region", "customer_segment", "customer_risk_category"
    ).agg(
        n.alias("loan_count"),
        principal.alias("total_principal_usd"),
        F.sum("outstanding_balance_est").alias("total_outstanding_usd"),
        F.sum("is_default_flag").alias("defaulted_count"),
        F.sum("is_delinquent_flag").alias("delinquent_count"),
        F.sum("is_active_flag").alias("active_count"),
        ratio_pct(sum_when(F.col("is_default_flag") == 1, F.col("loan_amount")), principal).alias(
            "default_rate_pct"
        ),
        F.round(mean(F.sum("interest_rate"), F.count("interest_rate"), 8), 2).alias(
            "avg_interest_rate"
        ),
        F.round(mean(principal, F.count("loan_amount"), 8), 2).alias("avg_loan_principal"),
    )


def default_rate(loans: DataFrame, by: list[str], weight: str = "principal") -> DataFrame:
    """Default rate in percent, weighted by principal or by count."""
    if weight == "count":
        rate = share_pct(F.sum("is_default_flag"), F.count(F.lit(1)))
    else:
        rate = ratio_pct(
            sum_when(F.col("is_default_flag") == 1, F.col("loan_amount")), F.sum("loan_amount")
        )
    return loans.groupBy(*by).agg(F.count(F.lit(1)).alias("loan_count"), rate.alias("default_rate_pct"))


def balance_intervals(
    loans: DataFrame, p: Params, since: date | None = None, also: Sequence[str] = (),
) -> DataFrame:
    """Loan x month from disbursement to as_of: the balance estimated for the month and the first and
    last day it holds for. `since` leaves out the months before that day's; `also` names more columns
    of the loan to keep.

    The balance changes only with the month, so a row stands for some thirty days;
    `daily_balances` writes them out.
    """
    as_of = lit_date(p.as_of_date)
    amount, emi, start = F.col("loan_amount"), F.col("emi_amount"), F.col("disbursement_date")
    first_month = month_start(start)
    if since is not None:
        first_month = F.greatest(first_month, month_start(lit_date(since)))
    months = F.sequence(first_month, month_start(as_of), F.expr("interval 1 month"))
    ids = ["loan_sk", "loan_id", "loan_type", "customer_id", *also]
    per_month = (
        loans.filter((start <= as_of) & (first_month <= month_start(as_of)))
        .select(*ids, "loan_amount", "emi_amount", "disbursement_date", tenure_months(amount, emi).alias("_tenure"))
        .withColumn("balance_month", F.explode(months))
    )
    paid = least_strict(months_between_boundaries(start, F.col("balance_month")), F.col("_tenure"))
    return per_month.select(
        *ids, "balance_month", F.greatest(start, F.col("balance_month")).alias("first_day"),
        F.least(as_of, F.last_day("balance_month")).alias("last_day"),
        outstanding(amount, emi, paid).alias("outstanding_balance"),
    )


def daily_balances(
    intervals: DataFrame, since: date | None = None, until: date | None = None, also: Sequence[str] = (),
) -> DataFrame:
    """Loan x day from the intervals, from `since` to `until`; other months are not read where the
    intervals are stored by month. `also` names more columns of the interval to keep."""
    first, last = F.col("first_day"), F.col("last_day")
    if since is not None:
        intervals = intervals.filter(F.col("balance_month") >= month_start(lit_date(since)))
        first = F.greatest(first, lit_date(since))
    if until is not None:
        intervals = intervals.filter(F.col("balance_month") <= lit_date(until))
        last = F.least(last, lit_date(until))
    days = F.when(first <= last, F.sequence(first, last))
    return intervals.select(
        "loan_sk", "loan_id", "loan_type", "customer_id", F.explode(days).alias("balance_date"), "balance_month",
        "outstanding_balance", *also)


def loan_balances_daily(loans: DataFrame, p: Params, since: date | None = None) -> DataFrame:
    """Loan x day from disbursement to as_of, with the balance estimated for that day. `since`
    leaves out the months before that day's."""
    return daily_balances(balance_intervals(loans, p, since))


def vintage(loans: DataFrame) -> DataFrame:
    """Default rate by disbursement quarter and months on book."""
    n = F.count(F.lit(1))
    return loans.groupBy(
        quarter_start(F.col("disbursement_date")).alias("vintage_quarter"),
        F.col("months_since_disbursement").alias("months_on_book"),
    ).agg(
        n.alias("loan_count"),
        F.sum("is_default_flag").alias("defaulted_count"),
        share_pct(F.sum("is_default_flag"), n).alias("default_rate_pct"),
    )


def npa_summary(loans: DataFrame) -> DataFrame:
    """Loans and exposure per performing / watch / NPA bucket."""
    return loans.groupBy(rules.npa_bucket(F.col("loan_status")).alias("npa_bucket")).agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.sum("loan_amount").alias("total_principal_usd"),
        F.sum("outstanding_balance_est").alias("total_outstanding_usd"),
    )


def interest_accrued(loans: DataFrame) -> DataFrame:
    """Interest on the outstanding balance over the months on book, per loan."""
    accrued = F.round(
        F.col("outstanding_balance_est")
        * F.col("interest_rate")
        * F.col("months_since_disbursement").cast("decimal(6,0)")
        / 1200,
        2,
    ).cast("decimal(18,2)")
    return loans.select("loan_id", "customer_id", accrued.alias("interest_accrued_usd"))


