"""Business rules as flag expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bankspark.config import (
    ACTIVE_LOAN_STATUSES, DEFAULT_STATUSES, FAILED_STATUSES, REVENUE_TYPES, Params,
)
from bankspark.functions.numbers import flag


def is_revenue(txn_type: Column) -> Column:
    return txn_type.isin(*REVENUE_TYPES)


def is_blocked(status: Column) -> Column:
    return flag(status == "BLOCKED")


def is_failed(status: Column) -> Column:
    return flag(status.isin(*FAILED_STATUSES))


def is_high_value(amount: Column, threshold: int) -> Column:
    return flag(amount >= threshold)


def is_round_high_value(amount_usd: Column, threshold: int) -> Column:
    """At or above the threshold, and a multiple of 1000 once rounded to whole units."""
    return flag((amount_usd >= threshold) & (F.round(amount_usd, 0) % 1000 == 0))


def loan_default(status: Column) -> Column:
    return flag(status.isin(*DEFAULT_STATUSES))


def loan_delinquent(status: Column) -> Column:
    return flag(status == "DELINQUENT")


def loan_active(status: Column) -> Column:
    return flag(status.isin(*ACTIVE_LOAN_STATUSES))


def npa_bucket(status: Column) -> Column:
    """Performing / watch / NPA from the loan status (our own definition)."""
    return (
        F.when(status.isin(*DEFAULT_STATUSES), "NPA")
        .when(status == "DELINQUENT", "WATCH")
        .otherwise("PERFORMING")
    )


def risk_value_segment(risk: Column, net_revenue: Column, cut: int) -> Column:
    rich = net_revenue > cut
    return (
        F.when((risk == "HIGH") & rich, "HIGH_RISK_HIGH_VALUE")
        .when(risk == "HIGH", "HIGH_RISK_LOW_VALUE")
        .when((risk == "LOW") & rich, "LOW_RISK_HIGH_VALUE")
        .when(risk == "LOW", "LOW_RISK_LOW_VALUE")
        .otherwise("MEDIUM_RISK")
    )


def cdc_operation(action: Column, is_update: Column) -> Column:
    """INSERT / UPDATE / DELETE from a change record's action and update marker."""
    return (
        F.when(is_update & action.isin("INSERT", "DELETE"), "UPDATE")
        .when(action.isin("INSERT", "DELETE"), action)
    )


def suspicion_reason(status: Column, amount_local: Column, p: Params) -> Column:
    """First matching reason on the local-currency amount; null when none applies."""
    return (
        F.when(status == "BLOCKED", "STATUS_BLOCKED")
        .when(
            (amount_local >= p.fraud_round_high_value_usd) & (amount_local % 1000 == 0),
            "ROUND_NUMBER_HIGH_VALUE",
        )
        .when(amount_local >= p.fraud_high_value_usd, "HIGH_VALUE")
    )
