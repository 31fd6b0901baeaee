"""The bank's data-quality suite and the column contracts of its models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from bankspark.config import Params
from bankspark.functions import rules
from bankspark.functions.dates import lit_date, lit_ts
from bankspark.operators import quality as Q
from bankspark.operators.joins import orphans
from bankspark.operators.quality import ERROR, INFO, WARN, Check
from bankspark.plans.marts import completed

FRESH_DETAIL = "Max lag (minutes) since last sync"
MASTERS = ("customers", "accounts", "loans", "branches")

# Warn and error limits in minutes per source; the default is for the others.
SOURCE_LIMITS = {"customers": (120, 720), "transactions": (30, 120)}
DEFAULT_LIMITS = (360, 1440)


def freshness_checks(raw: Mapping[str, DataFrame], p: Params) -> list[DataFrame]:
    """Transactions within two hours, master data within a day."""

    def check(name: str, minutes: int, severity: str) -> DataFrame:
        c = Check(f"freshness_raw_{name}", "FRESHNESS", "RAW", f"raw_{name}", severity, FRESH_DETAIL)
        return Q.check_freshness(raw[name], c, minutes, p.as_of)

    return [check("transactions", 120, ERROR), *[check(n, 1440, WARN) for n in MASTERS]]


def source_freshness(raw: Mapping[str, DataFrame], p: Params) -> DataFrame:
    out = None
    for name in (*MASTERS, "transactions", "calendar"):
        warn, error = SOURCE_LIMITS.get(name, DEFAULT_LIMITS)
        row = Q.source_freshness(raw[name], name, warn, error, p.as_of)
        out = row if out is None else out.unionByName(row)
    return out


def uniqueness_checks(raw: Mapping[str, DataFrame], stg: Mapping[str, DataFrame]) -> list[DataFrame]:
    live = raw["customers"].filter(~F.coalesce(F.col("_deleted"), F.lit(False)))
    return [
        Q.check_unique(
            live,
            Check("uniqueness_raw_customer_id", "UNIQUENESS", "RAW", "raw_customers", INFO,
                  "Duplicate customer ids in RAW (deduplicated downstream)"),
            "customer_id",
        ),
        Q.check_unique(
            stg["transactions"],
            Check("uniqueness_stg_transaction_id", "UNIQUENESS", "STG", "stg_transactions", ERROR,
                  "Duplicate transaction ids after deduplication"),
            "transaction_id",
        ),
    ]


def referential_checks(stg: Mapping[str, DataFrame]) -> list[DataFrame]:
    """With samples of the rows whose parent is missing."""

    def check(child: str, parent: str, key: str, own: str, c: Check, tolerance: int = 0) -> DataFrame:
        verdict = Q.check_fk(stg[child], stg[parent], c, key, tolerance=tolerance)
        lost = orphans(stg[child], stg[parent], key)
        return Q.with_failed_samples(verdict, {c.name: Q.failed_sample(lost, None, [own])})

    return [
        check("accounts", "customers", "customer_id", "account_id",
              Check("fk_accounts_to_customers", "REFERENTIAL", "STG", "stg_accounts", WARN,
                    "Accounts whose customer is missing (5 tolerated)"), tolerance=5),
        check("transactions", "accounts", "account_id", "transaction_id",
              Check("fk_transactions_to_accounts", "REFERENTIAL", "STG", "stg_transactions", ERROR,
                    "Transactions whose account is missing")),
    ]


def range_checks(stg: Mapping[str, DataFrame], p: Params) -> list[DataFrame]:
    """One scan per table for the counts; the samples of failing rows stop at a few rows a task."""

    def checks(table: str, key: str, tests: list[tuple[Check, Column]]) -> DataFrame:
        samples = {c.name: Q.failed_sample(stg[table], bad, [key]) for c, bad in tests}
        return Q.with_failed_samples(Q.check_predicates(stg[table], tests), samples)

    return [
        checks("transactions", "transaction_id", [
            (Check("range_transaction_amount_positive", "RANGE", "STG", "stg_transactions", ERROR,
                   "Transactions with amount <= 0"), F.col("amount") <= 0),
            (Check("range_transaction_date_not_future", "RANGE", "STG", "stg_transactions", WARN,
                   "Transactions later than now"),
             F.col("transaction_timestamp") > lit_ts(p.as_of)),
        ]),
        checks("loans", "loan_id", [
            (Check("range_loan_interest_rate", "RANGE", "STG", "stg_loans", WARN,
                   "Loans with an interest rate outside [0, 30] percent"),
             (F.col("interest_rate") < 0) | (F.col("interest_rate") > 30)),
        ]),
    ]


def volume_checks(stg: Mapping[str, DataFrame], as_of: date) -> list[DataFrame]:
    c = Check("volume_daily_transactions", "VOLUME", "STG", "stg_transactions", WARN,
              "Yesterday's rows against the mean of seven days, 70 % band")
    return [Q.check_volume(stg["transactions"], c, "transaction_date", as_of)]


def bank_checks(raw: Mapping[str, DataFrame], stg: Mapping[str, DataFrame], p: Params) -> list[DataFrame]:
    """All checks in their fixed order: freshness, uniqueness, references, ranges, volume."""
    return [
        *freshness_checks(raw, p), *uniqueness_checks(raw, stg), *referential_checks(stg),
        *range_checks(stg, p), *volume_checks(stg, p.as_of_date),
    ]


def run_bank_suite(
    raw: Mapping[str, DataFrame], stg: Mapping[str, DataFrame], p: Params, run_id: str | None = None,
    executed_by: str = "engine",
) -> DataFrame:
    return Q.run_suite(bank_checks(raw, stg, p), p.as_of, executed_by, run_id)


def revenue_variance(revenue: DataFrame, fct: DataFrame) -> DataFrame:
    """The net revenue of the mart and of the fact's rows, if they differ."""
    kind, usd = F.col("transaction_type"), F.col("amount_usd")
    zero = F.lit(0).cast("decimal(18,2)")
    value = F.sum(F.when(rules.is_revenue(kind), usd).otherwise(zero)) - F.sum(
        F.when(kind == "REFUND", usd).otherwise(zero)
    )
    return Q.assert_reconciles(
        revenue, F.sum("net_revenue_usd").cast("decimal(28,2)"), fct, value.cast("decimal(28,2)")
    )


def revenue_reconciles(revenue: DataFrame, fct: DataFrame) -> DataFrame:
    """The revenue mart against the completed rows of the fact, as a verdict row."""
    check = Check("revenue_reconciles", "INVARIANT", "MART", "fct_revenue_monthly", ERROR)
    return Q.check_invariant(revenue_variance(revenue, completed(fct)), check, F.lit(True))


def invariants(
    raw: Mapping[str, DataFrame], stg: Mapping[str, DataFrame], loans: DataFrame, fct: DataFrame,
    fraud: DataFrame, profit: DataFrame,
) -> list[DataFrame]:
    """Named business invariants, as verdict rows."""
    ids = raw["customers"].filter(~F.col("_deleted")).agg(
        F.countDistinct(F.upper(F.trim("customer_id")))
    )
    staged = stg["customers"].agg(F.count(F.lit(1)).alias("got")).withColumn("expected", ids.scalar())
    blocked = fct.filter(F.col("is_blocked_flag") == 1)

    def check(name: str, target: str) -> Check:
        return Check(name, "INVARIANT", "MART", target, ERROR)

    return [
        Q.check_invariant(staged, check("staged_rows_equal_raw_ids", "stg_customers"), F.col("got") != F.col("expected")),
        Q.check_invariant(loans, check("outstanding_not_negative", "fct_loans"), F.col("outstanding_balance_est") < 0),
        Q.check_fk(blocked, fraud, check("blocked_is_flagged", "fct_fraud_indicators"), "transaction_sk"),
        Q.check_invariant(profit, check("every_customer_has_bucket", "fct_customer_profitability"), F.col("risk_value_segment").isNull()),
    ]


# --- column contracts -----------------------------------------------------------------------

# The values that the models accept.
SEGMENTS = ("RETAIL", "SMB", "CORPORATE", "PRIVATE BANKING", "HNI", "UNKNOWN")
RISKS = ("LOW", "MEDIUM", "HIGH", "UNKNOWN")
REGIONS = ("North America", "Emea", "Apac", "Latam")
ACCOUNT_TYPES = ("SAVINGS", "CHECKING", "CREDIT_CARD", "BROKERAGE", "WEALTH")
ACCOUNT_STATUSES = ("ACTIVE", "DORMANT", "CLOSED", "FROZEN", "UNKNOWN")
CURRENCIES = ("USD", "INR", "EUR", "GBP")
TXN_STATUSES = ("COMPLETED", "FAILED", "PENDING", "REVERSED", "BLOCKED", "UNKNOWN")
LOAN_STATUSES = ("ACTIVE", "CLOSED", "DEFAULTED", "DELINQUENT", "WRITTEN_OFF")
RISK_VALUE = (
    "HIGH_RISK_HIGH_VALUE", "HIGH_RISK_LOW_VALUE", "LOW_RISK_HIGH_VALUE", "LOW_RISK_LOW_VALUE",
    "MEDIUM_RISK",
)

# model -> (test, column, argument). A bound is a number or an ISO date; None leaves it open.
# The argument of `relationships` is (parent model, parent column, severity).
STAGING_CONTRACTS: dict[str, list[tuple]] = {
    "stg_customers": [
        ("not_null", "customer_sk"), ("unique", "customer_sk"),
        ("not_null", "customer_id"), ("unique", "customer_id"),
        ("accepted_values", "customer_segment", SEGMENTS),
        ("accepted_values", "risk_category", RISKS),
        ("accepted_values", "region", REGIONS),
        ("between", "onboarding_date", ("2010-01-01", "as_of")),
    ],
    "stg_accounts": [
        ("not_null", "account_sk"), ("unique", "account_sk"),
        ("not_null", "account_id"), ("unique", "account_id"),
        ("not_null", "customer_id"),
        ("relationships", "customer_id", ("stg_customers", "customer_id", WARN)),
        ("accepted_values", "account_type", ACCOUNT_TYPES),
        ("accepted_values", "account_status", ACCOUNT_STATUSES),
    ],
    "stg_transactions": [
        ("not_null", "transaction_sk"), ("unique", "transaction_sk"),
        ("not_null", "transaction_id"), ("unique", "transaction_id"),
        ("not_null", "account_id"),
        ("relationships", "account_id", ("stg_accounts", "account_id", WARN)),
        ("not_null", "amount"),
        ("accepted_values", "currency", CURRENCIES),
        ("accepted_values", "transaction_status", TXN_STATUSES),
        ("not_null", "transaction_timestamp"),
    ],
    "stg_loans": [
        ("not_null", "loan_sk"), ("unique", "loan_sk"),
        ("not_null", "loan_id"), ("unique", "loan_id"),
        ("not_null", "customer_id"),
        ("relationships", "customer_id", ("stg_customers", "customer_id", ERROR)),
        ("accepted_values", "loan_status", LOAN_STATUSES),
        ("between", "loan_amount", (0, None)),
        ("accepted_values", "is_default_flag", (0, 1)),
    ],
    "stg_branches": [
        ("not_null", "branch_sk"), ("unique", "branch_sk"),
        ("not_null", "branch_id"), ("unique", "branch_id"), ("not_null", "region"),
    ],
    "stg_calendar": [
        ("not_null", "date_sk"), ("unique", "date_sk"),
        ("not_null", "date_key"), ("unique", "date_key"),
    ],
}
MART_CONTRACTS: dict[str, list[tuple]] = {
    "dim_date": [
        ("not_null", "date_sk"), ("unique", "date_sk"),
        ("not_null", "date_key"), ("unique", "date_key"),
    ],
    "dim_customer": [
        ("not_null", "customer_sk"), ("unique", "customer_sk"),
        ("not_null", "customer_id"), ("unique", "customer_id"),
        ("accepted_values", "customer_segment", SEGMENTS),
        ("accepted_values", "risk_category", RISKS),
    ],
    "dim_account": [
        ("not_null", "account_sk"), ("unique", "account_sk"),
        ("not_null", "account_id"), ("unique", "account_id"),
        ("relationships", "customer_id", ("dim_customer", "customer_id", WARN)),
    ],
    "dim_branch": [
        ("not_null", "branch_sk"), ("unique", "branch_sk"),
        ("not_null", "branch_id"), ("unique", "branch_id"),
    ],
    "fct_transactions": [
        ("not_null", "transaction_sk"), ("unique", "transaction_sk"),
        ("not_null", "transaction_id"), ("unique", "transaction_id"),
        ("relationships", "account_id", ("dim_account", "account_id", WARN)),
        ("not_null", "amount_usd"),
        ("accepted_values", "transaction_status", TXN_STATUSES),
    ],
    "fct_revenue_monthly": [("not_null", "revenue_month"), ("not_null", "net_revenue_usd")],
    "fct_customer_profitability": [
        ("not_null", "customer_id"), ("unique", "customer_id"),
        ("accepted_values", "risk_value_segment", RISK_VALUE),
    ],
    "fct_branch_performance": [("not_null", "branch_id"), ("not_null", "performance_month")],
    "fct_quarterly_kpis": [("not_null", "revenue_quarter")],
    "fct_loans": [
        ("not_null", "loan_sk"), ("unique", "loan_sk"),
        ("not_null", "loan_id"), ("unique", "loan_id"),
        ("relationships", "customer_id", ("dim_customer", "customer_id", ERROR)),
        ("between", "outstanding_balance_est", (0, None)),
    ],
    "fct_loan_portfolio": [("not_null", "loan_type"), ("between", "default_rate_pct", (0, 100))],
    "fct_fraud_indicators": [
        ("not_null", "transaction_sk"), ("unique", "transaction_sk"), ("between", "flag_count", (1, None)),
    ],
}
SOURCE_CONTRACTS: dict[str, list[tuple]] = {
    "raw_customers": [("not_null", "customer_id")],
    "raw_accounts": [("not_null", "account_id"), ("not_null", "customer_id")],
    "raw_transactions": [
        ("not_null", "transaction_id"), ("not_null", "account_id"), ("not_null", "transaction_timestamp"),
    ],
    "raw_loans": [("not_null", "loan_id"), ("not_null", "customer_id")],
    "raw_branches": [("not_null", "branch_id"), ("unique", "branch_id")],
    "raw_calendar": [("not_null", "date_key"), ("unique", "date_key")],
}


def _bound(value, p: Params) -> Column | None:
    if value is None:
        return None
    if value == "as_of":
        return lit_date(p.as_of_date)
    return lit_date(date.fromisoformat(value)) if isinstance(value, str) else F.lit(value)


def _row_test(kind: str, column: str, arg, p: Params) -> Q.ColumnTest:
    if kind == "not_null":
        return Q.test_not_null(column)
    if kind == "accepted_values":
        return Q.test_accepted(column, arg)
    return Q.test_between(column, _bound(arg[0], p), _bound(arg[1], p))


def table_tests(
    model: str, models: Mapping[str, DataFrame], tests: Sequence[tuple], p: Params
) -> tuple[list[Q.ColumnTest], list[str], list[Q.Reference]]:
    """A model's contract as row-level tests, unique columns and references."""
    rows = [_row_test(t[0], t[1], t[2] if len(t) > 2 else None, p) for t in tests if t[0] not in ("unique", "relationships")]
    unique = [t[1] for t in tests if t[0] == "unique"]
    references = [Q.Reference(t[1], models[t[2][0]], t[2][1], t[2][2]) for t in tests if t[0] == "relationships"]
    return rows, unique, references


def run_contracts(
    models: Mapping[str, DataFrame], contracts: Mapping[str, list[tuple]], p: Params
) -> DataFrame:
    """Failures of every column test, one row each, with its severity; a table's tests share a scan
    and a shuffle."""
    parts = [Q.run_table_tests(models[model], model, *table_tests(model, models, tests, p)) for model, tests in contracts.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
