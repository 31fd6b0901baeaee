"""The column tests of sources, staging and marts in words, and the SQL that counts their failures.

One line per column: model, column, tests. `in a|b` lists accepted values, `between lo..hi` bounds
(either may be missing; `now` is the reporting day), `in parent.column` a reference, with WARN where
a missing parent only warns. Fixed values: the values that the models accept.
"""

from __future__ import annotations

from bankspark.checks.sql import AS_OF

SOURCE_SPEC = """
raw_customers customer_id; not_null
raw_accounts account_id; not_null
raw_accounts customer_id; not_null
raw_transactions transaction_id; not_null
raw_transactions account_id; not_null
raw_transactions transaction_timestamp; not_null
raw_loans loan_id; not_null
raw_loans customer_id; not_null
raw_branches branch_id; not_null; unique
raw_calendar date_key; not_null; unique
"""

STAGING_SPEC = """
stg_customers customer_sk; not_null; unique
stg_customers customer_id; not_null; unique
stg_customers customer_segment; accepted RETAIL|SMB|CORPORATE|PRIVATE BANKING|HNI|UNKNOWN
stg_customers risk_category; accepted LOW|MEDIUM|HIGH|UNKNOWN
stg_customers region; accepted North America|Emea|Apac|Latam
stg_customers onboarding_date; between 2010-01-01..now
stg_accounts account_sk; not_null; unique
stg_accounts account_id; not_null; unique
stg_accounts customer_id; not_null; refers stg_customers.customer_id WARN
stg_accounts account_type; accepted SAVINGS|CHECKING|CREDIT_CARD|BROKERAGE|WEALTH
stg_accounts account_status; accepted ACTIVE|DORMANT|CLOSED|FROZEN|UNKNOWN
stg_transactions transaction_sk; not_null; unique
stg_transactions transaction_id; not_null; unique
stg_transactions account_id; not_null; refers stg_accounts.account_id WARN
stg_transactions amount; not_null
stg_transactions currency; accepted USD|INR|EUR|GBP
stg_transactions transaction_status; accepted COMPLETED|FAILED|PENDING|REVERSED|BLOCKED|UNKNOWN
stg_transactions transaction_timestamp; not_null
stg_loans loan_sk; not_null; unique
stg_loans loan_id; not_null; unique
stg_loans customer_id; not_null; refers stg_customers.customer_id ERROR
stg_loans loan_status; accepted ACTIVE|CLOSED|DEFAULTED|DELINQUENT|WRITTEN_OFF
stg_loans loan_amount; between 0..
stg_loans is_default_flag; accepted 0|1
stg_branches branch_sk; not_null; unique
stg_branches branch_id; not_null; unique
stg_branches region; not_null
stg_calendar date_sk; not_null; unique
stg_calendar date_key; not_null; unique
"""

MART_SPEC = """
dim_date date_sk; not_null; unique
dim_date date_key; not_null; unique
dim_customer customer_sk; not_null; unique
dim_customer customer_id; not_null; unique
dim_customer customer_segment; accepted RETAIL|SMB|CORPORATE|PRIVATE BANKING|HNI|UNKNOWN
dim_customer risk_category; accepted LOW|MEDIUM|HIGH|UNKNOWN
dim_account account_sk; not_null; unique
dim_account account_id; not_null; unique
dim_account customer_id; refers dim_customer.customer_id WARN
dim_branch branch_sk; not_null; unique
dim_branch branch_id; not_null; unique
fct_transactions transaction_sk; not_null; unique
fct_transactions transaction_id; not_null; unique
fct_transactions account_id; refers dim_account.account_id WARN
fct_transactions amount_usd; not_null
fct_transactions transaction_status; accepted COMPLETED|FAILED|PENDING|REVERSED|BLOCKED|UNKNOWN
fct_revenue_monthly revenue_month; not_null
fct_revenue_monthly net_revenue_usd; not_null
fct_customer_profitability customer_id; not_null; unique
fct_customer_profitability risk_value_segment; accepted HIGH_RISK_HIGH_VALUE|HIGH_RISK_LOW_VALUE|LOW_RISK_HIGH_VALUE|LOW_RISK_LOW_VALUE|MEDIUM_RISK
fct_branch_performance branch_id; not_null
fct_branch_performance performance_month; not_null
fct_quarterly_kpis revenue_quarter; not_null
fct_loans loan_sk; not_null; unique
fct_loans loan_id; not_null; unique
fct_loans customer_id; refers dim_customer.customer_id ERROR
fct_loans outstanding_balance_est; between 0..
fct_loan_portfolio loan_type; not_null
fct_loan_portfolio default_rate_pct; between 0..100
fct_fraud_indicators transaction_sk; not_null; unique
fct_fraud_indicators flag_count; between 1..
"""


def _literal(text: str) -> str:
    return AS_OF if text == "now" else f"DATE '{text}'" if "-" in text else text


def _failures(model: str, column: str, test: str) -> tuple[str, str, str]:
    """(test name, severity, SQL that counts failures) of one test."""
    kind, _, arg = test.partition(" ")
    if kind == "not_null":
        return kind, "ERROR", f"SELECT count(*) FROM {model} WHERE {column} IS NULL"
    if kind == "unique":
        return kind, "ERROR", f"SELECT count(*) FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"
    if kind == "accepted":
        values = ", ".join(v if v.isdigit() else f"'{v}'" for v in arg.split("|"))
        return "accepted_values", "ERROR", f"SELECT count(*) FROM {model} WHERE {column} NOT IN ({values})"
    if kind == "between":
        lo, hi = arg.split("..")
        out = [f"{column} {sign} {_literal(x)}" for sign, x in (("<", lo), (">", hi)) if x]
        return kind, "ERROR", f"SELECT count(*) FROM {model} WHERE {' OR '.join(out)}"
    parent, severity = arg.split(" ")
    table, key = parent.split(".")
    return "relationships", severity, f"SELECT count(*) FROM {model} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {table})"


def spec_sql(spec: str) -> str:
    parts = []
    for line in spec.strip().splitlines():
        where, *tests = line.split("; ")
        model, column = where.split(" ")
        for test in tests:
            name, severity, count = _failures(model, column, test)
            parts.append(f"SELECT '{model}' AS model, '{column}' AS column_name, '{name}' AS test, ({count}) AS failures, '{severity}' AS severity")
    return " UNION ALL ".join(parts)
