"""Declared schemas of the raw feeds; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
RATE = T.DecimalType(6, 2)
FX_RATE = T.DecimalType(18, 6)
MEASURE = T.DecimalType(38, 4)

SYNCED = "_synced"
DELETED = "_deleted"


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_S, _D, _I, _TS = T.StringType(), T.DateType(), T.IntegerType(), T.TimestampNTZType()

CUSTOMERS = _struct(
    ("customer_id", _S), ("customer_name", _S), ("customer_segment", _S),
    ("risk_category", _S), ("region", _S), ("onboarding_date", _D),
)
ACCOUNTS = _struct(
    ("account_id", _S), ("customer_id", _S), ("account_type", _S),
    ("branch_id", _S), ("account_status", _S), ("open_date", _D),
)
TRANSACTIONS = _struct(
    ("transaction_id", _S), ("account_id", _S), ("transaction_type", _S), ("amount", MONEY),
    ("currency", _S), ("merchant_category", _S), ("transaction_timestamp", _TS),
    ("transaction_status", _S),
)
LOANS = _struct(
    ("loan_id", _S), ("customer_id", _S), ("loan_type", _S), ("loan_amount", MONEY),
    ("interest_rate", RATE), ("emi_amount", MONEY), ("loan_status", _S),
    ("disbursement_date", _D),
)
BRANCHES = _struct(
    ("branch_id", _S), ("branch_name", _S), ("city", _S), ("state", _S), ("region", _S),
)
CALENDAR = _struct(
    ("date_key", _D), ("month", _I), ("quarter", _I), ("year", _I), ("fiscal_period", _S),
)
EXCHANGE_RATES = _struct(("currency", _S), ("rate_to_usd", FX_RATE), ("effective_month", _D))

RAW = {
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "transactions": TRANSACTIONS,
    "loans": LOANS,
    "branches": BRANCHES,
    "calendar": CALENDAR,
}
KEYS = {
    "customers": "customer_id",
    "accounts": "account_id",
    "transactions": "transaction_id",
    "loans": "loan_id",
    "branches": "branch_id",
    "calendar": "date_key",
}

DQ_RESULT = _struct(
    ("check_run_id", _S), ("check_name", _S), ("check_category", _S), ("layer", _S),
    ("target_object", _S), ("severity", _S), ("status", _S), ("observed_value", MEASURE),
    ("threshold_value", MEASURE), ("failed_row_sample", T.ArrayType(_S)),
    ("check_details", _S), ("executed_at", _TS), ("executed_by", _S),
)
RUN_RESULT = _struct(
    ("invocation_id", _S), ("run_started_at", _TS), ("run_completed_at", _TS),
    ("node_name", _S), ("node_type", _S), ("status", _S),
    ("execution_time_s", T.DecimalType(18, 4)), ("message", _S), ("target_name", _S),
)
