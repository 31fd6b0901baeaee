"""Engine parameters. `as_of` stands in for every "now" so that results can be reproduced."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime


@dataclass(frozen=True)
class Params:
    as_of: datetime
    reporting_currency: str = "USD"
    txn_late_arrival_overlap_hours: int = 24
    fraud_high_value_usd: int = 25000
    fraud_round_high_value_usd: int = 50000
    fraud_doc_threshold_usd: int = 50000
    dormant_account_days: int = 365
    rapid_fire_count: int = 3
    rapid_fire_minutes: int = 60
    high_net_revenue_usd: int = 10000
    cdc_interval_minutes: int = 5
    flag_memory_days: int = 400
    fiscal_year_start_month: int = 4

    @property
    def as_of_date(self) -> date:
        return self.as_of.date()


# The transaction types that count as revenue, and the failure states.
REVENUE_TYPES = ("CREDIT", "FEE", "INTEREST")
FAILED_STATUSES = ("FAILED", "REVERSED", "BLOCKED")
DEFAULT_STATUSES = ("DEFAULTED", "WRITTEN_OFF")
ACTIVE_LOAN_STATUSES = ("ACTIVE", "DELINQUENT")
RISK_LEVELS = ("LOW", "MEDIUM", "HIGH")
UNKNOWN = "UNKNOWN"
