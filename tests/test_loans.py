from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

from bankspark.config import Params
from bankspark.plans import loans
from tests.util import bag, frame

P = Params(as_of=datetime(2024, 6, 15))
SCHEMA = (
    "loan_sk string, loan_id string, customer_id string, loan_type string, loan_amount decimal(18,2), "
    "interest_rate decimal(6,2), emi_amount decimal(18,2), loan_status string, is_default_flag int, "
    "is_delinquent_flag int, is_active_flag int, disbursement_date date, loaded_at timestamp_ntz"
)


def loan(lid, amount, emi, start, status="ACTIVE", default=0):
    d = Decimal
    return (lid, lid, "C1", "HOME", d(amount), d("12.00"), None if emi is None else d(emi), status, default, 0, 1, start, None)


def book(spark):
    return frame(
        spark, SCHEMA,
        loan("L1", "1200.00", "100.00", date(2024, 1, 31)),     # 5 boundaries, 12 instalments
        loan("L2", "100.00", "100.00", date(2020, 1, 1)),       # paid off
        loan("L3", "1000.00", None, date(2024, 1, 1)),          # no instalment
        loan("L4", "1000.00", "0.00", date(2024, 1, 1)),        # zero instalment
        loan("L5", "1200.00", "100.00", date(2024, 8, 1)),      # starts in the future
    )


def test_amortisation(spark):
    got = bag(
        loans.amortize_loans(book(spark), P), "loan_id", "months_since_disbursement",
        "loan_tenure_months_estimate", "effective_months_paid", "estimated_total_repaid", "outstanding_balance_est",
    )
    d = Decimal
    assert got == [
        ("L1", 5, 12, 5, d("500.00"), d("700.00")),
        ("L2", 53, 1, 1, d("100.00"), d("0.00")),
        ("L3", 5, None, None, None, None),
        ("L4", 5, None, None, None, None),
        ("L5", -2, 12, -2, d("-200.00"), d("1400.00")),
    ]


def test_daily_balances_agree_with_amortisation_on_every_day(spark):
    daily = loans.loan_balances_daily(book(spark), P)
    got = {(r["loan_id"], r["balance_date"]): r["outstanding_balance"] for r in daily.collect()}
    assert ("L5", date(2024, 8, 1)) not in got
    assert min(d for (i, d) in got if i == "L1") == date(2024, 1, 31)
    assert sum(1 for (i, _) in got if i == "L1") == (date(2024, 6, 15) - date(2024, 1, 31)).days + 1
    for day in (date(2024, 1, 31), date(2024, 2, 1), date(2024, 2, 29), date(2024, 6, 1), date(2024, 6, 15)):
        at = loans.amortize_loans(book(spark), replace(P, as_of=datetime(day.year, day.month, day.day)))
        for r in at.filter("loan_id in ('L1', 'L2', 'L3')").collect():
            assert got[(r["loan_id"], day)] == r["outstanding_balance_est"]
    day = date(2024, 1, 31)
    while day <= date(2024, 6, 15):
        assert ("L1", day) in got
        day += timedelta(days=1)


def test_default_rate_by_principal_and_by_count(spark):
    rows = frame(
        spark, SCHEMA, loan("L1", "900.00", "1.00", date(2024, 1, 1), "DEFAULTED", 1), loan("L2", "100.00", "1.00", date(2024, 1, 1)),
    )
    assert loans.default_rate(rows, ["loan_type"]).first()["default_rate_pct"] == Decimal("90.00")
    assert loans.default_rate(rows, ["loan_type"], "count").first()["default_rate_pct"] == Decimal("50.00")
