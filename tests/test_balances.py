from datetime import date, datetime
from decimal import Decimal as D

from pyspark.sql import functions as F

from bankspark.checks import marts
from bankspark.config import Params
from bankspark.functions.cleanse import surrogate_key
from bankspark.plans import balances
from bankspark.plans.loans import balance_intervals, daily_balances, loan_balances_daily
from tests.util import bag, final_plan, frame

LOANS = "loan_sk string, loan_id string, loan_type string, customer_id string, loan_amount decimal(18,2), emi_amount decimal(18,2), disbursement_date date"
P = Params(as_of=datetime(2024, 4, 2))
DAYS = ["loan_sk", "loan_id", "loan_type", "customer_id", "balance_date", "outstanding_balance"]


def book(spark, n=3000, own_key=False):
    rows = frame(spark, LOANS, *[
        (f"s{i}", f"L{i:06d}", "AUTO" if i % 3 else "GOLD", f"C{i * 7919 % 5000:05d}", D(1000 + i), D(90 + i % 50), date(2023, 1 + i % 12, 15))
        for i in range(n)])
    return rows if own_key else rows.withColumn("loan_sk", surrogate_key(F.col("loan_id")))


def size(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_a_stored_month_of_a_loan_takes_few_bytes(spark, tmp_path):
    """The key that is made of the id is not stored with every month, and comes back; one of its own is."""
    loans, path = book(spark), str(tmp_path / "t")
    held = balances.load_balances(spark, path, loans, P)
    assert bag(daily_balances(held), *DAYS) == bag(loan_balances_daily(loans, P), *DAYS)
    assert spark.read.parquet(path).filter("loan_sk is not null").isEmpty()
    assert size(tmp_path / "t") < 12 * held.count()
    mixed = loans.limit(5).union(book(spark, 9, own_key=True).filter("loan_id > 'L000004'"))
    held = balances.load_balances(spark, str(tmp_path / "own"), mixed, P)
    assert bag(held.select("loan_id", "loan_sk").distinct()) == bag(mixed.select("loan_id", "loan_sk"))


def test_the_months_of_a_loan_meet_without_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(balances, "ROWS_PER_TASK", 5000)
    loans = book(spark)
    folded = marts._per_loan(balances.load_balances(spark, str(tmp_path / "t"), loans, P))
    shown = final_plan(folded)
    assert "Bucketed: true" in shown and "Exchange" not in shown
    daily = loan_balances_daily(loans, P)
    day, balance = F.col("balance_date"), F.col("outstanding_balance")
    want = daily.groupBy("loan_id", "loan_type").agg(
        F.count("*"), F.count(balance), F.min(day), F.max(day), F.sum(balance),
        F.sum((balance * 100).cast("bigint") % 1000003 * (F.date_diff(day, F.lit("1990-01-01").cast("date")) % 10007)))
    assert bag(folded) == bag(want)


def test_sums_of_the_greatest_balances_are_exact(spark, tmp_path):
    amount, emi = D("9999999999999999.99"), D("10000000000.00")
    loans = frame(spark, LOANS, ("s1", "l1", "AUTO", "c", amount, emi, date(2023, 1, 1)), ("s2", "l2", "AUTO", "c", amount, None, date(2023, 1, 1)))
    got = marts._per_loan(balances.load_balances(spark, str(tmp_path / "t"), loans, P))
    want = loan_balances_daily(loans, P).groupBy("loan_id").agg(F.sum("outstanding_balance"))
    assert bag(got, "loan_id", "outstanding_usd") == bag(want)


def test_a_table_without_buckets_is_brought_into_them(spark, tmp_path):
    """Its months stay as they are, even where the loans would give others now."""
    path, old = str(tmp_path / "t"), book(spark, 200, own_key=True)
    p = Params(as_of=datetime(2024, 3, 10))
    balance_intervals(old, p).write.partitionBy("balance_month").parquet(path)
    changed = old.withColumn("emi_amount", F.lit(5).cast("decimal(18,2)"))
    held = balances.load_balances(spark, path, changed, P)
    march = date(2024, 3, 1)
    want = loan_balances_daily(old, p).filter(F.col("balance_month") < march).union(loan_balances_daily(changed, P, march))
    assert bag(daily_balances(held), *DAYS) == bag(want, *DAYS)
    assert balances.stored_months(spark, path)[-1] == date(2024, 4, 1)


def test_a_backfill_writes_a_few_months_at_once(spark, tmp_path, monkeypatch):
    """So that not all the months it replaces lie beside the new ones until it ends."""
    monkeypatch.setattr(balances, "MONTHS_AT_ONCE", 2)
    path, old, written = str(tmp_path / "t"), book(spark, 200, own_key=True), []
    p = Params(as_of=datetime(2024, 2, 10))
    balances.load_balances(spark, path, old.filter("loan_id != 'L000003'"), p)
    make = balances.stored_rows
    monkeypatch.setattr(balances, "stored_rows", lambda loans, p, since, n=None: written.append((since, p.as_of_date)) or make(loans, p, since, n))
    held = balances.load_balances(spark, path, old, P, backfill_from=date(2023, 9, 5))
    spans = sorted(set(written) - {(date(2023, 9, 5), P.as_of_date)})
    assert spans == [(date(2023, 9, 5), date(2023, 10, 31)), (date(2023, 11, 1), date(2023, 12, 31)), (date(2024, 1, 1), P.as_of_date)]
    want = loan_balances_daily(old, P).filter("loan_id != 'L000003' or balance_month >= '2023-09-01'")
    assert bag(daily_balances(held), *DAYS) == bag(want, *DAYS)
    # Up to an earlier day than the table reaches, the months behind it go.
    held = balances.load_balances(spark, path, old, p, backfill_from=date(2023, 9, 5))
    assert bag(daily_balances(held), *DAYS) == bag(want.filter("balance_date <= '2024-02-10'"), *DAYS)
