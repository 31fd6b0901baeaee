from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from bankspark.operators import changes
from bankspark.plans.balances import load_balances
from bankspark.config import Params
from bankspark.sources import sinks
from tests.util import bag, frame, plan

SCHEMA = "k string, d date, x int"


def rows(spark, *items):
    return frame(spark, SCHEMA, *[(k, date.fromisoformat(d), x) for k, d, x in items])


def test_a_table_keeps_its_grain(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.merge_into_table(spark, path, rows(spark, ("a", "2001-01-05", 1), ("b", "2001-01-20", 2)), "k", "d", "month")
    sinks.merge_into_table(spark, path, rows(spark, ("c", "2001-01-06", 3)), "k", "d", "day")
    sinks.merge_into_table(spark, path, rows(spark, ("a", "2001-01-05", 9), ("z", "2001-02-01", 4)), "k", "d", "day")
    assert [(r[0], r[2]) for r in bag(sinks.read_clustered(spark, path), "k", "d", "x")] == [("a", 9), ("b", 2), ("c", 3), ("z", 4)]
    assert sinks.stored_grain(spark, path) == "month" and sinks.newest_partition(spark, path) == "m2001-02"


class Refusing:
    """A file system that answers no to some renames."""

    def __init__(self, fs, refuse):
        self.fs, self.refuse = fs, refuse

    def __getattr__(self, name):
        return getattr(self.fs, name)

    def rename(self, a, b):
        return False if self.refuse(b.toString()) else self.fs.rename(a, b)


def test_a_refused_rename_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.merge_into_table(spark, path, rows(spark, ("a", "2001-01-05", 1), ("b", "2001-02-20", 2)), "k", "d", "month")
    real = sinks._fs
    monkeypatch.setattr(sinks, "_fs", lambda s, p: Refusing(real(s, p), lambda to: "m2001-01" in to))
    with pytest.raises(OSError, match="could not move"):
        sinks.merge_into_table(spark, path, rows(spark, ("a", "2001-01-05", 7), ("c", "2001-02-21", 3)), "k", "d", "month")
    monkeypatch.undo()
    # The next merge finishes the move first.
    sinks.merge_into_table(spark, path, rows(spark, ("d", "2001-03-01", 4)), "k", "d", "month")
    assert [(r[0], r[2]) for r in bag(sinks.read_clustered(spark, path), "k", "d", "x")] == [("a", 7), ("b", 2), ("c", 3), ("d", 4)]


def test_a_refused_replacement_keeps_the_new_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.materialize(rows(spark, ("a", "2001-01-05", 1)), str(tmp_path), "t")
    real = sinks._fs
    monkeypatch.setattr(sinks, "_fs", lambda s, p: Refusing(real(s, p), lambda to: to.endswith("/t")))
    with pytest.raises(OSError):
        sinks.materialize(rows(spark, ("b", "2001-01-05", 2)), str(tmp_path), "t")
    monkeypatch.undo()
    sinks.finish_replace(spark, path)
    assert bag(spark.read.parquet(path), "k") == [("b",)]


def test_only_a_missing_table_is_no_table(spark, tmp_path):
    assert sinks.read_if_exists(spark, str(tmp_path / "none")) is None
    (tmp_path / "empty").mkdir()
    assert sinks.read_if_exists(spark, str(tmp_path / "empty")) is None
    (tmp_path / "rotten").mkdir()
    (tmp_path / "rotten" / "part-0.parquet").write_text("this is no parquet file at all")
    with pytest.raises(Exception):
        sinks.read_if_exists(spark, str(tmp_path / "rotten"))


def test_no_stored_time_no_bound(spark):
    src = frame(spark, "k int, t timestamp_ntz", (1, None), (2, datetime(1899, 1, 1)), (3, datetime(2024, 1, 1)))
    assert changes.high_water_mark(src.limit(0), "t", 24) is None
    assert changes.incremental_slice(src, "t", src.limit(0)).count() == 3
    assert changes.incremental_slice(src, "t").count() == 3
    assert bag(changes.incremental_slice(src, "t", src, 24), "k") == [(3,)]


LOANS = "loan_sk string, loan_id string, loan_type string, customer_id string, loan_amount decimal(18,2), emi_amount decimal(18,2), disbursement_date date"


def test_daily_balances_grow_by_month_and_can_be_filled_back(spark, tmp_path):
    from decimal import Decimal as D

    from bankspark.plans.loans import daily_balances, loan_balances_daily

    one = ("s1", "l1", "AUTO", "c", D("1000"), D("100"), date(2024, 1, 15))
    two = ("s2", "l2", "AUTO", "c", D("500"), None, date(2024, 2, 10))
    future = ("s3", "l3", "AUTO", "c", D("500"), D("5"), date(2025, 2, 10))
    loans, late = frame(spark, LOANS, one, future), frame(spark, LOANS, one, two, future)
    path = str(tmp_path / "balances")
    at = lambda *d: Params(as_of=datetime(*d))
    load_balances(spark, path, loans, at(2024, 2, 20))
    january = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "balances" / "balance_month=2024-01-01").iterdir()}
    load_balances(spark, path, loans, at(2024, 4, 2))
    assert january == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "balances" / "balance_month=2024-01-01").iterdir()}
    cols = ["loan_id", "balance_date", "outstanding_balance"]
    days = lambda df: bag(daily_balances(df), *cols)
    assert days(spark.read.parquet(path)) == bag(loan_balances_daily(loans, at(2024, 4, 2)), *cols)
    got = days(load_balances(spark, path, late, at(2024, 4, 2), backfill_from=date(2024, 2, 10)))
    assert got == bag(loan_balances_daily(late, at(2024, 4, 2)), *cols)
    held = load_balances(spark, path, late, at(2024, 4, 2))
    assert got == days(held) and held.count() == 4 + 3
    # A week is read from its months only; a loan-month is one stored row.
    week = daily_balances(held, date(2024, 2, 27), date(2024, 3, 2))
    assert bag(week, *cols) == [r for r in got if date(2024, 2, 27) <= r[1] <= date(2024, 3, 2)]
    assert {f.split("balance_month=")[1][:7] for f in week.inputFiles()} >= {"2024-02"} and "PartitionFilters: [isnotnull(balance_month" in plan(week)


def test_changed_and_vanished_loans_leave_the_stored_balances(spark, tmp_path):
    from decimal import Decimal as D

    from bankspark.plans.balances import stored_months
    from bankspark.plans.loans import daily_balances, loan_balances_daily

    cols = ["loan_id", "balance_date", "outstanding_balance"]
    loan = lambda i, emi, start, loaded: ("s" + i, "l" + i, "AUTO", "c", D("1000"), D(emi), start, loaded)
    schema, path, p = LOANS + ", loaded_at timestamp_ntz", str(tmp_path / "balances"), Params(as_of=datetime(2024, 5, 3))
    old = datetime(2024, 5, 1)
    first = [loan("1", "100", date(2024, 1, 15), old), loan("2", "50", date(2024, 3, 1), old)]
    load_balances(spark, path, frame(spark, schema, *first), p)
    # The instalment of loan 2 changes: its months follow, those before its start are left alone.
    january = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "balances" / "balance_month=2024-01-01").iterdir()}
    now = frame(spark, schema, first[0], loan("2", "70", date(2024, 3, 1), datetime(2024, 5, 3)))
    got = load_balances(spark, path, now, p, loaded_since=datetime(2024, 5, 2))
    assert bag(daily_balances(got), *cols) == bag(loan_balances_daily(now, p), *cols)
    assert january == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "balances" / "balance_month=2024-01-01").iterdir()}
    # Loan 1 was entered by mistake: from its start on, months that nobody has go.
    left = now.filter("loan_id = 'l2'")
    got = load_balances(spark, path, left, p, backfill_from=date(2024, 1, 15))
    assert bag(daily_balances(got), *cols) == bag(loan_balances_daily(left, p), *cols)
    assert [m.month for m in stored_months(spark, path)] == [3, 4, 5]


def test_months_of_loans_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Only the loans are shuffled; every task writes all months of its own."""
    from decimal import Decimal as D

    from bankspark.plans import balances
    from bankspark.plans.loans import daily_balances, loan_balances_daily

    monkeypatch.setattr(balances, "ROWS_PER_TASK", 50)
    p, path = Params(as_of=datetime(2024, 4, 2)), str(tmp_path / "balances")
    loans = frame(spark, LOANS, *[(f"s{i}", f"l{i}", "AUTO", "c", D(1000 + i), D(100), date(2023, 1 + i % 12, 15)) for i in range(60)])
    shown = plan(balances.stored_rows(loans, p, None))
    assert "Exchange" not in shown[:shown.index("Generate")] and "Exchange" in shown
    cols = ["loan_id", "balance_date", "outstanding_balance"]
    held = load_balances(spark, path, loans, p)
    assert bag(daily_balances(held), *cols) == bag(loan_balances_daily(loans, p), *cols)
    assert len(list((tmp_path / "balances" / "balance_month=2024-04-01").glob("*.zstd.parquet"))) > 1
