import gzip
from datetime import date, datetime
from decimal import Decimal

import pytest

from bankspark import schemas
from bankspark.sources import files, ledger, sinks
from bankspark.sources.calendar import calendar
from tests.util import bag

CSV = '''transaction_id,account_id,transaction_type,amount,currency,merchant_category,transaction_timestamp,transaction_status
T1, A1 ,DEBIT,12.50,USD,"FOOD, DRINK",2024-01-02 03:04:05,COMPLETED
T2,A1,DEBIT,NULL,USD,null,2024-01-02 03:04:05,
T3,A1,DEBIT,abc,USD,X,2024-01-02 03:04:05,COMPLETED
T4,A1,DEBIT,1
T5,A1,DEBIT,1,USD,X,not a time,COMPLETED
T6,A1,DEBIT,1,USD,"say ""hi""",2024-01-02 03:04:05,COMPLETED,extra
'''


@pytest.fixture
def path(tmp_path):
    p = tmp_path / "transactions.csv.gz"
    with gzip.open(p, "wt", encoding="utf-8") as f:
        f.write(CSV)
    return str(p)


def test_csv_scan(spark, path):
    got = {r["transaction_id"]: r for r in files.read_csv(spark, path, schemas.TRANSACTIONS).collect()}
    assert sorted(got) == ["T1", "T2", "T3", "T4", "T5", "T6"]
    assert got["T1"]["account_id"] == "A1" and got["T1"]["amount"] == Decimal("12.50")
    assert got["T1"]["merchant_category"] == "FOOD, DRINK"
    assert got["T1"]["transaction_timestamp"] == datetime(2024, 1, 2, 3, 4, 5)
    assert got["T2"]["amount"] is None and got["T2"]["merchant_category"] is None and got["T2"]["transaction_status"] is None
    assert got["T3"]["amount"] is None and got["T5"]["transaction_timestamp"] is None
    assert got["T4"]["currency"] is None and got["T6"]["merchant_category"] == 'say "hi"'


def test_load_splits_off_bad_rows(spark, path):
    good, rejected = files.load(spark, path, schemas.TRANSACTIONS)
    assert bag(good, "transaction_id") == [("T1",), ("T2",), ("T4",), ("T6",)]
    assert bag(rejected, "transaction_id", "amount", "reject_reason") == [
        ("T3", "abc", "amount"), ("T5", "1", "transaction_timestamp"),
    ]


def test_seed_is_typed_and_strict(spark, tmp_path):
    p = tmp_path / "fx.csv"
    p.write_text("currency,rate_to_usd,effective_month\nINR,0.012050,2024-01-01\n")
    assert bag(files.read_seed(spark, str(p), schemas.EXCHANGE_RATES)) == [("INR", Decimal("0.012050"), date(2024, 1, 1))]
    p.write_text("currency,rate_to_usd,effective_month\nINR,oops,2024-01-01\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_seed(spark, str(p), schemas.EXCHANGE_RATES).collect()


def test_source_by_name_lands_with_audit_columns(spark, tmp_path):
    (tmp_path / "branches.csv").write_text("branch_id,branch_name,city,state,region\nBR1,Défense,Paris,FR,EMEA\n")
    df = files.land(files.source(spark, str(tmp_path), "branches"), datetime(2024, 1, 1))
    assert bag(df, "branch_name", "_synced", "_deleted") == [("Défense", datetime(2024, 1, 1), False)]


def test_reload_log_and_view(spark, tmp_path):
    df = spark.range(3)
    for _ in range(2):
        sinks.reload(df, str(tmp_path / "t"))
        sinks.append_log(df, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    assert spark.read.parquet(str(tmp_path / "log")).count() == 6
    assert sinks.as_view(df, "three").count() == 3
    assert sinks.read_if_exists(spark, str(tmp_path / "none")) is None


def test_fiscal_calendar(spark):
    got = {str(r["date_key"]): r for r in calendar(spark, date(2023, 12, 31), date(2024, 4, 1)).collect()}
    assert len(got) == 93
    assert got["2024-03-31"]["fiscal_period"] == "FY2023-Q4" and got["2024-03-31"]["quarter"] == 1
    assert got["2024-04-01"]["fiscal_period"] == "FY2024-Q1"
    assert got["2023-12-31"]["fiscal_period"] == "FY2023-Q3"


def write_loans(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("currency,rate_to_usd,effective_month\n" + "".join(",".join(r) + "\n" for r in rows))


def test_files_are_loaded_once_and_rejects_name_their_file(spark, tmp_path, monkeypatch):
    landing, home = tmp_path / "landing", str(tmp_path / "home")
    counts = lambda: bag(ledger.load_new(spark, str(landing), schemas.EXCHANGE_RATES, home), "load", "good", "rejected")
    stored = lambda kind: bag(spark.read.parquet(f"{home}/{kind}"), "load", "currency")
    write_loans(landing, "a.csv", [("INR", "0.01", "2024-01-01"), ("EUR", "oops", "2024-01-01")])
    write_loans(landing, "b.csv", [("GBP", "1.2", "2024-01-01")])
    assert counts() == [(0, 2, 1)] and counts() == []
    rejected = spark.read.parquet(f"{home}/rejected").first()
    assert rejected["file"].endswith("/a.csv") and rejected["reject_reason"] == "rate_to_usd"
    write_loans(landing, "c.csv", [("USD", "1", "2024-01-01")])
    # The load breaks off after it has written its rows: it is done again with its own files.
    real = ledger.append_log

    def failing(df, path):
        if path.endswith("done"):
            raise OSError("lost")
        real(df, path)

    monkeypatch.setattr(ledger, "append_log", failing)
    with pytest.raises(OSError):
        counts()
    monkeypatch.undo()
    write_loans(landing, "d.csv", [("CHF", "1.1", "2024-01-01")])
    assert counts() == [(1, 1, 0), (2, 1, 0)] and counts() == []
    assert stored("good") == [(0, "GBP"), (0, "INR"), (1, "USD"), (2, "CHF")] and stored("rejected") == [(0, "EUR")]
    # A file that changed is a new one.
    write_loans(landing, "d.csv", [("CHF", "1.15", "2024-01-01"), ("JPY", "0.1", "2024-01-01")])
    assert counts() == [(3, 2, 0)]
