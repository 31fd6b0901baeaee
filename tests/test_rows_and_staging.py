from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from bankspark.operators.rows import latest_per_key, rank_by, top_n
from bankspark.plans import staging
from tests.util import bag, frame, plan, ts

RAW_CUSTOMER = (
    "customer_id string, customer_name string, customer_segment string, risk_category string, "
    "region string, onboarding_date date, _synced timestamp_ntz, _deleted boolean"
)


def customer(cid, name="A B", segment="Retail", risk="LOW", synced="2024-01-01", deleted=False):
    return (cid, name, segment, risk, "EMEA", date(2020, 1, 1), ts(synced), deleted)


def test_latest_sync_wins_and_ties_are_broken(spark):
    df = frame(
        spark, "k string, s timestamp_ntz, v int",
        ("a", ts("2024-01-01"), 1), ("a", ts("2024-01-02"), 2), ("b", ts("2024-01-01"), 5),
        ("b", ts("2024-01-01"), 7), ("c", ts("2024-01-01"), 1), ("c", None, 9), (None, ts("2024-01-01"), 3),
    )
    got = bag(latest_per_key(df, "k", "s", ["v"]), "k", "v")
    assert got == sorted([("a", 2), ("b", 7), ("c", 9), (None, 3)], key=repr)


def test_hot_key_is_pruned_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_micros(F.col("id")).cast("timestamp_ntz").alias("s"), "id",
    )
    out = latest_per_key(df, "k", "s")
    text = plan(out)
    assert text.count("WindowGroupLimit") == 2
    assert out.filter("k = 'hot'").collect()[0]["id"] == 29997
    assert out.count() == 20001


def test_customer_dirt(spark):
    raw = frame(
        spark, RAW_CUSTOMER,
        customer(" c00017 ", "  priya patel  "), customer("C00023", segment=None), customer("C00041", risk="high"),
        customer("C00005", "Old Name", synced="2024-01-01"), customer("c00005", "New Name", synced="2024-01-02"),
        customer("C00099", deleted=True), customer(None), customer("C00042", risk="odd"),
    )
    got = {r["customer_id"]: r for r in staging.stg_customers(raw).collect()}
    assert sorted(got) == ["C00005", "C00017", "C00023", "C00041", "C00042"]
    assert got["C00017"]["customer_name"] == "Priya Patel"
    assert got["C00023"]["customer_segment"] == "UNKNOWN"
    assert got["C00041"]["risk_category"] == "HIGH" and got["C00042"]["risk_category"] == "UNKNOWN"
    assert got["C00005"]["customer_name"] == "New Name"
    assert got["C00005"]["region"] == "Emea"


def test_transactions_drop_null_amounts_and_duplicates(spark):
    schema = (
        "transaction_id string, account_id string, transaction_type string, amount decimal(18,2), currency string, "
        "merchant_category string, transaction_timestamp timestamp_ntz, transaction_status string, "
        "_synced timestamp_ntz, _deleted boolean"
    )

    def txn(tid, amount, status="COMPLETED"):
        return (tid, "a1", "debit", amount, "usd", "x", ts("2024-03-05 23:59:59"), status, ts("2024-03-06"), False)

    raw = frame(spark, schema, txn("t1", Decimal("5.00")), txn("t1", Decimal("5.00")), txn("t2", None),
                txn("t3", Decimal("0.00"), None))
    got = bag(staging.stg_transactions(raw), "transaction_id", "amount", "transaction_status", "transaction_date")
    assert got == [("T1", Decimal("5.00"), "COMPLETED", date(2024, 3, 5)), ("T3", Decimal("0.00"), "UNKNOWN", date(2024, 3, 5))]
    warehouse = bag(staging.stg_transactions(raw, staging.WAREHOUSE), "transaction_id", "amount")
    assert warehouse == [("T1", Decimal("5.00")), ("T3", None)]


def test_warehouse_loans_keep_duplicates(spark):
    schema = (
        "loan_id string, customer_id string, loan_type string, loan_amount decimal(18,2), interest_rate decimal(6,2), "
        "emi_amount decimal(18,2), loan_status string, disbursement_date date, _synced timestamp_ntz, _deleted boolean"
    )
    row = ("l1", "c1", "home", Decimal("1"), Decimal("1"), Decimal("1"), "delinquent", date(2024, 1, 1), ts("2024-01-01"), False)
    raw = frame(spark, schema, row, row)
    assert staging.stg_loans(raw).count() == 1
    twin = staging.stg_loans(raw, staging.WAREHOUSE)
    assert twin.count() == 2 and "is_active_flag" not in twin.columns
    one = staging.stg_loans(raw).first()
    assert (one["is_default_flag"], one["is_delinquent_flag"], one["is_active_flag"]) == (0, 1, 1)


def test_calendar_attributes(spark):
    raw = frame(spark, "date_key date, month int, quarter int, year int, fiscal_period string, _synced timestamp_ntz, _deleted boolean",
                (date(2024, 3, 31), 3, 1, 2024, "FY2023-Q4", ts("2024-01-01"), False))
    r = staging.stg_calendar_dim(raw).first()
    assert (r["day_of_week"], r["day_name"], r["month_name"], r["is_weekend"]) == (0, "Sun", "Mar", 1)
    assert (r["month_end_date"], r["quarter_end_date"]) == (date(2024, 3, 31), date(2024, 3, 31))


def test_rank_and_top(spark):
    df = frame(spark, "k string, v int", ("a", 3), ("b", 3), ("c", 1), ("d", None))
    assert bag(rank_by(df, "v"), "k", "rank") == [("a", 1), ("b", 1), ("c", 3), ("d", 4)]
    assert [r["k"] for r in top_n(df, 2, "v", ["k"]).collect()] == ["a", "b"]
