from datetime import datetime

import pytest

from pyspark.sql import functions as F

from bankspark.operators.quality import QualityGateError
from bankspark.plans import marts
from bankspark.plans.build import as_of, build, load_staged_fact
from bankspark.plans.staging import stage
from bankspark.sources import standin
from tests.util import bag

LATER = as_of(standin.BANK, datetime(2002, 1, 1))


def test_two_builds(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "bank")
    raw, fx = standin.raw_tables(spark, sf_dir), standin.exchange_rates(spark)
    one = build(spark, raw, fx, folder, standin.BANK, gate=False)
    first_revenue = bag(one["fct_revenue_monthly"])
    n = one["fct_transactions"].count()
    assert n == one["fct_transactions"].select("transaction_sk").distinct().count()

    two = build(spark, raw, fx, folder, LATER, gate=False)
    assert two["fct_transactions"].count() == n
    assert bag(two["fct_revenue_monthly"]) == first_revenue
    # Only the rows within a day of the newest were loaded again.
    again = two["fct_transactions"].filter("loaded_at > '2001-12-31'").count()
    assert 0 < again < n / 10
    # Nothing changed in the masters: every version is still open.
    assert two["snap_customers"].filter("valid_to is not null").count() == 0
    # A fact built by increments gives the marts of one built at once.
    assert bag(marts.revenue_monthly(two["fct_transactions"])) == first_revenue
    # The second build read and wrote the last months' aggregates only.
    ages = {f.parent.name: f.stat().st_mtime_ns for f in (tmp_path / "bank" / "monthly" / "customers").glob("month=*/*.parquet")}
    last = two["fct_transactions"].filter("loaded_at > '2001-12-31'").selectExpr("date_format(transaction_date, \"'month=m'yyyy-MM\")").distinct()
    rewritten = {r[0] for r in last.collect()}
    written = sorted(ages, key=ages.get)[-len(rewritten):]
    assert set(written) == rewritten and len(ages) > 50

    runs = spark.read.parquet(folder + "/audit/run_results")
    assert runs.select("invocation_id").distinct().count() == 2
    assert runs.filter("status <> 'success'").count() == 0
    results = spark.read.parquet(folder + "/audit/dq_results")
    assert results.count() == 2 * (13 + 5)
    assert results.filter("check_name = 'fk_transactions_to_accounts'").first()["failed_row_sample"]
    failing = {r["test"] for r in two["column_tests"].filter("failures > 0 and severity = 'ERROR'").collect()}
    assert failing <= {"accepted_values", "relationships", "between"}


# What the stand-in feeds are known to fail: their regions, dates and ages are not the bank's.
KNOWN = (
    "stg_customers.region.accepted_values", "stg_customers.customer_segment.accepted_values", "stg_customers.onboarding_date.between",
    "stg_loans.customer_id.relationships", "dim_customer.customer_segment.accepted_values", "fct_loans.customer_id.relationships",
    "freshness_raw_transactions", "fk_transactions_to_accounts", "range_transaction_amount_positive",
)


def test_gate_stops_the_build_before_publication(spark, sf_dir, tmp_path):
    folder = tmp_path / "bank"
    raw, fx = standin.raw_tables(spark, sf_dir), standin.exchange_rates(spark)
    with pytest.raises(QualityGateError, match="stg_customers.region.accepted_values"):
        build(spark, raw, fx, str(folder), standin.BANK)
    # Staging, its books and the audit log exist; no snapshot, dimension, fact or mart does.
    assert sorted(p.name for p in folder.iterdir()) == ["audit", "staging", "tests", "touched"]
    runs = spark.read.parquet(str(folder / "audit" / "run_results"))
    assert bag(runs.filter("status = 'error'"), "node_name") == [("staging_tests",)]
    assert {r["node_type"] for r in runs.collect()} == {"view", "test"}
    assert not spark.getTags()


def test_duplicate_branch_publishes_nothing_and_waived_tests_let_pass(spark, sf_dir, tmp_path):
    raw, fx = standin.raw_tables(spark, sf_dir), standin.exchange_rates(spark)
    twice = {**raw, "branches": raw["branches"].union(raw["branches"].limit(1).withColumn("branch_id", F.trim("branch_id")))}
    folder = tmp_path / "bad"
    with pytest.raises(QualityGateError, match="stg_branches.branch_id.unique"):
        build(spark, twice, fx, str(folder), standin.BANK, waive=KNOWN)
    assert sorted(p.name for p in folder.iterdir()) == ["audit", "staging", "tests", "touched"]

    # Rows without a time, or from before any other, are in the first load.
    n = F.substr("transaction_id", F.lit(-3)).cast("int")
    old = F.when(n % 10 == 0, None).when(n % 10 == 1, F.lit(datetime(1899, 12, 31)).cast("timestamp_ntz")).otherwise(F.col("transaction_timestamp"))
    odd = {**raw, "transactions": raw["transactions"].withColumn("transaction_timestamp", old)}
    folder = tmp_path / "good"
    without_time = [f"{c}.not_null" for c in (
        "raw_transactions.transaction_timestamp", "stg_transactions.transaction_timestamp", "fct_revenue_monthly.revenue_month",
        "fct_branch_performance.performance_month", "fct_quarterly_kpis.revenue_quarter")]
    out = build(spark, odd, fx, str(folder), standin.BANK, waive=(*KNOWN, *without_time))
    staged = spark.read.parquet(str(folder / "staging" / "stg_transactions"))
    assert out["fct_transactions"].count() == staged.count()
    assert out["fct_transactions"].filter("transaction_timestamp is null").count() > 0
    assert out["fct_transactions"].filter("transaction_timestamp < '1900-01-01'").count() > 0
    names = {p.name for p in folder.iterdir()}
    assert {"dim_loan_type", "dim_merchant_category", "dim_account_history", "vw_customer_360", "layer_reconciliation", "loan_balances"} <= names
    assert not [n for n in names if "pending" in n]
    assert out["loan_balances_daily"].count() > 0


def test_backfill_loads_again_from_a_moment_on_and_late_rows_by_load_time(spark, sf_dir, tmp_path):
    raw = standin.raw_tables(spark, sf_dir)
    stg = stage(raw)
    fx, path = standin.exchange_rates(spark), str(tmp_path / "fct")
    load_staged_fact(spark, path, stg, fx, standin.BANK)
    fact = load_staged_fact(spark, path, stg, fx, LATER, backfill_from=datetime(2001, 1, 1))
    assert fact.filter("loaded_at > '2001-12-31' and transaction_timestamp < '2001-01-01'").count() == 0
    assert fact.filter("loaded_at = '2001-12-31' and transaction_timestamp >= '2001-01-01'").count() == 0
    since = datetime(1999, 6, 1)
    again = as_of(standin.BANK, datetime(2002, 1, 2))
    fact = load_staged_fact(spark, path, stg, fx, again, loaded_since=since)
    synced = stg["transactions"].filter(F.col("loaded_at") >= F.lit(since).cast("timestamp_ntz")).count()
    assert fact.filter("loaded_at = '2002-01-02'").count() == synced
