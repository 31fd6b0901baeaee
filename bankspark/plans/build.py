"""The batch build: stage, check, snapshot, load the fact, write dimensions and marts, check them,
and only then publish.

Staging is written once, so that the deduplicating shuffle runs once and the checks read only
the columns they need; that of the transactions is kept by date and takes only what was synced
since the last build. Source and staging contracts and the quality suite stand before anything
that is kept. The transaction fact is merged incrementally, a slice at a time, and each slice is
tested before it is merged. Everything else is refreshed in full from written inputs into a pending
folder, and takes the place of the published tables together, once its contracts, the business
invariants and the reconciliation hold. Aggregates by month, the tests of the staged transactions and
the loan balances are kept apart from that and follow the partitions that were written.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Collection, Mapping
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from bankspark.config import Params
from bankspark.functions.masks import READER
from bankspark.operators import changes, ops, quality
from bankspark.operators.test_state import refresh_tests
from bankspark.plans import balances, dims, dq, enrich, loans, marts, monthly, serve
from bankspark.plans.staging import (
    refresh_staged_transactions, stage, stg_transactions, stg_transactions_since,
)
from bankspark.session import work_dir
from bankspark.sources import sinks
from bankspark.sources.touched import Touched

FACT_KEY, FACT_DAY, FACT_TS = "transaction_sk", "transaction_date", "transaction_timestamp"


def load_fact(
    spark: SparkSession, path: str, txn: DataFrame, stg: Mapping[str, DataFrame], fx: DataFrame,
    p: Params, grain: str = "month", check: Callable[[DataFrame], None] | None = None,
    before: Callable[[list[str] | None], None] | None = None,
) -> DataFrame:
    """Merge staged transactions into the fact, enriching only those given; touched partitions
    are rewritten, the others left. `check` sees the written slice first and may raise; `before` is
    told which partitions will be written, None for all."""
    enriched = enrich.enrich_transactions(
        txn, stg["accounts"], stg["customers"], stg["branches"], fx, p
    )
    rows = enrich.fct_transactions(enriched, p)
    if check is None:
        sinks.merge_into_table(spark, path, rows, FACT_KEY, FACT_DAY, grain, before=before)
        return sinks.read_clustered(spark, path)
    slice_path = work_dir(spark, "slice")
    try:
        rows.write.parquet(slice_path)
        rows = spark.read.schema(rows.schema).parquet(slice_path)
        check(rows)
        sinks.merge_into_table(spark, path, rows, FACT_KEY, FACT_DAY, grain, before=before)
    finally:
        sinks.discard(spark, slice_path)
    return sinks.read_clustered(spark, path)


def load_staged_fact(
    spark: SparkSession, path: str, stg: Mapping[str, DataFrame], fx: DataFrame, p: Params, grain: str = "month",
    backfill_from: datetime | None = None, loaded_since: datetime | None = None,
    check: Callable[[DataFrame], None] | None = None, before: Callable[[list[str] | None], None] | None = None,
) -> DataFrame:
    """The load from staging: everything the first time; then from the high-water mark, or from
    `backfill_from`, and whatever was synced since `loaded_since`, however late it is."""
    bound = fact_bound(spark, path, p) if backfill_from is None else backfill_from
    txn = changes.incremental_slice(
        stg["transactions"], FACT_TS, backfill_from=bound, loaded="loaded_at", loaded_since=loaded_since)
    return load_fact(spark, path, txn, stg, fx, p, grain, check, before)


def load_fact_from_raw(
    spark: SparkSession, path: str, raw: DataFrame, stg: Mapping[str, DataFrame], fx: DataFrame,
    p: Params, grain: str = "month", backfill_from: datetime | None = None,
) -> DataFrame:
    """The incremental load by itself, staging no more of the raw feed than the slice needs."""
    bound = fact_bound(spark, path, p) if backfill_from is None else backfill_from
    txn = stg_transactions(raw) if bound is None else stg_transactions_since(raw, bound)
    return load_fact(spark, path, txn, stg, fx, p, grain)


def fact_bound(spark: SparkSession, path: str, p: Params) -> datetime | None:
    """High-water mark of the stored fact, read from its last partition; None without one."""
    newest = sinks.newest_rows(spark, path)
    if newest is None:
        return None
    return changes.high_water_mark(newest, FACT_TS, p.txn_late_arrival_overlap_hours)


def build(
    spark: SparkSession, raw: Mapping[str, DataFrame], fx: DataFrame, folder: str, p: Params,
    gate: bool = True, grain: str = "month", user: str = "engine", waive: Collection[str] = (),
    backfill_from: datetime | None = None, loaded_since: datetime | None = None, role: str = READER,
) -> dict[str, DataFrame]:
    """Run everything; returns the written tables by name.

    A failed ERROR check or test stops the build before anything is published, unless `gate` is
    off or the check is one of `waive` (a check's name, or model.column.test). `backfill_from` loads
    the fact again from a moment on, and the daily balances from its day; `loaded_since` adds what
    was synced since then, however late. `role` decides how the names of `customer_360` look.
    """
    invocation, started = uuid.uuid4().hex, datetime.now()
    log: list[tuple] = []
    out: dict[str, DataFrame] = {}
    pending = os.path.join(folder, f"_pending-{invocation}")
    scratch = os.path.join(folder, f"_scratch-{invocation}")
    sinks.finish_publication(spark, folder)

    def step(name: str, kind: str, work: Callable[[], DataFrame]) -> DataFrame:
        t0, status, message = time.monotonic(), "success", ""
        try:
            out[name] = work()
        except Exception as e:
            status, message = "error", str(e) or type(e).__name__
            raise
        finally:
            log.append(
                ops.run_row(invocation, started, name, kind, status, time.monotonic() - t0, message)
            )
        return out[name]

    def audit(name: str, rows: DataFrame) -> DataFrame:
        """Append to an audit table; the rows of this run so far, and those just added."""
        path = os.path.join(folder, "audit", name)
        fresh = sinks.materialize(rows, scratch, f"{name}-{uuid.uuid4().hex[:8]}")
        sinks.append_log(fresh, path)
        return fresh

    def verdicts(rows: list[DataFrame]) -> DataFrame:
        fresh = audit("dq_results", quality.run_suite(rows, p.as_of, user, invocation))
        if gate:
            quality.gate(fresh, waive)
        return fresh

    def judged(tests: DataFrame) -> DataFrame:
        fresh = audit("column_tests", tests.withColumn("check_run_id", F.lit(invocation)))
        if gate:
            quality.gate_tests(fresh, waive)
        return fresh

    def contracts(models: Mapping[str, DataFrame], rules: Mapping[str, list[tuple]]) -> DataFrame:
        return judged(dq.run_contracts(models, rules, p))

    def table(name: str, df: Callable[[], DataFrame], kind: str = "model") -> DataFrame:
        return step(name, kind, lambda: sinks.materialize(df(), pending, name))

    def work() -> None:
        step("source_tests", "test", lambda: contracts({f"raw_{n}": df for n, df in raw.items()}, dq.SOURCE_CONTRACTS))
        staging = os.path.join(folder, "staging")
        staged, written = Touched(spark, os.path.join(folder, "touched", "staging")), Touched(spark, os.path.join(folder, "touched", "fact"))
        txn_path = os.path.join(staging, "stg_transactions")
        stg = {
            name: step(
                f"stg_{name}", "view",
                (lambda: refresh_staged_transactions(
                    spark, txn_path, raw["transactions"], p.txn_late_arrival_overlap_hours, grain, staged.mark))
                if name == "transactions" else
                (lambda name=name, df=df: sinks.materialize(df, staging, f"stg_{name}")),
            )
            for name, df in stage(raw).items()
        }

        def staging_tests() -> DataFrame:
            """Of the transactions only the partitions written since the last run are read."""
            models, big = {f"stg_{n}": df for n, df in stg.items()}, "stg_transactions"
            small = dq.run_contracts(models, {m: t for m, t in dq.STAGING_CONTRACTS.items() if m != big}, p)
            parts, n = staged.since("tests")
            found = refresh_tests(
                spark, os.path.join(folder, "tests", big), txn_path, parts, big, *dq.table_tests(big, models, dq.STAGING_CONTRACTS[big], p))
            fresh = judged(small.unionByName(found))
            staged.reached("tests", n)
            return fresh

        step("staging_tests", "test", staging_tests)
        step("dq_results", "test", lambda: verdicts(dq.bank_checks(raw, stg, p)))
        snap = step(
            "snap_customers", "snapshot",
            lambda: sinks.advance_snapshot(
                spark, os.path.join(folder, "snap_customers"), stg["customers"], "customer_id",
                dims.CUSTOMER_CHECK_COLS, p.as_of,
            ),
        )
        accounts = step(
            "snap_accounts", "snapshot",
            lambda: sinks.advance_snapshot(
                spark, os.path.join(folder, "snap_accounts"), stg["accounts"], "account_id",
                dims.ACCOUNT_CHECK_COLS, p.as_of,
            ),
        )
        customer = table("dim_customer", lambda: dims.dim_customer(stg["customers"], snap))
        account = table("dim_account", lambda: dims.dim_account(stg["accounts"], stg["branches"], p))
        table("dim_account_history", lambda: accounts)
        branch = table("dim_branch", lambda: dims.dim_branch(stg["branches"]))
        table("dim_date", lambda: dims.dim_date(stg["calendar"]))
        table("dim_loan_type", lambda: dims.dim_loan_type(stg["loans"]))
        table("dim_merchant_category", lambda: dims.dim_merchant_category(stg["transactions"]))
        fact_rules = {"fct_transactions": dq.MART_CONTRACTS["fct_transactions"]}

        def check_slice(rows: DataFrame) -> None:
            contracts({"fct_transactions": rows, "dim_account": account}, fact_rules)

        def load() -> DataFrame:
            """From the partitions of the staging that the slice can lie in."""
            path = os.path.join(folder, "fct_transactions")
            bound = fact_bound(spark, path, p) if backfill_from is None else backfill_from
            whole = bound is None or loaded_since is not None
            txn = stg["transactions"] if whole else sinks.read_since(spark, txn_path, bound)
            return load_staged_fact(
                spark, path, {**stg, "transactions": txn}, fx, p, grain, bound, loaded_since, check_slice, written.mark)

        fact = step("fct_transactions", "incremental", load)
        months: dict[str, DataFrame] = {}

        def refresh_months() -> DataFrame:
            months.update(monthly.refresh(spark, os.path.join(folder, "monthly"), os.path.join(folder, "fct_transactions"), written, p, scratch))
            return months["revenue"]

        step("monthly", "incremental", refresh_months)
        loan = table(
            "fct_loans", lambda: loans.fct_loans(loans.amortize_loans(stg["loans"], p), customer, p)
        )
        revenue = table("fct_revenue_monthly", lambda: months["revenue"])
        table("fct_branch_performance", lambda: marts.branch_performance_of(months["branches"], branch))
        table("fct_quarterly_kpis", lambda: marts.quarterly_kpis(revenue))
        profit = table("fct_customer_profitability", lambda: marts.customer_profitability_of(
            customer, marts.customer_txn_total(months["customers"]), loan, p))
        table("fct_loan_portfolio", lambda: loans.loan_portfolio(loan))
        flagged = table("fct_fraud_indicators", lambda: months["flags"])
        table("vw_fraud_daily", lambda: serve.fraud_daily(flagged), "view")
        table("vw_revenue_exec", lambda: serve.revenue_exec(revenue), "view")
        table("vw_customer_360", lambda: serve.customer_360(customer, profit, fact, p, role), "view")
        table("layer_reconciliation", lambda: quality.reconcile(raw, stg), "test")
        others = {m: t for m, t in dq.MART_CONTRACTS.items() if m != "fct_transactions"}
        step("mart_tests", "test", lambda: contracts(out, others))
        step("invariants", "test", lambda: verdicts([
            *dq.invariants(raw, stg, loan, fact, flagged, profit), dq.revenue_reconciles(revenue, fact)]))
        held = step("loan_balances", "incremental", lambda: balances.load_balances(
            spark, os.path.join(folder, "loan_balances"), stg["loans"], p, backfill_from and backfill_from.date(), loaded_since))
        step("loan_balances_daily", "view", lambda: loans.daily_balances(held))
        for name in sinks.publish_all(spark, pending, folder):
            out[name] = spark.read.parquet(os.path.join(folder, name))

    try:
        with ops.run_tagged(spark, "bank", os.path.basename(folder), invocation, user):
            work()
    finally:
        sinks.append_log(ops.log_run(spark, log), os.path.join(folder, "audit", "run_results"))
        sinks.discard(spark, scratch)
        if sinks.READY not in sinks.folder_names(spark, pending):
            sinks.discard(spark, pending)  # otherwise the next build publishes the rest first
    for name in ("dq_results", "column_tests"):
        path = os.path.join(folder, "audit", name)
        out[name] = spark.read.parquet(path).filter(F.col("check_run_id") == invocation)
    return out


def as_of(p: Params, moment: datetime) -> Params:
    """The same parameters at another "now"."""
    return replace(p, as_of=moment)
