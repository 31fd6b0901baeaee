"""Queries: data quality, incremental loads, governance, operations."""

from __future__ import annotations

import os
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from bankspark.checks.context import RUN1, RUN2, Bank, query
from bankspark.checks.spec import MART_SPEC, SOURCE_SPEC, STAGING_SPEC, spec_sql
from bankspark.checks.sql import (
    AS_OF, AS_OF_TS, REVENUE, T1, T2, cents, code, dbl, rdiv, share_pct, sum_if,
)
from bankspark.functions import masks, rules
from bankspark.functions.dates import lit_ts
from bankspark.operators import changes, governance, masks_sql, ops, quality as Q, rows
from bankspark.plans import dims, dq, loans as loan_plans, marts, staging
from bankspark.plans.build import as_of, fact_bound, load_fact_from_raw, load_staged_fact
from bankspark.session import work_dir
from bankspark.sources import sinks, standin
from bankspark.streaming.cdc import SINK_COLS

_VERDICT = ["check_name", "check_category", "layer", "target_object", "severity", "status", "observed_value", "threshold_value", "check_details"]


def _verdicts(checks):
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out.select(*_VERDICT)


def _v(name, category, layer, target, severity, failed, observed, threshold, details, frm):
    return (
        f"SELECT '{name}' AS check_name, '{category}' AS check_category, '{layer}' AS layer, '{target}' AS target_object,"
        f" '{severity}' AS severity, CASE WHEN {failed} THEN 'FAIL' ELSE 'PASS' END AS status,"
        f" CAST({observed} AS DOUBLE) AS observed_value, CAST({threshold} AS DOUBLE) AS threshold_value,"
        f" '{details}' AS check_details FROM ({frm})"
    )


def _fresh(name, limit, severity):
    lag = f"(CAST(floor(epoch({AS_OF_TS}) / 60) AS BIGINT) - CAST(floor(epoch(max(_synced)) / 60) AS BIGINT))"
    return _v(f"freshness_raw_{name}", "FRESHNESS", "RAW", f"raw_{name}", severity, f"lag > {limit}", "lag", limit,
              "Max lag (minutes) since last sync", f"SELECT {lag} AS lag FROM raw_{name}")


_FRESH = " UNION ALL ".join(
    [_fresh("transactions", 120, "ERROR")] + [_fresh(n, 1440, "WARN") for n in ("customers", "accounts", "loans", "branches")]
)
_UNIQUE = " UNION ALL ".join([
    _v("uniqueness_raw_customer_id", "UNIQUENESS", "RAW", "raw_customers", "INFO", "n > 0", "n", 0,
       "Duplicate customer ids in RAW (deduplicated downstream)",
       "SELECT count(*) - count(DISTINCT customer_id) AS n FROM raw_customers WHERE NOT _deleted"),
    _v("uniqueness_stg_transaction_id", "UNIQUENESS", "STG", "stg_transactions", "ERROR", "n > 0", "n", 0,
       "Duplicate transaction ids after deduplication",
       "SELECT count(*) - count(DISTINCT transaction_id) AS n FROM stg_transactions"),
])
_FK = " UNION ALL ".join([
    _v("fk_accounts_to_customers", "REFERENTIAL", "STG", "stg_accounts", "WARN", "n > 5", "n", 5,
       "Accounts whose customer is missing (5 tolerated)",
       "SELECT count(*) AS n FROM stg_accounts a LEFT JOIN stg_customers c USING (customer_id) WHERE c.customer_sk IS NULL"),
    _v("fk_transactions_to_accounts", "REFERENTIAL", "STG", "stg_transactions", "ERROR", "n > 0", "n", 0,
       "Transactions whose account is missing",
       "SELECT count(*) AS n FROM stg_transactions t LEFT JOIN stg_accounts a USING (account_id) WHERE a.account_sk IS NULL"),
])
_RANGE = " UNION ALL ".join([
    _v("range_transaction_amount_positive", "RANGE", "STG", "stg_transactions", "ERROR", "n > 0", "n", 0,
       "Transactions with amount <= 0", "SELECT count(*) AS n FROM stg_transactions WHERE amount <= 0"),
    _v("range_transaction_date_not_future", "RANGE", "STG", "stg_transactions", "WARN", "n > 0", "n", 0,
       "Transactions later than now", f"SELECT count(*) AS n FROM stg_transactions WHERE transaction_timestamp > {AS_OF_TS}"),
    _v("range_loan_interest_rate", "RANGE", "STG", "stg_loans", "WARN", "n > 0", "n", 0,
       "Loans with an interest rate outside [0, 30] percent",
       "SELECT count(*) AS n FROM stg_loans WHERE interest_rate < 0 OR interest_rate > 30"),
])


def _volume(day: str) -> str:
    return _v(
        "volume_daily_transactions", "VOLUME", "STG", "stg_transactions", "WARN",
        "m6 <> 0 AND (y * 1000000 < m6 * 0.3 OR y * 1000000 > m6 * 1.7)", "y",
        dbl(rdiv("m6", "100"), 4), "Yesterday''s rows against the mean of seven days, 70 % band",
        f"""SELECT coalesce(max(CASE WHEN d = {day} - 1 THEN n END), 0) AS y,
          {rdiv(f"sum(CASE WHEN d BETWEEN {day} - 8 AND {day} - 2 THEN n END) * 1000000", f"count(CASE WHEN d BETWEEN {day} - 8 AND {day} - 2 THEN n END)")} AS m6
          FROM (SELECT transaction_date AS d, count(*) AS n FROM stg_transactions WHERE transaction_date >= {day} - 8 GROUP BY 1)""",
    )


@query("dq_freshness", _FRESH)
def _(b: Bank):
    return _verdicts(dq.freshness_checks(b.raw, b.p))


@query("dq_source_freshness", " UNION ALL ".join(
    f"SELECT '{n}' AS source_name, lag AS lag_minutes, CASE WHEN lag > {e} THEN 'ERROR' WHEN lag > {w} THEN 'WARN' ELSE 'PASS' END AS status"
    f" FROM (SELECT CAST(floor(epoch({AS_OF_TS}) / 60) AS BIGINT) - CAST(floor(epoch(max(_synced)) / 60) AS BIGINT) AS lag FROM raw_{n})"
    for n, w, e in (("customers", 120, 720), ("accounts", 360, 1440), ("loans", 360, 1440), ("branches", 360, 1440),
                    ("transactions", 30, 120), ("calendar", 360, 1440))
))
def _(b: Bank):
    return dq.source_freshness(b.raw, b.p)


@query("dq_uniqueness", _UNIQUE)
def _(b: Bank):
    return _verdicts(dq.uniqueness_checks(b.raw, b.stg))


@query("duplicate_count", "SELECT count(*) - count(DISTINCT l_orderkey) AS dup_count FROM lineitem")
def _(b: Bank):
    return Q.duplicate_count(b.table("lineitem"), "l_orderkey")


@query("dq_fk", _FK)
def _(b: Bank):
    return _verdicts(dq.referential_checks(b.stg))


@query("dq_range", _RANGE)
def _(b: Bank):
    return _verdicts(dq.range_checks(b.stg, b.p))


@query("dq_volume", _volume("DATE '2001-07-30'"))
def _(b: Bank):
    return _verdicts(dq.volume_checks(b.stg, date(2001, 7, 30)))


def _sample(name: str, table: str, key: str, bad: str) -> str:
    rows_ = f"SELECT '{{\"{key}\":\"' || {key} || '\"}}' AS j FROM {table} WHERE {bad} ORDER BY {key} LIMIT 5"
    return f"WHEN '{name}' THEN (SELECT coalesce(string_agg(j, '|' ORDER BY j), '') FROM ({rows_}))"


_SAMPLES = "CASE check_name " + " ".join([
    _sample("fk_accounts_to_customers", "stg_accounts", "account_id", "customer_id NOT IN (SELECT customer_id FROM stg_customers)"),
    _sample("fk_transactions_to_accounts", "stg_transactions", "transaction_id", "account_id NOT IN (SELECT account_id FROM stg_accounts)"),
    _sample("range_transaction_amount_positive", "stg_transactions", "transaction_id", "amount <= 0"),
    _sample("range_transaction_date_not_future", "stg_transactions", "transaction_id", f"transaction_timestamp > {AS_OF_TS}"),
    _sample("range_loan_interest_rate", "stg_loans", "loan_id", "interest_rate < 0 OR interest_rate > 30"),
]) + " ELSE '' END"


@query("dq_suite", f"""
  SELECT 'run-1' AS check_run_id, *, {_SAMPLES} AS failed_row_sample, {AS_OF_TS} AS executed_at, 'engine' AS executed_by
  FROM ({' UNION ALL '.join([_FRESH, _UNIQUE, _FK, _RANGE, _volume(AS_OF)])})""")
def _(b: Bank):
    return dq.run_bank_suite(b.raw, b.stg, b.p, "run-1")


@query("dq_failed_sample", "SELECT 'negative_balance' AS check_name, 'FAIL' AS status, CAST(count(*) AS DOUBLE) AS observed_value, (SELECT string_agg(j, '|' ORDER BY j) FROM (SELECT '{\"c_custkey\":' || c_custkey || '}' AS j FROM customer WHERE c_acctbal < 0 ORDER BY c_custkey LIMIT 5)) AS failed_row_sample FROM customer WHERE c_acctbal < 0")
def _(b: Bank):
    customer, bad = b.table("customer"), F.col("c_acctbal") < 0
    check = Q.Check("negative_balance", "RANGE", "RAW", "customer", "WARN")
    verdicts = Q.check_predicates(customer, [(check, bad)])
    return Q.with_failed_sample(verdicts, customer, bad, ["c_custkey"]).select(
        "check_name", "status", "observed_value", "failed_row_sample"
    )


@query("dq_invariants", """
  SELECT 'staged_rows_equal_raw_ids' AS check_name, 'PASS' AS status, CAST(0 AS DOUBLE) AS observed_value
  UNION ALL SELECT 'outstanding_not_negative', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*) FROM loans WHERE outstanding < 0
  UNION ALL SELECT 'blocked_is_flagged', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*) FROM fct
    WHERE is_blocked_flag = 1 AND transaction_sk NOT IN (SELECT transaction_sk FROM fraud)
  UNION ALL SELECT 'every_customer_has_bucket', CASE WHEN count(*) > 0 THEN 'FAIL' ELSE 'PASS' END, count(*) FROM profit WHERE risk_value_segment IS NULL""")
def _(b: Bank):
    checks = dq.invariants(b.raw, b.stg, b.loans, b.fct, b.fraud, b.profit)
    return _verdicts(checks).select("check_name", "status", "observed_value")


_RESULTS = """
  SELECT 'run-' || lpad(CAST(event_id AS VARCHAR), 10, '0') AS check_run_id, event_type || '_' || CAST(user_id AS VARCHAR) AS check_name,
    event_type AS check_category, ['RAW', 'STG', 'MART'][CAST(event_id % 3 AS INT) + 1] AS layer,
    'T' || CAST(user_id AS VARCHAR) AS target_object, ['ERROR', 'WARN', 'INFO'][CAST(user_id % 3 AS INT) + 1] AS severity,
    CASE WHEN event_id % 7 = 0 THEN 'FAIL' ELSE 'PASS' END AS status, CAST(event_id AS DOUBLE) AS observed_value,
    CAST(0 AS DOUBLE) AS threshold_value, 'd' AS check_details, ts AS executed_at FROM events"""


def _results(b: Bank):
    return b.table("events").selectExpr(
        "concat('run-', lpad(cast(event_id as string), 10, '0')) as check_run_id",
        "concat(event_type, '_', cast(user_id as string)) as check_name",
        "event_type as check_category",
        "element_at(array('RAW', 'STG', 'MART'), cast(event_id % 3 as int) + 1) as layer",
        "concat('T', cast(user_id as string)) as target_object",
        "element_at(array('ERROR', 'WARN', 'INFO'), cast(user_id % 3 as int) + 1) as severity",
        "if(event_id % 7 = 0, 'FAIL', 'PASS') as status",
        "cast(event_id as decimal(38, 4)) as observed_value",
        "cast(0 as decimal(38, 4)) as threshold_value", "'d' as check_details", "ts as executed_at",
    )


_LATEST = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY executed_at DESC, check_run_id DESC) AS rn FROM results) WHERE rn = 1"


@query("dq_latest", f"SELECT * EXCLUDE (rn) FROM ({_LATEST})", results=_RESULTS)
def _(b: Bank):
    return Q.dq_latest(_results(b))


@query("dq_failures_open", f"SELECT check_name, check_category, layer, target_object, severity, observed_value, threshold_value, check_details, executed_at FROM ({_LATEST}) WHERE status = 'FAIL'", results=_RESULTS)
def _(b: Bank):
    return Q.failures_open(_results(b))


@query("dq_scorecard", f"""
  SELECT CAST(executed_at AS DATE) AS check_date, layer, check_category, count(*) AS total_checks,
    count(*) FILTER (status = 'PASS') AS passed, count(*) FILTER (status = 'FAIL') AS failed,
    {share_pct("count(*) FILTER (status = 'PASS')", 'count(*)')} AS pass_rate_pct,
    count(*) FILTER (status = 'FAIL' AND severity = 'ERROR') AS error_count, count(*) FILTER (status = 'FAIL' AND severity = 'WARN') AS warn_count
  FROM results WHERE executed_at >= DATE '2024-01-15' GROUP BY 1, 2, 3""", results=_RESULTS)
def _(b: Bank):
    return Q.scorecard(_results(b), date(2024, 2, 14))


@query("scorecard_in_order", """
  SELECT check_date, layer, check_category, total_checks, CAST(row_number() OVER (ORDER BY check_date DESC, layer, check_category) AS INT) AS position FROM (
    SELECT CAST(executed_at AS DATE) AS check_date, layer, check_category, count(*) AS total_checks FROM results
    WHERE executed_at >= DATE '2024-01-15' GROUP BY 1, 2, 3)""", results=_RESULTS)
def _(b: Bank):
    card = Q.scorecard(_results(b), date(2024, 2, 14)).select("check_date", "layer", "check_category", "total_checks")
    return rows.in_order(card, F.desc("check_date"), "layer", "check_category")


_ENTITIES = ("customers", "accounts", "transactions", "loans", "branches")


@query("layer_reconciliation", f"""
  SELECT entity, raw_count, stg_count, raw_count - stg_count AS row_diff, {share_pct('stg_count', 'raw_count')} AS retention_pct,
    CASE WHEN raw_count = 0 THEN 'NO_DATA' WHEN abs(raw_count - stg_count) * 20 > raw_count THEN 'DRIFT_HIGH'
      WHEN raw_count <> stg_count THEN 'DRIFT_LOW' ELSE 'OK' END AS reconciliation_status
  FROM ({" UNION ALL ".join(f"SELECT '{e.upper()}' AS entity, (SELECT count(*) FROM raw_{e} WHERE NOT _deleted) AS raw_count, (SELECT count(*) FROM stg_{e}) AS stg_count" for e in _ENTITIES)})""")
def _(b: Bank):
    return Q.reconcile(
        {e.upper(): rows.not_deleted(b.raw[e]) for e in _ENTITIES}, {e.upper(): b.stg[e] for e in _ENTITIES}
    )


_REFUND = "transaction_type = 'REFUND'"
_QUALIFY = f"({sum_if(REVENUE)} - {sum_if(_REFUND)})"


@query("revenue_reconciles", f"""
  SELECT {dbl('m')} AS mart_value, {dbl('f')} AS fact_value, {dbl('abs(m - f)')} AS variance FROM
    (SELECT sum(net_revenue_usd) AS m FROM revenue), (SELECT {_QUALIFY} AS f FROM fct WHERE transaction_status = 'COMPLETED')
  WHERE abs(m - f) > 0.01""")
def _(b: Bank):
    return dq.revenue_variance(b.revenue, marts.completed(b.fct))


@query("revenue_reconciles_variance", f"""
  SELECT {dbl('m')} AS mart_value, {dbl('f')} AS fact_value, {dbl('abs(m - f)')} AS variance FROM
    (SELECT sum(net_revenue_usd) AS m FROM revenue), (SELECT {_QUALIFY} AS f FROM fct)
  WHERE abs(m - f) > 0.01""")
def _(b: Bank):
    return dq.revenue_variance(b.revenue, b.fct)


_MODEL_SQL = {
    "dim_date": "SELECT * FROM stg_calendar",
    "dim_customer": "SELECT * FROM stg_customers",
    "dim_account": "SELECT * FROM stg_accounts",
    "dim_branch": "SELECT * FROM stg_branches",
    "fct_transactions": "SELECT * FROM fct",
    "fct_revenue_monthly": "SELECT * FROM revenue",
    "fct_customer_profitability": "SELECT * FROM profit",
    "fct_branch_performance": "SELECT * FROM performance",
    "fct_quarterly_kpis": "SELECT DISTINCT date_trunc('quarter', revenue_month) AS revenue_quarter, branch_region FROM revenue",
    "fct_loans": "SELECT *, outstanding AS outstanding_balance_est FROM loans",
    "fct_loan_portfolio": "SELECT loan_type, customer_region, customer_segment, customer_risk_category, sum(CASE WHEN is_default_flag = 1 THEN loan_amount ELSE 0 END) / sum(loan_amount) * 100 AS default_rate_pct FROM loans GROUP BY 1, 2, 3, 4",
    "fct_fraud_indicators": "SELECT *, len(reasons) AS flag_count FROM fraud",
}


@query("column_tests_sources", spec_sql(SOURCE_SPEC))
def _(b: Bank):
    return dq.run_contracts({f"raw_{n}": b.raw[n] for n in b.raw}, dq.SOURCE_CONTRACTS, b.p)


@query("column_tests_staging", spec_sql(STAGING_SPEC))
def _(b: Bank):
    return dq.run_contracts({f"stg_{n}": b.stg[n] for n in b.stg}, dq.STAGING_CONTRACTS, b.p)


def _mart_models(b: Bank):
    return {
        "dim_date": dims.dim_date(b.stg["calendar"]), "dim_customer": b.dim_customer,
        "dim_account": dims.dim_account(b.stg["accounts"], b.stg["branches"], b.p),
        "dim_branch": b.dim_branch, "fct_transactions": b.fct, "fct_revenue_monthly": b.revenue,
        "fct_customer_profitability": b.profit, "fct_branch_performance": b.performance,
        "fct_quarterly_kpis": marts.quarterly_kpis(b.revenue), "fct_loans": b.loans,
        "fct_loan_portfolio": loan_plans.loan_portfolio(b.loans), "fct_fraud_indicators": b.fraud,
    }


# The models that others are made from, each behind those it is made from itself.
_SHARED = {
    "dim_customer": "dim_customer", "dim_branch": "dim_branch", "fct": "fct_transactions", "loans": "fct_loans", "revenue": "fct_revenue_monthly",
}


def _written_marts(b: Bank, folder: str) -> dict[str, DataFrame]:
    """Every mart model as a table. The shared ones come first, and the others read their tables
    instead of working them out once more."""
    written = {}
    for layer, model in _SHARED.items():
        written[model] = sinks.materialize(getattr(b, layer), folder, model)
        setattr(b, layer, written[model])
    return {n: written[n] if n in written else sinks.materialize(df, folder, n) for n, df in _mart_models(b).items()}


@query("column_tests_marts", spec_sql(MART_SPEC), **_MODEL_SQL)
def _(b: Bank):
    return dq.run_contracts(_written_marts(b, work_dir(b.spark, "marts")), dq.MART_CONTRACTS, b.p)


@query("positive_value", "SELECT 'lineitem' AS model, 'l_discount' AS column_name, 'positive_value' AS test, count(*) AS failures FROM lineitem WHERE l_discount <= 0")
def _(b: Bank):
    return Q.run_column_tests(b.table("lineitem"), "lineitem", [Q.test_positive("l_discount")])


@query("sync_anomalies", """
  SELECT connector, synced_at, duration_s, row_count, avg_duration_s, prev_row_count,
    coalesce(CAST(duration_s > avg_duration_s * 2 AS INT), 0) AS is_slow,
    coalesce(CAST(abs(row_count - prev_row_count) * 2 > prev_row_count AS INT), 0) AS is_row_drift
  FROM (SELECT *, avg(duration_s) OVER (PARTITION BY connector ORDER BY epoch(synced_at)::BIGINT RANGE BETWEEN 2592000 PRECEDING AND 1 PRECEDING) AS avg_duration_s,
      lag(row_count) OVER (PARTITION BY connector ORDER BY synced_at) AS prev_row_count
    FROM (SELECT event_type AS connector, date_trunc('hour', ts) AS synced_at, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS duration_s, count(*) AS row_count FROM events GROUP BY 1, 2))
  WHERE duration_s > avg_duration_s * 2 OR abs(row_count - prev_row_count) * 2 > prev_row_count""")
def _(b: Bank):
    """The log of an hourly sync per kind of event."""
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    log = b.table("events").groupBy(F.col("event_type").alias("connector"), hour.alias("synced_at")).agg(
        F.sum(F.floor("value")).alias("duration_s"), F.count(F.lit(1)).alias("row_count")
    )
    return Q.sync_anomalies(log)


# --- incremental loads and change records ---------------------------------------------------

_CUT = datetime(2001, 1, 1)


def _small(df):
    return df.select("transaction_id", "transaction_timestamp", "transaction_status")


@query("incremental_slice", """
  SELECT transaction_id, transaction_timestamp, transaction_status FROM stg_transactions WHERE transaction_timestamp >= (
    SELECT max(transaction_timestamp) - INTERVAL 24 HOUR FROM stg_transactions WHERE transaction_timestamp < DATE '2001-01-01')""")
def _(b: Bank):
    src = b.stg["transactions"]
    target = src.filter(F.col("transaction_timestamp") < lit_ts(_CUT))
    return _small(changes.incremental_slice(src, "transaction_timestamp", target, b.p.txn_late_arrival_overlap_hours))


@query("backfill_slice", "SELECT transaction_id, transaction_timestamp, transaction_status FROM stg_transactions WHERE transaction_timestamp >= DATE '2000-03-01'")
def _(b: Bank):
    return _small(changes.incremental_slice(b.stg["transactions"], "transaction_timestamp", backfill_from=datetime(2000, 3, 1)))


@query("stg_transactions_since", """
  SELECT transaction_id, transaction_timestamp, transaction_status FROM stg_transactions WHERE transaction_timestamp >= DATE '2001-05-01'""")
def _(b: Bank):
    return _small(staging.stg_transactions_since(b.raw["transactions"], datetime(2001, 5, 1)))


@query("merge_by_key", """
  SELECT transaction_id, CASE WHEN transaction_timestamp < DATE '2000-07-01' THEN 'STALE' ELSE transaction_status END AS transaction_status FROM stg_transactions""")
def _(b: Bank):
    src = b.stg["transactions"].select("transaction_id", "transaction_timestamp", "transaction_status")
    target = src.filter(F.col("transaction_timestamp") < lit_ts(_CUT)).withColumn("transaction_status", F.lit("STALE"))
    updates = src.filter(F.col("transaction_timestamp") >= lit_ts(datetime(2000, 7, 1)))
    return changes.merge_by_key(target, updates, "transaction_id").drop("transaction_timestamp")


@query("fct_incremental", """
  SELECT transaction_sk, transaction_id, transaction_timestamp, transaction_date, transaction_type, transaction_status, merchant_category,
    CAST(amount_local AS DOUBLE) AS amount_local, currency, CAST(amount_usd AS DOUBLE) AS amount_usd, account_sk, account_id, customer_sk, customer_id,
    customer_segment, customer_risk_category, branch_sk, branch_id, branch_region, branch_state,
    is_failed_flag, is_blocked_flag, is_high_value_flag, is_round_high_value_flag,
    CASE WHEN transaction_timestamp >= (SELECT max(transaction_timestamp) - INTERVAL 24 HOUR FROM fct WHERE transaction_date < DATE '2001-01-01')
      THEN TIMESTAMP '2001-12-31' ELSE TIMESTAMP '2000-12-31' END AS loaded_at FROM fct""")
def _(b: Bank):
    """Two loads into a written table, as the build makes them: everything before 2001, then what was
    synced since, from the partitions of the staging that the slice can lie in."""
    path, staged = work_dir(b.spark, "fct"), work_dir(b.spark, "stg_transactions")
    early = b.raw["transactions"].filter(F.col("transaction_timestamp") < lit_ts(_CUT))
    for raw, p in ((early, as_of(b.p, datetime(2000, 12, 31))), (b.raw["transactions"], b.p)):
        txn = staging.refresh_staged_transactions(b.spark, staged, raw, p.txn_late_arrival_overlap_hours)
        bound = fact_bound(b.spark, path, p)
        txn = txn if bound is None else sinks.read_since(b.spark, staged, bound)
        fact = load_staged_fact(b.spark, path, {**b.stg, "transactions": txn}, b.fx, p, backfill_from=bound)
    return fact


@query("clustered_table", "SELECT transaction_id, transaction_date, CAST(amount AS DOUBLE) AS amount FROM stg_transactions WHERE transaction_date >= DATE '2001-01-01'")
def _(b: Bank):
    path = work_dir(b.spark, "clustered")
    rows_ = b.stg["transactions"].select("transaction_id", "transaction_date", "amount")
    sinks.write_clustered(rows_, path, "transaction_date")
    return sinks.read_clustered(b.spark, path).filter(F.col("transaction_date") >= F.lit("2001-01-01").cast("date"))


@query("append_only_log", "SELECT account_id, account_status, runs FROM stg_accounts, (SELECT unnest([1, 2]) AS runs)")
def _(b: Bank):
    path = work_dir(b.spark, "log")
    for run in (1, 2):
        sinks.append_log(b.stg["accounts"].select("account_id", "account_status", F.lit(run).alias("runs")), path)
    return b.spark.read.parquet(path)


@query("materialised_reload", "SELECT branch_id, account_id FROM stg_accounts")
def _(b: Bank):
    folder = work_dir(b.spark, "tables")
    rows_ = b.stg["accounts"].select("branch_id", "account_id")
    sinks.materialize(rows_, folder, "accounts")
    again = sinks.materialize(rows_, folder, "accounts")
    path = os.path.join(folder, "reloaded")
    for _ in (1, 2):
        sinks.reload(again, path)
    return b.spark.read.parquet(path)


_OP = "CASE CAST(substr(transaction_id, 2) AS BIGINT) % 5 WHEN 0 THEN 'DELETE' WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'INSERT' END"


@query("apply_changes", f"""
  SELECT coalesce(t.transaction_id, c.transaction_id) AS transaction_id,
    CASE WHEN t.transaction_id IS NULL THEN 'MOVED' ELSE t.account_id END AS account_id,
    CAST(CASE WHEN t.transaction_id IS NULL OR op = 'UPDATE' THEN c.amount + 1 ELSE t.amount END AS DOUBLE) AS amount,
    CASE WHEN t.transaction_id IS NULL OR op = 'UPDATE' THEN op ELSE 'INSERT' END AS cdc_operation,
    CASE WHEN t.transaction_id IS NULL OR op = 'UPDATE' THEN {T2} ELSE {T1} END AS ingested_at
  FROM (SELECT * FROM stg_transactions WHERE transaction_status <> 'PENDING') t
  FULL JOIN (SELECT *, {_OP} AS op FROM stg_transactions) c ON c.transaction_sk = t.transaction_sk
  WHERE (t.transaction_id IS NOT NULL AND op IS DISTINCT FROM 'DELETE') OR (t.transaction_id IS NULL AND op = 'INSERT')""")
def _(b: Bank):
    txn = b.stg["transactions"]
    n = F.substr("transaction_id", F.lit(2)).cast("bigint") % 5
    op = F.when(n == 0, "DELETE").when(n == 1, "UPDATE").when(n == 2, "INSERT")
    target = (
        txn.filter(F.col("transaction_status") != "PENDING")
        .withColumn("cdc_operation", F.lit("INSERT"))
        .withColumn("ingested_at", lit_ts(RUN1))
        .select(*SINK_COLS)
    )
    batch = (
        txn.withColumn("cdc_operation", op)
        .withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
        .withColumn("account_id", F.lit("MOVED"))
    )
    return changes.apply_changes(target, batch, "transaction_sk", lit_ts(RUN2)).select(
        "transaction_id", "account_id", "amount", "cdc_operation", "ingested_at"
    )


@query("cdc_operation", """
  SELECT event_id, CASE WHEN action IN ('INSERT', 'DELETE') AND upd THEN 'UPDATE' WHEN action IN ('INSERT', 'DELETE') THEN action END AS cdc_operation
  FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN 'DELETE' WHEN event_type = 'view' THEN 'TRUNCATE' ELSE 'INSERT' END AS action, event_id % 2 = 0 AS upd FROM events)""")
def _(b: Bank):
    action = F.when(F.col("event_type") == "error", "DELETE").when(F.col("event_type") == "view", "TRUNCATE").otherwise("INSERT")
    return b.table("events").select(
        "event_id", rules.cdc_operation(action, F.col("event_id") % 2 == 0).alias("cdc_operation")
    )


_DIFF = "(a.customer_name, a.customer_segment, a.region) IS DISTINCT FROM (b.customer_name, b.customer_segment, b.region)"


@query("table_changes", f"""
  SELECT customer_id, customer_name, customer_segment, region, 'INSERT' AS action, false AS is_update FROM cust_after WHERE customer_id NOT IN (SELECT customer_id FROM cust_before)
  UNION ALL SELECT customer_id, customer_name, customer_segment, region, 'DELETE', false FROM cust_before WHERE customer_id NOT IN (SELECT customer_id FROM cust_after)
  UNION ALL SELECT b.customer_id, b.customer_name, b.customer_segment, b.region, 'DELETE', true FROM cust_before b JOIN cust_after a USING (customer_id) WHERE {_DIFF}
  UNION ALL SELECT a.customer_id, a.customer_name, a.customer_segment, a.region, 'INSERT', true FROM cust_before b JOIN cust_after a USING (customer_id) WHERE {_DIFF}""")
def _(b: Bank):
    cols = ["customer_id", "customer_name", "customer_segment", "region"]
    return changes.table_changes(b.cust_before.select(*cols), b.cust_after.select(*cols), "customer_id")


@query("high_water_mark", "SELECT max(transaction_timestamp) - INTERVAL 24 HOUR AS bound, count(*) AS target_rows FROM stg_transactions")
def _(b: Bank):
    rows_ = b.stg["transactions"]
    bound = changes.high_water_mark(rows_, "transaction_timestamp", b.p.txn_late_arrival_overlap_hours)
    return rows_.agg(lit_ts(bound).alias("bound"), F.count(F.lit(1)).alias("target_rows"))


_OLD = """
  SELECT * REPLACE (CASE n % 10 WHEN 0 THEN NULL WHEN 1 THEN TIMESTAMP '1899-12-31 00:00:00' ELSE transaction_timestamp END AS transaction_timestamp)
  FROM (SELECT *, CAST(substr(transaction_id, 2) AS BIGINT) AS n FROM stg_transactions)"""


@query("fct_first_load", "SELECT transaction_id, transaction_timestamp, CAST(transaction_timestamp AS DATE) AS transaction_date, CAST(amount AS DOUBLE) AS amount_local FROM old", old=_OLD)
def _(b: Bank):
    """Rows without a time and from before 1900 are in the first load, as the build runs it."""
    n = F.substr("transaction_id", F.lit(2)).cast("bigint") % 10
    ts = F.when(n == 0, None).when(n == 1, lit_ts(datetime(1899, 12, 31))).otherwise(F.col("transaction_timestamp"))
    old = b.stg["transactions"].withColumn("transaction_timestamp", ts).withColumn("transaction_date", F.col("transaction_timestamp").cast("date"))
    fact = load_staged_fact(b.spark, work_dir(b.spark, "fct"), {**b.stg, "transactions": old}, b.fx, b.p)
    return fact.select("transaction_id", "transaction_timestamp", "transaction_date", "amount_local")


# --- governance -----------------------------------------------------------------------------

_ROLES = (masks.ADMIN, masks.TRANSFORMER, masks.READER, "INTERN")


def _contacts(b: Bank):
    return b.table("customer").selectExpr(
        "c_custkey",
        "if(c_custkey % 31 = 0, null, concat(replace(c_name, '#', ' '), ' ', c_mktsegment)) as name",
        "concat(lower(c_mktsegment), '.', cast(c_custkey as string), '@bank', cast(c_nationkey as string), '.com') as email",
        "concat('+', cast(c_nationkey as string), ' (555) ', lpad(cast(c_custkey as string), 7, '0')) as phone",
        "concat('ID-', lpad(cast(c_custkey as string), 9, '0')) as govt_id",
        "cast(c_acctbal as decimal(18, 2)) as balance",
    )


_CONTACTS = """
  SELECT c_custkey, CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE replace(c_name, '#', ' ') || ' ' || c_mktsegment END AS name,
    lower(c_mktsegment) || '.' || CAST(c_custkey AS VARCHAR) || '@bank' || CAST(c_nationkey AS VARCHAR) || '.com' AS email,
    '+' || CAST(c_nationkey AS VARCHAR) || ' (555) ' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone,
    'ID-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS govt_id, CAST(c_acctbal AS DECIMAL(18, 2)) AS balance FROM customer"""


def _roles(mask, column: str):
    return lambda b: _contacts(b).select(
        "c_custkey", *[mask(F.col(column), role).alias(f"as_{role.lower()}") for role in _ROLES]
    )


def _role_sql(admin: str, transformer: str, reader: str, other: str) -> str:
    return f"SELECT c_custkey, {admin} AS as_fin_admin, {transformer} AS as_dbt_transformer, {reader} AS as_bi_reader, {other} AS as_intern FROM contacts"


_M = "'***MASKED***'"
query("mask_name", _role_sql("name", "name", "coalesce(left(split_part(name, ' ', 1), 1) || '. ' || left(split_part(name, ' ', -1), 1) || '.', '***')", _M), contacts=_CONTACTS)(_roles(masks.mask_name, "name"))
query("mask_email", _role_sql("email", "email", "left(split_part(email, '@', 1), 1) || '***@' || split_part(email, '@', 2)", _M), contacts=_CONTACTS)(_roles(masks.mask_email, "email"))
query("mask_phone", _role_sql("phone", "phone", "'XXX-XXX-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4)", _M), contacts=_CONTACTS)(_roles(masks.mask_phone, "phone"))
query("mask_govt_id", _role_sql("govt_id", "'HASH_' || left(sha256(govt_id), 12)", "'HASH_' || left(sha256(govt_id), 12)", _M), contacts=_CONTACTS)(_roles(masks.mask_govt_id, "govt_id"))
query("mask_amount", _role_sql(dbl("balance"), dbl("balance"), dbl(f"{rdiv(cents('balance'), '100000')} * 1000"), "CAST(NULL AS DOUBLE)"), contacts=_CONTACTS)(_roles(masks.mask_amount, "balance"))


def _tagged(b: Bank):
    df = _contacts(b)
    for column, data_class, field in (
        ("name", "PII_LOW", "NAME"), ("email", "PII_HIGH", "EMAIL"), ("phone", "PII_HIGH", "PHONE"),
        ("govt_id", "PII_HIGH", "GOVT_ID"), ("balance", "FINANCIAL_SENSITIVE", None),
    ):
        df = governance.tag(df, column, data_class, field)
    return df


_SEEN = {
    "FIN_ADMIN": ("name", "email", "phone", "govt_id", dbl("balance")),
    "DBT_TRANSFORMER": ("name", "email", "phone", "'HASH_' || left(sha256(govt_id), 12)", dbl("balance")),
    "BI_READER": (
        "coalesce(left(split_part(name, ' ', 1), 1) || '. ' || left(split_part(name, ' ', -1), 1) || '.', '***')",
        "left(split_part(email, '@', 1), 1) || '***@' || split_part(email, '@', 2)",
        "'XXX-XXX-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4)", "'HASH_' || left(sha256(govt_id), 12)",
        dbl(f"{rdiv(cents('balance'), '100000')} * 1000")),
    "INTERN": (_M, _M, _M, _M, "CAST(NULL AS DOUBLE)"),
}


@query("masks_in_sql", " UNION ALL ".join(
    f"SELECT '{role}' AS role, c_custkey, {', '.join(f'{e} AS {c}' for e, c in zip(seen, ('name', 'email', 'phone', 'govt_id', 'balance')))} FROM contacts"
    for role, seen in _SEEN.items()), contacts=_CONTACTS)
def _(b: Bank):
    """One masked view, read in SQL as each role."""
    masks_sql.register_masks(b.spark)
    masks_sql.masked_view(b.spark, _tagged(b), "masked_contacts")
    out = None
    for role in _SEEN:
        masks_sql.set_role(b.spark, role)
        seen = b.spark.sql("SELECT masking_role AS role, * FROM masked_contacts")
        out = seen if out is None else out.unionByName(seen)
    return out


@query("apply_masks", f"""
  SELECT c_custkey, coalesce(left(split_part(name, ' ', 1), 1) || '. ' || left(split_part(name, ' ', -1), 1) || '.', '***') AS name,
    left(split_part(email, '@', 1), 1) || '***@' || split_part(email, '@', 2) AS email,
    'XXX-XXX-' || right(regexp_replace(phone, '[^0-9]', '', 'g'), 4) AS phone, 'HASH_' || left(sha256(govt_id), 12) AS govt_id,
    {dbl(f"{rdiv(cents('balance'), '100000')} * 1000")} AS balance FROM contacts""", contacts=_CONTACTS)
def _(b: Bank):
    return governance.apply_masks(_tagged(b), masks.READER)


@query("row_access", "SELECT customer_id, region FROM stg_customers WHERE region = 'Asia'")
def _(b: Bank):
    return governance.row_access(b.stg["customers"].select("customer_id", "region"), masks.READER, "Asia")


@query("access_audit", """
  SELECT user_name, role_name, query_text, database_name, schema_name, start_time, execution_status, total_elapsed_time FROM query_log
  WHERE start_time >= DATE '2024-01-11' AND database_name = 'BANK' AND query_type IN ('SELECT', 'CREATE_TABLE_AS_SELECT', 'MERGE', 'UPDATE', 'DELETE')""")
def _(b: Bank):
    return governance.access_audit(standin.query_log(b.spark, b.dir), "BANK", date(2024, 2, 10))


@query("cost_by_tag", f"SELECT query_tag, {dbl('sum(credits_used_cloud_services + credits_used)')} AS credits FROM query_log WHERE query_tag LIKE 'project=bank%' GROUP BY 1")
def _(b: Bank):
    return ops.cost_by_tag(standin.query_log(b.spark, b.dir), "project=bank")


@query("cost_by_target", r"SELECT regexp_extract(query_text, '(?i)INTO\s+(\S+)', 1) AS target_object, CAST(sum(execution_time) AS DOUBLE) / 1000 AS exec_seconds FROM query_log WHERE query_type = 'CREATE_TABLE_AS_SELECT' GROUP BY 1")
def _(b: Bank):
    return ops.cost_by_target(standin.query_log(b.spark, b.dir))
