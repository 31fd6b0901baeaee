"""Queries: marts, loans, fraud, serving views, dashboards."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Window, functions as F

from bankspark.checks.context import Bank, query
from bankspark.checks.sql import (
    AS_OF, AS_OF_TS, REVENUE, cents, dbl, mean2, month, months_on, quarter, ratio_pct, rdiv,
    share_pct, sum_if,
)
from bankspark.functions import masks, rules
from bankspark.functions.dates import lit_date
from bankspark.operators import bursts, rows
from bankspark.plans import fraud, loans, marts, serve
from bankspark.plans.balances import BLOCK, load_balances
from bankspark.plans.build import as_of
from bankspark.session import work_dir
from bankspark.sources import standin
from bankspark.sources.sinks import materialize

_REV = "revenue_month, customer_segment, customer_risk_category, branch_region"


@query("revenue_monthly", f"""
  SELECT {_REV}, {dbl('inflow_usd')} AS inflow_usd, {dbl('refund_usd')} AS refund_usd,
    {dbl('net_revenue_usd')} AS net_revenue_usd, inflow_txn_count, active_customers,
    {mean2('net_revenue_usd', 'active_customers')} AS avg_revenue_per_customer FROM revenue""")
def _(b: Bank):
    return b.revenue


@query("revenue_with_outflow", f"SELECT {_REV}, {dbl('inflow_usd')} AS inflow_usd, {dbl('outflow_usd')} AS outflow_usd FROM revenue")
def _(b: Bank):
    return marts.revenue_monthly(b.fct, outflow=True).select(
        "revenue_month", "customer_segment", "customer_risk_category", "branch_region", "inflow_usd", "outflow_usd"
    )


@query("branch_performance", f"""
  SELECT * REPLACE ({dbl('total_volume_usd')} AS total_volume_usd, {dbl('revenue_usd')} AS revenue_usd),
    {share_pct('failed_count', 'transaction_count')} AS failed_pct FROM performance""")
def _(b: Bank):
    return b.performance


@query("customer_txn_agg", f"""
  SELECT customer_id, {dbl('rev')} AS total_revenue_usd, {dbl('ref')} AS total_refund_usd, n AS total_txn_count,
    CAST(failed AS BIGINT) AS failed_txn_count, CAST(high AS BIGINT) AS high_value_txn_count,
    first_txn_date, last_txn_date FROM txn_agg""")
def _(b: Bank):
    return marts.customer_txn_agg(b.fct)


@query("customer_loan_agg", f"""
  SELECT customer_id, n AS loan_count, {dbl('principal')} AS total_loan_principal, {dbl('owed')} AS total_outstanding_usd,
    CAST(defaulted AS BIGINT) AS defaulted_loan_count, {dbl('rate8', 8)} AS avg_interest_rate FROM loan_agg""")
def _(b: Bank):
    return marts.customer_loan_agg(b.amortized)


@query("customer_profitability", f"""
  SELECT customer_sk, customer_id, customer_name, customer_segment, risk_category, region, onboarding_date, tenure_days,
    {dbl('rev')} AS total_revenue_usd, {dbl('ref')} AS total_refund_usd, {dbl('net')} AS net_revenue_usd,
    txns AS total_txn_count, failed AS failed_txn_count, high AS high_value_txn_count, first_txn_date, last_txn_date,
    loan_count, {dbl('principal')} AS total_loan_principal, {dbl('owed')} AS total_outstanding_usd,
    defaulted AS defaulted_loan_count, {dbl('rate8', 8)} AS avg_loan_interest_rate,
    {dbl('cost2', 2)} AS cost_of_funds_proxy_usd, {dbl('profit2', 2)} AS profit_estimate_usd, risk_value_segment
  FROM profit""")
def _(b: Bank):
    return b.profit.drop("scd_valid_from", "scd_valid_to")


_QUARTERLY = f"""
  SELECT {quarter('revenue_month')} AS revenue_quarter, branch_region, sum(net_revenue_usd) AS net,
    sum(inflow_usd) AS inflow, sum(refund_usd) AS refund, CAST(sum(inflow_txn_count) AS BIGINT) AS inflow_txn_count,
    {rdiv('sum(active_customers) * 1000000', 'count(active_customers)')} AS active6 FROM revenue GROUP BY 1, 2"""


@query("quarterly_kpis", f"""
  SELECT revenue_quarter, branch_region, {dbl('net')} AS net_revenue_usd, {dbl('inflow')} AS gross_inflow_usd,
    {dbl('refund')} AS refund_usd, inflow_txn_count, {dbl('active6', 6)} AS avg_active_customers,
    {dbl('prev')} AS prev_quarter_revenue, {ratio_pct('net - prev', 'prev')} AS qoq_growth_pct,
    {ratio_pct('net', 'total')} AS region_revenue_contribution_pct
  FROM (SELECT *, lag(net) OVER (PARTITION BY branch_region ORDER BY revenue_quarter) AS prev,
    sum(net) OVER (PARTITION BY revenue_quarter) AS total FROM quarterly)""", quarterly=_QUARTERLY)
def _(b: Bank):
    return marts.quarterly_kpis(b.revenue)


@query("kpis_in_order", f"""
  SELECT revenue_quarter, branch_region, {dbl('net')} AS net_revenue_usd,
    CAST(row_number() OVER (ORDER BY revenue_quarter DESC, net DESC, branch_region NULLS FIRST) AS INT) AS position FROM quarterly""", quarterly=_QUARTERLY)
def _(b: Bank):
    """As the report shows them: the newest quarter first, in it the region with most revenue."""
    kpis = marts.quarterly_kpis(b.revenue).select("revenue_quarter", "branch_region", "net_revenue_usd")
    return rows.in_order(kpis, F.desc("revenue_quarter"), F.desc("net_revenue_usd"), "branch_region")


@query("nim_quarterly", f"""
  SELECT quarter, {dbl('interest')} AS interest_usd, {dbl('owed')} AS outstanding_usd, {dbl('cost')} AS quarter_cost_usd,
    {ratio_pct('interest - cost', 'owed', 4)} AS nim_pct
  FROM (SELECT {quarter('transaction_date')} AS quarter, sum(amount_usd) AS interest FROM fct
    WHERE transaction_status = 'COMPLETED' AND transaction_type = 'INTEREST' GROUP BY 1),
  (SELECT sum(outstanding) AS owed, CAST(sum({rdiv(cents('outstanding') + ' * ' + cents('interest_rate'), '40000')}) AS DECIMAL(30, 0)) * 0.01 AS cost FROM amortized)""")
def _(b: Bank):
    return marts.nim_quarterly(b.fct, b.amortized)


# --- loans ----------------------------------------------------------------------------------

_LOAN = """loan_id, loan_type, customer_id, CAST(loan_amount AS DOUBLE) AS loan_amount,
    CAST(interest_rate AS DOUBLE) AS interest_rate, CAST(emi_amount AS DOUBLE) AS emi_amount, loan_status,
    disbursement_date, since AS months_since_disbursement, tenure AS loan_tenure_months_estimate,
    paid AS effective_months_paid, CAST(repaid AS DOUBLE) AS estimated_total_repaid,
    CAST(outstanding AS DOUBLE) AS outstanding_balance_est, is_default_flag, is_delinquent_flag, is_active_flag"""


@query("loans_amortized", f"SELECT loan_sk, {_LOAN} FROM amortized")
def _(b: Bank):
    return b.amortized


@query("fct_loans", f"SELECT loan_sk, {_LOAN}, customer_sk, customer_segment, customer_risk_category, customer_region, {AS_OF_TS} AS loaded_at FROM loans")
def _(b: Bank):
    return b.loans


@query("loan_portfolio", f"""
  SELECT loan_type, customer_region, customer_segment, customer_risk_category, count(*) AS loan_count,
    {dbl('sum(loan_amount)')} AS total_principal_usd, {dbl('sum(outstanding)')} AS total_outstanding_usd,
    CAST(sum(is_default_flag) AS BIGINT) AS defaulted_count, CAST(sum(is_delinquent_flag) AS BIGINT) AS delinquent_count,
    CAST(sum(is_active_flag) AS BIGINT) AS active_count,
    {ratio_pct(sum_if('is_default_flag = 1', 'loan_amount'), 'sum(loan_amount)')} AS default_rate_pct,
    {mean2('sum(interest_rate)', 'count(interest_rate)')} AS avg_interest_rate,
    {mean2('sum(loan_amount)', 'count(loan_amount)')} AS avg_loan_principal
  FROM loans GROUP BY 1, 2, 3, 4""")
def _(b: Bank):
    return loans.loan_portfolio(b.loans)


@query("default_rate_by_count", f"SELECT customer_region, loan_type, count(*) AS loan_count, {share_pct('sum(is_default_flag)', 'count(*)')} AS default_rate_pct FROM loans GROUP BY 1, 2")
def _(b: Bank):
    return loans.default_rate(b.loans, ["customer_region", "loan_type"], weight="count")


@query("default_rate_by_principal", f"SELECT customer_region, count(*) AS loan_count, {ratio_pct(sum_if('is_default_flag = 1', 'loan_amount'), 'sum(loan_amount)')} AS default_rate_pct FROM loans GROUP BY 1")
def _(b: Bank):
    return loans.default_rate(b.loans, ["customer_region"])


_DAILY = f"""
  SELECT loan_id, balance_date, loan_type, CASE WHEN tenure IS NULL THEN NULL ELSE
    greatest(CAST(loan_amount - emi_amount * least({months_on('disbursement_date', 'balance_date')}, tenure) AS DECIMAL(18, 2)), CAST(0 AS DECIMAL(18, 2))) END AS balance
  FROM (SELECT *, CAST(unnest(generate_series(CAST(disbursement_date AS TIMESTAMP), {AS_OF_TS}, INTERVAL 1 DAY)) AS DATE) AS balance_date
    FROM amortized WHERE disbursement_date <= {AS_OF})"""

# Each loan's days folded to one row: the second sum gives each day a weight of its own, so a
# balance on the wrong day shows.
_PER_LOAN = f"""
  SELECT loan_id, loan_type, count(*) AS days, count(balance) AS rated_days, min(balance_date) AS first_day, max(balance_date) AS last_day,
    {dbl('sum(balance)')} AS outstanding_usd,
    CAST(sum(CAST(balance * 100 AS BIGINT) % 1000003 * ((balance_date - DATE '1990-01-01') % 10007)) AS BIGINT) AS by_day
  FROM daily GROUP BY 1, 2"""


def _per_loan(held):
    """The months of a loan are in one bucket of its block, so nothing is shuffled. What a month's days have in
    common is worked out before they are written out, in numbers that add up fast: cents as a high and a low
    half, so that no sum of them leaves a bigint."""
    cents, half = (F.col("outstanding_balance") * 100).cast("bigint"), 2**31
    months = held.withColumns({"_rest": cents % 1000003, "_high": F.shiftright(cents, 31), "_low": F.pmod(cents, F.lit(half))})
    daily = loans.daily_balances(months, also=(BLOCK, "_rest", "_high", "_low"))
    day = F.col("balance_date")
    weight = F.date_diff(day, F.lit("1990-01-01").cast("date")) % 10007
    whole = F.sum("_high").cast("decimal(18,0)") * F.lit(half).cast("decimal(10,0)") + F.sum("_low").cast("decimal(19,0)")
    return daily.groupBy(BLOCK, "loan_id", "loan_type").agg(
        F.count(F.lit(1)).alias("days"), F.count("_low").alias("rated_days"), F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        (whole * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(28,2)").alias("outstanding_usd"), F.sum(F.col("_rest") * weight).alias("by_day")).drop(BLOCK)


@query("loan_balances_daily", _PER_LOAN, daily=_DAILY)
def _(b: Bank):
    """From the stored intervals."""
    return _per_loan(load_balances(b.spark, work_dir(b.spark, "balances"), b.stg["loans"], b.p))


@query("loan_balances_backfill", _PER_LOAN, daily=_DAILY)
def _(b: Bank):
    """The stored table: a first load up to mid-2000 without some loans, one up to the end, and one
    from the first day of the loans that were missing."""
    path, all_loans = work_dir(b.spark, "balances"), b.stg["loans"]
    late = (F.substr("loan_id", F.lit(2)).cast("bigint") % 50 == 3) & (F.col("disbursement_date") >= F.lit("1999-06-15").cast("date"))
    load_balances(b.spark, path, all_loans.filter(~late), as_of(b.p, datetime(2000, 6, 20)))
    load_balances(b.spark, path, all_loans.filter(~late), b.p)
    return _per_loan(load_balances(b.spark, path, all_loans, b.p, date(1999, 6, 15)))


@query("loan_balances_on_day", f"""
  SELECT loan_type, balance_date, count(*) AS loan_count, {dbl('sum(balance)')} AS outstanding_usd FROM daily
  WHERE balance_date BETWEEN DATE '1999-12-28' AND DATE '2000-01-03' GROUP BY 1, 2""", daily=_DAILY)
def _(b: Bank):
    """A week across two years, from two months of the stored intervals."""
    held = load_balances(b.spark, work_dir(b.spark, "balances"), b.stg["loans"], b.p)
    days = loans.daily_balances(held, date(1999, 12, 28), date(2000, 1, 3))
    return days.groupBy("loan_type", "balance_date").agg(F.count(F.lit(1)).alias("loan_count"), F.sum("outstanding_balance").alias("outstanding_usd"))


@query("vintage", f"""
  SELECT {quarter('disbursement_date')} AS vintage_quarter, since AS months_on_book, count(*) AS loan_count,
    CAST(sum(is_default_flag) AS BIGINT) AS defaulted_count, {share_pct('sum(is_default_flag)', 'count(*)')} AS default_rate_pct
  FROM amortized GROUP BY 1, 2""")
def _(b: Bank):
    return loans.vintage(b.amortized)


@query("npa_bucket", f"""
  SELECT CASE WHEN loan_status IN ('DEFAULTED', 'WRITTEN_OFF') THEN 'NPA' WHEN loan_status = 'DELINQUENT' THEN 'WATCH' ELSE 'PERFORMING' END AS npa_bucket,
    count(*) AS loan_count, {dbl('sum(loan_amount)')} AS total_principal_usd, {dbl('sum(outstanding)')} AS total_outstanding_usd
  FROM amortized GROUP BY 1""")
def _(b: Bank):
    return loans.npa_summary(b.amortized)


@query("interest_accrued", f"""
  SELECT loan_id, customer_id, {dbl(rdiv(f"{cents('outstanding')} * {cents('interest_rate')} * since", '120000'), 2)} AS interest_accrued_usd FROM amortized""")
def _(b: Bank):
    return loans.interest_accrued(b.amortized)


# --- fraud ----------------------------------------------------------------------------------

_FCT = "transaction_id, transaction_timestamp, transaction_date, account_id, customer_id, customer_segment, customer_risk_category, branch_region"


@query("fct_transactions", f"""
  SELECT transaction_sk, {_FCT}, transaction_type, transaction_status, merchant_category, CAST(amount_local AS DOUBLE) AS amount_local,
    currency, CAST(amount_usd AS DOUBLE) AS amount_usd, account_sk, customer_sk, branch_sk, branch_id, branch_state,
    is_failed_flag, is_blocked_flag, is_high_value_flag, is_round_high_value_flag, {AS_OF_TS} AS loaded_at FROM fct""")
def _(b: Bank):
    return b.fct


@query("rapid_fire_events", """
  SELECT event_id, user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts
    RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND CURRENT ROW) AS txn_count_60min FROM events""")
def _(b: Bank):
    return bursts.with_burst_count(b.table("events").select("event_id", "user_id", "ts"), "user_id", "ts")


@query("rapid_fire_txn", "SELECT f.transaction_id, f.account_id, txn_count_60min FROM fct f JOIN burst USING (transaction_sk)")
def _(b: Bank):
    return bursts.with_burst_count(
        b.fct.select("transaction_id", "account_id", "transaction_timestamp"), "account_id", "transaction_timestamp"
    ).drop("transaction_timestamp")


@query("fraud_indicators", f"""
  SELECT transaction_sk, {_FCT}, CAST(amount_usd AS DOUBLE) AS amount_usd, currency, transaction_status, merchant_category,
    is_blocked_flag, is_high_value_flag, is_round_high_value_flag, is_rapid_fire_flag,
    array_to_string(reasons, '|') AS flag_reasons, CAST(len(reasons) AS INT) AS flag_count FROM fraud""")
def _(b: Bank):
    return b.fraud


@query("fraud_flag_documented", """
  SELECT transaction_id, CAST(is_blocked_flag = 1 OR amount_usd > 50000 OR txn_count_60min >= 3 AS INT) AS is_fraud_flag
  FROM fct JOIN burst USING (transaction_sk)""")
def _(b: Bank):
    return fraud.fraud_flag(b.fct, b.p).select("transaction_id", "is_fraud_flag")


@query("suspicious_batch", """
  SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, currency,
    CASE WHEN transaction_status = 'BLOCKED' THEN 'STATUS_BLOCKED'
      WHEN amount >= 50000 AND amount % 1000 = 0 THEN 'ROUND_NUMBER_HIGH_VALUE' ELSE 'HIGH_VALUE' END AS flag_reason
  FROM stg_transactions WHERE (transaction_status = 'BLOCKED' OR amount >= 25000)
    AND transaction_sk NOT IN (SELECT transaction_sk FROM stg_transactions WHERE transaction_type = 'REFUND')""")
def _(b: Bank):
    txn = b.stg["transactions"]
    logged = txn.filter(F.col("transaction_type") == "REFUND")
    return fraud.flag_suspicious(txn, logged, b.p).drop("transaction_sk", "flagged_at")


@query("flag_latency", """
  SELECT count(*) AS flag_count, quantile_cont(d, 0.5) AS p50_seconds, quantile_cont(d, 0.95) AS p95_seconds,
    CAST(quantile_cont(d, 0.95) < 300 AS INT) AS slo_met
  FROM (SELECT epoch(loaded_at)::BIGINT - epoch(transaction_timestamp)::BIGINT AS d FROM stg_transactions
    WHERE transaction_status = 'BLOCKED' OR amount >= 25000)""")
def _(b: Bank):
    reason = rules.suspicion_reason(F.col("transaction_status"), F.col("amount"), b.p)
    return fraud.flag_latency(
        b.stg["transactions"].filter(reason.isNotNull()), "transaction_timestamp", "loaded_at"
    )


@query("flag_latency_sketched", """
  SELECT count(*) AS flag_count, TRUE AS p50_within, TRUE AS p95_within, CAST(quantile_cont(d, 0.95) < 300 AS INT) AS slo_met
  FROM (SELECT epoch(loaded_at)::BIGINT - epoch(transaction_timestamp)::BIGINT AS d FROM stg_transactions
    WHERE transaction_status = 'BLOCKED' OR amount >= 25000)""")
def _(b: Bank):
    """From stored daily sketches, and whether each quantile's true rank is as near as promised."""
    reason = rules.suspicion_reason(F.col("transaction_status"), F.col("amount"), b.p)
    flags = b.stg["transactions"].filter(reason.isNotNull())
    daily = materialize(fraud.delay_sketches(flags, "transaction_timestamp", "loaded_at"), work_dir(b.spark, "delays"), "daily")
    found = fraud.flag_latency_of(daily)
    delay = F.unix_seconds(F.col("loaded_at").cast("timestamp")) - F.unix_seconds(F.col("transaction_timestamp").cast("timestamp"))

    def within(p: float, column: str):
        value, error = found.select(column).scalar(), F.lit(fraud.rank_error())
        return (F.avg((delay < value).cast("double")) <= p + error) & (F.avg((delay <= value).cast("double")) >= p - error)

    ranks = flags.agg(within(0.5, "p50_seconds").alias("p50_within"), within(0.95, "p95_seconds").alias("p95_within"))
    return ranks.select(found.select("flag_count").scalar().alias("flag_count"), "p50_within", "p95_within", found.select("slo_met").scalar().alias("slo_met"))


@query("fraud_daily", f"""
  SELECT transaction_date, branch_region, customer_segment, count(*) AS flagged_count, {dbl('sum(amount_usd)')} AS flagged_amount_usd,
    CAST(sum(is_blocked_flag) AS BIGINT) AS blocked_count, CAST(sum(is_round_high_value_flag) AS BIGINT) AS round_hv_count,
    CAST(sum(is_high_value_flag) AS BIGINT) AS hv_count FROM fraud GROUP BY 1, 2, 3""")
def _(b: Bank):
    return serve.fraud_daily(b.fraud)


@query("flags_by_rule", f"""
  SELECT rule, count(*) AS flagged_count, {dbl('sum(amount_usd)')} AS flagged_amount_usd
  FROM (SELECT amount_usd, unnest(reasons) AS rule FROM fraud) GROUP BY 1""")
def _(b: Bank):
    return fraud.flags_by_reason(b.fraud)


_FRAUD_AS_OF = date(2001, 7, 31)


@query("flagged_amount_7d", f"""
  SELECT rule, count(*) AS flagged_count, {dbl('sum(amount_usd)')} AS flagged_amount_usd
  FROM (SELECT amount_usd, unnest(reasons) AS rule FROM fraud WHERE transaction_date >= DATE '2001-07-24') GROUP BY 1""")
def _(b: Bank):
    return serve.flagged_amount_by_rule(b.fraud, _FRAUD_AS_OF)


@query("flag_trend_30d", f"""
  SELECT transaction_date, rule, count(*) AS flagged_count, {dbl('sum(amount_usd)')} AS flagged_amount_usd
  FROM (SELECT transaction_date, amount_usd, unnest(reasons) AS rule FROM fraud WHERE transaction_date >= DATE '2001-07-01') GROUP BY 1, 2""")
def _(b: Bank):
    return serve.flag_trend(b.fraud, _FRAUD_AS_OF)


@query("high_risk_top20", f"""
  SELECT customer_id, count(*) AS flagged_count, {dbl('sum(amount_usd)')} AS flagged_amount_usd FROM fraud
  WHERE transaction_date >= DATE '2001-07-01' AND customer_id IS NOT NULL
  GROUP BY 1 ORDER BY sum(amount_usd) DESC, customer_id LIMIT 20""")
def _(b: Bank):
    return serve.high_risk_customers(b.fraud, _FRAUD_AS_OF)


@query("flags_by_region", f"SELECT branch_region, count(*) AS flagged_count, {dbl('sum(amount_usd)')} AS flagged_amount_usd FROM fraud GROUP BY 1")
def _(b: Bank):
    return serve.flags_by_region(b.fraud)


@query("open_flags_today", "SELECT count(*) AS open_flags FROM events WHERE event_type = 'error' AND ts >= DATE '2024-01-29'")
def _(b: Bank):
    from dataclasses import replace
    from datetime import datetime

    payments = standin.stream_payments(b.table("events"))
    log = fraud.flag_suspicious(
        payments.withColumn("transaction_sk", F.md5("transaction_id")).filter(F.col("transaction_status") == "BLOCKED"),
        None, b.p, F.col("transaction_timestamp"),
    )
    return serve.open_flags_today(log, replace(b.p, as_of=datetime(2024, 1, 29)))


# --- serving views and dashboards -----------------------------------------------------------

_L12 = f"""
  SELECT customer_id, count(*) AS n12, {mean2('sum(amount_usd)', 'count(amount_usd)')} AS avg12 FROM fct
  WHERE transaction_date > DATE '2000-12-31' AND transaction_date <= {AS_OF} GROUP BY 1"""
_INITIALS = "coalesce(left(split_part({0}, ' ', 1), 1) || '. ' || left(split_part({0}, ' ', -1), 1) || '.', '***')"


@query("trailing_activity", "SELECT customer_id, n12 AS transaction_count_l12m, avg12 AS avg_transaction_amount_usd FROM l12", l12=_L12)
def _(b: Bank):
    return serve.trailing_activity(b.fct, b.p)


@query("customer_360", f"""
  SELECT p.customer_sk, p.customer_id, {_INITIALS.format('p.customer_name')} AS customer_name, p.customer_segment, p.risk_category, p.region,
    true AS is_current, {dbl('net')} AS lifetime_value_usd, {dbl('profit2', 2)} AS profit_estimate, risk_value_segment,
    n12 AS transaction_count_l12m, avg12 AS avg_transaction_amount_usd
  FROM profit p LEFT JOIN l12 ON l12.customer_id = p.customer_id""", l12=_L12)
def _(b: Bank):
    return serve.customer_360(b.dim_customer, b.profit, b.fct, b.p, masks.READER)


@query("revenue_exec", f"SELECT * REPLACE ({dbl('revenue_usd')} AS revenue_usd) FROM exec_view")
def _(b: Bank):
    return b.exec_view


@query("active_customers_exact", f"""
  SELECT {month('transaction_date')} AS revenue_month, customer_segment, branch_region, count(DISTINCT customer_id) AS active_customers
  FROM fct WHERE transaction_status = 'COMPLETED' GROUP BY 1, 2, 3""")
def _(b: Bank):
    return serve.active_customers_exact(b.fct)


@query("active_customers_united", f"""
  SELECT {quarter('transaction_date')} AS revenue_quarter, branch_region, count(DISTINCT customer_id) AS active_customers, TRUE AS within
  FROM fct WHERE transaction_status = 'COMPLETED' GROUP BY 1, 2""")
def _(b: Bank):
    """Quarters and regions united from stored monthly sketches; whether each is as near the exact
    count as promised."""
    monthly = materialize(serve.customer_sketches(b.fct), work_dir(b.spark, "sketches"), "monthly")
    near = serve.active_customers_united(monthly, F.trunc("revenue_month", "quarter").alias("quarter"), F.col("branch_region").alias("region"))
    exact = marts.completed(b.fct).groupBy(F.trunc("transaction_date", "quarter").alias("revenue_quarter"), "branch_region").agg(
        F.countDistinct("customer_id").alias("active_customers"))
    same = F.col("revenue_quarter").eqNullSafe(F.col("quarter")) & F.col("branch_region").eqNullSafe(F.col("region"))
    off = F.abs(near["active_customers"] - exact["active_customers"]) <= serve.sketch_error() * exact["active_customers"]
    return exact.join(near, same, "left").select("revenue_quarter", "branch_region", exact["active_customers"], off.alias("within"))


def _span(lo: str, hi: str) -> str:
    return f"coalesce(sum(CASE WHEN revenue_month BETWEEN DATE '{lo}' AND DATE '{hi}' THEN revenue_usd ELSE CAST(0 AS DECIMAL(18, 2)) END), 0)"


_FYTD = f"SELECT {_span('2001-04-01', '2001-12-31')} AS now_usd, {_span('2000-04-01', '2000-12-31')} AS prior_usd FROM exec_view"
_CYTD = f"SELECT {_span('2001-01-01', '2001-12-31')} AS now_usd, {_span('2000-01-01', '2000-12-31')} AS prior_usd FROM exec_view"
_DELTA = f"SELECT {dbl('now_usd')} AS fytd_revenue_usd, {dbl('prior_usd')} AS prior_fytd_revenue_usd, {ratio_pct('now_usd - prior_usd', 'prior_usd')} AS delta_pct FROM ytd"


@query("fytd_revenue", _DELTA, ytd=_FYTD)
def _(b: Bank):
    return serve.fytd_revenue(b.exec_view, b.p)


@query("calendar_ytd_revenue", _DELTA, ytd=_CYTD)
def _(b: Bank):
    return serve.fytd_revenue(b.exec_view, b.p, calendar_year=True)


@query("revenue_trend_24m", f"SELECT revenue_month, {dbl('sum(revenue_usd)')} AS revenue_usd FROM exec_view WHERE revenue_month >= DATE '2000-01-01' GROUP BY 1")
def _(b: Bank):
    return serve.revenue_trend(b.exec_view, b.p)


@query("revenue_by_segment", f"SELECT customer_segment, revenue_month, {dbl('sum(revenue_usd)')} AS revenue_usd FROM exec_view GROUP BY 1, 2")
def _(b: Bank):
    return serve.revenue_by_segment(b.exec_view)


@query("revenue_by_region", f"SELECT branch_region, {quarter('revenue_month')} AS revenue_quarter, {dbl('sum(revenue_usd)')} AS revenue_usd FROM exec_view GROUP BY 1, 2")
def _(b: Bank):
    return serve.revenue_by_region(b.exec_view)


@query("active_customer_trend", f"""
  SELECT revenue_month, CAST(sum(active_customers) AS BIGINT) AS active_customers, {dbl('sum(revenue_usd)')} AS revenue_usd,
    {mean2('sum(revenue_usd)', 'sum(active_customers)')} AS revenue_per_active_customer FROM exec_view GROUP BY 1""")
def _(b: Bank):
    return serve.active_customer_trend(b.exec_view)


@query("branch_league", f"""
  SELECT r.branch_id, r.branch_name, r.region, {dbl('r.revenue_usd')} AS revenue_usd, p.customer_count, p.profit AS profit_estimate_usd,
    l.avg_balance, CAST(rank() OVER (ORDER BY r.revenue_usd DESC NULLS LAST) AS INT) AS revenue_rank
  FROM branch_rev r
  LEFT JOIN (SELECT branch_id, count(*) AS customer_count, {dbl('sum(profit2)', 2)} AS profit FROM profit JOIN home USING (customer_id) GROUP BY 1) p USING (branch_id)
  LEFT JOIN (SELECT branch_id, {mean2('sum(outstanding)', 'count(outstanding)')} AS avg_balance FROM amortized JOIN home USING (customer_id) GROUP BY 1) l USING (branch_id)""")
def _(b: Bank):
    return serve.branch_league(b.performance, b.profit, b.stg["accounts"], b.amortized)


_BRANCH = f"SELECT branch_id, branch_name, region, {dbl('revenue_usd')} AS revenue_usd FROM branch_rev"


@query("branch_revenue", _BRANCH)
def _(b: Bank):
    return serve.branch_revenue(b.performance)


@query("branch_top10", f"{_BRANCH} ORDER BY revenue_usd DESC, branch_id LIMIT 10")
def _(b: Bank):
    return serve.branch_top(b.performance)


@query("branch_bottom10", f"{_BRANCH} ORDER BY revenue_usd, branch_id LIMIT 10")
def _(b: Bank):
    return serve.branch_bottom(b.performance)


@query("region_quantiles", """
  SELECT region, quantile_cont(v, 0.0) AS min_revenue, quantile_cont(v, 0.25) AS q1_revenue, quantile_cont(v, 0.5) AS median_revenue,
    quantile_cont(v, 0.75) AS q3_revenue, quantile_cont(v, 1.0) AS max_revenue
  FROM (SELECT region, CAST(revenue_usd AS DOUBLE) AS v FROM branch_rev) GROUP BY 1""")
def _(b: Bank):
    return serve.region_quantiles(b.performance)


@query("account_velocity", f"SELECT {month('open_date')} AS open_month, branch_id, count(*) AS new_account_count FROM stg_accounts GROUP BY 1, 2")
def _(b: Bank):
    return serve.account_velocity(b.stg["accounts"])


@query("default_rate_by_branch", f"""
  SELECT b.branch_id, b.branch_name, b.region, n AS loan_count, pct AS default_rate_pct FROM stg_branches b LEFT JOIN (
    SELECT branch_id, count(*) AS n, {ratio_pct(sum_if('is_default_flag = 1', 'loan_amount'), 'sum(loan_amount)')} AS pct
    FROM amortized JOIN home USING (customer_id) GROUP BY 1) USING (branch_id)""")
def _(b: Bank):
    return serve.default_rate_by_branch(b.amortized, b.stg["accounts"], b.dim_branch)


@query("failed_pct", f"""
  SELECT branch_region, count(*) AS transaction_count, {share_pct('sum(is_failed_flag)', 'count(*)')} AS failed_pct,
    {share_pct('sum(is_high_value_flag)', 'count(*)')} AS high_value_pct FROM fct GROUP BY 1""")
def _(b: Bank):
    return serve.failed_share(b.fct, "branch_region")


@query("fee_contribution", f"""
  SELECT branch_region, {dbl('fee')} AS fee_usd, {dbl('rev')} AS revenue_usd, {ratio_pct('fee', 'rev')} AS fee_contribution_pct FROM (
    SELECT branch_region, {sum_if("transaction_type = 'FEE'")} AS fee, {sum_if(REVENUE)} AS rev FROM fct
    WHERE transaction_status = 'COMPLETED' GROUP BY 1)""")
def _(b: Bank):
    return serve.fee_contribution(b.fct)


@query("region_growth", f"""
  SELECT branch_region, y AS revenue_year, {dbl('net')} AS net_revenue_usd, {dbl('prev')} AS prev_year_revenue, {ratio_pct('net - prev', 'prev')} AS growth_pct
  FROM (SELECT *, lag(net) OVER (PARTITION BY branch_region ORDER BY y) AS prev FROM (
    SELECT branch_region, CAST(year(revenue_month) AS INT) AS y, sum(net_revenue_usd) AS net FROM revenue GROUP BY 1, 2))""")
def _(b: Bank):
    return serve.region_growth(b.revenue)


@query("revenue_by_state", f"SELECT branch_state, {dbl(sum_if(REVENUE))} AS revenue_usd FROM fct WHERE transaction_status = 'COMPLETED' GROUP BY 1")
def _(b: Bank):
    return serve.revenue_by_state(b.fct)


@query("branch_pnl", f"""
  SELECT branch_id, m AS pnl_month, {dbl('rev')} AS revenue_usd, {dbl('ref')} AS refund_usd, {dbl('rev - ref')} AS pnl_usd FROM (
    SELECT branch_id, {month('transaction_date')} AS m, {sum_if(REVENUE)} AS rev, {sum_if("transaction_type = 'REFUND'")} AS ref
    FROM fct WHERE transaction_status = 'COMPLETED' GROUP BY 1, 2)""")
def _(b: Bank):
    return serve.branch_pnl(b.fct)


@query("dormant_accounts", f"""
  SELECT * FROM (SELECT a.account_id, a.customer_id, a.account_status, t.last_txn_date,
    CAST(date_diff('day', t.last_txn_date, {AS_OF}) AS INT) AS idle_days
  FROM stg_accounts a LEFT JOIN (SELECT account_id, max(transaction_date) AS last_txn_date FROM fct GROUP BY 1) t USING (account_id))
  WHERE idle_days IS NULL OR idle_days > 365""")
def _(b: Bank):
    return serve.dormant_accounts(b.stg["accounts"], b.fct, b.p)


# --- ranking and sorting idioms -------------------------------------------------------------


@query("rank_branches_in_region", """
  SELECT branch_id, region, CAST(revenue_usd AS DOUBLE) AS revenue_usd,
    CAST(rank() OVER (PARTITION BY region ORDER BY revenue_usd DESC) AS INT) AS rank FROM branch_rev""")
def _(b: Bank):
    return rows.rank_by(
        serve.branch_revenue(b.performance).select("branch_id", "region", "revenue_usd"), "revenue_usd", ["region"]
    )


@query("top_customers", f"""
  SELECT customer_id, {dbl('profit2', 2)} AS profit_estimate_usd FROM profit ORDER BY profit2 DESC, customer_id LIMIT 25""")
def _(b: Bank):
    return rows.top_n(
        b.profit.select("customer_id", "profit_estimate_usd"), 25, "profit_estimate_usd", ["customer_id"]
    )


@query("risk_value_matrix", "SELECT risk_category, risk_value_segment, count(*) AS customers FROM profit GROUP BY 1, 2")
def _(b: Bank):
    return b.profit.groupBy("risk_category", "risk_value_segment").agg(F.count(F.lit(1)).alias("customers"))


# --- acceptance -----------------------------------------------------------------------------


@query("accept_headline", f"SELECT {dbl('v')} AS tile_value, {dbl('v')} AS view_value, 1 AS ok FROM (SELECT sum(net_revenue_usd) AS v FROM revenue WHERE revenue_month >= DATE '2001-04-01')")
def _(b: Bank):
    return serve.accept_headline(b.exec_view, b.revenue, b.p)


@query("accept_flag_count", f"SELECT {dbl('count(*)')} AS tile_value, {dbl('count(*)')} AS view_value, 1 AS ok FROM fraud")
def _(b: Bank):
    return serve.accept_flag_count(serve.fraud_daily(b.fraud), b.fraud)


@query("accept_branch_rows", f"SELECT {dbl('count(DISTINCT branch_id)')} AS tile_value, {dbl('count(DISTINCT branch_id)')} AS view_value, 1 AS ok FROM performance")
def _(b: Bank):
    return serve.accept_branch_rows(serve.branch_revenue(b.performance), b.performance)
