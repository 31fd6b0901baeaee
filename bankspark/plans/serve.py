"""Serving views and dashboard measures over the marts."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from bankspark.config import Params
from bankspark.functions import rules
from bankspark.functions.dates import lit_date, month_start, quarter_start
from bankspark.functions.masks import mask_name
from bankspark.functions.numbers import flag, mean, ratio_pct, share_pct, sum_when
from bankspark.operators.rows import bottom_n, rank_by, top_n
from bankspark.plans.fraud import flags_by_reason
from bankspark.plans.marts import completed, with_previous


def _back_months(as_of: date, n: int):
    return F.add_months(lit_date(as_of), -n)


# --- serving views --------------------------------------------------------------------------


def trailing_activity(fct: DataFrame, p: Params, months: int = 12) -> DataFrame:
    """Count and mean USD amount of each customer's transactions in the last `months`."""
    recent = fct.filter(
        (F.col("transaction_date") > _back_months(p.as_of_date, months))
        & (F.col("transaction_date") <= lit_date(p.as_of_date))
    )
    n = F.count(F.lit(1))
    return recent.groupBy("customer_id").agg(
        n.alias("transaction_count_l12m"),
        F.round(mean(F.sum("amount_usd"), F.count("amount_usd"), 8), 2).alias(
            "avg_transaction_amount_usd"
        ),
    )


def customer_360(
    dim_customer: DataFrame, profitability: DataFrame, fct: DataFrame, p: Params, role: str
) -> DataFrame:
    """Current customers with value, risk and trailing activity; the name as `role` may see it."""
    value = profitability.select(
        "customer_id", F.col("net_revenue_usd").alias("lifetime_value_usd"),
        F.col("profit_estimate_usd").alias("profit_estimate"), "risk_value_segment",
    )
    return (
        dim_customer.filter(F.col("scd_valid_to").isNull())
        .join(value, "customer_id", "left")
        .join(trailing_activity(fct, p), "customer_id", "left")
        .select(
            "customer_sk", "customer_id",
            mask_name(F.col("customer_name"), role).alias("customer_name"),
            "customer_segment", "risk_category", "region",
            F.col("scd_valid_to").isNull().alias("is_current"),
            "lifetime_value_usd", "profit_estimate", "risk_value_segment",
            "transaction_count_l12m", "avg_transaction_amount_usd",
        )
    )


def fraud_daily(fraud: DataFrame) -> DataFrame:
    """Flags by day, region and segment."""
    return fraud.groupBy("transaction_date", "branch_region", "customer_segment").agg(
        F.count(F.lit(1)).alias("flagged_count"),
        F.sum("amount_usd").alias("flagged_amount_usd"),
        F.sum("is_blocked_flag").alias("blocked_count"),
        F.sum("is_round_high_value_flag").alias("round_hv_count"),
        F.sum("is_high_value_flag").alias("hv_count"),
    )


def revenue_exec(revenue: DataFrame) -> DataFrame:
    """Month x segment x region; active customers summed over the risk categories."""
    return revenue.groupBy("revenue_month", "customer_segment", "branch_region").agg(
        F.sum("net_revenue_usd").cast("decimal(28,2)").alias("revenue_usd"),
        F.sum("inflow_txn_count").alias("txn_count"),
        F.sum("active_customers").alias("active_customers"),
    )


def active_customers_exact(fct: DataFrame, error: float | None = None) -> DataFrame:
    """Month x segment x region recount of distinct customers; with `error`, the relative
    standard deviation to accept, a sketch instead of an exact count."""
    customers = (
        F.countDistinct("customer_id") if error is None else F.approx_count_distinct("customer_id", error)
    )
    return (
        completed(fct)
        .groupBy(
            month_start(F.col("transaction_date")).alias("revenue_month"),
            "customer_segment", "branch_region",
        )
        .agg(customers.alias("active_customers"))
    )


def customer_sketches(fct: DataFrame, lg_nominal: int = 12) -> DataFrame:
    """Month x segment x region sketches of the customers with completed transactions. Stored, they
    are united for any quarter, region or total; distinct counts themselves cannot be added up.
    A sketch keeps 2^lg_nominal digests at most, exact below that number."""
    return (
        completed(fct)
        .groupBy(
            month_start(F.col("transaction_date")).alias("revenue_month"),
            "customer_segment", "branch_region",
        )
        .agg(F.theta_sketch_agg("customer_id", lg_nominal).alias("customers"))
    )


def sketch_error(lg_nominal: int = 12, deviations: float = 3) -> float:
    """Relative error that a united count keeps to with so many standard deviations."""
    return deviations / (2**lg_nominal - 1) ** 0.5


def active_customers_united(sketches: DataFrame, *by: str | Column, lg_nominal: int = 12) -> DataFrame:
    """Distinct customers of any grouping of the sketched months, segments and regions."""
    united = sketches.groupBy(*by).agg(F.theta_union_agg("customers", lg_nominal).alias("_united"))
    return united.withColumn("active_customers", F.theta_sketch_estimate("_united")).drop("_united")


# --- revenue dashboard ----------------------------------------------------------------------


def fiscal_start(d: date, start_month: int) -> date:
    return date(d.year if d.month >= start_month else d.year - 1, start_month, 1)


def _year_back(d: date) -> date:
    try:
        return d.replace(year=d.year - 1)
    except ValueError:
        return d.replace(year=d.year - 1, day=28)


def fytd_revenue(exec_view: DataFrame, p: Params, calendar_year: bool = False) -> DataFrame:
    """Revenue of the fiscal (or calendar) year to date and of the same span a year before."""
    today = p.as_of_date
    start = date(today.year, 1, 1) if calendar_year else fiscal_start(today, p.fiscal_year_start_month)
    month, usd = F.col("revenue_month"), F.col("revenue_usd")

    def span(lo: date, hi: date):
        return sum_when(month.between(lit_date(lo), lit_date(hi)), usd).cast("decimal(28,2)")

    return exec_view.agg(
        span(start, today).alias("fytd_revenue_usd"),
        span(_year_back(start), _year_back(today)).alias("prior_fytd_revenue_usd"),
    ).withColumn(
        "delta_pct",
        ratio_pct(
            F.col("fytd_revenue_usd") - F.col("prior_fytd_revenue_usd"),
            F.col("prior_fytd_revenue_usd"),
        ),
    )


def revenue_trend(exec_view: DataFrame, p: Params, months: int = 24) -> DataFrame:
    first = F.add_months(month_start(lit_date(p.as_of_date)), -(months - 1))
    return (
        exec_view.filter(F.col("revenue_month") >= first)
        .groupBy("revenue_month")
        .agg(F.sum("revenue_usd").cast("decimal(28,2)").alias("revenue_usd"))
    )


def revenue_by_segment(exec_view: DataFrame) -> DataFrame:
    return exec_view.groupBy("customer_segment", "revenue_month").agg(
        F.sum("revenue_usd").cast("decimal(28,2)").alias("revenue_usd")
    )


def revenue_by_region(exec_view: DataFrame) -> DataFrame:
    return exec_view.groupBy(
        "branch_region", quarter_start(F.col("revenue_month")).alias("revenue_quarter")
    ).agg(F.sum("revenue_usd").cast("decimal(28,2)").alias("revenue_usd"))


def active_customer_trend(exec_view: DataFrame) -> DataFrame:
    """Active customers and revenue per active customer by month."""
    return (
        exec_view.groupBy("revenue_month")
        .agg(
            F.sum("active_customers").alias("active_customers"),
            F.sum("revenue_usd").cast("decimal(28,2)").alias("revenue_usd"),
        )
        .withColumn(
            "revenue_per_active_customer",
            F.round(mean(F.col("revenue_usd"), F.col("active_customers"), 8), 2),
        )
    )


# --- fraud dashboard ------------------------------------------------------------------------


def open_flags_today(log: DataFrame, p: Params, flagged_at: str = "flagged_at") -> DataFrame:
    return log.filter(F.col(flagged_at) >= lit_date(p.as_of_date)).agg(
        F.count(F.lit(1)).alias("open_flags")
    )


def flagged_amount_by_rule(fraud: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    recent = fraud.filter(F.col("transaction_date") >= lit_date(as_of - timedelta(days=days)))
    return flags_by_reason(recent)


def flag_trend(fraud: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    recent = fraud.filter(F.col("transaction_date") >= lit_date(as_of - timedelta(days=days)))
    return flags_by_reason(recent, "transaction_date")


def high_risk_customers(fraud: DataFrame, as_of: date, days: int = 30, n: int = 20) -> DataFrame:
    """Customers with the largest flagged amount in the last `days`."""
    recent = fraud.filter(
        (F.col("transaction_date") >= lit_date(as_of - timedelta(days=days)))
        & F.col("customer_id").isNotNull()
    )
    per_customer = recent.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("flagged_count"), F.sum("amount_usd").alias("flagged_amount_usd")
    )
    return top_n(per_customer, n, "flagged_amount_usd", ["customer_id"])


def flags_by_region(fraud: DataFrame) -> DataFrame:
    return fraud.groupBy("branch_region").agg(
        F.count(F.lit(1)).alias("flagged_count"), F.sum("amount_usd").alias("flagged_amount_usd")
    )


# --- branch dashboard -----------------------------------------------------------------------


def branch_revenue(performance: DataFrame) -> DataFrame:
    return performance.groupBy("branch_id", "branch_name", "region").agg(
        F.sum("revenue_usd").cast("decimal(28,2)").alias("revenue_usd")
    )


def customer_branch(acct: DataFrame) -> DataFrame:
    """One branch per customer: that of the lowest account id."""
    return acct.groupBy("customer_id").agg(F.min_by("branch_id", "account_id").alias("branch_id"))


def branch_league(
    performance: DataFrame, profitability: DataFrame, acct: DataFrame, loans: DataFrame
) -> DataFrame:
    """Revenue, customers, profit and mean outstanding balance per branch, ranked by revenue.

    Customers and their loans belong to the branch of the customer's lowest account id.
    """
    home = customer_branch(acct)
    people = (
        profitability.select("customer_id", "profit_estimate_usd")
        .join(home, "customer_id")
        .groupBy("branch_id")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("profit_estimate_usd").cast("decimal(28,2)").alias("profit_estimate_usd"),
        )
    )
    balance = (
        loans.select("customer_id", "outstanding_balance_est")
        .join(home, "customer_id")
        .groupBy("branch_id")
        .agg(
            F.round(
                mean(F.sum("outstanding_balance_est"), F.count("outstanding_balance_est"), 8), 2
            ).alias("avg_balance")
        )
    )
    table = (
        branch_revenue(performance)
        .join(people, "branch_id", "left")
        .join(balance, "branch_id", "left")
    )
    return rank_by(table, "revenue_usd", name="revenue_rank")


def branch_top(performance: DataFrame, n: int = 10) -> DataFrame:
    return top_n(branch_revenue(performance), n, "revenue_usd", ["branch_id"])


def branch_bottom(performance: DataFrame, n: int = 10) -> DataFrame:
    return bottom_n(branch_revenue(performance), n, "revenue_usd", ["branch_id"])


def region_quantiles(performance: DataFrame) -> DataFrame:
    """Five-number summary of branch revenue within each region."""
    q = F.percentile(F.col("revenue_usd").cast("double"), F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    names = ("min_revenue", "q1_revenue", "median_revenue", "q3_revenue", "max_revenue")
    return (
        branch_revenue(performance)
        .groupBy("region")
        .agg(q.alias("q"))
        .select("region", *[F.col("q")[i].alias(n) for i, n in enumerate(names)])
    )


def account_velocity(acct: DataFrame) -> DataFrame:
    """New accounts by opening month and branch."""
    return acct.groupBy(month_start(F.col("open_date")).alias("open_month"), "branch_id").agg(
        F.count(F.lit(1)).alias("new_account_count")
    )


def default_rate_by_branch(loans: DataFrame, acct: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Principal-weighted default rate of the loans of each branch's customers."""
    per_branch = (
        loans.join(customer_branch(acct), "customer_id")
        .groupBy("branch_id")
        .agg(
            F.count(F.lit(1)).alias("loan_count"),
            ratio_pct(
                sum_when(F.col("is_default_flag") == 1, F.col("loan_amount")), F.sum("loan_amount")
            ).alias("default_rate_pct"),
        )
    )
    return dim_branch.select("branch_id", "branch_name", "region").join(per_branch, "branch_id", "left")


# --- further documented measures ------------------------------------------------------------


def failed_share(fct: DataFrame, *by: str) -> DataFrame:
    """Failed and high-value transactions in percent of all, whatever their status."""
    n = F.count(F.lit(1))
    return fct.groupBy(*by).agg(
        n.alias("transaction_count"),
        share_pct(F.sum("is_failed_flag"), n).alias("failed_pct"),
        share_pct(F.sum("is_high_value_flag"), n).alias("high_value_pct"),
    )


def fee_contribution(fct: DataFrame) -> DataFrame:
    """Fees in percent of revenue by region."""
    kind, usd = F.col("transaction_type"), F.col("amount_usd")
    fee = sum_when(kind == "FEE", usd).cast("decimal(28,2)")
    revenue = sum_when(rules.is_revenue(kind), usd).cast("decimal(28,2)")
    return completed(fct).groupBy("branch_region").agg(
        fee.alias("fee_usd"), revenue.alias("revenue_usd"),
        ratio_pct(fee, revenue).alias("fee_contribution_pct"),
    )


def region_growth(revenue: DataFrame) -> DataFrame:
    """Yearly net revenue by region with growth on the year before it in the data."""
    yearly = revenue.groupBy("branch_region", F.year("revenue_month").alias("revenue_year")).agg(
        F.sum("net_revenue_usd").cast("decimal(28,2)").alias("net_revenue_usd")
    )
    return with_previous(
        yearly, "branch_region", "revenue_year", "net_revenue_usd", "prev_year_revenue", "growth_pct"
    )


def revenue_by_state(fct: DataFrame) -> DataFrame:
    return completed(fct).groupBy("branch_state").agg(
        sum_when(rules.is_revenue(F.col("transaction_type")), F.col("amount_usd")).cast("decimal(28,2)").alias("revenue_usd")
    )


def branch_pnl(fct: DataFrame) -> DataFrame:
    """Revenue less refunds per branch and month."""
    kind, usd = F.col("transaction_type"), F.col("amount_usd")
    revenue = sum_when(rules.is_revenue(kind), usd).cast("decimal(28,2)")
    refund = sum_when(kind == "REFUND", usd).cast("decimal(28,2)")
    return completed(fct).groupBy(
        "branch_id", month_start(F.col("transaction_date")).alias("pnl_month")
    ).agg(revenue.alias("revenue_usd"), refund.alias("refund_usd"), (revenue - refund).alias("pnl_usd"))


def dormant_accounts(acct: DataFrame, fct: DataFrame, p: Params) -> DataFrame:
    """Accounts without a transaction in the last `dormant_account_days` (or ever)."""
    last = (
        fct.filter(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(F.max("transaction_date").alias("last_txn_date"))
    )
    idle = F.date_diff(lit_date(p.as_of_date), F.col("last_txn_date"))
    return (
        acct.select("account_id", "customer_id", "account_status")
        .join(last, "account_id", "left")
        .withColumn("idle_days", idle)
        .filter(F.col("idle_days").isNull() | (F.col("idle_days") > p.dormant_account_days))
    )


# --- dashboard acceptance -------------------------------------------------------------------


def accept_headline(exec_view: DataFrame, revenue: DataFrame, p: Params) -> DataFrame:
    """Headline tile against the mart it is built from; `ok` within a cent."""
    start = fiscal_start(p.as_of_date, p.fiscal_year_start_month)
    since = F.col("revenue_month") >= lit_date(start)
    tile = exec_view.filter(since).agg(F.sum("revenue_usd").cast("decimal(28,2)").alias("tile_value"))
    view = revenue.filter(since).agg(F.sum("net_revenue_usd").cast("decimal(28,2)").alias("view_value"))
    return _accept(tile, view)


def accept_flag_count(daily: DataFrame, fraud: DataFrame) -> DataFrame:
    """Total of the daily roll-up against the flagged rows."""
    return _accept(
        daily.agg(F.sum("flagged_count").cast("decimal(28,2)").alias("tile_value")),
        fraud.agg(F.count(F.lit(1)).cast("decimal(28,2)").alias("view_value")),
    )


def accept_branch_rows(league: DataFrame, performance: DataFrame) -> DataFrame:
    """Rows of the league table against distinct branches."""
    return _accept(
        league.agg(F.count(F.lit(1)).cast("decimal(28,2)").alias("tile_value")),
        performance.agg(F.countDistinct("branch_id").cast("decimal(28,2)").alias("view_value")),
    )


def _accept(tile: DataFrame, view: DataFrame) -> DataFrame:
    gap = F.abs(F.col("tile_value") - F.col("view_value"))
    return tile.withColumn("view_value", view.scalar()).withColumn("ok", flag(gap <= F.lit("0.01").cast("decimal(18,2)")))
