"""Revenue, branch, KPI and profitability marts over the transaction fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from bankspark.config import Params
from bankspark.functions import rules
from bankspark.functions.dates import lit_date, month_start, quarter_start
from bankspark.functions.numbers import (
    divide, greatest_strict, mean, ratio_pct, share_pct, sum_when,
)


def completed(fct: DataFrame) -> DataFrame:
    return fct.filter(F.col("transaction_status") == "COMPLETED")


def revenue_monthly(fct: DataFrame, outflow: bool = False) -> DataFrame:
    """Month x segment x risk x region revenue.

    Rows are first reduced to one per group and customer, which makes the distinct customer
    count a plain count and spreads a large group over its customers.
    """
    kind, usd = F.col("transaction_type"), F.col("amount_usd")
    group = ["revenue_month", "customer_segment", "customer_risk_category", "branch_region"]
    per_customer = (
        completed(fct)
        .withColumn("revenue_month", month_start(F.col("transaction_date")))
        .groupBy(*group, "customer_id")
        .agg(
            sum_when(rules.is_revenue(kind), usd).alias("inflow"),
            sum_when(kind == "REFUND", usd).alias("refund"),
            sum_when(kind.isin("DEBIT", "TRANSFER"), usd).alias("outflow"),
            F.count_if(rules.is_revenue(kind)).alias("n"),
        )
    )
    totals = per_customer.groupBy(*group).agg(
        F.sum("inflow").cast("decimal(28,2)").alias("inflow_usd"),
        F.sum("refund").cast("decimal(28,2)").alias("refund_usd"),
        F.sum("outflow").cast("decimal(28,2)").alias("outflow_usd"),
        F.sum("n").alias("inflow_txn_count"),
        F.count("customer_id").alias("active_customers"),
    )
    net = (F.col("inflow_usd") - F.col("refund_usd")).cast("decimal(28,2)")
    result = totals.select(
        *group, "inflow_usd", "refund_usd", net.alias("net_revenue_usd"), "inflow_txn_count",
        "active_customers",
        F.round(mean(net, F.col("active_customers"), 8), 2).alias("avg_revenue_per_customer"),
        *(["outflow_usd"] if outflow else []),
    )
    return result


def branch_months(fct: DataFrame) -> DataFrame:
    """Month x branch activity of completed transactions.

    Reduced to one row per month, branch, customer and account before the two distinct counts.
    """
    group = ["performance_month", "branch_id"]
    reduced = (
        completed(fct)
        .filter(F.col("branch_id").isNotNull())
        .withColumn("performance_month", month_start(F.col("transaction_date")))
        .groupBy(*group, "customer_id", "account_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("amount_usd").alias("volume"),
            sum_when(rules.is_revenue(F.col("transaction_type")), F.col("amount_usd")).alias("revenue"),
            F.sum("is_failed_flag").alias("failed"),
            F.sum("is_high_value_flag").alias("high"),
        )
    )
    return reduced.groupBy(*group).agg(
        F.countDistinct("account_id").alias("active_accounts"),
        F.countDistinct("customer_id").alias("active_customers"),
        F.sum("n").alias("transaction_count"),
        F.sum("volume").cast("decimal(28,2)").alias("total_volume_usd"),
        F.sum("revenue").cast("decimal(28,2)").alias("revenue_usd"),
        F.sum("failed").alias("failed_count"),
        F.sum("high").alias("high_value_count"),
    )


def branch_performance(fct: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Month x branch activity with the branch's attributes."""
    return branch_performance_of(branch_months(fct), dim_branch)


def branch_performance_of(per_branch: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """The same from `branch_months`, the aggregate joined with the branches."""
    return per_branch.join(
        dim_branch.select("branch_id", "branch_name", "city", "state", "region"), "branch_id"
    ).select(
        "performance_month", "branch_id", "branch_name", "city", "state", "region",
        "active_accounts", "active_customers", "transaction_count", "total_volume_usd",
        "revenue_usd", "failed_count", "high_value_count",
        share_pct(F.col("failed_count"), F.col("transaction_count")).alias("failed_pct"),
    )


def customer_txn_agg(fct: DataFrame, *by: str) -> DataFrame:
    """Revenue, refunds, counts and first/last date per customer (and `by`)."""
    done = F.col("transaction_status") == "COMPLETED"
    kind, usd = F.col("transaction_type"), F.col("amount_usd")
    return fct.groupBy(*by, "customer_id").agg(
        sum_when(rules.is_revenue(kind) & done, usd).alias("total_revenue_usd"),
        sum_when((kind == "REFUND") & done, usd).alias("total_refund_usd"),
        F.count(F.lit(1)).alias("total_txn_count"),
        F.sum("is_failed_flag").alias("failed_txn_count"),
        F.sum("is_high_value_flag").alias("high_value_txn_count"),
        F.min("transaction_date").alias("first_txn_date"),
        F.max("transaction_date").alias("last_txn_date"),
    )


def customer_txn_total(parts: DataFrame) -> DataFrame:
    """The same per customer from the aggregates of several spans of time."""
    return parts.groupBy("customer_id").agg(
        F.sum("total_revenue_usd").alias("total_revenue_usd"),
        F.sum("total_refund_usd").alias("total_refund_usd"),
        F.sum("total_txn_count").alias("total_txn_count"),
        F.sum("failed_txn_count").alias("failed_txn_count"),
        F.sum("high_value_txn_count").alias("high_value_txn_count"),
        F.min("first_txn_date").alias("first_txn_date"),
        F.max("last_txn_date").alias("last_txn_date"),
    )


def customer_loan_agg(loans: DataFrame) -> DataFrame:
    """Count, principal, outstanding, defaults and mean rate per customer."""
    return loans.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("loan_count"),
        F.sum("loan_amount").alias("total_loan_principal"),
        F.sum("outstanding_balance_est").alias("total_outstanding_usd"),
        F.sum("is_default_flag").alias("defaulted_loan_count"),
        mean(F.sum("interest_rate"), F.count("interest_rate"), 8).alias("avg_interest_rate"),
    )


def customer_profitability(
    dim_customer: DataFrame, fct: DataFrame, loans: DataFrame, p: Params
) -> DataFrame:
    """Customer-grain profitability: net revenue less an interest carrying-cost proxy."""
    return customer_profitability_of(dim_customer, customer_txn_agg(fct), loans, p)


def customer_profitability_of(
    dim_customer: DataFrame, txn: DataFrame, loans: DataFrame, p: Params
) -> DataFrame:
    """The same from the transactions per customer."""
    loan = customer_loan_agg(loans)

    def money(c: str):
        return F.coalesce(F.col(c), F.lit(0)).cast("decimal(18,2)").alias(c)

    def number(c: str):
        return F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)

    joined = (
        dim_customer.join(txn, "customer_id", "left")
        .join(loan, "customer_id", "left")
        .select(
            "customer_sk", "customer_id", "customer_name", "customer_segment", "risk_category",
            "region", "onboarding_date",
            F.date_diff(lit_date(p.as_of_date), F.col("onboarding_date")).alias("tenure_days"),
            money("total_revenue_usd"),
            money("total_refund_usd"),
            (
                F.coalesce("total_revenue_usd", F.lit(0)) - F.coalesce("total_refund_usd", F.lit(0))
            ).cast("decimal(18,2)").alias("net_revenue_usd"),
            number("total_txn_count"),
            number("failed_txn_count"),
            number("high_value_txn_count"),
            "first_txn_date",
            "last_txn_date",
            number("loan_count"),
            money("total_loan_principal"),
            money("total_outstanding_usd"),
            number("defaulted_loan_count"),
            F.coalesce("avg_interest_rate", F.lit(0)).cast("decimal(12,8)").alias(
                "avg_loan_interest_rate"
            ),
        )
    )
    # Scales follow the warehouse's decimal division: 12 digits for rates, 6 for months.
    monthly_rate = (F.col("avg_loan_interest_rate") / 100).cast("decimal(14,12)")
    monthly_cost = (
        (F.col("total_outstanding_usd") * monthly_rate).cast("decimal(30,12)") / 12
    ).cast("decimal(26,12)")
    months = greatest_strict(
        (F.col("tenure_days") / F.lit(30).cast("decimal(2,0)")).cast("decimal(12,6)"),
        F.lit(1).cast("decimal(12,6)"),
    )
    cost = monthly_cost * months
    return (
        joined.withColumn("cost_of_funds_proxy_usd", F.round(cost, 2).cast("decimal(18,2)"))
        .withColumn(
            "profit_estimate_usd", F.round(F.col("net_revenue_usd") - cost, 2).cast("decimal(18,2)")
        )
        .withColumn(
            "risk_value_segment",
            rules.risk_value_segment(
                F.col("risk_category"), F.col("net_revenue_usd"), p.high_net_revenue_usd
            ),
        )
    )


def quarterly_base(revenue: DataFrame) -> DataFrame:
    """Quarter x region sums of the monthly revenue mart."""
    return revenue.groupBy(
        quarter_start(F.col("revenue_month")).alias("revenue_quarter"), "branch_region"
    ).agg(
        F.sum("net_revenue_usd").cast("decimal(28,2)").alias("net_revenue_usd"),
        F.sum("inflow_usd").cast("decimal(28,2)").alias("gross_inflow_usd"),
        F.sum("refund_usd").cast("decimal(28,2)").alias("refund_usd"),
        F.sum("inflow_txn_count").alias("inflow_txn_count"),
        mean(F.sum("active_customers"), F.count("active_customers"), 6).alias("avg_active_customers"),
    )


def with_previous(
    df: DataFrame, part: str, order: str, value: str, previous: str, growth: str
) -> DataFrame:
    """The value of the part's previous row and the growth on it in percent."""
    lagged = F.lag(value).over(Window.partitionBy(part).orderBy(F.col(order).asc_nulls_last()))
    return df.withColumn(previous, lagged).withColumn(
        growth, ratio_pct(F.col(value) - F.col(previous), F.col(previous))
    )


def quarterly_kpis(revenue: DataFrame) -> DataFrame:
    """Quarterly KPIs with growth on the region's previous quarter and share of the quarter.

    The windows run over quarter x region rows, a few per region.
    """
    grown = with_previous(
        quarterly_base(revenue), "branch_region", "revenue_quarter", "net_revenue_usd",
        "prev_quarter_revenue", "qoq_growth_pct",
    )
    total = F.sum("net_revenue_usd").over(Window.partitionBy("revenue_quarter"))
    return grown.withColumn(
        "region_revenue_contribution_pct", ratio_pct(F.col("net_revenue_usd"), total)
    )


def nim_quarterly(fct: DataFrame, loans: DataFrame) -> DataFrame:
    """Net interest margin proxy per quarter: completed interest less a quarter of the yearly
    carrying cost, in percent of the outstanding balance."""
    owed = F.col("outstanding_balance_est")
    quarter_cost = F.round(owed * F.col("interest_rate") / 400, 2).cast("decimal(18,2)")
    book_owed = loans.agg(F.sum(owed).cast("decimal(28,2)")).scalar()
    book_cost = loans.agg(F.sum(quarter_cost).cast("decimal(28,2)")).scalar()
    interest = (
        completed(fct)
        .filter(F.col("transaction_type") == "INTEREST")
        .groupBy(quarter_start(F.col("transaction_date")).alias("quarter"))
        .agg(F.sum("amount_usd").cast("decimal(28,2)").alias("interest_usd"))
    )
    priced = interest.withColumn("outstanding_usd", book_owed).withColumn("quarter_cost_usd", book_cost)
    margin = F.col("interest_usd") - F.col("quarter_cost_usd")
    return priced.withColumn("nim_pct", ratio_pct(margin, F.col("outstanding_usd"), 4))
