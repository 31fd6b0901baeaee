"""Currency conversion against a (currency, month) rate seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from bankspark.functions.dates import month_start


def _one() -> Column:
    return F.lit(1).cast("decimal(18,6)")


def monthly_rates(fx: DataFrame) -> DataFrame:
    """One rate per currency and month (the highest, should the seed repeat one)."""
    return fx.groupBy(
        F.upper("currency").alias("_ccy"), month_start(F.col("effective_month")).alias("_fx_month")
    ).agg(F.max("rate_to_usd").alias("_rate"))


def fx_exact_month(df: DataFrame, fx: DataFrame, currency: str, day: str) -> DataFrame:
    """Adds `rate_to_usd`: the rate of the row's own month, 1.0 where the seed has none."""
    rates = monthly_rates(fx)
    match = (F.col(currency) == F.col("_ccy")) & (month_start(F.col(day)) == F.col("_fx_month"))
    return (
        df.join(rates, match, "left")
        .withColumn("rate_to_usd", F.coalesce("_rate", _one()))
        .withColumn("is_fx_defaulted", F.col("_rate").isNull())
        .drop("_ccy", "_fx_month", "_rate")
    )


def convert_to_usd(
    df: DataFrame, fx: DataFrame, amount: str, currency: str, day: str, out: str = "amount_usd"
) -> DataFrame:
    """Adds the amount in USD, to the cent, at the rate of the row's month."""
    rated = fx_exact_month(df, fx, currency, day)
    return rated.withColumn(out, to_usd(F.col(amount), F.col("rate_to_usd"))).drop(
        "rate_to_usd", "is_fx_defaulted"
    )


def to_usd(amount: Column, rate: Column) -> Column:
    return F.round(amount * rate, 2).cast("decimal(18,2)")


def fx_as_of(df: DataFrame, fx: DataFrame, currency: str, day: str) -> DataFrame:
    """Adds `rate_to_usd`: the latest rate at or before the row's day, 1.0 before the first.

    Rates hold from the start of a month, so they are laid out as one row per currency and
    month up to the last month that has any rate; a row looks up its own month, or that last
    one if it is later. This makes the as-of match an equi-join.
    """
    rates = monthly_rates(fx)
    last_month = rates.agg(F.max("_fx_month")).scalar()
    following = F.lead("_fx_month").over(Window.partitionBy("_ccy").orderBy("_fx_month"))
    until = F.coalesce(F.add_months(following, -1), last_month)
    dense = rates.withColumn("_until", until).select(
        "_ccy",
        "_rate",
        F.explode(F.sequence("_fx_month", "_until", F.expr("interval 1 month"))).alias("_in_month"),
    )
    wanted = F.least(month_start(F.col(day)), last_month)
    return (
        df.withColumn("_wanted", wanted)
        .join(dense, (F.col(currency) == F.col("_ccy")) & (F.col("_wanted") == F.col("_in_month")), "left")
        .withColumn("rate_to_usd", F.coalesce("_rate", _one()))
        .drop("_wanted", "_ccy", "_rate", "_in_month")
    )
