"""Fraud indicators over the transaction fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bankspark.config import Params
from bankspark.functions import rules
from bankspark.functions.dates import lit_ts
from bankspark.functions.numbers import flag
from bankspark.operators.bursts import burst_hits, with_burst_flag
from bankspark.operators.joins import not_already_in
from bankspark.operators.rows import non_empty

# The reasons in the order they are listed, with the flag each one comes from.
REASONS = (
    ("STATUS_BLOCKED", "is_blocked_flag"),
    ("ROUND_NUMBER_HIGH_VALUE", "is_round_high_value_flag"),
    ("HIGH_VALUE", "is_high_value_flag"),
    ("RAPID_FIRE", "is_rapid_fire_flag"),
)


def rapid_fire_hits(fct: DataFrame, p: Params) -> DataFrame:
    """The accounts and instants that the rapid-fire rule catches."""
    return burst_hits(
        fct, "account_id", "transaction_timestamp", p.rapid_fire_minutes, p.rapid_fire_count
    )


def fraud_indicators(fct: DataFrame, p: Params, hits: DataFrame | None = None) -> DataFrame:
    """Transactions that meet at least one rule, with all reasons. `hits` are the written
    rapid_fire_hits, worked out on the fly if missing."""
    flagged = with_burst_flag(
        fct, "account_id", "transaction_timestamp", p.rapid_fire_minutes, p.rapid_fire_count,
        hits=hits,
    )
    reasons = F.array_compact(
        F.array(*[F.when(F.col(c) == 1, F.lit(reason)) for reason, c in REASONS])
    )
    return non_empty(flagged.withColumn("flag_reasons", reasons), "flag_reasons").select(
        "transaction_sk", "transaction_id", "transaction_timestamp", "transaction_date",
        "account_id", "customer_id", "customer_segment", "customer_risk_category",
        "branch_region", "amount_usd", "currency", "transaction_status", "merchant_category",
        "is_blocked_flag", "is_high_value_flag", "is_round_high_value_flag",
        "is_rapid_fire_flag", "flag_reasons", F.size("flag_reasons").alias("flag_count"),
    )


def fraud_flag(fct: DataFrame, p: Params) -> DataFrame:
    """The documented single flag: blocked, above the documented amount, or rapid-fire."""
    flagged = with_burst_flag(
        fct, "account_id", "transaction_timestamp", p.rapid_fire_minutes, p.rapid_fire_count
    )
    hit = (
        (F.col("is_blocked_flag") == 1)
        | (F.col("amount_usd") > p.fraud_doc_threshold_usd)
        | (F.col("is_rapid_fire_flag") == 1)
    )
    return flagged.withColumn("is_fraud_flag", flag(hit))


def flag_suspicious(
    batch: DataFrame, already: DataFrame | None, p: Params, flagged_at=None, *more: str
) -> DataFrame:
    """New rows for the suspicious-transaction log: first matching reason on the local amount,
    never a transaction that is already in the log. `more` columns of the batch are kept."""
    reason = rules.suspicion_reason(F.col("transaction_status"), F.col("amount"), p)
    hits = batch.withColumn("flag_reason", reason).filter(F.col("flag_reason").isNotNull())
    if already is not None:
        hits = not_already_in(hits, already, "transaction_sk")
    return hits.select(
        "transaction_sk", "transaction_id", "account_id", "amount", "currency", "flag_reason",
        (lit_ts(p.as_of) if flagged_at is None else flagged_at).alias("flagged_at"), *more,
    )


def _delay(happened: str, flagged: str) -> Column:
    return F.unix_seconds(F.col(flagged).cast("timestamp")) - F.unix_seconds(F.col(happened).cast("timestamp"))


def _met(latency: DataFrame) -> DataFrame:
    return latency.withColumn("slo_met", flag(F.col("p95_seconds") < 300))


def flag_latency(flags: DataFrame, happened: str, flagged: str) -> DataFrame:
    """Median and 95th percentile of the seconds from transaction to flag, against the goal of
    five minutes. Exact: counts per distinct delay meet in one task; `flag_latency_of` does without."""
    delay = _delay(happened, flagged)
    return _met(flags.agg(
        F.count(F.lit(1)).alias("flag_count"),
        F.percentile(delay, 0.5).alias("p50_seconds"),
        F.percentile(delay, 0.95).alias("p95_seconds"),
    ))


def delay_sketches(flags: DataFrame, happened: str, flagged: str, k: int = 400) -> DataFrame:
    """Per day of flagging the number of flags and a quantile sketch of their delays, some kilobytes
    whatever the day's size; stored, they are merged for any span of days."""
    return flags.groupBy(F.col(flagged).cast("date").alias("flag_date")).agg(
        F.count(F.lit(1)).alias("flag_count"), F.kll_sketch_agg_bigint(_delay(happened, flagged), k).alias("delays"))


def rank_error(k: int = 400) -> float:
    """How far a quantile's rank may be off: the published error of these sketches at 99 %
    confidence, and half as much again."""
    return 1.5 * 2.296 / k**0.9021


def flag_latency_of(sketches: DataFrame, k: int = 400) -> DataFrame:
    """`flag_latency` from the sketches of some days."""
    merged = sketches.agg(F.sum("flag_count").alias("flag_count"), F.kll_merge_agg_bigint("delays", k).alias("_delays"))
    quantile = lambda p: F.kll_sketch_get_quantile_bigint("_delays", F.lit(p)).cast("double")
    return _met(merged.select("flag_count", quantile(0.5).alias("p50_seconds"), quantile(0.95).alias("p95_seconds")))


def flags_by_reason(fraud: DataFrame, *by: str) -> DataFrame:
    """Flag count and amount per reason (a row counts for each of its reasons)."""
    return (
        fraud.select(*by, "amount_usd", F.explode("flag_reasons").alias("rule"))
        .groupBy(*by, "rule")
        .agg(
            F.count(F.lit(1)).alias("flagged_count"),
            F.sum("amount_usd").alias("flagged_amount_usd"),
        )
    )
