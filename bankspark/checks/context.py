"""The bank's layers over one data folder, built on first use, and the query registry."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from bankspark.checks.sql import with_models
from bankspark.operators.history import snapshot_check, start_history
from bankspark.plans import dims, enrich, fraud, loans, marts, serve, staging
from bankspark.session import tune
from bankspark.sources import standin

RUN1, RUN2 = datetime(2000, 6, 30), datetime(2001, 6, 30)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables(Mapping):
    """Named frames, each built when first asked for."""

    def __init__(self, names: Iterable[str], build: Callable[[str], DataFrame]):
        self._names, self._build, self._built = list(names), build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Bank:
    """Lazy frames of every layer."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self.p = tune(spark), sf_dir, standin.BANK

    def table(self, name: str) -> DataFrame:
        return standin.source(self.spark, self.dir, name)

    @cached_property
    def raw(self) -> Tables:
        return Tables(standin.FEEDS, lambda name: standin.FEEDS[name](self.spark, self.dir))

    @cached_property
    def stg(self) -> Tables:
        return Tables(standin.FEEDS, lambda name: staging.STAGERS[name](self.raw[name]))

    @cached_property
    def fx(self) -> DataFrame:
        return standin.exchange_rates(self.spark)

    @cached_property
    def enriched(self) -> DataFrame:
        s = self.stg
        return enrich.enrich_transactions(
            s["transactions"], s["accounts"], s["customers"], s["branches"], self.fx, self.p
        )

    @cached_property
    def fct(self) -> DataFrame:
        return enrich.fct_transactions(self.enriched, self.p)

    @cached_property
    def revenue(self) -> DataFrame:
        return marts.revenue_monthly(self.fct)

    @cached_property
    def exec_view(self) -> DataFrame:
        return serve.revenue_exec(self.revenue)

    @cached_property
    def dim_branch(self) -> DataFrame:
        return dims.dim_branch(self.stg["branches"])

    @cached_property
    def performance(self) -> DataFrame:
        return marts.branch_performance(self.fct, self.dim_branch)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dims.dim_customer(self.stg["customers"], start_history(self.stg["customers"], RUN1))

    @cached_property
    def amortized(self) -> DataFrame:
        return loans.amortize_loans(self.stg["loans"], self.p)

    @cached_property
    def loans(self) -> DataFrame:
        return loans.fct_loans(self.amortized, self.dim_customer, self.p)

    @cached_property
    def fraud(self) -> DataFrame:
        return fraud.fraud_indicators(self.fct, self.p)

    @cached_property
    def profit(self) -> DataFrame:
        return marts.customer_profitability(self.dim_customer, self.fct, self.loans, self.p)

    # The customer master before and after a change, and its history after both runs.

    @cached_property
    def cust_before(self) -> DataFrame:
        n = F.substr("customer_id", F.lit(2)).cast("bigint")
        return self.stg["customers"].filter(n % 60 != 7).select(
            "customer_sk", "customer_id",
            F.when(n % 11 == 0, F.upper("customer_name")).otherwise(F.col("customer_name")).alias("customer_name"),
            F.when(n % 10 == 0, "LEGACY").otherwise(F.col("customer_segment")).alias("customer_segment"),
            "risk_category",
            F.when(n % 13 != 0, F.col("region")).alias("region"),
            "onboarding_date", "loaded_at",
        )

    @cached_property
    def cust_after(self) -> DataFrame:
        n = F.substr("customer_id", F.lit(2)).cast("bigint")
        return self.stg["customers"].filter(n % 50 != 49).withColumn(
            "region", F.when(n % 26 != 0, F.col("region"))
        )

    @cached_property
    def cust_history(self) -> DataFrame:
        return snapshot_check(
            start_history(self.cust_before, RUN1), self.cust_after, "customer_id",
            dims.CUSTOMER_CHECK_COLS, RUN2,
        )


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and arrays as text, the forms the checks compare."""

    def shown(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.concat_ws("|", f.name).alias(f.name)
        return F.col(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None, **extra: str):
    """Register a query built from the bank's layers, with the SQL that checks it."""

    def register(build: Callable[[Bank], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(build(Bank(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = with_models(sql, extra)
        return build

    return register
