"""The bank's raw feeds derived from the benchmark tables, with realistic dirt.

Every customer and order becomes one or more raw rows: customers and accounts from `customer`,
transactions and loans from `orders`, branches from `nation` and `region`, the change stream
from `events`. Derivations use integer arithmetic on the keys only, so that any SQL engine
gets the same rows. Dirt: padded and lower-case codes, missing fields, soft-deleted rows,
older copies of a row, orphan references, odd amounts.
"""

from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from bankspark.config import Params
from bankspark.schemas import EXCHANGE_RATES
from bankspark.sources.calendar import calendar_of
from bankspark.sources import files

BANK = Params(as_of=datetime(2001, 12, 31))
EVENTS = Params(as_of=datetime(2024, 1, 31))

# Codes of the raw feeds.
ACCOUNT_TYPES = ("SAVINGS", "CHECKING", "CREDIT_CARD", "BROKERAGE", "WEALTH")
TXN_TYPES = ("DEBIT", "CREDIT", "TRANSFER", "FEE", "INTEREST", "REFUND")
CURRENCIES = ("USD", "INR", "EUR", "GBP")
LOAN_TYPES = ("HOME", "AUTO", "PERSONAL", "BUSINESS", "EDUCATION", "GOLD")
MERCHANT_CATEGORIES = (
    "GROCERY", "TRAVEL", "ELECTRONICS", "HEALTHCARE", "ATM_WITHDRAWAL",
    "DINING", "UTILITIES", "ECOMMERCE", "INVESTMENT", "INSURANCE",
)
EVENT_STATUS = {
    "signup": "COMPLETED", "view": "COMPLETED", "click": "PENDING",
    "purchase": "COMPLETED", "error": "BLOCKED",
}
RATE_YEARS = range(1995, 2002)
BASE_RATES = {"USD": "1.0", "INR": "0.01205", "EUR": "1.088", "GBP": "1.272"}

SYNC = "timestamp_ntz'2001-12-31 00:00:00'"


_schemas: dict[str, StructType] = {}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table. These never change, so the schema in a file is looked up once."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    if path not in _schemas:
        _schemas[path] = files.source(spark, sf_dir, name).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _pick(values: tuple[str, ...], index: str) -> str:
    """SQL: the value at a zero-based index."""
    items = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({items}), cast({index} as int) + 1)"


def _copies(df: DataFrame, has_older_copy: str) -> DataFrame:
    """Column `copy`: 0 for the row itself, 1 for an older copy of some rows."""
    return df.selectExpr(
        "*", f"explode(if({has_older_copy}, array(0, 1), array(0))) as copy"
    )


def rate_rows() -> list[tuple[str, Decimal, date]]:
    """Rates for January and June of each year; they drift by 0.001 a year, except USD."""
    return [
        (c, Decimal(base) + (Decimal("0.001") * (y - 1995) if c != "USD" else 0), date(y, m, 1))
        for c, base in BASE_RATES.items()
        for y in RATE_YEARS
        for m in (1, 6)
    ]


def exchange_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rate_rows(), EXCHANGE_RATES)


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = source(spark, sf_dir, "nation"), source(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def raw_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _geo(spark, sf_dir).selectExpr(
        "concat(' br', lpad(cast(n_nationkey as string), 3, '0')) as branch_id",
        "concat('main-branch ', n_name) as branch_name",
        "concat(' CITY ', cast(n_nationkey as string)) as city",
        "concat('s', lpad(cast(n_nationkey % 10 as string), 2, '0')) as state",
        "r_name as region",
        f"timestampadd(MINUTE, -n_nationkey, {SYNC}) as _synced",
        "n_nationkey = 24 as _deleted",
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    geo = _geo(spark, sf_dir)
    customer = source(spark, sf_dir, "customer")
    rows = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    code = "concat('C', lpad(cast(c_custkey as string), 8, '0'))"
    return _copies(rows, "c_custkey % 97 = 0").selectExpr(
        f"if(c_custkey % 17 = 0, concat('  ', lower({code}), ' '), {code}) as customer_id",
        "if(c_custkey % 31 = 0, null, concat(' ', lower(c_name), ' ', upper(n_name), ' '))"
        " as customer_name",
        "case when c_custkey % 23 = 0 then null when c_custkey % 19 = 0"
        " then lower(c_mktsegment) else c_mktsegment end as customer_segment",
        "case when copy = 1 then 'HIGH' when c_custkey % 29 = 0 then 'n/a'"
        " when c_acctbal < 0 then 'high' when c_acctbal < 3000 then ' MEDIUM'"
        " else 'LOW' end as risk_category",
        "r_name as region",
        "date_add(date'1993-01-01', cast(c_custkey % 700 as int)) as onboarding_date",
        f"timestampadd(MINUTE, -cast(c_custkey % 1440 + copy * 1440 as int), {SYNC}) as _synced",
        "c_custkey % 101 = 0 as _deleted",
    )


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = source(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_nationkey", "explode(array(0, 1)) as k"
    ).selectExpr("*", "c_custkey * 2 + k as n")
    code = "concat('A', lpad(cast(n as string), 9, '0'))"
    return _copies(numbered, "n % 97 = 0").selectExpr(
        f"if(n % 13 = 0, lower({code}), {code}) as account_id",
        "if(n % 211 = 0, 'C99999999', concat('C', lpad(cast(c_custkey as string), 8, '0')))"
        " as customer_id",
        f"{_pick(ACCOUNT_TYPES, 'n % 5')} as account_type",
        "concat('BR', lpad(cast((c_nationkey + k) % 25 as string), 3, '0')) as branch_id",
        "case when copy = 1 then 'FROZEN' when n % 20 = 0 then 'DORMANT'"
        " when n % 20 = 1 then 'CLOSED' when n % 20 = 2 then null when n % 20 = 3 then 'frozen'"
        " else 'ACTIVE' end as account_status",
        "date_add(date'1994-01-01', cast(n % 2500 as int)) as open_date",
        f"timestampadd(MINUTE, -cast(n % 1440 + copy * 1440 as int), {SYNC}) as _synced",
        "n % 101 = 0 as _deleted",
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Every 250th payment is the first of four within half an hour; the others have numbers of
    # their own beyond those of the orders, and with them their own type, status and dirt.
    orders = source(spark, sf_dir, "orders").selectExpr(
        "*", "explode(if(o_orderkey % 250 = 7, array(0, 1, 2, 3), array(0))) as burst"
    ).selectExpr(
        "o_orderkey + cast(burst as bigint) * 1000000100 as n", "o_custkey", "o_totalprice",
        "timestampadd(SECOND, cast((o_orderkey * 7919) % 86400 as int) + burst * 600, o_orderdate) as at",
    )
    code = "concat('T', lpad(cast(n as string), 10, '0'))"
    return _copies(orders, "n % 97 = 0").selectExpr(
        f"if(n % 7 = 0, concat(' ', lower({code})), {code}) as transaction_id",
        "concat('A', lpad(cast(o_custkey * 2 + n % 2 as string), 9, '0')) as account_id",
        f"{_pick(TXN_TYPES, 'n % 6')} as transaction_type",
        "cast(case when n % 113 = 0 then null"
        " when n % 50 = 0 then cast(floor(o_totalprice / 1000) * 1000 as decimal(18, 0))"
        " else cast(floor(o_totalprice * 5) as decimal(18, 0)) * 0.01 end as decimal(18, 2))"
        " as amount",
        f"{_pick(CURRENCIES, 'o_custkey % 4')} as currency",
        f"{_pick(MERCHANT_CATEGORIES, 'n % 10')} as merchant_category",
        "at as transaction_timestamp",
        "case when copy = 1 then 'PENDING' when n % 20 = 0 then 'blocked'"
        " when n % 20 = 1 then 'FAILED' when n % 20 = 2 then 'PENDING'"
        " when n % 20 = 3 then 'REVERSED' when n % 37 = 0 then null"
        " else 'COMPLETED' end as transaction_status",
        "timestampadd(SECOND, cast(60 + n % 600 - copy * 50 as int), at) as _synced",
        "n % 101 = 0 as _deleted",
    )


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = source(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as n", "o_custkey", "o_totalprice", "cast(o_orderdate as date) as day"
    )
    return _copies(orders, "n % 97 = 0").selectExpr(
        "concat('L', lpad(cast(n as string), 9, '0')) as loan_id",
        "concat('c', lpad(cast(o_custkey as string), 8, '0')) as customer_id",
        f"{_pick(LOAN_TYPES, 'n % 6')} as loan_type",
        "cast(o_totalprice as decimal(18, 2)) as loan_amount",
        "cast(if(n % 401 = 0, 3500, 450 + n % 1350) * 0.01 as decimal(6, 2)) as interest_rate",
        "cast(case when n % 70 = 3 then null when n % 80 = 3 then 0"
        " else 500 + n % 9000 end as decimal(18, 2)) as emi_amount",
        "case when copy = 1 then 'ACTIVE' when n % 25 = 3 then 'DEFAULTED'"
        " when n % 25 = 13 then 'delinquent' when n % 50 = 23 then 'WRITTEN_OFF'"
        " when n % 50 = 33 then 'CLOSED' else 'ACTIVE' end as loan_status",
        "date_add(day, if(n % 307 = 0, 3000, 0)) as disbursement_date",
        f"timestampadd(MINUTE, -cast(n % 1440 + copy * 1440 as int), {SYNC}) as _synced",
        "n % 101 = 0 as _deleted",
    )


def raw_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_of(source(spark, sf_dir, "orders"), "o_orderdate").selectExpr(
        "*", f"{SYNC} as _synced", "false as _deleted"
    )


FEEDS = {
    "customers": raw_customers,
    "accounts": raw_accounts,
    "transactions": raw_transactions,
    "loans": raw_loans,
    "branches": raw_branches,
    "calendar": raw_calendar,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in FEEDS.items()}


def stream_payments(events: DataFrame) -> DataFrame:
    """The events feed as raw transactions of the change stream (batch or streaming frame)."""
    status = "case event_type " + " ".join(
        f"when '{k}' then '{v}'" for k, v in EVENT_STATUS.items()
    ) + " end"
    return events.selectExpr(
        "concat('E', lpad(cast(event_id as string), 10, '0')) as transaction_id",
        "concat('A', lpad(cast(user_id as string), 9, '0')) as account_id",
        "upper(event_type) as transaction_type",
        "cast(case when event_id % 40 = 0 then floor(value) * 1000 else floor(value * 100) end"
        " as decimal(18, 2)) as amount",
        f"{_pick(CURRENCIES, 'user_id % 4')} as currency",
        f"{_pick(MERCHANT_CATEGORIES, 'event_id % 10')} as merchant_category",
        "ts as transaction_timestamp",
        f"{status} as transaction_status",
    )


def query_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement log made from the events feed."""
    return source(spark, sf_dir, "events").selectExpr(
        "concat('user_', cast(user_id as string)) as user_name",
        f"{_pick(('FIN_ADMIN', 'DBT_TRANSFORMER', 'BI_READER'), 'user_id % 3')} as role_name",
        "concat('create table t as select 1 ',"
        " if(event_id % 3 = 0, 'insert into', 'INSERT  INTO'),"
        " ' MART_', cast(event_id % 5 as string), ' values') as query_text",
        f"{_pick(('BANK', 'OTHER'), 'if(event_id % 5 = 0, 1, 0)')} as database_name",
        "concat('SCHEMA_', cast(event_id % 4 as string)) as schema_name",
        f"{_pick(('SELECT', 'CREATE_TABLE_AS_SELECT', 'MERGE', 'UPDATE', 'DELETE', 'INSERT', 'GRANT'), 'event_id % 7')}"
        " as query_type",
        "ts as start_time",
        f"{_pick(('SUCCESS', 'FAIL'), 'if(event_id % 11 = 0, 1, 0)')} as execution_status",
        "cast(floor(value * 100) as bigint) as total_elapsed_time",
        "cast(floor(value * 80) as bigint) as execution_time",
        "concat(if(event_id % 2 = 0, 'project=bank', 'project=other'), ';run=',"
        " cast(event_id % 20 as string)) as query_tag",
        "cast(event_id % 100 as decimal(18, 4)) as credits_used",
        "cast((event_id % 10) * 0.25 as decimal(18, 4)) as credits_used_cloud_services",
    )
