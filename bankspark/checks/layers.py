"""Queries: sources, staging, enrichment, joins."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import functions as F

from bankspark import schemas
from bankspark.checks.context import RUN2, Bank, query
from bankspark.checks.sql import AS_OF, REVENUE, T1, T2, cents, code, dbl, month, rdiv, sum_if, title
from bankspark.functions import cleanse, rules
from bankspark.functions.numbers import annuity_emi, flag
from bankspark.operators import fx, joins, quality, rows
from bankspark.operators.changes import sync_columns
from bankspark.operators.history import (
    current_rows, overwrite_type1, snapshot_check, start_history, with_version_key,
)
from bankspark.plans import dims, enrich, marts, staging
from bankspark.sources import sinks
from bankspark.session import work_dir
from bankspark.sources.files import land, load, read_csv, read_seed
from bankspark.sources.ledger import load_new

# --- sources --------------------------------------------------------------------------------


@query("source_scan", "SELECT * FROM orders")
def _(b: Bank):
    return b.table("orders")


@query("land_audit", """
  SELECT c_custkey, c_name, TIMESTAMP '2001-12-31 00:00:00' AS _synced, false AS _deleted FROM customer""")
def _(b: Bank):
    return land(b.table("customer").select("c_custkey", "c_name"), b.p.as_of)


@query("row_counts", """
  SELECT 'customers' AS table_name, count(*) AS row_count FROM raw_customers
  UNION ALL SELECT 'accounts', count(*) FROM raw_accounts
  UNION ALL SELECT 'transactions', count(*) FROM raw_transactions
  UNION ALL SELECT 'loans', count(*) FROM raw_loans
  UNION ALL SELECT 'branches', count(*) FROM raw_branches
  UNION ALL SELECT 'calendar', count(*) FROM raw_calendar""")
def _(b: Bank):
    return quality.row_counts(b.raw)


@query("seed_rates", """
  SELECT currency, CAST(rate_to_usd AS DOUBLE) AS rate_to_usd, effective_month, coalesce(n, 0) AS n FROM fx LEFT JOIN (
    SELECT currency AS c, date_trunc('month', transaction_date) AS m, count(*) AS n
    FROM stg_transactions GROUP BY 1, 2) ON c = currency AND m = effective_month""")
def _(b: Bank):
    """The rates written as a seed file and read back, with the transactions each applies to."""
    path = work_dir(b.spark, "seed")
    b.fx.write.csv(path, header=True)
    used = b.stg["transactions"].groupBy(
        F.col("currency"), F.trunc("transaction_date", "month").alias("effective_month")
    ).agg(F.count(F.lit(1)).alias("n"))
    rates = read_seed(b.spark, path, schemas.EXCHANGE_RATES)
    return rates.join(used, ["currency", "effective_month"], "left").fillna(0, ["n"])


@query("calendar_source", "SELECT date_key, month, quarter, year, fiscal_period FROM raw_calendar")
def _(b: Bank):
    return b.raw["calendar"].drop("_synced", "_deleted")


@query("as_view", f"SELECT r_name, count(*) AS customers FROM customer JOIN geo ON c_nationkey = n_nationkey GROUP BY 1")
def _(b: Bank):
    geo = sinks.as_view(b.table("nation"), "bank_nation")
    sinks.as_view(b.table("region"), "bank_region")
    sinks.as_view(b.table("customer"), "bank_customer")
    return geo.sparkSession.sql(
        "SELECT r_name, count(*) AS customers FROM bank_customer"
        " JOIN bank_nation ON c_nationkey = n_nationkey"
        " JOIN bank_region ON n_regionkey = r_regionkey GROUP BY r_name"
    )


@query("sync_columns", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS tier, c_name FROM customer")
def _(b: Bank):
    target = b.table("customer")
    incoming = target.select("c_custkey", F.lit("GOLD").alias("tier"), "c_name")
    return sync_columns(target, incoming)


@query("date_or_serial", """
  SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""")
def _(b: Bank):
    text = (
        F.when(F.col("o_orderkey") % 9 == 0, "not a date")
        .when(
            F.col("o_orderkey") % 2 == 0,
            F.date_diff(F.col("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date")).cast("string"),
        )
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    return b.table("orders").select("o_orderkey", cleanse.parse_date_or_serial(text).alias("day"))




@query("sync_reimport", "SELECT customer_id, customer_name, TIMESTAMP '2001-06-30 00:00:00' AS _synced, false AS _deleted FROM cust_after")
def _(b: Bank):
    cols = ["customer_id", "customer_name"]
    old = land(b.cust_before.select(*cols), datetime(2000, 6, 30))
    return sinks.sync(old, b.cust_after.select(*cols), "reimport", "customer_id", RUN2)


@query("sync_upsert", f"""
  SELECT customer_id, customer_name, {T2} AS _synced, false AS _deleted FROM cust_after
  UNION ALL SELECT customer_id, customer_name, {T1}, false FROM cust_before
  WHERE customer_id NOT IN (SELECT customer_id FROM cust_after)""")
def _(b: Bank):
    cols = ["customer_id", "customer_name"]
    old = land(b.cust_before.select(*cols), datetime(2000, 6, 30))
    return sinks.sync(old, b.cust_after.select(*cols), "upsert", "customer_id", RUN2)


@query("sync_soft_delete", f"""
  SELECT customer_id, customer_name, {T2} AS _synced, false AS _deleted FROM cust_after
  UNION ALL SELECT customer_id, customer_name, {T2}, true FROM cust_before
  WHERE customer_id NOT IN (SELECT customer_id FROM cust_after)""")
def _(b: Bank):
    cols = ["customer_id", "customer_name"]
    old = land(b.cust_before.select(*cols), datetime(2000, 6, 30))
    return sinks.sync(old, b.cust_after.select(*cols), "soft_delete", "customer_id", RUN2)


# --- cleansing and staging ------------------------------------------------------------------

_AMOUNT = "CAST(amount AS DOUBLE) AS amount"


@query("soft_delete_filter", "SELECT account_id, account_status FROM raw_accounts WHERE NOT _deleted")
def _(b: Bank):
    return rows.drop_deleted(b.raw["accounts"]).select("account_id", "account_status")


@query("require_not_null", f"SELECT transaction_id, {_AMOUNT} FROM raw_transactions WHERE transaction_id IS NOT NULL AND amount IS NOT NULL")
def _(b: Bank):
    return rows.require(b.raw["transactions"], ["transaction_id", "amount"]).select("transaction_id", "amount")


@query("normalise_text", f"""
  SELECT customer_id AS raw_id, {code('customer_id')} AS id, {title('customer_name')} AS name,
    {title("'o''brien-smith ' || customer_name")} AS long_name,
    coalesce({code('customer_segment')}, 'UNKNOWN') AS segment,
    CASE WHEN {code('risk_category')} IN ('LOW', 'MEDIUM', 'HIGH') THEN {code('risk_category')} ELSE 'UNKNOWN' END AS risk
  FROM raw_customers""")
def _(b: Bank):
    c = F.col
    return b.raw["customers"].select(
        c("customer_id").alias("raw_id"),
        cleanse.norm_code(c("customer_id")).alias("id"),
        cleanse.norm_name(c("customer_name")).alias("name"),
        cleanse.norm_name(F.concat(F.lit("o'brien-smith "), c("customer_name"))).alias("long_name"),
        cleanse.default_unknown(c("customer_segment")).alias("segment"),
        cleanse.canonical(c("risk_category"), ("LOW", "MEDIUM", "HIGH")).alias("risk"),
    )


@query("surrogate_keys", f"""
  SELECT l_orderkey, l_linenumber, l_shipdate,
    md5(CAST(l_orderkey AS VARCHAR) || '-' || CASE WHEN l_linenumber = 1 THEN '_dbt_utils_surrogate_key_null_' ELSE CAST(l_linenumber AS VARCHAR) END) AS line_sk,
    md5(CAST(l_orderkey AS VARCHAR)) AS raw_sk FROM lineitem""")
def _(b: Bank):
    line = F.when(F.col("l_linenumber") != 1, F.col("l_linenumber"))
    return b.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate",
        cleanse.surrogate_key(F.col("l_orderkey"), line).alias("line_sk"),
        cleanse.md5_key(F.col("l_orderkey")).alias("raw_sk"),
    )


@query("zero_to_null", "SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_discount, 0) AS l_discount FROM lineitem")
def _(b: Bank):
    return b.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", cleanse.zero_to_null(F.col("l_discount")).alias("l_discount")
    )


@query("dedup_latest", """
  SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
      l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""")
def _(b: Bank):
    return rows.latest_per_key(
        b.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"),
        ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey", "l_suppkey", "l_extendedprice"],
    )


@query("stg_customers", "SELECT * FROM stg_customers")
def _(b: Bank):
    return b.stg["customers"]


@query("stg_accounts", "SELECT * FROM stg_accounts")
def _(b: Bank):
    return b.stg["accounts"]


@query("stg_transactions", f"SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM stg_transactions")
def _(b: Bank):
    return b.stg["transactions"]


_LOAN_DBL = "CAST(loan_amount AS DOUBLE) AS loan_amount, CAST(interest_rate AS DOUBLE) AS interest_rate, CAST(emi_amount AS DOUBLE) AS emi_amount"


@query("stg_loans", f"SELECT * REPLACE ({_LOAN_DBL}) FROM stg_loans")
def _(b: Bank):
    return b.stg["loans"]


@query("stg_branches", "SELECT b.*, n AS accounts FROM stg_branches b LEFT JOIN (SELECT branch_id, count(*) AS n FROM stg_accounts GROUP BY 1) USING (branch_id)")
def _(b: Bank):
    n = b.stg["accounts"].groupBy("branch_id").agg(F.count(F.lit(1)).alias("accounts"))
    return b.stg["branches"].join(n, "branch_id", "left")


@query("calendar_dim", "SELECT * FROM stg_calendar")
def _(b: Bank):
    return b.stg["calendar"]


def _twin(sk: str, key: str, cols: str, raw: str, where: str = "") -> str:
    """The newest row per cleansed key, with the hash of the raw one."""
    return f"""
  SELECT md5(raw_key) AS {sk}, * EXCLUDE (raw_key, rn) FROM (
    SELECT {key} AS raw_key, {cols}, _synced AS loaded_at, row_number() OVER (PARTITION BY {code(key)} ORDER BY _synced DESC) AS rn
    FROM {raw} WHERE NOT _deleted {where}) WHERE rn = 1"""


@query("stg_customers_warehouse", _twin(
    "customer_sk", "customer_id", f"""{code('customer_id')} AS customer_id, {title('customer_name')} AS customer_name,
      coalesce({code('customer_segment')}, 'UNKNOWN') AS customer_segment,
      CASE WHEN {code('risk_category')} IN ('LOW', 'MEDIUM', 'HIGH') THEN {code('risk_category')} ELSE 'UNKNOWN' END AS risk_category,
      {title('region')} AS region, onboarding_date""", "raw_customers"))
def _(b: Bank):
    return staging.stg_customers(b.raw["customers"], staging.WAREHOUSE)


@query("stg_accounts_warehouse", _twin(
    "account_sk", "account_id", f"""{code('account_id')} AS account_id, {code('customer_id')} AS customer_id, {code('account_type')} AS account_type,
      {code('branch_id')} AS branch_id, coalesce({code('account_status')}, 'UNKNOWN') AS account_status, open_date""", "raw_accounts"))
def _(b: Bank):
    return staging.stg_accounts(b.raw["accounts"], staging.WAREHOUSE)


@query("stg_transactions_warehouse", _twin(
    "transaction_sk", "transaction_id", f"""{code('transaction_id')} AS transaction_id, {code('account_id')} AS account_id,
      {code('transaction_type')} AS transaction_type, CAST(nullif(amount, 0) AS DOUBLE) AS amount, {code('currency')} AS currency,
      {code('merchant_category')} AS merchant_category, transaction_timestamp, CAST(transaction_timestamp AS DATE) AS transaction_date,
      coalesce({code('transaction_status')}, 'UNKNOWN') AS transaction_status""", "raw_transactions", "AND amount IS NOT NULL"))
def _(b: Bank):
    return staging.stg_transactions(b.raw["transactions"], staging.WAREHOUSE)


@query("stg_loans_warehouse", f"""
  SELECT md5(loan_id) AS loan_sk, {code('loan_id')} AS loan_id, {code('customer_id')} AS customer_id, {code('loan_type')} AS loan_type,
    CAST(loan_amount AS DOUBLE) AS loan_amount, CAST(interest_rate AS DOUBLE) AS interest_rate, CAST(emi_amount AS DOUBLE) AS emi_amount,
    {code('loan_status')} AS loan_status, CAST({code('loan_status')} IN ('DEFAULTED', 'WRITTEN_OFF') AS INT) AS is_default_flag,
    CAST({code('loan_status')} = 'DELINQUENT' AS INT) AS is_delinquent_flag, disbursement_date, _synced AS loaded_at
  FROM raw_loans WHERE NOT _deleted""")
def _(b: Bank):
    return staging.stg_loans(b.raw["loans"], staging.WAREHOUSE)


@query("loan_flags", "SELECT loan_id, loan_status, is_default_flag, is_delinquent_flag, is_active_flag FROM stg_loans")
def _(b: Bank):
    return staging.loan_flags(b.stg["loans"].select("loan_id", "loan_status"))


@query("rule_flags", """
  SELECT transaction_id, CAST(is_blocked_flag AS INT) AS is_blocked, CAST(is_failed_flag AS INT) AS is_failed,
    is_high_value_flag AS is_high, is_round_high_value_flag AS is_round FROM enriched""")
def _(b: Bank):
    status, usd = F.col("transaction_status"), F.col("amount_usd")
    return b.enriched.select(
        "transaction_id", rules.is_blocked(status).alias("is_blocked"),
        rules.is_failed(status).alias("is_failed"),
        rules.is_high_value(usd, 25000).alias("is_high"),
        rules.is_round_high_value(usd, 50000).alias("is_round"),
    )


@query("completed_filter", f"SELECT transaction_id, {_AMOUNT} FROM stg_transactions WHERE transaction_status = 'COMPLETED'")
def _(b: Bank):
    return marts.completed(b.stg["transactions"]).select("transaction_id", "amount")


@query("array_non_empty", "SELECT c_custkey, array_to_string(list_filter([CASE WHEN c_acctbal < 0 THEN 'DEBT' END, CASE WHEN c_custkey % 3 = 0 THEN 'THIRD' END], lambda x: x IS NOT NULL), '|') AS marks FROM customer WHERE c_acctbal < 0 OR c_custkey % 3 = 0")
def _(b: Bank):
    marks = F.array_compact(
        F.array(F.when(F.col("c_acctbal") < 0, "DEBT"), F.when(F.col("c_custkey") % 3 == 0, "THIRD"))
    )
    return rows.non_empty(b.table("customer").select("c_custkey", marks.alias("marks")), "marks")


# --- joins and conversion -------------------------------------------------------------------


@query("enrich_transactions", "SELECT * REPLACE (CAST(amount_local AS DOUBLE) AS amount_local, CAST(amount_usd AS DOUBLE) AS amount_usd) FROM enriched")
def _(b: Bank):
    return b.enriched


@query("fx_exact_month", "SELECT transaction_id, currency, CAST(rate_to_usd AS DOUBLE) AS rate_to_usd, is_fx_defaulted FROM rated")
def _(b: Bank):
    return fx.fx_exact_month(b.stg["transactions"], b.fx, "currency", "transaction_date").select(
        "transaction_id", "currency", "rate_to_usd", "is_fx_defaulted"
    )


@query("convert_to_usd", f"""
  SELECT transaction_id, CAST(CAST(round(t.amount * coalesce((SELECT max(f.rate_to_usd) FROM fx f WHERE upper(f.currency) = t.currency
    AND f.effective_month = {month('t.transaction_date')}), CAST(1 AS DECIMAL(18, 6))), 2) AS DECIMAL(18, 2)) AS DOUBLE) AS amount_usd
  FROM stg_transactions t""")
def _(b: Bank):
    return fx.convert_to_usd(
        b.stg["transactions"], b.fx, "amount", "currency", "transaction_date"
    ).select("transaction_id", "amount_usd")


@query("fx_as_of", """
  SELECT t.transaction_id, t.currency, CAST(coalesce(r.rate, 1.0) AS DOUBLE) AS rate_to_usd
  FROM stg_transactions t ASOF LEFT JOIN rates r ON r.ccy = t.currency AND t.transaction_date >= r.fx_month""")
def _(b: Bank):
    return fx.fx_as_of(b.stg["transactions"], b.fx, "currency", "transaction_date").select(
        "transaction_id", "currency", "rate_to_usd"
    )


@query("fx_defaulted_count", """
  SELECT currency, count(*) AS transactions, count(*) FILTER (is_fx_defaulted) AS defaulted FROM rated
  WHERE currency <> 'USD' GROUP BY 1""")
def _(b: Bank):
    rated = fx.fx_exact_month(b.stg["transactions"], b.fx, "currency", "transaction_date")
    return rated.filter(F.col("currency") != "USD").groupBy("currency").agg(
        F.count(F.lit(1)).alias("transactions"), F.count_if("is_fx_defaulted").alias("defaulted")
    )


@query("orphan_accounts", "SELECT account_id, customer_id FROM stg_accounts WHERE customer_id NOT IN (SELECT customer_id FROM stg_customers)")
def _(b: Bank):
    return joins.orphans(b.stg["accounts"], b.stg["customers"], "customer_id").select("account_id", "customer_id")


@query("orphan_transactions", "SELECT transaction_id, account_id FROM stg_transactions WHERE account_id NOT IN (SELECT account_id FROM stg_accounts)")
def _(b: Bank):
    return joins.orphans(b.stg["transactions"], b.stg["accounts"], "account_id").select("transaction_id", "account_id")


@query("not_already_in", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def _(b: Bank):
    seen = b.table("orders").filter(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("c_custkey"))
    return joins.not_already_in(b.table("customer"), seen, "c_custkey").select("c_custkey", "c_name")


@query("point_in_time_join", """
  SELECT t.transaction_id, t.customer_id, h.customer_segment AS asof_customer_segment, h.region AS asof_region
  FROM fct t LEFT JOIN cust_history h ON h.customer_id = t.customer_id
    AND t.transaction_timestamp >= h.valid_from AND (h.valid_to IS NULL OR t.transaction_timestamp < h.valid_to)""")
def _(b: Bank):
    fact = b.fct.select("transaction_id", "customer_id", "transaction_timestamp")
    return joins.join_as_of_validity(
        fact, b.cust_history, "customer_id", "transaction_timestamp", ["customer_segment", "region"]
    ).drop("transaction_timestamp")


# --- dimensions and history -----------------------------------------------------------------

_CUST = "customer_sk, customer_id, customer_name, customer_segment, risk_category, region, onboarding_date"


@query("dim_customer", f"""
  SELECT s.customer_sk, s.customer_id, s.customer_name, coalesce(h.customer_segment, s.customer_segment) AS customer_segment,
    coalesce(h.risk_category, s.risk_category) AS risk_category, coalesce(h.region, s.region) AS region,
    coalesce(h.onboarding_date, s.onboarding_date) AS onboarding_date, h.valid_from AS scd_valid_from,
    h.valid_to AS scd_valid_to
  FROM stg_customers s LEFT JOIN (SELECT * FROM cust_history WHERE valid_to IS NULL) h USING (customer_id)""")
def _(b: Bank):
    return dims.dim_customer(b.stg["customers"], b.cust_history)


@query("dim_account", f"""
  SELECT account_sk, account_id, customer_id, account_type, account_status, a.branch_id, branch_name,
    b.region AS branch_region, open_date, CAST(date_diff('day', open_date, {AS_OF}) AS INT) AS account_age_days
  FROM stg_accounts a LEFT JOIN stg_branches b ON b.branch_id = a.branch_id""")
def _(b: Bank):
    return dims.dim_account(b.stg["accounts"], b.stg["branches"], b.p)


@query("dim_branch", "SELECT branch_sk, branch_id, branch_name, city, state, region FROM stg_branches")
def _(b: Bank):
    return b.dim_branch


@query("dim_date", "SELECT date_sk, date_key, year, quarter, month, month_name, day_of_week, day_name, is_weekend, fiscal_period, month_end_date, quarter_end_date FROM stg_calendar")
def _(b: Bank):
    return dims.dim_date(b.stg["calendar"])


@query("dim_loan_type", "SELECT DISTINCT md5(loan_type) AS loan_type_sk, loan_type FROM stg_loans")
def _(b: Bank):
    return dims.dim_loan_type(b.stg["loans"])


@query("dim_merchant_category", "SELECT DISTINCT md5(merchant_category) AS mcat_sk, merchant_category FROM stg_transactions")
def _(b: Bank):
    return dims.dim_merchant_category(b.stg["transactions"])


@query("snapshot_scd2", f"SELECT {_CUST}, loaded_at, valid_from, valid_to FROM cust_history")
def _(b: Bank):
    return b.cust_history


@query("snapshot_keep_deleted", f"""
  SELECT customer_id, customer_segment, valid_from,
    CASE WHEN customer_id IN (SELECT customer_id FROM cust_after) THEN valid_to END AS valid_to FROM cust_history""")
def _(b: Bank):
    return snapshot_check(
        start_history(b.cust_before, datetime(2000, 6, 30)), b.cust_after, "customer_id",
        dims.CUSTOMER_CHECK_COLS, RUN2, invalidate_hard_deletes=False,
    ).select("customer_id", "customer_segment", "valid_from", "valid_to")


@query("snapshot_type1_name", """
  SELECT h.customer_id, CASE WHEN a.customer_id IS NULL THEN h.customer_name ELSE a.customer_name END AS customer_name,
    h.valid_from FROM cust_history h LEFT JOIN cust_after a ON a.customer_id = h.customer_id""")
def _(b: Bank):
    return overwrite_type1(b.cust_history, b.cust_after, "customer_id", ["customer_name"]).select(
        "customer_id", "customer_name", "valid_from"
    )


@query("snapshot_current", f"SELECT {_CUST} FROM cust_history WHERE valid_to IS NULL")
def _(b: Bank):
    return current_rows(b.cust_history).drop("loaded_at", "valid_from", "valid_to")


@query("version_keys", "SELECT customer_id, valid_from, md5(customer_id || '-' || CAST(valid_from AS VARCHAR)) AS version_sk FROM cust_history")
def _(b: Bank):
    return with_version_key(b.cust_history, "customer_id").select("customer_id", "valid_from", "version_sk")


@query("dim_account_history", f"""
  SELECT a.account_id, a.account_status, a.branch_id, {T1} AS valid_from,
    CASE WHEN n.account_id IS NULL OR n.account_status <> a.account_status THEN {T2} END AS valid_to
  FROM acct_before a LEFT JOIN stg_accounts n USING (account_id)
  UNION ALL SELECT n.account_id, n.account_status, n.branch_id, {T2}, NULL
  FROM stg_accounts n LEFT JOIN acct_before a USING (account_id)
  WHERE a.account_id IS NULL OR n.account_status <> a.account_status""",
  acct_before="SELECT * REPLACE (CASE WHEN account_status = 'DORMANT' THEN 'ACTIVE' ELSE account_status END AS account_status) FROM stg_accounts WHERE account_type <> 'WEALTH'")
def _(b: Bank):
    acct = b.stg["accounts"]
    before = acct.filter(F.col("account_type") != "WEALTH").withColumn(
        "account_status",
        F.when(F.col("account_status") == "DORMANT", "ACTIVE").otherwise(F.col("account_status")),
    )
    history = start_history(before, datetime(2000, 6, 30))
    return dims.dim_account_history(history, acct, RUN2).select(
        "account_id", "account_status", "branch_id", "valid_from", "valid_to"
    )


@query("annuity_emi", """
  SELECT loan_id, round(CAST(loan_amount AS DOUBLE) * r * g / nullif(g - 1, 0), 2) AS emi FROM (
    SELECT *, pow(1 + r, 60) AS g FROM (SELECT *, CAST(interest_rate AS DOUBLE) / 12 / 100 AS r FROM stg_loans))""")
def _(b: Bank):
    return b.stg["loans"].select(
        "loan_id", annuity_emi(F.col("loan_amount"), F.col("interest_rate"), F.lit(60)).alias("emi")
    )


# --- files ----------------------------------------------------------------------------------

def _loan_files(b: Bank) -> str:
    """The raw loans as compressed CSV files; some fields hold null tokens, blanks or rubbish."""
    n = F.substr("loan_id", F.lit(2)).cast("bigint")
    text = b.raw["loans"].select(
        "loan_id",
        F.concat(F.lit(" "), "customer_id", F.lit(" ")).alias("customer_id"),
        F.when(n % 7 == 0, "null").otherwise(F.col("loan_type")).alias("loan_type"),
        F.when(n % 50 == 0, "12,x").otherwise(F.col("loan_amount").cast("string")).alias("loan_amount"),
        F.col("interest_rate").cast("string").alias("interest_rate"),
        F.coalesce(F.col("emi_amount").cast("string"), F.lit("NULL")).alias("emi_amount"),
        "loan_status",
        F.when(n % 90 == 0, "soon").otherwise(F.col("disbursement_date").cast("string")).alias("disbursement_date"),
    )
    path = work_dir(b.spark, "loan_files")
    text.write.csv(path, header=True, compression="gzip", quote='"', escape='"')
    return path


_N = "CAST(substr(loan_id, 2) AS BIGINT)"
_CSV_SQL = f"""SELECT loan_id, customer_id, CASE WHEN {_N} % 7 = 0 THEN NULL ELSE loan_type END AS loan_type,
    CASE WHEN {_N} % 50 = 0 THEN NULL ELSE CAST(loan_amount AS DOUBLE) END AS loan_amount, CAST(interest_rate AS DOUBLE) AS interest_rate,
    CAST(emi_amount AS DOUBLE) AS emi_amount, loan_status, CASE WHEN {_N} % 90 = 0 THEN NULL ELSE disbursement_date END AS disbursement_date
  FROM raw_loans"""


@query("csv_scan", _CSV_SQL)
def _(b: Bank):
    return read_csv(b.spark, _loan_files(b), schemas.LOANS)


@query("csv_load_good", f"{_CSV_SQL} WHERE {_N} % 50 <> 0 AND {_N} % 90 <> 0")
def _(b: Bank):
    return load(b.spark, _loan_files(b), schemas.LOANS)[0]


_WAVE = f"CASE WHEN {_N} % 3 = 0 THEN 'late' ELSE 'early' END"


@query("csv_load_ledger", f"""
  SELECT {_WAVE} AS wave, CAST(CASE WHEN {_WAVE} = 'late' THEN 1 ELSE 0 END AS BIGINT) AS load, count(*) FILTER (WHERE {_N} % 50 <> 0 AND {_N} % 90 <> 0) AS good,
    count(*) FILTER (WHERE {_N} % 50 = 0 OR {_N} % 90 = 0) AS rejected
  FROM raw_loans GROUP BY 1, 2""")
def _(b: Bank):
    """Two waves of files, the first of them loaded twice; rows by the file that they name."""
    text, home = b.spark.read.csv(_loan_files(b), header=True), work_dir(b.spark, "ledger")
    landing = os.path.join(home, "landing")
    late = F.substr("loan_id", F.lit(2)).cast("bigint") % 3 == 0
    for wave, rows in (("early", text.filter(~late)), ("late", text.filter(late))):
        rows.write.csv(os.path.join(landing, wave), header=True, quote='"', escape='"')
        for _ in range(2):
            load_new(b.spark, os.path.join(landing, "*"), schemas.LOANS, home)
    of = lambda kind: b.spark.read.parquet(os.path.join(home, kind)).select(
        "load", F.regexp_extract("file", "/landing/([a-z]+)/", 1).alias("wave"), F.lit(kind).alias("kind"))
    return of("good").unionByName(of("rejected")).groupBy("wave", F.col("load").cast("bigint").alias("load")).agg(
        F.count_if(F.col("kind") == "good").alias("good"), F.count_if(F.col("kind") == "rejected").alias("rejected"))


@query("csv_load_rejected", f"""
  SELECT loan_id, CASE WHEN {_N} % 50 = 0 THEN 'loan_amount' ELSE 'disbursement_date' END AS reject_reason
  FROM raw_loans WHERE {_N} % 50 = 0 OR {_N} % 90 = 0""")
def _(b: Bank):
    return load(b.spark, _loan_files(b), schemas.LOANS)[1].select("loan_id", "reject_reason")


@query("stg_branches_warehouse", f"SELECT md5(branch_id) AS branch_sk, {code('branch_id')} AS branch_id, {title('branch_name')} AS branch_name, {title('city')} AS city, {code('state')} AS state, {title('region')} AS region FROM raw_branches WHERE NOT _deleted")
def _(b: Bank):
    return staging.stg_branches(b.raw["branches"], staging.WAREHOUSE)


@query("stg_calendar_warehouse", "SELECT md5(CAST(date_key AS VARCHAR)) AS date_sk, date_key, month, quarter, year, fiscal_period FROM raw_calendar")
def _(b: Bank):
    return staging.stg_calendar_dim(b.raw["calendar"], staging.WAREHOUSE)
