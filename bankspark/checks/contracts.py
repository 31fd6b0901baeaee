"""Queries on the gate, schemas, tags, masks and logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from bankspark.checks.context import Bank, query
from bankspark.checks.quality import _CONTACTS, _contacts, _tagged
from bankspark.checks.spec import STAGING_SPEC, spec_sql
from bankspark.operators import governance, ops, quality as Q, rows
from bankspark.plans import dq


@query("gate_result", f"""
  SELECT model || '.' || column_name || '.' || test AS failed FROM ({spec_sql(STAGING_SPEC)}) WHERE failures > 0 AND severity = 'ERROR'
  UNION ALL SELECT 'fk_transactions_to_accounts' WHERE EXISTS (SELECT 1 FROM stg_transactions WHERE account_id NOT IN (SELECT account_id FROM stg_accounts))
  UNION ALL SELECT 'range_transaction_amount_positive' WHERE EXISTS (SELECT 1 FROM stg_transactions WHERE amount <= 0)""")
def _(b: Bank):
    """What the gate of a build would raise for, the freshness of the raw feed waived."""
    tests = dq.run_contracts({f"stg_{n}": b.stg[n] for n in b.stg}, dq.STAGING_CONTRACTS, b.p)
    suite = dq.run_bank_suite(b.raw, b.stg, b.p, "run")
    return Q.failed_tests(tests).unionByName(Q.failed_checks(suite, ["freshness_raw_transactions"]))


# What a feed is declared to be, against the benchmark table it is checked on.
_EXPECTED = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "bigint", "c_acctbal": "double", "c_segment": "string"}


@query("schema_drift", """
  SELECT 'customer' AS table_name, column_name, expected_type, actual_type, drift, (SELECT count(*) FROM customer) AS row_count FROM (VALUES
    ('c_mktsegment', NULL, 'string', 'ADDED'), ('c_nationkey', 'bigint', 'int', 'TYPE'), ('c_segment', 'string', NULL, 'MISSING')
  ) t(column_name, expected_type, actual_type, drift)""")
def _(b: Bank):
    customer = b.table("customer")
    return Q.check_schema(customer, _EXPECTED, "customer").withColumn("row_count", customer.agg(F.count(F.lit(1))).scalar())


@query("tag_inventory", """
  SELECT 'contacts' AS table_name, t.column_name, tag_name, tag_value, n AS filled FROM (VALUES
    ('name', 'DATA_CLASS', 'PII_LOW'), ('name', 'PII_FIELD', 'NAME'), ('email', 'DATA_CLASS', 'PII_HIGH'), ('email', 'PII_FIELD', 'EMAIL'),
    ('phone', 'DATA_CLASS', 'PII_HIGH'), ('phone', 'PII_FIELD', 'PHONE'), ('govt_id', 'DATA_CLASS', 'PII_HIGH'), ('govt_id', 'PII_FIELD', 'GOVT_ID'),
    ('balance', 'DATA_CLASS', 'FINANCIAL_SENSITIVE')) t(column_name, tag_name, tag_value)
  JOIN (UNPIVOT (SELECT count(name) AS name, count(email) AS email, count(phone) AS phone, count(govt_id) AS govt_id, count(balance) AS balance FROM contacts)
    ON COLUMNS(*) INTO NAME column_name VALUE n) USING (column_name)""", contacts=_CONTACTS)
def _(b: Bank):
    """Every tag, and how many rows hold a value under it."""
    df = _tagged(b)
    refs = governance.tag_references({"contacts": df})
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "filled")
    return refs.join(counts, "column_name")


@query("mask_coverage", """
  SELECT 'contacts' AS table_name, column_name, data_class, coverage, (SELECT count(*) FROM contacts) AS row_count FROM (VALUES
    ('c_custkey', 'PII_LOW', 'OPEN'), ('name', 'PII_LOW', 'FIELD'), ('email', 'PII_HIGH', 'FIELD'), ('phone', 'PII_HIGH', 'FIELD'),
    ('govt_id', 'PII_HIGH', 'OUT'), ('balance', 'FINANCIAL_SENSITIVE', 'AMOUNT')) t(column_name, data_class, coverage)""", contacts=_CONTACTS)
def _(b: Bank):
    df = governance.tag_open(governance.tag(_tagged(b), "c_custkey", "PII_LOW"), "c_custkey")
    df = governance.tag(df, "govt_id", "PII_HIGH", "ADDRESS")
    return governance.mask_coverage({"contacts": df}).withColumn("row_count", df.agg(F.count(F.lit(1))).scalar())


@query("masks_fail_closed", """
  SELECT c_custkey, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS DOUBLE) AS balance, '***MASKED***' AS name FROM contacts""", contacts=_CONTACTS)
def _(b: Bank):
    """Protected columns that no finer mask fits are masked out for a role nobody knows."""
    df = _contacts(b).select("c_custkey", "email", F.col("balance").cast("double").alias("balance"), "name")
    df = governance.tag(governance.tag(df, "email", "PII_HIGH"), "balance", "FINANCIAL_SENSITIVE")
    return governance.apply_masks(governance.tag(df, "name", "PII_LOW", "NAME"), "NOBODY")


@query("run_log", """
  SELECT event_type || '.' || CAST(CAST(ts AS DATE) AS VARCHAR) AS node_name, 'model' AS node_type, 'error' AS status,
    'events: ' || count(*) || chr(10) || 'first: ' || min(event_id) || chr(10) || 'last: ' || max(event_id)
      || chr(10) || string_agg(event_id, chr(10) ORDER BY event_id) AS message, 'local' AS target_name
  FROM events GROUP BY event_type, CAST(ts AS DATE)""")
def _(b: Bank):
    """A row per kind of event and day, as a failed node whose message names every event of that kind and day on a
    line of its own; it is kept whole."""
    day = F.col("ts").cast("date").alias("day")
    kinds = b.table("events").groupBy("event_type", day).agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"),
        F.nullif(F.array_join(F.sort_array(F.collect_list("event_id")).cast("array<string>"), "\n"), F.lit("")).alias("ids"))
    line = lambda name, c: F.concat(F.lit(f"{name}: "), F.col(c).cast("string"))
    nodes = kinds.select(
        F.lit("run").alias("invocation_id"), F.lit(datetime(2024, 1, 1)).alias("run_started_at"), F.current_timestamp().alias("run_completed_at"),
        F.concat_ws(".", "event_type", F.col("day").cast("string")).alias("node_name"), F.lit("model").alias("node_type"), F.lit("error").alias("status"),
        F.lit(1.5).alias("execution_time_s"), F.concat_ws("\n", line("events", "n"), line("first", "first"), line("last", "last"), F.col("ids")).alias("message"),
        F.lit("local").alias("target_name"))
    return ops.log_run(b.spark, nodes).select("node_name", "node_type", "status", "message", "target_name")


@query("run_tag", """
  SELECT '{"project": "bank", "target": "dev", "invocation_id": "i1", "user": "me"}' AS query_tag, TRUE AS tagged, TRUE AS cleared,
    (SELECT count(*) FROM events) AS rows_tagged""")
def _(b: Bank):
    """The tag that the jobs of a run carry, while they run and no longer."""
    with ops.run_tagged(b.spark, "bank", "dev", "i1", "me") as tag:
        counted = b.table("events").count()
        tagged = "bank:dev:i1:me" in b.spark.getTags()
    cleared = "bank:dev:i1:me" not in b.spark.getTags()
    return b.spark.range(1).select(
        F.lit(tag).alias("query_tag"), F.lit(tagged).alias("tagged"), F.lit(cleared).alias("cleared"), F.lit(counted).cast("bigint").alias("rows_tagged"))


@query("sample_rows", "SELECT least(100, count(*)) AS n, least(100, count(*)) AS n_known FROM orders")
def _(b: Bank):
    """A sample's size, and how many of its rows the table really holds."""
    orders = b.table("orders")
    picked = rows.sample_rows(orders.select("o_orderkey"), 100)
    known = picked.join(orders.select("o_orderkey"), "o_orderkey", "left_semi")
    return picked.agg(F.count(F.lit(1)).alias("n")).withColumn("n_known", known.agg(F.count(F.lit(1))).scalar())

