"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from bankspark.checks.all import ORACLE, QUERIES
from bankspark.operators.bursts import burst_hits, with_burst_flag
from bankspark.sources.sinks import materialize
from tests.util import final_plan, plan

ROW_LEVEL = (
    "stg_transactions", "enrich_transactions", "revenue_monthly", "branch_performance", "customer_profitability",
    "fraud_indicators", "rapid_fire_txn", "point_in_time_join", "snapshot_scd2", "apply_changes", "table_changes",
    "loan_balances_daily", "fx_as_of", "customer_360", "dq_suite", "quarterly_kpis", "merge_by_key",
)


@pytest.mark.parametrize("name", ROW_LEVEL)
def test_no_cross_joins_python_or_single_task_windows(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "PythonRDD"):
        assert bad not in text, f"{bad} in {name}"
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line and "GroupLimit" not in line:
            assert not any("Exchange SinglePartition" in near for near in lines[i + 1:i + 3]), name


def test_scans_read_only_what_is_needed(spark, sf_dir):
    text = QUERIES["account_velocity"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in text
    text = plan(QUERIES["incremental_slice"](spark, sf_dir))
    assert "c_custkey" not in text


def test_hot_account_is_split_by_the_adaptive_join(spark):
    """With a third of the rows on one account the skewed partition is read in pieces."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fact = spark.range(0, 120000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("A0")).otherwise(F.concat(F.lit("A"), F.col("id") % 5000)).alias("account_id"),
            F.timestamp_seconds(F.col("id") * 100).cast("timestamp_ntz").alias("t"), F.md5(F.col("id").cast("string")).alias("sk"),
        )
        acct = spark.range(5000).select(F.concat(F.lit("A"), F.col("id")).alias("account_id"), F.col("id").alias("branch"))
        joined = fact.join(acct, "account_id", "left")
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 120000
        assert with_burst_flag(fact, "account_id", "t").count() == 120000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_written_hits_spare_the_fact_its_shuffle(spark, tmp_path):
    fact = spark.range(20000).select(
        F.concat(F.lit("A"), F.col("id") % 500).alias("account_id"), F.timestamp_seconds(F.col("id") * F.when(F.col("id") < 5000, 3).otherwise(7)).cast("timestamp_ntz").alias("t"),
    )
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    hits = materialize(burst_hits(fact, "account_id", "t"), str(tmp_path), "hits")
    quick = with_burst_flag(fact, "account_id", "t", hits=hits)
    assert "BroadcastHashJoin" in plan(quick) and "Exchange hashpartitioning" not in plan(quick)
    slow = with_burst_flag(fact, "account_id", "t")
    assert quick.exceptAll(slow).count() == 0 and quick.filter("is_rapid_fire_flag = 1").count() > 0


def test_sketched_counts_are_near_the_exact_ones(spark):
    from bankspark.plans.serve import active_customers_exact

    fct = spark.range(20000).select(
        F.lit("COMPLETED").alias("transaction_status"), F.lit("2024-01-15").cast("date").alias("transaction_date"),
        F.lit("RETAIL").alias("customer_segment"), F.lit("Emea").alias("branch_region"),
        (F.col("id") % 5000).alias("customer_id"),
    )
    exact = active_customers_exact(fct).first()["active_customers"]
    near = active_customers_exact(fct, 0.02).first()["active_customers"]
    assert exact == 5000 and abs(near - exact) < 500


def test_registry():
    assert len(QUERIES) > 120 and set(ORACLE) <= set(QUERIES)
    assert len(set(QUERIES) - set(ORACLE)) == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, sf_dir, name):
    import duckdb

    from check_queries import TABLES, bag as rows_of

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(cols, cur.fetchall())
