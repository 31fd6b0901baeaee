"""Loan balances as a stored table: an interval per loan and month, from which days are read."""

from __future__ import annotations

import os
from dataclasses import replace
from datetime import date, datetime, time, timedelta
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bankspark.config import Params
from bankspark.functions.cleanse import surrogate_key
from bankspark.functions.dates import lit_date, lit_ts, month_start, months_between_boundaries
from bankspark.plans.loans import balance_intervals
from bankspark.session import work_dir
from bankspark.sources import sinks

PART, BLOCK = "balance_month", "loan_block"
# A few narrow loans become many rows; a task sorts about so many by month and writes them out, a file for
# each month.
ROWS_PER_TASK = 3_000_000
# Stored months that are written anew at once; until they are complete the old ones stay beside them.
MONTHS_AT_ONCE = 6
BUCKETS = "_buckets-"  # a mark in the table's folder: how many buckets its months have
IDS = ["loan_sk", "loan_id", "loan_type", "customer_id"]
# Sorted ids and balances of one width are short as differences, and no dictionary holds them.
FORMAT = {
    "compression": "zstd", "parquet.writer.version": "v2", "partitionOverwriteMode": "dynamic",
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("loan_id", "customer_id", "outstanding_balance")},
}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored_months(spark: SparkSession, path: str) -> list[date]:
    """The months of the table, from its folders' names; no file is read."""
    names = [n.split("=", 1)[1] for n in sinks.folder_names(spark, path) if n.startswith(f"{PART}=")]
    return sorted(date.fromisoformat(n) for n in names)


def _stored_buckets(spark: SparkSession, path: str) -> int | None:
    return next((int(n.removeprefix(BUCKETS)) for n in sinks.folder_names(spark, path) if n.startswith(BUCKETS)), None)


def loan_block(loan_id: Column) -> Column:
    """Loans whose ids differ in the last three characters only share a block, and a block is in one bucket: so
    a bucket's sorted ids are neighbours, which compress well. Of a short id four characters count."""
    size = F.length(loan_id)
    return F.hash(F.left(loan_id, F.greatest(size - 3, F.least(size, F.lit(4)))))


def _kept_key() -> Column:
    """A key that is that of the loan's id is not kept, `stored_balances` makes it again: it is random, so
    with every month it would take more room than all else."""
    derived = F.col("loan_sk").eqNullSafe(surrogate_key(F.col("loan_id")))
    return F.when(~derived, F.col("loan_sk")).alias("loan_sk")


def _narrow(loans: DataFrame) -> DataFrame:
    """What the months of a loan are made of."""
    return loans.select(_kept_key(), *IDS[1:], "loan_amount", "emi_amount", "disbursement_date")


def _buckets(loans: DataFrame, p: Params) -> int:
    """As many as the rows ask for that the loans become, which their own size does not tell."""
    months = months_between_boundaries(F.col("disbursement_date"), lit_date(p.as_of_date)) + 1
    total = loans.agg(F.sum(F.greatest(months, F.lit(0)))).first()[0] or 0
    return total // ROWS_PER_TASK + 1


def stored_rows(loans: DataFrame, p: Params, since: date | None, buckets: int | None = None) -> DataFrame:
    """The rows to write, by the tasks that write them: a bucket each, in order of the ids."""
    dealt = _narrow(loans).withColumn(BLOCK, loan_block(F.col("loan_id"))).repartition(buckets or _buckets(loans, p), BLOCK)
    return _as_stored(balance_intervals(dealt.sortWithinPartitions("loan_id"), p, since, also=(BLOCK,)))


def _as_stored(rows: DataFrame) -> DataFrame:
    return rows.select(*IDS, BLOCK, "first_day", "last_day", "outstanding_balance", PART)


def _register(spark: SparkSession, path: str, rows: DataFrame, buckets: int) -> str:
    """Tell the session that the folder, as it is now, is a table in buckets; its files belong to the folder.
    Spark reads a bucket's files of all months in one task."""
    path = sinks.qualified(spark, path)
    name = f"spark_catalog.default.balances_{md5(path.encode()).hexdigest()[:16]}"
    text = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    options = ", ".join(f"{text(k)} = {text(v)}" for k, v in FORMAT.items())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS ({options}) PARTITIONED BY ({PART}) "
        f"CLUSTERED BY ({BLOCK}) INTO {buckets} BUCKETS LOCATION {text(path)}")
    spark.catalog.recoverPartitions(name)
    return name


def stored_balances(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a registered table, with the keys that were not kept."""
    rows = spark.table(name)
    return rows.withColumn("loan_sk", F.coalesce("loan_sk", surrogate_key(F.col("loan_id"))))


def _spans(months: list[date], since: date | None, p: Params) -> list[tuple[date | None, Params]]:
    """From when and up to when to write at once: the stored months by a few, the last with all that follow."""
    again = [m for m in months if since is not None and m >= since.replace(day=1)]
    starts = [since, *again[MONTHS_AT_ONCE::MONTHS_AT_ONCE]]
    ends = [replace(p, as_of=min(p.as_of, datetime.combine(m - timedelta(days=1), time()))) for m in starts[1:]]
    return list(zip(starts, [*ends, p], strict=True))


def _into_buckets(spark: SparkSession, path: str) -> int:
    """Write a table of the time before there were buckets once more, with them; what it holds stays."""
    old, new = spark.read.parquet(path), path.rstrip("/") + "__buckets"
    buckets = old.count() // ROWS_PER_TASK + 1
    rows = _as_stored(old.withColumn("loan_sk", _kept_key()).withColumn(BLOCK, loan_block(F.col("loan_id"))))
    sinks.discard(spark, new)
    sinks.mark(spark, new, f"{BUCKETS}{buckets}")
    rows.repartition(buckets, BLOCK).sortWithinPartitions("loan_id").write.insertInto(
        _register(spark, new, rows, buckets), overwrite=True)
    sinks.publish(spark, new, path)
    return buckets


def load_balances(
    spark: SparkSession, path: str, loans: DataFrame, p: Params, backfill_from: date | None = None,
    loaded_since: datetime | None = None,
) -> DataFrame:
    """Bring the table of loan x month (see `balance_intervals`) up to `p.as_of`; it is partitioned by month
    and, within a month, in buckets by loan.

    Whole months are written, each in place of the one that is there: from the newest stored month
    on, which has grown by some days; from the month of `backfill_from`, if that is earlier; and
    from the first month of the loans that were loaded (`loaded_at`) since `loaded_since`, as a changed
    loan changes all its months. Earlier months are left alone, and a month that no loan has any
    more goes. Running it again changes nothing, or finishes a run that was cut off.

    Loans are shuffled, their months are not: a task writes all months of its loans, each to a file
    of its own, and a reader that needs a loan's months together finds them in one bucket. So beside
    the table itself nothing of its size is stored. A table keeps the number of buckets that its
    first load gave it.
    """
    sinks.finish_replace(spark, path)
    months = stored_months(spark, path)
    since = None
    if months:
        since = min(months[-1], backfill_from or months[-1])
        if loaded_since is not None:
            changed = loans.filter(F.col("loaded_at") >= lit_ts(loaded_since)).agg(F.min("disbursement_date")).first()[0]
            since = min(since, changed or since)
    work, cleanup = work_dir(spark, "loans"), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        _narrow(loans).write.parquet(work)
        loans = spark.read.parquet(work)
        if months:
            buckets = _stored_buckets(spark, path) or _into_buckets(spark, path)
        else:
            sinks.discard(spark, path)  # a mark without months
            buckets = _buckets(loans, p)
            sinks.mark(spark, path, f"{BUCKETS}{buckets}")
        rows = stored_rows(loans, p, since, buckets)
        name = _register(spark, path, rows, buckets)
        for start, upto in _spans(months, since, p):
            stored_rows(loans, upto, start, buckets).write.insertInto(name, overwrite=True)
        first = loans.filter(F.col("disbursement_date") <= lit_date(p.as_of_date)).agg(
            F.min(month_start(F.col("disbursement_date")))).first()[0]
    finally:
        spark.conf.set(CLEANUP, cleanup)
        sinks.discard(spark, work)
    for month in months:
        if month >= since.replace(day=1) and not (first and first <= month <= p.as_of_date):
            sinks.discard(spark, os.path.join(path, f"{PART}={month}"))
    return stored_balances(spark, _register(spark, path, rows, buckets))
