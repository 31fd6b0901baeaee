"""Data-quality checks. Each check is one verdict row; a suite is their union.

Predicates on one table share a single scan of it.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from bankspark.functions.dates import lit_date, lit_ts, minutes_between_boundaries
from bankspark.functions.numbers import flag, mean, share_pct
from bankspark.operators.joins import orphans
from bankspark.operators.rows import latest_per_key
from bankspark.schemas import DQ_RESULT, SYNCED

ERROR, WARN, INFO = "ERROR", "WARN", "INFO"
VERDICT_COLS = [f.name for f in DQ_RESULT.fields]


@dataclass(frozen=True)
class Check:
    """What a verdict row says about itself."""

    name: str
    category: str
    layer: str
    target: str
    severity: str
    details: str = ""


def verdict(
    check: Check, failed: Column, observed: Column, threshold: Column | float,
    sample: Column | None = None,
) -> Column:
    """The check's fields as one struct."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.category).alias("check_category"),
        F.lit(check.layer).alias("layer"),
        F.lit(check.target).alias("target_object"),
        F.lit(check.severity).alias("severity"),
        F.when(failed, "FAIL").otherwise("PASS").alias("status"),
        observed.cast("decimal(38,4)").alias("observed_value"),
        limit.cast("decimal(38,4)").alias("threshold_value"),
        (sample if sample is not None else F.lit(None).cast("array<string>")).alias(
            "failed_row_sample"
        ),
        F.lit(check.details).alias("check_details"),
    )


def _rows(one_row: DataFrame, verdicts: Sequence[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*verdicts)).alias("v")).select("v.*")


def check_freshness(
    df: DataFrame, check: Check, max_minutes: int, as_of: datetime, ts: str = SYNCED,
    strict: bool = False,
) -> DataFrame:
    """Lag of the newest row over the limit fails. An empty table passes unless `strict`."""
    lag = minutes_between_boundaries(F.col("newest"), lit_ts(as_of))
    failed = lag > max_minutes
    if strict:
        failed = F.coalesce(failed, F.lit(True))
    return _rows(df.agg(F.max(ts).alias("newest")), [verdict(check, failed, lag, max_minutes)])


def source_freshness(
    df: DataFrame, name: str, warn_minutes: int, error_minutes: int, as_of: datetime,
    ts: str = SYNCED,
) -> DataFrame:
    """Lag of a source against its warn and error limits."""
    lag = minutes_between_boundaries(F.col("newest"), lit_ts(as_of))
    return df.agg(F.max(ts).alias("newest")).select(
        F.lit(name).alias("source_name"),
        lag.alias("lag_minutes"),
        F.when(lag > error_minutes, "ERROR")
        .when(lag > warn_minutes, "WARN")
        .otherwise("PASS")
        .alias("status"),
    )


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows less distinct keys; a null key counts as a duplicate."""
    return df.agg((F.count(F.lit(1)) - F.countDistinct(key)).alias("dup_count"))


def check_unique(df: DataFrame, check: Check, key: str) -> DataFrame:
    dup = F.col("dup_count")
    return _rows(duplicate_count(df, key), [verdict(check, dup > 0, dup, 0)])


def check_fk(
    child: DataFrame, parent: DataFrame, check: Check, key: str, tolerance: int = 0,
    parent_key: str | None = None,
) -> DataFrame:
    """More orphan rows than tolerated fails."""
    counted = orphans(child, parent, key, parent_key).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return _rows(counted, [verdict(check, n > tolerance, n, tolerance)])


def check_predicates(df: DataFrame, checks: Sequence[tuple[Check, Column]]) -> DataFrame:
    """Any row that meets a check's predicate fails it. One scan for all checks."""
    counts = df.agg(*[F.count_if(bad).alias(f"n{i}") for i, (_, bad) in enumerate(checks)])
    return _rows(
        counts,
        [verdict(c, F.col(f"n{i}") > 0, F.col(f"n{i}"), 0) for i, (c, _) in enumerate(checks)],
    )


def failed_sample(df: DataFrame, bad: Column | None, cols: Sequence[str], n: int = 5) -> Column:
    """Up to n failing rows as JSON texts (the first by `cols`; each task keeps only its own first
    n), as a scalar subquery. Without `bad` all rows of `df` are failing ones."""
    rows = df if bad is None else df.filter(bad)
    first = rows.select(*cols).orderBy(*cols).limit(n)
    return first.agg(F.sort_array(F.collect_list(F.to_json(F.struct(*cols))))).scalar()


def with_failed_sample(
    verdicts: DataFrame, df: DataFrame, bad: Column, cols: Sequence[str], n: int = 5
) -> DataFrame:
    """The verdict rows with up to n failing rows attached."""
    return verdicts.withColumn("failed_row_sample", failed_sample(df, bad, cols, n))


def with_failed_samples(verdicts: DataFrame, samples: dict[str, Column]) -> DataFrame:
    """The verdict rows, each with the sample given for its check."""
    shown = F.lit(None).cast("array<string>")
    for name, sample in samples.items():
        shown = F.when(F.col("check_name") == name, sample).otherwise(shown)
    return verdicts.withColumn("failed_row_sample", shown)


def check_invariant(df: DataFrame, check: Check, violated: Column) -> DataFrame:
    return check_predicates(df, [(check, violated)])


def check_volume(
    df: DataFrame, check: Check, day: str, as_of: date, low: float = 0.3, high: float = 1.7
) -> DataFrame:
    """Yesterday's rows against the mean of the seven days before; days without rows are
    left out of the mean, and without any history the check passes."""

    def back(n: int) -> Column:
        return lit_date(as_of - timedelta(days=n))

    daily = (
        df.filter(F.col(day) >= back(8)).groupBy(day).agg(F.count(F.lit(1)).alias("row_count"))
    )
    past = F.when(F.col(day).between(back(8), back(2)), F.col("row_count"))
    today = daily.agg(
        F.coalesce(F.max(F.when(F.col(day) == back(1), F.col("row_count"))), F.lit(0)).alias("y"),
        mean(F.sum(past), F.count(past), 6).alias("avg"),
    )
    y, avg = F.col("y"), F.col("avg")
    failed = (avg != 0) & ((y < avg * low) | (y > avg * high))
    return _rows(today, [verdict(check, failed, y, avg)])


def check_schema(df: DataFrame, expected: dict[str, str], table: str) -> DataFrame:
    """Columns missing, added or of another type than declared, one row each."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    drift = [(table, c, expected.get(c), actual.get(c)) for c in sorted({*expected, *actual})]
    kinds = [
        (t, c, want, got, "MISSING" if got is None else "ADDED" if want is None else "TYPE")
        for t, c, want, got in drift
        if want != got
    ]
    return df.sparkSession.createDataFrame(
        kinds,
        "table_name string, column_name string, expected_type string, actual_type string, "
        "drift string",
    )


def run_suite(
    checks: Sequence[DataFrame], executed_at: datetime, executed_by: str = "engine",
    run_id: str | None = None,
) -> DataFrame:
    """All verdicts in one frame, stamped."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return (
        out.withColumn("check_run_id", F.lit(run_id) if run_id else F.uuid())
        .withColumn("executed_at", lit_ts(executed_at))
        .withColumn("executed_by", F.lit(executed_by))
        .select(*VERDICT_COLS)
    )


def dq_latest(results: DataFrame) -> DataFrame:
    """The most recent run of each check."""
    return latest_per_key(results, "check_name", "executed_at", ["check_run_id"])


def failures_open(results: DataFrame) -> DataFrame:
    """Checks whose latest run failed, worst severity first."""
    severity = F.when(F.col("severity") == ERROR, 1).when(F.col("severity") == WARN, 2).otherwise(3)
    return (
        dq_latest(results)
        .filter(F.col("status") == "FAIL")
        .orderBy(severity, F.col("executed_at").desc())
        .select(
            "check_name", "check_category", "layer", "target_object", "severity",
            "observed_value", "threshold_value", "check_details", "executed_at",
        )
    )


def scorecard(results: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Pass rate and failures by day, layer and category over the last `days`."""
    passed, failed = F.col("status") == "PASS", F.col("status") == "FAIL"
    total, ok = F.count(F.lit(1)), F.count_if(passed)
    return (
        results.filter(F.col("executed_at") >= lit_date(as_of - timedelta(days=days)))
        .groupBy(
            F.col("executed_at").cast("date").alias("check_date"), "layer", "check_category"
        )
        .agg(
            total.alias("total_checks"),
            ok.alias("passed"),
            F.count_if(failed).alias("failed"),
            share_pct(ok, total).alias("pass_rate_pct"),
            F.count_if(failed & (F.col("severity") == ERROR)).alias("error_count"),
            F.count_if(failed & (F.col("severity") == WARN)).alias("warn_count"),
        )
    )


def row_counts(tables: dict[str, DataFrame], label: str = "table_name") -> DataFrame:
    """One row per table with its row count."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(label), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile(raw: dict[str, DataFrame], stg: dict[str, DataFrame]) -> DataFrame:
    """Raw against staged row counts per entity, with a drift verdict."""
    left = row_counts(raw, "entity").withColumnRenamed("row_count", "raw_count")
    right = row_counts(stg, "entity").withColumnRenamed("row_count", "stg_count")
    diff = F.col("raw_count") - F.col("stg_count")
    return left.join(right, "entity").select(
        "entity",
        "raw_count",
        "stg_count",
        diff.alias("row_diff"),
        share_pct(F.col("stg_count"), F.col("raw_count")).alias("retention_pct"),
        F.when(F.col("raw_count") == 0, "NO_DATA")
        .when(F.abs(diff) > F.col("raw_count") * F.lit(5) / 100, "DRIFT_HIGH")
        .when(diff != 0, "DRIFT_LOW")
        .otherwise("OK")
        .alias("reconciliation_status"),
    )


def assert_reconciles(
    mart: DataFrame, mart_value: Column, fact: DataFrame, fact_value: Column,
    tolerance: str = "0.01",
) -> DataFrame:
    """Both totals and their difference, if it exceeds the tolerance (no row = reconciled)."""
    pair = mart.agg(mart_value.alias("mart_value")).withColumn(
        "fact_value", fact.agg(fact_value).scalar()
    )
    variance = F.abs(F.col("mart_value") - F.col("fact_value"))
    return pair.withColumn("variance", variance).filter(
        F.col("variance") > F.lit(tolerance).cast("decimal(18,2)")
    )


# --- column tests: failing rows or keys per test -------------------------------------------


@dataclass(frozen=True)
class ColumnTest:
    """One test of one column; `bad` is true on a failing row."""

    column: str
    test: str
    bad: Column


def test_not_null(column: str) -> ColumnTest:
    return ColumnTest(column, "not_null", F.col(column).isNull())


def test_accepted(column: str, values: Sequence) -> ColumnTest:
    """Nulls pass."""
    bad = F.coalesce(~F.col(column).isin(*values), F.lit(False))
    return ColumnTest(column, "accepted_values", bad)


def test_between(column: str, lo: Column | None = None, hi: Column | None = None) -> ColumnTest:
    c = F.col(column)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | F.coalesce(c < lo, F.lit(False))
    if hi is not None:
        bad = bad | F.coalesce(c > hi, F.lit(False))
    return ColumnTest(column, "between", bad)


def test_positive(column: str) -> ColumnTest:
    return ColumnTest(column, "positive_value", F.coalesce(F.col(column) <= 0, F.lit(False)))


for _t in (test_not_null, test_accepted, test_between, test_positive):
    _t.__test__ = False  # not pytest tests


def run_column_tests(df: DataFrame, model: str, tests: Sequence[ColumnTest]) -> DataFrame:
    """Failing rows per row-level test, from one scan."""
    counted = df.agg(*[F.count_if(t.bad).alias(f"n{i}") for i, t in enumerate(tests)])
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(t.column).alias("column_name"),
            F.lit(t.test).alias("test"),
            F.col(f"n{i}").alias("failures"),
        )
        for i, t in enumerate(tests)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def run_unique_test(df: DataFrame, model: str, column: str) -> DataFrame:
    """Number of non-null values that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("failures"))
        .select(
            F.lit(model).alias("model"), F.lit(column).alias("column_name"),
            F.lit("unique").alias("test"), "failures",
        )
    )


def run_relationship_test(
    child: DataFrame, model: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Non-null child values without a parent."""
    known = child.filter(F.col(column).isNotNull()).select(column)
    return orphans(known, parent, column, parent_column).agg(
        F.count(F.lit(1)).alias("failures")
    ).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        F.lit("relationships").alias("test"), "failures",
    )


@dataclass(frozen=True)
class Reference:
    """Values of `column` that must stand in `parent_column` of a parent."""

    column: str
    parent: DataFrame
    parent_column: str
    severity: str = ERROR


def run_table_tests(
    df: DataFrame, model: str, rows: Sequence[ColumnTest], unique: Sequence[str] = (), references: Sequence[Reference] = (),
) -> DataFrame:
    """Failures of all tests of a table from one scan and one shuffle, a row per test.

    Every row gives its value for each unique and reference test, and once its row-level failures;
    they are summed by (test, value) together with the parents' values. Before that shuffle each
    task sums up what it has, so the row-level failures and a hot value are one row a task. Nulls
    are neither duplicates nor orphans.
    """
    n_keyed = len(unique) + len(references)
    bad = [f"bad{k}" for k in range(len(rows))]

    def entry(test: int, value: Column, own: int, parent: int, bads: Sequence[Column]) -> Column:
        return F.struct(
            F.lit(test).alias("test"), value.cast("string").alias("value"), F.lit(own).cast("bigint").alias("own"),
            F.lit(parent).alias("parent"), *[b.cast("bigint").alias(name) for name, b in zip(bad, bads)])

    none = [F.lit(0)] * len(rows)
    entries = [entry(n_keyed, F.lit(""), 1, 0, [t.bad.cast("int") for t in rows])] if rows else []
    entries += [entry(k, F.col(c), 1, 0, none) for k, c in enumerate([*unique, *[r.column for r in references]])]
    given = df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    for k, r in enumerate(references, len(unique)):
        given = given.unionByName(r.parent.select(entry(k, F.col(r.parent_column), 0, 1, none).alias("e")).select("e.*"))
    summed = given.filter("value is not null").groupBy("test", "value").agg(
        F.sum("own").alias("own"), F.max("parent").alias("parent"), *[F.sum(b).alias(b) for b in bad])
    of = lambda k: F.col("test") == k
    failures = [F.coalesce(F.sum(b), F.lit(0)) for b in bad]
    failures += [F.count_if(of(k) & (F.col("own") > 1)) for k in range(len(unique))]
    failures += [F.coalesce(F.sum(F.when(of(k) & (F.col("parent") == 0), F.col("own"))), F.lit(0)) for k in range(len(unique), n_keyed)]
    names = [(t.column, t.test, ERROR) for t in rows] + [(c, "unique", ERROR) for c in unique]
    names += [(r.column, "relationships", r.severity) for r in references]
    counted = summed.agg(*[f.cast("bigint").alias(f"n{k}") for k, f in enumerate(failures)])
    return counted.select(F.explode(F.array(*[outcome(model, *name, F.col(f"n{k}")) for k, name in enumerate(names)])).alias("r")).select("r.*")


def outcome(model: str, column: str, test: str, severity: str, failures: Column) -> Column:
    """A result row of a column test."""
    return F.struct(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test"),
        failures.alias("failures"), F.lit(severity).alias("severity"))


# --- gate and monitors ---------------------------------------------------------------------


class QualityGateError(RuntimeError):
    """An ERROR check failed; nothing downstream may be published."""


def failed_checks(results: DataFrame, waive: Collection[str] = ()) -> DataFrame:
    """The ERROR checks that failed and are not waived."""
    bad = (F.col("status") == "FAIL") & (F.col("severity") == ERROR) & ~F.col("check_name").isin(*waive)
    return results.filter(bad).select(F.col("check_name").alias("failed"))


def failed_tests(tests: DataFrame, waive: Collection[str] = ()) -> DataFrame:
    """The column tests of severity ERROR with failures, as model.column.test."""
    name = F.concat_ws(".", "model", "column_name", "test")
    return tests.filter((F.col("failures") > 0) & (F.col("severity") == ERROR) & ~name.isin(*waive)).select(name.alias("failed"))


def _raise(failed: DataFrame) -> None:
    names = sorted(r["failed"] for r in failed.collect())  # a few verdict rows
    if names:
        raise QualityGateError("failed checks: " + ", ".join(names))


def gate(results: DataFrame, waive: Collection[str] = ()) -> None:
    """Raise if any ERROR check failed (looks at the few verdict rows)."""
    _raise(failed_checks(results, waive))


def gate_tests(tests: DataFrame, waive: Collection[str] = ()) -> None:
    """Raise if any column test of severity ERROR failed."""
    _raise(failed_tests(tests, waive))


def sync_anomalies(
    sync_log: DataFrame, part: str = "connector", ts: str = "synced_at",
    seconds: str = "duration_s", rows: str = "row_count", days: int = 30,
) -> DataFrame:
    """Syncs slower than twice the mean of the 30 days before, or whose row count moved by more
    than half since the previous sync. The log has a few rows per connector and day."""
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    before = Window.partitionBy(part).orderBy(at).rangeBetween(-days * 86400, -1)
    prior = F.lag(rows).over(Window.partitionBy(part).orderBy(ts))
    return (
        sync_log.withColumn("avg_duration_s", F.avg(seconds).over(before))
        .withColumn("prev_row_count", prior)
        .withColumn("is_slow", flag(F.col(seconds) > F.col("avg_duration_s") * 2))
        .withColumn(
            "is_row_drift",
            flag(F.abs(F.col(rows) - F.col("prev_row_count")) * 2 > F.col("prev_row_count")),
        )
        .filter((F.col("is_slow") == 1) | (F.col("is_row_drift") == 1))
    )
