from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankspark.operators import quality as Q
from tests.util import bag, frame, ts

NOW = datetime(2024, 6, 15, 12, 0)
C = Q.Check("c", "CAT", "RAW", "t", "ERROR", "d")


def status(df):
    r = df.first()
    return r["status"], r["observed_value"]


def test_freshness(spark):
    at = lambda m: frame(spark, "_synced timestamp_ntz", (NOW - timedelta(minutes=m),))
    assert status(Q.check_freshness(at(120), C, 120, NOW)) == ("PASS", Decimal("120.0000"))
    assert status(Q.check_freshness(at(121), C, 120, NOW))[0] == "FAIL"
    empty = at(0).filter("false")
    assert status(Q.check_freshness(empty, C, 120, NOW)) == ("PASS", None)
    assert status(Q.check_freshness(empty, C, 120, NOW, strict=True))[0] == "FAIL"
    got = [Q.source_freshness(at(m), "s", 30, 120, NOW).first()["status"] for m in (30, 31, 121)]
    assert got == ["PASS", "WARN", "ERROR"]


def test_unique_fk_and_predicates(spark):
    df = frame(spark, "k string, v int", ("a", 1), ("a", -1), (None, None))
    assert status(Q.check_unique(df, C, "k")) == ("FAIL", Decimal("2.0000"))
    parent = frame(spark, "k string", ("a",))
    assert status(Q.check_fk(df, parent, C, "k", tolerance=1)) == ("PASS", Decimal("1.0000"))
    assert status(Q.check_fk(df, parent, C, "k"))[0] == "FAIL"
    both = Q.check_predicates(df, [(C, F.col("v") < 0), (C, F.col("v") > 5)])
    assert bag(both, "status", "observed_value") == [("FAIL", Decimal("1.0000")), ("PASS", Decimal("0.0000"))]
    sampled = Q.with_failed_sample(Q.check_predicates(df, [(C, F.col("v") < 0)]), df, F.col("v") < 0, ["k", "v"])
    assert sampled.first()["failed_row_sample"] == ['{"k":"a","v":-1}']


@pytest.mark.parametrize(
    "per_day, yesterday, want",
    [({}, 5, "PASS"), ({2: 10, 8: 10}, 3, "PASS"), ({2: 10, 8: 10}, 2, "FAIL"), ({2: 10, 8: 10}, 18, "FAIL"), ({9: 10}, 0, "PASS"), ({3: 10}, 0, "FAIL")],
)
def test_volume(spark, per_day, yesterday, want):
    today = date(2024, 6, 15)
    days = [today - timedelta(days=n) for n, c in {**per_day, 1: yesterday}.items() for _ in range(c)]
    df = spark.createDataFrame([(d,) for d in days], "day date")
    assert status(Q.check_volume(df, C, "day", today))[0] == want


def results(spark):
    rows = [
        ("r1", "a", "X", "RAW", "t", "WARN", "FAIL", ts("2024-06-14 10:00:00")),
        ("r2", "a", "X", "RAW", "t", "WARN", "PASS", ts("2024-06-14 11:00:00")),
        ("r2", "b", "X", "RAW", "t", "ERROR", "FAIL", ts("2024-06-14 11:00:00")),
        ("r2", "c", "X", "RAW", "t", "WARN", "FAIL", ts("2024-06-14 11:30:00")),
        ("r0", "c", "X", "RAW", "t", "WARN", "FAIL", ts("2024-01-01 11:30:00")),
    ]
    df = frame(spark, "check_run_id string, check_name string, check_category string, layer string, target_object string, severity string, status string, executed_at timestamp_ntz", *rows)
    return df.withColumn("observed_value", F.lit(1)).withColumn("threshold_value", F.lit(0)).withColumn("check_details", F.lit(""))


def test_result_views(spark):
    assert [r["check_name"] for r in Q.failures_open(results(spark)).collect()] == ["b", "c"]
    card = Q.scorecard(results(spark), date(2024, 6, 15)).first()
    assert (card["total_checks"], card["passed"], card["failed"], card["pass_rate_pct"], card["error_count"], card["warn_count"]) == (4, 1, 3, Decimal("25.00"), 1, 2)


def test_gate(spark):
    with pytest.raises(Q.QualityGateError, match="b"):
        Q.gate(results(spark))
    Q.gate(results(spark).filter("check_name <> 'b'"))


def test_reconcile_levels(spark):
    n = lambda k: spark.range(k)
    got = Q.reconcile({"A": n(0), "B": n(100), "C": n(100), "D": n(100)}, {"A": n(0), "B": n(95), "C": n(94), "D": n(100)})
    assert bag(got, "entity", "reconciliation_status") == [("A", "NO_DATA"), ("B", "DRIFT_LOW"), ("C", "DRIFT_HIGH"), ("D", "OK")]


def test_column_tests_let_nulls_pass(spark):
    df = frame(spark, "c string, v int", ("a", 0), ("z", 5), (None, None))
    got = Q.run_column_tests(df, "m", [Q.test_not_null("c"), Q.test_accepted("c", ["a"]), Q.test_between("v", F.lit(1), F.lit(4)), Q.test_positive("v")])
    assert bag(got, "test", "failures") == [("accepted_values", 1), ("between", 2), ("not_null", 1), ("positive_value", 1)]
    assert Q.run_unique_test(df.union(df), "m", "c").first()["failures"] == 2
    assert Q.run_relationship_test(df, "m", "c", df.filter("c = 'a'"), "c").first()["failures"] == 1


def test_schema_drift(spark):
    df = frame(spark, "a int, b string", (1, "x"))
    got = Q.check_schema(df, {"a": "bigint", "c": "string"}, "t")
    assert bag(got, "column_name", "drift") == [("a", "TYPE"), ("b", "ADDED"), ("c", "MISSING")]
    assert Q.check_schema(df, {"a": "int", "b": "string"}, "t").count() == 0


def test_reconciliation_tolerates_a_cent(spark):
    one = lambda v: frame(spark, "v decimal(18,2)", (Decimal(v),))
    s = F.sum("v").cast("decimal(18,2)")
    assert Q.assert_reconciles(one("10.00"), s, one("10.01"), s).count() == 0
    assert Q.assert_reconciles(one("10.00"), s, one("10.02"), s).first()["variance"] == Decimal("0.02")


def test_sync_anomalies(spark):
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    log = frame(
        spark, "connector string, synced_at timestamp_ntz, duration_s bigint, row_count bigint",
        ("a", day(0), 10, 100), ("a", day(1), 10, 150), ("a", day(2), 21, 150), ("a", day(3), 10, 70), ("a", day(60), 99, 70),
    )
    got = bag(Q.sync_anomalies(log), "synced_at", "is_slow", "is_row_drift")
    assert got == sorted([(day(2), 1, 0), (day(3), 0, 1)], key=repr)


def test_marts_are_made_from_the_tables_written_before_them(spark, tmp_path, monkeypatch):
    from types import SimpleNamespace

    from bankspark.checks import quality

    n = spark.range(5)
    b = SimpleNamespace(dim_customer=n, dim_branch=n, fct=n, loans=n, revenue=n)
    seen = {}

    def models(b):
        seen["from"] = [f for layer in quality._SHARED for f in getattr(b, layer).inputFiles()]
        return {**{m: getattr(b, layer) for layer, m in quality._SHARED.items()}, "fct_fraud_indicators": b.fct.filter("id > 2")}

    monkeypatch.setattr(quality, "_mart_models", models)
    written = quality._written_marts(b, str(tmp_path))
    assert {f.split("/")[-2] for f in seen["from"]} == set(quality._SHARED.values())
    assert list(written) == [*quality._SHARED.values(), "fct_fraud_indicators"]
    assert written["fct_fraud_indicators"].count() == 2 and written["fct_loans"].count() == 5
