"""What is kept per partition and follows the partitions that were written."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankspark.config import Params
from bankspark.operators import quality as Q
from bankspark.operators.test_state import refresh_tests
from bankspark.plans import fraud, marts, monthly
from bankspark.sources import sinks
from bankspark.sources.touched import Touched, follow, month_of, months_of
from tests.util import bag, frame, plan

SCHEMA = "k string, account string, amount int, d date"


def rows(spark, *items):
    return frame(spark, SCHEMA, *[(k, a, n, date.fromisoformat(d) if d else None) for k, a, n, d in items])


def test_followers_see_what_was_written_since_they_came(spark, tmp_path):
    t = Touched(spark, str(tmp_path / "t"))
    assert t.since("a") == (None, 0)
    t.mark(None)
    parts, n = t.since("a")
    assert parts is None and n == 1
    t.reached("a", n)
    assert t.since("a") == ([], 1) and t.since("b")[0] is None
    t.mark(["m2001-02", "none"])
    t.mark(["m2001-02", "m2001-03"])
    parts, n = t.since("a")
    assert parts == ["m2001-02", "m2001-03", "none"] and n == 3
    t.mark([])
    t.mark(["m2001-04"])  # arrives after `a` looked
    t.reached("a", n)
    assert t.since("a")[0] == ["m2001-04"]
    t.mark(None)
    assert t.since("a")[0] is None
    assert months_of(["d2001-02-03", "d2001-02-04", "none", "m2001-05"]) == ["m2001-02", "m2001-05", "none"]


def test_the_books_stay_short(spark, tmp_path, monkeypatch):
    from bankspark.sources import touched as module

    monkeypatch.setattr(module, "FEW_FILES", 6)
    t = Touched(spark, str(tmp_path / "t"))
    t.mark(None)
    t.reached("slow", t.since("slow")[1])
    for k in range(1, 8):
        t.mark([f"m2001-0{k}"])
        parts, n = t.since("quick")
        assert parts is None if k == 1 else parts == [f"m2001-0{k}"]
        t.reached("quick", n)
    assert t.since("slow")[0] == [f"m2001-0{k}" for k in range(1, 8)] and t.since("quick") == ([], 8)
    assert len([f for f in (tmp_path / "t" / "done").iterdir() if f.suffix == ".parquet"]) < 7
    t.reached("slow", 8)
    t.reached("quick", 8)
    t.mark(["m2001-09"])
    assert t.since("slow") == (["m2001-09"], 9) == t.since("quick") and t.since("new")[0] is None


@pytest.mark.parametrize("grain", ["month", "day"])
def test_only_touched_months_are_read(spark, tmp_path, grain):
    table, kept = str(tmp_path / "t"), str(tmp_path / "kept")
    first = [("a", "x", 1, "2001-01-05"), ("b", "x", 2, "2001-01-20"), ("c", "y", 3, "2001-02-01"), ("n", "y", 9, None)]
    sinks.write_clustered(rows(spark, *first), table, "d", grain)
    sums = lambda df: df.groupBy("month").agg(F.sum("amount").alias("total"))
    whole = lambda: bag(sums(spark.read.parquet(table).withColumn("month", month_of(F.col("date_part")))), "month", "total")
    assert bag(follow(spark, kept, table, "month", None, sums, month_of), "month", "total") == whole() == [("m2001-01", 3), ("m2001-02", 3), ("none", 9)]
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "kept" / "month=m2001-01").iterdir()}
    marks = []
    moved = rows(spark, ("c", "y", 3, "2001-03-01"), ("z", "y", 5, "2001-03-02"))  # February loses its only row
    sinks.merge_into_table(spark, table, moved, "k", "d", grain, before=marks.append)
    months = months_of(marks[0])
    assert months == ["m2001-02", "m2001-03"]
    seen = []

    def work(df):
        seen.append(plan(df))
        return sums(df)

    assert bag(follow(spark, kept, table, "month", months, work, month_of), "month", "total") == whole()
    assert "PartitionFilters: []" not in seen[0] and before == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "kept" / "month=m2001-01").iterdir()}
    assert bag(follow(spark, kept, table, "month", [], work, month_of), "month", "total") == whole()


FACT = (
    "transaction_sk string, transaction_date date, transaction_status string, transaction_type string, amount_usd decimal(18,2), "
    "customer_segment string, customer_risk_category string, branch_region string, customer_id string, account_id string, "
    "branch_id string, is_failed_flag int, is_high_value_flag int, is_blocked_flag int, is_round_high_value_flag int, "
    "transaction_id string, transaction_timestamp timestamp_ntz, currency string, merchant_category string")
P = Params(as_of=datetime(2002, 1, 1))


def facts(n, seed, first=0):
    rng = random.Random(seed)
    day = lambda: None if rng.random() < 0.05 else date(2001, rng.randrange(1, 7), rng.randrange(1, 28))
    return [(f"s{first + i}", day(), rng.choice(["COMPLETED"] * 3 + ["FAILED"]), rng.choice(["CREDIT", "DEBIT", "REFUND", "FEE"]),
             Decimal(rng.randrange(1, 90000)) / 100, rng.choice("AB"), "LOW", rng.choice(["E", None]), rng.choice(["c1", "c2", "c3", None]),
             f"a{rng.randrange(5)}", rng.choice(["b1", "b2", None]), rng.randrange(2), 0, 0, 0, f"t{first + i}", None, "USD", "X") for i in range(n)]


def at(row, moment):
    """A row of the fact at another time."""
    day = None if moment is None else moment.date()
    return (row[0], day, *row[2:16], moment, *row[17:])


def test_months_kept_equal_marts_made_at_once(spark, tmp_path):
    """After a late month, a moved row and a repeated run."""
    path, folder = str(tmp_path / "fact"), str(tmp_path / "monthly")
    touched = Touched(spark, str(tmp_path / "touched"))

    def load(items):
        sinks.merge_into_table(spark, path, frame(spark, FACT, *items), "transaction_sk", "transaction_date", before=touched.mark)
        got = monthly.refresh(spark, folder, path, touched, P, str(tmp_path / "scratch"))
        fact = sinks.read_clustered(spark, path)
        assert bag(got["revenue"], *sorted(got["revenue"].columns)) == bag(marts.revenue_monthly(fact), *sorted(got["revenue"].columns))
        assert bag(got["branches"], *sorted(got["branches"].columns)) == bag(marts.branch_months(fact), *sorted(got["branches"].columns))
        cols = sorted(marts.customer_txn_agg(fact).columns)
        assert bag(marts.customer_txn_total(got["customers"]), *cols) == bag(marts.customer_txn_agg(fact), *cols)

    load(facts(200, 1))
    may = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "monthly" / "customers" / "month=m2001-05").iterdir()}
    load([("s1", date(2001, 2, 3), *facts(1, 2)[0][2:]), *[(r[0], date(2001, 3, 9), *r[2:]) for r in facts(3, 3, 500)]])
    if touched.since("monthly")[0] == []:
        unchanged = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "monthly" / "customers" / "month=m2001-05").iterdir()}
        old = facts(200, 1)[1][1]
        assert unchanged == may or (old and old.month == 5)
    load([])


def test_flags_kept_by_month_see_over_its_edges(spark, tmp_path):
    """A late row at the end of a month raises a burst in the next one; months far away stay as they are."""
    path, folder = str(tmp_path / "fact"), str(tmp_path / "monthly")
    touched, blank = Touched(spark, str(tmp_path / "touched")), facts(40, 5)

    def load(items):
        items = [(*r[:9], "a", *r[10:]) for r in items]
        sinks.merge_into_table(spark, path, frame(spark, FACT, *items), "transaction_sk", "transaction_date", before=touched.mark)
        got = monthly.refresh(spark, folder, path, touched, P, str(tmp_path / "scratch"))["flags"]
        want = fraud.fraud_indicators(sinks.read_clustered(spark, path), P)
        assert bag(got, *sorted(want.columns)) == bag(want, *sorted(want.columns))
        return {r.transaction_sk for r in got.collect()}

    t = lambda *x: datetime(2001, *x)
    first = load([at(blank[0], t(3, 1, 0, 5)), at(blank[1], t(3, 1, 0, 20)), at(blank[2], t(6, 1, 5)), at(blank[3], t(6, 1, 5)), at(blank[4], t(6, 1, 5, 1)), at(blank[5], None)])
    assert first == {"s4"}
    june = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "monthly" / "flags" / "month=m2001-06").iterdir()}
    second = load([at(blank[6], t(2, 28, 23, 50))])
    assert second - first == {"s1"}
    assert june == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "monthly" / "flags" / "month=m2001-06").iterdir()}
    load([at(blank[7], None), at(blank[6], t(2, 20))])  # it moves away again, and the burst with it


def state(spark, home, table, parts, tests):
    return bag(refresh_tests(spark, str(home / "state"), table, parts, "m", *tests), "model", "column_name", "test", "failures", "severity")


def test_stored_tests_equal_tests_of_the_whole(spark, tmp_path):
    """Random merges; after each the stored state says what a scan of everything says."""
    rng = random.Random(4)
    table, touched = str(tmp_path / "t"), Touched(spark, str(tmp_path / "touched"))
    parents = frame(spark, "id string", ("x",), ("y",))
    for n in range(5):
        tests = ([Q.test_not_null("d"), Q.test_between("amount", F.lit(2), F.lit(7))], ["account", "amount"], [Q.Reference("account", parents, "id", "WARN")])
        items = [(f"k{rng.randrange(15)}-{n if rng.random() < 0.3 else 0}", rng.choice(["x", "y", "z", None, f"u{n}"]), rng.randrange(10), rng.choice([None, *[f"2001-0{m}-05" for m in (1, 2, 3)]]))
                 for _ in range(4 if n else 20)]
        items = list({i[0]: i for i in items}.values())
        sinks.merge_into_table(spark, table, rows(spark, *items), "k", "d", before=touched.mark)
        parts, at = touched.since("tests")
        got = state(spark, tmp_path, table, parts, tests)
        touched.reached("tests", at)
        want = Q.run_table_tests(sinks.read_clustered(spark, table), "m", *tests)
        assert got == bag(want, "model", "column_name", "test", "failures", "severity")
        assert any(r[3] for r in got)
        parents = parents.limit(1) if n == 2 else parents  # a parent goes: nothing was written, failures still follow


def test_a_second_run_reads_touched_partitions_only(spark, tmp_path):
    table = tmp_path / "t"
    sinks.write_clustered(rows(spark, ("a", "x", 1, "2001-01-05"), ("b", "x", 2, "2001-02-05"), ("c", "y", 2, "2001-03-05")), str(table), "d")
    tests = ([Q.test_not_null("account")], ["amount"], [])
    assert {r[2]: r[3] for r in state(spark, tmp_path, str(table), None, tests)} == {"not_null": 0, "unique": 1}
    sinks.merge_into_table(spark, str(table), rows(spark, ("b", None, 1, "2001-02-05")), "k", "d")
    for month in ("m2001-01", "m2001-03"):  # rows that would fail every test, if they were read
        rows(spark, ("q", None, 7, "2001-01-05"), ("q", None, 7, "2001-01-05")).drop("d").write.mode("overwrite").parquet(str(table / f"date_part={month}"))
    assert {r[2]: r[3] for r in state(spark, tmp_path, str(table), ["m2001-02"], tests)} == {"not_null": 1, "unique": 1}


def test_table_tests_need_one_shuffle(spark):
    df = rows(spark, ("a", "x", 1, "2001-01-05"), ("a", "z", 2, None), ("b", None, 2, None), ("b", "z", 9, None), (None, "x", 9, None), (None, "x", 9, None))
    parents = frame(spark, "id string", ("x",), ("x",), (None,))
    tests = ([Q.test_not_null("d"), Q.test_accepted("account", ["x"]), Q.test_positive("amount")], ["k", "account"], [Q.Reference("account", parents, "id", "WARN")])
    found = Q.run_table_tests(df, "m", *tests)
    text = plan(found)
    assert {(r.column_name, r.test): r.failures for r in found.collect()} == {
        ("d", "not_null"): 5, ("account", "accepted_values"): 2, ("amount", "positive_value"): 0,
        ("k", "unique"): 2, ("account", "unique"): 2, ("account", "relationships"): 2}
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Exchange SinglePartition") == 1 and "Join" not in text
    assert {r.failures for r in Q.run_table_tests(df.limit(0), "m", *tests).collect()} == {0}


def test_publication_that_is_cut_off_is_finished(spark, tmp_path, monkeypatch):
    folder, pending = tmp_path / "bank", tmp_path / "bank" / "_pending-1"
    for name in ("one", "two", "three"):
        sinks.materialize(rows(spark, (name, "old", 1, None)), str(folder), name)
        sinks.materialize(rows(spark, (name, "new", 1, None)), str(pending), name)
    (folder / "_pending-2").mkdir()
    real, done = sinks.publish, []

    def failing(spark_, source, path):
        if len(done) == 1:
            raise OSError("lost")
        done.append(path)
        return real(spark_, source, path)

    monkeypatch.setattr(sinks, "publish", failing)
    with pytest.raises(OSError):
        sinks.publish_all(spark, str(pending), str(folder))
    monkeypatch.undo()
    # One table had been moved away, but had not yet reached its place.
    left = sorted(p.name for p in pending.iterdir() if not p.name.startswith((".", "_")))
    (pending / left[0] / "_READY").touch()
    (pending / left[0]).rename(folder / f"{left[0]}__pending")
    sinks.finish_publication(spark, str(folder))
    for name in ("one", "two", "three"):
        assert bag(spark.read.parquet(str(folder / name)), "account") == [("new",)]
    assert sorted(p.name for p in folder.iterdir()) == ["one", "three", "two"]
    # One that never began leaves the old tables.
    sinks.materialize(rows(spark, ("one", "newer", 1, None)), str(pending), "one")
    sinks.finish_publication(spark, str(folder))
    assert bag(spark.read.parquet(str(folder / "one")), "account") == [("new",)] and not pending.exists()
