from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from bankspark.functions.dates import lit_ts
from bankspark.operators import changes
from bankspark.sources import sinks
from tests.util import bag, frame, ts

NOW = datetime(2024, 5, 1)
ROW = "k string, amount decimal(18,2), owner string, cdc_operation string, ingested_at timestamp_ntz"


def target(spark):
    old = datetime(2024, 1, 1)
    return frame(spark, ROW, *[(k, Decimal("1.00"), "me", "INSERT", old) for k in ("a", "b", "c", "d")])


def batch(spark):
    return frame(
        spark, "k string, amount decimal(18,2), owner string, cdc_operation string",
        ("a", Decimal("2.00"), "you", "UPDATE"), ("b", Decimal("2.00"), "you", "DELETE"), ("c", Decimal("2.00"), "you", "INSERT"),
        ("x", Decimal("2.00"), "you", "UPDATE"), ("y", Decimal("2.00"), "you", "INSERT"), ("z", Decimal("2.00"), "you", "DELETE"),
        ("d", Decimal("2.00"), "you", None),
    )


def test_three_clauses_and_repetition(spark):
    once = changes.apply_changes(target(spark), batch(spark), "k", lit_ts(NOW))
    want = sorted(
        [("a", 2.0, "me", "UPDATE", 5), ("c", 1.0, "me", "INSERT", 1), ("d", 1.0, "me", "INSERT", 1), ("y", 2.0, "you", "INSERT", 5)]
    )
    shown = lambda df: sorted((r["k"], float(r["amount"]), r["owner"], r["cdc_operation"], r["ingested_at"].month) for r in df.collect())
    assert shown(once) == want
    assert shown(changes.apply_changes(once, batch(spark), "k", lit_ts(NOW))) == want


def test_update_pair_keeps_the_new_image(spark):
    t = ts("2024-01-01")
    df = frame(spark, "k string, s timestamp_ntz, a string, v int", ("a", t, "DELETE", 1), ("a", t, "INSERT", 2), ("b", t, "DELETE", 3))
    assert bag(changes.latest_change(df, "k", "s", "a"), "k", "v") == [("a", 2), ("b", 3)]


def test_table_changes_lead_from_one_state_to_the_other(spark):
    schema = "k string, v string"
    before = frame(spark, schema, ("a", "1"), ("b", None), ("c", "3"))
    after = frame(spark, schema, ("a", "2"), ("b", None), ("d", "4"))
    got = changes.table_changes(before, after, "k")
    assert bag(got) == sorted(
        [("a", "1", "DELETE", True), ("a", "2", "INSERT", True), ("c", "3", "DELETE", False), ("d", "4", "INSERT", False)], key=repr
    )
    removed = got.filter("action = 'DELETE'").select("k", "v")
    added = got.filter("action = 'INSERT'").select("k", "v")
    assert bag(before.exceptAll(removed).unionAll(added)) == bag(after)
    assert bag(changes.table_changes(None, after, "k"), "action") == [("INSERT",)] * 3


def test_merge_twice_equals_once_and_columns_follow(spark):
    old = frame(spark, "k string, v int, gone int", ("a", 1, 1), ("b", 2, 2))
    new = frame(spark, "k string, v int, fresh string", ("b", 20, "x"), ("c", 30, "y"))
    once = changes.merge_by_key(old, new, "k")
    assert bag(once) == sorted([("a", 1, None), ("b", 20, "x"), ("c", 30, "y")], key=repr)
    assert bag(changes.merge_by_key(once, new, "k")) == bag(once)


def test_incremental_bounds(spark):
    src = frame(spark, "k int, t timestamp_ntz", (1, ts("2024-01-01 00:00:00")), (2, ts("2024-01-01 12:00:00")), (3, ts("2024-01-02 12:00:00")))
    empty = src.filter("k < 0")
    assert changes.incremental_slice(src, "t", empty).count() == 3
    target_ = src.filter("k = 3")
    assert bag(changes.incremental_slice(src, "t", target_, 24), "k") == [(2,), (3,)]
    assert bag(changes.incremental_slice(src, "t", backfill_from=ts("2024-01-02")), "k") == [(3,)]


def test_sync_modes(spark):
    at = datetime(2024, 1, 2)
    old = sinks.sync(None, frame(spark, "k string, v int", ("a", 1), ("b", 2)), "reimport", "k", datetime(2024, 1, 1))
    new = frame(spark, "k string, v int", ("b", 3), ("c", 4))
    assert bag(sinks.sync(old, new, "upsert", "k", at), "k", "v", "_deleted") == [("a", 1, False), ("b", 3, False), ("c", 4, False)]
    soft = sinks.sync(old, new, "soft_delete", "k", at)
    assert bag(soft, "k", "v", "_deleted") == [("a", 1, True), ("b", 3, False), ("c", 4, False)]
    again = sinks.sync(soft, new, "soft_delete", "k", datetime(2024, 1, 3))
    assert again.filter("k = 'a'").first()["_synced"] == at


def test_written_merge_moves_rows_between_partitions(spark, tmp_path):
    path = str(tmp_path / "fact")
    schema = "k string, day date, v int"
    day = lambda s: ts(s).date()
    sinks.merge_into_table(spark, path, frame(spark, schema, ("a", day("2024-01-05"), 1), ("b", day("2024-02-05"), 2), ("c", day("2024-03-05"), 3)), "k", "day")
    # b leaves February, which then has no rows; d arrives; a is replaced in place.
    updates = frame(spark, schema, ("a", day("2024-01-06"), 10), ("b", day("2024-03-06"), 20), ("d", None, 40))
    for _ in range(2):
        sinks.merge_into_table(spark, path, updates, "k", "day")
        got = bag(sinks.read_clustered(spark, path), "k", "v")
        assert got == [("a", 10), ("b", 20), ("c", 3), ("d", 40)]
    parts = sorted(p.name for p in (tmp_path / "fact").iterdir() if p.is_dir())
    assert parts == ["date_part=m2024-01", "date_part=m2024-03", "date_part=none"]


def test_an_interrupted_move_is_finished_or_dropped(spark, tmp_path):
    path, pending = tmp_path / "fact", tmp_path / "fact__pending"
    schema = "k string, day date, v int"
    day = lambda s: ts(s).date()
    base = frame(spark, schema, ("a", day("2024-01-05"), 1), ("b", day("2024-02-05"), 2), ("c", day("2024-03-05"), 3))
    sinks.write_clustered(base, str(path), "day")
    # Incomplete: dropped.
    sinks.write_clustered(frame(spark, schema, ("a", day("2024-01-05"), 9)), str(pending), "day")
    sinks.finish_move(spark, str(path))
    assert bag(sinks.read_clustered(spark, str(path)), "k", "v") == [("a", 1), ("b", 2), ("c", 3)] and not pending.exists()
    # Complete, and the process died after it had removed the old January: finished.
    sinks.write_clustered(frame(spark, schema, ("a", day("2024-01-05"), 9)), str(pending), "day")
    (pending / "date_part=m2024-02").mkdir()
    (pending / sinks.READY).touch()
    sinks.discard(spark, str(path / "date_part=m2024-01"))
    sinks.merge_into_table(spark, str(path), frame(spark, schema, ("d", day("2024-04-01"), 4)), "k", "day")
    assert bag(sinks.read_clustered(spark, str(path)), "k", "v") == [("a", 9), ("c", 3), ("d", 4)] and not pending.exists()


def test_replacing_a_table_survives_an_interruption(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace_table(spark.range(3), path)
    sinks.replace_table(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 2
    spark.range(7).write.parquet(path + sinks.PENDING)
    sinks.finish_replace(spark, path)
    assert spark.read.parquet(path).count() == 2
    spark.range(7).write.parquet(path + sinks.PENDING)
    (tmp_path / ("t" + sinks.PENDING) / sinks.READY).touch()
    sinks.discard(spark, path)
    sinks.finish_replace(spark, path)
    assert spark.read.parquet(path).count() == 7


def test_clustered_table_prunes_and_splits_a_hot_day(spark, tmp_path):
    path = str(tmp_path / "hot")
    df = spark.range(0, 200000, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01").cast("date"))
        .otherwise(F.date_add(F.lit("2024-02-01").cast("date"), (F.col("id") % 20).cast("int"))).alias("day"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(size)
    spark.conf.set(size, "500KB")
    try:
        sinks.write_clustered(df, path, "day", grain="day")
    finally:
        spark.conf.set(size, old)
    back = spark.read.parquet(path).filter("date_part = 'd2024-01-01'")
    assert back.count() == 66667
    hot = [f for f in spark.read.parquet(path).inputFiles() if "d2024-01-01" in f]
    cold = [f for f in spark.read.parquet(path).inputFiles() if "d2024-02-05" in f]
    assert len(hot) >= 4 and len(hot) > len(cold)
    assert "PartitionFilters: [isnotnull(date_part" in back._jdf.queryExecution().executedPlan().toString()
