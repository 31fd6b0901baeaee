import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bankspark.operators.history import overwrite_type1, snapshot_check, start_history
from bankspark.operators.joins import join_as_of_validity, join_short_history
from bankspark.sources import sinks
from tests.util import bag, frame, plan, ts

SCHEMA = "id string, name string, segment string, region string"
CHECK = ["segment", "region"]
R1, R2, R3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


def state(spark, *rows):
    return frame(spark, SCHEMA, *rows)


def first(spark):
    return start_history(
        state(spark, ("a", "A", "X", "N"), ("b", "B", "X", "N"), ("c", "C", "X", None), ("d", "D", "X", "N")), R1
    )


def test_versions(spark):
    now = state(spark, ("a", "A", "Y", "N"), ("b", "Bee", "X", "N"), ("c", "C", "X", None), ("e", "E", "X", "N"))
    got = bag(snapshot_check(first(spark), now, "id", CHECK, R2), "id", "name", "segment", "valid_from", "valid_to")
    assert got == sorted(
        [
            ("a", "A", "X", R1, R2), ("a", "A", "Y", R2, None),   # changed
            ("b", "B", "X", R1, None),                           # only the name changed
            ("c", "C", "X", R1, None),                           # null stays null
            ("d", "D", "X", R1, R2),                             # gone
            ("e", "E", "X", R2, None),                           # new
        ],
        key=repr,
    )


def test_no_change_adds_nothing_and_a_key_can_return(spark):
    h1 = first(spark)
    same = state(spark, ("a", "A", "X", "N"), ("b", "B", "X", "N"), ("c", "C", "X", None), ("d", "D", "X", "N"))
    assert bag(snapshot_check(h1, same, "id", CHECK, R2)) == bag(h1)
    without_d = same.filter("id <> 'd'")
    h2 = snapshot_check(h1, without_d, "id", CHECK, R2)
    h3 = snapshot_check(h2, same, "id", CHECK, R3)
    assert bag(h3.filter("id = 'd'"), "valid_from", "valid_to") == sorted([(R1, R2), (R3, None)], key=repr)


def test_deletes_can_be_left_open_and_names_overwritten(spark):
    now = state(spark, ("a", "Anna", "Y", "N"))
    kept = snapshot_check(first(spark), now, "id", CHECK, R2, invalidate_hard_deletes=False)
    assert kept.filter("valid_to is null").count() == 4
    named = overwrite_type1(kept, now, "id", ["name"])
    assert bag(named.filter("id in ('a', 'b')"), "id", "name") == [("a", "Anna"), ("a", "Anna"), ("b", "B")]


def test_written_snapshot_equals_the_one_in_memory(spark, tmp_path):
    path = str(tmp_path / "snap")
    runs = [
        (R1, state(spark, ("a", "A", "X", "N"), ("b", "B", "X", "N"))),
        (R2, state(spark, ("a", "A", "Y", "N"))),
        (R3, state(spark, ("a", "A", "Z", "N"), ("b", "B", "X", "N"))),
    ]
    memory = None
    for at, rows in runs:
        written = sinks.advance_snapshot(spark, path, rows, "id", CHECK, at)
        memory = start_history(rows, at) if memory is None else snapshot_check(memory, rows, "id", CHECK, at)
        assert bag(written) == bag(memory)


def test_a_repeated_run_keeps_the_history(spark, tmp_path):
    path = str(tmp_path / "snap")
    sinks.advance_snapshot(spark, path, state(spark, ("a", "A", "X", "N"), ("b", "B", "X", "N")), "id", CHECK, R1)
    changed = state(spark, ("a", "A", "Y", "N"))
    once = bag(sinks.advance_snapshot(spark, path, changed, "id", CHECK, R2))
    assert bag(sinks.advance_snapshot(spark, path, changed, "id", CHECK, R2)) == once
    # A run that died after it had closed versions but before it replaced the open ones.
    sinks.replace_table(
        start_history(state(spark, ("a", "A", "X", "N"), ("b", "B", "X", "N")), R1), path + "/open"
    )
    assert bag(sinks.advance_snapshot(spark, path, changed, "id", CHECK, R2)) == once


def test_point_in_time_join(spark):
    now = state(spark, ("a", "A", "Y", "N"))
    history = snapshot_check(first(spark), now, "id", CHECK, R2)
    facts = frame(
        spark, "n int, id string, at timestamp_ntz",
        (1, "a", ts("2023-12-31")), (2, "a", R1), (3, "a", ts("2024-01-31 23:59:59")), (4, "a", R2), (5, "zz", R2), (6, "d", R2),
    )
    got = bag(join_as_of_validity(facts, history, "id", "at", ["segment"]), "n", "asof_segment")
    assert got == [(1, None), (2, "X"), (3, "X"), (4, "Y"), (5, None), (6, None)]


def versions(rng, keys, n):
    """Contiguous and broken histories, versions of no length, open and closed ends."""
    out = []
    for k in keys:
        cuts = sorted(datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(0, 400_000)) for _ in range(n))
        for a, b in zip(cuts, [*cuts[1:], None]):
            if rng.random() < 0.8:
                out.append((k, a, b, None if rng.random() < 0.1 else f"{k}{len(out)}"))
    return out


@pytest.mark.parametrize("bucket_days", [1, 31, 5000])
def test_sweep_equals_the_interval_join(spark, bucket_days):
    rng = random.Random(bucket_days)
    keys = ["a", "b", "c", None]
    hist = versions(rng, keys, 12) + [("d", None, None, "lost"), ("d", datetime(2024, 3, 1), datetime(2024, 3, 1), "never")]
    moments = [h[1] for h in hist if h[1]] + [datetime(2023, 12, 1) + timedelta(minutes=rng.randrange(0, 500_000)) for _ in range(150)] + [None]
    facts = [(i, rng.choice([*keys, "d", "zz"]), at) for i, at in enumerate(moments)]
    history = frame(spark, "id string, valid_from timestamp_ntz, valid_to timestamp_ntz, segment string", *hist)
    fact = frame(spark, "n int, id string, at timestamp_ntz", *facts)
    cols = ("n", "id", "at", "asof_segment")
    got = bag(join_as_of_validity(fact, history, "id", "at", ["segment"], bucket_days), *cols)
    assert got == bag(join_short_history(fact, history, "id", "at", ["segment"]), *cols) and len(got) == len(facts)
    assert sum(r[3] is not None for r in got) > 30
    assert bag(join_as_of_validity(fact, history.limit(0), "id", "at", ["segment"]), "asof_segment") == [(None,)] * len(facts)
    assert join_as_of_validity(fact.limit(0), history, "id", "at", ["segment"]).count() == 0


def test_one_key_with_many_facts_and_versions(spark):
    """10^5 facts and 10^3 versions of a key meet in rows of both, not in pairs, and in many tasks' groups."""
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    at = lambda minutes: F.timestamp_add("MINUTE", minutes, start)
    history = spark.range(1000).select(F.lit("hot").alias("id"), at((F.col("id") * 500).cast("int")).alias("valid_from"),
                                       at((F.col("id") * 500 + 500).cast("int")).alias("valid_to"), F.col("id").alias("v"))
    fact = spark.range(100_000).select(F.lit("hot").alias("id"), F.col("id").alias("n"), at((F.col("id") * 5).cast("int")).alias("ts"))
    got = join_as_of_validity(fact, history, "id", "ts", ["v"], bucket_days=7)
    text = plan(got)
    assert "Join" not in text and "Window" in text
    assert got.filter("asof_v = n div 100").count() == 100_000
