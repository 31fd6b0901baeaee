import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from bankspark.operators.bursts import burst_counts, with_burst_count, with_burst_flag
from tests.util import bag, frame, plan, ts

START = datetime(2024, 1, 1)


def brute(rows, minutes=60):
    """Count per row: rows of the same key within [t - minutes, t]."""
    by_key = defaultdict(list)
    for _, key, t in rows:
        by_key[key].append(t)
    window = timedelta(minutes=minutes)
    return sorted(
        ((i, sum(1 for u in by_key[k] if (t is None and u is None) or (t and u and t - window <= u <= t))) for i, k, t in rows),
        key=repr,
    )


def test_window_edges(spark):
    t = [ts("2024-01-01 10:00:00"), ts("2024-01-01 10:59:00"), ts("2024-01-01 11:00:00"), ts("2024-01-01 11:01:00")]
    df = frame(spark, "id int, k string, t timestamp_ntz", *[(i, "a", x) for i, x in enumerate(t)])
    assert bag(with_burst_count(df, "k", "t"), "id", "txn_count_60min") == [(0, 1), (1, 2), (2, 3), (3, 3)]
    assert bag(with_burst_flag(df, "k", "t"), "id", "is_rapid_fire_flag") == [(0, 0), (1, 0), (2, 1), (3, 1)]


def test_peers_count_each_other_and_nulls_are_one_group(spark):
    t = ts("2024-01-01 10:00:00")
    rows = [(0, "a", t), (1, "a", t), (2, None, t), (3, None, t), (4, None, ts("2024-01-01 10:30:00")), (5, "a", None), (6, "a", None)]
    df = frame(spark, "id int, k string, t timestamp_ntz", *rows)
    assert bag(with_burst_count(df, "k", "t"), "id", "txn_count_60min") == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3), (5, 2), (6, 2)]


@pytest.mark.parametrize("bucket_windows", [1, 4])
def test_against_brute_force_with_a_hot_key(spark, bucket_windows):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(40)}"
        # Many instants fall exactly on the minute and on bucket borders.
        t = START + timedelta(minutes=rng.randrange(0, 3000), microseconds=rng.choice([0, 0, 1, 999_999]))
        rows.append((i, key, t))
    df = frame(spark, "id int, k string, t timestamp_ntz", *rows)
    counts = burst_counts(df, "k", "t", 60, bucket_windows)
    joined = df.join(counts, (df.k == counts["_key"]) & (df.t == counts["_ts"]), "left")
    assert bag(joined, "id", "txn_count") == brute(rows)


def test_hot_key_is_spread_over_buckets(spark):
    """A third of all rows on one key ends in many window groups, none of them large."""
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("t"),
    )
    counts = burst_counts(df, "k", "t")
    assert counts.filter("_key = 'hot'").count() == 10000
    text = plan(counts)
    window = next(line for line in text.splitlines() if "Window [" in line)
    assert "_bucket" in window and "CartesianProduct" not in text
    assert "partial_count" in text


def test_same_instant_flood_is_counted_before_the_shuffle(spark):
    df = spark.range(20000).select(F.lit("hot").alias("k"), F.lit(START).cast("timestamp_ntz").alias("t"))
    assert bag(burst_counts(df, "k", "t")) == [("hot", START, 20000)]
