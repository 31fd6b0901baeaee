import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from bankspark.config import Params
from bankspark.functions.dates import lit_ts
from bankspark.operators.bursts import burst_counts
from bankspark.streaming import cdc, late, monitors
from tests.util import bag, frame, plan, ts

P = Params(as_of=datetime(2024, 1, 31))
CHANGE = (
    "transaction_id string, account_id string, transaction_type string, amount decimal(18,2), currency string, "
    "merchant_category string, transaction_timestamp timestamp_ntz, transaction_status string, "
    "_synced timestamp_ntz, _deleted boolean, action string, is_update boolean"
)


def change(tid, amount, action="INSERT", is_update=False, status="COMPLETED", at="2024-01-10", synced=1, deleted=False):
    return (
        tid, "a1", "debit", None if amount is None else Decimal(amount), "usd", "x", ts(at), status,
        ts("2024-01-20") + timedelta(seconds=synced), deleted, action, is_update,
    )


class Pipe:
    """Lands waves of change records and runs the change path and the flagger after each."""

    def __init__(self, spark, home, buckets=4):
        self.spark, self.home, self.n, self.buckets = spark, home, 0, buckets
        self.path, self.log = str(home / "sink"), str(home / "log")

    def run(self, *rows):
        self.n += 1
        now = lit_ts(datetime(2024, 2, self.n))
        if rows:
            frame(self.spark, CHANGE, *rows).coalesce(1).write.mode("append").parquet(str(self.home / "landing"))
        records = self.spark.readStream.schema(CHANGE).parquet(str(self.home / "landing"))
        cdc.start_cdc(records, self.path, str(self.home / "ckpt"), P, now, buckets=self.buckets, available_now=True).awaitTermination()
        cdc.start_flags(self.spark, self.path, self.log, str(self.home / "ckpt2"), P, now, available_now=True).awaitTermination()

    @property
    def sink(self):
        return cdc.open_sink(self.spark, self.path)

    def stored(self):
        return {r["transaction_id"]: r for r in self.sink.rows().collect()}

    def flags(self):
        return bag(self.spark.read.parquet(self.log), "transaction_id", "flag_reason")


@pytest.mark.parametrize("folds", [False, True])
def test_changes_over_several_runs(spark, tmp_path, folds):
    """The same rows and flags whether batches are folded into the base in between or not."""
    pipe = Pipe(spark, tmp_path)
    pipe.run(
        change(" t1", "10.00"), change("t2", "60000.00"), change("t3", "30000.00"), change("t4", "1.00", status="blocked"),
        change("t5", "60000.00", status="blocked"), change("t6", None), change(None, "1.00"),
        change("t7", "60500.00"), change("t8", "1.00", at="2024-03-10"),
    )
    assert sorted(pipe.stored()) == ["T1", "T2", "T3", "T4", "T5", "T7", "T8"]
    first_flags = [
        ("T2", "ROUND_NUMBER_HIGH_VALUE"), ("T3", "HIGH_VALUE"), ("T4", "STATUS_BLOCKED"), ("T5", "STATUS_BLOCKED"), ("T7", "HIGH_VALUE"),
    ]
    assert pipe.flags() == first_flags
    if folds:
        assert pipe.sink.fold() > 0 and pipe.sink.fold() == 0
        pipe.sink.clean()
        assert len(pipe.stored()) == 7

    pipe.run(
        # an update pair at one sync time: the new image wins; a moved time must not move the row
        change("t1", "10.00", "DELETE", True, synced=5), change("t1", "26000.00", "INSERT", True, synced=5, at="2024-05-05"),
        change("t2", "60000.00", "DELETE"), change("t3", "31000.00", "INSERT", False),
        change("t9", "5.00", "INSERT", True),                     # update of an unknown key
        change("t4", "1.00", "INSERT", True, deleted=True),       # soft delete
        change("t8", "1.00", "DELETE", at="2024-03-10"),          # empties its month
        change("t10", "70000.00"), change("t10", "5.00", synced=9),  # the later of two
    )
    stored = pipe.stored()
    assert sorted(stored) == ["T1", "T10", "T3", "T5", "T7"]
    t1 = stored["T1"]
    assert (t1["amount"], t1["cdc_operation"], t1["transaction_timestamp"]) == (Decimal("26000.00"), "UPDATE", ts("2024-01-10"))
    assert t1["ingested_at"] == datetime(2024, 2, 2) and stored["T3"]["ingested_at"] == datetime(2024, 2, 1)
    assert stored["T3"]["amount"] == Decimal("30000.00") and stored["T10"]["amount"] == Decimal("5.00")
    assert pipe.flags() == sorted([*first_flags, ("T1", "HIGH_VALUE")])

    before = pipe.stored(), pipe.flags()
    if folds:
        pipe.sink.fold()
        pipe.sink.clean()
        assert pipe.stored() == before[0]
    pipe.run()  # nothing new has landed
    assert (pipe.stored(), pipe.flags()) == before
    pipe.run(change("unknown", "60000.00", "DELETE"))
    assert (pipe.stored(), pipe.flags()) == before


def take(spark, home, seq, rows, path=None, buckets=4):
    """One batch straight into a sink."""
    sink = cdc.open_sink(spark, path or str(home / "sink"), buckets=buckets)
    cdc.take_batch(sink, cdc.changes_per_key(frame(spark, CHANGE, *rows)), seq, lit_ts(datetime(2024, 2, 1)))
    return sink


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path, log = str(tmp_path / "sink"), str(tmp_path / "log")
    for seq, rows in enumerate((
        [change("t1", "60000.00"), change("t2", "5.00"), change("t3", "30000.00")],
        [change("t1", "1.00", "INSERT", True), change("t2", "5.00", "DELETE"), change("t4", "30000.00")],
    )):
        seen = []
        for _ in range(2):
            sink = take(spark, tmp_path, seq, rows)
            cdc.start_flags(spark, path, log, str(tmp_path / "ckpt"), P, available_now=True).awaitTermination()
            seen.append((bag(sink.rows()), bag(spark.read.parquet(log))))
        assert seen[0] == seen[1] and len(seen[0][1]) == 2 + seq
    # A fold that failed before it was entered in the books is written again.
    frame(spark, "transaction_sk string", ("junk",)).write.parquet(path + "/base/version=0/bucket=0/date_part=m2024-01")
    before = bag(sink.rows())
    assert sink.fold() > 0 and bag(sink.rows()) == before == bag(cdc.open_sink(spark, path).rows())


def test_sink_equals_changes_applied_one_batch_after_the_other(spark, tmp_path):
    """Random batches, folds and cleaning between some, against the plain merge of whole tables."""
    from bankspark.operators.changes import apply_changes

    rng = random.Random(8)
    want = spark.createDataFrame([], cdc.SINK_SCHEMA)
    for seq in range(6):
        rows = [change(f"t{rng.randrange(30)}", f"{rng.randrange(1, 60000)}.00", rng.choice(["INSERT", "INSERT", "DELETE"]), rng.random() < 0.4,
                       at=f"2024-0{rng.randrange(1, 5)}-01", synced=i) for i in range(rng.randrange(1, 25))]
        sink = take(spark, tmp_path, seq, rows)
        now = lit_ts(datetime(2024, 2, 1))
        want = spark.createDataFrame(apply_changes(want, cdc.changes_per_key(frame(spark, CHANGE, *rows)), "transaction_sk", now).collect(), cdc.SINK_SCHEMA)
        assert bag(sink.rows()) == bag(want)
        if seq in (1, 2, 4):
            sink.fold()
            if seq != 2:
                sink.clean()
                books = spark.read.parquet(str(tmp_path / "sink" / "versions"))
                assert books.count() == books.select("bucket").distinct().count() <= 4
            assert bag(sink.rows()) == bag(want)
    some = want.limit(3)
    assert bag(sink.rows(some)) == bag(want.join(some.select("transaction_sk"), "transaction_sk", "left_semi"))


def scans(df):
    return [line for line in plan(df).splitlines() if "FileScan parquet" in line and ("bucket" in line or "/sink" in line)]


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    """Ten keys of many, in a sink of 64 buckets: every read of the sink is filtered by partition, and
    at most ten buckets' files are opened."""
    take(spark, tmp_path, 0, [change(f"t{i}", "10.00", at=f"2024-0{1 + i % 4}-01") for i in range(600)], buckets=64).fold()
    sink = take(spark, tmp_path, 1, [change(f"t{i}", "30000.00", "INSERT", True) for i in range(10)])
    applied = sink.applied(1)
    assert applied.count() == 10 and bag(applied, "amount")[0] == (Decimal("30000.00"),)
    found = scans(applied)
    assert found and all("PartitionFilters: [" in line and "PartitionFilters: []" not in line for line in found)
    opened = {f.split("bucket=")[1].split("/")[0] for f in applied.inputFiles()}
    everywhere = {f.split("bucket=")[1].split("/")[0] for f in sink.rows().inputFiles()}
    assert len(opened) <= 10 < len(everywhere) == 64
    keys = spark.createDataFrame(applied.select("transaction_sk").limit(3).collect(), "transaction_sk string")
    assert sink.rows(keys).count() == 3
    found = scans(sink.rows(keys))
    assert found and all("PartitionFilters: [" in line and "PartitionFilters: []" not in line for line in found)
    assert len({f.split("bucket=")[1].split("/")[0] for f in sink.rows(keys).inputFiles() if "/base/" in f}) <= 3
    # A batch that is only stored reads nothing of the sink, and folding rewrites its buckets only.
    assert sink.fold() == len(opened)
    sink.clean()
    assert sink.rows().count() == 600 and sink.rows().filter("amount = 30000").count() == 10


def test_flagging_reads_neither_log_nor_sink(spark, tmp_path):
    take(spark, tmp_path, 0, [change(f"t{i}", "30000.00") for i in range(20)])
    path, log = str(tmp_path / "sink"), str(tmp_path / "log")
    for seq in (1, 2):
        q = cdc.start_flags(spark, path, log, str(tmp_path / "ckpt"), P, available_now=True)
        q.awaitTermination()
        text = q._jsq.explainInternal(False)
        assert "log" not in [x.rstrip("]") for line in text.splitlines() if "FileScan" in line for x in line.split("/")]
        assert "/base" not in text and "StreamingDeduplicateWithinWatermark" in text
        take(spark, tmp_path, seq, [change(f"t{i}", "31000.00", "INSERT", True) for i in range(25)] + [change("new", "30000.00")])
    assert spark.read.parquet(log).count() == 21
    # One entry a flagged key.
    assert q.lastProgress.stateOperators[0].numRowsTotal == 21


def test_a_new_stream_goes_on_after_the_batches_of_another(spark, tmp_path):
    take(spark, tmp_path, 0, [change("t1", "10.00")])
    sink = take(spark, tmp_path, 3, [change("t2", "10.00")])
    assert sink.first_seq("a") == 4 and sink.first_seq("a") == 4
    take(spark, tmp_path, 4, [change("t1", "10.00", "DELETE")]).fold()
    sink.clean()
    assert sink.first_seq("b") == 5 and bag(sink.rows(), "transaction_id") == [("T2",)]


def events(n=400, keys=6, seed=3):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        key = rng.choice(["hot", "hot", "hot", None, ""] + [f"k{n}" for n in range(keys)])
        rows.append((i, key, start + timedelta(seconds=rng.randrange(0, 30 * 3600), microseconds=rng.choice([0, 1]))))
    return rows


def stream_files(spark, home, schema, batches):
    """One file per batch, read one per micro-batch in the order written."""
    for i, rows in enumerate(batches):
        path = home / "in" / f"b{i}"
        frame(spark, schema, *rows).coalesce(1).write.parquet(str(path))
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
        .parquet(str(home / "in"))
    )


@pytest.mark.parametrize("bucket_windows", [1, 6])
def test_rapid_fire_stream_with_rows_out_of_order_equals_the_batch(spark, tmp_path, bucket_windows):
    rows = events()
    rows.sort(key=lambda r: r[2] + timedelta(minutes=37 * (r[0] % 5)))  # up to 2.5 h late
    batches = [rows[i * 100:(i + 1) * 100] for i in range(4)]
    schema = "id int, k string, t timestamp_ntz"
    stream = monitors.with_event_time(stream_files(spark, tmp_path, schema, batches), "t")
    out = str(tmp_path / "out")
    with monitors.progress_log(spark, str(tmp_path / "log"), every=3):
        monitors.run_to_files(
            monitors.rapid_fire_stream(stream, "k", "t", bucket_windows=bucket_windows), out, str(tmp_path / "ckpt")
        ).awaitTermination()
    emitted = spark.read.parquet(out)
    got = monitors.final_counts(emitted, "k", "t").withColumn("t", F.col("t").cast("timestamp_ntz"))
    want = burst_counts(frame(spark, schema, *rows), "k", "t")
    assert bag(got) == bag(want)
    assert emitted.count() >= got.count()  # late rows are corrections, not losses
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.agg(F.sum("input_rows"), F.sum("late_rows")).first() == (len(rows), 0) and log.count() >= 4


def test_one_hot_account_and_rows_that_come_too_late(spark, tmp_path):
    """Most rows belong to one account; two rows are beyond the watermark, and counted as such."""
    t0 = datetime(2024, 1, 1)
    rows = [(i, "hot" if i % 10 else f"k{i}", t0 + timedelta(seconds=i * 7)) for i in range(3000)]
    batches = [rows[:1500], rows[1500:] + [(9000, "far", t0 + timedelta(days=9))], [(9003, "far", t0 + timedelta(days=9))], [(9001, "hot", t0), (9002, "k0", t0)]]
    schema = "id int, k string, t timestamp_ntz"
    stream = monitors.with_event_time(stream_files(spark, tmp_path, schema, batches), "t")
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    with monitors.progress_log(spark, log):
        monitors.run_to_files(monitors.rapid_fire_stream(stream, "k", "t"), out, str(tmp_path / "ckpt")).awaitTermination()
    got = monitors.final_counts(spark.read.parquet(out), "k", "t").withColumn("t", F.col("t").cast("timestamp_ntz"))
    want = burst_counts(frame(spark, schema, *rows, (9000, "far", t0 + timedelta(days=9)), (9003, "far", t0 + timedelta(days=9))), "k", "t")
    assert bag(got) == bag(want)
    assert spark.read.parquet(log).agg(F.sum("late_rows")).first()[0] > 0


def test_open_days_join_the_closed_ones(spark):
    t0 = datetime(2024, 1, 1)
    flags = frame(spark, "r string, amount int, t timestamp_ntz", ("x", 1, t0), ("x", 2, t0 + timedelta(days=1)), ("y", 4, t0 + timedelta(days=1)))
    how = ("t", ["r"], "amount")
    none = frame(spark, "flag_date date, r string, flagged_count long, flagged_amount long")
    whole = bag(monitors.with_open_days(none, flags, *how))
    assert len(whole) == 3
    closed = frame(spark, "flag_date date, r string, flagged_count long, flagged_amount long", (t0.date(), "x", 1, 1))
    assert bag(monitors.with_open_days(closed, flags, *how)) == whole


def test_rapid_fire_state_expires(spark, tmp_path):
    schema = "id int, k string, t timestamp_ntz"
    t0 = datetime(2024, 1, 1)
    batches = [[(0, "a", t0)], [(1, "a", t0 + timedelta(days=3))], [(2, "a", t0 + timedelta(days=6))]]
    stream = monitors.with_event_time(stream_files(spark, tmp_path, schema, batches), "t")
    q = monitors.run_to_files(monitors.rapid_fire_stream(stream, "k", "t"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    last = q.lastProgress.stateOperators[0]
    assert last.numRowsTotal <= 2


def test_repeats_within_the_watermark_are_dropped(spark, tmp_path):
    schema = "id int, t timestamp_ntz"
    t0 = datetime(2024, 1, 1)
    batches = [[(1, t0), (1, t0), (2, t0)], [(1, t0 + timedelta(hours=2)), (3, t0 + timedelta(hours=3))]]
    stream = monitors.with_event_time(stream_files(spark, tmp_path, schema, batches), "t")
    out = str(tmp_path / "out")
    monitors.run_to_files(monitors.dedup_within_watermark(stream, ["id"]), out, str(tmp_path / "ckpt")).awaitTermination()
    assert bag(spark.read.parquet(out), "id") == [(1,), (2,), (3,)]


def test_daily_rollup_emits_closed_days_once(spark, tmp_path):
    schema = "r string, amount int, t timestamp_ntz"
    t0 = datetime(2024, 1, 1)
    batches = [
        [("x", 1, t0), ("x", 2, t0 + timedelta(hours=30))],
        [("x", 4, t0 + timedelta(hours=1)), ("x", 8, t0 + timedelta(hours=80))],  # an hour late, still counted
    ]
    stream = monitors.with_event_time(stream_files(spark, tmp_path, schema, batches), "t")
    out = str(tmp_path / "out")
    daily = monitors.fraud_daily_stream(stream, "t", ["r"], "amount")
    monitors.run_to_files(daily, out, str(tmp_path / "ckpt")).awaitTermination()
    got = bag(spark.read.schema(daily.schema).parquet(out), "flag_date", "flagged_count", "flagged_amount")
    assert got == [(t0.date(), 2, 5), ((t0 + timedelta(days=1)).date(), 1, 2)]


def test_a_hot_account_writes_new_entries_only(spark, tmp_path):
    """Three batches into one group of state: each writes as many entries as it has instants, not
    what the group holds."""
    t0 = datetime(2024, 1, 1)
    rows = [(i, "hot", t0 + timedelta(seconds=2 * i)) for i in range(1500)]
    schema = "id int, k string, t timestamp_ntz"
    batches = [rows[:1000], rows[1000:1400], rows[1400:]]
    stream = monitors.with_event_time(stream_files(spark, tmp_path, schema, batches), "t")
    out = str(tmp_path / "out")
    q = monitors.run_to_files(monitors.rapid_fire_stream(stream, "k", "t"), out, str(tmp_path / "ckpt"))
    q.awaitTermination()
    # Every row stands in its own bucket and in the next one's window.
    updated = [p.stateOperators[0].numRowsUpdated for p in q.recentProgress if p.numInputRows]
    assert len(updated) == 3 and updated[1] <= 2 * 400 + 10 and updated[2] <= 2 * 100 + 10
    got = monitors.final_counts(spark.read.parquet(out), "k", "t").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert bag(got) == bag(burst_counts(frame(spark, schema, *rows), "k", "t"))


def test_late_rows_are_kept_and_spare_the_stateful_step(spark, tmp_path):
    schema = "id int, t timestamp_ntz"
    t0 = datetime(2024, 1, 10)
    hour = timedelta(hours=1)
    batches = [[(1, t0), (2, None)], [(3, t0 - 24 * hour), (4, t0 - 23 * hour), (5, t0 + 30 * hour)], [(6, t0 + 6 * hour), (7, t0 + 7 * hour), (8, None)]]
    stream = stream_files(spark, tmp_path, schema, batches)
    path = str(tmp_path / "split")
    late.split_late(stream, "t", path, str(tmp_path / "ckpt")).awaitTermination()
    assert bag(late.late_rows(spark, path, schema), "id") == [(3,), (6,)]
    on_time = spark.read.schema(schema).option("basePath", path + "/batches").parquet(path + "/batches").filter("not cast(late as boolean)")
    assert bag(on_time, "id") == [(1,), (2,), (4,), (5,), (7,), (8,)]
    assert bag(spark.read.parquet(path + "/marks"), "batch", "mark") == [(0, t0 - 24 * hour), (1, t0 + 6 * hour), (2, t0 - 17 * hour)]
    log = str(tmp_path / "log")
    timed = monitors.with_event_time(late.on_time_rows(spark, path, schema), "t")
    with monitors.progress_log(spark, log):
        monitors.run_to_files(monitors.dedup_within_watermark(timed, ["id"]), str(tmp_path / "out"), str(tmp_path / "ckpt2")).awaitTermination()
    assert spark.read.parquet(log).agg(F.sum("late_rows")).first()[0] == 0
    assert late.state_keys(spark, str(tmp_path / "ckpt2")).agg(F.sum("n_keys")).first()[0] >= 3


def test_groups_of_rapid_fire_state_do_not_grow_with_the_keys(spark, tmp_path):
    schema = "id int, k string, t timestamp_ntz"
    rows = [(i, f"k{i}", datetime(2024, 1, 1, 0, 30)) for i in range(600)]
    stream = monitors.with_event_time(stream_files(spark, tmp_path, schema, [rows]), "t")
    q = monitors.run_to_files(monitors.rapid_fire_stream(stream, "k", "t", shares=4), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    # Two buckets of time for each of four shares, with a timer each.
    assert max(p.stateOperators[0].numRowsTotal for p in q.recentProgress) < 100
    assert spark.read.parquet(str(tmp_path / "out")).filter("txn_count = 1").count() == 600


def test_waves_of_events_are_written_by_many_tasks_and_taken_in_one_batch_each(spark, tmp_path):
    from bankspark.checks import streams
    from bankspark.streaming import late

    class Bank:
        def __init__(self):
            self.spark = spark

        def table(self, name):
            n = F.col("id")
            ts = F.timestamp_seconds(F.lit(1_700_000_000) + n * 60).cast("timestamp_ntz")
            return spark.range(0, 10_000, 1, 4).select(n.alias("event_id"), (n % 7).alias("user_id"), ts.alias("ts"))

    home, batches = str(tmp_path), []
    for stream in streams._waves_of_events(Bank(), home):
        q = late.split_late(stream, "ts", home + "/out", home + "/ckpt")
        q.awaitTermination()
        batches.append(sum(p.numInputRows > 0 for p in q.recentProgress))
    assert batches == [1, 1, 1]
    assert len(list((tmp_path / "landing" / "a").glob("part-*.parquet"))) == 4
    got = late.late_rows(spark, home + "/out", stream.schema)
    assert got.count() == sum(n % 10 == 0 and n <= 9999 - 1440 for n in range(10_000))


def test_a_batch_alone_is_not_joined_with_its_own_keys(spark, tmp_path):
    sink = cdc.open_sink(spark, str(tmp_path / "sink"), buckets=2)
    kinds = {f.name: f.dataType for f in cdc.SINK_SCHEMA}
    values = {"cdc_operation": F.lit("INSERT"), "amount": F.lit(1)}
    keys = spark.createDataFrame([("a",), ("b",), (None,)], "transaction_sk string")
    changes = keys.select(*[
        (F.col(c) if c == "transaction_sk" else values.get(c, F.lit(None))).cast(kinds[c]).alias(c)
        for c in cdc.SINK_COLS if c != "ingested_at"])
    sink.append(changes, 0, lit_ts(datetime(2024, 1, 1)))
    applied = sink.applied(0)
    assert sorted(r["transaction_sk"] for r in applied.collect()) == ["a", "b"]
    assert applied._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 1  # the base
    sink.append(changes, 1, lit_ts(datetime(2024, 1, 1)))
    assert sink.applied(1).count() == 0
