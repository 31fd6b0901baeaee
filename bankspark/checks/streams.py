"""Queries that run a stream over the events feed to its end and return what it wrote."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from bankspark.checks.context import Bank, query
from bankspark.checks.sql import dbl
from bankspark.functions.dates import lit_ts
from bankspark.functions.rules import suspicion_reason
from bankspark.session import work_dir
from bankspark.sources import standin
from bankspark.streaming import cdc, late, monitors


def _waves(b: Bank) -> list[DataFrame]:
    """Two waves of change records: every payment arrives, then every payment is changed, in
    a way that depends on its number (updated, deleted, inserted again, soft-deleted, or a
    payment nobody knows is updated)."""
    first = standin.stream_payments(b.table("events")).withColumns(
        {
            "_synced": F.expr("timestampadd(SECOND, 1, transaction_timestamp)"),
            "_deleted": F.lit(False),
            "action": F.lit("INSERT"),
            "is_update": F.lit(False),
        }
    )
    n = F.substr("transaction_id", F.lit(2)).cast("bigint")
    image = (
        first.withColumn("_n", n)
        .withColumn("kind", F.col("_n") % 6)
        .withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
        .withColumn("account_id", F.lit("MOVED"))
        .withColumn("_synced", F.expr("timestampadd(SECOND, 2, transaction_timestamp)"))
        .withColumn(
            "transaction_status",
            F.when(F.col("_n") % 12 == 0, "blocked").otherwise(F.col("transaction_status")),
        )
        .withColumn(
            "transaction_id",
            F.when(F.col("kind") >= 4, F.concat(F.lit("X"), "transaction_id")).otherwise(F.col("transaction_id")),
        )
        .withColumn("_deleted", F.col("kind") == 3)
        .withColumn("is_update", F.col("kind").isin(0, 3, 4, 5))
        .withColumn(
            "action",
            F.explode(
                F.when(F.col("kind") == 1, F.array(F.lit("DELETE")))
                .when(F.col("kind") == 2, F.array(F.lit("INSERT")))
                .otherwise(F.array(F.lit("DELETE"), F.lit("INSERT")))
            ),
        )
        .drop("_n", "kind")
    )
    return [first, image]


def _run_cdc(b: Bank, flags: bool = False) -> DataFrame:
    """Both waves through the change path, the first folded into the base before the second comes.
    Returns the sink, or the log of flags that follow it."""
    home = work_dir(b.spark, "cdc")
    landing, sink, log, ckpt, flag_ckpt = (os.path.join(home, d) for d in ("landing", "sink", "log", "ckpt", "flag_ckpt"))
    now = lit_ts(standin.EVENTS.as_of)
    for wave in _waves(b):
        wave.write.mode("append").parquet(landing)
        records = b.spark.readStream.schema(wave.schema).parquet(landing)
        cdc.open_sink(b.spark, sink).fold()
        cdc.start_cdc(records, sink, ckpt, standin.EVENTS, now, buckets=_BUCKETS, available_now=True).awaitTermination()
        if flags:
            cdc.start_flags(b.spark, sink, log, flag_ckpt, standin.EVENTS, now, available_now=True).awaitTermination()
    return b.spark.read.parquet(log) if flags else cdc.open_sink(b.spark, sink).rows()


_BUCKETS = 16  # a file each in these small tables


_UPDATED = "event_id % 6 = 0"
_SINK = f"""
  SELECT transaction_id, account_id, transaction_type,
    CASE WHEN {_UPDATED} THEN CAST(amount + 1 AS DECIMAL(18, 2)) ELSE amount END AS amount, currency, merchant_category,
    transaction_timestamp, CASE WHEN event_id % 12 = 0 THEN 'BLOCKED' ELSE transaction_status END AS transaction_status,
    transaction_timestamp + CASE WHEN {_UPDATED} THEN INTERVAL 2 SECOND ELSE INTERVAL 1 SECOND END AS loaded_at,
    CASE WHEN {_UPDATED} THEN 'UPDATE' ELSE 'INSERT' END AS cdc_operation, event_id
  FROM payments WHERE event_id % 6 NOT IN (1, 3)"""


def _reason(amount: str, status: str) -> str:
    return (
        f"CASE WHEN {status} = 'BLOCKED' THEN 'STATUS_BLOCKED' WHEN {amount} >= 50000 AND {amount} % 1000 = 0"
        f" THEN 'ROUND_NUMBER_HIGH_VALUE' WHEN {amount} >= 25000 THEN 'HIGH_VALUE' END"
    )


@query("cdc_stream", "SELECT * EXCLUDE (event_id) REPLACE (CAST(amount AS DOUBLE) AS amount) FROM sink", sink=_SINK)
def _(b: Bank):
    return _run_cdc(b).drop("transaction_sk", "transaction_date", "ingested_at")


@query("suspicious_stream", f"""
  SELECT transaction_id, account_id, CAST(amount AS DOUBLE) AS amount, currency, flag_reason FROM (
    SELECT *, {_reason('amount', 'transaction_status')} AS flag_reason FROM payments) WHERE flag_reason IS NOT NULL
  UNION ALL SELECT transaction_id, account_id, CAST(amount AS DOUBLE), currency, flag_reason FROM (
    SELECT s.*, {_reason('s.amount', 's.transaction_status')} AS flag_reason, {_reason('p.amount', 'p.transaction_status')} AS before
    FROM sink s JOIN payments p USING (transaction_id) WHERE s.cdc_operation = 'UPDATE')
  WHERE flag_reason IS NOT NULL AND before IS NULL""", sink=_SINK)
def _(b: Bank):
    return _run_cdc(b, flags=True).drop("transaction_sk", "flagged_at")


def _events(b: Bank) -> DataFrame:
    """The events file as a stream."""
    return (
        b.spark.readStream.schema(b.table("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(b.dir)
    )


def _drain(b: Bank, stream: DataFrame, name: str) -> DataFrame:
    home = work_dir(b.spark, name)
    out = os.path.join(home, "out")
    monitors.run_to_files(stream, out, os.path.join(home, "ckpt")).awaitTermination()
    return b.spark.read.schema(stream.schema).parquet(out)


@query("rapid_fire_stream", """
  SELECT DISTINCT user_id, CAST(ts AS TIMESTAMP) AS ts, count(*) OVER (PARTITION BY user_id ORDER BY ts
    RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND CURRENT ROW) AS txn_count FROM events""")
def _(b: Bank):
    timed = monitors.with_event_time(_events(b).select("user_id", "ts"), "ts")
    emitted = _drain(b, monitors.rapid_fire_stream(timed, "user_id", "ts"), "rapid")
    return monitors.final_counts(emitted, "user_id", "ts").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("fraud_daily_stream", f"""
  SELECT CAST(transaction_timestamp AS DATE) AS flag_date, currency, count(*) AS flagged_count, {dbl('sum(amount)')} AS flagged_amount
  FROM payments WHERE transaction_status = 'BLOCKED' OR amount >= 25000 GROUP BY 1, 2""")
def _(b: Bank):
    """Days the stream has closed and those still open."""
    def flags(events: DataFrame) -> DataFrame:
        payments = standin.stream_payments(events)
        reason = suspicion_reason(F.col("transaction_status"), F.col("amount"), standin.EVENTS)
        return payments.filter(reason.isNotNull())

    timed = monitors.with_event_time(flags(_events(b)), "transaction_timestamp")
    how = ("transaction_timestamp", ["currency"], "amount")
    closed = _drain(b, monitors.fraud_daily_stream(timed, *how), "daily")
    return monitors.with_open_days(closed, flags(b.table("events")), *how)


@query("dedup_watermark", "SELECT event_id, user_id, event_type FROM events")
def _(b: Bank):
    twice = _events(b).withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    timed = monitors.with_event_time(twice, "ts")
    unique = monitors.dedup_within_watermark(timed, ["event_id"]).select("event_id", "user_id", "event_type")
    return _drain(b, unique, "dedup")


_LATE = """SELECT * FROM events WHERE event_id % 10 = 0 AND ts <= (SELECT max(ts) FROM events WHERE event_id % 10 <> 0) - INTERVAL 24 HOUR"""


def _waves_of_events(b: Bank, home: str) -> Iterator[DataFrame]:
    """Nine tenths of the events, then the newest of the last tenth, then the rest: the same stream each
    time, after one more of them has come. What follows it takes a wave in one micro-batch, whatever
    the number of its files."""
    events = b.table("events").select("event_id", "user_id", "ts")
    landing = os.path.join(home, "landing")
    newest = events.filter("event_id % 10 <> 0").agg(F.max("ts") - F.expr("interval 1 day")).scalar()
    tenth = F.col("event_id") % 10 == 0
    for name, part in (("a", ~tenth), ("b", tenth & (F.col("ts") > newest)), ("c", tenth & (F.col("ts") <= newest))):
        events.filter(part).write.parquet(os.path.join(landing, name))
        yield b.spark.readStream.schema(events.schema).parquet(os.path.join(landing, "*"))


@query("late_rows", "SELECT event_id, user_id, ts FROM late", late=_LATE)
def _(b: Bank):
    """The rows that came too late, kept."""
    home = work_dir(b.spark, "late")
    for stream in _waves_of_events(b, home):
        late.split_late(stream, "ts", os.path.join(home, "out"), os.path.join(home, "ckpt")).awaitTermination()
    return late.late_rows(b.spark, os.path.join(home, "out"), stream.schema).select("event_id", "user_id", "ts")


@query("late_rows_logged", """
  SELECT (SELECT count(*) FROM late) AS late_rows, (SELECT count(*) FROM events) - (SELECT count(*) FROM late) AS unique_rows, CAST(0 AS BIGINT) AS late_after_split""", late=_LATE)
def _(b: Bank):
    """What the progress log counts for a stateful step on the same stream, and for one behind the split."""
    home = work_dir(b.spark, "late_logged")
    at = lambda *names: os.path.join(home, *names)
    counted = {}

    def follow(rows: DataFrame, name: str) -> None:
        unique = monitors.dedup_within_watermark(monitors.with_event_time(rows, "ts"), ["event_id"])
        with monitors.progress_log(b.spark, at(f"{name}_log")):
            monitors.run_to_files(unique, at(name), at(f"{name}_ckpt")).awaitTermination()

    for stream in _waves_of_events(b, home):
        late.split_late(stream, "ts", at("out"), at("split_ckpt")).awaitTermination()
        follow(stream, "late_rows")
    follow(late.on_time_rows(b.spark, at("out"), stream.schema), "late_after_split")
    for name in ("late_rows", "late_after_split"):
        counted[name] = b.spark.read.parquet(at(f"{name}_log")).agg(F.sum("late_rows").alias(name))
        counted["unique_rows"] = b.spark.read.parquet(at(name)).agg(F.count(F.lit(1)).alias("unique_rows"))
    names = ("late_rows", "unique_rows", "late_after_split")
    return b.spark.range(1).select(*[counted[n].select(n).scalar().alias(n) for n in names])


@query("stream_state_keys", "SELECT count(*) AS n_keys FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 48 HOUR")
def _(b: Bank):
    """The events that a deduplication still remembers, from its state store: those not a delay older
    than the watermark."""
    home = work_dir(b.spark, "state")
    timed = monitors.with_event_time(_events(b).select("event_id", "ts"), "ts")
    ckpt = os.path.join(home, "ckpt")
    monitors.run_to_files(monitors.dedup_within_watermark(timed, ["event_id"]), os.path.join(home, "out"), ckpt).awaitTermination()
    return late.state_keys(b.spark, ckpt).agg(F.sum("n_keys").alias("n_keys"))


_BATCHES = 110  # more than a query itself remembers


@query("stream_progress", f"SELECT {_BATCHES} AS batches, count(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows FROM events")
def _(b: Bank):
    """The events in many files, one micro-batch each."""
    home = work_dir(b.spark, "progress")
    landing, log = os.path.join(home, "landing"), os.path.join(home, "log")
    events = b.table("events").select("event_id", "ts")
    part = F.pmod("event_id", F.lit(_BATCHES)).alias("part")
    events.select("*", part).repartition(8, "part").write.partitionBy("part").parquet(landing)
    with monitors.progress_log(b.spark, log, "audit", every=50):
        stream = b.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(landing, "*"))
        q = stream.writeStream.queryName("audit").format("noop").option("checkpointLocation", os.path.join(home, "ckpt")).trigger(availableNow=True).start()
        q.awaitTermination()
    return b.spark.read.parquet(log).filter("input_rows > 0").agg(
        F.count(F.lit(1)).cast("int").alias("batches"), F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))
