"""Continuous monitors over a transaction stream."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from bankspark.functions.dates import epoch_micros
from bankspark.operators.bursts import MICROS_PER_MINUTE
from bankspark.sources.sinks import append_log


def with_event_time(df: DataFrame, ts: str, delay: str = "24 hours") -> DataFrame:
    """Event time as a zoned timestamp (session time zone UTC) with a watermark: rows later
    than `delay` are dropped by stateful steps; `ProgressLog` counts them per batch."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def dedup_within_watermark(df: DataFrame, keys: list[str]) -> DataFrame:
    """The first row per key; repeats that arrive within the watermark delay are dropped."""
    return df.dropDuplicatesWithinWatermark(keys)


class _Bursts(StatefulProcessor):
    """A share of the keys and a bucket of time: how many rows each (key, instant) has.

    A batch appends its own counts per (key, instant), in one call; totals are worked out from all
    entries, which are those of the bucket and of one window before it.
    """

    def __init__(self, window_us: int, width_us: int):
        self.window_us, self.width_us = window_us, width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "k string, us long, n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        bucket = int(key[1])
        held = list(zip(*self.rows.get()))
        if not held:
            self.handle.registerTimer((bucket + 1) * self.width_us // 1000)
        old_k, old_us, old_n = held or ((), (), ())
        parts = [(p["k"].to_numpy(object), p["us"].to_numpy(np.int64)) for p in rows]
        names = np.concatenate([*[k for k, _ in parts], np.array(old_k, object)])
        us = np.concatenate([*[t for _, t in parts], np.array(old_us, np.int64)])
        fresh = len(us) - len(old_us)
        code, known_names = pd.factorize(names)
        # One number per (key, instant); a key's last instant is more than a window ahead of the next key.
        low = us.min()
        span = us.max() - low + self.window_us + 1
        at, place = np.unique(code * span + (us - low), return_inverse=True)
        code, us = at // span, at % span + low
        added = np.bincount(place[:fresh], minlength=len(at))
        before = np.bincount(place[fresh:], weights=np.array(old_n, np.int64), minlength=len(at)).astype(np.int64)
        new = np.nonzero(added)[0]
        self.rows.appendList(list(zip(known_names[code[new]].tolist(), us[new].tolist(), added[new].tolist())))
        first = np.searchsorted(at, at - self.window_us, side="left")

        def counts(n: np.ndarray) -> np.ndarray:
            running = np.concatenate([[0], np.cumsum(n)])
            return running[1:] - running[first]

        now = counts(added + before)
        known = np.where(before > 0, counts(before), 0)
        news = (now != known) & (us // self.width_us == bucket)
        if news.any():
            yield pd.DataFrame({"k": known_names[code[news]], "us": us[news], "c": now[news]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.rows.clear()
        return iter([])

    def close(self) -> None:
        pass


def rapid_fire_stream(
    df: DataFrame, key: str, ts: str, minutes: int = 60, bucket_windows: int = 1, shares: int = 64
) -> DataFrame:
    """(key, ts, txn_count) for each instant whose 60-minute count is new or has grown.

    A late row raises the counts of instants after it, which are then emitted again; the
    final count of an instant is the largest one emitted.

    State is kept per share of the keys (`shares`, by hash) and time bucket: the rows per key and instant
    of the bucket and of the window before it. So a group holds at most `bucket_windows` + 1 windows,
    however hot a key or long its history, and the number of groups does not grow with that of the
    keys; a batch writes the instants it has rows for and no others, and a timer clears the group
    when the watermark passes the bucket's end. Take more shares where a window has more rows than
    a group should hold.
    """
    window_us = minutes * MICROS_PER_MINUTE
    width_us = window_us * bucket_windows
    us = epoch_micros(F.col(ts))
    own, last = F.floor(us / width_us), F.floor((us + window_us) / width_us)
    text = F.col(key).cast("string")
    # A leading mark tells a missing key from an empty one.
    placed = df.select(
        ts,
        F.when(text.isNull(), "").otherwise(F.concat(F.lit("="), text)).alias("k"),
        us.alias("us"),
        F.pmod(F.xxhash64(text), F.lit(shares)).alias("_share"),
        F.explode(F.array_distinct(F.array(own, last))).alias("_bucket"),
    )
    emitted = placed.groupBy("_share", "_bucket").transformWithStateInPandas(
        _Bursts(window_us, width_us), "k string, us long, c long", "append", "EventTime")
    return emitted.select(
        F.when(F.col("k") != "", F.substr("k", F.lit(2))).cast(df.schema[key].dataType).alias(key),
        F.timestamp_micros("us").alias(ts),
        F.col("c").alias("txn_count"),
    )


def final_counts(emitted: DataFrame, key: str, ts: str) -> DataFrame:
    """The last word on each instant from everything rapid_fire_stream emitted."""
    return emitted.groupBy(key, ts).agg(F.max("txn_count").alias("txn_count"))


def daily_flags(flags: DataFrame, day: Column, by: list[str], amount: str) -> DataFrame:
    return flags.groupBy(day, *by).agg(
        F.count(F.lit(1)).alias("flagged_count"), F.sum(amount).alias("flagged_amount")
    )


def fraud_daily_stream(flags: DataFrame, ts: str, by: list[str], amount: str) -> DataFrame:
    """Daily roll-up, each day emitted once, when the watermark has passed its end. The days that
    are still open are `with_open_days`."""
    rolled = daily_flags(flags, F.window(ts, "1 day").alias("w"), by, amount)
    return rolled.select(F.col("w.start").cast("date").alias("flag_date"), *by, "flagged_count", "flagged_amount")


def with_open_days(closed: DataFrame, flags: DataFrame, ts: str, by: list[str], amount: str) -> DataFrame:
    """The roll-up of all days: what the stream has closed, and the later days from the flags so
    far. Days close in order, so one date tells them apart, and only open days are read again."""
    last = closed.agg(F.max("flag_date")).first()[0]  # one value
    day = F.col(ts).cast("date")
    still = flags if last is None else flags.filter(day > F.lit(last))
    return closed.unionByName(daily_flags(still, day.alias("flag_date"), by, amount))


def run_to_files(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream's rows to parquet files, exactly once."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


PROGRESS = (
    "query_name string, batch_id long, started_at string, input_rows long, late_rows long, "
    "batch_duration_ms long, sources string"
)


class ProgressLog(StreamingQueryListener):
    """Appends a row for every micro-batch of a session's streams, with the rows read, the rows that
    came too late for the watermark and were dropped, and the source offsets.

    Rows are written `every` so many batches and when a query ends; a crash can cost the last ones.
    Add it with `spark.streams.addListener`. `name` limits it to one query.
    """

    def __init__(self, spark: SparkSession, path: str, name: str | None = None, every: int = 1):
        self.spark, self.path, self.name, self.every = spark, path, name, every
        self.rows: list[tuple] = []
        self.ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.name is not None and p.name != self.name:
            return
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.rows.append((
            p.name, p.batchId, p.timestamp, p.numInputRows, late, p.batchDuration,
            json.dumps([{"start": s.startOffset, "end": s.endOffset} for s in p.sources]),
        ))
        if len(self.rows) >= self.every:
            self.write()

    def onQueryTerminated(self, event) -> None:
        self.write()
        self.ended.set()

    def write(self) -> None:
        rows, self.rows = self.rows, []
        if rows:
            append_log(self.spark.createDataFrame(rows, PROGRESS), self.path)


@contextmanager
def progress_log(spark: SparkSession, path: str, name: str | None = None, every: int = 1) -> Iterator[ProgressLog]:
    """Log the streams that run inside the block, to the last batch of the first that ends."""
    log = ProgressLog(spark, path, name, every)
    spark.streams.addListener(log)
    try:
        yield log
        log.ended.wait(60)
    finally:
        spark.streams.removeListener(log)
        log.write()
