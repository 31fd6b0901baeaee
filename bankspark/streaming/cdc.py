"""The change-data path: cleanse each micro-batch, store it beside the sink, then flag what it set.

The checkpoint holds the source offsets. A micro-batch that is repeated after a failure
changes nothing: its folder is written again, and the flagger remembers what it has flagged.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from bankspark.config import Params
from bankspark.functions.cleanse import surrogate_key
from bankspark.functions.rules import cdc_operation
from bankspark.operators.changes import latest_change
from bankspark.plans.fraud import flag_suspicious
from bankspark.plans.staging import cleanse_transactions
from bankspark.schemas import DELETED
from bankspark.sources.change_sink import BUCKETS, ChangeSink

KEY, DAY = "transaction_sk", "transaction_date"
_TEXT, _TIME = T.StringType(), T.TimestampNTZType()
SINK_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in (
    ("transaction_sk", _TEXT), ("transaction_id", _TEXT), ("account_id", _TEXT), ("transaction_type", _TEXT),
    ("amount", T.DecimalType(18, 2)), ("currency", _TEXT), ("merchant_category", _TEXT), ("transaction_timestamp", _TIME),
    ("transaction_date", T.DateType()), ("transaction_status", _TEXT), ("loaded_at", _TIME), ("cdc_operation", _TEXT),
    ("ingested_at", _TIME),
)])
SINK_COLS = tuple(SINK_SCHEMA.fieldNames())
APPLIED = "applied"


def changes_per_key(records: DataFrame) -> DataFrame:
    """One cleansed change per transaction from raw change records.

    A soft-deleted image counts as a DELETE. Of the two halves of an update the new image wins.
    """
    soft = F.coalesce(F.col(DELETED), F.lit(False))
    usable = records.dropna(subset=["transaction_id", "amount"]).select(
        "*",
        F.when(soft, "DELETE").otherwise(F.col("action")).alias("_action"),
        (F.col("is_update") & ~soft).alias("_is_update"),
    )
    cleansed = cleanse_transactions(usable, extra=("_action", "_is_update"))
    newest = latest_change(cleansed, "transaction_id", "loaded_at", "_action")
    return newest.select(
        surrogate_key(F.col("transaction_id")).alias(KEY),
        *[c for c in SINK_COLS if c not in (KEY, "cdc_operation", "ingested_at")],
        cdc_operation(F.col("_action"), F.col("_is_update")).alias("cdc_operation"),
    )


def open_sink(spark: SparkSession, path: str, grain: str = "month", buckets: int = BUCKETS) -> ChangeSink:
    return ChangeSink(spark, path, KEY, DAY, SINK_SCHEMA, grain=grain, buckets=buckets)


def take_batch(sink: ChangeSink, changes: DataFrame, seq: int, now: Column) -> None:
    """Store one batch of prepared changes, and the rows it added or updated for whoever follows them."""
    sink.append(changes, seq, now)
    sink.applied(seq).write.mode("overwrite").parquet(os.path.join(sink.path, APPLIED, f"seq={seq}"))


def start_cdc(
    records: DataFrame, path: str, checkpoint: str, p: Params, now: Column | None = None,
    grain: str = "month", buckets: int = BUCKETS, available_now: bool = False,
) -> StreamingQuery:
    """Take in a streaming frame of change records, every `p.cdc_interval_minutes`, or once over
    what is there. Empty batches leave no trace."""
    sink = open_sink(records.sparkSession, path, grain, buckets)
    first = sink.first_seq(checkpoint)
    stamp = F.current_timestamp() if now is None else now

    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            take_batch(sink, changes_per_key(batch), first + batch_id, stamp)

    writer = records.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{p.cdc_interval_minutes} minutes").start()


def flagged_once(applied: DataFrame, p: Params, flagged_at: Column | None = None) -> DataFrame:
    """New rows for the suspicious-transaction log from a stream of rows that were added or updated.

    What has been flagged is state: a key, and when it may be forgotten, `p.flag_memory_days` after
    it was flagged. So neither the log nor the sink is read, the state holds suspicious keys only, and
    a row that comes again, in a repeated batch or changed once more, is not flagged again.
    """
    stamp = F.current_timestamp().cast("timestamp_ntz") if flagged_at is None else flagged_at
    timed = applied.withColumn("_at", F.col("ingested_at").cast("timestamp"))
    timed = timed.withWatermark("_at", f"{p.flag_memory_days} days")
    hits = flag_suspicious(timed, None, p, stamp, "_at")
    return hits.dropDuplicatesWithinWatermark([KEY]).drop("_at")


def start_flags(
    spark: SparkSession, path: str, log: str, checkpoint: str, p: Params, now: Column | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Follow a sink: flag the suspicious rows among those its batches set and append them to the log,
    each key once. Starts after the sink's first batch."""
    applied = spark.readStream.schema(SINK_SCHEMA).option("recursiveFileLookup", "true").parquet(os.path.join(path, APPLIED))
    writer = (
        flagged_once(applied, p, now).writeStream.format("parquet").outputMode("append")
        .option("path", log).option("checkpointLocation", checkpoint)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{p.cdc_interval_minutes} minutes").start()
