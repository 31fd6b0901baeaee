"""Rows that come too late for the watermark, kept, and a look at what the state of a stream holds."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from bankspark.sources.sinks import append_log, read_if_exists


def split_late(
    df: DataFrame, ts: str, path: str, checkpoint: str, delay: str = "24 hours", available_now: bool = True
) -> StreamingQuery:
    """Store a stream's rows below `path`, apart by whether they are late: at or before the newest time
    of all earlier batches less `delay`. A stateful step with that watermark drops them, at once or,
    where batches follow each other closely, from the next batch on. Rows without a time are never
    late.

    Such a step should read `on_time_rows`, and loses none of them; `late_rows` is what it would have
    lost. A batch that is repeated is judged by the same mark and writes its folder again.
    """
    spark = df.sparkSession
    batches, marks = os.path.join(path, "batches"), os.path.join(path, "marks")

    def mark_before(batch_id: int):
        kept = read_if_exists(spark, marks)
        return None if kept is None else kept.filter(F.col("batch") < batch_id).agg(F.max("mark")).first()[0]

    def each(batch: DataFrame, batch_id: int) -> None:
        mark, seen = mark_before(batch_id), Observation()
        at = F.col(ts).cast("timestamp")
        # Watermarks are kept in milliseconds.
        late = F.lit(False) if mark is None else F.coalesce(F.date_trunc("millisecond", at) <= F.lit(mark), F.lit(False))
        (batch.withColumn("late", late).observe(seen, F.date_trunc("millisecond", F.max(at)).alias("newest"))
         .write.mode("overwrite").partitionBy("late").parquet(os.path.join(batches, f"batch={batch_id}")))
        newest = seen.get["newest"]
        if newest is not None:
            row = spark.createDataFrame([(batch_id, newest)], "batch long, newest timestamp")
            reached = row.select("batch", (F.col("newest") - F.expr(f"interval {delay}")).alias("mark"))
            append_log(reached.coalesce(1), marks)

    writer = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def late_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """Everything that came too late so far, with the batch it came in."""
    base = os.path.join(path, "batches")
    return spark.read.schema(schema).option("basePath", base).parquet(base).filter(F.col("late").cast("boolean")).drop("late")


def on_time_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """The other rows, as a stream."""
    return spark.readStream.schema(schema).parquet(os.path.join(path, "batches", "batch=*", "late=false"))


def state_keys(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What a stopped or running stream remembers, from the state store of its checkpoint: the keys
    held per partition of the state."""
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return state.groupBy("partition_id").agg(F.count(F.lit(1)).alias("n_keys"))
