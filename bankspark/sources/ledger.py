"""Loading files once: a ledger says which file went into which load."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from bankspark.sources.files import land, load
from bankspark.sources.sinks import append_log, read_if_exists

PLANS = "load long, file string, modified timestamp, bytes long"
DONE = "load long, good long, rejected long"


def files_at(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder or pattern: name, time of change, size. None of them is opened."""
    listed = spark.read.format("binaryFile").load(path)
    return listed.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("bytes"))


def load_new(
    spark: SparkSession, path: str, schema: T.StructType, home: str, synced_at: datetime | None = None,
) -> DataFrame:
    """Load the files of `path` that no load has taken yet, and return what was loaded now, a row per load.

    Below `home`: `good` (typed, with the audit columns) and `rejected` (text, with the reason), both by
    load and with the `file` of each row; and the ledger. A load is planned before it writes and
    entered as done after it has written its two folders; one that was cut off is done again, with
    the files it was planned with, so no row is lost or there twice. A file that has changed counts
    as a new one. The names of the new files go through the driver, as they do in any listing.
    """
    plans, done = os.path.join(home, "ledger", "plans"), os.path.join(home, "ledger", "done")
    planned = read_if_exists(spark, plans)
    finished = read_if_exists(spark, done)
    new = files_at(spark, path)
    if planned is not None:
        new = new.join(planned, ["file", "modified", "bytes"], "left_anti")
    rows = new.collect()
    if rows:
        number = 0 if planned is None else planned.agg(F.max("load")).first()[0] + 1
        append_log(spark.createDataFrame([(number, r.file, r.modified, r.bytes) for r in rows], PLANS).coalesce(1), plans)
    planned = read_if_exists(spark, plans)
    if planned is None:
        return spark.createDataFrame([], DONE)
    open_plans = planned if finished is None else planned.join(finished, "load", "left_anti")
    todo = open_plans.groupBy("load").agg(F.collect_list("file").alias("files")).orderBy("load").collect()
    out = []
    for plan in todo:
        good, rejected = load(spark, plan.files, schema, named=True)
        counts = []
        for kind, part in (("good", land(good, synced_at)), ("rejected", rejected)):
            at = os.path.join(home, kind, f"load={plan.load}")
            part.write.mode("overwrite").parquet(at)
            counts.append(spark.read.schema(part.schema).parquet(at).count())
        out.append((plan.load, *counts))
        append_log(spark.createDataFrame(out[-1:], DONE).coalesce(1), done)
    return spark.createDataFrame(out, DONE)
