"""Writing tables: full refresh, append-only logs, date-clustered tables, merges in place."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.errors import AnalysisException

from bankspark.functions.dates import lit_ts
from bankspark.operators.changes import merge_by_key, sync_columns
from bankspark.operators.history import snapshot_check, start_history
from bankspark.schemas import DELETED, SYNCED
from bankspark.session import work_dir

PART = "date_part"


def materialize(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Full refresh: write the table and hand back the written rows. An existing table stays in
    place until the new one is complete."""
    return replace_table(df, os.path.join(folder, name))


def reload(df: DataFrame, path: str) -> None:
    """Replace a table by a fresh load; repeating it changes nothing."""
    df.write.mode("overwrite").parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    if "*" not in path and not _fs(spark, path).exists(_path(spark, path)):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        # A folder without files yet, or a pattern nothing matches. Anything else is an error:
        # taken for a missing table it would be overwritten.
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def sync(
    target: DataFrame | None, incoming: DataFrame, mode: str, key: str, synced_at: datetime
) -> DataFrame:
    """State of a raw table after one sync.

    `reimport`: the incoming rows. `upsert`: incoming rows replace or join the target by key.
    `soft_delete`: as upsert, and target rows the source no longer has are marked deleted.
    """
    fresh = incoming.withColumn(SYNCED, lit_ts(synced_at)).withColumn(DELETED, F.lit(False))
    if mode == "reimport" or target is None:
        return fresh
    if mode == "upsert":
        return merge_by_key(target, fresh, key)
    if mode == "soft_delete":
        gone = sync_columns(target, fresh).join(fresh.select(key), key, "left_anti")
        newly = ~F.coalesce(F.col(DELETED), F.lit(False))
        gone = gone.withColumn(
            SYNCED, F.when(newly, lit_ts(synced_at)).otherwise(F.col(SYNCED))
        ).withColumn(DELETED, F.lit(True))
        return fresh.unionByName(gone)
    raise ValueError(f"unknown sync mode {mode}")


def part_label(date_col: str, grain: str) -> Column:
    """Partition label; the leading letter keeps it a string when folders are listed."""
    pattern = "'d'yyyy-MM-dd" if grain == "day" else "'m'yyyy-MM"
    return F.coalesce(F.date_format(date_col, pattern), F.lit("none"))


def _clustered(df: DataFrame, date_col: str, grain: str) -> DataFrame:
    """Rows gathered by partition and sorted by date. The rebalance hint lets AQE size the
    writing tasks by the data: small partitions share a task, a large or hot one is split."""
    return (
        df.withColumn(PART, part_label(date_col, grain))
        .hint("rebalance", F.col(PART))
        .sortWithinPartitions(PART, date_col)
    )


def write_clustered(df: DataFrame, path: str, date_col: str, grain: str = "month") -> None:
    """Table partitioned by month or day and sorted by date inside its files, so that date
    filters skip partitions and row groups. Take `day` where a month is terabytes."""
    _clustered(df, date_col, grain).write.mode("overwrite").partitionBy(PART).parquet(path)


def stored_grain(spark: SparkSession, path: str) -> str | None:
    """`day` or `month` as the folders of a clustered table tell; None if they do not."""
    for status in _fs(spark, path).listStatus(_path(spark, path)):
        label = status.getPath().getName().removeprefix(f"{PART}=")
        if label != status.getPath().getName() and label[0] in "dm" and label != "none":
            return {"d": "day", "m": "month"}[label[0]]
    return None


def rewrite_partitions(
    spark: SparkSession, path: str, date_col: str, key: str, grain: str,
    affected_keys: DataFrame, incoming: DataFrame,
    merge: Callable[[DataFrame, DataFrame], DataFrame], before: Callable[[list[str]], None] | None = None,
) -> list[str]:
    """Apply `merge(target, incoming)` to the partitions it can touch and leave the others;
    returns the touched partitions, and tells `before` ahead of writing them. One writer at a time.

    Touched are the partitions of the incoming rows and those that hold one of
    `affected_keys`; that lookup reads only the key and partition columns. The new partitions
    are written beside the table and moved in when complete, so a lost executor costs its
    tasks, and an interrupted move is finished by the next merge. A table keeps the grain it was
    written with; `grain` counts for a table without dated partitions.
    """
    finish_move(spark, path)
    grain = stored_grain(spark, path) or grain
    target = spark.read.parquet(path)
    holds = target.select(key, PART).join(affected_keys.select(key), key, "left_semi").select(PART)
    arriving = incoming.select(part_label(date_col, grain).alias(PART))
    # One value per touched month or day.
    touched = [r[0] for r in holds.union(arriving).distinct().collect()]
    if not touched:
        return []
    if before is not None:
        before(touched)
    old = target.filter(F.col(PART).isin(*touched)).drop(PART)
    written = Observation()
    pending = path.rstrip("/") + PENDING
    _clustered(merge(old, incoming), date_col, grain).observe(
        written, F.collect_set(PART).alias("parts")
    ).write.partitionBy(PART).parquet(pending)
    fs = _fs(spark, pending)
    for part in set(touched) - set(written.get["parts"]):
        # A partition whose last row left: an empty folder takes its place.
        fs.mkdirs(_path(spark, pending, f"{PART}={part}"))
    fs.create(_path(spark, pending, READY)).close()
    finish_move(spark, path)
    return touched


# New data waits in a folder of this suffix; the marker file says that it is complete.
PENDING, READY = "__pending", "_READY"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path(os.path.join(*parts))


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _rename(fs, source, target) -> None:
    """Move a folder; a file system that only answers no leaves everything where it is."""
    if not fs.rename(source, target):
        raise OSError(f"could not move {source} to {target}; the new data is still at {source}")


def finish_move(spark: SparkSession, path: str) -> None:
    """Move complete pending partitions into the table, or drop incomplete ones.

    Each step can be repeated: a partition still in the pending folder has not been moved.
    """
    path = path.rstrip("/")
    pending = path + PENDING
    fs = _fs(spark, path)
    if not fs.exists(_path(spark, pending)):
        return
    if fs.exists(_path(spark, pending, READY)):
        for status in fs.listStatus(_path(spark, pending)):
            name = status.getPath().getName()
            if not name.startswith(f"{PART}="):
                continue
            fs.delete(_path(spark, path, name), True)
            if len(fs.listStatus(status.getPath())):
                _rename(fs, status.getPath(), _path(spark, path, name))
    fs.delete(_path(spark, pending), True)


def finish_replace(spark: SparkSession, path: str) -> None:
    """Put a complete pending table in place of the table, or drop an incomplete one."""
    path = path.rstrip("/")
    pending = path + PENDING
    fs = _fs(spark, path)
    if not fs.exists(_path(spark, pending)):
        return
    if not fs.exists(_path(spark, pending, READY)):
        fs.delete(_path(spark, pending), True)
        return
    fs.delete(_path(spark, path), True)
    _rename(fs, _path(spark, pending), _path(spark, path))
    fs.delete(_path(spark, path, READY), False)


def publish(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Put a complete table, written elsewhere on the same file system, in place of `path`."""
    finish_replace(spark, path)
    fs = _fs(spark, path)
    fs.mkdirs(_path(spark, path).getParent())
    fs.create(_path(spark, source, READY)).close()
    _rename(fs, _path(spark, source), _path(spark, path.rstrip("/") + PENDING))
    finish_replace(spark, path)
    return spark.read.parquet(path)


def publish_all(spark: SparkSession, pending: str, folder: str) -> list[str]:
    """Put the tables of a folder, all of them complete, in place of those in `folder`; returns their names.

    A mark says that publication has begun. From then on it is only ever finished, by whoever comes
    next (`finish_publication`): no set of tables stays half new, half old.
    """
    fs = _fs(spark, pending)
    for name in folder_names(spark, pending):
        fs.create(_path(spark, pending, f"{READY}={name}")).close()
    fs.create(_path(spark, pending, READY)).close()
    return _move_tables(spark, pending, folder)


def _move_tables(spark: SparkSession, pending: str, folder: str) -> list[str]:
    there = folder_names(spark, pending)
    names = sorted(n.removeprefix(f"{READY}=") for n in there if n.startswith(f"{READY}="))
    for name in names:
        if name in there:
            publish(spark, os.path.join(pending, name), os.path.join(folder, name))
        else:  # it had left for its place
            finish_replace(spark, os.path.join(folder, name))
    discard(spark, pending)
    return names


def finish_publication(spark: SparkSession, folder: str, prefix: str = "_pending-") -> None:
    """Finish a publication that was cut off, and drop what a run left that never began one."""
    for name in folder_names(spark, folder):
        if name.startswith(prefix):
            pending = os.path.join(folder, name)
            if READY in folder_names(spark, pending):
                _move_tables(spark, pending, folder)
            discard(spark, pending)


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Replace a table by rows that may be read from it. The old table stays until the new one
    is complete."""
    spark = df.sparkSession
    finish_replace(spark, path)
    pending = path.rstrip("/") + PENDING
    df.write.mode("overwrite").parquet(pending)
    _fs(spark, path).create(_path(spark, pending, READY)).close()
    finish_replace(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, at = _fs(spark, path), _path(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []


def mark(spark: SparkSession, path: str, name: str) -> None:
    """An empty file in a table's folder, made if it is missing; readers do not see names that begin with `_`."""
    _fs(spark, path).create(_path(spark, path, name)).close()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, for those who resolve a relative one otherwise."""
    return _fs(spark, path).makeQualified(_path(spark, path)).toString()


def newest_partition(spark: SparkSession, path: str) -> str | None:
    """The last month or day of a clustered table, from its folder names."""
    names = [f.getPath().getName() for f in _fs(spark, path).listStatus(_path(spark, path))]
    parts = [n.split("=", 1)[1] for n in names if n.startswith(f"{PART}=") and not n.endswith("=none")]
    return max(parts, default=None)


def newest_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of the last partition: enough to find the newest date of the table."""
    if not _fs(spark, path).exists(_path(spark, path)):
        return None
    part = newest_partition(spark, path)
    return read_parts(spark, path, [] if part is None else [part])


def read_parts(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    """Some partitions of a clustered table."""
    return spark.read.parquet(path).filter(F.col(PART).isin(*parts)).drop(PART)


def read_since(spark: SparkSession, path: str, since: datetime) -> DataFrame:
    """The partitions of a clustered table from a moment's day or month on, and the one of rows
    without a date; the others are not read. Labels sort as their dates do, `none` last."""
    rows = spark.read.parquet(path)
    label = {"day": f"d{since:%Y-%m-%d}", "month": f"m{since:%Y-%m}"}.get(stored_grain(spark, path) or "")
    return (rows if label is None else rows.filter(F.col(PART) >= label)).drop(PART)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote, on whatever file system it is."""
    _fs(spark, path).delete(_path(spark, path), True)


def merge_into_table(
    spark: SparkSession, path: str, updates: DataFrame, key: str, date_col: str,
    grain: str = "month", work: str | None = None, before: Callable[[list[str] | None], None] | None = None,
) -> None:
    """Merge by unique key into a date-clustered table, created if missing. Intermediate rows go
    below `work`, the shared folder if not given, and leave with the call, also if it fails. `before`
    is told which partitions will be written, None for all."""
    finish_move(spark, path)
    if not _fs(spark, path).exists(_path(spark, path)):
        if before is not None:
            before(None)
        write_clustered(updates, path, date_col, grain)
        return
    staged = work_dir(spark, "updates", work)
    updates.write.parquet(staged)
    try:
        updates = spark.read.parquet(staged)
        rewrite_partitions(
            spark, path, date_col, key, grain, updates, updates,
            lambda old, new: merge_by_key(old, new, key), before,
        )
    finally:
        discard(spark, staged)


def advance_snapshot(
    spark: SparkSession, path: str, current: DataFrame, key: str, check_cols: Sequence[str],
    run_ts: datetime, invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """One run of a type-2 snapshot kept as an `open` table and a `closed` folder per run.

    Only the open versions are read and rewritten, so the cost of a run does not grow with the
    history. A run can be repeated, whether it failed or not: versions that it had already
    closed are not closed again.
    """
    open_path = os.path.join(path, "open")
    closed_path = os.path.join(path, "closed", f"r{run_ts:%Y%m%d%H%M%S}")
    finish_replace(spark, open_path)
    opened = read_if_exists(spark, open_path)
    if opened is None:
        return replace_table(start_history(current, run_ts), open_path)
    staged = work_dir(spark, "snapshot")
    snapshot_check(opened, current, key, check_cols, run_ts, invalidate_hard_deletes).write.parquet(staged)
    versions = spark.read.parquet(staged)
    closing = versions.filter(F.col("valid_to").isNotNull())
    done = read_if_exists(spark, closed_path)
    if done is not None:
        closing = closing.join(done.select(key, "valid_from"), [key, "valid_from"], "left_anti")
    closing.select(*versions.columns).write.mode("append").parquet(closed_path)
    replace_table(versions.filter(F.col("valid_to").isNull()), open_path)
    discard(spark, staged)
    return read_snapshot(spark, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """All versions, open and closed."""
    opened = spark.read.parquet(os.path.join(path, "open"))
    closed = read_if_exists(spark, os.path.join(path, "closed", "*"))
    return opened if closed is None else opened.unionByName(closed)


def read_clustered(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path).drop(PART)
    return df.select(*cols) if cols else df
