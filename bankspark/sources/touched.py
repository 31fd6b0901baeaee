"""Which partitions of a clustered table have been written, for those who keep something per partition."""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from bankspark.sources.sinks import PART, append_log, discard, finish_replace, folder_names, read_if_exists, replace_table

ALL = "*"
FEW_FILES = 200  # of a log, before it is written anew


class Touched:
    """The partitions of one table that each of its followers has yet to look at.

    A writer marks what it is about to write, so a failure in between costs a follower some work and no
    change; a follower says how far it came once its own result stands. Two short logs below `path`.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.marks, self.done = spark, os.path.join(path, "marks"), os.path.join(path, "done")
        for log in (self.marks, self.done):
            finish_replace(spark, log)

    def _newest(self, path: str, follower: str | None = None) -> int:
        kept = read_if_exists(self.spark, path)
        if kept is None:
            return 0
        kept = kept if follower is None else kept.filter(F.col("follower") == follower)
        return kept.agg(F.max("n")).first()[0] or 0

    def mark(self, parts: list[str] | None) -> None:
        """Partition labels about to be written; None for all of them."""
        rows = [(self._newest(self.marks) + 1, part) for part in ([ALL] if parts is None else parts)]
        if rows:
            append_log(self.spark.createDataFrame(rows, "n long, part string").coalesce(1), self.marks)

    def since(self, follower: str) -> tuple[list[str] | None, int]:
        """What a follower has to look at (None: everything), and the number to give to `reached`. One that
        has never come looks at everything."""
        upto, before = self._newest(self.marks), self._newest(self.done, follower)
        if before == 0 or upto == 0:
            return None, upto
        marks = self.spark.read.parquet(self.marks).filter((F.col("n") > before) & (F.col("n") <= upto))
        parts = sorted(r[0] for r in marks.select("part").distinct().collect())  # a value per partition
        return (None if ALL in parts else parts), upto

    def reached(self, follower: str, n: int) -> None:
        append_log(self.spark.createDataFrame([(n, follower)], "n long, follower string").coalesce(1), self.done)
        if max(len(folder_names(self.spark, log)) for log in (self.marks, self.done)) > FEW_FILES:
            self._shorten()

    def _shorten(self) -> None:
        """Keep what some follower has yet to see, and the last number given. One that has never come
        looks at everything anyway."""
        done = self.spark.read.parquet(self.done).groupBy("follower").agg(F.max("n").alias("n")).select("n", "follower")
        seen, newest = done.agg(F.min("n")).first()[0], self._newest(self.marks)
        if newest:
            left = self.spark.read.parquet(self.marks).filter((F.col("n") > seen) | (F.col("n") == newest))
            replace_table(left.distinct().coalesce(1), self.marks)
        replace_table(done.coalesce(1), self.done)


def month_of(part: Column) -> Column:
    """The month label of a partition label of either grain."""
    return F.when(part == "none", part).otherwise(F.concat(F.lit("m"), F.substr(part, F.lit(2), F.lit(7))))


def months_of(parts: list[str]) -> list[str]:
    """The month labels of partition labels of either grain."""
    return sorted({p if p == "none" else "m" + p[1:8] for p in parts})


def month_away(label: str, n: int) -> str:
    """The label of the month n months after a month's."""
    if label == "none":
        return label
    count = int(label[1:5]) * 12 + int(label[6:8]) - 1 + n
    return f"m{count // 12:04d}-{count % 12 + 1:02d}"


def follow(
    spark: SparkSession, path: str, table: str, label: str, parts: list[str] | None,
    work: Callable[[DataFrame], DataFrame], by: Callable[[Column], Column] = lambda part: part,
    also: Sequence[str] = (),
) -> DataFrame:
    """Keep `work(rows of the table)` stored by partition of the table: only `parts` (labels after `by`)
    are read and worked out again, each in place of what is there; None is all of them.

    `work` sees the label as column `label` and keeps it. It is given the partitions `also` too, where
    it has to look beyond a partition's edge; what it makes of those is not stored. A partition
    without rows goes.
    """
    source = spark.read.parquet(table)
    named = source.withColumn(label, by(F.col(PART)))
    whole = parts is None or not folder_names(spark, path)
    if not whole:
        named = named.filter(by(F.col(PART)).isin(*parts, *also))
    rows = work(named.drop(PART))
    if not whole and also:
        rows = rows.filter(F.col(label).isin(*parts))
    if whole:
        rows.hint("rebalance", F.col(label)).write.mode("overwrite").partitionBy(label).parquet(path)
    elif parts:
        written = Observation()
        (rows.hint("rebalance", F.col(label)).observe(written, F.collect_set(label).alias("parts")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(label).parquet(path))
        for part in set(parts) - set(written.get["parts"]):
            discard(spark, os.path.join(path, f"{label}={part}"))
    return spark.read.schema(rows.schema).parquet(path)
