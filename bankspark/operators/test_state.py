"""Column tests of a clustered table from what is stored per partition, so that a run reads the partitions
written since the last one and no others."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from bankspark.operators.quality import ERROR, ColumnTest, Reference, outcome
from bankspark.sources.sinks import read_if_exists, replace_table
from bankspark.sources.touched import follow

LABEL = "part"


def refresh_tests(
    spark: SparkSession, path: str, table: str, parts: Sequence[str] | None, model: str,
    rows: Sequence[ColumnTest], unique: Sequence[str] = (), references: Sequence[Reference] = (),
) -> DataFrame:
    """Failures of all tests of a table, a row per test, as `run_table_tests` finds them on the whole.

    Kept per partition of the table, below `path`: the failures of the row-level tests, how often
    each referring value stands there, and a 16-byte digest of every unique value. `parts` (None: all)
    are read again. A value can only have become a duplicate in one of them or have been one before,
    so these digests are looked up among all; the table itself is not read for it. References are
    compared with the parents as they are now, value by value.
    """
    where = lambda kind: os.path.join(path, kind)
    parts = None if parts is None else list(parts)
    bad = [f"bad{k}" for k in range(len(rows))]
    out = []

    def exploded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        values = [F.struct(F.lit(k).alias("test"), F.col(c).cast("string").alias("value")) for k, c in enumerate(columns)]
        return df.select(LABEL, F.explode(F.array(*values)).alias("t")).select(LABEL, "t.*").filter("value is not null")

    if rows:
        counts = follow(spark, where("rows"), table, LABEL, parts, lambda df: df.groupBy(LABEL).agg(
            *[F.count_if(t.bad).alias(b) for t, b in zip(rows, bad)]))
        total = counts.agg(*[F.coalesce(F.sum(b), F.lit(0)).alias(b) for b in bad])
        out.append(total.select(F.explode(F.array(*[outcome(model, t.column, t.test, ERROR, F.col(b)) for t, b in zip(rows, bad)])).alias("r")))
    if unique:
        digest = F.unhex(F.md5("value")).alias("digest")
        keys = follow(spark, where("keys"), table, LABEL, parts, lambda df: exploded(df, unique).select(LABEL, "test", digest))
        known = read_if_exists(spark, where("duplicates"))
        looked = keys
        if parts is not None and known is not None:
            suspects = keys.filter(F.col(LABEL).isin(*parts)).select("test", "digest").unionByName(known)
            looked = keys.join(suspects, ["test", "digest"], "left_semi")
        twice = looked.groupBy("test", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("test", "digest")
        twice = replace_table(twice, where("duplicates"))
        total = twice.agg(*[F.count_if(F.col("test") == k).alias(f"n{k}") for k in range(len(unique))])
        out.append(total.select(F.explode(F.array(*[outcome(model, c, "unique", ERROR, F.col(f"n{k}")) for k, c in enumerate(unique)])).alias("r")))
    if references:
        held = follow(spark, where("references"), table, LABEL, parts, lambda df: exploded(
            df, [r.column for r in references]).groupBy(LABEL, "test", "value").agg(F.count(F.lit(1)).alias("n")))
        for k, r in enumerate(references):
            values = held.filter(F.col("test") == k).groupBy("value").agg(F.sum("n").alias("n"))
            parents = r.parent.select(F.col(r.parent_column).cast("string").alias("value"))
            lost = values.join(parents, "value", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
            out.append(lost.select(outcome(model, r.column, "relationships", r.severity, F.col("n")).alias("r")))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found.select("r.*")
