"""Reading delimited files and declared sources; landing with audit columns."""

from __future__ import annotations

import os
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from bankspark.functions.dates import lit_ts
from bankspark.schemas import DELETED, RAW, SYNCED

# Texts that mean "no value" in delimited files.
NULL_TOKENS = ("", "NULL", "null")


FILE = "file"


def _raw_text(spark: SparkSession, path: str | list[str], schema: T.StructType, named: bool = False) -> DataFrame:
    """All fields as trimmed text, null tokens as null; short rows are filled with nulls. `named` adds
    the file of each row."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    df = spark.read.csv(
        path, schema=text, header=True, quote='"', escape='"', mode="PERMISSIVE",
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, encoding="UTF-8",
    )

    def clean(name: str) -> Column:
        value = F.trim(F.col(name))
        return F.when(~value.isin(*NULL_TOKENS), value).alias(name)

    return df.select(*[clean(f.name) for f in schema.fields], *([F.col("_metadata.file_path").alias(FILE)] if named else []))


def _typed(schema: T.StructType) -> list[Column]:
    return [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Delimited files (gzip too) as typed rows; a field that does not parse becomes null."""
    return _raw_text(spark, path, schema).select(*_typed(schema))


def load(
    spark: SparkSession, path: str | list[str], schema: T.StructType, named: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): a row is rejected when one of its fields has text that does not parse.

    Rejected rows keep their text and name the first such column. `named` adds the `file` of each row.
    """
    raw = _raw_text(spark, path, schema, named)
    bad = [
        F.when(
            F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f.name)
        )
        for f in schema.fields
    ]
    checked = raw.withColumn("reject_reason", F.coalesce(*bad))
    good = checked.filter(F.col("reject_reason").isNull()).select(*_typed(schema), *([FILE] if named else []))
    rejected = checked.filter(F.col("reject_reason").isNotNull())
    return good, rejected


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A small static file with declared column types; any unparsable field is an error."""
    return _raw_text(spark, path, schema).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def land(df: DataFrame, synced_at: datetime | None = None, deleted: bool = False) -> DataFrame:
    """Raw rows with the audit columns: sync time (default now) and the delete marker."""
    at = F.current_timestamp().cast("timestamp_ntz") if synced_at is None else lit_ts(synced_at)
    return df.withColumn(SYNCED, at).withColumn(DELETED, F.lit(deleted))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of its own file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by name from a folder, on any file system Spark reads: parquet as it is, CSV
    (plain or gzip; a gzip file is one task, however large) by its declared schema."""
    if name in RAW:
        for ending in ("csv", "csv.gz"):
            path = os.path.join(folder, f"{name}.{ending}")
            if exists(spark, path):
                return read_csv(spark, path, RAW[name])
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
