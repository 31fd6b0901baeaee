"""Helpers shared by the operators: written intermediates, text buffers, document keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bankspark.session import work_dir
from bankspark.sources.sinks import discard

# Rows per Arrow batch handed to Python. Texts can be long, so batches are kept short; the
# operators cut them once more by bytes (`byte_slices`).
ARROW_ROWS = 512
SLICE_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Session settings the Arrow operators rely on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def write_stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write an intermediate table to a fresh folder below the shared one and read it back.

    Cuts the lineage: a lost executor costs the tasks of the running stage only.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stage_path = path
    return back


def few(df: DataFrame, limit: int) -> DataFrame:
    """A written table, marked for broadcast if it has at most `limit` rows."""
    return F.broadcast(df) if df.count() <= limit else df


def drop_stage(df: DataFrame) -> None:
    """Remove an intermediate that nothing will read again."""
    discard(df.sparkSession, df.stage_path)


def id_remainder(col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo `mod`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % mod


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """Two never-null longs that name a row of documents: rows that repeat id and text share
    them, and work done per key is joined back to each such row."""
    return (
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63)).cast("long")).alias("k_id"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("k_row"),
    )


KEY = ["llm_k_id", "llm_k_row"]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All columns of `docs` and the row key under names that do not clash with them."""
    key = row_key(id_col, text_col)
    return docs.select(*columns_of(docs), *[c.alias(name) for c, name in zip(key, KEY)])


def as_key(found: DataFrame, *more: str) -> DataFrame:
    """The row key of a result (k_id, k_row) under the names of `keyed`, and more of its columns."""
    return found.select(*[F.col(c).alias(name) for c, name in zip(("k_id", "k_row"), KEY)], *more)


def columns_of(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def texts_of(batch: pa.RecordBatch, col: str) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets into them; null is empty."""
    arr = batch.column(batch.schema.get_field_index(col))
    if pa.types.is_dictionary(arr.type):
        arr = arr.dictionary_decode()
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    offsets = np.frombuffer(arr.buffers()[1], kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def byte_slices(batch: pa.RecordBatch, col: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts hold about `limit` bytes (one row at least)."""
    if batch.num_rows == 0:
        return
    _, offsets = texts_of(batch, col)
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop
