"""A keyed table that small batches of changes arrive at, without reading the table to take them in.

Below its path:

    changes/seq=<n>/bucket=<b>/                   every batch as it came, one change per key
    base/version=<v>/bucket=<b>/date_part=<m>/    rows, by hash bucket of the key, then month or day
    versions/                                     a row per version and bucket it rewrote
    streams/                                      the number of buckets; the first seq of each stream

A reader takes each bucket's newest version and plays the batches after it. `fold`, a job of its own,
writes new versions of the buckets that have changes. Nothing is moved or overwritten: a version
counts once its row in `versions` is there, and a batch that is repeated writes its folder again.
One writer of batches and one fold at a time; `clean` removes what no reader needs any more.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from bankspark.operators.changes import CDC_UPDATE_COLS
from bankspark.sources.sinks import (
    append_log, discard, finish_replace, folder_names, part_label, read_if_exists, replace_table,
)

BUCKETS = 256
SEQ, BUCKET, VERSION, PART = "seq", "bucket", "version", "date_part"
VERSIONS = "version long, upto long, bucket int, n long"
STREAMS = "stream string, first long, buckets int, grain string"


def played(row: Column, changes: Column, columns: Sequence[str], update_cols: Sequence[str]) -> Column:
    """A row (null: unknown key) after its key's changes, oldest first.

    Known key + DELETE: gone. Known key + UPDATE: `update_cols` are set and the row is stamped.
    Unknown key + INSERT: added. Everything else is ignored. `seq` is the last change that counted.
    """
    def step(have: Column, change: Column) -> Column:
        op = change["cdc_operation"]

        def value(c: str) -> Column:
            if c == "ingested_at":
                return change["at"]
            if c in ("cdc_operation", SEQ, *update_cols):
                return change[c]
            return F.when(have.isNull(), change[c]).otherwise(have[c])

        taken = (have.isNull() & (op == "INSERT")) | (have.isNotNull() & (op == "UPDATE"))
        return F.when(have.isNotNull() & (op == "DELETE"), F.lit(None)).when(
            taken, F.struct(*[value(c).alias(c) for c in (*columns, SEQ)])).otherwise(have)

    return F.aggregate(changes, row, step)


@dataclass
class ChangeSink:
    """`columns` are those of the stored rows: the key, `day`, `cdc_operation` and `ingested_at` among them."""

    spark: SparkSession
    path: str
    key: str
    day: str
    schema: T.StructType
    update_cols: Sequence[str] = CDC_UPDATE_COLS
    grain: str = "month"
    buckets: int = BUCKETS

    def __post_init__(self) -> None:
        finish_replace(self.spark, self._at("versions"))
        kept = read_if_exists(self.spark, self._at("streams"))
        known = None if kept is None else kept.first()
        if known is not None:  # a sink keeps what it was made with
            self.buckets, self.grain = known["buckets"], known["grain"]
        self.known = known is not None

    def _at(self, *parts: str) -> str:
        return os.path.join(self.path, *parts)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def first_seq(self, stream: str) -> int:
        """Where the batches of a stream, named by its checkpoint, start: after all that were here when
        it first came."""
        kept = read_if_exists(self.spark, self._at("streams"))
        found = [] if kept is None else kept.filter(F.col("stream") == stream).collect()  # one row
        if found:
            return found[0]["first"]
        first = max(self._upto(), *(self._seqs() or [-1])) + 1
        self._enter(stream, first)
        return first

    def _enter(self, stream: str, first: int) -> None:
        append_log(self.spark.createDataFrame([(stream, first, self.buckets, self.grain)], STREAMS).coalesce(1), self._at("streams"))
        self.known = True

    # --- taking changes in ---------------------------------------------------------------------

    def append(self, changes: DataFrame, seq: int, now: Column) -> None:
        """Store a batch: one change per key, with `cdc_operation`. The sink is not read."""
        if not self.known:
            self._enter("", 0)
        columns = [F.col(f.name).cast(f.dataType) for f in self.schema if f.name != "ingested_at"]
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias(BUCKET)
        rows = changes.select(*columns, now.cast("timestamp_ntz").alias("at"), bucket)
        # One file a bucket.
        rows.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self._at("changes", f"{SEQ}={seq}"))

    def applied(self, seq: int) -> DataFrame:
        """The rows that a batch added or updated, as they are after it. Reads the batch's buckets only."""
        buckets = self._buckets_of(seq, seq)
        pending = self._pending(buckets, upto=seq)
        keys = pending.filter(F.col(SEQ) == seq).select(BUCKET, self.key)
        mine = [BUCKET, self.key]
        # Where this batch alone is pending, all changes are of its keys.
        alone = self._seqs(self._upto())[:1] == [seq]
        lists = self._lists(pending.filter(F.col(self.key).isNotNull()) if alone else pending.join(keys, mine, "left_semi"))
        base = self._base(buckets).join(keys, mine, "left_semi")
        rows = lists.join(base, mine, "left").select(self._play("row").alias("r"))
        return rows.filter(F.col(f"r.{SEQ}") == seq).select("r.*").drop(SEQ)

    # --- reading -------------------------------------------------------------------------------

    def rows(self, keys: DataFrame | None = None) -> DataFrame:
        """The table as it is now; with `keys`, the rows of these keys, from their buckets only."""
        buckets = None
        if keys is not None:
            keys = keys.select(self.key).distinct()
            bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
            buckets = sorted(r[0] for r in keys.select(bucket.alias(BUCKET)).distinct().collect())  # at most the number of buckets
        state = self._state(buckets)
        return state if keys is None else state.join(keys, self.key, "left_semi")

    def _state(self, buckets: list[int] | None, upto: int | None = None, with_bucket: bool = False) -> DataFrame:
        """Rows of some buckets (None: all). The base is joined with the keys that have changes, a
        side that `fold` keeps short, and not shuffled while that can be broadcast."""
        base, lists = self._base(buckets), self._lists(self._pending(buckets, upto))
        mine = [BUCKET, self.key]
        old = base.join(lists, mine, "left").select(BUCKET, self._play("row").alias("r"))
        met = base.select(*mine).join(lists.select(*mine), mine, "left_semi")
        new = lists.join(met, mine, "left_anti").select(BUCKET, self._play(None).alias("r"))
        kept = old.unionByName(new).filter(F.col("r").isNotNull())
        return kept.select(*([BUCKET] if with_bucket else []), "r.*").drop(SEQ)

    def _row_type(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(SEQ, T.LongType())])

    def _play(self, row: str | None) -> Column:
        start = F.lit(None).cast(self._row_type()) if row is None else F.col(row).cast(self._row_type())
        return F.when(F.col("changes").isNull(), start).otherwise(played(start, F.col("changes"), self.columns, self.update_cols))

    def _lists(self, pending: DataFrame) -> DataFrame:
        """(bucket, key, changes): at most one change a batch."""
        change = F.struct(SEQ, *[F.col(c) for c in self.columns if c != "ingested_at"], "at")
        return pending.groupBy(BUCKET, self.key).agg(F.array_sort(F.collect_list(change)).alias("changes"))

    def _base(self, buckets: list[int] | None) -> DataFrame:
        """(bucket, key, row) of the newest version of each bucket."""
        live = {b: v for b, v, n in self._live() if n and (buckets is None or b in set(buckets))}
        paths = [self._at("base", f"{VERSION}={v}", f"{BUCKET}={b}") for b, v in sorted(live.items())]
        row = F.struct(*self.columns, F.lit(-1).cast("long").alias(SEQ)).alias("row")
        stored = T.StructType([*self.schema.fields, T.StructField(VERSION, T.LongType()), T.StructField(BUCKET, T.IntegerType()), T.StructField(PART, T.StringType())])
        if not paths:
            return self.spark.createDataFrame([], stored).select(BUCKET, self.key, row)
        read = self.spark.read.schema(stored).option("basePath", self._at("base")).parquet(*paths)
        return read.filter(F.col(BUCKET).isin(*live)).select(BUCKET, self.key, row)

    def _pending(self, buckets: list[int] | None, upto: int | None = None) -> DataFrame:
        """Changes that no version holds yet."""
        kinds = [f for f in self.schema if f.name != "ingested_at"]
        stored = T.StructType([*kinds, T.StructField("at", T.TimestampNTZType()), T.StructField(SEQ, T.LongType()), T.StructField(BUCKET, T.IntegerType())])
        after = self._upto()
        paths = [self._at("changes", f"{SEQ}={n}") for n in self._seqs(after) if upto is None or n <= upto]
        if not paths:
            return self.spark.createDataFrame([], stored)
        read = self.spark.read.schema(stored).option("basePath", self._at("changes")).parquet(*paths)
        return read.filter(F.col(SEQ) > after) if buckets is None else read.filter(F.col(BUCKET).isin(*buckets))

    # --- the books -----------------------------------------------------------------------------

    def _folders(self, *parts: str) -> list[str]:
        return folder_names(self.spark, self._at(*parts))

    def _seqs(self, after: int = -1) -> list[int]:
        """Batches after one whose folders are complete."""
        found = sorted(int(n.split("=")[1]) for n in self._folders("changes") if n.startswith(f"{SEQ}="))
        return [n for n in found if n > after and "_SUCCESS" in self._folders("changes", f"{SEQ}={n}")]

    def _versions(self) -> DataFrame | None:
        return read_if_exists(self.spark, self._at("versions"))

    def _upto(self) -> int:
        kept = self._versions()
        newest = None if kept is None else kept.agg(F.max("upto")).first()[0]
        return -1 if newest is None else newest

    def _live(self) -> list[tuple[int, int, int]]:
        """(bucket, newest version, rows): a row per bucket."""
        kept = self._versions()
        if kept is None:
            return []
        newest = kept.groupBy(BUCKET).agg(F.max_by(F.struct(VERSION, "n"), VERSION).alias("x"))
        return [tuple(r) for r in newest.select(BUCKET, f"x.{VERSION}", "x.n").collect()]

    def _buckets_of(self, first: int, last: int) -> list[int]:
        """Buckets that the batches first..last have changes in, by their folders' names."""
        names = {n for s in self._seqs(first - 1) if s <= last for n in self._folders("changes", f"{SEQ}={s}")}
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))

    # --- housekeeping --------------------------------------------------------------------------

    def fold(self) -> int:
        """Bring the buckets that have changes up to the newest batch; returns how many. Other buckets
        are neither read nor written."""
        seqs = self._seqs(self._upto())
        if not seqs:
            return 0
        upto, buckets = seqs[-1], self._buckets_of(seqs[0], seqs[-1])
        version = max([v for _, v, _ in self._live()], default=-1) + 1
        folder = self._at("base", f"{VERSION}={version}")
        rows = self._state(buckets, upto, with_bucket=True).withColumn(PART, part_label(self.day, self.grain))
        (rows.hint("rebalance", F.col(BUCKET), F.col(PART)).sortWithinPartitions(BUCKET, PART, self.day)
         .write.mode("overwrite").partitionBy(BUCKET, PART).parquet(folder))
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType()), T.StructField(PART, T.StringType())])
        held = {r[0]: r[1] for r in self.spark.read.schema(schema).parquet(folder).groupBy(BUCKET).count().collect()}  # a row per bucket
        book = [(version, upto, b, held.get(b, 0)) for b in buckets]
        append_log(self.spark.createDataFrame(book, VERSIONS).coalesce(1), self._at("versions"))
        return len(buckets)

    def clean(self) -> None:
        """Remove folded batches, superseded versions and their entries in the books. Not while a reader
        that began before the last fold runs."""
        kept = self._versions()
        if kept is None:
            return
        newest = kept.groupBy(BUCKET).agg(F.max_by(F.struct(VERSION, "upto", BUCKET, "n"), VERSION).alias("x"))
        replace_table(newest.select("x.*").coalesce(1), self._at("versions"))
        upto, live = self._upto(), {(v, b) for b, v, _ in self._live()}
        newest = max([v for v, _ in live], default=-1)
        for n in self._seqs():
            if n <= upto:
                discard(self.spark, self._at("changes", f"{SEQ}={n}"))
        for name in self._folders("base"):
            v = int(name.split("=")[1]) if name.startswith(f"{VERSION}=") else newest + 1
            for sub in self._folders("base", name) if v <= newest else []:
                if sub.startswith(f"{BUCKET}=") and (v, int(sub.split("=")[1])) not in live:
                    discard(self.spark, self._at("base", name, sub))
