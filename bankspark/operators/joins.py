"""Join shapes shared by the plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from bankspark.functions.dates import epoch_micros


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key is absent from the parent; a null key is an orphan too."""
    keys = parent.select(F.col(parent_key or key).alias(key))
    return child.join(keys, key, "left_anti")


def not_already_in(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose (non-null) key has not been seen."""
    return df.join(seen.select(key), key, "left_anti")


def overlay_current(stg: DataFrame, snapshot: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Staged rows left-joined to the open snapshot rows; `cols` come from the snapshot first."""
    snap = snapshot.select(
        F.col(key), *[F.col(c).alias(f"_snap_{c}") for c in cols],
        F.col("valid_from").alias("scd_valid_from"), F.col("valid_to").alias("scd_valid_to"),
    )
    joined = stg.join(snap, key, "left")
    kept = [
        F.coalesce(F.col(f"_snap_{c}"), F.col(c)).alias(c) if c in cols else F.col(c)
        for c in stg.columns
    ]
    return joined.select(*kept, "scd_valid_from", "scd_valid_to")


def join_as_of_validity(
    fact: DataFrame, history: DataFrame, key: str, ts: str, attrs: list[str], bucket_days: int = 31
) -> DataFrame:
    """Each fact row with the `attrs` its key had at the row's own time (null if none).

    A sweep instead of a join: versions and facts of a key stand in one line by time, and each fact
    takes the last version before it, so a key with many of both is read once and not paired up. The
    line is cut into buckets of time, so that no key, however hot, is one task; a version is handed
    on to every bucket it lasts into, between the first and the last one with facts. Versions of a key do
    not overlap; one that ends when it begins counts for nothing. Facts without key or time have no
    attributes. With a history of few versions a key and short enough to be broadcast,
    `join_short_history` needs no shuffle of the facts.
    """
    width = bucket_days * 86_400_000_000
    columns = fact.columns
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    out = [F.col(f"_row.{c}").alias(c) for c in columns]
    at = fact.select(F.struct(*columns).alias("_row"), F.col(key).alias("_key"), epoch_micros(F.col(ts)).alias("_us")).filter("_key is not null and _us is not null")
    rows = at.withColumn("_bucket", F.floor(F.col("_us") / width))
    first, last = (rows.agg(f(F.col("_bucket"))).scalar() for f in (F.min, F.max))

    start, end = epoch_micros(F.col("valid_from")), epoch_micros(F.col("valid_to"))
    spans = history.select(
        F.col(key).alias("_key"), start.alias("_from"), end.alias("_to"), F.struct(*attrs, F.col("valid_to").alias("_end")).alias("_version"),
    ).filter("_key is not null and _from is not null and (_to is null or _to > _from)").select(
        "*", F.greatest(F.floor(F.col("_from") / width), first).alias("_lo"),
        F.least(F.coalesce(F.floor((F.col("_to") - 1) / width), last), last).alias("_hi"))
    versions = spans.filter("_lo <= _hi").select(
        "_key", "_from", "_version", F.explode(F.sequence("_lo", "_hi")).alias("_bucket"))
    line = rows.select("_key", "_bucket", "_us", F.lit(1).alias("_kind"), "_row").unionByName(
        versions.select("_key", "_bucket", F.greatest(F.col("_from"), F.col("_bucket") * width).alias("_us"), F.lit(0).alias("_kind"), "_version"),
        allowMissingColumns=True)
    so_far = Window.partitionBy("_key", "_bucket").orderBy("_us", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = line.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far)).filter(F.col("_kind") == 1)
    holds = F.col("_version._end").isNull() | (F.col(f"_row.{ts}") < F.col("_version._end"))
    found = swept.select(*out, *[F.when(holds, F.col(f"_version.{a}")).alias(f"asof_{a}") for a in attrs])
    bare = fact.filter(~known).select(*columns, *[F.lit(None).cast(history.schema[a].dataType).alias(f"asof_{a}") for a in attrs])
    return found.unionByName(bare)


def join_short_history(
    fact: DataFrame, history: DataFrame, key: str, ts: str, attrs: list[str]
) -> DataFrame:
    """The same by an equi-join on the key and the interval condition: every version of a key meets every
    fact of it; a hot key is split on the fact side by AQE."""
    hist = history.select(
        F.col(key).alias("_hist_key"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
        *[F.col(a).alias(f"asof_{a}") for a in attrs],
    )
    valid = (
        (F.col(key) == F.col("_hist_key"))
        & (F.col(ts) >= F.col("_from"))
        & (F.col("_to").isNull() | (F.col(ts) < F.col("_to")))
    )
    return fact.join(hist, valid, "left").drop("_hist_key", "_from", "_to")
