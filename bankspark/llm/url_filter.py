"""URL rules by a sort-merge range join on reversed hosts; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bankspark.llm.common import few, write_stage
from bankspark.llm.decontam import lower_ascii

POINTS_PER_SWEEP = 100_000
BROADCAST_HOSTS = 1_000_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) behind the first `://`, and the path up to `?` or `#`; both
    empty without `://` or url."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    return lower_ascii(raw), F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)


def range_key(host: Column, path: Column) -> Column:
    """Reversed host labels, a slash and the path, as bytes: what a rule fits, among urls of its
    host level, begins with the rule's key. A host holds no slash, so levels stay apart."""
    return F.encode(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("/"), path), "utf-8")


def boundaries(rules: DataFrame) -> DataFrame:
    """(level, key, top): where, along the sorted keys of a host level, the innermost active rule
    changes, and to which. Rules of one level are prefixes, so their intervals nest.

    A sweep over the sorted starts and ends keeps the stack: its height is a running sum, and what
    an end uncovers is the last rule that was pushed at the height left. The rules of one host are
    one group of the sweep.
    """
    key = range_key(F.col("host"), F.col("path"))
    rule = F.struct(
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("size"),
        F.concat("host", "path").alias("rule"), "verdict")
    starts = rules.select(F.col("host").alias("level"), key.alias("key"), F.lit(1).alias("step"), rule.alias("rule"))
    ends = starts.select("level", F.concat("key", F.lit(bytearray(b"\xff"))).alias("key"), F.lit(-1).alias("step"), F.lit(None).cast(starts.schema["rule"].dataType).alias("rule"))
    sweep = W.partitionBy("level").orderBy("key")
    steps = starts.unionByName(ends).withColumn("height", F.sum("step").over(sweep))
    pushed = F.last("rule", ignorenulls=True).over(W.partitionBy("level", "height").orderBy("key"))
    return steps.select("level", "key", F.when(F.col("height") > 0, pushed).alias("top"))


def apply_rules(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
                points_per_sweep: int = POINTS_PER_SWEEP) -> DataFrame:
    """All columns of `pages` and a struct `llm_rule`: host, path, rule, verdict.

    rules: (host, path, verdict). A rule fits its host and all subdomains if the path begins with
    the rule's. Of several, the one of the longest host wins, then of the longest path; of two
    rules alike, `block`. Without a fitting rule `rule` is null and the verdict is `default`. Rules
    without host are left out; a null path is empty; a null verdict is `default`. A url that is
    null or has no `://` has empty host and path and fits no rule. Repeated rows stay; an empty
    table gives no rows.

    Each distinct url becomes a point per suffix of its host that has rules. Points and rule
    boundaries of a host level are sorted together, and a point takes the last boundary before it.
    A level with many points is dealt to several sweeps, each with all of that level's boundaries.
    """
    host, path = host_and_path(F.col(url_col))
    kept = rules.select(
        lower_ascii(F.col("host")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.coalesce("verdict", F.lit(default)).alias("verdict")
    ).filter("host is not null and host != ''").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    urls = pages.select(host.alias("host"), path.alias("path")).filter("host != ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    points = urls.withColumn("level", F.explode(suffixes)).join(kept.select(F.col("host").alias("level")).distinct(), "level", "left_semi")
    sweeps = points.groupBy("level").agg(F.ceil(F.count("*") / points_per_sweep).cast("long").alias("sweeps"))
    # A row per host that has rules, so that the points need not be gathered by host for it.
    sweeps = few(write_stage(sweeps, "sweeps"), BROADCAST_HOSTS)
    points = points.join(sweeps, "level").select(
        "level", F.pmod(F.xxhash64("host", "path"), F.col("sweeps")).alias("sweep"),
        range_key(F.col("level"), F.col("path")).alias("key"), F.lit(1).alias("kind"), "host", "path")
    marks = boundaries(kept).join(sweeps, "level").select(
        "level", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sweeps") - 1)).alias("sweep"), "key",
        F.lit(0).alias("kind"), F.struct("top").alias("mark"))
    sweep = W.partitionBy("level", "sweep").orderBy("key", "kind")
    at = F.last("mark", ignorenulls=True).over(sweep)
    met = marks.unionByName(points, allowMissingColumns=True).withColumn("mark", at).filter("kind = 1 and mark.top is not null")
    best = met.groupBy("host", "path").agg(F.max("mark.top").alias("best")).select(
        F.col("host").alias("llm_host"), F.col("path").alias("llm_path"), "best")
    rows = pages.withColumn("llm_host", host).withColumn("llm_path", path)
    verdict = F.struct(
        F.col("llm_host").alias("host"), F.col("llm_path").alias("path"), F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    return rows.join(best, ["llm_host", "llm_path"], "left").select(*[rows[f"`{c}`"] for c in pages.columns], verdict.alias("llm_rule"))
