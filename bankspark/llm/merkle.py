"""Merkle manifests of a dataset: a digest tree per group, one over the groups, and a proof per row."""

from __future__ import annotations

import string
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from bankspark.llm.common import drop_stage, few, write_stage

FANOUT = 16
DIGEST = 64  # characters of a digest
LEVELS = 3  # of the tree that one block holds
BLOCK = FANOUT**LEVELS
# Bounds under which a short table is broadcast: a row per task and group, and the siblings above a
# group or block, some kilobytes each.
BROADCAST_ROWS, BROADCAST_PATHS = 100_000, 5_000

PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, concatenated."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda h, step: digest(step["left"], h, step["right"]))


def siblings(path: Column) -> Column:
    """All sibling digests of a path, level by level from the leaf, left to right."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z and nothing else."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds `place`, a row's position in its group `g` (0 first), and `n`, the group's size.

    The rows are sorted across tasks by range, so no group, however large, is sorted or numbered by
    one task: a row's number in its task, less that of the group's first row there, plus the
    group's rows in the tasks before.
    """
    ordered = nodes.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    # The upper bits of these ids are the task's number, the lower 33 the row's.
    ordered = ordered.withColumn("seq", F.monotonically_increasing_id())
    ordered = write_stage(ordered.withColumn("task", F.shiftright("seq", 33)), "ordered")
    held = ordered.groupBy("g", "task").agg(F.count(F.lit(1)).alias("rows"), F.min("seq").alias("first"))
    held = write_stage(held.selectExpr(
        "g as g2", "task as task2", "first", "sum(rows) over (partition by g) as n",
        "sum(rows) over (partition by g order by task) - rows as before"), "held")
    same = F.col("g").eqNullSafe(F.col("g2")) & (F.col("task") == F.col("task2"))
    placed = ordered.join(few(held, BROADCAST_ROWS), same).select(
        *nodes.columns, (F.col("seq") - F.col("first") + F.col("before")).alias("place"), "n")
    placed.stage_path = ordered.stage_path
    return placed


def _parents(level: str) -> Column:
    """The next level of a block as one string: a digest of every run of FANOUT digests."""
    size = FANOUT * DIGEST
    runs = F.sequence(F.lit(0), F.ceil((F.octet_length(level) / size)).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substr(level, i * size + 1, F.lit(size)), 256)), "").cast("binary")


def _blocks(placed: DataFrame, payload: list[str]) -> DataFrame:
    """A row per block of BLOCK neighbouring nodes of a group: the nodes, each level as one string (null
    above the block's top), and the top. A block of a group with several goes up all its levels."""
    node = F.struct("place", *payload, "digest")
    df = placed.groupBy("g", "n", F.expr(f"place div {BLOCK}").alias("block")).agg(F.array_sort(F.collect_list(node)).alias("nodes"))
    df = df.withColumn("level0", F.array_join(F.transform("nodes", lambda x: x["digest"]), "").cast("binary"))
    for k in range(LEVELS):
        more = (F.col("n") > BLOCK) | (F.octet_length(f"level{k}") > DIGEST)
        df = df.withColumn(f"level{k + 1}", F.when(more, _parents(f"level{k}")))
    levels = [f"level{k}" for k in reversed(range(LEVELS + 1))]
    return write_stage(df.withColumn("top", F.coalesce(*levels).cast("string")), "blocks")


def _path_in_block(place: Column) -> Column:
    """Siblings of a node in its block: what stands left and right of it in its run, per level."""
    steps = []
    for k in range(LEVELS):
        i = F.shiftright((place % BLOCK).cast("int"), 4 * k)
        run = F.shiftleft(F.shiftright(i, 4), 4)
        left = F.substr(f"level{k}", run * DIGEST + 1, (i - run) * DIGEST)
        right = F.substr(f"level{k}", (i + 1) * DIGEST + 1, (run + FANOUT - 1 - i) * DIGEST)
        steps.append(F.when(F.col(f"level{k + 1}").isNotNull(), F.struct(
            left.cast("string").alias("left"), right.cast("string").alias("right"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _with_paths(blocks: DataFrame, payload: list[str], *more: str) -> DataFrame:
    """A row per node with its siblings in its block and `upper`, those of the block, appended."""
    rows = F.transform("nodes", lambda x: F.struct(
        x["place"].alias("place"), *[x[c].alias(c) for c in payload], x["digest"].alias("digest"),
        F.concat(_path_in_block(x["place"]), F.col("upper")).cast(PATH).alias("path")))
    return blocks.select("g", *more, F.inline(rows))


def _climb(placed: DataFrame, payload: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The blocks of all groups' trees, the siblings above each block (g, block, upper), and the
    groups' roots (g, digest). Each round is a block's worth of levels, on a table that much shorter."""
    blocks = _blocks(placed, payload)
    tops = blocks.select("g", F.col("block").alias("place"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("top").alias("digest"))
    if (tops.agg(F.max("n")).first()[0] or 0) <= 1:  # one value
        return blocks, tops.select("g", F.col("place").alias("block"), F.array().cast(PATH).alias("upper")), tops.select("g", "digest")
    above, ends, roots = _climb(tops, [])
    return blocks, _with_paths(_beside(above, ends), []).select("g", F.col("place").alias("block"), F.col("path").alias("upper")), roots


def _beside(blocks: DataFrame, ends: DataFrame) -> DataFrame:
    """Blocks with what is known of each one's top; a key is one row on either side."""
    ends = write_stage(ends, "ends")
    renamed = ends.withColumnsRenamed({"g": "g2", "block": "block2"})
    same = F.col("g").eqNullSafe(F.col("g2")) & (F.col("block") == F.col("block2"))
    return blocks.join(few(renamed, BROADCAST_PATHS), same).drop("g2", "block2")


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id", group_col: str = "source", carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, leaf, subroot, root, path (the siblings by level, from the
    leaf's run through its group's tree and that of the groups up to the root), and the columns of `carry`.

    A leaf is the digest of `fields` in their order. A group's leaves ascend by id (null first, then
    by leaf); every FANOUT neighbours make a parent until one node is left, and the groups' roots
    (null group first, bytewise) do the same. Rows that repeat are leaves each, an empty table has
    no rows, columns not named are ignored, a long text is hashed by its task alone.

    Only digests are shuffled: once by range to number them, once to blocks of 4,096 neighbours.
    Hot groups are many blocks. Tables of a row per task, group or block are broadcast while short.
    """
    carry = dict(carry or {})
    leaves = write_stage(docs.select(
        F.col(f"`{group_col}`").alias("g"), F.col(f"`{id_col}`").alias("doc_id"),
        digest(*[field(F.col(f"`{c}`")) for c in fields]).alias("digest"), *[c.alias(name) for name, c in carry.items()]), "leaves")
    payload = ["doc_id", *carry]
    placed = _placed(leaves, ["doc_id", "digest"])
    drop_stage(leaves)
    blocks, ends, subroots = _climb(placed, payload)
    drop_stage(placed)
    roots = subroots.select(F.lit(0).alias("g"), F.col("g").alias("source"), "digest")
    tree, tree_ends, root = _climb(_placed(roots, ["source"]), ["source"])
    root = root.first()  # one row at most
    above = _with_paths(_beside(tree, tree_ends), ["source"]).select(
        F.col("source").alias("g2"), F.col("digest").alias("subroot"), F.col("path").alias("rest"))
    ends = ends.join(few(write_stage(above, "subroots"), BROADCAST_PATHS), F.col("g").eqNullSafe(F.col("g2"))).select(
        "g", "block", F.concat("upper", "rest").alias("upper"), "subroot")
    rows = _with_paths(_beside(blocks, ends), payload, "subroot")
    return rows.select(
        "doc_id", F.col("g").alias("source"), F.col("digest").alias("leaf"), "subroot",
        F.lit(root and root["digest"]).cast("string").alias("root"), "path", *carry)


def verify(rows: DataFrame, leaf: str = "leaf") -> DataFrame:
    """Adds the root that column `leaf` folds to along its row's path, and whether it is `root`."""
    return rows.withColumn("folded_root", fold(F.col(leaf), F.col("path"))).withColumn("verified", F.expr("folded_root = root"))
