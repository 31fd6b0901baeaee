"""Benchmark decontamination by a positional inverted index; DataFrame operations only."""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bankspark.llm.common import KEY, as_key, columns_of, few, keyed, row_key, write_stage

WINDOW = 13
# Bounds under which a side is broadcast: terms of the items, documents with candidates.
BROADCAST_TERMS = 1_000_000
BROADCAST_DOCS = 500_000
END = ""  # a term no text holds; its posting's place is the document's number of words
# Fixed value of the contract: a word is a run of characters outside these.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z and nothing else; pure ASCII takes the faster function."""
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def words(text: Column) -> Column:
    """Words of a text as an array; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), BREAKS), "")


@dataclass
class Index:
    """Postings of the corpus (k_id, k_row, place, tid) for the terms of the items' windows, and
    the windows: which item holds which (wid), and each one's terms (wid, size, place, tid)."""

    postings: DataFrame
    items: DataFrame
    windows: DataFrame


def build_index(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> Index:
    """Store the postings, by one pass over the documents.

    A window: `window` consecutive words of an item, or the whole of one with fewer. Only terms
    of windows get postings (a semi-join ahead of the store). Null texts have no words.
    """
    size = F.size("words")
    spans = F.when(
        size >= window, F.transform(F.sequence(F.lit(1), size - window + 1), lambda i: F.slice("words", i, window))
    ).when(size > 0, F.array("words"))
    held = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), words(F.col(item_text_col)).alias("words"))
    held = held.select("item", F.explode(spans).alias("terms")).distinct()
    numbered = write_stage(
        held.select("terms").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    terms = numbered.select(F.explode("terms").alias("term")).distinct()
    terms = terms.union(terms.sparkSession.createDataFrame([(END,)], "term string"))
    vocabulary = write_stage(terms.withColumn("tid", F.monotonically_increasing_id()), "terms")
    item_windows = write_stage(held.join(numbered, "terms").select("item", "wid"), "items")
    windows = write_stage(
        numbered.select("wid", F.size("terms").alias("size"), F.posexplode("terms").alias("place", "term"))
        .join(vocabulary, "term").select("wid", "size", "place", "tid"), "window-terms")
    tokens = docs.select(*row_key(id_col, text_col), F.posexplode(F.array_append(words(F.col(text_col)), F.lit(END))).alias("place", "term"))
    postings = tokens.join(few(vocabulary, BROADCAST_TERMS), "term")
    end = vocabulary.filter(F.col("term") == END).first()["tid"]
    tid = F.when(F.col("tid") == end, F.lit(-1)).otherwise(F.col("tid")).cast("long")
    postings = write_stage(postings.select("k_id", "k_row", "place", tid.alias("tid")), "postings")
    return Index(postings, item_windows, windows)


def rarest(index: Index, ranks: int) -> DataFrame:
    """(wid, size, place, tid, rank): each window's terms with the fewest postings, rarest first.
    A window with a term that the corpus lacks is left out."""
    counts = index.postings.groupBy("tid").agg(F.count("*").alias("n"))
    ranked = index.windows.join(counts, "tid", "left")
    # Windows are short: one group holds `window` rows.
    ranked = ranked.withColumn("absent", F.max(F.col("n").isNull()).over(W.partitionBy("wid"))).filter("not absent")
    order = W.partitionBy("wid").orderBy("n", "place")
    return write_stage(
        ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= ranks)
        .select("wid", "size", "place", "tid", "rank"), "rarest")


def starts(index: Index, terms: DataFrame) -> DataFrame:
    """Where the windows of some of their terms (wid, size, place, tid) would start."""
    lists = index.postings.filter("tid >= 0").withColumnRenamed("place", "at")
    return lists.join(few(terms, BROADCAST_TERMS), "tid").select(
        "wid", "size", "k_id", "k_row", (F.col("at") - F.col("place")).alias("start"))


def phrase_matches(index: Index) -> DataFrame:
    """(wid, size, k_id, k_row, start): every occurrence of every window.

    The list of each window's rarest term gives candidates, which meet the offset-adjusted list
    of the second rarest, and then, in the documents left, those of all other terms.
    """
    key = ["wid", "size", "k_id", "k_row", "start"]
    ranked = rarest(index, 2)
    found = starts(index, ranked.filter("rank = 1").drop("rank")).filter("start >= 0").distinct()
    second = starts(index, ranked.filter("rank = 2").drop("rank"))
    single = found.filter("size = 1")
    found = write_stage(found.filter("size > 1").join(second, key, "left_semi").unionByName(single), "candidates")
    places = write_stage(found.select("k_id", "k_row").distinct(), "candidate-documents")
    lists = index.postings.filter("tid >= 0").join(few(places, BROADCAST_DOCS), ["k_id", "k_row"], "left_semi").distinct()
    wanted = found.join(index.windows.drop("size"), "wid").withColumn("place", F.col("start") + F.col("place"))
    met = wanted.join(lists, ["k_id", "k_row", "place", "tid"]).groupBy(*key).agg(F.count("*").alias("n"))
    return met.filter("n = size").drop("n")


def proximity_matches(index: Index, slop: int = 8) -> DataFrame:
    """(wid, k_id, k_row, start, distance): places where a window's second rarest term stands
    within `slop` words of where the rarest one expects it; distance 0 is the phrase's own.

    Both lists are cut into stretches of slop + 1 words, and neighbouring stretches meet by
    equality, so a term's list is not paired with all of another.
    """
    ranked = rarest(index, 2)
    one = starts(index, ranked.filter("rank = 1").drop("rank")).distinct()
    two = starts(index, ranked.filter("rank = 2").drop("rank")).select("wid", "k_id", "k_row", F.col("start").alias("other")).distinct()
    cell = F.floor(F.col("start") / (slop + 1))
    one = one.withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    two = two.withColumn("cell", F.floor(F.col("other") / (slop + 1)))
    pairs = one.join(two, ["wid", "k_id", "k_row", "cell"]).withColumn("distance", F.abs(F.col("start") - F.col("other")))
    return pairs.filter(F.col("distance") <= slop).groupBy("wid", "k_id", "k_row", "start").agg(F.min("distance").alias("distance"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of `docs`: k_id, k_row, doc_id, n_words, n_hit (words inside an occurring window),
    items (ids as text, sorted, of the items with such windows), contaminated (n_hit > 0 and at
    least a twentieth of n_words).

    Null, empty and word-free texts have no words and are clean; null item ids count as one empty
    id; items that repeat count once; no items, no hits. Rows that repeat id and text agree;
    other columns are ignored; an empty table gives no rows.
    """
    index = build_index(docs, items, id_col, text_col, item_col, item_text_col, window)
    hits = write_stage(phrase_matches(index), "hits")
    spot = ["k_id", "k_row"]
    runs = hits.groupBy(*spot, "start").agg((F.col("start") + F.max("size")).alias("stop"))
    before = F.max("stop").over(W.partitionBy(*spot).orderBy("start").rowsBetween(W.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce("before", F.lit(0))))
    covered = runs.withColumn("before", before).groupBy(*spot).agg(F.sum(fresh).cast("long").alias("n_hit"))
    named = hits.select(*spot, "wid").distinct().join(index.items, "wid").groupBy(*spot).agg(F.sort_array(F.collect_set("item")).alias("items"))
    sizes = index.postings.filter("tid = -1").select(*spot, F.col("place").cast("long").alias("n_words"))
    out = sizes.join(covered.join(named, spot), spot, "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        *spot, F.when(F.col("k_id") != F.lit(-(2**63)).cast("long"), F.col("k_id")).alias("doc_id"), "n_words",
        n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are not contaminated, with their columns."""
    dirty = as_key(contamination(docs, items, id_col, text_col).filter("contaminated")).distinct()
    return keyed(docs, id_col, text_col).join(dirty, KEY, "left_anti").select(*columns_of(docs))
