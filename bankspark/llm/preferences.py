"""Preference pairs as one prompt and two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TRAINED_ROLE = "assistant"


def conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turns): each conversation's turns in order (of equal numbers by role and text,
    null first). Rows without a conversation id belong to none; a null role is `unknown`, a null
    text empty."""
    turn = F.struct(
        F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = turns.filter(F.col(id_col).isNotNull())
    return rows.groupBy(F.col(id_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def common_prefix(a: Column, b: Column) -> Column:
    """Number of leading turns that agree in role and text."""
    least = F.least(F.size(a), F.size(b))
    same = F.transform(
        F.sequence(F.lit(0), least - 1),
        lambda i: (a[i]["role"] == b[i]["role"]) & (a[i]["text"] == b[i]["text"]))
    first = F.array_position(same, F.lit(False))
    return F.when(least <= 0, F.lit(0)).when(first == 0, least).otherwise(first - 1).cast("int")


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit("<|end|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def trained_spans(turns: Column, trained: str) -> Column:
    """Character ranges of the rendered turns that the loss counts: text and end mark of the
    trained role's turns."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(acc: Column, turn: Column) -> Column:
        lo = acc["at"] + F.length(turn["role"]) + 5
        hi = lo + F.length(turn["text"]) + 7
        span = F.array(F.struct(lo.alias("start"), hi.alias("end")))
        return F.struct((hi + 1).alias("at"), F.when(turn["role"] == trained, F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, add, lambda acc: acc["spans"])


def format_pairs(turns: DataFrame, pairs: DataFrame, trained: str = TRAINED_ROLE, **names: str) -> DataFrame:
    """One row per pair (chosen_id, rejected_id): chosen_id, rejected_id, n_prompt (turns of the
    longest common prefix), prompt, and for either side its completion and the character ranges
    of it that are trained on.

    The prompt is rendered once; completions are the turns behind it. Of equal conversations
    everything is prompt and both completions are empty, as is the completion of a conversation
    that the other one continues. Pairs with an unknown or null id are left out; repeated pairs
    stay. A conversation is one row: its turns meet in one task.
    """
    whole = conversations(turns, **names)
    left = whole.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("c"))
    right = whole.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("r"))
    return format_sides(pairs.select("chosen_id", "rejected_id").join(left, "chosen_id").join(right, "rejected_id"), trained)


def format_sides(both: DataFrame, trained: str = TRAINED_ROLE) -> DataFrame:
    """The same from the turns of either side, columns c and r."""
    both = both.withColumn("n_prompt", common_prefix(F.col("c"), F.col("r")))
    rest = lambda side: F.slice(side, F.col("n_prompt") + 1, F.greatest(F.size(side), F.lit(1)))
    both = both.select(
        "chosen_id", "rejected_id", "n_prompt", F.slice("c", F.lit(1), F.col("n_prompt")).alias("p"), rest(F.col("c")).alias("c"), rest(F.col("r")).alias("r"))
    return both.select(
        "chosen_id", "rejected_id", "n_prompt", render(F.col("p")).alias("prompt"),
        render(F.col("c")).alias("chosen"), trained_spans(F.col("c"), trained).alias("chosen_trained"),
        render(F.col("r")).alias("rejected"), trained_spans(F.col("r"), trained).alias("rejected_trained"))


def exchanged(turns: DataFrame, trained: str = TRAINED_ROLE, **names: str) -> DataFrame:
    """Preference pairs made of every conversation by itself, for tables that hold none: (chosen_id,
    rejected_id, c, r) for `format_sides`.

    The rejected side is the conversation with its last trained turn exchanged for the last trained
    turn of conversation `rejected_id`, its neighbour (2k and 2k + 1); where that is missing or has
    none, for an empty text, and rejected_id is null. A conversation without a trained turn is the
    same on both sides, its rejected_id null. So the turns ahead of the exchanged one are the prompt.
    """
    whole = conversations(turns, **names)
    place = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == trained, i)))
    whole = whole.withColumn("last", place)
    answers = whole.filter("last is not null").select(
        F.col("conv_id").alias("rejected_id"), F.expr("turns[last].text").alias("answer"))
    joined = whole.join(answers, F.col("conv_id").cast("long").bitwiseXOR(F.lit(1).cast("long")) == F.col("rejected_id"), "left")
    joined = joined.withColumn("rejected_id", F.when(F.col("last").isNotNull(), F.col("rejected_id")))

    def other(t: Column, i: Column) -> Column:
        return F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.when(
            i == F.col("last"), F.coalesce(F.col("answer"), F.lit(""))).otherwise(t["text"]).alias("text"))

    return joined.select(F.col("conv_id").alias("chosen_id"), "rejected_id", F.col("turns").alias("c"), F.transform("turns", other).alias("r"))


def neighbour_pairs(turns: DataFrame, trained: str = TRAINED_ROLE) -> DataFrame:
    """(chosen_id, rejected_id) of conversations 2k and 2k + 1: the one with more characters by the
    trained role is chosen, of equals the one with the smaller id. A stand-in for a preference
    table; one of the two missing, no pair."""
    said = F.when(F.col("role") == trained, F.length("text")).otherwise(0)
    sizes = turns.filter("conv_id is not null").groupBy("conv_id").agg(F.coalesce(F.sum(said), F.lit(0)).cast("long").alias("n"))
    order = F.struct(-F.col("n"), "conv_id")
    pairs = sizes.groupBy(F.floor(F.col("conv_id") / 2)).agg(
        F.count("*").alias("k"), F.min(order).alias("a"), F.max(order).alias("b"))
    return pairs.filter("k = 2").select(F.col("a.conv_id").alias("chosen_id"), F.col("b.conv_id").alias("rejected_id"))
