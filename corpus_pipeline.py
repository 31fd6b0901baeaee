"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from bankspark.llm import decontam, langid, near_dup, packing, suffix_dedup
from bankspark.llm.common import write_stage

LEAST_CONFIDENCE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told: those without a letter, and those whose likeliest
    language has a posterior probability under LEAST_CONFIDENCE, go. Learnt from the documents
    that name a language; if none does, all documents are undetermined and go."""
    found = langid.identify(docs, langid.fit(docs), lang_out="llm_lang", score_out="llm_sure")
    sure = (F.col("llm_lang") != langid.UNDETERMINED) & (F.col("llm_sure") >= LEAST_CONFIDENCE)
    return found.filter(sure).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return near_dup.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that stand earlier in the corpus; n_chars follows.
    A document with nothing left goes; one that was empty before stays."""
    cut = suffix_dedup.remove_repeats(docs, min_bytes=200, keep="first", as_text=True)
    changed = F.col("llm_kept.n_removed") > 0
    left = cut.filter(~changed | (F.trim("llm_kept.kept") != ""))
    text = F.when(changed, F.col("llm_kept.kept")).otherwise(F.col("text"))
    new = {"text": text, "n_chars": F.when(changed, F.length("llm_kept.kept")).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return left.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if new.get(c) is not None else F.col(f"`{c}`") for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in windows of the benchmark."""
    return decontam.drop_contaminated(docs, spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language), ("near_dedup", drop_near_duplicates), ("suffix_dedup", drop_repeated_passages),
    ("decontamination", decontaminate), ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written and read again."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = write_stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
