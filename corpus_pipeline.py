"""The corpus pipeline: quality rules, toxicity, near-duplicates, benchmark decontamination, packing.

Every stage takes the documents that its predecessor kept; all but the last return the columns of ``documents``. Texts
that are missing count as empty, rows that are there twice are judged each (near-duplicates: one stays), rows without an
id have no label, and empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeops.llm.decontaminate import drop_contaminated
from lakeops.llm.minhash import keep_one
from lakeops.llm.packing import packed
from lakeops.llm.quality import keep_good
from lakeops.llm.registry import table
from lakeops.llm.toxicity import drop_toxic
from lakeops.session import materialize

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; texts with few words, missing ones too, go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; texts without words score 0."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, that of the smallest id; texts without words are in no group."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages, also of items without an id; texts without words stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"), unnamed=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of every document, packed into sequences; a text without words is a piece of the end id alone."""
    return packed(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: SQL has no tokenizer and does not learn, so tests run the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
