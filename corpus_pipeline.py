"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor has written. Null, empty and blank texts fail the
first stage's least length. Ids and sources may be null or repeated: of rows with one text
one stays in the second stage, the one of least id; null is a source of its own, the last.
Ties between classes, ranks and pieces fall as the operators' own docstrings say. Texts of
any length are taken whole. Columns other than those of ``documents`` are dropped by the
first stage, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import minhash, mixing, packing, quality, substrings
from ledgerlens.llm.staging import settled

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# The columns of documents.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass every quality rule."""
    return quality.judged(docs).filter("kept").select(*COLUMNS)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the least id."""
    return minhash.representatives(docs).select(*COLUMNS)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated passages, as words joined by one space; other texts stay as they are."""
    cleaned = substrings.cleaned(docs)
    text = F.when(F.col("dedup.n_removed") > 0, F.col("dedup.kept_text")).otherwise(F.col("text"))
    return cleaned.withColumn("text", text).withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.repeated(mixing.mixed(docs)).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences, with their token ids."""
    return packing.packed(docs, added_tokens=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The stages rest on hashing, graph components and a tokenizer, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(spark, f"stage-{name.replace(' ', '-')}", partial(stage, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
