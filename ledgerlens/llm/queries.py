"""The queries of this subpackage, each a thin digest of one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import licenses, minhash, mixing, orchard, packing, personal, quality, ranked, sharding, substrings, suffixes, topk, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.packed(_table(spark, sf_dir, "documents"), with_ids=False, added_tokens=True)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(_table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", *(F.col(f"mix.{c}") for c in ("size", "source_size", "target", "taken")))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.judged(_table(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return verdicts.select("doc_id", *(F.col(f"measures.{c}") for c in counts), "base_failed", "kept")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(_table(spark, sf_dir, "documents")).drop("matches")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").withColumn("embedding", topk.quantised(F.col("embedding")))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.sharded(_table(spark, sf_dir, "documents"))
    return shards.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(_table(spark, sf_dir, "documents"))


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.scanned(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in personal.KINDS]
    return found.select("doc_id", *counts, F.sha2(personal.listed(base), 256).alias("base_sha256"), personal.listed(F.col("spans")).alias("spans"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").withColumn("embedding", topk.quantised(F.col("embedding"), 4096))
    codes, model = orchard.compressed(vectors)
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return codes.select(F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error", F.lit(model.sha256()).alias("codebooks_sha256"))


def queries() -> dict[str, Query]:
    return {
        "op1_packing": op1_packing,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_mixing": op3_mixing,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_quality_rules": op5_quality_rules,
        "op6_license_scan": op6_license_scan,
        "op7_toxicity": op7_toxicity,
        "op8_exact_top_k": op8_exact_top_k,
        "op9_sharding": op9_sharding,
        "op10_minhash": op10_minhash,
        "op11_pii": op11_pii,
        "op12_ranked_search": op12_ranked_search,
        "op13_orchard": op13_orchard,
    }


def oracle_sql() -> dict[str, str]:
    from ledgerlens.llm.oracle import ORACLE

    return dict(ORACLE)
