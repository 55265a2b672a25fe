"""Registered queries of the corpus operators, with oracle SQL where SQL can express one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftwell.llm import decontaminate, merkle, mixing, naming, spelling
from driftwell.llm.decontaminate import contamination
from driftwell.llm.merkle import manifest
from driftwell.llm.mixing import mix
from driftwell.llm.naming import exact_duplicates
from driftwell.llm.packing import pack
from driftwell.llm.personal import find_personal
from driftwell.llm.prefixes import fingerprint_documents
from driftwell.llm.quality import score_quality
from driftwell.llm.repeats import remove_repeats
from driftwell.llm.sharding import shard
from driftwell.llm.simhash import near_duplicates
from driftwell.llm.spelling import spelling_groups
from driftwell.llm.toxicity import score_toxicity


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def labels(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet")


def benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/benchmark.parquet")


PLANS = {
    "op1_prefix_fingerprints": (lambda spark, sf: fingerprint_documents(documents(spark, sf)), None),
    "op2_length_buckets": (lambda spark, sf: pack(documents(spark, sf)), None),
    "op3_pareto_mix": (lambda spark, sf: mix(documents(spark, sf)), mixing.ORACLE_SQL),
    "op4_repeated_passages": (lambda spark, sf: remove_repeats(documents(spark, sf)), None),
    "op5_subword_quality": (lambda spark, sf: score_quality(documents(spark, sf), labels(spark, sf)), None),
    "op6_block_naming": (lambda spark, sf: exact_duplicates(documents(spark, sf)), naming.ORACLE_SQL),
    "op7_weak_toxicity": (lambda spark, sf: score_toxicity(documents(spark, sf), labels(spark, sf)), None),
    "op8_anchor_personal": (lambda spark, sf: find_personal(documents(spark, sf)), None),
    "op9_simhash_components": (lambda spark, sf: near_duplicates(documents(spark, sf)), None),
    "op10_balanced_shards": (lambda spark, sf: shard(documents(spark, sf)), None),
    "op11_benchmark_windows": (lambda spark, sf: contamination(documents(spark, sf), benchmark(spark, sf)), decontaminate.ORACLE_SQL),
    "op12_merkle_manifest": (lambda spark, sf: manifest(documents(spark, sf)), merkle.ORACLE_SQL),
    "op13_spelling_variants": (lambda spark, sf: spelling_groups(documents(spark, sf)), spelling.ORACLE_SQL),
}
