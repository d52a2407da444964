"""One query per pipeline operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tripfare.llm import oracle, sharding
from tripfare.llm.decontamination import decontamination
from tripfare.llm.exact_search import exact_top_k
from tripfare.llm.graph_dedup import graph_dedup
from tripfare.llm.importance import importance_resampling
from tripfare.llm.language import language_id, remainder
from tripfare.llm.language_model import score_texts
from tripfare.llm.mixing import mix
from tripfare.llm.near_duplicates import NearDuplicates, near_duplicates
from tripfare.llm.phrases import phrases
from tripfare.llm.suffix_dedup import suffix_dedup
from tripfare.llm.token_counts import token_counts
from tripfare.llm.token_files import token_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_duplicates(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"), NearDuplicates(percent=85))


def op2_sharding(spark, sf_dir):
    return sharding.assign_shards(_table(spark, sf_dir, "documents").select("doc_id"))


def op3_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = language_id(docs, remainder(4) != 2)
    return found.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op4_suffix_dedup(spark, sf_dir):
    return suffix_dedup(_table(spark, sf_dir, "documents")).drop("kept")


def op5_decontamination(spark, sf_dir):
    found = decontamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("items", "text_hash")


def op6_exact_top_k(spark, sf_dir):
    return exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_token_files(spark, sf_dir):
    return token_table(_table(spark, sf_dir, "documents"))


def op8_language_model(spark, sf_dir):
    return score_texts(_table(spark, sf_dir, "documents"), remainder(7) != 2)


def op9_mixing(spark, sf_dir):
    return mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("text_hash")


def op10_substring_dedup(spark, sf_dir):
    return graph_dedup(_table(spark, sf_dir, "documents")).drop("kept")


def op11_phrases(spark, sf_dir):
    return phrases(_table(spark, sf_dir, "documents")).drop("size")


def op12_token_counts(spark, sf_dir):
    return token_counts(_table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark, sf_dir):
    found = importance_resampling(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_near_duplicates,
        op2_sharding,
        op3_language_id,
        op4_suffix_dedup,
        op5_decontamination,
        op6_exact_top_k,
        op7_token_files,
        op8_language_model,
        op9_mixing,
        op10_substring_dedup,
        op11_phrases,
        op12_token_counts,
        op13_importance_resampling,
        pipeline,
    )
}

# Where SQL can state the result. The others are tested against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op1_near_duplicates": oracle.NEAR_DUPLICATES,
    "op2_sharding": sharding.oracle(),
    "op4_suffix_dedup": oracle.SUFFIX_DEDUP,
    "op5_decontamination": oracle.DECONTAMINATION,
    "op6_exact_top_k": oracle.EXACT_TOP_K,
    "op10_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op11_phrases": oracle.PHRASES,
    "op13_importance_resampling": oracle.IMPORTANCE_RESAMPLING,
}
