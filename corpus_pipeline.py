"""From raw documents to token files: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripfare.llm.decontamination import decontamination
from tripfare.llm.language import in_a_language
from tripfare.llm.mixing import mix
from tripfare.llm.near_duplicates import NearDuplicates, near_duplicate_rows
from tripfare.llm.tables import small
from tripfare.llm.token_files import token_table
from tripfare.operators.durable import durable


def _lines(docs: DataFrame) -> DataFrame:
    """Whole rows beside what decisions are joined by, so no column name can clash."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("line"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64(F.col("text").cast("string")).alias("hash"),
    )


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; texts that are NULL or without letters go."""
    return in_a_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates, and rows without id.

    Rows that share an id are judged each by its own text; of rows with equal id
    and text, one stays.
    """
    found = near_duplicate_rows(docs, NearDuplicates(percent=80))
    gone = found.filter("not stays").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct()
    gone = durable(gone, "near-copies")
    same = F.col("hash").eqNullSafe(F.col("gone_hash")) & F.col("id").eqNullSafe(F.col("gone_id"))
    left = _lines(docs).join(small(gone), same, "left_anti")
    twice = left.filter("id is not null").groupBy(F.col("id").alias("twice_id"), F.col("hash").alias("twice_hash")).count()
    twice = durable(twice.filter("count > 1").drop("count"), "repeated-rows")
    if twice.isEmpty():
        return left.select("line.*")
    same = F.col("hash").eqNullSafe(F.col("twice_hash")) & F.col("id").eqNullSafe(F.col("twice_id"))
    repeated = left.join(small(twice), same, "left_semi").groupBy("id", F.col("line.text").alias("text"))
    once = repeated.agg(F.min_by("line", F.to_json("line")).alias("line"))
    return left.join(small(twice), same, "left_anti").select("line.*").unionByName(once.select("line.*"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = durable(found.filter("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")), "contaminated")
    same = F.col("hash").eqNullSafe(F.col("bad_hash")) & F.col("id").eqNullSafe(F.col("bad_id"))
    return _lines(docs).join(small(bad), same, "left_anti").select("line.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate to the target mix says, on average; rows without id too."""
    found = mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    other = found.groupBy(F.col("doc_id").alias("other_id"), F.col("text_hash").alias("other_hash")).agg(F.max("copies").alias("copies"))
    other = durable(other.filter("copies <> 1"), "not-once")
    same = F.col("hash").eqNullSafe(F.col("other_hash")) & F.col("id").eqNullSafe(F.col("other_id"))
    taken = _lines(docs).join(small(other), same, "left")
    return taken.select(F.explode(F.array_repeat("line", F.coalesce("copies", F.lit(1)))).alias("line")).select("line.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids written in block files, and each document's place in them."""
    return token_table(docs)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
    ("tokens", tokens),
]

# Language prediction and the mixing classifier are fitted models: no SQL states them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name)
    return docs
