"""The corpus pipeline: each stage applies one operator to all documents the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcat.llm import jaccard_join, mixing, packing, pii, quality
from fieldcat.llm.queries import tokenizer_path
from fieldcat.llm.support import small_side, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    text = F.xxhash64("text")
    judged = quality.judge(docs.withColumn("text_hash", text), "doc_id", "text_hash")
    rejected = judged.where("not kept").select(F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_"), F.col("lang").alias("lang_"), F.col("source").alias("source_")).distinct()
    same = (docs["doc_id"].eqNullSafe(F.col("id_")) & (text == F.col("hash_"))
            & docs["lang"].eqNullSafe(F.col("lang_")) & docs["source"].eqNullSafe(F.col("source_")))
    return docs.join(small_side(rejected), same, "left_anti").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: that of least doc_id (null last), then text hash. Of
    rows given twice with that doc_id and text, the least by their other columns stays."""
    every, named = jaccard_join.grouped(docs)
    rows = every.where("n > 0").join(named.select("fp", "root"), "fp").groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    rows = stage(rows, "members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))).alias("first")
    rows = rows.join(rows.groupBy("root").agg(first), "root")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.id")) & (F.col("text_hash") == F.col("first.hash"))
    other = rows.where(~is_first | (F.col("copies") > 1)).select(
        F.col("doc_id").alias("id_"), F.col("text_hash").alias("hash_"), is_first.alias("repeated_"))
    other = stage(other, "others")
    text = F.xxhash64("text")
    same = docs["doc_id"].eqNullSafe(F.col("id_")) & (text == F.col("hash_"))
    docs = docs.select(*COLUMNS)
    once = docs.join(small_side(other), same, "left_anti")
    # a minimum, so rows given any number of times shrink in every task
    several = docs.join(small_side(other.where("repeated_")), same, "left_semi").groupBy("doc_id", text.alias("hash_")).agg(
        F.min(F.struct("lang", "source", "n_chars", "text")).alias("row"))
    return once.unionByName(several.select("doc_id", "row.text", "row.lang", "row.source", "row.n_chars")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced by its kind."""
    docs = docs.select(*COLUMNS)
    return pii.redact(docs, pii.fit(docs)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those it takes no word of go."""
    return mixing.materialise(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of packed sequences."""
    rows = packing.pieces(docs, tokenizer_path(), added=True).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(rows)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing_sources", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Some stages have no SQL form; the pipeline is tested against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
