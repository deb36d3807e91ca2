"""One query per operator of the subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcat.llm import importance, jaccard_join, licenses, main_text, mixing, packing, phrases, pii, pseudo_likelihood, quality, quotes, url_filter, vector_graph


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def tokenizer_path() -> str:
    """The byte-level tokenizer's file; installed on every node."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    rows = packing.pieces(docs, tokenizer_path(), added=True).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(rows)


def op2_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score_corpus(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link(_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_graph.near_duplicates(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return quality.judge(docs, "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(_table(spark, sf_dir, "documents", "lang", "text"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents", "doc_id", "text"), _table(spark, sf_dir, "benchmark", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_pseudo_likelihood": op2_pseudo_likelihood,
    "op3_quotation_linking": op3_quotation_linking,
    "op4_pii": op4_pii,
    "op5_license_scan": op5_license_scan,
    "op6_mixing": op6_mixing,
    "op7_embedding_graph": op7_embedding_graph,
    "op8_url_filter": op8_url_filter,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_main_text": op11_main_text,
    "op12_collocations": op12_collocations,
    "op13_importance_resampling": op13_importance_resampling,
}
