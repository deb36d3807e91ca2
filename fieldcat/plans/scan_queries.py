"""Registered queries over container files: each stages its input as the files an instrument
would write, in a fresh folder under the shared checkpoint root, and scans them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcat.functions.values import safe_size
from fieldcat.operators import fields as fld, sampling
from fieldcat.operators.frames import thumbnails
from fieldcat.operators.registry import IngestResult
from fieldcat.plans import adapters as ad
from fieldcat.plans.ingest import ingest_files
from fieldcat.schemas import CATALOGUE_KEYS, SAMPLE_SIZE, SAMPLED_KEYS, SCIENTIFIC_KEYS, unique_keys
from fieldcat.session import scratch_dir
from fieldcat.sources import containers

#: Values of an array in one chunk of a staged file.
CHUNK = 64


def _report(fields: DataFrame) -> DataFrame:
    norm = fld.value_text(fld.normalise(fld.select_fields(fields, ad.REQUESTED_KEYS)))
    return norm.select("file_path", "key", "value_kind", "value_text", "n_values")


def container_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The field scan over one file per document; the documents' texts are in the files and are
    not read, since no one asks for them."""
    root = scratch_dir(spark, "containers")
    containers.write_containers(ad.doc_fields(spark, sf_dir), root)
    return _report(containers.read_containers(spark, root, unique_keys(ad.REQUESTED_KEYS)))


def stream_container_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files arriving in two drops, the second while the stream's checkpoint exists."""
    root = scratch_dir(spark, "stream-containers")
    fields = ad.doc_fields(spark, sf_dir)
    half = F.pmod(F.xxhash64("file_path"), F.lit(2))
    for part in (0, 1):
        containers.write_containers(fields.where(half == part), f"{root}/in")
        stream = containers.stream_containers(spark, f"{root}/in", unique_keys(ad.REQUESTED_KEYS), settleSeconds="0")
        stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck") \
            .trigger(availableNow=True).start().awaitTermination()
    return _report(spark.read.schema(containers.FIELDS).parquet(f"{root}/out"))


def _vector_containers(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "vector-containers")
    containers.write_containers(ad.vec_instrument_fields(spark, sf_dir), root, chunk=CHUNK)
    return root


def _scanned(rows: DataFrame, name: str) -> DataFrame:
    """The rows of a scan, stored: the files are opened once, however often a query uses their rows."""
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _samples(spark: SparkSession, root: str) -> DataFrame:
    return _scanned(containers.read_containers(spark, root, SAMPLED_KEYS, SAMPLE_SIZE), "samples")


def sampled_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stride samples of the sampled keys: kept values, and an error for each scalar."""
    samples = _samples(spark, _vector_containers(spark, sf_dir))
    kept = sampling.sample_elements(samples).select(
        "file_path", "key", "n_values", "step", "chunks", "chunks_read", F.coalesce(F.col("pos").cast("bigint"), F.lit(-1)).alias("pos"), "value",
        F.lit(None).cast("string").alias("msg"))
    none = F.lit(-1).cast("bigint")
    files = samples.select("file_path").distinct()
    issues = sampling.sample_issues(files, samples, SAMPLED_KEYS).select(
        "file_path", "key", *[none.alias(c) for c in ("n_values", "step", "chunks", "chunks_read", "pos")],
        F.lit(None).cast("double").alias("value"), F.col("issue.msg").alias("msg"))
    return kept.unionByName(issues)


def _vector_ingest(spark: SparkSession, sf_dir: str) -> IngestResult:
    root = _vector_containers(spark, sf_dir)
    files = ad.vec_frames(spark, sf_dir).select(
        F.concat(F.lit("job-"), F.col("vec_id").cast("string")).alias("job_id"), "file_path", F.size("pixels").cast("bigint").alias("size"),
        F.lit(None).cast("timestamp").alias("mod_time"))
    fields = _scanned(containers.read_containers(spark, root, unique_keys(CATALOGUE_KEYS + SCIENTIFIC_KEYS)), "fields")
    return ingest_files(files, fields, thumbnails(ad.vec_frames(spark, sf_dir)), _samples(spark, root))


def ingest_vector_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end from container files: fields, stride samples inside the metadata, records."""
    ds = _vector_ingest(spark, sf_dir).datasets
    return ds.select("job_id", "pid", "owner", "creationLocation", "datasetName", "sourceFolder", "scientificMetadata",
                     safe_size("keywords").cast("bigint").alias("n_keywords"), "ownerGroup", F.array_join("accessGroups", ",").alias("accessGroups"))


def ingest_vector_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First frame, intensity, 8 bits, image, data URI, attachment record."""
    return _vector_ingest(spark, sf_dir).attachments.select("datasetId", "thumbnail", "caption", "ownerGroup",
                                                            F.array_join("accessGroups", ",").alias("accessGroups"))


def ingest_vector_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vector_ingest(spark, sf_dir).issues.select("job_id", "seq", "issue.severity", "issue.msg")


SCAN_QUERIES = {
    "container_fields": container_fields,
    "stream_container_fields": stream_container_fields,
    "sampled_fields": sampled_fields,
    "ingest_vector_datasets": ingest_vector_datasets,
    "ingest_vector_attachments": ingest_vector_attachments,
    "ingest_vector_issues": ingest_vector_issues,
}
