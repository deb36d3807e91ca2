"""The document ingestor: the registry plug-in that turns requests for
document 'files' into dataset records and missing-key issues."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcat.functions.issues import issue
from fieldcat.functions.values import safe_size
from fieldcat.operators import catalog, fields as fld, sampling
from fieldcat.operators.registry import IngestResult, Registry
from fieldcat.plans import adapters as ad
from fieldcat.sources.tables import read_table
from fieldcat.schemas import CATALOGUE_KEYS, SAMPLED_KEYS, SCIENTIFIC_KEYS, SEVERITY_ERROR


@dataclass
class DocContext:
    spark: SparkSession
    sf_dir: str


def ingest_documents(jobs: DataFrame, ctx: DocContext) -> IngestResult:
    """Ingest the documents of a set of jobs. When the jobs carry ``doc_id``
    the document scans are narrowed to the batch's id range (two numbers
    from the driver), which parquet min/max statistics turn into skipped
    row groups; the semi-joins then keep exactly the batch's files."""
    files = jobs.select("job_id", F.col("document_path").alias("file_path"))
    meta = ad.instrument_metadata(ctx.spark, ctx.sf_dir)
    fields = ad.doc_fields(ctx.spark, ctx.sf_dir, ad.REQUESTED_KEYS, with_doc_id=True)
    if "doc_id" in jobs.columns:
        lo, hi = jobs.agg(F.min("doc_id"), F.max("doc_id")).first()
        if lo is not None:
            meta = meta.where(F.col("doc_id").between(lo, hi))
            fields = fields.where(F.col("doc_id").between(lo, hi))
    meta = meta.join(files, "file_path")
    datasets = catalog.dataset_records(meta, carry=("job_id",))
    fields = fields.drop("doc_id").join(files.select("file_path"), "file_path", "left_semi")
    issues = (fld.missing_issues(files, fields, ad.REQUESTED_KEYS)
              .select("job_id", F.col("key_seq").alias("seq"), "issue"))
    return IngestResult(datasets, issues)


def doc_registry() -> Registry:
    reg = Registry()
    for spec in ad.REGISTERED_SPECS:
        reg.register(spec, ingest_documents)
    return reg


def doc_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = ad.doc_files(spark, sf_dir)
    return files.select(F.concat(F.lit("job-"), F.col("doc_id").cast("string")).alias("job_id"),
                        F.col("file_path").alias("document_path"), "mapping_id", "doc_id")


# --- end to end: field table -> linked records -------------------------------------------

def ingest_files(files: DataFrame, fields: DataFrame, images: DataFrame, samples: DataFrame | None = None) -> IngestResult:
    """One pass from extracted fields to linked catalogue records. ``files``:
    job_id, file_path, size, mod_time; ``fields``: the long field table;
    ``images``: file_path, content; ``samples``: the stride samples of the
    files' arrays (``SAMPLES``), of which the sampled keys join the metadata
    as ``data_sample`` (K3) and scalars give errors.

    Requested keys are normalised (P1, P2); the catalogue keys become the
    dataset's columns, the scientific keys its strict-JSON metadata (F6, F8);
    the data block and the attachment carry the dataset's id and owner
    columns (P6); absent keys give warnings, a file without a name an error."""
    name = fld.column_name
    keys = CATALOGUE_KEYS + SCIENTIFIC_KEYS
    norm = fld.normalise(fld.select_fields(fields, keys))
    wide = fld.pivot_fields(fld.value_text(fld.select_fields(norm, CATALOGUE_KEYS)), CATALOGUE_KEYS, files=files)
    science = fld.metadata_json(norm, SCIENTIFIC_KEYS, out="scientific_metadata", files=files)
    scalars = None
    if samples is not None:
        kept = sampling.sample_json(samples, SAMPLED_KEYS)
        joint = F.when(F.col("scientific_metadata") == "{}", F.lit("{")).otherwise(
            F.concat(F.expr("left(scientific_metadata, length(scientific_metadata) - 1)"), F.lit(",")))
        science = science.join(kept, "file_path", "left").select("file_path", F.concat(
            joint, F.lit('"data_sample":'), F.coalesce("data_sample", F.lit("{}")), F.lit("}")).alias("scientific_metadata"))
        scalars = sampling.sample_issues(files.select("file_path", "job_id"), samples, SAMPLED_KEYS).select(
            "job_id", (F.col("key_seq") + len(CATALOGUE_KEYS)).alias("seq"), "issue")
    short = {k: F.col(name(k)) for k in CATALOGUE_KEYS}
    at = "/measurement/sample/"
    meta = files.join(wide, "file_path").join(science, "file_path").select(
        "job_id", "file_path", "size", "mod_time", short[at + "file_name"].alias("file_name"),
        short[at + "experiment/pi"].alias("pi"), short[at + "experimenter/email"].alias("email"),
        short["/measurement/instrument/instrument_name"].alias("instrument_name"),
        short[at + "experiment/proposal"].alias("proposal"), short[at + "experiment/beamline"].alias("beamline"),
        short[at + "experimenter/name"].alias("username"), "scientific_metadata")
    named = meta.where(F.col("file_name").isNotNull())
    datasets = catalog.dataset_records(named, carry=("job_id",))
    unnamed = meta.where(F.col("file_name").isNull()).select(
        "job_id", F.lit(-1).alias("seq"), issue(SEVERITY_ERROR, "file has no name", "ingest").alias("issue"))
    absent = fld.missing_issues(files.select("file_path", "job_id"), fields, CATALOGUE_KEYS).select(
        "job_id", F.col("key_seq").alias("seq"), "issue")
    issues = unnamed.unionByName(absent)
    return IngestResult(datasets, issues if scalars is None else issues.unionByName(scalars), catalog.datablocks(files, datasets),
                        catalog.attachments(images, datasets))


def document_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' metadata under the instrument's own keys; absent values
    are absent rows."""
    m = ad.instrument_metadata(spark, sf_dir)
    at = "/measurement/sample/"
    text = {"/measurement/instrument/instrument_name": "instrument_name", at + "experiment/beamline": "beamline",
            at + "experiment/pi": "pi", at + "experiment/proposal": "proposal", at + "experimenter/email": "email",
            at + "experimenter/name": "username", at + "file_name": "file_name"}
    none, scalar = F.lit(None), F.array().cast("array<bigint>")
    rows = [F.when(F.col(c).isNotNull(), F.struct(
        F.lit(k).alias("key"), F.lit("S").alias("kind"), F.array(F.col(c)).alias("str_values"),
        none.cast("array<bigint>").alias("int_values"), none.cast("array<double>").alias("dbl_values"))) for k, c in text.items()]
    rows.append(F.struct(F.lit("/measurement/instrument/detector/binning_x").alias("key"), F.lit("i").alias("kind"),
                         none.cast("array<string>").alias("str_values"), F.array(F.col("size").cast("bigint")).alias("int_values"),
                         none.cast("array<double>").alias("dbl_values")))
    rows.append(F.struct(F.lit("/measurement/instrument/detector/dark_field_value").alias("key"), F.lit("f").alias("kind"),
                         none.cast("array<string>").alias("str_values"), none.cast("array<bigint>").alias("int_values"),
                         F.array(F.when(F.col("size") > 5000, F.lit(float("inf"))).otherwise(F.lit(0.5))).alias("dbl_values")))
    return m.select("file_path", F.explode(F.array_compact(F.array(*rows))).alias("f")).select(
        "file_path", "f.key", "f.kind", scalar.alias("shape"), scalar.alias("maxshape"), "f.str_values", "f.int_values", "f.dbl_values")


def _ingested(spark: SparkSession, sf_dir: str) -> IngestResult:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "lang", "source", "n_chars")
    files = docs.select(F.concat(F.lit("job-"), F.col("doc_id").cast("string")).alias("job_id"), ad.doc_file_path().alias("file_path"),
                        F.col("n_chars").alias("size"),
                        F.expr("timestamp_seconds(1577836800 + doc_id * 3600) + make_interval(0, 0, 0, 0, 0, 0, if(doc_id % 2 = 0, 0.25, 0))").alias("mod_time"))
    images = docs.select(ad.doc_file_path().alias("file_path"), F.encode(F.concat("lang", F.lit(":"), "source"), "UTF-8").alias("content"))
    return ingest_files(files, document_fields(spark, sf_dir), images)


def ingest_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = _ingested(spark, sf_dir).datasets
    return ds.select("job_id", "pid", "owner", "contactEmail", "creationLocation", "proposalId", "principalInvestigator",
                     "sourceFolder", "size", "scientificMetadata", safe_size("keywords").cast("bigint").alias("n_keywords"),
                     "creationTime", "ownerGroup", F.array_join("accessGroups", ",").alias("accessGroups"))


def ingest_datablocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.col("dataFileList")[0]
    return _ingested(spark, sf_dir).datablocks.select(
        "datasetId", "size", first["path"].alias("df_path"), first["time"].alias("df_time"), first["type"].alias("df_type"),
        "ownerGroup", F.array_join("accessGroups", ",").alias("accessGroups"))


def ingest_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir).attachments.select(
        "datasetId", "thumbnail", "caption", "ownerGroup", F.array_join("accessGroups", ",").alias("accessGroups"))


def ingest_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingested(spark, sf_dir).issues.select("job_id", "seq", "issue.severity", "issue.msg")


INGEST_QUERIES = {
    "ingest_datasets": ingest_datasets,
    "ingest_datablocks": ingest_datablocks,
    "ingest_attachments": ingest_attachments,
    "ingest_issues": ingest_issues,
}
