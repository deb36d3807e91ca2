"""Registered queries: (spark, sf_dir) -> DataFrame over the driver tables.

Each result is the report form of an operator: arrays are shown as joined
text or exploded rows and every computed column is aliased, so the same
query written in SQL (``plans.oracle``) can be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcat.functions.access import access_groups, owner_group
from fieldcat.functions.text import keywords, search_terms
from fieldcat.functions.values import mask_nonfinite, safe_size
from fieldcat.operators import catalog, fields as fld, jobs, quality, sampling
from fieldcat.plans import adapters as ad
from fieldcat.sources.tables import read_table


# --- catalogue -----------------------------------------------------------------

def dataset_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: one raw-dataset record per document 'file'."""
    ds = catalog.dataset_records(ad.instrument_metadata(spark, sf_dir))
    return ds.select(
        "pid", "owner", "contactEmail", "creationLocation", "datasetName", "type",
        "instrumentId", "proposalId", "dataFormat", "principalInvestigator", "sourceFolder",
        "size", "scientificMetadata", "sampleId", "isPublished", "description",
        safe_size("keywords").cast("bigint").alias("n_keywords"), "creationTime", "ownerGroup",
        F.array_join("accessGroups", ",").alias("accessGroups"))


def search_terms_documents(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return d.select("doc_id", search_terms("text").alias("terms"),
                    safe_size(keywords("text")).cast("bigint").alias("n_keywords"))


def search_terms_pages(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages", "page_id", "url")
    return p.select("page_id", search_terms("url").alias("terms"),
                    safe_size(keywords("url")).cast("bigint").alias("n_keywords"))


def access_controls(spark, sf_dir):
    m = ad.instrument_metadata(spark, sf_dir)
    return m.select("doc_id", owner_group("username", "proposal").alias("owner_group"),
                    F.array_join(access_groups("username", "beamline"), ",").alias("access_groups"),
                    F.size(access_groups("username", "beamline")).cast("bigint").alias("n_access_groups"))


# --- field table -------------------------------------------------------------------

def field_extract(spark, sf_dir):
    f = fld.select_fields(ad.doc_fields(spark, sf_dir, ad.REQUESTED_KEYS), ad.REQUESTED_KEYS)
    norm = fld.value_text(fld.normalise(f))
    return norm.select("file_path", "key", "value_kind", "value_text", "n_values")


def field_pivot(spark, sf_dir):
    f = fld.select_fields(ad.doc_fields(spark, sf_dir, ad.REQUESTED_KEYS), ad.REQUESTED_KEYS)
    return fld.pivot_fields(fld.value_text(fld.normalise(f)), ad.REQUESTED_KEYS)


def scientific_metadata(spark, sf_dir):
    """Per file, the requested keys as one strict-JSON object (F8)."""
    f = fld.select_fields(ad.doc_fields(spark, sf_dir, ad.REQUESTED_KEYS), ad.REQUESTED_KEYS)
    return fld.metadata_json(fld.normalise(f), ad.REQUESTED_KEYS)


def missing_key_issues(spark, sf_dir):
    iss = fld.missing_issues(ad.doc_files(spark, sf_dir).select("file_path"),
                             ad.doc_fields(spark, sf_dir, ad.REQUESTED_KEYS),
                             ad.REQUESTED_KEYS)
    return iss.select("file_path", "key", "key_seq", "issue.stage", "issue.severity", "issue.msg")


def _ingest_batch(spark, sf_dir):
    """Jobs of one ingest batch (one per document file) and their issues:
    unregistered mapping -> one error; otherwise the missing-key warnings."""
    files = ad.doc_files(spark, sf_dir)
    matched = jobs.match_registry(files.withColumn("job_id", F.concat(F.lit("job-"), F.col("doc_id").cast("string"))),
                                  ad.REGISTERED_SPECS, path_col="file_path")
    batch = matched.withColumn("dataset_id", F.when(F.col("registered"), F.sha2(F.col("file_path"), 256)))
    reg_err = batch.where(~F.col("registered")).select("job_id", F.lit(-1).alias("seq"), "issue")
    warn = (fld.missing_issues(batch.where(F.col("registered")).select("file_path", "job_id"),
                               ad.doc_fields(spark, sf_dir, ad.REQUESTED_KEYS), ad.REQUESTED_KEYS)
            .select("job_id", F.col("key_seq").alias("seq"), "issue"))
    return batch, reg_err.unionByName(warn)


def job_final_status(spark, sf_dir):
    batch, issues = _ingest_batch(spark, sf_dir)
    return jobs.final_status(batch, issues)


def job_log(spark, sf_dir):
    batch, issues = _ingest_batch(spark, sf_dir)
    return jobs.job_log(batch, issues)


def registry_match(spark, sf_dir):
    batch, _ = _ingest_batch(spark, sf_dir)
    return batch.select("job_id", "mapping_id", "registered", F.col("issue.msg").alias("error_msg"))


# --- sampling and cleaning -----------------------------------------------------------

def array_stride(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    e = e.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    return sampling.stride_elements(e, ["vec_id"], "embedding")


def row_stride(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    s = sampling.stride_rows(ev, order_by=["ts", "event_id"], partition_by=["user_id"])
    return s.select("user_id", "event_id", "ts", "event_type", "row_idx", "n")


def event_page_json(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type")
    s = sampling.stride_rows(ev, order_by=["ts", "event_id"], partition_by=["user_id"])
    # epoch milliseconds of the wall-clock time, independent of the session zone
    s = s.withColumn("ts", F.expr("timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
    return sampling.to_column_json(s, ["user_id"], "row_idx", ["event_id", "event_type", "ts"])


def _saturated(x):
    """|x| > 0.2 becomes +/-Inf and x in (-0.001, 0.001) becomes NaN."""
    x = x.cast("double")
    return (F.when(x > 0.2, F.lit(float("inf"))).when(x < -0.2, F.lit(float("-inf")))
            .when(F.abs(x) < 0.001, F.lit(float("nan"))).otherwise(x))


def nonfinite_mask(spark, sf_dir):
    """Element-wise masking in long form (scalar expressions, no lambda)."""
    from pyspark.sql import types as T
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    px = e.select("vec_id", F.posexplode("embedding").alias("pos", "x"))
    return px.select("vec_id", F.col("pos").cast("bigint").alias("pos"),
                     mask_nonfinite(_saturated(F.col("x")), T.DoubleType()).alias("value"))


# --- jobs over job events ------------------------------------------------------------

def _jobs(spark, sf_dir):
    return jobs.fold_jobs(ad.job_events(spark, sf_dir), tiebreak="event_id")


def job_current(spark, sf_dir):
    return _jobs(spark, sf_dir).drop("last_log")


def job_transitions(spark, sf_dir):
    t = jobs.transition_issues(ad.job_events(spark, sf_dir), tiebreak="event_id")
    return t.select("id", "event_id", "time", "prev_status", "status", F.col("issue.msg").alias("msg"))


def job_history(spark, sf_dir):
    h = jobs.job_history(ad.job_events(spark, sf_dir), tiebreak="event_id")
    return h.select("id", "pos", "history_len", "time", "status", "submitter", "event_id")


QUERIES = {
    "dataset_catalog": dataset_catalog,
    "search_terms_documents": search_terms_documents,
    "search_terms_pages": search_terms_pages,
    "access_controls": access_controls,
    "field_extract": field_extract,
    "field_pivot": field_pivot,
    "missing_key_issues": missing_key_issues,
    "scientific_metadata": scientific_metadata,
    "job_final_status": job_final_status,
    "job_log": job_log,
    "registry_match": registry_match,
    "array_stride": array_stride,
    "row_stride": row_stride,
    "event_page_json": event_page_json,
    "nonfinite_mask": nonfinite_mask,
    "job_current": job_current,
    "job_history": job_history,
    "job_transitions": job_transitions,
}


# --- job lookups, timeline --------------------------------------------------------

def job_lookup(spark, sf_dir):
    ids = read_table(spark, sf_dir, "customer", "c_custkey").select(
        F.concat(F.lit("job-"), F.col("c_custkey").cast("string")).alias("id"))
    return jobs.lookup_events(ad.job_events(spark, sf_dir), ids, tiebreak="event_id")


def unstarted_jobs(spark, sf_dir):
    return jobs.unstarted(_jobs(spark, sf_dir)).select("id", "submit_time", "submitter", "status_time")


def next_job(spark, sf_dir):
    return jobs.next_jobs(_jobs(spark, sf_dir), n=1).select("id", "submit_time", "submitter")


def pending_terminal(spark, sf_dir):
    return jobs.phase(_jobs(spark, sf_dir)).select("id", "status", "phase")


def _batch_history(spark, sf_dir):
    """History items of the ingest batch: running, then the final status
    with its log (the submitted item carries no log)."""
    batch, issues = _ingest_batch(spark, sf_dir)
    final = jobs.final_status(batch, issues).join(jobs.job_log(batch, issues), "job_id")
    running = batch.select("job_id", F.lit(2).cast("bigint").alias("pos"),
                           F.lit("running").alias("status"), F.lit("Starting job").alias("log"))
    done = final.select("job_id", F.lit(3).cast("bigint").alias("pos"), "status", "log")
    return running.unionByName(done).withColumn("time", F.lit(None).cast("timestamp"))


def status_timeline(spark, sf_dir):
    t = jobs.status_timeline(_batch_history(spark, sf_dir), key="job_id")
    return t.select("job_id", "pos", "status", "line_no", "line")


# --- admission, quality, orphans ------------------------------------------------------

def admitted_requests(spark, sf_dir):
    acc, _ = jobs.admit(ad.job_requests(spark, sf_dir), ad.clients(spark, sf_dir))
    return acc.select("id", "submitter", "document_path", "mapping_id", "submit_time")


def job_submissions(spark, sf_dir):
    """The first status event (submitted) of every admitted request."""
    acc, _ = jobs.admit(ad.job_requests(spark, sf_dir), ad.clients(spark, sf_dir))
    return jobs.initial_events(acc)


def rejected_requests(spark, sf_dir):
    _, rej = jobs.admit(ad.job_requests(spark, sf_dir), ad.clients(spark, sf_dir))
    return rej.select("id", "document_path", "submit_time")


def duplicate_ids(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    return quality.duplicate_ids(li, ["l_orderkey", "l_linenumber"])


def registry_first_wins(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type")
    return quality.first_wins(p, "p_brand", ["p_partkey"])


def orphan_events(spark, sf_dir):
    acc, _ = jobs.admit(ad.job_requests(spark, sf_dir), ad.clients(spark, sf_dir))
    li = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_linestatus")
    events = li.select(F.concat(F.lit("req-"), F.col("l_orderkey").cast("string")).alias("id"),
                       "l_orderkey", "l_linenumber", "l_linestatus")
    return jobs.orphan_events(events, acc.select("id"))


def orphan_children(spark, sf_dir):
    """Datablocks written for every file; datasets only for registered jobs."""
    batch, _ = _ingest_batch(spark, sf_dir)
    blocks = catalog.data_files(ad.doc_files(spark, sf_dir).withColumn("mod_time", F.lit(None).cast("timestamp")))
    blocks = blocks.select("file_path", F.sha2("file_path", 256).alias("datasetId"))
    datasets = batch.where("registered").select(F.col("dataset_id").alias("pid"))
    return catalog.orphans(blocks, datasets, "datasetId", "pid")


# --- access -------------------------------------------------------------------------

def visible_datasets(spark, sf_dir):
    from fieldcat.operators.access import visible
    return visible(ad.order_datasets(spark, sf_dir), ad.supplier_users(spark, sf_dir))


def access_grants(spark, sf_dir):
    """Every record's groups: the linear form of visibility."""
    from fieldcat.operators.access import grants
    return grants(ad.order_datasets(spark, sf_dir))


def group_reach(spark, sf_dir):
    from fieldcat.operators.access import group_reach as reach
    return reach(ad.order_datasets(spark, sf_dir))


def job_record(spark, sf_dir):
    """Customers' ingest requests with their state and ordered history."""
    c = read_table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    reqs = c.select(F.concat(F.lit("job-"), F.col("c_custkey").cast("string")).alias("id"),
                    F.col("c_name").alias("submitter"), F.col("c_mktsegment").alias("mapping_id"))
    r = jobs.job_records(reqs, ad.job_events(spark, sf_dir), tiebreak="event_id")
    return r.select("id", "submitter", "mapping_id", "status", "status_time", "start_time", "end_time",
                    F.coalesce("n_events", F.lit(0)).alias("n_events"), F.coalesce("pos", F.lit(0)).alias("pos"), "item_time", "item_status", "item_actor")


def share_routing(spark, sf_dir):
    from fieldcat.operators.access import route_shares
    r = route_shares(ad.order_datasets(spark, sf_dir), ad.shares(spark, sf_dir))
    return r.select("pid", "proposal", "share_folder", "routed", F.col("issue.msg").alias("error_msg"))


QUERIES.update({
    "job_lookup": job_lookup,
    "unstarted_jobs": unstarted_jobs,
    "next_job": next_job,
    "pending_terminal": pending_terminal,
    "status_timeline": status_timeline,
    "admitted_requests": admitted_requests,
    "rejected_requests": rejected_requests,
    "job_submissions": job_submissions,
    "duplicate_ids": duplicate_ids,
    "registry_first_wins": registry_first_wins,
    "orphan_events": orphan_events,
    "orphan_children": orphan_children,
    "visible_datasets": visible_datasets,
    "share_routing": share_routing,
    "access_grants": access_grants,
    "group_reach": group_reach,
    "job_record": job_record,
})


# --- frames ---------------------------------------------------------------------------

def frame_intensity_q(spark, sf_dir):
    from fieldcat.operators import frames as fr
    f = fr.intensity_pixels(ad.vec_frames(spark, sf_dir), ["vec_id"])
    return f.select("vec_id", "pos", F.round("intensity", 6).alias("intensity"))


def frame_stats_q(spark, sf_dir):
    from fieldcat.operators import frames as fr
    return fr.frame_stats(ad.vec_frames(spark, sf_dir)).select("vec_id", "frame_min", "frame_max")


def contrast_stretch_q(spark, sf_dir):
    from fieldcat.operators import frames as fr
    out = fr.contrast_stretch(ad.quantity_pixels(spark, sf_dir), ["l_returnflag", "l_linestatus"], "v")
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "v",
                      "lo", "hi", "stretched")


def first_frames_q(spark, sf_dir):
    from fieldcat.operators import frames as fr
    return fr.first_frames(ad.conversation_frames(spark, sf_dir), n=1).select(
        "conv_id", "frame_idx", "role", "text")


# --- mapping-driven documents ----------------------------------------------------------

def _doc_norm(spark, sf_dir, mapping):
    keys = mapping.keys("md", "conf")
    f = fld.select_fields(ad.doc_fields(spark, sf_dir, keys), keys)
    return fld.value_text(fld.normalise(f)).select("file_path", "key", "value_text")


def mapping_start(spark, sf_dir):
    from fieldcat.operators.mapping import start_docs
    from fieldcat.sources.mapping import packaged_mapping
    m = packaged_mapping(spark)
    return start_docs(_doc_norm(spark, sf_dir, m), m).select("file_path", "field", "value_text")


def mapping_config(spark, sf_dir):
    from fieldcat.operators.mapping import config_docs
    from fieldcat.sources.mapping import packaged_mapping
    m = packaged_mapping(spark)
    return config_docs(_doc_norm(spark, sf_dir, m), m).select("file_path", "stream", "device", "field",
                                                              "value_text")


def mapping_events(spark, sf_dir):
    from fieldcat.operators.mapping import event_rows
    from fieldcat.sources.mapping import packaged_mapping
    rows, _ = event_rows(ad.vec_fields(spark, sf_dir), packaged_mapping(spark))
    return rows


def mapping_event_issues(spark, sf_dir):
    from fieldcat.operators.mapping import event_rows
    from fieldcat.sources.mapping import packaged_mapping
    _, issues = event_rows(ad.vec_fields(spark, sf_dir), packaged_mapping(spark))
    return issues.select("file_path", "field", "issue.severity", "issue.msg")


def mapping_projection(spark, sf_dir):
    from fieldcat.operators.mapping import project
    from fieldcat.sources.mapping import packaged_mapping
    m = packaged_mapping(spark)
    keys = m.keys("projection")
    norm = fld.value_text(fld.normalise(fld.select_fields(ad.doc_fields(spark, sf_dir, keys), keys)))
    return project(norm.select("file_path", "key", "value_text"), m)


def mapping_external(spark, sf_dir):
    from fieldcat.operators.mapping import external_refs
    from fieldcat.sources.mapping import packaged_mapping
    frames = ad.vec_frames(spark, sf_dir).withColumn("key", F.lit("/vec/frame"))
    return external_refs(frames, packaged_mapping(spark))


# --- files ------------------------------------------------------------------------------

def _inventory(spark, sf_dir):
    from fieldcat.sources.files import scan_files
    inv = scan_files(spark, sf_dir, glob="*.parquet")
    return inv.withColumn("file_path", F.regexp_replace("file_path", "^file:", "")) \
              .withColumn("folder", F.regexp_replace("folder", "^file:", ""))


def file_inventory(spark, sf_dir):
    inv = _inventory(spark, sf_dir)
    return inv.select("file_path", "file_name", "folder", "size",
                      F.unix_timestamp("mod_time").alias("mod_epoch"))


def datablocks_q(spark, sf_dir):
    inv = _inventory(spark, sf_dir)
    blocks = catalog.data_files(inv)
    out = blocks.join(inv.select("file_path", "size"), "file_path").select(
        F.sha2("file_path", 256).alias("datasetId"), F.col("size").alias("size"),
        F.size("dataFileList").cast("bigint").alias("n_files"),
        F.col("dataFileList")[0]["path"].alias("df_path"),
        F.col("dataFileList")[0]["size"].alias("df_size"),
        F.col("dataFileList")[0]["type"].alias("df_type"))
    return out


def attachments_q(spark, sf_dir):
    from fieldcat.functions.files import data_uri
    p = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return p.select("page_id", F.sha2("url", 256).alias("datasetId"),
                    data_uri(F.encode("html", "UTF-8")).alias("thumbnail"),
                    F.lit("raw image").alias("caption"))


QUERIES.update({
    "frame_intensity": frame_intensity_q,
    "frame_stats": frame_stats_q,
    "contrast_stretch": contrast_stretch_q,
    "first_frames": first_frames_q,
    "mapping_start": mapping_start,
    "mapping_config": mapping_config,
    "mapping_events": mapping_events,
    "mapping_event_issues": mapping_event_issues,
    "mapping_projection": mapping_projection,
    "mapping_external": mapping_external,
    "file_inventory": file_inventory,
    "datablocks": datablocks_q,
    "attachments": attachments_q,
})

from fieldcat.plans.ingest import INGEST_QUERIES  # noqa: E402
from fieldcat.plans.streaming_queries import STREAM_QUERIES  # noqa: E402

QUERIES.update(INGEST_QUERIES)
QUERIES.update(STREAM_QUERIES)
from fieldcat.plans.scan_queries import SCAN_QUERIES  # noqa: E402

QUERIES.update(SCAN_QUERIES)


# --- bitmaps and layouts --------------------------------------------------------------------

#: Buckets and files of the staged tables.
EVENT_BUCKETS, CLUSTER_FILES = 16, 16


def user_reach(spark, sf_dir):
    """How many records each user may see and change, without pairs of user and record."""
    from fieldcat.operators.access import user_reach as reach
    return reach(ad.order_datasets(spark, sf_dir), ad.supplier_users(spark, sf_dir))


def job_lookup_indexed(spark, sf_dir):
    """The look-up of every customer's job over events stored by job."""
    from fieldcat.operators import layout
    from fieldcat.session import scratch_dir
    table = layout.write_events_by_job(ad.job_events(spark, sf_dir), scratch_dir(spark, "events-by-job"), EVENT_BUCKETS)
    ids = read_table(spark, sf_dir, "customer", "c_custkey").select(F.concat(F.lit("job-"), F.col("c_custkey").cast("string")).alias("id"))
    return layout.lookup_indexed(spark, table, ids, tiebreak="event_id")


def clustered_events(spark, sf_dir):
    """Events stored along a curve of time and user, read by a range of either."""
    from fieldcat.operators import layout
    from fieldcat.session import scratch_dir
    path = scratch_dir(spark, "clustered-events")
    ev = read_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    layout.write_clustered(ev, path, ["ts", "user_id"], CLUSTER_FILES)
    stored = spark.read.schema(ev.schema).parquet(path)
    week = stored.where((F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz")) & (F.col("ts") < F.lit("2024-01-10").cast("timestamp_ntz")))
    users = stored.where(F.col("user_id").between(40, 60))
    count = [F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")]
    return week.groupBy(F.lit("time").alias("by"), "event_type").agg(*count).unionByName(
        users.groupBy(F.lit("user").alias("by"), "event_type").agg(*count))


QUERIES.update({
    "user_reach": user_reach,
    "job_lookup_indexed": job_lookup_indexed,
    "clustered_events": clustered_events,
})


# --- functions that no other query reaches ------------------------------------------------------

def widened_values(spark, sf_dir):
    """Embeddings widened to 64 bits (F7), element by element."""
    from fieldcat.functions.values import widen
    e = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    kind = {f.name: f.dataType for f in e.schema.fields}
    return e.select("vec_id", widen("label", kind["label"]).alias("label"),
                    F.posexplode(widen("embedding", kind["embedding"])).alias("pos", "value")).withColumn("pos", F.col("pos").cast("bigint"))


def job_log_lines(spark, sf_dir):
    """Logs with both kinds of line ends (F17): the newline and the two characters backslash-n."""
    events = ad.job_events(spark, sf_dir).withColumn("log", F.concat(
        F.lit("status "), F.col("status"), F.lit("\\nby "), F.col("submitter"), F.lit("\n"), F.coalesce("log", F.lit(""))))
    history = events.select("id", F.col("event_id").alias("pos"), "time", "status", "log")
    return jobs.status_timeline(history).select("id", "pos", F.col("line_no").cast("bigint").alias("line_no"), "line")


def renamed_fields(spark, sf_dir):
    """Field rows whose keys came with colons (P10)."""
    colons = fld.rename_keys(ad.doc_fields(spark, sf_dir, ad.REQUESTED_KEYS), "/", ":")
    norm = fld.value_text(fld.normalise(fld.select_fields(fld.rename_keys(colons), ad.REQUESTED_KEYS)))
    return norm.select("file_path", "key", "value_kind", "value_text", "n_values")


def mapping_linked(spark, sf_dir):
    """Linked projections (P11): which frames a file's image data is."""
    from fieldcat.operators.mapping import linked
    from fieldcat.sources.mapping import packaged_mapping
    return linked(ad.vec_frames(spark, sf_dir).withColumn("key", F.lit("/vec/frame")), packaged_mapping(spark))


def overdue_jobs(spark, sf_dir):
    """Unfinished jobs that no client waits for any more (F15)."""
    return jobs.overdue(_jobs(spark, sf_dir)).select("id", "status", "status_time")


def container_inventory(spark, sf_dir):
    """The inventory (S1) of the documents' files, staged as containers."""
    from fieldcat.session import scratch_dir
    from fieldcat.sources.containers import write_containers
    from fieldcat.sources.files import scan_files
    root = scratch_dir(spark, "inventory")
    write_containers(ad.doc_fields(spark, sf_dir, ["/doc/lang"]), root)
    inv = scan_files(spark, root, glob="*.npz", recursive=True)
    at = F.expr("instr(folder, '/data/')")
    return inv.select("file_name", F.expr("substring(folder, instr(folder, '/data/'))").alias("folder"), (F.col("size") > 0).alias("filled")).where(at > 0)


def stored_records(spark, sf_dir):
    """Data blocks and attachments as stored tables (S8, S9): sorted by owner and
    dataset inside each file, read back and linked."""
    from fieldcat.operators.sinks import write_table
    from fieldcat.plans.ingest import _ingested
    from fieldcat.session import scratch_dir
    root, res = scratch_dir(spark, "stored"), _ingested(spark, sf_dir)
    write_table(res.datablocks, f"{root}/datablocks", sort_within=["ownerGroup", "datasetId"])
    write_table(res.attachments, f"{root}/attachments", sort_within=["ownerGroup", "datasetId"])
    blocks = spark.read.parquet(f"{root}/datablocks").select("datasetId", "size", F.col("dataFileList")[0]["path"].alias("df_path"), "ownerGroup")
    images = spark.read.parquet(f"{root}/attachments").select("datasetId", "thumbnail", "caption")
    return blocks.join(images, "datasetId")


QUERIES.update({
    "widened_values": widened_values,
    "job_log_lines": job_log_lines,
    "renamed_fields": renamed_fields,
    "mapping_linked": mapping_linked,
    "overdue_jobs": overdue_jobs,
    "container_inventory": container_inventory,
    "stored_records": stored_records,
})
