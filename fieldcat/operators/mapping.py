"""Mapping-driven documents (P11-P15): start documents, per-device
configuration, one event row per time stamp, external references and
projections. The mapping tables are tiny and fixed, so they are broadcast
into equi-joins on the field key; the field table is never crossed with
anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcat.functions.issues import issue
from fieldcat.functions.values import safe_size
from fieldcat.operators.fields import column_name
from fieldcat.schemas import SEVERITY_WARNING
from fieldcat.sources.mapping import Mapping


def start_docs(norm_text: DataFrame, mapping: Mapping) -> DataFrame:
    """(file_path, field, value_text) for every metadata field a file has."""
    md = F.broadcast(mapping.md_fields.select(F.col("field").alias("key"), "seq"))
    return norm_text.join(md, "key").select("file_path", F.col("key").alias("field"), "value_text", "seq")


def start_doc_json(start: DataFrame) -> DataFrame:
    """One JSON object per file (bounded: one entry per mapped field)."""
    entries = F.array_sort(F.collect_list(F.struct("seq", "field", "value_text")))
    return (start.groupBy("file_path").agg(entries.alias("_e"))
            .select("file_path", F.to_json(F.map_from_entries(
                F.transform("_e", lambda e: F.struct(e["field"], e["value_text"])))).alias("start_doc")))


def config_docs(norm_text: DataFrame, mapping: Mapping) -> DataFrame:
    """(file_path, stream, device, field, value_text) per configured field."""
    conf = F.broadcast(mapping.conf_fields.select("stream", "device", F.col("field").alias("key"), "seq"))
    return norm_text.join(conf, "key").select("file_path", "stream", "device",
                                              F.col("key").alias("field"), "value_text", "seq")


def _numeric(c_int, c_dbl):
    return F.coalesce(c_dbl, c_int.cast("array<double>"))


def event_rows(fields: DataFrame, mapping: Mapping, stream: str = "primary",
               stage: str = "events") -> tuple[DataFrame, DataFrame]:
    """One row per time stamp of every file, with one column per mapped
    (non-external) numeric event field, and warning issues for fields whose
    length differs from the time stamps. Each file's arrays sit in one row
    (bounded by the file's own array lengths); keys outside the mapping are
    filtered next to the scan."""
    ts_key = mapping.keys("time_stamp", stream=stream)[0]
    ev = mapping.keys("event", stream=stream)
    keys = [ts_key] + [k for k in ev if k != ts_key]
    arr = _numeric(F.col("int_values"), F.col("dbl_values"))
    per_file = (fields.where(F.col("key").isin(keys)).groupBy("file_path")
                .agg(*[F.first(F.when(F.col("key") == k, arr), ignorenulls=True).alias(column_name(k))
                       for k in keys]))
    ts_col = column_name(ts_key)
    others = [column_name(k) for k in keys[1:]]
    n_ts = safe_size(ts_col)
    # arrays_zip pads the shorter arrays with nulls up to the longest one;
    # positions past the last time stamp are dropped
    rows = (per_file.where(F.col(ts_col).isNotNull())
            .select("file_path", n_ts.alias("_n_ts"),
                    F.posexplode(F.arrays_zip(F.col(ts_col), *[
                        F.coalesce(F.col(c), F.array().cast("array<double>")).alias(c) for c in others]))
                    .alias("seq", "z"))
            .where(F.col("seq") < F.col("_n_ts"))
            .select("file_path", F.col("seq").cast("bigint").alias("seq"),
                    F.col("z")[ts_col].alias("time_stamp"), *[F.col("z")[c].alias(c) for c in others]))
    issues = (per_file.where(F.col(ts_col).isNotNull())
              .select("file_path", F.explode(F.array(*[
                  F.struct(F.lit(k).alias("field"), safe_size(column_name(k)).alias("n"))
                  for k in keys[1:]])).alias("f"), n_ts.alias("n_ts"))
              .where(F.col("f.n").isNotNull() & (F.col("f.n") != F.col("n_ts")))
              .select("file_path", F.col("f.field").alias("field"),
                      issue(SEVERITY_WARNING, F.concat(
                          F.lit("length of "), F.col("f.field"), F.lit(" ("), F.col("f.n").cast("string"),
                          F.lit(") differs from time stamps ("), F.col("n_ts").cast("string"), F.lit(")")),
                          stage).alias("issue")))
    return rows, issues


def external_refs(frames: DataFrame, mapping: Mapping, stream: str = "primary",
                  file_col: str = "file_path", frame_col: str = "frame_idx") -> DataFrame:
    """(file_path, key, frame_idx) for every frame of an external field:
    where the data lives, never the pixels. ``frames`` names each frame's
    field in ``key``; a frame belongs to that field only."""
    ext = mapping.keys("external", stream=stream)
    return (frames.where(F.col("key").isin(ext)) if ext else frames.where(F.lit(False))).select(
        F.col(file_col).alias("file_path"), "key", F.col(frame_col).alias("frame_idx"))


def project(norm_text: DataFrame, mapping: Mapping, location: str = "start") -> DataFrame:
    """(file_path, projection, out_name, field, value_text) for projections
    at ``location`` whose field the file carries ('/'-separated keys)."""
    p = F.broadcast(mapping.projections.where(F.col("location") == location)
                    .select("projection", "out_name", F.col("field").alias("key")))
    return norm_text.join(p, "key").select("file_path", "projection", "out_name",
                                           F.col("key").alias("field"), "value_text")


def linked(frames: DataFrame, mapping: Mapping, stream: str = "primary") -> DataFrame:
    """(file_path, projection, out_name, field, n_frames): what a linked projection of ``stream``
    points at in each file that holds its external field, never the pixels."""
    wanted = mapping.projections.where((F.col("type") == "linked") & (F.col("stream") == stream) & F.col("resolved"))
    links = F.array(*[F.struct(F.lit(r.field).alias("field"), F.lit(r.projection).alias("projection"), F.lit(r.out_name).alias("out_name"))
                      for r in sorted(wanted.collect())])  # a mapping document's few rows
    held = external_refs(frames, mapping, stream).groupBy("file_path", "key").agg(F.count(F.lit(1)).alias("n_frames"))
    if not mapping.keys("external", stream=stream) or wanted.isEmpty():
        return held.select("file_path", *[F.lit(None).cast("string").alias(c) for c in ("projection", "out_name", "field")], "n_frames").where(F.lit(False))
    return held.select("*", F.explode(links).alias("p")).where(F.col("p.field") == F.col("key")).select(
        "file_path", "p.projection", "p.out_name", "p.field", "n_frames")


def unresolved_projections(mapping: Mapping) -> DataFrame:
    """Projection rows naming a field the mapping does not declare."""
    return mapping.projections.where(~F.col("resolved"))
