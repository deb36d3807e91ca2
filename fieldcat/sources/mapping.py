"""Mapping document source (S4): a declarative field mapping, read with a
declared schema (no inference) and exploded into small tables."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcat.functions.text import renamed
FIELD = "struct<field:string,external:boolean>"
MAPPING_SCHEMA = (
    "name string, description string, version string, resource_spec string, "
    "md_mappings array<struct<field:string,description:string>>, "
    "stream_mappings map<string,struct<time_stamp:string,"
    "thumbnail_info:struct<number:int,field:string>,"
    f"conf_mappings:array<struct<device:string,mapping_fields:array<{FIELD}>>>,"
    f"mapping_fields:array<{FIELD}>>>, "
    "projections array<struct<name:string,configuration:map<string,string>,"
    "projection:map<string,struct<type:string,location:string,stream:string,field:string>>>>"
)

RESOURCE_DIR = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "resources")


@dataclass
class Mapping:
    """Exploded mapping tables (each a few rows; safe to broadcast)."""
    md_fields: DataFrame        # name, field, seq
    conf_fields: DataFrame      # name, stream, device, field, seq
    event_fields: DataFrame     # name, stream, field, external, seq
    streams: DataFrame          # name, stream, time_stamp, thumb_number, thumb_field
    projections: DataFrame      # name, projection, out_name, type, location, stream, field, resolved

    @cached_property
    def fields(self) -> dict[str, list]:
        """The mapping's field lists, read to the driver once (a mapping is a
        configuration document of a few dozen rows): ``md``, ``conf``,
        ``event``, ``external``, ``projection`` (fields) and ``time_stamp``
        (stream -> key)."""
        nul = F.lit(None).cast("string")
        rows = (self.md_fields.select(F.lit("md").alias("t"), nul.alias("stream"), "field", "seq")
                .unionByName(self.conf_fields.select(F.lit("conf").alias("t"), "stream", "field", "seq"))
                .unionByName(self.event_fields.select(
                    F.when(F.col("external"), F.lit("external")).otherwise(F.lit("event")).alias("t"),
                    "stream", "field", "seq"))
                .unionByName(self.streams.select(F.lit("time_stamp").alias("t"), "stream",
                                                 F.col("time_stamp").alias("field"), F.lit(0).alias("seq")))
                .unionByName(self.projections.select(F.lit("projection").alias("t"), "stream", "field",
                                                     F.lit(0).alias("seq")))
                .collect())
        out: dict[str, list] = {"md": [], "conf": [], "event": [], "external": [], "projection": [],
                                "time_stamp": []}
        for r in sorted(rows, key=lambda r: (r.t, r.seq, r.field or "")):
            out[r.t].append((r.stream, r.field))
        return out

    def keys(self, *kinds: str, stream: str | None = None) -> list[str]:
        return list(dict.fromkeys(f for k in kinds for s, f in self.fields[k]
                                  if f is not None and (stream is None or s in (stream, None))))


def load_mapping(spark: SparkSession, path: str) -> Mapping:
    """A mapping JSON document on shared storage."""
    doc = spark.read.schema(MAPPING_SCHEMA).option("multiLine", True).json(path)
    return explode_mapping(doc)


def mapping_from_text(spark: SparkSession, text: str) -> Mapping:
    """A mapping document held by the driver (a small configuration file):
    parsed in Python, its few rows become local tables - no Spark job runs
    to build them. Same tables as ``explode_mapping`` (tested)."""
    d = json.loads(text)
    name = d.get("name")

    def first_pos(rows, key):
        seen = {}
        for r in rows:
            k = key(r)
            if k not in seen:
                seen[k] = r
        return list(seen.values())

    md = first_pos([(name, m.get("field"), i) for i, m in enumerate(d.get("md_mappings") or [])],
                   lambda r: r[1])
    streams, conf, ev = [], [], []
    for stream, s in (d.get("stream_mappings") or {}).items():
        thumb = s.get("thumbnail_info") or {}
        streams.append((name, stream, s.get("time_stamp"), thumb.get("number"), thumb.get("field")))
        for c in s.get("conf_mappings") or []:
            conf += first_pos([(name, stream, c.get("device"), f.get("field"), i)
                               for i, f in enumerate(c.get("mapping_fields") or [])], lambda r: r[3])
        evs = {}
        for i, f in enumerate(s.get("mapping_fields") or []):
            k = f.get("field")
            ext = bool(f.get("external") or False)
            if k in evs:
                evs[k] = (name, stream, k, evs[k][3] or ext, evs[k][4])
            else:
                evs[k] = (name, stream, k, ext, i)
        ev += list(evs.values())
    declared = {r[1] for r in md} | {r[3] for r in conf} | {r[2] for r in ev}
    proj = []
    for p in d.get("projections") or []:
        for out_name, spec in (p.get("projection") or {}).items():
            field = (spec.get("field") or "").replace(":", "/") if spec.get("field") is not None else None
            proj.append((name, p.get("name"), out_name, spec.get("type"), spec.get("location"),
                         spec.get("stream"), field, field in declared))
    mk = spark.createDataFrame
    m = Mapping(
        mk(md, "name string, field string, seq int"),
        mk(conf, "name string, stream string, device string, field string, seq int"),
        mk(ev, "name string, stream string, field string, external boolean, seq int"),
        mk(streams, "name string, stream string, time_stamp string, thumb_number int, thumb_field string"),
        mk(proj, "name string, projection string, out_name string, type string, location string, "
                 "stream string, field string, resolved boolean"))
    # same order as ``Mapping.fields``: by position, then field
    lists = {"md": [(None, r[1]) for r in sorted(md, key=lambda r: (r[2], r[1] or ""))],
             "conf": [(r[1], r[3]) for r in sorted(conf, key=lambda r: (r[4], r[3] or ""))],
             "event": [(r[1], r[2]) for r in sorted(ev, key=lambda r: (r[4], r[2] or "")) if not r[3]],
             "external": [(r[1], r[2]) for r in sorted(ev, key=lambda r: (r[4], r[2] or "")) if r[3]],
             "time_stamp": [(r[1], r[2]) for r in streams],
             "projection": [(r[5], r[6]) for r in proj]}
    m.__dict__["fields"] = lists  # fills the cached_property
    return m


def packaged_mapping(spark: SparkSession, name: str = "doc_mapping.json") -> Mapping:
    with open(os.path.join(RESOURCE_DIR, name), encoding="utf-8") as fh:
        return mapping_from_text(spark, fh.read())


def _first_position(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drop repeated listings of a field, keeping its first position."""
    return (df.groupBy(*keys).agg(F.min("seq").alias("seq")))


def explode_mapping(doc: DataFrame) -> Mapping:
    md = doc.select("name", F.posexplode("md_mappings").alias("seq", "m"))
    md = _first_position(md.select("name", F.col("m.field").alias("field"), "seq"), ["name", "field"])

    streams_raw = doc.select("name", F.explode("stream_mappings").alias("stream", "s"))
    streams = streams_raw.select(
        "name", "stream", F.col("s.time_stamp").alias("time_stamp"),
        F.col("s.thumbnail_info.number").alias("thumb_number"),
        F.col("s.thumbnail_info.field").alias("thumb_field"))
    conf = (streams_raw.select("name", "stream", F.explode("s.conf_mappings").alias("c"))
            .select("name", "stream", F.col("c.device").alias("device"),
                    F.posexplode("c.mapping_fields").alias("seq", "f"))
            .select("name", "stream", "device", F.col("f.field").alias("field"), "seq"))
    conf = _first_position(conf, ["name", "stream", "device", "field"])
    ev = (streams_raw.select("name", "stream", F.posexplode("s.mapping_fields").alias("seq", "f"))
          .select("name", "stream", F.col("f.field").alias("field"),
                  F.coalesce(F.col("f.external"), F.lit(False)).alias("external"), "seq"))
    ev = ev.groupBy("name", "stream", "field").agg(F.max("external").alias("external"),
                                                   F.min("seq").alias("seq"))

    proj = (doc.select("name", F.explode("projections").alias("p"))
            .select("name", F.col("p.name").alias("projection"),
                    F.explode("p.projection").alias("out_name", "spec"))
            .select("name", "projection", "out_name", F.col("spec.type").alias("type"),
                    F.col("spec.location").alias("location"), F.col("spec.stream").alias("stream"),
                    renamed("spec.field").alias("field")))
    declared = (md.select("name", "field").unionByName(conf.select("name", "field"))
                .unionByName(ev.select("name", "field")).distinct()
                .withColumn("_declared", F.lit(True)))
    proj = (proj.join(declared, ["name", "field"], "left")
            .withColumn("resolved", F.coalesce("_declared", F.lit(False))).drop("_declared"))
    return Mapping(md, conf, ev, streams, proj)
