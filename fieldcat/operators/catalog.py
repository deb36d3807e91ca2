"""Catalogue records: dataset (P3, F1-F5), data files / datablock (P4),
attachment (P5, F11), ownership spread (P6) and orphan checks (J4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldcat.functions.access import access_groups, owner_group
from fieldcat.functions.files import basename, data_uri, local_time_text, parent_dir
from fieldcat.functions.ids import natural_id
from fieldcat.functions.text import keywords
from fieldcat.functions.values import default_unknown
from fieldcat.schemas import (
    ATTACHMENT_CAPTION, DATA_FORMAT, DATAFILE_TYPE, DATASET_TYPE, THUMBNAIL_TYPE,
)


def ownership(df: DataFrame, user: str | Column = "username", beamline: str = "beamline",
              proposal: str = "proposal", aliases: dict | None = None) -> DataFrame:
    """Adds ownerGroup / accessGroups, computed once per file and carried by
    every record derived from it."""
    user_c = F.col(user) if isinstance(user, str) else user
    return df.withColumn("ownerGroup", owner_group(user_c, proposal)) \
             .withColumn("accessGroups", access_groups(user_c, beamline, aliases))


def dataset_records(meta: DataFrame, user: str | Column = "username",
                    aliases: dict | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One raw-dataset record per file.

    ``meta`` columns: file_path, size, mod_time (timestamp or null), file_name,
    pi, email, instrument_name, proposal, beamline, scientific_metadata (JSON
    text) and the user column. ``pid`` is the SHA-256 of the path, so a replay
    upserts the same record.
    """
    m = ownership(meta, user, aliases=aliases).withColumn("_kw", keywords("file_name"))
    description = F.array_join("_kw", " ")
    return m.select(
        natural_id("file_path").alias("pid"),
        default_unknown("pi").alias("owner"),
        default_unknown("email").alias("contactEmail"),
        default_unknown("instrument_name").alias("creationLocation"),
        F.col("file_name").alias("datasetName"),
        F.lit(DATASET_TYPE).alias("type"),
        default_unknown("instrument_name").alias("instrumentId"),
        F.col("proposal").alias("proposalId"),
        F.lit(DATA_FORMAT).alias("dataFormat"),
        default_unknown("pi").alias("principalInvestigator"),
        parent_dir("file_path").alias("sourceFolder"),
        F.col("size").cast("bigint").alias("size"),
        F.col("scientific_metadata").alias("scientificMetadata"),
        description.alias("sampleId"),
        F.lit(False).alias("isPublished"),
        description.alias("description"),
        F.col("_kw").alias("keywords"),
        local_time_text("mod_time").alias("creationTime"),
        "ownerGroup",
        "accessGroups",
        F.col("file_path"),
        *carry,
    )


def data_files(files: DataFrame) -> DataFrame:
    """files(file_path, size, mod_time) -> (file_path, dataFileList)."""
    entry = F.struct(
        basename("file_path").alias("path"),
        F.col("size").cast("bigint").alias("size"),
        local_time_text("mod_time").alias("time"),
        F.lit(DATAFILE_TYPE).alias("type"),
    )
    return files.select("file_path", F.array(entry).alias("dataFileList"))


def datablocks(files: DataFrame, datasets: DataFrame) -> DataFrame:
    """One datablock per dataset file; the dataset's pid and ownership are
    carried over by an equi-join on file_path (one row per side)."""
    ds = datasets.select("file_path", F.col("pid").alias("datasetId"), "ownerGroup", "accessGroups")
    return (data_files(files).join(files.select("file_path", "size"), "file_path")
            .join(ds, "file_path")
            .select("datasetId", F.col("size").cast("bigint").alias("size"), "dataFileList",
                    "ownerGroup", "accessGroups", "file_path"))


def attachments(images: DataFrame, datasets: DataFrame, image_type: str = THUMBNAIL_TYPE,
                content: str = "content") -> DataFrame:
    """images(file_path, <content bytes>) -> attachment records."""
    ds = datasets.select("file_path", F.col("pid").alias("datasetId"), "ownerGroup", "accessGroups")
    return (images.join(ds, "file_path")
            .select("datasetId", data_uri(content, image_type).alias("thumbnail"),
                    F.lit(ATTACHMENT_CAPTION).alias("caption"), "ownerGroup", "accessGroups",
                    "file_path"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent (anti join; the parent side is
    only its key column)."""
    keys = parent.select(F.col(parent_key).alias("_pk"))
    return child.join(keys, F.col(child_key) == F.col("_pk"), "left_anti")
