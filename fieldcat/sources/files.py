"""File inventory scan (S1): path, size and modification time of every file,
without reading the content (binaryFile prunes ``content`` when unselected). A folder tree is listed
in tasks, since Spark's own index of files lies in the driver, about a kilobyte a file."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcat.functions.files import basename, local_time_text, parent_dir
from fieldcat.session import scratch_dir

#: Entries of a listing that are handed on at once.
ENTRIES = 10_000
ENTRY = "path string, length long, modificationTime timestamp, folder boolean"


def _hidden(name: str) -> bool:
    """Names that Spark's file sources pass over."""
    return (name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")) and not name.startswith(
        ("_common_metadata", "_metadata"))


def _arrow_folder(path: str) -> str | None:
    """What stands before Arrow's paths in Spark's form of them, None if Arrow cannot list ``path``."""
    try:
        system, root = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
        if not root.startswith("/") or system.get_file_info(root).type != fs.FileType.Directory:
            return None  # one file, a pattern, nothing, or a bucket's name: Spark tells
    except (OSError, ValueError, pa.ArrowException):
        return None
    return "file:" if isinstance(system, fs.LocalFileSystem) else path[:path.index("/", path.index("://") + 3)] if "/" in path.split("://")[1] else None


def _list_folders(before: str, glob: str | None):
    """The entries of folders, in tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modificationTime", pa.timestamp("us", "UTC")), ("folder", pa.bool_())])
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                system = fs.LocalFileSystem() if before == "file:" else fs.FileSystem.from_uri(folder)[0]
                found = system.get_file_info(fs.FileSelector(folder.removeprefix(before), allow_not_found=True))
                rows = []
                for f in found:
                    below = f.type == fs.FileType.Directory
                    if not _hidden(f.base_name) and (below or not glob or fnmatch.fnmatchcase(f.base_name, glob)):
                        rows.append({"path": before + f.path, "length": None if below else f.size,
                                     "modificationTime": None if f.mtime_ns is None else f.mtime_ns // 1_000_000 * 1000, "folder": below})
                for at in range(0, len(rows), ENTRIES):
                    yield pa.RecordBatch.from_pylist(rows[at:at + ENTRIES], schema=schema)
    return run


def _listed(spark: SparkSession, path: str, before: str, glob: str | None) -> DataFrame:
    """The files below ``path``, listed level by level in tasks that take folders, and stored."""
    root, out = scratch_dir(spark, "listing"), None
    top = path.removeprefix("file://").removeprefix("file:") if before == "file:" else path.removeprefix(before)
    level = spark.createDataFrame([(before + (top.rstrip("/") or "/"),)], "path string")
    for depth in range(1 << 10):
        at = f"{root}/depth={depth}"
        tasks = 2 * spark.sparkContext.defaultParallelism if depth else 1
        level.repartition(tasks).mapInArrow(_list_folders(before, glob), ENTRY).write.parquet(at)
        rows = spark.read.schema(ENTRY).parquet(at)
        files = rows.where("not folder").drop("folder")
        out = files if out is None else out.unionAll(files)
        level = rows.where("folder").select("path")
        if level.isEmpty():
            break
    return out


def scan_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = False) -> DataFrame:
    before = _arrow_folder(path) if recursive and not set(glob or "") & set("{}[]\\") else None
    if before is None:
        reader = spark.read.format("binaryFile")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        if recursive:
            reader = reader.option("recursiveFileLookup", "true")
        files = reader.load(path).select("path", "length", "modificationTime")
    else:
        files = _listed(spark, path, before, glob)
    return files.select(
        F.col("path").alias("file_path"),
        basename("path").alias("file_name"),
        parent_dir("path").alias("folder"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("mod_time"),
        local_time_text("modificationTime").alias("mod_time_text"),
    )


def read_file_bytes(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Path and bytes, for sources whose content is needed (thumbnails)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("path").alias("file_path"), "content")
