"""Field scan (S2, S3, K3) as a Spark data source over container files.

A container is one instrument file: an ``.npz`` archive whose members are arrays under
hierarchical keys. Its directory is read first and members one by one, so a scan opens each
file once and decodes the *requested* keys only. Beside a member ``<key>`` there may be
``<key>@``, JSON attributes (kind, shape, maxshape, chunk), and a long array may lie in chunk
members ``<key>#0``, ``<key>#1`` ... of ``chunk`` values each.

``spark.read.format("containers").load(root)`` gives the long field table (``FIELDS``);
``file_path`` is the path below ``root`` without ``.npz``, starting with a slash.

* Partitions: files in path order up to ``partitionBytes`` each, every file counting
  ``openBytes`` more; a file above that is split by its members. With ``tasks`` they are
  smaller where there would be fewer than that.
* Pushdown: ``keys`` and ``paths`` (options, JSON lists) choose members and files, and with a
  shorter read schema only its columns are built: without value columns no member is opened
  that has attributes. The choice is an option of the scan and not Spark's filter pushdown:
  in Spark 4.1 two filters over one Python scan share the filters pushed last.
* ``sampleSize``: rows of ``SAMPLES``, the stride sample of each array; of a chunked array
  only the chunks that hold a kept index are read.
* Driver: folders are listed one at a time in path order; a slice holds its paths compressed (some
  bytes a file), and a written task's files stand in a hidden list that the commit reads.
* Streams: files are taken in (modification time, path) order; one younger than
  ``settleSeconds`` waits, so that a file of the same instant cannot be passed over.

An unreadable file has no rows and an unreadable member is a row of nulls; neither fails the
task. Folders are reached through Arrow file systems (local, s3, gs, hdfs).
"""

from __future__ import annotations

import fnmatch
import io
import json
import math
import time
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from fieldcat.schemas import FIELDS, SAMPLES

NAME = "containers"
SUFFIX = ".npz"
VALUES = {"S": "str_values", "i": "int_values", "f": "dbl_values"}
BATCH_ROWS = 4096


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ContainerSource)


def _chosen(keys: list[str] | None, options: dict) -> dict:
    return options if keys is None else options | {"keys": json.dumps(list(dict.fromkeys(keys)))}


def _spread(spark: SparkSession) -> dict:
    """Small files by the thousand in a task, as long as every core has some."""
    return {"openBytes": str(64 << 10), "tasks": str(2 * spark.sparkContext.defaultParallelism)}


def read_containers(spark: SparkSession, root: str, keys: list[str] | None = None, sample_size: int | None = None, **options) -> DataFrame:
    """The field table of all containers below ``root``, of the requested ``keys`` only; with
    ``sample_size`` their stride samples."""
    register(spark)
    reader = spark.read.format(NAME).options(**_chosen(keys, _spread(spark) | options))
    return (reader if sample_size is None else reader.option("sampleSize", str(sample_size))).load(root)


def stream_containers(spark: SparkSession, root: str, keys: list[str] | None = None, **options) -> DataFrame:
    register(spark)
    return spark.readStream.format(NAME).options(**_chosen(keys, _spread(spark) | options)).load(root)


def write_containers(fields: DataFrame, root: str, chunk: int | None = None) -> None:
    """One container for each ``file_path`` of a field table: a file's rows meet in one task,
    sorted, so the writer holds one member at a time."""
    register(fields.sparkSession)
    rows = fields.select(*FIELDS.names).repartition("file_path").sortWithinPartitions("file_path", "key")
    rows.write.format(NAME).option("chunk", str(chunk or 0)).mode("append").save(root)


# ---------------------------------------------------------------- one container

def _kind(a: np.ndarray) -> str:
    return {"S": "S", "U": "S", "O": "S", "i": "i", "u": "i", "b": "i", "f": "f"}.get(a.dtype.kind, a.dtype.kind)


def _python(a: np.ndarray, kind: str) -> list:
    flat = a.ravel()
    if kind == "S":
        return [v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v) for v in flat.tolist()]
    return [int(v) for v in flat.tolist()] if kind == "i" else flat.astype(float).tolist()


# Headers by what they say; plain tables, since this module travels to executors by value.
_READ, _WRITTEN = {}, {}


def _header(data: bytes) -> tuple:
    """Shape, order and type of an array by its header; arrays of files of one kind share theirs."""
    if data not in _READ:
        if len(_READ) >= 1024:
            _READ.clear()
        _READ[data] = np.lib.format.read_array_header_1_0(io.BytesIO(data))
    return _READ[data]


def _header_of(n: int, kind: str) -> bytes:
    """What stands before the values of an array of ``n`` in a file."""
    if (n, kind) not in _WRITTEN:
        if len(_WRITTEN) >= 1024:
            _WRITTEN.clear()
        out = io.BytesIO()
        np.lib.format.write_array_header_1_0(out, {"descr": kind, "fortran_order": False, "shape": (n,)})
        _WRITTEN[n, kind] = out.getvalue()
    return _WRITTEN[n, kind]


class Container:
    """The members of one open archive."""

    def __init__(self, stream):
        self.zip = zipfile.ZipFile(stream)
        self.names = {n.removesuffix(".npy") for n in self.zip.namelist()}
        self.keys = sorted({n.rstrip("@").split("#")[0] for n in self.names})

    def array(self, name: str) -> np.ndarray:
        data = self.zip.read(name + ".npy")
        if data[:8] == b"\x93NUMPY\x01\x00":
            at = 10 + int.from_bytes(data[8:10], "little")
            shape, fortran, kind = _header(data[8:at])
            if not fortran and not kind.hasobject and kind.itemsize:
                return np.frombuffer(data, kind, math.prod(shape), at).reshape(shape)
        return np.lib.format.read_array(io.BytesIO(data), allow_pickle=False)

    def attributes(self, key: str) -> dict:
        return json.loads(self.zip.read(key + "@")) if key + "@" in self.names else {}

    def values(self, key: str, attributes: dict, chunks: list[int] | None = None) -> tuple[list | None, str]:
        """The values of a key (of the named chunks only) and their kind."""
        if attributes.get("null"):
            return None, attributes["kind"]
        if not attributes.get("chunk"):
            a = self.array(key)
            kind = attributes.get("kind") or _kind(a)
            return (json.loads(a.tobytes()) if attributes.get("text") else _python(a, kind)), kind
        kind, out = attributes["kind"], []
        for c in range(-(-attributes["n"] // attributes["chunk"])) if chunks is None else chunks:
            a = self.array(f"{key}#{c}")
            out += json.loads(a.tobytes()) if attributes.get("text") else _python(a, kind)
        return out, kind

    def field(self, path: str, key: str, columns: set[str]) -> dict:
        """A row of the field table, built as far as ``columns`` ask."""
        row = {"file_path": path, "key": "/" + key.lstrip("/")}
        try:
            if columns <= {"file_path", "key"}:
                return row
            attributes = self.attributes(key)
            if attributes and not columns & set(VALUES.values()):
                return row | {"kind": attributes["kind"], "shape": attributes["shape"], "maxshape": attributes["maxshape"]}
            values, kind = self.values(key, attributes)
            shape = attributes.get("shape")
            if shape is None and not attributes:
                shape = [int(s) for s in self.array(key).shape]
            return row | {"kind": kind, "shape": shape, "maxshape": attributes.get("maxshape", shape), VALUES.get(kind, ""): values}
        except Exception:  # noqa: BLE001 - an unreadable member is a row of nulls
            return row

    def sample(self, path: str, key: str, size: int) -> dict:
        """The stride sample of an array; a scalar has no step."""
        row = {"file_path": path, "key": "/" + key.lstrip("/")}
        try:
            attributes = self.attributes(key)
            chunk = attributes.get("chunk")
            values, kind = (None, attributes["kind"]) if chunk else self.values(key, attributes)
            shape = attributes.get("shape") or ([] if attributes else [int(s) for s in self.array(key).shape])
            if not shape:
                return row | {"kind": kind}
            n = attributes["n"] if chunk else len(values or [])
            step = max(n // size, 1)
            kept, read = range(0, n, step), 1
            if chunk:
                wanted = sorted({i // chunk for i in kept})
                read = len(wanted)
                found = dict(zip(wanted, (self.values(key, attributes, [c])[0] for c in wanted)))
                out = [found[i // chunk][i % chunk] for i in kept]
            else:
                out = [values[i] for i in kept]
            return row | {"kind": kind, "n_values": n, "step": step, "chunks": -(-n // chunk) if chunk else 1, "chunks_read": read,
                          VALUES.get(kind, ""): out}
        except Exception:  # noqa: BLE001
            return row


# ---------------------------------------------------------------- reading

class Slice(InputPartition):
    """Files of one task, their paths compressed: the driver holds the slices of all files at once.
    ``keys`` are the members of the single file of a split one."""

    def __init__(self, files: list[str], keys: list[str] | None = None):
        self.packed = zlib.compress("\0".join(files).encode("utf-8", "surrogateescape")) if files else b""
        self.keys = keys

    @property
    def files(self) -> list[str]:
        return zlib.decompress(self.packed).decode("utf-8", "surrogateescape").split("\0") if self.packed else []


class _Scan:
    """What batch and stream readers share: options, listing, slicing and decoding."""

    def __init__(self, schema, options: dict):
        self.schema = schema
        self.system, self.root = fs.FileSystem.from_uri(options["path"]) if "://" in options["path"] else (
            fs.LocalFileSystem(), options["path"].removeprefix("file:"))
        self.root = self.root.rstrip("/")
        self.most = int(options.get("partitionbytes", 128 << 20))
        self.open = int(options.get("openbytes", 1 << 20))
        self.tasks = int(options.get("tasks", 0))
        self.sample = int(options["samplesize"]) if "samplesize" in options else None
        self.glob = options.get("pathglobfilter")
        self.keys = set(json.loads(options["keys"])) if "keys" in options else None
        self.paths = set(json.loads(options["paths"])) if "paths" in options else None

    def walk(self, folder: str | None = None) -> Iterator[tuple[int, str, int]]:
        """(modification time, path, bytes) of the containers below the root, in path order; holds
        one folder of each level."""
        found = self.system.get_file_info(fs.FileSelector(folder or self.root, allow_not_found=True))
        for f in sorted(found, key=lambda f: f.path + "/" * (f.type == fs.FileType.Directory)):
            if f.type == fs.FileType.Directory:
                yield from self.walk(f.path)
            elif f.type == fs.FileType.File and f.path.endswith(SUFFIX) and not f.base_name.startswith(("_", ".")):
                if self.glob and not fnmatch.fnmatch(f.base_name, self.glob):
                    continue
                if self.paths is None or self.logical(f.path) in self.paths:
                    yield int(f.mtime_ns or 0), f.path, int(f.size or 0)

    def listed(self) -> list[tuple[int, str, int]]:
        return list(self.walk())

    def logical(self, path: str) -> str:
        return path[len(self.root):].removesuffix(SUFFIX)

    def slices(self, files: list[tuple[int, str, int]]) -> list[Slice]:
        return self._slices(sorted(files, key=lambda f: f[1]), self._size(files))

    def slices_of(self, wanted: Callable[[tuple], bool] = lambda f: True) -> list[Slice]:
        """The slices of the wanted files below the root, which are listed twice and never held."""
        return self._slices(filter(wanted, self.walk()), self._size(filter(wanted, self.walk())) if self.tasks else self.most)

    def _size(self, files: Iterable[tuple[int, str, int]]) -> int:
        """Bytes of a slice."""
        total = 0
        for _, _, n in files if self.tasks else ():
            total += n + self.open
            if total >= self.most * self.tasks:
                return self.most
        return total // self.tasks if self.tasks else self.most

    def _slices(self, files: Iterable[tuple[int, str, int]], most: int) -> list[Slice]:
        out, held, size = [], [], 0
        for _, path, n in files:
            if n > self.most:
                out += self._split(path)
                continue
            if held and size + n + self.open > most:
                out.append(Slice(held))
                held, size = [], 0
            held.append(path)
            size += n + self.open
        return out + ([Slice(held)] if held else [])

    def _split(self, path: str) -> list[Slice]:
        """Groups of a large file's members, by their bytes in its directory."""
        try:
            with self.system.open_input_file(path) as f:
                container, sizes = Container(f), {}
                for info in container.zip.infolist():
                    key = info.filename.removesuffix(".npy").rstrip("@").split("#")[0]
                    sizes[key] = sizes.get(key, 0) + info.compress_size
        except Exception:  # noqa: BLE001 - unreadable: no rows
            return []
        out, held, size = [], [], 0
        for key, n in sorted(sizes.items()):
            if held and size + n > self.most:
                out.append(Slice([path], held))
                held, size = [], 0
            held.append(key)
            size += n
        return out + ([Slice([path], held)] if held else [])

    def decode(self, part: Slice) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        columns, rows, room = set(arrow.names), [], BATCH_ROWS
        for path in part.files:
            try:
                with self.system.open_input_file(path) as f:
                    container = Container(f)
                    for key in container.keys if part.keys is None else part.keys:
                        name = "/" + key.lstrip("/")
                        if self.keys is not None and name not in self.keys:
                            continue
                        at = self.logical(path)
                        row = container.field(at, key, columns) if self.sample is None else container.sample(at, key, self.sample)
                        rows.append({c: row.get(c) for c in arrow.names})
                        room -= 1 + sum(len(v) for v in row.values() if isinstance(v, list)) // 64
            except Exception:  # noqa: BLE001 - an unreadable file has no rows
                pass
            if room <= 0:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                rows, room = [], BATCH_ROWS
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)


class ContainerReader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.scan = _Scan(schema, options)

    def partitions(self) -> list[Slice]:
        return self.scan.slices_of() or [Slice([])]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        yield from self.scan.decode(partition)


class ContainerStreamReader(DataSourceStreamReader):
    """The offset is the last (modification time, path) taken: its size does not grow."""

    def __init__(self, schema, options: dict):
        self.scan = _Scan(schema, options)
        self.settle = float(options.get("settleseconds", 2))

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        until = (time.time() - self.settle) * 1e9
        last = max((f[:2] for f in self.scan.walk() if f[0] <= until), default=(-1, ""))
        return {"time": last[0], "path": last[1]}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        low, high = (start["time"], start["path"]), (end["time"], end["path"])
        return self.scan.slices_of(lambda f: low < f[:2] <= high)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        yield from self.scan.decode(partition)


# ---------------------------------------------------------------- writing

@dataclass
class Written(WriterCommitMessage):
    """The hidden list of a task's files, None if it wrote none."""

    path: str | None


class ContainerWriter(DataSourceArrowWriter):
    """Containers under hidden names, moved to their own when all tasks are done."""

    def __init__(self, options: dict):
        self.scan = _Scan(None, options)
        self.chunk = int(options.get("chunk", 0))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done, path, archive, sink, folders = [], None, None, None, set()

        def close():
            if archive is not None:
                archive.close()
                sink.close()

        for batch in iterator:
            numbers = [c for c in ("int_values", "dbl_values") if c in batch.schema.names]  # stay in Arrow's memory
            columns = {c: batch.column(c) for c in numbers}
            for i, row in enumerate(batch.drop_columns(numbers).to_pylist()):
                row |= {c: v[i].values for c, v in columns.items()}
                if row["file_path"] is None or row["key"] is None:
                    continue
                if row["file_path"] != path:
                    close()
                    path = row["file_path"]
                    final = f"{self.scan.root}/{path.lstrip('/')}{SUFFIX}"
                    folder = final.rsplit("/", 1)[0]
                    if folder not in folders:
                        self.scan.system.create_dir(folder, recursive=True)
                        folders.add(folder)
                    hidden = f"{folder}/.{uuid.uuid4().hex}"
                    sink = self.scan.system.open_output_stream(hidden)
                    archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED)
                    done.append((hidden, final))
                self._put(archive, row)
        close()
        if not done:
            return Written(None)
        self.scan.system.create_dir(self.scan.root, recursive=True)
        written = f"{self.scan.root}/.{uuid.uuid4().hex}.written"
        with self.scan.system.open_output_stream(written) as f:
            f.write(json.dumps(done).encode())
        return Written(written)

    def _each(self, messages: list[Written], do: Callable[[str, str], None]) -> None:
        """``do`` for the files (hidden, final) of the tasks, one task's list at a time."""
        for message in messages:
            if message and message.path:
                with self.scan.system.open_input_stream(message.path) as f:
                    done = json.loads(f.read())
                for hidden, final in done:
                    do(hidden, final)
                self.scan.system.delete_file(message.path)

    def _put(self, archive: zipfile.ZipFile, row: dict) -> None:
        key, kind = row["key"].lstrip("/"), row["kind"]
        values = row.get(VALUES.get(kind, ""))
        if isinstance(values, pa.Array):
            values = values.to_pylist() if values.null_count else values.to_numpy(zero_copy_only=False)
        text = kind == "S" or (isinstance(values, list) and None in values)
        attributes = {"kind": kind, "shape": row["shape"], "maxshape": row["maxshape"], "null": values is None, "text": text}

        def array(name: str, part: list) -> None:
            a = np.frombuffer(json.dumps(part).encode(), np.uint8) if text else np.asarray(part, np.int64 if kind == "i" else np.float64)
            archive.writestr(zipfile.ZipInfo(name + ".npy"), _header_of(len(a), a.dtype.str) + a.tobytes())

        if values is not None and self.chunk and len(values) > self.chunk:
            attributes |= {"chunk": self.chunk, "n": len(values)}
            for c in range(0, len(values), self.chunk):
                array(f"{key}#{c // self.chunk}", values[c:c + self.chunk])
        elif values is not None:
            array(key, values)
        archive.writestr(key + "@", json.dumps(attributes))

    def commit(self, messages: list[Written]) -> None:
        self._each(messages, self.scan.system.move)

    def abort(self, messages: list[Written]) -> None:
        self._each(messages, lambda hidden, _: self.scan.system.delete_file(hidden))


class ContainerSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return SAMPLES if "samplesize" in {k.lower() for k in self.options} else FIELDS

    def _options(self) -> dict:
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema) -> ContainerReader:
        return ContainerReader(schema, self._options())

    def streamReader(self, schema) -> ContainerStreamReader:
        return ContainerStreamReader(schema, self._options())

    def writer(self, schema, overwrite: bool) -> ContainerWriter:
        return ContainerWriter(self._options())
