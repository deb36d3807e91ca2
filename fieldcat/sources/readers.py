"""Field scan (S2): fill the long field table from instrument files.

Spark lists the files and spreads them over tasks (``binaryFile``); a
decoder turns one file's bytes into field rows for the *requested keys
only* (P1 at the source), in a ``mapInPandas`` batch. The decoder is a
small per-file helper; everything after it is DataFrame work. A file the
decoder cannot read yields rows with null values (null on failure, P2),
never a failed task (T4).

``decode_npz`` reads NumPy ``.npz`` archives, whose member names are the
hierarchical keys (``measurement/sample/name``). Any other format plugs in
with the same signature: ``decoder(path, content, keys) -> list[tuple]``.
"""

from __future__ import annotations

import io
from typing import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from fieldcat.schemas import FIELDS

FIELD_COLUMNS = [f.name for f in FIELDS.fields]


def _row(path, key, arr):
    shape = [int(s) for s in arr.shape]
    flat = arr.ravel()
    kind = arr.dtype.kind
    if kind in "SUO":
        vals = [v.decode("utf-8", "replace") if isinstance(v, bytes) else (None if v is None else str(v))
                for v in flat.tolist()]
        return (path, key, "S", shape, shape, vals, None, None)
    if kind in "iub":
        return (path, key, "i", shape, shape, None, [int(v) for v in flat.tolist()], None)
    if kind == "f":
        return (path, key, "f", shape, shape, None, None, [float(v) for v in flat.tolist()])
    return (path, key, kind, shape, shape, None, None, None)


def decode_npz(path: str, content: bytes, keys: set[str]) -> list[tuple]:
    try:
        with np.load(io.BytesIO(content), allow_pickle=False) as z:
            out = []
            for name in z.files:
                key = "/" + name.lstrip("/")
                if key in keys:
                    try:
                        out.append(_row(path, key, np.asarray(z[name])))
                    except Exception:  # noqa: BLE001 - one unreadable key
                        out.append((path, key, None, None, None, None, None, None))
            return out
    except Exception:  # noqa: BLE001 - unreadable file: no fields, J1 reports them
        return []


def extract_fields(spark: SparkSession, path: str, keys: list[str],
                   decoder: Callable[[str, bytes, set], list[tuple]] = decode_npz,
                   glob: str | None = None) -> DataFrame:
    """(file_path, key, kind, shape, maxshape, str_values, int_values,
    dbl_values) for every requested key present in every file."""
    wanted = set(keys)
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "content")

    def run(batches: Iterable[pd.DataFrame]):
        for pdf in batches:
            rows = []
            for p, content in zip(pdf["path"], pdf["content"]):
                rows.extend(decoder(p, bytes(content), wanted))
            yield pd.DataFrame(rows, columns=FIELD_COLUMNS)

    return files.mapInPandas(run, FIELDS)
