"""Plug-in code that fails on some rows fails those rows only (T4).

A row ingestor is a function from a pandas batch to a pandas batch, run inside tasks. Where a
batch raises, it is halved and both halves run again, down to the single rows that raise:
``k`` bad rows of ``n`` cost about ``k log n`` more calls. A bad row becomes a quarantine row
with its own columns and the exception's text; all others are as if it had not been there. So
a task never fails for what plug-in code raises, and one that is lost runs again whole.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcat.functions.issues import issue
from fieldcat.operators.registry import IngestResult
from fieldcat.schemas import SEVERITY_ERROR
from fieldcat.session import scratch_dir

# Row ingestors travel by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ERROR = "_exception"
#: Characters of an exception's text that are kept.
MOST_TEXT = 4000


def bisect(rows: pd.DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, str | None]]:
    """(result, None) of the parts of ``rows`` on which ``fn`` runs, (row, text) of each single
    row on which it raises."""
    work = [rows]
    while work:
        part = work.pop()
        try:
            yield fn(part), None
        except Exception as e:  # noqa: BLE001 - plug-in code
            if len(part) <= 1:
                yield part, f"{type(e).__name__}: {e}"[:MOST_TEXT]
            else:
                half = len(part) // 2
                work += [part.iloc[half:], part.iloc[:half]]


def run_isolated(rows: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> tuple[DataFrame, DataFrame]:
    """(results, quarantine): what ``fn`` makes of ``rows`` in ``schema``, and the rows on which
    it raises, with ``exception``. ``fn`` runs once a row: the outcome is written to the shared
    folder and both sides are read from there."""
    spark = rows.sparkSession
    made = T._parse_datatype_string(schema)
    both = T.StructType([T.StructField("result", made), T.StructField("row", rows.schema), T.StructField(ERROR, T.StringType())])
    names, given = made.names, rows.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, text in bisect(batch, fn) if len(batch) else ():
                if len(part):
                    ok = text is None
                    yield pd.DataFrame({
                        "result": part[names].to_dict("records") if ok else [None] * len(part),
                        "row": [None] * len(part) if ok else part[given].to_dict("records"), ERROR: [text] * len(part)})

    path = scratch_dir(spark, "isolated")
    rows.mapInPandas(run, both).write.parquet(path)
    out = spark.read.schema(both).parquet(path)
    return (out.where(F.col(ERROR).isNull()).select("result.*"),
            out.where(F.col(ERROR).isNotNull()).select("row.*", F.col(ERROR).alias("exception")))


def row_ingestor(fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> Callable[[DataFrame, object], IngestResult]:
    """A registry plug-in from a row ingestor: ``fn`` makes dataset rows (``schema`` has job_id
    and pid) of job rows (job_id, document_path, mapping_id); jobs on which it raises get an
    error issue with the exception's text (F16)."""
    def ingest(jobs: DataFrame, ctx: object) -> IngestResult:
        rows = jobs.select("job_id", "document_path", "mapping_id")
        datasets, bad = run_isolated(rows, fn, schema)
        failed = issue(SEVERITY_ERROR, "ingestor failed", "ingest", F.col("exception"))
        return IngestResult(datasets, bad.select("job_id", F.lit(0).alias("seq"), failed.alias("issue")))
    return ingest
