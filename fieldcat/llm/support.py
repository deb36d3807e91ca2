"""Helpers shared by the training-data operators: staging, size-checked joins, components."""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldcat.session import scratch_dir

#: Rows of a side that may be broadcast (about 24 bytes a row); beyond it the join shuffles.
BROADCAST_ROWS = 500_000

#: Text handed to a numpy kernel at once; a longer document makes a piece of its own.
PIECE_BYTES = 6_000_000

#: Bytes of an Arrow batch between an executor and its Python workers inside ``small_batches``.
BATCH_BYTES = 2_000_000


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: cuts the lineage
    with files that outlive any executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast only if its counted rows stay within ``max_rows``."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def worker_cache() -> dict:
    """A dictionary that lives as long as this Python process, over all its tasks (task code
    travels by value, so a module's globals would not)."""
    return vars(sys.modules.setdefault("_fieldcat_worker_cache", types.ModuleType("_fieldcat_worker_cache")))


def text_pieces(batch: pa.RecordBatch, column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``most`` bytes of text each (one row at least). What
    Arrow holds of earlier batches is given back first and last: a worker lives on after its
    task, and its executor's memory would keep the largest batch it has read."""
    pa.default_memory_pool().release_unused()
    text = batch.column(column)
    start, size = 0, 0
    lengths = pa.compute.fill_null(pa.compute.binary_length(text), 0).to_numpy(zero_copy_only=False)
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += int(n)
    if start < batch.num_rows:
        yield batch.slice(start)
    pa.default_memory_pool().release_unused()


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH_BYTES):
    """Jobs that run inside hand rows to Python in batches of about ``most`` bytes. Spark cuts
    them after 10,000 rows or 64 MB, which both the executor and its workers hold several times."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has an edge; ``root`` is the smallest node reached.

    Alternating large-star and small-star rounds over an edge table: each round is two
    pre-aggregated minima joined back to the edges, so no node's neighbours are gathered
    in one place. Ends when a round changes nothing. Null ends and loops are ignored.
    """
    def oriented(x: DataFrame) -> DataFrame:
        return x.where("hi <> lo").distinct()

    now = stage(oriented(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
                         .where(F.col(a).isNotNull() & F.col(b).isNotNull())), "edges")

    def mark(x: DataFrame):
        return x.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()

    before = mark(now)
    while before[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(now.select(F.col("lo"), F.col("hi")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = oriented(both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")))
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi")
        now = stage(oriented(small.select(F.explode(F.array(
            F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.hi", "e.lo")), "edges")
        after = mark(now)
        if after == before:
            break
        before = after
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(
        now.select(F.col("lo"), F.col("lo")).distinct())
