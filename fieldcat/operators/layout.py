"""Tables laid out for the queries that read them: events by job (S6) and rows by several
orderings at once (S8, S9, K4).

* ``write_events_by_job``: the status events as a bucketed table, sorted by job id inside each
  bucket and with Parquet's Bloom filters on it. A join or fold by job id reads it without a
  shuffle of the events, and a look-up of a few jobs reads their buckets and, in these, the row
  groups whose filters may hold them.
* ``write_clustered``: rows along a space-filling (Z-order) curve over two or more orderings.
  Each ordering is cut into equal parts by its own quantiles; the parts' bits, interleaved, are
  the place on the curve. Files and row groups then cover a small range of every ordering, and
  a filter on any of them skips most by their statistics.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcat.operators import jobs as J

#: Bits of an ordering's part on the curve (16 parts of equal rows).
BITS = 4


def write_events_by_job(events: DataFrame, path: str, buckets: int, key: str = "id") -> str:
    """Writes the table and returns its name in the session's catalogue."""
    name = f"events_by_job_{uuid.uuid4().hex[:12]}"
    events.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).option(
        f"parquet.bloom.filter.enabled#{key}", "true").format("parquet").saveAsTable(name)
    return name


def lookup_indexed(spark: SparkSession, table: str, ids: DataFrame, key: str = "id", tiebreak: str | None = None) -> DataFrame:
    """``jobs.lookup_events`` over a table by job: the ids are dealt to its buckets and meet the
    events there."""
    return J.lookup_events(spark.table(table), ids, key, tiebreak)


def find_jobs(spark: SparkSession, table: str, ids: list[str], key: str = "id", tiebreak: str | None = None) -> DataFrame:
    """The state of the few jobs named (P7): literal ids reach the scan, which prunes buckets and
    row groups by them."""
    return J.fold_jobs(spark.table(table).where(F.col(key).isin(ids)), key, tiebreak)


def _number(df: DataFrame, name: str) -> Column:
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.StringType):  # the first bytes, as a number
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    return c.cast("double")


def curve(df: DataFrame, orderings: list[str], bits: int = BITS) -> Column:
    """Each row's place on the curve. Quantiles are one aggregate over the table; the driver gets
    ``2**bits - 1`` numbers an ordering. A null lies in the first part."""
    at = [F.lit(i / (1 << bits)) for i in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(_number(df, o), F.array(*at), 10_000).alias(f"q{i}") for i, o in enumerate(orderings)]).first()
    place = F.lit(0)
    for i, o in enumerate(orderings):
        part = sum((F.coalesce(_number(df, o) >= F.lit(q), F.lit(False)).cast("int") for q in cuts[i] or []), F.lit(0))
        for bit in range(bits):
            place = place + F.shiftleft(F.shiftright(part, bit).bitwiseAND(1), bit * len(orderings) + i)
    return place


def write_clustered(df: DataFrame, path: str, orderings: list[str], files: int, row_group_bytes: int | None = None) -> None:
    """Parquet files along the curve; ``files`` of about equal rows."""
    rows = df.withColumn("_place", curve(df, orderings)).repartitionByRange(files, "_place", *orderings).sortWithinPartitions("_place", *orderings)
    writer = rows.drop("_place").write
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
