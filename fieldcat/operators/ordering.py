"""Row numbers within groups that stay balanced when one group is huge.

``row_number() over (partition by k order by o)`` sends each group to one
task. Here every group, large or small, is cut into *pieces*: a piece is a
pure function of the first order column that never decreases along it (an
hour of time, 65,536 consecutive integers, a three-character prefix). Rows
are numbered inside each (group, piece), and a small table of per-piece
counts supplies each piece's offset and the group's size. One plan for every
size: no thresholds, no samples, no job while the plan is built. Null keys
and null order values are groups and pieces like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Widths of a piece: seconds of time, consecutive integers, leading characters.
PIECE_SECONDS = 3600
PIECE_INTEGERS = 65_536
PIECE_CHARACTERS = 3


def piece_of(df: DataFrame, col: str) -> Column:
    """The piece of each row: never decreases along ``col``; null for null."""
    t, c = df.schema[col].dataType, F.col(col)
    if isinstance(t, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.floor(F.timestamp_diff("SECOND", epoch, F.date_trunc("HOUR", c).cast("timestamp_ntz")) / PIECE_SECONDS)
    if isinstance(t, T.TimestampType):
        return F.floor(F.unix_micros(c) / (PIECE_SECONDS * 1_000_000))
    if isinstance(t, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.floor(c / PIECE_INTEGERS)
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.floor(c.cast("double")).cast("double")
    return F.substring(c.cast("string"), 1, PIECE_CHARACTERS)


def group_row_number(df: DataFrame, keys: list[str], order: list[str], rn: str = "rn", n: str = "n",
                     previous: dict[str, str] | None = None) -> DataFrame:
    """Adds ``rn`` (1-based position in the group by ``order``) and ``n``
    (group size). ``order`` must break all ties within a group. ``previous``
    maps new column names to columns whose value in the row before is
    wanted: ``lag`` inside a piece, the piece before at its border."""
    previous = previous or {}
    rows = df.withColumn("_piece", piece_of(df, order[0]))
    inside = Window.partitionBy(*keys, "_piece").orderBy(*order)
    local = rows.withColumn("_at", F.row_number().over(inside))
    for new, col in previous.items():
        local = local.withColumn(new, F.lag(col).over(inside))
    pieces = rows.groupBy(*keys, "_piece").agg(
        F.count(F.lit(1)).alias("_count"),
        *[F.max_by(col, F.struct(*order)).alias(f"_last_{new}") for new, col in previous.items()])
    group = Window.partitionBy(*keys)
    along = group.orderBy("_piece")
    border = pieces.select(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], F.col("_piece").alias("_of"),
        F.coalesce(F.sum("_count").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_count").over(group).alias("_size"),
        *[F.lag(f"_last_{new}").over(along).alias(f"_last_{new}") for new in previous])
    same = F.col("_piece").eqNullSafe(F.col("_of"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    out = local.join(border, same)
    for new in previous:
        out = out.withColumn(new, F.when(F.col("_at") == 1, F.col(f"_last_{new}")).otherwise(F.col(new)))
    return out.select(*df.columns, *previous, (F.col("_at") + F.col("_before")).cast("bigint").alias(rn),
                      F.col("_size").cast("bigint").alias(n))
