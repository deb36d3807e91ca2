"""Row stride sample of an event page (K2), its column-oriented JSON (F18)
and the array stride sample (K3): of an array column, and of the sampled keys
of files, whose samples the container scan reads (``SAMPLES``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcat.functions.issues import issue
from fieldcat.functions.values import stride_step
from fieldcat.operators.ordering import group_row_number
from fieldcat.schemas import SAMPLE_SIZE, SEVERITY_ERROR, unique_keys


def stride_rows(df: DataFrame, order_by: list, partition_by: list[str] = (),
                sample_size: int = SAMPLE_SIZE) -> DataFrame:
    """Rows 0, step, 2*step, ... of every group in ``order_by`` order, with
    step = max(n div sample_size, 1). Adds ``row_idx`` (0-based position in
    the group) and ``n`` (group size). Groups of any size stay balanced."""
    numbered = group_row_number(df, list(partition_by), list(order_by), rn="_rn", n="n")
    step = stride_step(F.col("n"), sample_size)
    return (numbered.where(((F.col("_rn") - 1) % step) == 0)
            .withColumn("row_idx", F.col("_rn") - 1).drop("_rn"))


def stride_elements(df: DataFrame, keys: list[str], array_col: str,
                    sample_size: int = SAMPLE_SIZE) -> DataFrame:
    """Long form of the array stride sample: (keys..., n_values, step,
    sample_len, pos, value) for the kept elements, pos being the element's
    index in the sample. Scalar arithmetic on posexplode output."""
    n = F.size(array_col).cast("bigint")
    step = stride_step(n, sample_size)
    base = df.select(*keys, n.alias("n_values"), step.alias("step"),
                     F.posexplode(array_col).alias("_i", "value"))
    return (base.where((F.col("_i") % F.col("step")) == 0)
            .select(*keys, "n_values", "step",
                    ((F.col("n_values") + F.col("step") - 1) / F.col("step")).cast("bigint").alias("sample_len"),
                    (F.col("_i") / F.col("step")).cast("bigint").alias("pos"), "value"))


def to_column_json(sample: DataFrame, group_by: list[str], index: str, columns: list[str],
                   out: str = "page_json") -> DataFrame:
    """Per group, ``{"col": {"<index>": value, ...}, ...}`` in index order.
    Each group holds one stride sample (fewer than 2*sample_size rows), so
    the per-group lists are bounded."""
    aggs = [F.collect_list(F.struct(F.col(index).alias("i"), F.col(c).alias("v"))).alias(c)
            for c in columns]
    grouped = sample.groupBy(*group_by).agg(*aggs)

    def as_map(c):
        entries = F.transform(F.array_sort(F.col(c)),
                              lambda e: F.struct(e["i"].cast("string").alias("k"), e["v"].alias("v")))
        return F.map_from_entries(entries).alias(c)

    return grouped.select(*group_by, F.to_json(F.struct(*[as_map(c) for c in columns])).alias(out))


def is_scalar(samples: DataFrame):
    """A key of a file that is readable and has no length."""
    return F.col("step").isNull() & F.col("kind").isNotNull()


def sample_elements(samples: DataFrame) -> DataFrame:
    """(file_path, key, n_values, step, chunks, chunks_read, pos, value) of the kept elements of
    numeric arrays; an empty array is one row with neither pos nor value."""
    values = F.coalesce("dbl_values", F.col("int_values").cast("array<double>"))
    return samples.where("step is not null and kind <> 'S'").select(
        "file_path", "key", "n_values", "step", "chunks", "chunks_read", F.posexplode_outer(values).alias("pos", "value"))


def sample_issues(files: DataFrame, samples: DataFrame, keys: list[str], stage: str = "extract") -> DataFrame:
    """One error per (file, sampled key) that is a scalar; a key that a file lacks is no issue.
    The other columns of ``files`` (file_path, ...) are carried along."""
    wanted = F.array(*[F.lit(k) for k in unique_keys(keys)])
    scalars = samples.where(is_scalar(samples) & F.col("key").isin(unique_keys(keys))).select("file_path", "key")
    msg = F.concat(F.lit("data sample of a scalar "), F.col("key"))
    return files.join(scalars, "file_path").select(
        *files.columns, "key", (F.array_position(wanted, F.col("key")).cast("int") - 1).alias("key_seq"),
        issue(SEVERITY_ERROR, msg, stage).alias("issue"))


def sample_json(samples: DataFrame, keys: list[str], out: str = "data_sample") -> DataFrame:
    """Per file ``{"<key>": [<kept values>], ...}`` in ``keys`` order, strict JSON. A file holds
    at most ``len(keys)`` samples of under ``2 * SAMPLE_SIZE`` values, a fixed bound."""
    from fieldcat.functions.values import mask_nonfinite

    wanted = F.array(*[F.lit(k) for k in unique_keys(keys)])
    values = F.coalesce(F.to_json("str_values"), F.to_json("int_values"), F.to_json(mask_nonfinite(F.col("dbl_values"))), F.lit("[]"))
    entry = F.concat(F.regexp_replace(F.to_json(F.array("key")), r"^\[|\]$", ""), F.lit(":"), values)
    per_file = (samples.where(F.col("step").isNotNull() & F.col("key").isin(unique_keys(keys)))
                .select("file_path", F.array_position(wanted, F.col("key")).alias("_pos"), entry.alias("_e"))
                .groupBy("file_path").agg(F.array_sort(F.collect_list(F.struct("_pos", "_e"))).alias("_es")))
    return per_file.select("file_path", F.concat(F.lit("{"), F.array_join(F.transform("_es", lambda e: e["_e"]), ","), F.lit("}")).alias(out))
