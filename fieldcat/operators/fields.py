"""Long field table: requested-key projection (P1), value normalisation (P2),
wide pivot, missing-key issues (J1) and the separator rename (P10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldcat.functions.issues import issue
from fieldcat.functions.text import renamed
from fieldcat.functions.values import safe_size
from fieldcat.schemas import SEVERITY_WARNING, unique_keys


def select_fields(fields: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the requested keys. The list is fixed and small, so ``isin``
    keeps it a filter next to the scan (pushed down as a range or IN)."""
    return fields.where(F.col("key").isin(unique_keys(keys)))


def _first(arr):
    return F.try_element_at(arr, F.lit(1))


def normalise(fields: DataFrame) -> DataFrame:
    """Typed value per (file, key): strings unbox on shape () or (1,);
    numbers unbox on maxshape (1,) or a 0-d shape; everything else stays an
    array. A failed unboxing (no element) gives null, not an error."""
    is_str = F.col("kind") == F.lit("S")
    is_int = F.col("kind") == F.lit("i")
    shape_n = safe_size("shape")
    unbox_str = (shape_n == 0) | ((shape_n == 1) & (F.col("shape")[0] == 1))
    max_one = F.coalesce((safe_size("maxshape") == 1) & (F.col("maxshape")[0] == 1), F.lit(False))
    unbox_num = max_one | (shape_n == 0)
    unbox = F.when(is_str, unbox_str).otherwise(unbox_num)
    vkind = (F.when(is_str, F.when(unbox, F.lit("string")).otherwise(F.lit("string_array")))
             .when(is_int, F.when(unbox, F.lit("int")).otherwise(F.lit("int_array")))
             .otherwise(F.when(unbox, F.lit("double")).otherwise(F.lit("double_array"))))
    n_values = (F.when(is_str, safe_size("str_values")).when(is_int, safe_size("int_values"))
                .otherwise(safe_size("dbl_values")))
    return fields.select(
        "file_path", "key", vkind.alias("value_kind"),
        F.when(is_str & unbox, _first("str_values")).alias("str_value"),
        F.when(is_int & unbox, _first("int_values")).alias("int_value"),
        F.when(~is_str & ~is_int & unbox, _first("dbl_values")).alias("dbl_value"),
        F.when(is_str & ~unbox, F.col("str_values")).alias("str_array"),
        F.when(is_int & ~unbox, F.col("int_values")).alias("int_array"),
        F.when(~is_str & ~is_int & ~unbox, F.col("dbl_values")).alias("dbl_array"),
        n_values.cast("bigint").alias("n_values"),
    )


def value_text(norm: DataFrame) -> DataFrame:
    """Adds ``value_text``: the normalised value as one string (arrays joined
    with ',') - the form a wide, string-typed view can carry."""
    txt = F.coalesce(
        F.col("str_value"), F.col("int_value").cast("string"), F.col("dbl_value").cast("string"),
        F.array_join("str_array", ","),
        F.array_join(F.col("int_array").cast("array<string>"), ","),
        F.array_join(F.col("dbl_array").cast("array<string>"), ","),
    )
    return norm.withColumn("value_text", txt)


def column_name(key: str) -> str:
    return key.strip("/").replace("/", "_").replace(":", "_")


def pivot_fields(norm_text: DataFrame, keys: list[str], value: str = "value_text",
                 files: DataFrame | None = None) -> DataFrame:
    """Wide table, one row per file, one column per requested key. The pivot
    values are given, so Spark plans no extra job to find them; the
    aggregation is partial (map-side) per file. With ``files`` (file_path),
    a file without any requested key is a row of nulls."""
    ks = unique_keys(keys)
    wide = norm_text.groupBy("file_path").pivot("key", ks).agg(F.first(value))
    if files is not None:
        wide = files.select("file_path").join(wide, "file_path", "left")
    return wide.select("file_path", *[F.col(f"`{k}`").alias(column_name(k)) for k in ks])


def missing_issues(files: DataFrame, fields: DataFrame, keys: list[str],
                   stage: str = "extract") -> DataFrame:
    """One warning per (file, requested key) with no field row; the other
    columns of ``files`` (e.g. a job id) are carried along.

    No cross product: each file's present keys are gathered (at most
    len(keys) per file, a fixed bound), the missing ones are the requested
    array minus those, exploded with their list position."""
    ks = unique_keys(keys)
    wanted = F.array(*[F.lit(k) for k in ks])
    present = (select_fields(fields, ks).groupBy("file_path")
               .agg(F.collect_set("key").alias("_present")))
    carried = [c for c in files.columns if c != "file_path"]
    missing = (files.join(present, "file_path", "left")
               .select("file_path", *carried, F.explode(F.array_except(
                   wanted, F.coalesce("_present", F.array().cast("array<string>")))).alias("key")))
    seq = F.array_position(wanted, F.col("key")).cast("int") - 1
    msg = F.concat(F.lit("dataset not found "), F.col("key"))
    return missing.select("file_path", *carried, "key", seq.alias("key_seq"),
                          issue(SEVERITY_WARNING, msg, stage).alias("issue"))


def rename_separator(df: DataFrame, old: str = ":", new: str = "/") -> DataFrame:
    """Column names with ``old`` replaced by ``new`` (P10)."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])


def rename_keys(fields: DataFrame, old: str = ":", new: str = "/") -> DataFrame:
    """The long-form equivalent of ``rename_separator``."""
    return fields.withColumn("key", renamed("key", old, new))


def value_json(norm: DataFrame) -> DataFrame:
    """Adds ``value_json``: the normalised value as JSON text. Doubles are
    masked first (NaN / +-Inf become null), so the text is strict JSON."""
    from fieldcat.functions.values import mask_nonfinite
    from pyspark.sql import types as T

    def one(c):
        # to_json of a one-element array, brackets removed: the element's JSON
        return F.regexp_replace(F.to_json(F.array(c)), r"^\[|\]$", "")

    j = F.coalesce(
        F.when(F.col("str_value").isNotNull(), one(F.col("str_value"))),
        F.when(F.col("int_value").isNotNull(), one(F.col("int_value"))),
        F.when(F.col("dbl_value").isNotNull(), one(mask_nonfinite(F.col("dbl_value"), T.DoubleType()))),
        F.when(F.col("str_array").isNotNull(), F.to_json(F.col("str_array"))),
        F.when(F.col("int_array").isNotNull(), F.to_json(F.col("int_array"))),
        F.when(F.col("dbl_array").isNotNull(), F.to_json(mask_nonfinite(F.col("dbl_array")))),
        F.lit("null"))
    return norm.withColumn("value_json", j)


def metadata_json(norm: DataFrame, keys: list[str], out: str = "metadata",
                  files: DataFrame | None = None) -> DataFrame:
    """One JSON object per file, ``{"<key>": <value>, ...}`` in requested-key
    order (F8). A file holds at most len(keys) entries, a fixed bound. With
    ``files`` (file_path), a file without any requested key gets ``{}``."""
    ks = unique_keys(keys)
    wanted = F.array(*[F.lit(k) for k in ks])
    entry = F.concat(F.regexp_replace(F.to_json(F.array("key")), r"^\[|\]$", ""), F.lit(":"),
                     F.col("value_json"))
    per_file = (value_json(select_fields(norm, ks))
                .select("file_path", F.array_position(wanted, F.col("key")).alias("_pos"), entry.alias("_e"))
                .groupBy("file_path").agg(F.array_sort(F.collect_list(F.struct("_pos", "_e"))).alias("_es")))
    if files is not None:
        per_file = files.select("file_path").join(per_file, "file_path", "left")
    body = F.coalesce(F.array_join(F.transform("_es", lambda e: e["_e"]), ","), F.lit(""))
    return per_file.select("file_path", F.concat(F.lit("{"), body, F.lit("}")).alias(out))
