"""Value normalisation helpers: defaults (F5), non-finite masking (F6),
widening (F7) and the array stride sample (K3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcat.schemas import SAMPLE_SIZE, UNKNOWN


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def default_unknown(c: Column | str, default: str = UNKNOWN) -> Column:
    """Null or empty becomes ``Unknown``."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(default))


def _mask_scalar(x: Column) -> Column:
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)


def mask_nonfinite(c: Column | str, dtype: T.DataType = T.ArrayType(T.DoubleType())) -> Column:
    """NaN and +/-Inf become null, at any array depth; strings pass through."""
    c = _c(c)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: mask_nonfinite(x, dtype.elementType))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _mask_scalar(c)
    return c


def widen(c: Column | str, dtype: T.DataType) -> Column:
    """Integers to BIGINT, floats to DOUBLE (arrays element-wise)."""
    c = _c(c)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: widen(x, dtype.elementType))
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.cast("double")
    return c


def safe_size(c: Column | str) -> Column:
    """Array length, null for a null array whatever the ANSI setting (without
    ANSI mode ``size(null)`` would be -1)."""
    c = _c(c)
    return F.when(c.isNotNull(), F.size(c))


def stride_step(n: Column, sample_size: int = SAMPLE_SIZE) -> Column:
    """max(n div sample_size, 1)."""
    return F.greatest(F.floor(n / F.lit(sample_size)).cast("bigint"), F.lit(1).cast("bigint"))


def stride_array(c: Column | str, sample_size: int = SAMPLE_SIZE) -> Column:
    """Every step-th element from the first, step = max(len div sample_size, 1):
    len < sample_size keeps all, otherwise sample_size..2*sample_size-1 elements."""
    c = _c(c)
    step = stride_step(F.size(c), sample_size)
    return F.filter(c, lambda x, i: (i % step) == 0)
