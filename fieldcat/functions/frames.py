"""Frame intensity (F9) and 8-bit quantisation (F10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldcat.schemas import INTENSITY_OFFSET, INTENSITY_SCALE


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def frame_intensity(pixels: Column | str) -> Column:
    """205 * ln(p - min + 1.001) / max(ln(q - min + 1.001)) for every pixel;
    the maximum of the logs is the log of the largest pixel. Pixels are
    widened to DOUBLE first (integer frames must not wrap)."""
    px = _c(pixels).cast("array<double>")
    mn, mx = F.array_min(px), F.array_max(px)
    top = F.ln((mx - mn) + F.lit(INTENSITY_OFFSET))
    return F.transform(px, lambda p: F.lit(INTENSITY_SCALE) * F.ln((p - mn) + F.lit(INTENSITY_OFFSET)) / top)


def pixel_intensity(p: Column, frame_min: Column, frame_max: Column) -> Column:
    """The same intensity for one pixel, given its frame's min and max."""
    return (F.lit(INTENSITY_SCALE) * F.ln((p - frame_min) + F.lit(INTENSITY_OFFSET))
            / F.ln((frame_max - frame_min) + F.lit(INTENSITY_OFFSET)))


def quantise(x: Column | str) -> Column:
    """Truncate to an 8-bit level (domain 0..205 for intensities)."""
    return F.floor(_c(x)).cast("int")


def gray_image(levels: Column, width: Column, height: Column) -> Column:
    """The bytes of a portable gray map (binary form) of 8-bit levels in row order."""
    header = F.concat(F.lit("P5\n"), width.cast("string"), F.lit(" "), height.cast("string"), F.lit("\n255\n"))
    body = F.unhex(F.array_join(F.transform(levels, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    return F.concat(F.encode(header, "UTF-8"), body)
