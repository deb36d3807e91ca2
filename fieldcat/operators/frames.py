"""Image frames: first frames (S3), per-frame statistics (A5) and the
percentile-clipped contrast stretch (A6, F10).

Frames are rows (one frame per row, pixels in an array) or, for the
stretch, pixels in long form (one row per pixel). The stretch never gathers
a frame's pixels: it counts a histogram per frame (at most 256 bins, a
partial aggregate), derives the cut points from cumulative counts over those
bins, and maps every pixel with the frame's two bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldcat.functions.frames import frame_intensity, gray_image, quantise
from fieldcat.functions.frames import pixel_intensity
from fieldcat.schemas import AUTOCONTRAST_CUTOFF_PERCENT


def first_frames(frames: DataFrame, n: int = 1, frame_col: str = "frame_idx") -> DataFrame:
    """Frames 0..n-1 of every stack: a filter Spark pushes into the scan."""
    return frames.where(F.col(frame_col) < n)


def frame_stats(frames: DataFrame, pixels: str = "pixels") -> DataFrame:
    """Adds frame_min / frame_max (as DOUBLE)."""
    px = F.col(pixels).cast("array<double>")
    return frames.withColumn("frame_min", F.array_min(px)).withColumn("frame_max", F.array_max(px))


def intensity_pixels(frames: DataFrame, keys: list[str], pixels: str = "pixels") -> DataFrame:
    """Long form (keys..., pos, intensity): the frame's min and max are taken
    from the array, then every pixel is one row and the maths is scalar, so
    the whole expression stays in generated code (no lambda per pixel)."""
    px = F.col(pixels).cast("array<double>")
    return (frames.select(*keys, F.array_min(px).alias("_mn"), F.array_max(px).alias("_mx"),
                          F.posexplode(px).alias("pos", "_p"))
            .select(*keys, F.col("pos").cast("bigint").alias("pos"),
                    pixel_intensity(F.col("_p"), F.col("_mn"), F.col("_mx")).alias("intensity")))


def thumbnails(frames: DataFrame) -> DataFrame:
    """(file_path, content) of ``frames`` (file_path, frame_idx, height, width, pixels): the first
    frame of each file, as intensity (F9), cut to 8 bits (F10), as the bytes of a gray image.
    Levels are cut after rounding to nine digits, so the brightest pixel is 205 everywhere."""
    levels = F.transform(frame_intensity("pixels"), lambda v: quantise(F.round(v, 9)))
    return first_frames(frames).select("file_path", gray_image(levels, F.col("width"), F.col("height")).alias("content"))


def contrast_bounds(pixels: DataFrame, frame_keys: list[str], value: str,
                    cutoff: float = AUTOCONTRAST_CUTOFF_PERCENT) -> DataFrame:
    """(frame, lo, hi) after cutting ``cutoff`` percent of the pixels at each
    end of the 8-bit histogram: cut = floor(n * cutoff / 100); lo = least
    level whose cumulative count exceeds cut; hi = greatest level whose
    reverse cumulative count exceeds cut."""
    hist = pixels.groupBy(*frame_keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*frame_keys)
    up = w.orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = w.orderBy(F.col("_v").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = (hist.withColumn("_n", F.sum("_c").over(w))
         .withColumn("_cum", F.sum("_c").over(up))
         .withColumn("_rcum", F.sum("_c").over(down))
         .withColumn("_cut", F.floor(F.col("_n") * F.lit(float(cutoff)) / F.lit(100.0))))
    return h.groupBy(*frame_keys).agg(
        F.min(F.when(F.col("_cum") > F.col("_cut"), F.col("_v"))).alias("lo"),
        F.max(F.when(F.col("_rcum") > F.col("_cut"), F.col("_v"))).alias("hi"))


def stretch_level(v, lo, hi):
    """The lookup of an autocontrast: v unchanged when hi <= lo, else
    clamp(trunc(v * 255/(hi-lo) - lo * 255/(hi-lo)), 0, 255)."""
    scale = F.lit(255.0) / (hi - lo).cast("double")
    offset = -lo.cast("double") * scale
    mapped = F.floor(v.cast("double") * scale + offset)
    clamped = F.least(F.greatest(mapped, F.lit(0)), F.lit(255)).cast("int")
    return F.when(hi <= lo, v.cast("int")).otherwise(clamped)


def contrast_stretch(pixels: DataFrame, frame_keys: list[str], value: str,
                     cutoff: float = AUTOCONTRAST_CUTOFF_PERCENT, out: str = "stretched") -> DataFrame:
    """Every pixel with its stretched level. The bounds table has one row
    per frame; AQE broadcasts it when small and otherwise joins by frame,
    splitting a frame with very many pixels (skew join)."""
    b = contrast_bounds(pixels, frame_keys, value, cutoff)
    return (pixels.join(b, frame_keys)
            .withColumn(out, stretch_level(F.col(value), F.col("lo"), F.col("hi"))))
