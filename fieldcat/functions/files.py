"""File-path and time-text helpers (F11-F13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldcat.schemas import THUMBNAIL_TYPE


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def basename(path: Column | str) -> Column:
    return F.regexp_extract(_c(path), r"([^/]+)$", 1)


def parent_dir(path: Column | str) -> Column:
    """Like a path's parent: '/a' -> '/', 'a' -> '.', '/x/y/a' -> '/x/y'."""
    p = _c(path)
    stripped = F.regexp_replace(p, r"/+[^/]*$", "")
    return (F.when(~p.contains("/"), F.lit("."))
            .when(stripped == F.lit(""), F.lit("/"))
            .when(stripped.endswith(":"), F.concat(stripped, F.lit("/")))
            .otherwise(stripped))


def local_time_text(ts: Column | str) -> Column:
    """'YYYY-MM-DD HH:MM:SS', with '.ffffff' only when the microseconds are
    not zero (the text form of a datetime). Uses the session time zone."""
    t = _c(ts)
    micros = F.date_format(t, "SSSSSS")
    return F.when(micros == F.lit("000000"), F.date_format(t, "yyyy-MM-dd HH:mm:ss")) \
        .otherwise(F.date_format(t, "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def data_uri(content: Column | str, image_type: str = THUMBNAIL_TYPE) -> Column:
    """'data:image/<type>;base64,' + one-line base64 of the bytes."""
    encoded = F.regexp_replace(F.base64(_c(content)), r"[\r\n]", "")
    return F.concat(F.lit(f"data:image/{image_type};base64,"), encoded)
