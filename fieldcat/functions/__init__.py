"""Column expressions. Every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from fieldcat.functions.access import access_groups, owner_group
from fieldcat.functions.files import basename, data_uri, local_time_text, parent_dir
from fieldcat.functions.frames import frame_intensity, quantise
from fieldcat.functions.ids import natural_id, new_id
from fieldcat.functions.issues import issue
from fieldcat.functions.text import keywords, search_terms
from fieldcat.functions.values import (
    default_unknown, mask_nonfinite, safe_size, stride_array, stride_step, widen,
)

__all__ = [
    "access_groups", "owner_group", "basename", "data_uri", "local_time_text",
    "parent_dir", "frame_intensity", "quantise", "natural_id", "new_id", "issue",
    "keywords", "search_terms", "default_unknown", "mask_nonfinite", "safe_size", "stride_array",
    "stride_step", "widen",
]
