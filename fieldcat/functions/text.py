"""Search terms (F1) and keywords (F2)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a term is a maximal run of ASCII letters and digits.
TERM_SEPARATOR = "[^a-zA-Z0-9]"
TERM = "[a-zA-Z0-9]+"


def keywords(text: Column | str) -> Column:
    """Split on every non-alphanumeric ASCII character (accented letters are
    separators too), drop empty pieces, lower-case. Null in, null out.

    Extracting the maximal runs of TERM gives exactly the non-empty pieces
    of a split on TERM_SEPARATOR, without materialising the empty ones."""
    c = F.col(text) if isinstance(text, str) else text
    return F.transform(F.regexp_extract_all(c, F.lit(TERM), 0), F.lower)


def search_terms(text: Column | str) -> Column:
    """Keywords joined with one space."""
    return F.array_join(keywords(text), " ")


def renamed(name: Column | str, old: str = ":", new: str = "/") -> Column:
    """A key with ``old`` separators turned into ``new`` ones (P10)."""
    return F.replace(F.col(name) if isinstance(name, str) else name, F.lit(old), F.lit(new))
