"""Owner group (F3) and access groups (F4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldcat.schemas import BEAMLINE_ALIASES


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def _present(c: Column) -> Column:
    return c.isNotNull() & (c != F.lit(""))


def owner_group(user: Column | str, proposal: Column | str) -> Column:
    """The proposal when there is one (null, empty and the text ``None`` count
    as absent), else the ingesting user."""
    p = _c(proposal)
    return F.when(_present(p) & (p != F.lit("None")), p).otherwise(_c(user))


def access_groups(user: Column | str, beamline: Column | str,
                  aliases: dict[str, list[str]] | None = None) -> Column:
    """[beamline, user, *aliases(beamline)] when a beamline is present, else []."""
    b, u = _c(beamline), _c(user)
    aliases = BEAMLINE_ALIASES if aliases is None else aliases
    empty = F.array().cast("array<string>")
    extra = empty
    for name, groups in reversed(list(aliases.items())):
        extra = F.when(b == F.lit(name), F.array(*[F.lit(g) for g in groups])).otherwise(extra)
    return F.when(_present(b), F.concat(F.array(b, u), extra)).otherwise(empty)
