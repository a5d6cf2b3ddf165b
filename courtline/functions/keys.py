"""Season parsing and composite keys.

Composite keys use ``||`` semantics: any NULL part makes the key NULL (``concat``),
never ``concat_ws``, which would silently skip the missing part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: season-type labels and their keys --------------------------------
SEASON_TYPES = [(1, "Regular Season"), (2, "Playoffs")]


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def season_year_text(season: Column | str) -> Column:
    """``LEFT(season, 4)``: '2025-26' -> '2025'."""
    return F.substring(_c(season), 1, 4)


def season_year(season: Column | str) -> Column:
    """Start year of a '2025-26' season label as INT."""
    return season_year_text(season).cast("int")


def season_type_key(season_type: Column | str) -> Column:
    """Label -> key; other labels give NULL (no ELSE)."""
    c = _c(season_type)
    out = None
    for key, label in SEASON_TYPES:
        out = F.when(c == label, F.lit(key)) if out is None else out.when(c == label, F.lit(key))
    return out


def composite_key(*parts: Column | str) -> Column:
    """'a|b|c' from the parts, NULL if any part is NULL."""
    cols = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("|"))
        cols.append(_c(p).cast("string"))
    return F.concat(*cols)


def team_year_key(team_id: Column | str, season: Column | str) -> Column:
    return composite_key(team_id, season_year_text(season))


def year_type_team_key(season: Column | str, season_type: Column | str,
                       team_id: Column | str) -> Column:
    return composite_key(season_year_text(season), season_type_key(season_type), team_id)
