"""Typed staging (CMP1): one projection that trims, nulls blanks, folds accents and casts.

The staging layer is a lazy DataFrame (the reference's views): nothing is cached or
written, so it always reflects the current raw layer.  Casts are ANSI: a value such
as '12.0' for an INT column raises instead of being silently coerced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.functions.text import blank_to_null, fold_accents, jersey_list, normalise_country
from courtline.schemas import BIOS_SPEC, PLAYER_SPEC, STAT_TYPE, TEAM_SPEC


def _typed(raw_col: str, kind: str):
    v = blank_to_null(raw_col)
    if kind == "text":
        return v
    if kind == "fold":
        return fold_accents(v)
    if kind == "long":
        return v.cast("bigint")
    if kind == "int":
        return v.cast("int")
    if kind == "stat":
        return v.cast(STAT_TYPE)
    if kind == "date":
        return v.cast("date")
    if kind == "country":
        return normalise_country(raw_col)
    if kind == "jersey":
        return jersey_list(raw_col)
    raise ValueError(f"unknown staging kind {kind!r}")


def staged_columns(spec: list[tuple[str, str, str]]) -> list[tuple[str, Column]]:
    """The typed, snake_case columns of ``spec``: name and expression."""
    return [(out, _typed(src, kind)) for out, src, kind in spec]


def typed_staging(raw: DataFrame, spec: list[tuple[str, str, str]]) -> DataFrame:
    """Project ``raw`` (all-text) to the columns of ``spec``."""
    return raw.select(*[c.alias(out) for out, c in staged_columns(spec)])


def stage_bios(raw_bios: DataFrame) -> DataFrame:
    return typed_staging(raw_bios, BIOS_SPEC)


def stage_player_boxscores(raw_player: DataFrame) -> DataFrame:
    return typed_staging(raw_player, PLAYER_SPEC)


def stage_team_boxscores(raw_team: DataFrame) -> DataFrame:
    return typed_staging(raw_team, TEAM_SPEC)


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Typed views for a dict of raw tables (keys: bios, player_boxscores, team_boxscores)."""
    return {
        "bios": stage_bios(raw["bios"]),
        "player": stage_player_boxscores(raw["player_boxscores"]),
        "team": stage_team_boxscores(raw["team_boxscores"]),
    }

