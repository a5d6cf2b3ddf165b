"""Dimensions (CMP9, CMP11): seasons, teams-by-era, season types, dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.functions.keys import composite_key, season_year


def dim_seasons(team_stg: DataFrame) -> DataFrame:
    """One row per season: integer year key and the '2025-26' display label."""
    return team_stg.select(season_year("season").alias("year"), F.col("season")).distinct()


def dim_teams(team_stg: DataFrame, logos: DataFrame) -> DataFrame:
    """Team x year with the era-correct name and logo.

    The distinct includes the abbreviation, so a team with two abbreviations in one
    year yields two rows for one ``team_year_key`` (flagged by ``dup_team_year_keys``).
    """
    b = team_stg.select("team_id", "team_abbreviation", "team_name",
                        season_year("season").alias("_year")).distinct()
    j = b.join(logos, (b.team_name == logos.team) & (b._year == logos.year))
    return j.select(
        "team_id", "team_abbreviation", "team_name", logos.year.alias("year"),
        composite_key("team_id", logos.year).alias("team_year_key"),
        logos.logo.alias("logo_by_year"),
    ).distinct()


def dim_date(dates: DataFrame, date_col: str = "game_date") -> DataFrame:
    """Calendar dimension spanning the data's first to last date.

    Only the two bounds reach one row; the calendar itself (a few thousand days per
    decade) is generated by ``sequence`` and exploded.
    """
    bounds = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    d = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return d.select(
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.dayofmonth("date").alias("day"),
        (F.weekday("date") + 1).alias("iso_dow"),
        F.dayofyear("date").alias("day_of_year"),
    )
