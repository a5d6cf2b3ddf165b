"""Career products (CMP6-CMP8): signature team, percentile profile, player dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.functions.stats import height_cm, weight_kg
from courtline.operators.windows import DEFAULT_BUCKETS, bucketed_percent_rank

# ---- fixed values: image URL formats of the player dimension ------------------------
HEADSHOT_URL = ("https://cdn.nba.com/headshots/nba/latest/1040x760/", ".png")
FLAG_URL = ("https://flagcdn.com/", ".svg")

# Career profile axes: output name -> per-season rate column it ranks.
PROFILE_AXES = [("pts", "pts_pg"), ("fg2m", "fg2m_pg"), ("fg3m", "fg3m_pg"), ("ts", "ts"),
                ("ast", "ast_pg"), ("reb", "reb_pg"), ("stl", "stl_pg"), ("blk", "blk_pg")]
QUALIFYING_MINUTES = 1000


def signature_category(weighted: DataFrame, entity: str, group: str, subgroup: list[str],
                       weight: str) -> DataFrame:
    """Pick each entity's main ``group`` and, within it, its main ``subgroup`` row.

    ``weighted`` has one row per (entity, group, *subgroup) with a ``weight``.  The
    main group maximises the summed weight (ties: lowest ``group``); the main
    subgroup maximises its own weight inside that group (ties: ascending subgroup
    columns).  Both are least ordered structs, an aggregate that is combined map-side: the
    second one meets a row per entity and group, and nothing is sorted by entity.
    """
    best = F.struct(*_falling(F.col(weight)), *[F.col(c).alias(c) for c in subgroup], F.col(weight).alias(weight))
    groups = weighted.groupBy(entity, group).agg(F.sum(weight).alias("_total"), F.min(best).alias("_best"))
    top = groups.groupBy(entity).agg(F.min(F.struct(*_falling(F.col("_total")), F.col(group).alias(group), "_best")).alias("_top"))
    at = {group: f"_top.{group}", **{c: f"_top._best.{c}" for c in [*subgroup, weight]}}
    return top.select(*[F.col(at.get(c, c)).alias(c) for c in weighted.columns])


def _falling(value: Column) -> list[Column]:
    """Struct fields whose ascending order is that of ``value`` descending, nulls last."""
    return [value.isNull().alias("_none"), (-value).alias("_falling")]


def season_impact(player_fct: DataFrame) -> DataFrame:
    """Points plus minutes per player, team and season (missing counts as 0); sums that merge by addition."""
    impact = F.sum(F.coalesce(F.col("pts"), F.lit(0)) + F.coalesce(F.col("min"), F.lit(0)))
    return player_fct.groupBy("player_id", "team_id", "year").agg(impact.alias("impact"))


def impact_by_logo(seasons: DataFrame, dim_teams_df: DataFrame) -> DataFrame:
    """Season impacts summed per player x team x era name x logo: the dimension meets a row per season, not one per game."""
    dt = dim_teams_df.select("year", "team_id", "team_name", F.col("logo_by_year").alias("logo"))
    return (seasons.join(dt, ["year", "team_id"]).groupBy("player_id", "team_id", "team_name", "logo")
            .agg(F.sum("impact").alias("impact")))


def signature_of(seasons: DataFrame, dim_teams_df: DataFrame) -> DataFrame:
    """Each player's signature franchise and its most representative era logo, from season impacts."""
    top = signature_category(impact_by_logo(seasons, dim_teams_df), "player_id", "team_id",
                             ["team_name", "logo"], "impact")
    return top.select("player_id", F.col("team_id").alias("main_team_id"),
                      F.col("team_name").alias("main_team_name"),
                      F.col("logo").alias("main_logo"))


def signature_team(player_fct: DataFrame, dim_teams_df: DataFrame) -> DataFrame:
    return signature_of(season_impact(player_fct), dim_teams_df)


def _dsum(c: str) -> Column:
    return F.sum(c).cast("double")


def season_rates(player_fct: DataFrame, entity: str = "player_id", period: str = "year",
                 floor: int | None = QUALIFYING_MINUTES) -> DataFrame:
    """Per entity-period totals and per-game rates; periods under the minutes floor drop.

    Rates are DOUBLE (never a scale-0 decimal).  True shooting is written with integer
    weights, 50*pts / (100*fga + 44*fta), so equal shooting lines give equal doubles.
    """
    n = F.count(F.lit(1))
    per_game = ["min", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk", "tov", "pf", "pts"]
    agg = player_fct.groupBy(entity, period).agg(
        n.alias("gp"),
        F.sum("min").alias("min"),
        *[(_dsum(c) / n).alias(f"{c}_pg") for c in per_game],
        ((F.sum("fgm") - F.sum("fg3m")).cast("double") / n).alias("fg2m_pg"),
        ((F.sum("fga") - F.sum("fg3a")).cast("double") / n).alias("fg2a_pg"),
        F.try_divide((F.sum("pts") * 50).cast("double"),
                     F.nullif(F.sum("fga") * 100 + F.sum("fta") * 44, F.lit(0)).cast("double"))
         .alias("ts"),
        F.sum("dd2").alias("dd2"),
        F.sum("td3").alias("td3"),
    )
    if floor is not None:
        agg = agg.filter(F.col("min") >= floor)
    return agg


def _ranked(rates: DataFrame, entity: str, period: str, axes: list[tuple[str, str]], num_buckets: int) -> DataFrame:
    """A row per entity, period and axis (``_axis``) with its percentile (``_pctl``, 0-100, NULLs rank highest).

    The axes are unpivoted to one long frame so a single :func:`bucketed_percent_rank` pass ranks
    all of them, splitting a crowded period across value ranges.
    """
    long = rates.select(entity, period, *[F.col(c).cast("double").alias(name)
                                          for name, c in axes])
    long = long.unpivot([entity, period], [name for name, _ in axes], "_axis", "_v")
    return bucketed_percent_rank(long, [period, "_axis"], "_v", "_pctl", num_buckets, scale=100.0)


def percentile_profile(rates: DataFrame, entity: str = "player_id", period: str = "year",
                       axes: list[tuple[str, str]] | None = None,
                       num_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Rank every axis within its period and average per entity; one aggregation gives the columns."""
    axes = PROFILE_AXES if axes is None else axes
    return _ranked(rates, entity, period, axes, num_buckets).groupBy(entity).agg(
        *[F.avg(F.when(F.col("_axis") == name, F.col("_pctl"))).alias(f"{name}_pctl")
          for name, _ in axes])


def season_percentiles(rates: DataFrame, entity: str = "player_id", period: str = "year",
                       axes: list[tuple[str, str]] | None = None,
                       num_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """The percentiles of each entity and period: a period depends on its own rows alone."""
    axes = PROFILE_AXES if axes is None else axes
    return _ranked(rates, entity, period, axes, num_buckets).groupBy(entity, period).agg(
        *[F.max(F.when(F.col("_axis") == name, F.col("_pctl"))).alias(f"{name}_pctl")
          for name, _ in axes])


def career_profile(seasons: DataFrame, entity: str = "player_id",
                   axes: list[tuple[str, str]] | None = None) -> DataFrame:
    """Averages of season percentiles per entity."""
    return seasons.groupBy(entity).agg(*[F.avg(f"{name}_pctl").alias(f"{name}_pctl")
                                         for name, _ in (PROFILE_AXES if axes is None else axes)])


def career_percentiles(player_fct: DataFrame, floor: int = QUALIFYING_MINUTES) -> DataFrame:
    return percentile_profile(season_rates(player_fct, floor=floor))


def player_dim(bios_stg: DataFrame, country_codes: DataFrame, overrides: DataFrame,
               signature: DataFrame, profile: DataFrame) -> DataFrame:
    """One row per bio with display name, metric units, images and career products.

    The two curated lookups are small, so that joins with them are broadcast by their measured size;
    signature and profile are one row per player and join on player_id.
    """
    b = bios_stg.alias("b")
    codes = country_codes.alias("codes")
    names = overrides.alias("names")
    main = signature.alias("main")
    career = profile.alias("career")
    j = (b.join(codes, F.col("b.country") == F.col("codes.country"), "left")
         .join(main, F.col("b.player_id") == F.col("main.player_id"), "left")
         .join(names, F.col("b.player_id") == F.col("names.player_id"), "left")
         .join(career, F.col("b.player_id") == F.col("career.player_id"), "left"))
    pct = ["pts_pctl", "fg2m_pctl", "fg3m_pctl", "ts_pctl", "ast_pctl", "reb_pctl",
           "stl_pctl", "blk_pctl"]
    return j.select(
        F.col("b.player_id").alias("player_id"),
        F.coalesce(F.col("names.name_override"), F.col("b.display_first_last")).alias("player_name"),
        *[F.col("b." + c).alias(c) for c in ["birthdate", "school", "country", "height"]],
        height_cm("b.height").alias("height_cm"),
        F.col("b.weight").alias("weight"),
        weight_kg("b.weight").alias("weight_kg"),
        *[F.col("b." + c).alias(c) for c in ["season_exp", "jersey", "position", "from_year",
                                             "to_year", "draft_year", "draft_round",
                                             "draft_number"]],
        F.concat(F.lit(HEADSHOT_URL[0]), F.col("b.player_id").cast("string"),
                 F.lit(HEADSHOT_URL[1])).alias("player_img"),
        F.concat(F.lit(FLAG_URL[0]), F.col("codes.code"), F.lit(FLAG_URL[1])).alias("country_flag"),
        F.col("main.main_team_id").alias("main_team_id"),
        F.col("main.main_team_name").alias("main_team_name"),
        F.col("main.main_logo").alias("main_logo"),
        *[F.col("career." + c).alias(c) for c in pct],
    )
