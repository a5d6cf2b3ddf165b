"""Data-quality checks (DQ1-DQ10), each a DataFrame whose rows are findings.

Every check is distributed: anti/semi joins and grouped counts, never a collect.
Parity checks return labelled counts (``source``, ``n``) instead of two unlabelled
rows, so the order of the union does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.functions.keys import season_year

MISSING_STATS = ["oreb", "dreb", "stl", "blk", "tov"]


def orphan_keys(fact: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct fact keys with no dimension row (LEFT JOIN ... IS NULL)."""
    return fact.select(*keys).join(dim.select(*keys), keys, "left_anti").distinct()


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys occurring more than once, with their count (GROUP BY ... HAVING > 1)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
            .filter(F.col("count") > 1))


def count_parity(**named: DataFrame) -> DataFrame:
    """Labelled row counts of several DataFrames; equal counts mean the check passed."""
    out = None
    for label, df in named.items():
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(label).alias("source"), "n")
        out = c if out is None else out.unionByName(c)
    return out


def orphan_players(player_stg: DataFrame, bios_stg: DataFrame) -> DataFrame:
    """DQ1: box-score player ids with no bio (the fact's inner join would drop them)."""
    return orphan_keys(player_stg, bios_stg, ["player_id"])


def dup_player_rows(player_stg: DataFrame) -> DataFrame:
    """DQ2: repeated (player, game, team)."""
    return duplicate_keys(player_stg, ["player_id", "game_id", "team_id"])


def dup_team_rows(team_stg: DataFrame) -> DataFrame:
    """DQ3: repeated (game, team)."""
    return duplicate_keys(team_stg, ["game_id", "team_id"])


def missing_logos(team_stg: DataFrame, logos: DataFrame) -> DataFrame:
    """DQ4: team-seasons with no era logo."""
    b = team_stg.select("team_name", season_year("season").alias("year"))
    lk = logos.select(F.col("team").alias("team_name"), "year")
    return b.join(lk, ["team_name", "year"], "left_anti").distinct()


def fact_parity(player_fct: DataFrame, player_stg: DataFrame) -> DataFrame:
    """DQ5: the player fact keeps the staging row count."""
    return count_parity(player_boxscores=player_fct, v_player_boxscores=player_stg)


def self_join_parity(team_stg: DataFrame) -> DataFrame:
    """DQ6: the opponent self-join keeps the team row count."""
    t, o = team_stg.select("game_id", "team_id").alias("t"), \
        team_stg.select("game_id", "team_id").alias("o")
    joined = t.join(o, (F.col("t.game_id") == F.col("o.game_id"))
                    & (F.col("t.team_id") != F.col("o.team_id")))
    return count_parity(opponent_join=joined, v_team_boxscores=team_stg)


def homonyms(dim_players_df: DataFrame) -> DataFrame:
    """DQ7: players sharing a display name (candidates for a name override)."""
    dupes = duplicate_keys(dim_players_df, ["player_name"]).select("player_name")
    return (dim_players_df.select("player_name", "player_id", "birthdate")
            .join(dupes, "player_name", "left_semi"))


def dup_dim_players(dim_players_df: DataFrame) -> DataFrame:
    """DQ8: repeated player_id in the player dimension."""
    return duplicate_keys(dim_players_df, ["player_id"])


def percent_1dp(part: Column, whole: Column) -> Column:
    """100 * part / whole rounded half-up to one decimal, exactly (integer arithmetic)."""
    num = part * 2000 + whole
    den = whole * 2
    return ((num - F.pmod(num, den)) / den).cast("double") / 10


def completeness_by_season(team_stg: DataFrame, stats: list[str] | None = None,
                           period: Column | None = None) -> DataFrame:
    """DQ9: games per season and the percent of rows missing each statistic."""
    stats = MISSING_STATS if stats is None else stats
    period = season_year("season").alias("year") if period is None else period
    n = F.count(F.lit(1))
    return (team_stg.groupBy(period)
            .agg(n.alias("games"),
                 *[percent_1dp(F.count_if(F.col(c).isNull()), n).alias(f"pct_missing_{c}")
                   for c in stats]))


def dim_parity(dim_players_df: DataFrame, bios_stg: DataFrame) -> DataFrame:
    """DQ10: the player dimension keeps every bio."""
    return count_parity(dim_players=dim_players_df, v_bios=bios_stg)
