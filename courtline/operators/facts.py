"""Fact tables (CMP2-CMP5, CMP12): player fact and the team reconstruction chain.

Physical shape at scale: every fact here is keyed by game.  A store keeps the typed team rows
and the roll-up in buckets of the game, so the opponent self-joins need no exchange and the
player fact's opponent join one, of the player rows.  The roll-up to team-game grain
groups on (team_id, game_id), which a partitioning by game satisfies.  The
bios join goes through AQE, which broadcasts bios at runtime when the measured side is
under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.functions.keys import season_type_key, season_year, team_year_key, year_type_team_key
from courtline.functions.stats import double_double, full_years_between, home_away, triple_double
from courtline.schemas import OPP_STATS, STAT_TYPE, STATS16, SUM_TYPE
from courtline.sources import lookups

KEY_COLUMNS = ["year", "season_type_key", "team_year_key", "year_type_team_key"]


def model_keys(season: str = "season", season_type: str = "season_type",
               team_id: str = "team_id") -> dict[str, Column]:
    """The four model keys derived from a season label, season type and team (CMP12)."""
    return {
        "year": season_year(season),
        "season_type_key": season_type_key(season_type),
        "team_year_key": team_year_key(team_id, season),
        "year_type_team_key": year_type_team_key(season, season_type, team_id),
    }


def player_fact(player_stg: DataFrame, bios_stg: DataFrame, team_stg: DataFrame) -> DataFrame:
    """One row per player x game x team x opponent team row (CMP2).

    Inner join to bios drops players without a bio (see check ``orphan_players``);
    the opponent join keeps every other team row of the same game, so a one-sided
    game drops its rows and a three-team game fans out, exactly as specified.
    """
    # all that the row itself and its bio give is taken before the rows are dealt by the game
    own = ["player_id", "team_id", "game_id", "game_date", "wl", *STATS16]
    bios = bios_stg.select(F.col("player_id").alias("_bio"), "birthdate")
    rows = player_stg.join(bios, F.col("player_id") == F.col("_bio")).select(
        *own, *[e.alias(k) for k, e in model_keys().items()], home_away("matchup").alias("home_away"),
        full_years_between("game_date", "birthdate").alias("age"))
    opp = team_stg.select("game_id", "team_id").alias("opp")
    joined = rows.repartition("game_id").alias("bs").join(
        opp, (F.col("bs.game_id") == F.col("opp.game_id")) & (F.col("bs.team_id") != F.col("opp.team_id")))
    return joined.select(
        F.col("bs.player_id").alias("player_id"),
        F.col("bs.team_id").alias("team_id"),
        F.col("opp.team_id").alias("opponent_id"),
        *[F.col("bs." + k).alias(k) for k in KEY_COLUMNS],
        F.col("bs.game_id").alias("game_id"),
        F.col("bs.game_date").alias("game_date"),
        F.col("bs.age").alias("age"),
        F.col("bs.home_away").alias("home_away"),
        F.col("bs.wl").alias("wl"),
        *[F.col("bs." + c).alias(c) for c in STATS16],
        double_double("bs.").alias("dd2"),
        triple_double("bs.").alias("td3"),
    )


def opponent_join(df: DataFrame, game: str = "game_id", side: str = "team_id",
                  stats: list[str] | None = None, carry: list[str] | None = None,
                  prefix: str = "opp_", opponent_col: str | None = None) -> DataFrame:
    """Attach the other side's statistics of the same game (CMP3).

    An inner equi-join on ``game`` with the residual ``side <> other.side``: every
    row meets every other row of its game.  ``carry`` are the own-side columns kept.
    """
    stats = OPP_STATS if stats is None else stats
    carry = carry if carry is not None else [c for c in df.columns]
    t = df.alias("t")
    o = df.select(game, side, *stats).alias("o")
    out = [F.col("t." + c).alias(c) for c in carry]
    if opponent_col:
        out.insert(carry.index(side) + 1 if side in carry else 0,
                   F.col("o." + side).alias(opponent_col))
    out += [F.col("o." + c).alias(prefix + c) for c in stats]
    return (t.join(o, (F.col("t." + game) == F.col("o." + game))
                   & (F.col("t." + side) != F.col("o." + side)))
            .select(*out))


def team_base(team_stg: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Official team box scores with opponent statistics (team_boxscores_base).

    ``excluded`` (game_id) lists games that are void, the curated ones unless given; their own side goes by an
    anti-join, which is broadcast or not by the list's measured size.  The opponent side is the unfiltered staging table.
    """
    excluded = lookups.excluded_games(team_stg.sparkSession) if excluded is None else excluded
    t = team_stg.join(excluded.select("game_id").distinct(), "game_id", "left_anti")
    keyed = t.withColumns({**model_keys(), "home_away": home_away("matchup")})
    cols = ["team_id", "game_id", "game_date", *KEY_COLUMNS, "home_away", "wl", *STATS16]
    tt = keyed.select(*cols).alias("t")
    o = team_stg.select("game_id", "team_id", *OPP_STATS).alias("o")
    j = tt.join(o, (F.col("t.game_id") == F.col("o.game_id"))
                & (F.col("t.team_id") != F.col("o.team_id")))
    return j.select(
        F.col("t.team_id").alias("team_id"), F.col("o.team_id").alias("opponent_id"),
        F.col("t.game_id").alias("game_id"), F.col("t.game_date").alias("game_date"),
        *[F.col("t." + c).alias(c) for c in KEY_COLUMNS],
        F.col("t.home_away").alias("home_away"), F.col("t.wl").alias("wl"),
        *[F.col("t." + c).alias(c) for c in STATS16],
        *[F.col("o." + c).alias("opp_" + c) for c in OPP_STATS],
    )


def rollup_reconstruct(fine: DataFrame, keys: list[str] | None = None,
                       stats: list[str] | None = None) -> DataFrame:
    """Re-aggregate a finer grain to the coarser one (CMP4): SUM per statistic.

    SUM keeps an all-NULL group NULL (never ``fillna(0)``), so a statistic nobody
    recorded stays missing instead of becoming a false zero.  Partial aggregation
    runs map-side before the shuffle.
    """
    keys = ["team_id", "game_id"] if keys is None else keys
    stats = STATS16 if stats is None else stats
    return fine.groupBy(*keys).agg(*[_total(fine, c).alias(c) for c in stats])


def _total(df: DataFrame, column: str) -> Column:
    """SUM; of whole numbers of a statistic's type as longs, where Spark's own type would be a 20-digit decimal."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType) and kind.scale == 0 and kind.precision <= STAT_TYPE.precision:
        return F.sum(F.col(column).cast("bigint")).cast(SUM_TYPE)
    return F.sum(column)


def backfill(base: DataFrame, recon: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Fill each NULL of ``base`` from ``recon`` per column (CMP5); never overwrite.

    A LEFT join keeps every base row; a non-NULL base value always wins, so the
    per-column coalesce may leave sums such as oreb + dreb != reb (by design).
    """
    b, a = base.alias("b"), recon.select(*keys, *cols).alias("a")
    cond = None
    for k in keys:
        c = F.col("b." + k) == F.col("a." + k)
        cond = c if cond is None else cond & c
    out = [F.coalesce(F.col("b." + c), F.col("a." + c)).alias(c) if c in cols
           else F.col("b." + c).alias(c) for c in base.columns]
    return b.join(a, cond, "left").select(*out)


def team_fact(team_base_df: DataFrame, team_agg_df: DataFrame) -> DataFrame:
    """Final team box scores: official values, gaps filled from the player roll-up."""
    cols = STATS16 + ["opp_" + c for c in OPP_STATS]
    return backfill(team_base_df, team_agg_df, ["game_id", "team_id"], cols)


def build_facts(stg: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The fact chain from staged inputs (keys: bios, player, team)."""
    pf = player_fact(stg["player"], stg["bios"], stg["team"])
    base = team_base(stg["team"])
    only = rollup_reconstruct(pf)
    agg = opponent_join(only, carry=["team_id", "game_id", *STATS16])
    return {
        "player_boxscores": pf,
        "team_boxscores_base": base,
        "team_boxscores_agg_team_only": only,
        "team_boxscores_agg": agg,
        "team_boxscores": team_fact(base, agg),
    }
