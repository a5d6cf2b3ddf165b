"""Semantic-layer measures as explicit grouped aggregations (ME1-ME14, MX1-MX8).

A BI measure is a function of its filter context.  Here the context is explicit: a
group grain (e.g. player x season x season type) plus three scopes built from additive
totals, each a grouped aggregation followed by equi-joins on the grain:

* player scope - sums of the player fact over the group;
* team scope - the distinct ``year_type_team_key`` values the group touched, joined
  to per-key team totals and summed (a traded player sees every game of every team
  he played for that season, including games he missed);
* league scope - every (year, season type) pair in the cross product of the group's
  years and season types, joined to per-pair league totals and summed.  Built with two
  equi-joins (years -> league pairs, then semi-match on the group's types), never a
  cross join.

BLANK arithmetic follows the semantic layer: in ``+`` and ``-`` a missing operand
counts as zero (the result is missing only when every operand is), ``*`` and ``/``
propagate it, and ``DIVIDE`` gives missing on a zero or missing denominator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtline.schemas import OPP_STATS, STATS16

# ---- fixed values: measure constants -------------------------------------------------
STATS_COMPLETE_FROM_YEAR = 1983   # reliability cutoff of the reference data
FTA_WEIGHT_TS = 0.44              # free-throw weight in true shooting and PER
FTA_WEIGHT_POSS = 0.4             # free-throw weight in possessions
OREB_WEIGHT_POSS = 1.07           # offensive-rebound weight in possessions
PER_LEAGUE_AVERAGE = 15.0         # PER is scaled so the league average is 15
HIDE_COLOR, SHOW_COLOR = "#DFE3EC", "#00000000"
DISCLAIMER = ("Advanced metrics and complete columns are available for seasons from "
              "1983–84 onward, when the NBA's box-score data became complete.")

TEAM_COLS = [f"tm_{c}" for c in STATS16] + [f"opp_{c}" for c in OPP_STATS]


# ---- BLANK-aware arithmetic ----------------------------------------------------------
def b_add(*terms: Column) -> Column:
    """Sum where a missing term counts as 0; missing only if every term is missing."""
    any_present = None
    total = None
    for t in terms:
        present = t.isNotNull()
        any_present = present if any_present is None else any_present | present
        v = F.coalesce(t, F.lit(0.0))
        total = v if total is None else total + v
    return F.when(any_present, total)


def b_sub(a: Column, b: Column) -> Column:
    return b_add(a, -b)


def divide(a: Column, b: Column) -> Column:
    """DIVIDE(a, b): missing on a zero or missing denominator."""
    return F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0)))


def _d(c: str) -> Column:
    return F.col(c).cast("double")


# ---- additive totals ---------------------------------------------------------------
#: What every scope of a measure is a union of: an entity's games for one team, season and season type.
KEY = ["year", "season_type_key", "year_type_team_key"]


def player_sums(player_fct: DataFrame) -> DataFrame:
    """The player fact's sums per player and key: one scan, from which all scopes are summed on.

    Every measure reads a fact through such sums only, so it takes this table in the fact's place.
    """
    return player_fct.groupBy("player_id", *KEY).agg(*[F.sum(c).alias(c) for c in STATS16])


def team_sums(team_fct: DataFrame) -> DataFrame:
    """The team fact's sums and number of ``games`` per team and key, in the fact's place likewise."""
    return team_fct.groupBy("team_id", *KEY).agg(
        F.count(F.lit(1)).alias("games"), *[F.sum(c).alias(c) for c in STATS16],
        *[F.sum(f"opp_{c}").alias(f"opp_{c}") for c in OPP_STATS])


def team_totals(team_fct: DataFrame, keys: list[str]) -> DataFrame:
    """Team-fact sums as tm_* / opp_* plus ``tm_gp`` (games) per ``keys``."""
    games = F.sum("games") if "games" in team_fct.columns else F.count(F.lit(1))
    return team_fct.groupBy(*keys).agg(
        games.alias("tm_gp"),
        *[F.sum(c).alias(f"tm_{c}") for c in STATS16],
        *[F.sum(f"opp_{c}").alias(f"opp_{c}") for c in OPP_STATS])


def player_totals(player_fct: DataFrame, keys: list[str], prefix: str = "p_") -> DataFrame:
    return player_fct.groupBy(*keys).agg(*[F.sum(c).alias(prefix + c) for c in STATS16])


def with_cutoff(df: DataFrame, cutoff: int | None) -> DataFrame:
    return df if cutoff is None else df.filter(F.col("year") >= cutoff)


def team_scope(player_fct: DataFrame, team_fct: DataFrame, grain: list[str],
               cutoff: int | None = None, floor_games: bool = False,
               keep_all_groups: bool = False) -> DataFrame:
    """Team totals over the distinct team keys each group touched (many-to-many link).

    With ``cutoff``, totals count only keys of seasons from the cutoff on; with
    ``floor_games`` the same pass also counts team games over every season
    (``floor_gp``, the PER minutes floor), so one join serves both scopes.
    ``keep_all_groups`` keeps groups whose keys match no team row (totals NULL).
    """
    keys = player_fct.select(*grain, "year_type_team_key", "year").distinct()
    per_key = team_totals(team_fct, ["year_type_team_key"])
    j = keys.join(per_key, "year_type_team_key", "left" if keep_all_groups else "inner")
    inside = F.lit(True) if cutoff is None else F.col("year") >= cutoff
    sums = [F.sum(F.when(inside, F.col(c))).alias(c) for c in ["tm_gp"] + TEAM_COLS]
    if floor_games:
        sums.append(F.sum("tm_gp").alias("floor_gp"))
    return j.groupBy(*grain).agg(*sums)


def league_pairs(player_fct: DataFrame, grain: list[str], pair_totals: DataFrame) -> DataFrame:
    """Join each group to the totals of every (year, type) in years(group) x types(group)."""
    ycols = list(dict.fromkeys(grain + ["year"]))
    tcols = list(dict.fromkeys(grain + ["season_type_key"]))
    years = player_fct.select(*ycols).distinct()
    types = player_fct.select(*tcols).distinct()
    lt = pair_totals
    if "season_type_key" in grain:
        lt = lt.withColumnRenamed("season_type_key", "_lt_type")
        j = years.join(lt, "year")
        j = j.filter(F.col("_lt_type") == F.col("season_type_key")).drop("_lt_type")
        return j.join(types, tcols, "left_semi")
    j = years.join(lt, "year")
    return j.join(types, tcols, "left_semi")


def league_scope(player_fct: DataFrame, team_fct: DataFrame, grain: list[str]) -> DataFrame:
    """League totals (team-fact lg_* and player-fact lp_*) summed over each group's pairs."""
    pair_keys = ["year", "season_type_key"]
    lg = team_totals(team_fct, pair_keys)
    lg = lg.select(*pair_keys, *[F.col(c).alias("lg_" + c) for c in ["tm_gp"] + TEAM_COLS])
    lp = player_totals(player_fct, pair_keys, "lp_")
    totals = lg.join(lp, pair_keys, "left")
    value_cols = [c for c in totals.columns if c not in pair_keys]
    pairs = league_pairs(player_fct, grain, totals)
    return pairs.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in value_cols])


# ---- measure formulas ----------------------------------------------------------------
def possessions(t: str, o: str) -> Column:
    """Two-sided possession estimate from columns ``{t}x`` (own) and ``{o}x`` (opponent)."""
    def side(a: str, b: str) -> Column:
        return b_add(
            _d(a + "fga"),
            F.lit(FTA_WEIGHT_POSS) * _d(a + "fta"),
            -(F.lit(OREB_WEIGHT_POSS) * divide(_d(a + "oreb"), b_add(_d(a + "oreb"), _d(b + "dreb")))
              * b_sub(_d(a + "fga"), _d(a + "fgm"))),
            _d(a + "tov"))
    return F.lit(0.5) * b_add(side(t, o), side(o, t))


def pace(poss: Column, minutes: Column) -> Column:
    return F.lit(48.0) * divide(poss, divide(minutes, F.lit(5.0)))


def league_constants() -> dict[str, Column]:
    """factor, VOP, league DREB%, FTM/PF and FTA/PF from league sums ``lg_tm_*``."""
    ast, fg, ft = _d("lg_tm_ast"), _d("lg_tm_fgm"), _d("lg_tm_ftm")
    return {
        "factor": b_sub(F.lit(2.0) / 3, divide(F.lit(0.5) * divide(ast, fg),
                                              F.lit(2.0) * divide(fg, ft))),
        "vop": divide(_d("lg_tm_pts"), b_add(_d("lg_tm_fga"), -_d("lg_tm_oreb"), _d("lg_tm_tov"),
                                             F.lit(FTA_WEIGHT_TS) * _d("lg_tm_fta"))),
        "lg_dreb_pct": divide(b_sub(_d("lg_tm_reb"), _d("lg_tm_oreb")), _d("lg_tm_reb")),
        "lg_ftm_pf": divide(_d("lg_tm_ftm"), _d("lg_tm_pf")),
        "lg_fta_pf": divide(_d("lg_tm_fta"), _d("lg_tm_pf")),
        "lg_poss": possessions("lg_tm_", "lg_opp_"),
    }


def unadjusted_per(p: str, tm_ast: Column, tm_fgm: Column) -> Column:
    """Hollinger's unadjusted PER from player sums ``{p}x`` and team assist ratio.

    Needs the league constants as columns (factor, vop, lg_dreb_pct, lg_ftm_pf, lg_fta_pf).
    """
    ratio = divide(tm_ast, tm_fgm)
    factor, vop, dreb = F.col("factor"), F.col("vop"), F.col("lg_dreb_pct")
    two3 = F.lit(2.0) / 3
    x = lambda c: _d(p + c)
    body = b_add(
        x("fg3m"),
        two3 * x("ast"),
        b_sub(F.lit(2.0), factor * ratio) * x("fgm"),
        x("ftm") * F.lit(0.5) * b_add(F.lit(1.0), b_sub(F.lit(1.0), ratio), two3 * ratio),
        -(vop * x("tov")),
        -(vop * dreb * b_sub(x("fga"), x("fgm"))),
        -(vop * F.lit(FTA_WEIGHT_TS) * b_add(F.lit(FTA_WEIGHT_TS), F.lit(0.56) * dreb)
          * b_sub(x("fta"), x("ftm"))),
        vop * b_sub(F.lit(1.0), dreb) * b_sub(x("reb"), x("oreb")),
        vop * dreb * x("oreb"),
        vop * x("stl"),
        vop * dreb * x("blk"),
        -(x("pf") * b_sub(F.col("lg_ftm_pf"),
                          F.lit(FTA_WEIGHT_TS) * F.col("lg_fta_pf") * vop)),
    )
    return divide(F.lit(1.0), x("min")) * body


def per_frame(player_fct: DataFrame, team_fct: DataFrame, grain: list[str],
              cutoff: int | None = STATS_COMPLETE_FROM_YEAR,
              mpg_floor: float = 0.0) -> DataFrame:
    """u_per, a_per, lga_per and per for every group of ``grain``.

    The minutes floor is ``mpg_floor`` x team games counted over all seasons (it is
    bound outside the cutoff), while the minutes compared with it are the cutoff's.
    """
    pf_c, tf_c = with_cutoff(player_fct, cutoff), with_cutoff(team_fct, cutoff)
    p = player_totals(pf_c, grain)
    # every group appears here (all seasons), carrying in-cutoff team totals + floor games
    t = team_scope(player_fct, team_fct, grain, cutoff=cutoff, floor_games=True,
                   keep_all_groups=True)
    lg = league_scope(pf_c, tf_c, grain)
    return _per_measures(t.join(p, grain, "left").join(lg, grain, "left"), mpg_floor).select(*grain, *PER_MEASURES)


PER_MEASURES = ["u_per", "a_per", "lga_per", "per"]


def _per_measures(j: DataFrame, mpg_floor: float) -> DataFrame:
    """The PER chain on rows that have player (p_), team (tm_, opp_, floor_gp) and league (lg_, lp_) sums."""
    j = j.withColumns(league_constants())
    j = j.withColumns({
        "pace": pace(possessions("tm_", "opp_"), _d("tm_min")),
        "lg_pace": pace(F.col("lg_poss"), _d("lg_tm_min")),
        "u_per": unadjusted_per("p_", _d("tm_ast"), _d("tm_fgm")),
        # league as one player: its own team and league totals, pace ratio 1
        "_lg_u_per": unadjusted_per("lp_", _d("lg_tm_ast"), _d("lg_tm_fgm")),
    })
    j = j.withColumns({
        "a_per": F.col("u_per") * divide(F.col("lg_pace"), F.col("pace")),
        "lga_per": divide(F.col("_lg_u_per") * divide(F.col("lg_pace"), F.col("lg_pace"))
                          * _d("lp_min"), _d("lp_min")),
    })
    floor = F.lit(float(mpg_floor)) * F.coalesce(_d("floor_gp"), F.lit(0.0))
    return j.withColumn("per", F.when(_d("p_min") >= floor,
                                      F.col("a_per") * divide(F.lit(PER_LEAGUE_AVERAGE),
                                                              F.col("lga_per"))))


#: Grains of a player by the grouping id of (player_id, year, season_type_key); 4 is the league's (year, type).
PLAYER_GRAINS = {0: "season type", 1: "season", 3: "career"}
_LEAGUE_GRAIN = 4


def team_scopes(team_sum: DataFrame) -> DataFrame:
    """Team sums per team key and per (year, season type), by grouping sets in one pass; ``_g`` tells which."""
    key, pair = ["year_type_team_key"], ["year", "season_type_key"]
    sets = [[F.col(c) for c in s] for s in (key, pair)]
    return team_sum.groupingSets(sets, *(F.col(c) for c in key + pair)).agg(
        F.grouping_id().alias("_g"), F.sum("games").alias("tm_gp"), *[F.sum(c).alias(f"tm_{c}") for c in STATS16],
        *[F.sum(f"opp_{c}").alias(f"opp_{c}") for c in OPP_STATS])


_KEY_SET, _PAIR_SET = 3, 4  # grouping ids of the two sets above


def player_scopes(player_sum: DataFrame, by_key: DataFrame, cutoff: int | None) -> DataFrame:
    """Player sums, team scopes and the seasons and types of every grain, by grouping sets in one pass.

    A row of ``player_sum`` has one team key, so the team totals of ``by_key`` are added to it once, and every
    grain sums rows.  The sets of years and types of a group are as small as the seasons there are.
    """
    rows = player_sum.join(by_key, "year_type_team_key", "left")
    inside = F.lit(True) if cutoff is None else F.col("year") >= cutoff
    cols = ["player_id", "year", "season_type_key"]
    sets = [[F.col(c) for c in s] for s in (cols, cols[:2], cols[:1], cols[1:])]
    sums = [*(f"p_{c}" for c in STATS16), "tm_gp", *TEAM_COLS, "floor_gp"]
    rows = rows.select(*cols, *[F.when(inside, F.col(c)).alias(f"p_{c}") for c in STATS16],
                       *[F.when(inside, F.col(c)).alias(c) for c in ["tm_gp", *TEAM_COLS]], F.col("tm_gp").alias("floor_gp"))
    # the finest grain first: the other grains, and the sets, are taken from its rows, a few per player
    finest = rows.groupBy(*cols).agg(*[F.sum(c).alias(c) for c in sums])
    # the values are other columns than the grouped ones, which are null in coarser sets
    finest = finest.select("*", F.when(inside, F.col("year")).alias("_y"), F.when(inside, F.col("season_type_key")).alias("_t"))
    return finest.groupingSets(sets, *(F.col(c) for c in cols)).agg(
        F.grouping_id().alias("_g"), F.collect_set("_y").alias("_years"), F.collect_set("_t").alias("_types"),
        *[F.sum(c).alias(c) for c in sums])


def per_grains(player_sum: DataFrame, team_sum: DataFrame, cutoff: int | None = STATS_COMPLETE_FROM_YEAR,
               mpg_floor: float = 0.0, keep=lambda name, df: df) -> DataFrame:
    """PER of players per season and type, per season and over careers, from one pass over each table of sums.

    ``keep(name, df)`` may store the two tables of scopes, which the plan reads more than once.
    """
    teams = keep("team_scopes", team_scopes(team_sum))
    by_key = teams.filter(F.col("_g") == _KEY_SET).drop("_g", "year", "season_type_key")
    scopes = keep("player_scopes", player_scopes(player_sum, by_key, cutoff))
    pair = ["year", "season_type_key"]
    players = scopes.filter(F.col("_g") == _LEAGUE_GRAIN).select(*pair, *[F.col(f"p_{c}").alias(f"lp_{c}") for c in STATS16])
    league = with_cutoff(teams.filter(F.col("_g") == _PAIR_SET), cutoff) \
        .select(*pair, *[F.col(c).alias("lg_" + c) for c in ["tm_gp", *TEAM_COLS]]).join(players, pair, "left")
    league = league.withColumnsRenamed({"year": "_y", "season_type_key": "_t"})
    groups = scopes.filter(F.col("_g") != _LEAGUE_GRAIN)
    group = ["_g", "player_id", *pair]
    pairs = groups.select(*group, F.explode("_years").alias("_y"), "_types").select(*group, "_y", F.explode("_types").alias("_t"))
    sums = [c for c in league.columns if c not in ("_y", "_t")]
    scope = pairs.join(league, ["_y", "_t"]).groupBy(*group).agg(*[F.sum(c).alias(c) for c in sums])
    scope = scope.withColumnsRenamed({c: f"_l{c}" for c in group})
    j = groups.join(scope, [groups[c].eqNullSafe(scope[f"_l{c}"]) for c in group], "left")
    names = F.element_at(F.create_map(*[F.lit(x) for kv in PLAYER_GRAINS.items() for x in kv]), F.col("_g").cast("int"))
    return _per_measures(j, mpg_floor).select(names.alias("grain"), "player_id", *pair, *PER_MEASURES)


# ---- simple measures ------------------------------------------------------------------
def team_games(team_fct: DataFrame, grain: list[str]) -> DataFrame:
    """ME1 tm_gp and ME2 mov = (tm_pts - opp_pts) / tm_gp per group of team rows."""
    t = team_totals(team_fct, grain)
    return t.select(*grain, "tm_gp",
                    divide(b_sub(_d("tm_pts"), _d("opp_pts")), F.col("tm_gp")).alias("mov"))


def true_shooting(player_fct: DataFrame, grain: list[str],
                  cutoff: int | None = STATS_COMPLETE_FROM_YEAR) -> DataFrame:
    """ME7 p_ts% = 100 * pts / (2 * (fga + 0.44 * fta)), within the cutoff."""
    groups = player_fct.select(*grain).distinct()
    p = player_totals(with_cutoff(player_fct, cutoff), grain)
    j = groups.join(p, grain, "left")
    ts = divide(_d("p_pts"), F.lit(2.0) * b_add(_d("p_fga"), F.lit(FTA_WEIGHT_TS) * _d("p_fta")))
    return j.select(*grain, (ts * F.lit(100.0)).alias("ts_pct"))


def team_possessions(team_fct: DataFrame, grain: list[str],
                     cutoff: int | None = STATS_COMPLETE_FROM_YEAR) -> DataFrame:
    """ME8 tm_poss and MX6 pace per group of team rows, within the cutoff."""
    groups = team_fct.select(*grain).distinct()
    t = team_totals(with_cutoff(team_fct, cutoff), grain)
    j = groups.join(t, grain, "left")
    poss = possessions("tm_", "opp_")
    return j.select(*grain, poss.alias("tm_poss"), pace(poss, _d("tm_min")).alias("pace"))


def four_factors(team_fct: DataFrame, grain: list[str],
                 cutoff: int | None = STATS_COMPLETE_FROM_YEAR) -> DataFrame:
    """MX1-MX4: eFG%, TOV%, OREB%, FT rate per group of team rows."""
    t = team_totals(with_cutoff(team_fct, cutoff), grain)
    return t.select(
        *grain,
        divide(b_add(_d("tm_fgm"), F.lit(0.5) * _d("tm_fg3m")), _d("tm_fga")).alias("efg_pct"),
        divide(_d("tm_tov"), b_add(_d("tm_fga"), F.lit(FTA_WEIGHT_TS) * _d("tm_fta"),
                                   _d("tm_tov"))).alias("tov_pct"),
        divide(_d("tm_oreb"), b_add(_d("tm_oreb"), _d("opp_dreb"))).alias("oreb_pct"),
        divide(_d("tm_ftm"), _d("tm_fga")).alias("ft_rate"),
    )


def ratings(team_fct: DataFrame, grain: list[str],
            cutoff: int | None = STATS_COMPLETE_FROM_YEAR) -> DataFrame:
    """MX7: offensive, defensive and net rating per 100 possessions."""
    t = team_totals(with_cutoff(team_fct, cutoff), grain)
    poss = possessions("tm_", "opp_")
    ortg = F.lit(100.0) * divide(_d("tm_pts"), poss)
    drtg = F.lit(100.0) * divide(_d("opp_pts"), poss)
    return t.select(*grain, ortg.alias("ortg"), drtg.alias("drtg"),
                    b_sub(ortg, drtg).alias("net_rtg"))


def usage_and_share(player_fct: DataFrame, team_fct: DataFrame, grain: list[str],
                    cutoff: int | None = STATS_COMPLETE_FROM_YEAR,
                    share_stats: tuple[str, ...] = ("pts", "reb", "ast", "stl", "blk")
                    ) -> DataFrame:
    """MX5 usage% and MX8 share-of-team (p_x / tm_x) over the group's team scope."""
    pf_c, tf_c = with_cutoff(player_fct, cutoff), with_cutoff(team_fct, cutoff)
    p = player_totals(pf_c, grain)
    t = team_scope(pf_c, tf_c, grain)
    j = p.join(t, grain)
    w = F.lit(FTA_WEIGHT_TS)
    p_load = b_add(_d("p_fga"), w * _d("p_fta"), _d("p_tov"))
    t_load = b_add(_d("tm_fga"), w * _d("tm_fta"), _d("tm_tov"))
    usage = F.lit(100.0) * divide(p_load * divide(_d("tm_min"), F.lit(5.0)),
                                  _d("p_min") * t_load)
    return j.select(*grain, usage.alias("usg_pct"),
                    *[divide(_d("p_" + s), _d("tm_" + s)).alias(f"{s}_share")
                      for s in share_stats])


# ---- player-page measures ------------------------------------------------------------
def current_team(player_fct: DataFrame, dim_seasons_df: DataFrame, dim_players_df: DataFrame,
                 dim_teams_df: DataFrame) -> DataFrame:
    """ME10: 'Retired' if the player's last season precedes the latest season there is,
    else the team name of the team-year he played for on his last game date.

    The latest season is that of the season dimension, whether or not it has facts yet (no
    back-propagation from the player); an ambiguous last date (two team-years) gives no team, like
    SELECTEDVALUE.
    """
    # a scalar subquery: Catalyst runs it once and inlines the value
    current_year = dim_seasons_df.agg(F.max("year")).scalar()
    keys = latest_value(player_fct, "player_id", "game_date", "team_year_key")
    names = (dim_teams_df.groupBy("team_year_key")
             .agg(F.when(F.count_distinct("team_name") == 1, F.min("team_name"))
                  .alias("latest_team")))
    latest = keys.join(names, "team_year_key", "left").select("player_id", "latest_team")
    j = dim_players_df.select("player_id", "to_year").join(latest, "player_id", "left")
    retired = F.coalesce(F.col("to_year"), F.lit(0)) < current_year
    return j.select("player_id", F.when(retired, F.lit("Retired"))
                    .otherwise(F.col("latest_team")).alias("current_team"))


def latest_value(df: DataFrame, entity: str, order_col: str, value_col: str) -> DataFrame:
    """Value at each entity's latest ``order_col``; NULL when that moment has several
    distinct values (SELECTEDVALUE).

    One scan: the latest moment of each (entity, value) is aggregated map-side, and the values of an
    entity that share the overall latest one are counted.  A null entity is none and has no row; a moment at
    which the value is only null has no value.
    """
    each = df.filter(F.col(entity).isNotNull()).groupBy(entity, value_col).agg(F.max(order_col).alias("_at"))
    moments = each.groupBy(entity, "_at").agg(F.count(value_col).alias("_values"), F.min(value_col).alias("_value"))
    last = moments.filter(F.col("_at").isNotNull()).groupBy(entity).agg(F.max(F.struct("_at", "_values", "_value")).alias("_last"))
    return last.select(entity, F.when(F.col("_last._values") == 1, F.col("_last._value")).alias(value_col))


def display_flags(dim_players_df: DataFrame,
                  cutoff: int = STATS_COMPLETE_FROM_YEAR) -> DataFrame:
    """ME11/ME12: overlay colour and disclaimer for careers ending before the cutoff.

    A missing last season compares as 0, so it counts as before the cutoff.
    """
    early = F.coalesce(F.col("to_year"), F.lit(0)) < cutoff
    return dim_players_df.select(
        "player_id",
        F.when(early, F.lit(HIDE_COLOR)).otherwise(F.lit(SHOW_COLOR)).alias("hide_advanced"),
        F.when(early, F.lit(DISCLAIMER)).otherwise(F.lit("")).alias("disclaimer"))


def display_text(dim_players_df: DataFrame) -> DataFrame:
    """ME13: 'h (cm cm) • w lbs (kg kg)', missing parts shown as empty text."""
    t = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return dim_players_df.select(
        "player_id",
        F.concat(t("height"), F.lit(" ("), t("height_cm"), F.lit(" cm) • "), t("weight"),
                 F.lit(" lbs ("), t("weight_kg"), F.lit(" kg)")).alias("height_weight"))


# ---- Win Shares (ME9 ws_48, MX9) ---------------------------------------------------
# The reference names Win Shares and WS/48 but does not define them; this is the
# published offensive / defensive method (points produced and individual defensive
# rating, Oliver; marginal points per win, Basketball-Reference).
# ---- fixed values: Win Shares constants -----------------------------------------------
WS_OFF_PPP_WEIGHT = 0.92      # replacement-level offense, share of league points/poss
WS_DEF_PPP_WEIGHT = 1.08      # replacement-level defense
WS_PTS_PER_WIN = 0.32         # marginal points per win, share of league points/game
WS_QAST_WEIGHT = 1.14


def _sq(c: Column) -> Column:
    return c * c


def win_shares_frame(player_fct: DataFrame, team_fct: DataFrame, grain: list[str],
                     cutoff: int | None = STATS_COMPLETE_FROM_YEAR) -> DataFrame:
    """Offensive, defensive and total Win Shares and WS/48 per group of ``grain``.

    Player sums are compared with the group's team scope (every game of every team
    key it touched) and the league scope, as PER does.  Divisions are DIVIDE.
    """
    pf_c, tf_c = with_cutoff(player_fct, cutoff), with_cutoff(team_fct, cutoff)
    p = player_totals(pf_c, grain)
    t = team_scope(pf_c, tf_c, grain)
    lg = league_scope(pf_c, tf_c, grain).select(
        *grain, "lg_tm_gp", "lg_tm_pts", "lg_tm_min", *[c for c in league_scope_cols()])
    j = p.join(t, grain).join(lg, grain, "left")
    d = _d
    one = F.lit(1.0)
    mp, tmp = d("p_min"), d("tm_min")
    share = divide(mp, divide(tmp, F.lit(5.0)))
    j = j.withColumns({
        "tm_poss": possessions("tm_", "opp_"),
        "lg_poss": possessions("lg_tm_", "lg_opp_"),
        "q_ast": share * (F.lit(WS_QAST_WEIGHT) * divide(d("tm_ast") - d("p_ast"), d("tm_fgm")))
                 + divide(divide(d("tm_ast"), tmp) * mp * 5.0 - d("p_ast"),
                          divide(d("tm_fgm"), tmp) * mp * 5.0 - d("p_fgm")) * (one - share),
        "tm_sc_poss": d("tm_fgm") + (one - _sq(one - divide(d("tm_ftm"), d("tm_fta"))))
                      * d("tm_fta") * 0.4,
        "tm_orb_pct": divide(d("tm_oreb"), d("tm_oreb") + (d("opp_reb") - d("opp_oreb"))),
        "shot_share": divide(d("p_pts") - d("p_ftm"), F.lit(2.0) * d("p_fga")),
    })
    j = j.withColumns({
        "tm_play_pct": divide(F.col("tm_sc_poss"), d("tm_fga") + d("tm_fta") * 0.4 + d("tm_tov")),
        "fg_part": d("p_fgm") * (one - F.lit(0.5) * F.col("shot_share") * F.col("q_ast")),
        "ast_part": F.lit(0.5) * divide((d("tm_pts") - d("tm_ftm")) - (d("p_pts") - d("p_ftm")),
                                        F.lit(2.0) * (d("tm_fga") - d("p_fga"))) * d("p_ast"),
        "ft_part": (one - _sq(one - divide(d("p_ftm"), d("p_fta")))) * 0.4 * d("p_fta"),
    })
    j = j.withColumn("tm_orb_weight", divide(
        (one - F.col("tm_orb_pct")) * F.col("tm_play_pct"),
        (one - F.col("tm_orb_pct")) * F.col("tm_play_pct")
        + F.col("tm_orb_pct") * (one - F.col("tm_play_pct"))))
    orb_factor = one - divide(d("tm_oreb"), F.col("tm_sc_poss")) * F.col("tm_orb_weight") \
        * F.col("tm_play_pct")
    j = j.withColumns({
        "orb_part": d("p_oreb") * F.col("tm_orb_weight") * F.col("tm_play_pct"),
        "orb_factor": orb_factor,
    })
    j = j.withColumns({
        "tot_poss": (F.col("fg_part") + F.col("ast_part") + F.col("ft_part")) * F.col("orb_factor")
                    + F.col("orb_part")
                    + (d("p_fga") - d("p_fgm")) * (one - F.lit(1.07) * F.col("tm_orb_pct"))
                    + _sq(one - divide(d("p_ftm"), d("p_fta"))) * 0.4 * d("p_fta")
                    + d("p_tov"),
        "pprod": (F.lit(2.0) * (d("p_fgm") + F.lit(0.5) * d("p_fg3m"))
                  * (one - F.lit(0.5) * F.col("shot_share") * F.col("q_ast"))
                  + F.lit(2.0) * divide(d("tm_fgm") - d("p_fgm") + F.lit(0.5) * (d("tm_fg3m") - d("p_fg3m")),
                                        d("tm_fgm") - d("p_fgm")) * F.col("ast_part")
                  + d("p_ftm")) * F.col("orb_factor")
                 + F.col("orb_part") * divide(d("tm_pts"), F.col("tm_sc_poss")),
        "lg_ppp": divide(d("lg_tm_pts"), F.col("lg_poss")),
        # defense
        "dor_pct": divide(d("opp_oreb"), d("opp_oreb") + d("tm_dreb")),
        "dfg_pct": divide(d("opp_fgm"), d("opp_fga")),
    })
    j = j.withColumns({
        "fm_wt": divide(F.col("dfg_pct") * (one - F.col("dor_pct")),
                        F.col("dfg_pct") * (one - F.col("dor_pct"))
                        + (one - F.col("dfg_pct")) * F.col("dor_pct")),
        "mppw": F.lit(WS_PTS_PER_WIN) * divide(d("lg_tm_pts"), d("lg_tm_gp"))
                * divide(pace(F.col("tm_poss"), tmp), pace(F.col("lg_poss"), d("lg_tm_min"))),
    })
    stops = (d("p_stl") + d("p_blk") * F.col("fm_wt") * (one - F.lit(1.07) * F.col("dor_pct"))
             + d("p_dreb") * (one - F.col("fm_wt"))
             + (divide(d("opp_fga") - d("opp_fgm") - d("tm_blk"), tmp) * F.col("fm_wt")
                * (one - F.lit(1.07) * F.col("dor_pct"))
                + divide(d("opp_tov") - d("tm_stl"), tmp)) * mp
             + divide(d("p_pf"), d("tm_pf")) * 0.4 * d("opp_fta")
             * _sq(one - divide(d("opp_ftm"), d("opp_fta"))))
    j = j.withColumns({
        "stop_pct": divide(stops * tmp, F.col("tm_poss") * mp),
        "tm_drtg": F.lit(100.0) * divide(d("opp_pts"), F.col("tm_poss")),
        "d_pts_per_scposs": divide(d("opp_pts"), d("opp_fgm") + (one - _sq(
            one - divide(d("opp_ftm"), d("opp_fta")))) * d("opp_fta") * 0.4),
    })
    j = j.withColumn("drtg", F.col("tm_drtg") + F.lit(0.2) * (
        F.lit(100.0) * F.col("d_pts_per_scposs") * (one - F.col("stop_pct")) - F.col("tm_drtg")))
    ows = divide(F.col("pprod") - F.lit(WS_OFF_PPP_WEIGHT) * F.col("lg_ppp") * F.col("tot_poss"),
                 F.col("mppw"))
    dws = divide(divide(mp, tmp) * F.col("tm_poss")
                 * (F.lit(WS_DEF_PPP_WEIGHT) * F.col("lg_ppp") - F.col("drtg") / 100.0),
                 F.col("mppw"))
    j = j.withColumns({"ows": ows, "dws": dws})
    j = j.withColumn("ws", F.col("ows") + F.col("dws"))
    return j.select(*grain, "ows", "dws", "ws",
                    (divide(F.col("ws"), mp) * 48.0).alias("ws_48"))


def league_scope_cols() -> list[str]:
    return [f"lg_tm_{c}" for c in STATS16 if c not in ("pts", "min")] + \
        [f"lg_opp_{c}" for c in OPP_STATS]
