"""Oracle SQL for the measure layer (hand-written against the DuckDB model CTEs)."""

from __future__ import annotations

from oracle.fixture import _STAT_LIST as STATS16, _OPPOSED as OPP_STATS
from oracle.fixture import FIXTURE_VOID
from oracle.queries import SQL, reg

CUT = 1998
MPG_FLOOR = 0.5


def badd(*terms: str) -> str:
    present = " OR ".join(f"({t}) IS NOT NULL" for t in terms)
    total = " + ".join(f"COALESCE({t}, 0.0)" for t in terms)
    return f"(CASE WHEN {present} THEN {total} END)"


def bsub(a: str, b: str) -> str:
    return badd(a, f"-({b})")


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0.0))"


def d(c: str) -> str:
    return f"CAST({c} AS DOUBLE)"


def poss(t: str, o: str) -> str:
    def side(a, b):
        return badd(d(a + "fga"), f"0.4::DOUBLE * {d(a + 'fta')}",
                    f"-(1.07::DOUBLE * {div(d(a + 'oreb'), badd(d(a + 'oreb'), d(b + 'dreb')))}"
                    f" * {bsub(d(a + 'fga'), d(a + 'fgm'))})",
                    d(a + "tov"))
    return f"(0.5::DOUBLE * {badd(side(t, o), side(o, t))})"


def pace(p: str, m: str) -> str:
    return f"(48.0::DOUBLE * {div(p, div(m, '5.0::DOUBLE'))})"


def tsum(prefix_out: str, src_prefix: str = "") -> str:
    cols = [f"SUM({src_prefix}{c}) AS {prefix_out}tm_{c}" for c in STATS16]
    cols += [f"SUM({src_prefix}opp_{c}) AS {prefix_out}opp_{c}" for c in OPP_STATS]
    return ", ".join(cols)


def psum(prefix_out: str) -> str:
    return ", ".join(f"SUM({c}) AS {prefix_out}{c}" for c in STATS16)


def uper(p: str, tm_ast: str, tm_fgm: str) -> str:
    r = div(tm_ast, tm_fgm)
    x = lambda c: d(p + c)
    two3 = "(2.0::DOUBLE / 3)"
    body = badd(
        x("fg3m"),
        f"{two3} * {x('ast')}",
        f"{bsub('2.0::DOUBLE', f'factor * {r}')} * {x('fgm')}",
        f"{x('ftm')} * 0.5::DOUBLE * {badd('1.0::DOUBLE', bsub('1.0::DOUBLE', r), f'{two3} * {r}')}",
        f"-(vop * {x('tov')})",
        f"-(vop * lg_dreb_pct * {bsub(x('fga'), x('fgm'))})",
        f"-(vop * 0.44::DOUBLE * {badd('0.44::DOUBLE', '0.56::DOUBLE * lg_dreb_pct')} * "
        f"{bsub(x('fta'), x('ftm'))})",
        f"vop * {bsub('1.0::DOUBLE', 'lg_dreb_pct')} * {bsub(x('reb'), x('oreb'))}",
        f"vop * lg_dreb_pct * {x('oreb')}",
        f"vop * {x('stl')}",
        f"vop * lg_dreb_pct * {x('blk')}",
        f"-({x('pf')} * {bsub('lg_ftm_pf', '0.44::DOUBLE * lg_fta_pf * vop')})",
    )
    return f"({div('1.0::DOUBLE', x('min'))} * {body})"


def per_sql(grain: list[str]) -> str:
    g = ", ".join(grain)
    gk = " AND ".join(f"a.{c} = b.{c}" for c in grain)
    on = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in grain)
    ycols = list(dict.fromkeys(grain + ["year"]))
    tcols = list(dict.fromkeys(grain + ["season_type_key"]))
    type_match = ("AND lt.season_type_key = y.season_type_key"
                  if "season_type_key" in grain else "")
    lcols = (["lg_tm_gp"] + [f"lg_tm_{c}" for c in STATS16] + [f"lg_opp_{c}" for c in OPP_STATS]
             + [f"lp_{c}" for c in STATS16])
    tcols_sum = ["tm_gp"] + [f"tm_{c}" for c in STATS16] + [f"opp_{c}" for c in OPP_STATS]
    return f"""
, pf_c AS (SELECT * FROM player_boxscores WHERE year >= {CUT})
, tf_c AS (SELECT * FROM team_boxscores WHERE year >= {CUT})
, grp AS (SELECT DISTINCT {g} FROM player_boxscores)
, p AS (SELECT {g}, {psum('p_')} FROM pf_c GROUP BY {g})
, keyt AS (SELECT year_type_team_key, COUNT(*) AS tm_gp, {tsum('')} FROM tf_c GROUP BY 1)
, t AS (SELECT {", ".join('k.' + c for c in grain)}, {", ".join(f'SUM({c}) AS {c}' for c in tcols_sum)}
        FROM (SELECT DISTINCT {g}, year_type_team_key FROM pf_c) k
        JOIN keyt ON k.year_type_team_key = keyt.year_type_team_key GROUP BY {", ".join('k.' + c for c in grain)})
, lgt AS (SELECT year, season_type_key, COUNT(*) AS lg_tm_gp, {tsum('lg_')} FROM tf_c GROUP BY 1, 2)
, lpt AS (SELECT year, season_type_key, {psum('lp_')} FROM pf_c GROUP BY 1, 2)
, lpair AS (SELECT lgt.*, {", ".join('lpt.lp_' + c for c in STATS16)} FROM lgt
            LEFT JOIN lpt ON lgt.year = lpt.year AND lgt.season_type_key = lpt.season_type_key)
, lg AS (SELECT {", ".join('y.' + c for c in grain)}, {", ".join(f'SUM(lt.{c}) AS {c}' for c in lcols)}
         FROM (SELECT DISTINCT {", ".join(ycols)} FROM pf_c) y
         JOIN lpair lt ON lt.year = y.year {type_match}
         WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT {", ".join(tcols)} FROM pf_c) ty
                       WHERE {" AND ".join(f"ty.{c} = y.{c}" for c in grain if c != "season_type_key")}
                       {"AND" if [c for c in grain if c != "season_type_key"] else ""}
                       ty.season_type_key = lt.season_type_key)
         GROUP BY {", ".join('y.' + c for c in grain)})
, keyall AS (SELECT year_type_team_key, COUNT(*) AS gp FROM team_boxscores GROUP BY 1)
, gpall AS (SELECT {", ".join('k.' + c for c in grain)}, SUM(gp) AS floor_gp
            FROM (SELECT DISTINCT {g}, year_type_team_key FROM player_boxscores) k
            JOIN keyall ON k.year_type_team_key = keyall.year_type_team_key
            GROUP BY {", ".join('k.' + c for c in grain)})
, j AS (SELECT grp.*, {", ".join('p.p_' + c for c in STATS16)}, {", ".join('t.' + c for c in tcols_sum)},
               {", ".join('lg.' + c for c in lcols)}, gpall.floor_gp
        FROM grp LEFT JOIN p ON {on('grp', 'p')} LEFT JOIN t ON {on('grp', 't')}
        LEFT JOIN lg ON {on('grp', 'lg')} LEFT JOIN gpall ON {on('grp', 'gpall')})
, c1 AS (SELECT *,
    {bsub('(2.0::DOUBLE / 3)', div(f"0.5::DOUBLE * {div(d('lg_tm_ast'), d('lg_tm_fgm'))}",
                                   f"2.0::DOUBLE * {div(d('lg_tm_fgm'), d('lg_tm_ftm'))}"))} AS factor,
    {div(d('lg_tm_pts'), badd(d('lg_tm_fga'), f"-{d('lg_tm_oreb')}", d('lg_tm_tov'),
                               f"0.44::DOUBLE * {d('lg_tm_fta')}"))} AS vop,
    {div(bsub(d('lg_tm_reb'), d('lg_tm_oreb')), d('lg_tm_reb'))} AS lg_dreb_pct,
    {div(d('lg_tm_ftm'), d('lg_tm_pf'))} AS lg_ftm_pf,
    {div(d('lg_tm_fta'), d('lg_tm_pf'))} AS lg_fta_pf,
    {poss('lg_tm_', 'lg_opp_')} AS lg_poss
  FROM j)
, c2 AS (SELECT *,
    {pace(poss('tm_', 'opp_'), d('tm_min'))} AS pace,
    {pace('lg_poss', d('lg_tm_min'))} AS lg_pace,
    {uper('p_', d('tm_ast'), d('tm_fgm'))} AS u_per,
    {uper('lp_', d('lg_tm_ast'), d('lg_tm_fgm'))} AS lg_u_per
  FROM c1)
, c3 AS (SELECT *, u_per * {div('lg_pace', 'pace')} AS a_per,
    {div(f"lg_u_per * {div('lg_pace', 'lg_pace')} * {d('lp_min')}", d('lp_min'))} AS lga_per
  FROM c2)
, perf AS (SELECT {g}, u_per, a_per, lga_per,
    CASE WHEN {d('p_min')} >= {MPG_FLOOR}::DOUBLE * COALESCE({d('floor_gp')}, 0.0)
         THEN a_per * {div('15.0::DOUBLE', 'lga_per')} END AS per
  FROM c3)
"""


_PS = ["player_id", "year", "season_type_key"]
_TS = ["team_id", "year", "season_type_key"]
_PSJ = ", ".join(_PS)
_TSJ = ", ".join(_TS)


def reg_per(name: str, grain: list[str], cols: str) -> None:
    reg(name, "__EXTRA__" + per_sql(grain) + "__SELECT__" + f"SELECT {cols} FROM perf")


for _m in ["u_per", "a_per", "lga_per", "per"]:
    reg_per(_m, _PS, f"{_PSJ}, ROUND({_m}, 6) AS {_m}")
reg_per("per_season", ["player_id", "year"],
        "player_id, year, ROUND(u_per, 6) AS u_per, ROUND(a_per, 6) AS a_per, "
        "ROUND(lga_per, 6) AS lga_per, ROUND(per, 6) AS per")
reg_per("per_career", ["player_id"],
        "player_id, ROUND(u_per, 6) AS u_per, ROUND(a_per, 6) AS a_per, "
        "ROUND(lga_per, 6) AS lga_per, ROUND(per, 6) AS per")

# all three grains at once: the rows of the three queries above, each under its grain's name
_GRAINS = {"season type": (_PS, "year, season_type_key"), "season": (_PS[:2], "year, NULL::INT AS season_type_key"),
           "career": (_PS[:1], "NULL::INT AS year, NULL::INT AS season_type_key")}
reg("per_grains", " UNION ALL ".join(
    f"SELECT * FROM (WITH {per_sql(g).strip()[1:]} SELECT '{name}' AS grain, player_id, {keys}, "
    + ", ".join(f"ROUND({c}, 6) AS {c}" for c in ["u_per", "a_per", "lga_per", "per"]) + " FROM perf)"
    for name, (g, keys) in _GRAINS.items()))

_TT = f"SELECT {_TSJ}, COUNT(*) AS tm_gp, {tsum('')} FROM team_boxscores"
reg("tm_gp", f"SELECT {_TSJ}, COUNT(*) AS tm_gp FROM team_boxscores GROUP BY {_TSJ}")
reg("mov", f"SELECT {_TSJ}, ROUND({div(bsub(d('tm_pts'), d('opp_pts')), 'tm_gp')}, 6) AS mov "
           f"FROM ({_TT} GROUP BY {_TSJ})")
reg("ts_pct", f"SELECT g.player_id, g.year, g.season_type_key, ROUND("
              f"{div(d('p_pts'), '2.0::DOUBLE * ' + badd(d('p_fga'), '0.44::DOUBLE * ' + d('p_fta')))}"
              f" * 100.0::DOUBLE, 6) AS ts_pct FROM (SELECT DISTINCT {_PSJ} FROM player_boxscores) g "
              f"LEFT JOIN (SELECT {_PSJ}, {psum('p_')} FROM player_boxscores WHERE year >= {CUT} "
              f"GROUP BY {_PSJ}) p ON g.player_id = p.player_id AND g.year = p.year "
              f"AND g.season_type_key = p.season_type_key")
_TTC = (f"SELECT g.team_id, g.year, g.season_type_key, t.* EXCLUDE (team_id, year, season_type_key) "
        f"FROM (SELECT DISTINCT {_TSJ} FROM team_boxscores) g LEFT JOIN "
        f"({_TT} WHERE year >= {CUT} GROUP BY {_TSJ}) t ON g.team_id = t.team_id "
        f"AND g.year = t.year AND g.season_type_key = t.season_type_key")
reg("tm_poss", f"SELECT {_TSJ}, ROUND({poss('tm_', 'opp_')}, 6) AS tm_poss FROM ({_TTC})")
reg("pace", f"SELECT {_TSJ}, ROUND({pace(poss('tm_', 'opp_'), d('tm_min'))}, 6) AS pace FROM ({_TTC})")
SQL["pace"] = SQL["pace"].replace(FIXTURE_VOID, "")  # pace is of every game but the curated void one
_TTW = f"{_TT} WHERE year >= {CUT} GROUP BY {_TSJ}"
reg("four_factors",
    f"SELECT {_TSJ}, "
    f"ROUND({div(badd(d('tm_fgm'), '0.5::DOUBLE * ' + d('tm_fg3m')), d('tm_fga'))}, 6) AS efg_pct, "
    f"ROUND({div(d('tm_tov'), badd(d('tm_fga'), '0.44::DOUBLE * ' + d('tm_fta'), d('tm_tov')))}, 6) AS tov_pct, "
    f"ROUND({div(d('tm_oreb'), badd(d('tm_oreb'), d('opp_dreb')))}, 6) AS oreb_pct, "
    f"ROUND({div(d('tm_ftm'), d('tm_fga'))}, 6) AS ft_rate FROM ({_TTW})")
_ORTG = f"(100.0::DOUBLE * {div(d('tm_pts'), poss('tm_', 'opp_'))})"
_DRTG = f"(100.0::DOUBLE * {div(d('opp_pts'), poss('tm_', 'opp_'))})"
reg("ratings", f"SELECT {_TSJ}, ROUND({_ORTG}, 6) AS ortg, ROUND({_DRTG}, 6) AS drtg, "
               f"ROUND({bsub(_ORTG, _DRTG)}, 6) AS net_rtg FROM ({_TTW})")
_TSC = ["tm_gp"] + [f"tm_{c}" for c in STATS16] + [f"opp_{c}" for c in OPP_STATS]
_PT = (f"SELECT p.*, {', '.join('t.' + c for c in _TSC)} FROM "
       f"(SELECT {_PSJ}, {psum('p_')} FROM player_boxscores WHERE year >= {CUT} GROUP BY {_PSJ}) p "
       f"JOIN (SELECT k.player_id, k.year, k.season_type_key, "
       f"{', '.join(f'SUM({c}) AS {c}' for c in _TSC)} FROM "
       f"(SELECT DISTINCT {_PSJ}, year_type_team_key FROM player_boxscores WHERE year >= {CUT}) k "
       f"JOIN (SELECT year_type_team_key, COUNT(*) AS tm_gp, {tsum('')} FROM team_boxscores "
       f"WHERE year >= {CUT} GROUP BY 1) kt ON k.year_type_team_key = kt.year_type_team_key "
       f"GROUP BY 1, 2, 3) t ON p.player_id = t.player_id AND p.year = t.year "
       f"AND p.season_type_key = t.season_type_key")
_PLOAD = badd(d('p_fga'), '0.44::DOUBLE * ' + d('p_fta'), d('p_tov'))
_TLOAD = badd(d('tm_fga'), '0.44::DOUBLE * ' + d('tm_fta'), d('tm_tov'))
reg("usage", f"SELECT {_PSJ}, ROUND(100.0::DOUBLE * "
             f"{div(_PLOAD + ' * ' + div(d('tm_min'), '5.0::DOUBLE'), d('p_min') + ' * ' + _TLOAD)}"
             f", 6) AS usg_pct FROM ({_PT})")
reg("team_share", f"SELECT {_PSJ}, " + ", ".join(
    f"ROUND({div(d('p_' + s), d('tm_' + s))}, 6) AS {s}_share"
    for s in ["pts", "reb", "ast", "stl", "blk"]) + f" FROM ({_PT})")
reg("current_team",
    "SELECT dp.player_id, CASE WHEN COALESCE(dp.to_year, 0) < (SELECT MAX(year) FROM dim_seasons) "
    "THEN 'Retired' ELSE lt.latest_team END AS current_team FROM dim_players dp LEFT JOIN ("
    " SELECT k.player_id, n.latest_team FROM ("
    "  SELECT pb.player_id, CASE WHEN COUNT(DISTINCT pb.team_year_key) = 1 "
    "         THEN MIN(pb.team_year_key) END AS team_year_key"
    "  FROM player_boxscores pb JOIN (SELECT player_id, MAX(game_date) AS last_date "
    "       FROM player_boxscores GROUP BY 1) ld ON pb.player_id = ld.player_id "
    "       AND pb.game_date = ld.last_date GROUP BY pb.player_id) k"
    " LEFT JOIN (SELECT team_year_key, CASE WHEN COUNT(DISTINCT team_name) = 1 "
    "            THEN MIN(team_name) END AS latest_team FROM dim_teams GROUP BY 1) n"
    " ON k.team_year_key = n.team_year_key) lt ON dp.player_id = lt.player_id")
reg("display_flags",
    f"SELECT player_id, CASE WHEN COALESCE(to_year, 0) < {CUT} THEN '#DFE3EC' ELSE '#00000000' END "
    f"AS hide_advanced, CASE WHEN COALESCE(to_year, 0) < {CUT} THEN 'Advanced metrics and complete "
    f"columns are available for seasons from 1983–84 onward, when the NBA''s box-score data became "
    f"complete.' ELSE '' END AS disclaimer FROM dim_players")
reg("display_text",
    "SELECT player_id, COALESCE(CAST(height AS VARCHAR), '') || ' (' || "
    "COALESCE(CAST(height_cm AS VARCHAR), '') || ' cm) • ' || COALESCE(CAST(weight AS VARCHAR), '') "
    "|| ' lbs (' || COALESCE(CAST(weight_kg AS VARCHAR), '') || ' kg)' AS height_weight FROM dim_players")


# ---- Win Shares ---------------------------------------------------------------------
def sq(x: str) -> str:
    return f"(({x}) * ({x}))"


def _ws_sql() -> str:
    D = d
    mp, tmp = D("p_min"), D("tm_min")
    share = div(mp, div(tmp, "5.0::DOUBLE"))
    one = "1.0::DOUBLE"
    return f"""
, wsp AS ({_PT})
, wsl AS (SELECT year, season_type_key, COUNT(*) AS lg_tm_gp, {tsum('lg_')}
          FROM team_boxscores WHERE year >= {CUT} GROUP BY 1, 2)
, w0 AS (SELECT wsp.*, {", ".join(f"wsl.{c}" for c in ["lg_tm_gp"] + [f"lg_tm_{c}" for c in STATS16] + [f"lg_opp_{c}" for c in OPP_STATS])}
         FROM wsp LEFT JOIN wsl ON wsp.year = wsl.year AND wsp.season_type_key = wsl.season_type_key)
, w1 AS (SELECT *,
    {poss('tm_', 'opp_')} AS tm_poss2,
    {poss('lg_tm_', 'lg_opp_')} AS lg_poss,
    {share} * (1.14::DOUBLE * {div(f"{D('tm_ast')} - {D('p_ast')}", D('tm_fgm'))})
      + {div(f"{div(D('tm_ast'), tmp)} * {mp} * 5.0::DOUBLE - {D('p_ast')}",
             f"{div(D('tm_fgm'), tmp)} * {mp} * 5.0::DOUBLE - {D('p_fgm')}")} * ({one} - {share}) AS q_ast,
    {D('tm_fgm')} + ({one} - {sq(f"{one} - {div(D('tm_ftm'), D('tm_fta'))}")}) * {D('tm_fta')} * 0.4::DOUBLE AS tm_sc_poss,
    {div(D('tm_oreb'), f"{D('tm_oreb')} + ({D('opp_reb')} - {D('opp_oreb')})")} AS tm_orb_pct,
    {div(f"{D('p_pts')} - {D('p_ftm')}", f"2.0::DOUBLE * {D('p_fga')}")} AS shot_share
  FROM w0)
, w2 AS (SELECT *,
    {div('tm_sc_poss', f"{D('tm_fga')} + {D('tm_fta')} * 0.4::DOUBLE + {D('tm_tov')}")} AS tm_play_pct,
    {D('p_fgm')} * ({one} - 0.5::DOUBLE * shot_share * q_ast) AS fg_part,
    0.5::DOUBLE * {div(f"({D('tm_pts')} - {D('tm_ftm')}) - ({D('p_pts')} - {D('p_ftm')})",
                       f"2.0::DOUBLE * ({D('tm_fga')} - {D('p_fga')})")} * {D('p_ast')} AS ast_part,
    ({one} - {sq(f"{one} - {div(D('p_ftm'), D('p_fta'))}")}) * 0.4::DOUBLE * {D('p_fta')} AS ft_part
  FROM w1)
, w3 AS (SELECT *,
    {div(f"({one} - tm_orb_pct) * tm_play_pct",
         f"({one} - tm_orb_pct) * tm_play_pct + tm_orb_pct * ({one} - tm_play_pct)")} AS tm_orb_weight
  FROM w2)
, w4 AS (SELECT *,
    {D('p_oreb')} * tm_orb_weight * tm_play_pct AS orb_part,
    {one} - {div(D('tm_oreb'), 'tm_sc_poss')} * tm_orb_weight * tm_play_pct AS orb_factor
  FROM w3)
, w5 AS (SELECT *,
    (fg_part + ast_part + ft_part) * orb_factor + orb_part
      + ({D('p_fga')} - {D('p_fgm')}) * ({one} - 1.07::DOUBLE * tm_orb_pct)
      + {sq(f"{one} - {div(D('p_ftm'), D('p_fta'))}")} * 0.4::DOUBLE * {D('p_fta')}
      + {D('p_tov')} AS tot_poss,
    (2.0::DOUBLE * ({D('p_fgm')} + 0.5::DOUBLE * {D('p_fg3m')})
       * ({one} - 0.5::DOUBLE * shot_share * q_ast)
     + 2.0::DOUBLE * {div(f"{D('tm_fgm')} - {D('p_fgm')} + 0.5::DOUBLE * ({D('tm_fg3m')} - {D('p_fg3m')})",
                          f"{D('tm_fgm')} - {D('p_fgm')}")} * ast_part
     + {D('p_ftm')}) * orb_factor + orb_part * {div(D('tm_pts'), 'tm_sc_poss')} AS pprod,
    {div(D('lg_tm_pts'), 'lg_poss')} AS lg_ppp,
    {div(D('opp_oreb'), f"{D('opp_oreb')} + {D('tm_dreb')}")} AS dor_pct,
    {div(D('opp_fgm'), D('opp_fga'))} AS dfg_pct
  FROM w4)
, w6 AS (SELECT *,
    {div(f"dfg_pct * ({one} - dor_pct)", f"dfg_pct * ({one} - dor_pct) + ({one} - dfg_pct) * dor_pct")} AS fm_wt,
    0.32::DOUBLE * {div(D('lg_tm_pts'), D('lg_tm_gp'))}
      * {div(pace('tm_poss2', tmp), pace('lg_poss', D('lg_tm_min')))} AS mppw
  FROM w5)
, w7 AS (SELECT *,
    {div(f"""({D('p_stl')} + {D('p_blk')} * fm_wt * ({one} - 1.07::DOUBLE * dor_pct)
             + {D('p_dreb')} * ({one} - fm_wt)
             + ({div(f"{D('opp_fga')} - {D('opp_fgm')} - {D('tm_blk')}", tmp)} * fm_wt
                * ({one} - 1.07::DOUBLE * dor_pct)
                + {div(f"{D('opp_tov')} - {D('tm_stl')}", tmp)}) * {mp}
             + {div(D('p_pf'), D('tm_pf'))} * 0.4::DOUBLE * {D('opp_fta')}
             * {sq(f"{one} - {div(D('opp_ftm'), D('opp_fta'))}")}) * {tmp}""",
         f"tm_poss2 * {mp}")} AS stop_pct,
    100.0::DOUBLE * {div(D('opp_pts'), 'tm_poss2')} AS tm_drtg,
    {div(D('opp_pts'), f"{D('opp_fgm')} + ({one} - {sq(f'{one} - ' + div(D('opp_ftm'), D('opp_fta')))}) * {D('opp_fta')} * 0.4::DOUBLE")} AS d_pts_per_scposs
  FROM w6)
, w8 AS (SELECT *,
    tm_drtg + 0.2::DOUBLE * (100.0::DOUBLE * d_pts_per_scposs * ({one} - stop_pct) - tm_drtg) AS drtg
  FROM w7)
, w9 AS (SELECT *,
    {div(f"pprod - 0.92::DOUBLE * lg_ppp * tot_poss", 'mppw')} AS ows,
    {div(f"{div(mp, tmp)} * tm_poss2 * (1.08::DOUBLE * lg_ppp - drtg / 100.0::DOUBLE)", 'mppw')} AS dws
  FROM w8)
"""


reg("ws_48", "__EXTRA__" + _ws_sql() + "__SELECT__"
    f"SELECT {_PSJ}, ROUND(ows, 6) AS ows, ROUND(dws, 6) AS dws, ROUND(ows + dws, 6) AS ws, "
    f"ROUND({div('ows + dws', d('p_min'))} * 48.0::DOUBLE, 6) AS ws_48 FROM w9")
