"""The testdata -> raw box-score mapping and the model chain, as DuckDB SQL CTEs."""

from __future__ import annotations

# fixed values: letters that Unicode does not decompose, with their ASCII spelling
PLAIN_LETTERS = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Þ": "TH", "þ": "th", "ß": "ss", "Ĳ": "IJ", "ĳ": "ij",
    "Ð": "D", "ð": "d", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "Ŀ": "L", "ŀ": "l", "Ł": "L", "ł": "l",
    "Ø": "O", "ø": "o", "Ŧ": "T", "ŧ": "t", "Ŋ": "N", "ŋ": "n", "ƒ": "f",
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fold_sql(expr: str) -> str:
    """DuckDB strips what decomposes; the rest is spelled out."""
    out = f"strip_accents({expr})"
    for letter, plain in PLAIN_LETTERS.items():
        out = f"replace({out}, {_q(letter)}, {_q(plain)})"
    return out


def _txt(e: str) -> str:
    return f"COALESCE(CAST({e} AS VARCHAR), '')"


_STAT_LIST = ["min", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb",
              "ast", "stl", "blk", "tov", "pf", "pts"]

#: The void games that the fixture adds to the curated one.
FIXTURE_VOID = " UNION SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') FROM orders WHERE o_orderkey % 211 = 0"

RAW_CTES = f"""
pl_lines AS (
  SELECT l.l_suppkey AS s, l.l_orderkey AS o, l.l_linenumber % 2 AS side,
         CAST(SUM(l.l_quantity) AS BIGINT) AS q, MAX(od.o_orderdate) AS odate
  FROM lineitem l JOIN orders od ON l.l_orderkey = od.o_orderkey
  GROUP BY 1, 2, 3),
pl_base AS (
  SELECT s, o, side, q, year(odate) AS y, month(odate) AS m, CAST(odate AS DATE) AS game_date,
         o % 25 AS home, (o + 1 + o % 12) % 25 AS away,
         CASE WHEN side = 0 THEN o % 25 ELSE (o + 1 + o % 12) % 25 END AS team,
         (year(odate) < 1998 AND o % 67 = 0) AS gap
  FROM pl_lines),
pg AS (
  SELECT s, o, side, q, y, m, game_date, home, away, team,
    CASE WHEN NOT (s % 7 = 0 AND o % 11 = 0) THEN q % 37 END AS min,
    q % 12 AS fgm, q % 12 + q % 9 AS fga,
    least(q % 12, q % 4) AS fg3m, least(q % 12, q % 4) + q % 3 AS fg3a,
    q % 6 AS ftm, q % 6 + q % 3 AS fta,
    CASE WHEN NOT gap THEN q % 5 END AS oreb,
    CASE WHEN NOT gap THEN (q + o) % 9 END AS dreb,
    q % 5 + (q + o) % 9 AS reb,
    (q + s) % 13 AS ast,
    CASE WHEN y <> 1995 AND NOT gap THEN (q + o) % 4 END AS stl,
    CASE WHEN y <> 1995 AND NOT gap THEN (o + s) % 3 END AS blk,
    CASE WHEN NOT gap THEN q % 5 END AS tov,
    q % 6 AS pf,
    2 * (q % 12) + least(q % 12, q % 4) + q % 6 AS pts,
    q % 21 - 10 AS plus_minus
  FROM pl_base),
tg_sum AS (
  SELECT o, side, MIN(y) AS y, MIN(m) AS m, MIN(game_date) AS game_date, MIN(team) AS team,
         MIN(home) AS home, MIN(away) AS away,
         {", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in _STAT_LIST + ["plus_minus"])}
  FROM pg GROUP BY o, side),
tg AS (
  SELECT o, side, y, m, game_date, team, home, away,
    {", ".join(f"CASE WHEN NOT (y IN (1996, 1997) AND o % 10 <> 0) THEN {c} END AS {c}"
               if c in ("oreb", "dreb", "stl", "blk", "tov") else c
               for c in _STAT_LIST + ["plus_minus"])}
  FROM tg_sum),
pg_t AS (
  SELECT g.*, n.n_name,
    CAST(y AS VARCHAR) || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS _season,
    CASE WHEN m IN (5, 6) THEN 'Playoffs' ELSE 'Regular Season' END AS _stype,
    n.n_name || CASE WHEN y < 1998 THEN ' A' ELSE ' B' END AS _team_name,
    CASE WHEN side = 0 THEN 'T' || CAST(home AS VARCHAR) || ' vs. T' || CAST(away AS VARCHAR)
         ELSE 'T' || CAST(away AS VARCHAR) || ' @ T' || CAST(home AS VARCHAR) END AS _matchup,
    CASE WHEN (side = 0) = (o % 2 = 0) THEN 'W' ELSE 'L' END AS _wl,
    lpad(CAST(o AS VARCHAR), 10, '0') AS _game_id
  FROM pg g JOIN nation n ON g.team = n.n_nationkey),
tg_t AS (
  SELECT g.*, n.n_name,
    CAST(y AS VARCHAR) || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS _season,
    CASE WHEN m IN (5, 6) THEN 'Playoffs' ELSE 'Regular Season' END AS _stype,
    n.n_name || CASE WHEN y < 1998 THEN ' A' ELSE ' B' END AS _team_name,
    CASE WHEN side = 0 THEN 'T' || CAST(home AS VARCHAR) || ' vs. T' || CAST(away AS VARCHAR)
         ELSE 'T' || CAST(away AS VARCHAR) || ' @ T' || CAST(home AS VARCHAR) END AS _matchup,
    CASE WHEN (side = 0) = (o % 2 = 0) THEN 'W' ELSE 'L' END AS _wl,
    lpad(CAST(o AS VARCHAR), 10, '0') AS _game_id
  FROM tg g JOIN nation n ON g.team = n.n_nationkey),
raw_player AS (
  SELECT
    CASE WHEN _stype = 'Playoffs' THEN '4' ELSE '2' END || CAST(y AS VARCHAR) AS "SEASON_ID",
    CAST(s AS VARCHAR) AS "PLAYER_ID",
    'Player ' || CAST(s % 40 AS VARCHAR) AS "PLAYER_NAME",
    CAST(team AS VARCHAR) AS "TEAM_ID",
    'T' || CAST(team AS VARCHAR) AS "TEAM_ABBREVIATION",
    _team_name AS "TEAM_NAME", _game_id AS "GAME_ID",
    CAST(game_date AS VARCHAR) AS "GAME_DATE", _matchup AS "MATCHUP", _wl AS "WL",
    CASE WHEN min IS NULL AND s % 2 = 0 THEN '  ' ELSE {_txt("min")} END AS "MIN",
    {", ".join(f'{_txt(c)} AS "{c.upper()}"' for c in
               ["fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast",
                "stl", "blk", "tov", "pf"])},
    CASE WHEN o % 5 = 0 THEN ' ' || {_txt("pts")} || ' ' ELSE {_txt("pts")} END AS "PTS",
    {_txt("plus_minus")} AS "PLUS_MINUS",
    _season AS "Season", _stype AS "SeasonType"
  FROM pg_t),
raw_team AS (
  SELECT
    CAST(team AS VARCHAR) AS "TEAM_ID",
    'T' || CAST(team AS VARCHAR) AS "TEAM_ABBREVIATION",
    _team_name AS "TEAM_NAME", _game_id AS "GAME_ID",
    CAST(game_date AS VARCHAR) AS "GAME_DATE", _matchup AS "MATCHUP", _wl AS "WL",
    {", ".join(f'{_txt(c)} AS "{c.upper()}"' for c in _STAT_LIST)},
    _season AS "Season", _stype AS "SeasonType"
  FROM tg_t),
raw_bios AS (
  SELECT
    CAST(s_suppkey AS VARCHAR) AS "PLAYER_ID",
    CASE WHEN s_suppkey % 5 = 0 THEN 'Đorđe Łæßčé' ELSE 'Player' END AS "FIRST_NAME",
    CAST(s_suppkey % 40 AS VARCHAR) AS "LAST_NAME",
    CASE WHEN s_suppkey % 5 = 0 THEN 'Đorđe Łæßčé' ELSE 'Player' END || ' '
      || CAST(s_suppkey % 40 AS VARCHAR) AS "DISPLAY_FIRST_LAST",
    'player-' || CAST(s_suppkey AS VARCHAR) AS "PLAYER_SLUG",
    CASE WHEN s_suppkey % 13 = 5 THEN '1972-02-29'
         ELSE CAST(DATE '1960-01-01' + CAST((s_suppkey * 37) % 7000 AS INTEGER) AS VARCHAR)
    END AS "BIRTHDATE",
    CASE WHEN s_suppkey % 9 = 0 THEN '' ELSE 'School ' || CAST(s_suppkey % 17 AS VARCHAR) END
      AS "SCHOOL",
    CASE WHEN s_suppkey % 4 = 0 THEN ' ' || ctry || ' ' ELSE ctry END AS "COUNTRY",
    'Affiliation ' || CAST(s_suppkey % 7 AS VARCHAR) AS "LAST_AFFILIATION",
    CAST(5 + s_suppkey % 3 AS VARCHAR) || '-' || CAST(s_suppkey % 11 AS VARCHAR) AS "HEIGHT",
    CASE WHEN s_suppkey % 19 = 0 THEN '' ELSE CAST(160 + (s_suppkey * 7) % 90 AS VARCHAR) END
      AS "WEIGHT",
    CAST(s_suppkey % 15 AS VARCHAR) AS "SEASON_EXP",
    CASE WHEN s_suppkey % 4 = 0
         THEN CAST(s_suppkey % 30 AS VARCHAR) || '-' || CAST(s_suppkey % 30 + 1 AS VARCHAR)
         ELSE CAST(s_suppkey % 50 AS VARCHAR) END AS "JERSEY",
    CASE s_suppkey % 3 WHEN 0 THEN 'Guard' WHEN 1 THEN 'Forward' ELSE 'Center' END
      AS "POSITION",
    CAST(1995 + s_suppkey % 4 AS VARCHAR) AS "FROM_YEAR",
    CAST(1997 + s_suppkey % 5 AS VARCHAR) AS "TO_YEAR",
    CASE WHEN s_suppkey % 8 = 0 THEN 'Undrafted' ELSE CAST(1994 + s_suppkey % 4 AS VARCHAR) END
      AS "DRAFT_YEAR",
    CASE WHEN s_suppkey % 8 = 0 THEN 'Undrafted' ELSE CAST(1 + s_suppkey % 2 AS VARCHAR) END
      AS "DRAFT_ROUND",
    CASE WHEN s_suppkey % 8 = 0 THEN 'Undrafted' ELSE CAST(1 + s_suppkey % 30 AS VARCHAR) END
      AS "DRAFT_NUMBER",
    CASE WHEN s_suppkey % 23 = 0 THEN 'Y' ELSE 'N' END AS "GREATEST_75_FLAG"
  FROM (SELECT s_suppkey,
               CASE s_suppkey % 6 WHEN 0 THEN 'USA' WHEN 1 THEN 'México' WHEN 2 THEN 'DRC'
                    WHEN 3 THEN 'Macedonia' WHEN 4 THEN 'France' ELSE 'Atlantis' END AS ctry
        FROM supplier) sup
  WHERE s_suppkey % 10 <> 9),
team_logos AS (
  SELECT n.n_name || CASE WHEN ts.y < 1998 THEN ' A' ELSE ' B' END AS team,
         CAST(ts.y AS INTEGER) AS year,
         'logos/' || CAST(ts.team AS VARCHAR) || '_' || CAST(ts.y AS VARCHAR) || '.svg' AS logo
  FROM (SELECT DISTINCT team, y FROM pg) ts JOIN nation n ON ts.team = n.n_nationkey
  WHERE NOT (ts.team = 24 AND ts.y = 2001))"""


# Staging: every text column is trimmed and blanked at once, then each output is one cast of one column.
_CAST = {"text": "{c}", "folded": None, "big": "CAST({c} AS BIGINT)", "int": "CAST({c} AS INT)", "date": "CAST({c} AS DATE)",
         "whole": "CAST({c} AS DECIMAL(10,0))", "list": "replace({c}, '-', ', ')",
         # fixed values: country spellings
         "country": "ifnull(MAP {{'México': 'Mexico', 'DRC': 'Democratic Republic of the Congo', "
                    "'Macedonia': 'North Macedonia'}}[{c}], {c})"}
_KINDS = {
    "v_bios": ("raw_bios", {
        "big": ["player_id"], "folded": ["first_name", "last_name", "display_first_last"], "date": ["birthdate"],
        "country": ["country"], "int": ["weight", "season_exp", "from_year", "to_year"], "list": ["jersey"],
        "text": ["player_slug", "school", "last_affiliation", "height", "position", "draft_year", "draft_round",
                 "draft_number", "greatest_75_flag"]}),
    "v_player": ("raw_player", {
        "big": ["player_id", "team_id"], "date": ["game_date"], "text": ["game_id", "matchup", "wl", "season"],
        "whole": [*_STAT_LIST, "plus_minus"]}),
    "v_team": ("raw_team", {
        "big": ["team_id"], "date": ["game_date"], "whole": _STAT_LIST,
        "text": ["team_abbreviation", "team_name", "game_id", "matchup", "wl", "season"]}),
}


def _staged(view: str) -> str:
    raw, kinds = _KINDS[view]
    outputs = [(fold_sql(f'"{c.upper()}"') if kind == "folded" else _CAST[kind].format(c=f'"{c.upper()}"')) + f" AS {c}"
               for kind, names in kinds.items() for c in names]
    if view != "v_bios":
        outputs.append('"SEASONTYPE" AS season_type')
    return (f"{view} AS (SELECT {', '.join(outputs)} FROM "
            f"(SELECT nullif(trim(COLUMNS('(.+)')), '') AS '\\1' FROM {raw}))")


STAGING_CTES = "\n" + ",\n".join(map(_staged, _KINDS))

# Model.  A game is one row that lists its sides; an opponent is any side of another team.
_OPPOSED = _STAT_LIST[1:]


def _sides(rows: str, game: str = "game_id") -> str:
    fields = ", ".join(f"'{c}': {c}" for c in ["team_id", *_STAT_LIST])
    return f"SELECT {game}, list({{{fields}}}) AS sides FROM {rows} WHERE {game} IS NOT NULL GROUP BY {game}"


def _against(rows: str, games: str) -> str:
    return (f"SELECT r.*, unnest(list_filter(g.sides, lambda x: x.team_id <> r.team_id)) AS foe "
            f"FROM {rows} r JOIN {games} g USING (game_id)")


_YEAR = "CAST(season[1:4] AS INT)"
_TYPE = "list_position(['Regular Season', 'Playoffs'], season_type)"
_DIMENSIONS = (f"{_YEAR} AS year, nullif({_TYPE}, 0) AS season_type_key, "
               f"team_id || '|' || season[1:4] AS team_year_key, "
               f"season[1:4] || '|' || nullif({_TYPE}, 0) || '|' || team_id AS year_type_team_key")
_VENUE = "if(contains(matchup, 'vs'), 'Home', if(contains(matchup, '@'), 'Away', NULL)) AS home_away"
_TENS = "len(list_filter([pts, ast, reb, stl, blk], lambda v: v >= 10))"
_FOE = ", ".join(f"foe.{c} AS opp_{c}" for c in _OPPOSED)
_PROFILE = {"pts": "sum(pts) / gp", "fg2m": "(sum(fgm) - sum(fg3m)) / gp", "fg3m": "sum(fg3m) / gp", "reb": "sum(reb) / gp",
            "ast": "sum(ast) / gp", "stl": "sum(stl) / gp", "blk": "sum(blk) / gp",
            "ts": "50 * sum(pts) / nullif(100 * sum(fga) + 44 * sum(fta), 0)"}


def _as_double(e: str) -> str:
    left, _, right = e.rpartition(" / ")
    return f"CAST({left} AS DOUBLE) / {right.replace('gp', 'count(*)')}"


MODEL_CTES = f"""
dim_seasons AS (SELECT {_YEAR} AS year, season FROM v_team GROUP BY season),
dim_teams AS (
  SELECT team_id, team_abbreviation, team_name, year, team_id || '|' || year AS team_year_key, logo AS logo_by_year
  FROM (SELECT *, {_YEAR} AS year FROM v_team) JOIN (SELECT team AS team_name, year, logo FROM team_logos) USING (team_name, year)
  GROUP BY ALL),
excluded_games AS (
  SELECT unnest(['0021201214']) AS game_id UNION SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') FROM orders WHERE o_orderkey % 211 = 0),
raw_games AS ({_sides("v_team")}),
player_boxscores AS (
  SELECT player_id, team_id, foe.team_id AS opponent_id, {_DIMENSIONS}, game_id, game_date,
    CAST(year(game_date) - year(born) - if((month(game_date), day(game_date)) < (month(born), day(born)), 1, 0) AS INT) AS age,
    {_VENUE}, wl, {", ".join(_STAT_LIST)}, if({_TENS} >= 2, 1, 0) AS dd2, if({_TENS} >= 3, 1, 0) AS td3
  FROM ({_against("(SELECT p.*, b.birthdate AS born FROM v_player p JOIN v_bios b USING (player_id))", "raw_games")})),
team_boxscores_base AS (
  SELECT team_id, foe.team_id AS opponent_id, game_id, game_date, {_DIMENSIONS}, {_VENUE}, wl,
    {", ".join(_STAT_LIST)}, {_FOE}
  FROM ({_against("v_team", "raw_games")}) WHERE game_id NOT IN (FROM excluded_games)),
team_boxscores_agg_team_only AS (
  SELECT team_id, game_id, {", ".join(f"sum({c}) AS {c}" for c in _STAT_LIST)} FROM player_boxscores GROUP BY ALL),
rolled_games AS ({_sides("team_boxscores_agg_team_only")}),
team_boxscores_agg AS (SELECT * EXCLUDE (foe), {_FOE} FROM ({_against("team_boxscores_agg_team_only", "rolled_games")})),
team_boxscores AS (
  SELECT b.* REPLACE ({", ".join(f"ifnull(b.{c}, a.{c}) AS {c}" for c in [*_STAT_LIST, *("opp_" + c for c in _OPPOSED)])})
  FROM team_boxscores_base b LEFT JOIN team_boxscores_agg a USING (team_id, game_id)),
stints AS (
  SELECT player_id, team_id, team_name, logo_by_year AS logo, sum(weight) AS weight
  FROM (SELECT player_id, team_id, year, sum(ifnull(pts, 0) + ifnull(min, 0)) AS weight FROM player_boxscores GROUP BY ALL)
  JOIN dim_teams USING (team_id, year) GROUP BY ALL),
franchises AS (
  SELECT player_id, min(row(-weight, team_id)) AS top
  FROM (SELECT player_id, team_id, sum(weight) AS weight FROM stints GROUP BY ALL) GROUP BY player_id),
player_signature_team AS (
  SELECT player_id, any_value(top[2]) AS main_team_id, min(row(-weight, team_name, logo))[2] AS main_team_name,
    min(row(-weight, team_name, logo))[3] AS main_logo
  FROM stints JOIN franchises USING (player_id) WHERE team_id = top[2] GROUP BY player_id),
rates AS (
  SELECT player_id, year, {", ".join(f"{_as_double(e)} AS {p}" for p, e in _PROFILE.items())}
  FROM player_boxscores GROUP BY player_id, year HAVING sum(min) >= 1000),
axis_values AS (SELECT * FROM rates UNPIVOT INCLUDE NULLS (v FOR axis IN ({", ".join(_PROFILE)}))),
axis_ranks AS (
  SELECT year, axis, v, (sum(n) OVER smaller - n) * 100.0 / nullif(sum(n) OVER (PARTITION BY year, axis) - 1, 0) AS pctl
  FROM (SELECT year, axis, v, count(*) AS n FROM axis_values GROUP BY ALL)
  WINDOW smaller AS (PARTITION BY year, axis ORDER BY v NULLS LAST)),
career_percentiles AS (
  SELECT player_id, {", ".join(f"round(avg(CAST(ifnull(pctl, 0) AS DOUBLE)) FILTER (a.axis = '{p}'), 6) AS {p}_pctl"
                               for p in ["pts", "fg2m", "fg3m", "ts", "ast", "reb", "stl", "blk"])}
  FROM axis_values a JOIN axis_ranks r ON a.year IS NOT DISTINCT FROM r.year AND a.axis = r.axis AND a.v IS NOT DISTINCT FROM r.v
  GROUP BY player_id),
country_codes AS (SELECT * FROM (VALUES {{COUNTRY_VALUES}}) t(country, code)),
curated_names AS (SELECT * FROM (VALUES {{OVERRIDE_VALUES}}) t(player_id, name_override)),
name_overrides AS (
  FROM curated_names UNION ALL SELECT s_suppkey, 'Known as ' || s_suppkey FROM supplier
  WHERE s_suppkey % 29 = 3 AND s_suppkey NOT IN (SELECT player_id FROM curated_names)),
dim_players AS (
  SELECT player_id, ifnull((SELECT min(name_override) FROM name_overrides o WHERE o.player_id = v_bios.player_id),
                           display_first_last) AS player_name,
    v_bios.* EXCLUDE (player_id, first_name, last_name, display_first_last, player_slug, last_affiliation, greatest_75_flag),
    CAST((CAST(split_part(height, '-', 1) AS INT) * 3048 + CAST(split_part(height, '-', 2) AS INT) * 254 + 50) // 100 AS INT)
      AS height_cm,
    CAST((CAST(weight AS BIGINT) * 45359237 + 50000000) // 100000000 AS INT) AS weight_kg,
    'https://cdn.nba.com/headshots/nba/latest/1040x760/' || player_id || '.png' AS player_img,
    'https://flagcdn.com/' || (SELECT min(code) FROM country_codes c WHERE c.country = v_bios.country) || '.svg' AS country_flag,
    s.* EXCLUDE (player_id), p.* EXCLUDE (player_id)
  FROM v_bios LEFT JOIN player_signature_team s USING (player_id) LEFT JOIN career_percentiles p USING (player_id))"""


def _values() -> tuple[str, str]:
    from courtline.sources.lookups import COUNTRY_CODES, NAME_OVERRIDES
    cv = ", ".join(f"({_q(a)}, {_q(b)})" for a, b in COUNTRY_CODES)
    ov = ", ".join(f"(CAST({a} AS BIGINT), {_q(b)})" for a, b in NAME_OVERRIDES)
    return cv, ov


def with_ctes(select_sql: str, extra_ctes: str = "") -> str:
    cv, ov = _values()
    model = MODEL_CTES.replace("{COUNTRY_VALUES}", cv).replace("{OVERRIDE_VALUES}", ov)
    return ("WITH " + RAW_CTES.strip() + "," + STAGING_CTES + "," + model + extra_ctes + "\n"
            + select_sql)
