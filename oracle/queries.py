"""Oracle SQL per registered query key (DuckDB dialect, testdata views pre-registered)."""

from __future__ import annotations

from oracle.fixture import _STAT_LIST as STATS16, _OPPOSED as OPP_STATS
from oracle.fixture import fold_sql, with_ctes  # noqa: E402

SQL: dict[str, str] = {}

_OPP = ["opp_" + c for c in OPP_STATS]


def _replace(table: str, big: list[str] = (), dbl: list[str] = ()) -> str:
    reps = [f"CAST({c} AS BIGINT) AS {c}" for c in big] + [f"ROUND({c}, 6) AS {c}" for c in dbl]
    if not reps:
        return f"SELECT * FROM {table}"
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM {table}"


def reg(name: str, select_sql: str, ctes: bool = True) -> None:
    """Register ``select_sql``; a leading ``__EXTRA__<ctes>__SELECT__`` block appends
    CTEs after the model chain."""
    if select_sql.startswith("__EXTRA__"):
        extra, sel = select_sql[len("__EXTRA__"):].split("__SELECT__", 1)
        SQL[name] = with_ctes(sel, extra)
        return
    SQL[name] = with_ctes(select_sql) if ctes else select_sql


# ---- staging --------------------------------------------------------------------------
reg("staging_bios", "SELECT * FROM v_bios")
reg("staging_player", _replace("v_player", STATS16 + ["plus_minus"]))
reg("staging_team", _replace("v_team", STATS16))
reg("accent_fold", f"SELECT doc_id, {fold_sql('text')} AS text_folded FROM documents", ctes=False)

# ---- lookups applied to data ----------------------------------------------------------
reg("lookup_country", "SELECT b.player_id, b.country, cc.code FROM v_bios b "
                      "LEFT JOIN country_codes cc ON b.country = cc.country")
reg("lookup_override", "SELECT player_id, player_name FROM dim_players")
reg("lookup_season_type",
    "SELECT g.season_type_key, st.season_type, g.games FROM "
    "(SELECT season_type_key, COUNT(*) AS games FROM team_boxscores GROUP BY season_type_key) g "
    "LEFT JOIN (VALUES (1, 'Regular Season'), (2, 'Playoffs')) st(season_type_key, season_type) "
    "ON g.season_type_key = st.season_type_key")
reg("lookup_logo", "SELECT * FROM team_logos")

# ---- dimensions -----------------------------------------------------------------------
reg("dim_seasons", "SELECT * FROM dim_seasons")
reg("dim_teams", "SELECT * FROM dim_teams")
reg("dim_date",
    "SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, "
    "CAST(month(d) AS INT) AS month, monthname(d) AS month_name, CAST(day(d) AS INT) AS day, "
    "CAST(isodow(d) AS INT) AS iso_dow, CAST(dayofyear(d) AS INT) AS day_of_year "
    "FROM (SELECT unnest(generate_series(MIN(game_date), MAX(game_date), INTERVAL 1 DAY)) AS d "
    "FROM player_boxscores)")

# ---- facts ----------------------------------------------------------------------------
reg("fact_player", _replace("player_boxscores", STATS16))
reg("fact_team_base", _replace("team_boxscores_base", STATS16 + _OPP))
reg("fact_team_agg_only", _replace("team_boxscores_agg_team_only", STATS16))
reg("fact_team_agg", _replace("team_boxscores_agg", STATS16 + _OPP))
reg("fact_team", _replace("team_boxscores", STATS16 + _OPP))
reg("composite_keys", "SELECT player_id, game_id, team_id, year, season_type_key, "
                      "team_year_key, year_type_team_key FROM player_boxscores")

# ---- derived --------------------------------------------------------------------------
reg("signature_team", "SELECT * FROM player_signature_team")
reg("career_percentiles", "SELECT * FROM career_percentiles")
reg("dim_players", "SELECT * FROM dim_players")

_EXPORT = {"team_id": "Team_ID", "opponent_id": "Opponent_ID", "game_id": "Game_ID",
           "game_date": "Game Date", "year": "Year", "season_type_key": "Season_Type_Key",
           "team_year_key": "Team_Year_Key", "year_type_team_key": "Year_Type_Team_Key",
           "home_away": "Home/Away", "wl": "W/L"}
reg("bi_export", "SELECT " + ", ".join(
    [f'{k} AS "{v}"' for k, v in _EXPORT.items()]
    + [f'CAST({c} AS BIGINT) AS "{c.upper()}"' for c in STATS16 + _OPP])
    + " FROM team_boxscores")

# fixed values: the exported names of the dimensions' columns
_EXPORTS = {
    "dim_players": 'player_id AS "Player_ID", player_name AS "Player", birthdate AS "Birthdate", school AS "School", country AS "Country", '
                   'height AS "Height (in)", height_cm AS "Height (cm)", weight AS "Weight (lbs)", weight_kg AS "Weight (kg)", '
                   'season_exp AS "Seasons", jersey AS "Jersey", position AS "Position", from_year AS "Played From", '
                   'to_year AS "Played To", draft_year AS "Draft Year", draft_round AS "Draft Round", '
                   'draft_number AS "Draft Number", player_img AS "Player Image", country_flag AS "Country Flag", '
                   'main_team_id AS "Main_Team_ID", main_team_name AS "Main Team", main_logo AS "Main Logo", '
                   + ", ".join(f'{c}_pctl AS "{c.upper()}_PCTL"' for c in ["pts", "fg2m", "fg3m", "ts", "ast", "reb", "stl", "blk"]),
    "dim_teams": 'team_id AS "Team_ID", team_abbreviation AS "Abbreviation", team_name AS "Team", year AS "Year", '
                 'team_year_key AS "Team_Year_Key", logo_by_year AS "Logo"',
    "dim_seasons": 'year AS "Year", season AS "Season"',
    "player_boxscores": ", ".join([f'{k} AS "{v}"' for k, v in _EXPORT.items()]
                                  + ['player_id AS "Player_ID"', 'age AS "Age"', 'dd2 AS "DD2"', 'td3 AS "TD3"']
                                  + [f'CAST({c} AS BIGINT) AS "{c.upper()}"' for c in STATS16]),
}
for _t, _cols in _EXPORTS.items():
    reg(f"bi_export_{_t}", f"SELECT {_cols} FROM {_t}")

# ---- data-quality checks --------------------------------------------------------------
reg("check_orphans", "SELECT player_id FROM v_player EXCEPT SELECT player_id FROM v_bios")


def _repeated(rows: str, *keys: str) -> str:
    """Keys of several rows: a row in each key's window that is the second, with the window's size."""
    k = ", ".join(keys)
    return f"SELECT {k}, count(*) OVER same AS count FROM {rows} WINDOW same AS (PARTITION BY {k}) QUALIFY row_number() OVER same = 2"


reg("check_dup_player", _repeated("v_player", "player_id", "game_id", "team_id"))
reg("check_dup_team", _repeated("v_team", "game_id", "team_id"))
reg("check_missing_logo", "SELECT team_name, CAST(season[1:4] AS INT) AS year FROM v_team EXCEPT SELECT team, year FROM team_logos")
reg("check_fact_parity",
    "SELECT 'player_boxscores' AS source, COUNT(*) AS n FROM player_boxscores "
    "UNION ALL SELECT 'v_player_boxscores', COUNT(*) FROM v_player")
reg("check_selfjoin_parity",
    "SELECT 'opponent_join' AS source, COUNT(*) AS n FROM v_team t JOIN v_team o "
    "ON t.game_id = o.game_id AND t.team_id <> o.team_id "
    "UNION ALL SELECT 'v_team_boxscores', COUNT(*) FROM v_team")
reg("check_homonyms", "SELECT player_name, player_id, birthdate FROM dim_players WHERE player_name IS NOT NULL "
                      "QUALIFY count(*) OVER (PARTITION BY player_name) > 1")
reg("check_dup_dim", _repeated("dim_players", "player_id"))


def _missing(c: str) -> str:
    """Percent of NULLs to one place, half up, from the rows and the non-NULL ones."""
    return f"CAST((2000 * (count(*) - count({c})) + count(*)) // (2 * count(*)) AS DOUBLE) / 10"


reg("check_completeness", f"SELECT CAST(season[1:4] AS INT) AS year, count(*) AS games, "
    + ", ".join(f"{_missing(c)} AS pct_missing_{c}" for c in ["oreb", "dreb", "stl", "blk", "tov"])
    + " FROM v_team GROUP BY year ORDER BY year")
reg("check_dim_parity",
    "SELECT 'dim_players' AS source, COUNT(*) AS n FROM dim_players "
    "UNION ALL SELECT 'v_bios', COUNT(*) FROM v_bios")
reg("check_dups_native",
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS count FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1", ctes=False)
reg("check_missing_native",
    "SELECT d.lang, COUNT(*) AS games, "
    + ", ".join(f"{_missing('l.' + c)} AS pct_missing_{c}" for c in ["quality", "toxic"])
    + " FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang", ctes=False)


import oracle.measures_sql  # noqa: E402,F401  (registers measure SQL)

# ---- season refresh -------------------------------------------------------------------
# The raw rows as the refresh must leave them: other seasons as they were, of the current one
# the games of the new load, with its corrected points.
def _after_refresh(table: str) -> str:
    last = f'(SELECT max("Season") FROM raw_team_loaded)'
    return (f'{table} AS (SELECT * REPLACE (CASE WHEN "Season" = {last} AND trim("PTS") <> \'\' '
            f'THEN CAST(CAST(trim("PTS") AS BIGINT) + 1 AS VARCHAR) ELSE "PTS" END AS "PTS") FROM {table}_loaded '
            f'WHERE ("Season" = {last} AND CAST("GAME_ID" AS BIGINT) % 5 = 0) IS NOT TRUE)')


def reg_refreshed(name: str, select_sql: str) -> None:
    sql = with_ctes(select_sql)
    for t in ("raw_player", "raw_team"):
        sql = sql.replace(f"\n{t} AS (", f"\n{t}_loaded AS (", 1)
    head, tail = sql.split("\nraw_bios AS (", 1)
    SQL[name] = f"{head}\n{_after_refresh('raw_player')},\n{_after_refresh('raw_team')},\nraw_bios AS ({tail}"


reg_refreshed("refresh_season", "SELECT * FROM raw_team")
reg_refreshed("refresh_season_players", 'SELECT * EXCLUDE ("SEASON_ID", "PLAYER_NAME", "TEAM_ABBREVIATION", "TEAM_NAME") FROM raw_player')
reg_refreshed("refresh_equals_rebuild", _replace("team_boxscores", STATS16 + _OPP))
reg_refreshed("refresh_player_fact", _replace("player_boxscores", STATS16))
reg_refreshed("refresh_dim_players", "SELECT * FROM dim_players")

# ---- CSV files ------------------------------------------------------------------------
for _name in ("bios", "player", "team"):
    SQL[f"csv_{_name}"] = SQL[f"staging_{_name}"]

# ---- loads of dirty files -------------------------------------------------------------
_BAD_CELLS = {"GAME_DATE": (29, "31/02/1997", "date"), "MIN": (31, "12:30", "decimal(10,0)"), "TEAM_ID": (37, "12.0", "bigint"),
              "PTS": (43, "n/a", "decimal(10,0)")}
_SPOILED = " OR ".join(f"n % {k} = 0" for k in [41, *(k for k, _, _ in _BAD_CELLS.values())])


def _dirty(name: str) -> str:
    """Raw rows with ``n``, by which cells are bad and lines cut short, and the first five cells of a line."""
    head = {"player": ["PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "TEAM_ABBREVIATION"],
            "team": ["TEAM_ID", "TEAM_ABBREVIATION", "TEAM_NAME", "GAME_ID"]}[name]
    n = " + ".join(f'CAST("{c}" AS BIGINT)' for c in ["GAME_ID", "TEAM_ID", *(["PLAYER_ID"] if name == "player" else [])])
    cells = " || ',' || ".join(f'if(n % {_BAD_CELLS[c][0]} = 0, \'{_BAD_CELLS[c][1]}\', "{c}")' if c in _BAD_CELLS else f'"{c}"' for c in head)
    season = "if(\"SeasonType\" = 'Playoffs', '4', '2') || \"Season\"[1:4]"
    return f", dirty_{name} AS (SELECT n, {season} || ',' || {cells} AS line_head FROM (SELECT *, {n} AS n FROM raw_{name}))"


def _rejects(name: str) -> str:
    return (f"SELECT line_head, NULL::VARCHAR AS \"column\", NULL::VARCHAR AS value, 'cells' AS reason FROM dirty_{name} WHERE n % 41 = 0"
            + "".join(f" UNION ALL SELECT line_head, '{c}', '{v}', '{kind}' FROM dirty_{name} WHERE n % {k} = 0 AND n % 41 <> 0"
                      for c, (k, v, kind) in _BAD_CELLS.items()))


for _t in ("player", "team"):
    _whole = STATS16 + (["plus_minus"] if _t == "player" else [])
    _n = "CAST(game_id AS BIGINT) + team_id" + (" + player_id" if _t == "player" else "")
    reg(f"load_{_t}_rows", f"SELECT * EXCLUDE (n) FROM (SELECT * REPLACE ({', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in _whole)}), "
                           f"{_n} AS n FROM v_{_t}) WHERE NOT ({_SPOILED})")
    reg(f"load_{_t}_rejects", f"__EXTRA__{_dirty(_t)}\n__SELECT__{_rejects(_t)}")
reg("load_counts", f"__EXTRA__{_dirty('player')}{_dirty('team')}\n__SELECT__" + " UNION ALL ".join(
    f"SELECT '{t}_boxscores' AS source, count(*) AS lines, count(*) FILTER (NOT ({_SPOILED})) AS rows, "
    f"count(*) FILTER ({_SPOILED}) AS rejected_lines, (SELECT count(*) FROM ({_rejects(t)})) AS rejects FROM dirty_{t}" for t in ("player", "team")))

# ---- views by name --------------------------------------------------------------------
for _name in ("bios", "player", "team"):
    SQL[f"view_{_name}"] = SQL[f"staging_{_name}"]
reg("view_season_games", "SELECT season, count(DISTINCT game_id) AS games, CAST(sum(pts) AS BIGINT) AS pts FROM v_team GROUP BY season")
SQL["rebuild_dim_players"] = SQL["refresh_dim_players"]

# ---- logo files -----------------------------------------------------------------------
reg("logo_upsert",
    "SELECT team, year, "
    "CASE WHEN year = 1994 THEN 'kept' WHEN year = 1995 THEN 'update' WHEN year < 1997 THEN 'unchanged' "
    "WHEN year = 1998 THEN 'conflict' ELSE 'insert' END AS first_action, "
    "CASE year WHEN 1994 THEN 'kept' WHEN 1998 THEN 'conflict' ELSE 'unchanged' END AS second_action, "
    "CASE year WHEN 1995 THEN 'new/' || logo WHEN 1998 THEN NULL ELSE logo END AS logo, "
    "CASE year WHEN 1994 THEN 0 WHEN 1997 THEN 2 WHEN 1998 THEN 2 ELSE 1 END AS times FROM team_logos")

# ---- duplicate checks after a load that came twice --------------------------------------
_TWICE = "(FROM v_team UNION ALL FROM v_team WHERE season = (SELECT max(season) FROM v_team))"
reg("check_dup_team_reload", _repeated(_TWICE, "game_id", "team_id"))
reg("check_dup_dim_reload", _repeated("(FROM dim_players UNION ALL FROM dim_players WHERE player_id % 7 = 0)", "player_id"))

# ---- season rates ---------------------------------------------------------------------
reg("season_rates",
    "SELECT player_id, year, count(*) AS gp, CAST(sum(min) AS BIGINT) AS min, "
    + ", ".join(f"round(CAST(sum({c}) AS DOUBLE) / count(*), 6) AS {c}_pg" for c in STATS16)
    + ", round(CAST(sum(fgm) - sum(fg3m) AS DOUBLE) / count(*), 6) AS fg2m_pg"
      ", round(CAST(sum(fga) - sum(fg3a) AS DOUBLE) / count(*), 6) AS fg2a_pg"
      ", round(CAST(50 * sum(pts) AS DOUBLE) / nullif(100 * sum(fga) + 44 * sum(fta), 0), 6) AS ts"
      ", CAST(sum(dd2) AS BIGINT) AS dd2, CAST(sum(td3) AS BIGINT) AS td3 "
      "FROM player_boxscores GROUP BY player_id, year HAVING sum(min) >= 1000")

# ---- operators on native tables -------------------------------------------------------
reg("opponent_join_native",
    "WITH s AS (SELECT l_orderkey, l_linenumber % 2 AS side, "
    "CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty, "
    "CAST(SUM(1) AS BIGINT) AS lines FROM lineitem GROUP BY 1, 2) "
    "SELECT t.l_orderkey, t.side, o.side AS opp_side, t.qty, t.lines, o.qty AS opp_qty, "
    "o.lines AS opp_lines FROM s t JOIN s o ON t.l_orderkey = o.l_orderkey AND t.side <> o.side",
    ctes=False)
reg("backfill_native",
    "SELECT b.o_orderkey, b.o_orderstatus, COALESCE(b.o_totalprice, a.o_totalprice) AS o_totalprice "
    "FROM (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN ROUND(o_totalprice, 2) "
    "END AS o_totalprice FROM orders) b LEFT JOIN (SELECT l_orderkey AS o_orderkey, "
    "ROUND(SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS o_totalprice FROM lineitem "
    "GROUP BY 1) a ON b.o_orderkey = a.o_orderkey", ctes=False)
reg("signature_native",
    "WITH amounts AS (SELECT o_custkey, p_brand, p_type, CAST(sum(l_quantity) AS BIGINT) AS qty FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL), "
    "mains AS (SELECT o_custkey, min(row(-qty, p_brand))[2] AS p_brand FROM "
    "(SELECT o_custkey, p_brand, sum(qty) AS qty FROM amounts GROUP BY ALL) GROUP BY o_custkey) "
    "SELECT o_custkey, p_brand, min(row(-qty, p_type))[2] AS p_type, max(qty) AS qty "
    "FROM amounts JOIN mains USING (o_custkey, p_brand) GROUP BY ALL", ctes=False)
reg("percentile_native",
    "WITH po AS (SELECT l_orderkey, SUM(l_quantity) AS q FROM lineitem GROUP BY 1), "
    "r AS (SELECT o.o_custkey, year(o.o_orderdate) AS year, CAST(SUM(po.q) AS DOUBLE) AS qty, "
    "CAST(COUNT(*) AS DOUBLE) AS orders FROM orders o LEFT JOIN po ON o.o_orderkey = po.l_orderkey "
    "GROUP BY 1, 2), "
    "pr AS (SELECT o_custkey, PERCENT_RANK() OVER (PARTITION BY year ORDER BY qty ASC NULLS LAST) * 100 "
    "AS qty_pctl, PERCENT_RANK() OVER (PARTITION BY year ORDER BY orders ASC NULLS LAST) * 100 "
    "AS orders_pctl FROM r) "
    "SELECT o_custkey, ROUND(AVG(qty_pctl), 6) AS qty_pctl, ROUND(AVG(orders_pctl), 6) AS orders_pctl "
    "FROM pr GROUP BY 1", ctes=False)
reg("latest_state_native",
    "SELECT e.user_id, CASE WHEN COUNT(DISTINCT e.event_type) = 1 THEN MIN(e.event_type) END "
    "AS event_type FROM events e JOIN (SELECT user_id, MAX(ts) AS last_ts FROM events GROUP BY 1) l "
    "ON e.user_id = l.user_id AND e.ts = l.last_ts GROUP BY e.user_id", ctes=False)
