"""Declared schemas: the all-text raw layer and the typed staging specs.

Raw tables are read with an explicit all-string schema (never ``inferSchema``) so a
malformed historical value can never change a column type; typing happens in staging.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: raw column names, in source order --------------------------------
RAW_BIOS_COLUMNS = [
    "PERSON_ID", "FIRST_NAME", "LAST_NAME", "DISPLAY_FIRST_LAST", "DISPLAY_LAST_COMMA_FIRST",
    "DISPLAY_FI_LAST", "PLAYER_SLUG", "BIRTHDATE", "SCHOOL", "COUNTRY", "LAST_AFFILIATION",
    "HEIGHT", "WEIGHT", "SEASON_EXP", "JERSEY", "POSITION", "ROSTERSTATUS",
    "GAMES_PLAYED_CURRENT_SEASON_FLAG", "TEAM_ID", "TEAM_NAME", "TEAM_ABBREVIATION",
    "TEAM_CODE", "TEAM_CITY", "PLAYERCODE", "FROM_YEAR", "TO_YEAR", "DLEAGUE_FLAG",
    "NBA_FLAG", "GAMES_PLAYED_FLAG", "DRAFT_YEAR", "DRAFT_ROUND", "DRAFT_NUMBER",
    "GREATEST_75_FLAG", "PLAYER_ID",
]

RAW_PLAYER_COLUMNS = [
    "SEASON_ID", "PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "TEAM_ABBREVIATION", "TEAM_NAME",
    "GAME_ID", "GAME_DATE", "MATCHUP", "WL", "MIN", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A",
    "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB", "DREB", "REB", "AST", "STL", "BLK", "TOV",
    "PF", "PTS", "PLUS_MINUS", "FANTASY_PTS", "VIDEO_AVAILABLE", "Season", "SeasonType",
]

RAW_TEAM_COLUMNS = [
    "SEASON_ID", "TEAM_ID", "TEAM_ABBREVIATION", "TEAM_NAME", "GAME_ID", "GAME_DATE",
    "MATCHUP", "WL", "MIN", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA",
    "FT_PCT", "OREB", "DREB", "REB", "AST", "STL", "BLK", "TOV", "PF", "PTS", "PLUS_MINUS",
    "VIDEO_AVAILABLE", "Season", "SeasonType",
]

# The sixteen box-score statistics carried through every fact table, in model order.
STATS16 = ["min", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb",
           "ast", "stl", "blk", "tov", "pf", "pts"]
# Opponent columns carry every statistic except minutes.
OPP_STATS = [c for c in STATS16 if c != "min"]

STAT_TYPE = T.DecimalType(10, 0)
# Their sums over a game: the most digits that rows and files still hold as a long.
SUM_TYPE = T.DecimalType(18, 0)


def all_text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


RAW_SCHEMAS = {
    "bios": all_text_schema(RAW_BIOS_COLUMNS),
    "player_boxscores": all_text_schema(RAW_PLAYER_COLUMNS),
    "team_boxscores": all_text_schema(RAW_TEAM_COLUMNS),
}

LOGO_SCHEMA = T.StructType([
    T.StructField("team", T.StringType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("logo", T.StringType(), True),
])

# ---- staging specs: (output column, raw column, kind) --------------------------------
# kinds: text | fold (accent-folded text) | long | int | stat | date | country | jersey
BIOS_SPEC = [
    ("player_id", "PLAYER_ID", "long"),
    ("first_name", "FIRST_NAME", "fold"),
    ("last_name", "LAST_NAME", "fold"),
    ("display_first_last", "DISPLAY_FIRST_LAST", "fold"),
    ("player_slug", "PLAYER_SLUG", "text"),
    ("birthdate", "BIRTHDATE", "date"),
    ("school", "SCHOOL", "text"),
    ("country", "COUNTRY", "country"),
    ("last_affiliation", "LAST_AFFILIATION", "text"),
    ("height", "HEIGHT", "text"),
    ("weight", "WEIGHT", "int"),
    ("season_exp", "SEASON_EXP", "int"),
    ("jersey", "JERSEY", "jersey"),
    ("position", "POSITION", "text"),
    ("from_year", "FROM_YEAR", "int"),
    ("to_year", "TO_YEAR", "int"),
    ("draft_year", "DRAFT_YEAR", "text"),
    ("draft_round", "DRAFT_ROUND", "text"),
    ("draft_number", "DRAFT_NUMBER", "text"),
    ("greatest_75_flag", "GREATEST_75_FLAG", "text"),
]

PLAYER_SPEC = (
    [("player_id", "PLAYER_ID", "long"),
     ("team_id", "TEAM_ID", "long"),
     ("game_id", "GAME_ID", "text"),
     ("game_date", "GAME_DATE", "date"),
     ("matchup", "MATCHUP", "text"),
     ("wl", "WL", "text")]
    + [(c, c.upper(), "stat") for c in STATS16]
    + [("plus_minus", "PLUS_MINUS", "stat"),
       ("season", "Season", "text"),
       ("season_type", "SeasonType", "text")]
)

TEAM_SPEC = (
    [("team_id", "TEAM_ID", "long"),
     ("team_abbreviation", "TEAM_ABBREVIATION", "text"),
     ("team_name", "TEAM_NAME", "text"),
     ("game_id", "GAME_ID", "text"),
     ("game_date", "GAME_DATE", "date"),
     ("matchup", "MATCHUP", "text"),
     ("wl", "WL", "text")]
    + [(c, c.upper(), "stat") for c in STATS16]
    + [("season", "Season", "text"),
       ("season_type", "SeasonType", "text")]
)

STAGING_SPECS = {"bios": BIOS_SPEC, "player_boxscores": PLAYER_SPEC, "team_boxscores": TEAM_SPEC}
