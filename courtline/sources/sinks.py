"""BI export projection (SNK6): display names and whole numbers for the semantic layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values: model column -> exported display name ----------------------------
_COMMON = {
    "team_id": "Team_ID", "opponent_id": "Opponent_ID", "game_id": "Game_ID",
    "game_date": "Game Date", "year": "Year", "season_type_key": "Season_Type_Key",
    "team_year_key": "Team_Year_Key", "year_type_team_key": "Year_Type_Team_Key",
    "home_away": "Home/Away", "wl": "W/L",
}
EXPORT_NAMES = {
    "team_boxscores": _COMMON,
    "player_boxscores": {**_COMMON, "player_id": "Player_ID", "age": "Age"},
    "dim_players": {
        "player_id": "Player_ID", "player_name": "Player", "birthdate": "Birthdate", "school": "School", "country": "Country",
        "height": "Height (in)", "height_cm": "Height (cm)", "weight": "Weight (lbs)", "weight_kg": "Weight (kg)",
        "season_exp": "Seasons", "jersey": "Jersey", "position": "Position", "from_year": "Played From", "to_year": "Played To",
        "draft_year": "Draft Year", "draft_round": "Draft Round", "draft_number": "Draft Number", "player_img": "Player Image",
        "country_flag": "Country Flag", "main_team_id": "Main_Team_ID", "main_team_name": "Main Team", "main_logo": "Main Logo",
    },
    "dim_teams": {"team_id": "Team_ID", "team_abbreviation": "Abbreviation", "team_name": "Team", "year": "Year",
                  "team_year_key": "Team_Year_Key", "logo_by_year": "Logo"},
    "dim_seasons": {"year": "Year", "season": "Season"},
    "dim_season_type": {"season_type_key": "Season_Type_Key", "season_type": "Season Type"},
}


def bi_projection(df: DataFrame, table: str) -> DataFrame:
    """Rename to display names and turn scale-0 decimals into whole numbers (BIGINT)."""
    names = EXPORT_NAMES.get(table, {})
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType) and f.dataType.scale == 0:
            c = c.cast("bigint")
        cols.append(c.alias(names.get(f.name, f.name.upper())))
    return df.select(*cols)


def write_bi_export(df: DataFrame, table: str, path: str) -> str:
    bi_projection(df, table).write.mode("overwrite").parquet(path)
    return path
