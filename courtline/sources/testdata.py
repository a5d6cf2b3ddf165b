"""Map the driver's TPC-H-ish tables onto the raw box-score shapes.

A game is an order, a player is a supplier, and a team is a nation.  Each order's
line items split into two sides by line-number parity; a player's line items on one
side form one player-game row.  Team rows are the sums of their player rows, with a
deliberately gappy stretch of seasons so the reconstruction chain has work to do.
All derived with DataFrame expressions, so the fixture's work scales with lineitem.

The same mapping, written as SQL, feeds the DuckDB oracle (``oracle/fixture.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: fixture parameters ----------------------------------------------
N_TEAMS = 25                 # teams are the 25 nations
ERA_SPLIT_YEAR = 1998        # team names get an era suffix: ' A' before, ' B' from it
UNRECORDED_YEAR = 1995       # steals and blocks were not recorded this season
TEAM_GAP_YEARS = (1996, 1997)  # team rows miss oreb/dreb/stl/blk/tov (~90%)
MISSING_LOGO = (24, 2001)    # one team-season without a logo row
VOID_GAMES = 211             # of these orders the game is void
KNOWN_AS = (29, 3)           # players of this remainder have a display name of their own
COUNTRIES_BY_MOD6 = ["USA", "México", "DRC", "Macedonia", "France", "Atlantis"]
ACCENTED_FIRST_NAME = "Đorđe Łæßčé"
POSITIONS = ["Guard", "Forward", "Center"]
GAP_STATS = ["oreb", "dreb", "stl", "blk", "tov"]


_PLANS: dict[tuple, DataFrame] = {}


def _memo(key: tuple, build):
    """Reuse a built plan (not data) for the same session and input folder."""
    if key not in _PLANS:
        _PLANS[key] = build()
    return _PLANS[key]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _memo((spark.sparkContext.applicationId, sf_dir, "read", name),
                 lambda: spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _txt(c: Column) -> Column:
    """Numeric -> raw text; NULL becomes the empty string a CSV would hold."""
    return F.coalesce(c.cast("string"), F.lit(""))


def _abbr(team: Column) -> Column:
    return F.concat(F.lit("T"), team.cast("string"))


def _season_label(y: Column) -> Column:
    return F.concat(y.cast("string"), F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def player_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed player-game rows (numeric stats with NULL gaps) before text encoding."""
    return _memo((spark.sparkContext.applicationId, sf_dir, "player_games"), lambda: _player_games(spark, sf_dir))


def player_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums that a player-game row is made of: player, order, side, quantity and date.

    Both inputs are dealt by the order, which the sums and a table in buckets of the order keep to.
    """
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber",
                                                  "l_quantity").repartition("l_orderkey")
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").repartition("o_orderkey")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .groupBy(F.col("l_suppkey").alias("s"), F.col("l_orderkey").alias("o"),
                     (F.col("l_linenumber") % 2).alias("side"))
            .agg(F.sum("l_quantity").cast("bigint").alias("q"),
                 F.max("o_orderdate").alias("odate")))


def use_player_lines(spark: SparkSession, sf_dir: str, df: DataFrame) -> None:
    """Serve later fixture builds from ``df`` (e.g. materialised player_lines)."""
    _PLANS[(spark.sparkContext.applicationId, sf_dir, "player_lines")] = df


def _player_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _memo((spark.sparkContext.applicationId, sf_dir, "player_lines"), lambda: player_lines(spark, sf_dir))
    s, o, q = F.col("s"), F.col("o"), F.col("q")
    y = F.year("odate")
    home = o % N_TEAMS
    away = (o + 1 + o % 12) % N_TEAMS
    fgm = q % 12
    fg3m = F.least(q % 12, q % 4)
    ftm = q % 6
    oreb = q % 5
    dreb = (q + o) % 9
    gap = (y < ERA_SPLIT_YEAR) & (o % 67 == 0)
    nogap = lambda c: F.when(~gap, c)
    return lines.select(
        s, o, F.col("side"), q,
        y.alias("y"), F.month("odate").alias("m"), F.to_date("odate").alias("game_date"),
        F.when(F.col("side") == 0, home).otherwise(away).alias("team"),
        home.alias("home"), away.alias("away"),
        F.when(~((s % 7 == 0) & (o % 11 == 0)), q % 37).alias("min"),
        fgm.alias("fgm"), (fgm + q % 9).alias("fga"),
        fg3m.alias("fg3m"), (fg3m + q % 3).alias("fg3a"),
        ftm.alias("ftm"), (ftm + q % 3).alias("fta"),
        nogap(oreb).alias("oreb"), nogap(dreb).alias("dreb"), (oreb + dreb).alias("reb"),
        ((q + s) % 13).alias("ast"),
        F.when(y != UNRECORDED_YEAR, nogap((q + o) % 4)).alias("stl"),
        F.when(y != UNRECORDED_YEAR, nogap((o + s) % 3)).alias("blk"),
        nogap(q % 5).alias("tov"), (q % 6).alias("pf"),
        (2 * fgm + fg3m + ftm).alias("pts"),
        (q % 21 - 10).alias("plus_minus"),
    )


def _game_text(df: DataFrame, nation: DataFrame) -> DataFrame:
    """Columns shared by player and team raw rows (ids, names, matchup, season)."""
    side0 = F.col("side") == 0
    y = F.col("y")
    return (df.join(F.broadcast(nation.select("n_nationkey", "n_name")),  # 25 rows
                    F.col("team") == F.col("n_nationkey"))
            .withColumns({
                "_season": _season_label(y),
                "_stype": F.when(F.col("m").isin(5, 6), F.lit("Playoffs"))
                           .otherwise(F.lit("Regular Season")),
                "_team_name": F.concat(F.col("n_name"),
                                       F.when(y < ERA_SPLIT_YEAR, F.lit(" A")).otherwise(F.lit(" B"))),
                "_matchup": F.when(side0, F.concat(_abbr(F.col("home")), F.lit(" vs. "),
                                                   _abbr(F.col("away"))))
                             .otherwise(F.concat(_abbr(F.col("away")), F.lit(" @ "),
                                                 _abbr(F.col("home")))),
                "_wl": F.when(side0 == (F.col("o") % 2 == 0), F.lit("W")).otherwise(F.lit("L")),
                "_game_id": F.lpad(F.col("o").cast("string"), 10, "0"),
            }))


def _stat_text(names: list[str]) -> list[Column]:
    return [_txt(F.col(c)).alias(c.upper()) for c in names]


def _pct_text(num: str, den: str, alias: str) -> Column:
    return _txt(F.round(F.try_divide(F.col(num).cast("double"), F.col(den).cast("double")), 3)
                ).alias(alias)


def raw_player_boxscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    pg = _game_text(player_games(spark, sf_dir), _read(spark, sf_dir, "nation"))
    pad = F.col("o") % 5 == 0  # some values arrive padded with spaces
    return pg.select(
        F.concat(F.when(F.col("_stype") == "Playoffs", F.lit("4")).otherwise(F.lit("2")),
                 F.col("y").cast("string")).alias("SEASON_ID"),
        F.col("s").cast("string").alias("PLAYER_ID"),
        F.concat(F.lit("Player "), (F.col("s") % 40).cast("string")).alias("PLAYER_NAME"),
        F.col("team").cast("string").alias("TEAM_ID"),
        _abbr(F.col("team")).alias("TEAM_ABBREVIATION"),
        F.col("_team_name").alias("TEAM_NAME"),
        F.col("_game_id").alias("GAME_ID"),
        F.col("game_date").cast("string").alias("GAME_DATE"),
        F.col("_matchup").alias("MATCHUP"),
        F.col("_wl").alias("WL"),
        F.when(F.col("min").isNull() & (F.col("s") % 2 == 0), F.lit("  "))
         .otherwise(_txt(F.col("min"))).alias("MIN"),
        _txt(F.col("fgm")).alias("FGM"), _txt(F.col("fga")).alias("FGA"),
        _pct_text("fgm", "fga", "FG_PCT"),
        _txt(F.col("fg3m")).alias("FG3M"), _txt(F.col("fg3a")).alias("FG3A"),
        _pct_text("fg3m", "fg3a", "FG3_PCT"),
        _txt(F.col("ftm")).alias("FTM"), _txt(F.col("fta")).alias("FTA"),
        _pct_text("ftm", "fta", "FT_PCT"),
        *_stat_text(["oreb", "dreb", "reb", "ast", "stl", "blk", "tov", "pf"]),
        F.when(pad, F.concat(F.lit(" "), _txt(F.col("pts")), F.lit(" ")))
         .otherwise(_txt(F.col("pts"))).alias("PTS"),
        _txt(F.col("plus_minus")).alias("PLUS_MINUS"),
        F.lit("").alias("FANTASY_PTS"),
        F.lit("1").alias("VIDEO_AVAILABLE"),
        F.col("_season").alias("Season"),
        F.col("_stype").alias("SeasonType"),
    )


def raw_team_boxscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    pg = player_games(spark, sf_dir)
    stats = ["min", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb",
             "ast", "stl", "blk", "tov", "pf", "pts", "plus_minus"]
    team = (pg.groupBy("o", "side")
            .agg(F.first("y").alias("y"), F.first("m").alias("m"),
                 F.first("game_date").alias("game_date"), F.first("team").alias("team"),
                 F.first("home").alias("home"), F.first("away").alias("away"),
                 *[F.sum(c).cast("bigint").alias(c) for c in stats]))
    in_gap = F.col("y").isin(*TEAM_GAP_YEARS) & (F.col("o") % 10 != 0)
    team = team.withColumns({c: F.when(~in_gap, F.col(c)) for c in GAP_STATS})
    tg = _game_text(team, _read(spark, sf_dir, "nation"))
    return tg.select(
        F.concat(F.when(F.col("_stype") == "Playoffs", F.lit("4")).otherwise(F.lit("2")),
                 F.col("y").cast("string")).alias("SEASON_ID"),
        F.col("team").cast("string").alias("TEAM_ID"),
        _abbr(F.col("team")).alias("TEAM_ABBREVIATION"),
        F.col("_team_name").alias("TEAM_NAME"),
        F.col("_game_id").alias("GAME_ID"),
        F.col("game_date").cast("string").alias("GAME_DATE"),
        F.col("_matchup").alias("MATCHUP"),
        F.col("_wl").alias("WL"),
        _txt(F.col("min")).alias("MIN"),
        _txt(F.col("fgm")).alias("FGM"), _txt(F.col("fga")).alias("FGA"),
        _pct_text("fgm", "fga", "FG_PCT"),
        _txt(F.col("fg3m")).alias("FG3M"), _txt(F.col("fg3a")).alias("FG3A"),
        _pct_text("fg3m", "fg3a", "FG3_PCT"),
        _txt(F.col("ftm")).alias("FTM"), _txt(F.col("fta")).alias("FTA"),
        _pct_text("ftm", "fta", "FT_PCT"),
        *_stat_text(["oreb", "dreb", "reb", "ast", "stl", "blk", "tov", "pf", "pts",
                     "plus_minus"]),
        F.lit("1").alias("VIDEO_AVAILABLE"),
        F.col("_season").alias("Season"),
        F.col("_stype").alias("SeasonType"),
    )


def raw_bios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bio per supplier, except every tenth (those players become orphans)."""
    sup = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"))
    s = F.col("s")
    first = F.when(s % 5 == 0, F.lit(ACCENTED_FIRST_NAME)).otherwise(F.lit("Player"))
    last = (s % 40).cast("string")
    country = F.element_at(F.array(*[F.lit(c) for c in COUNTRIES_BY_MOD6]),
                           (s % 6 + 1).cast("int"))
    birth = F.when(s % 13 == 5, F.lit("1972-02-29")).otherwise(
        F.date_add(F.lit("1960-01-01").cast("date"), ((s * 37) % 7000).cast("int")).cast("string"))
    undrafted = s % 8 == 0
    return sup.filter(s % 10 != 9).select(
        s.cast("string").alias("PERSON_ID"),
        first.alias("FIRST_NAME"),
        last.alias("LAST_NAME"),
        F.concat(first, F.lit(" "), last).alias("DISPLAY_FIRST_LAST"),
        F.concat(last, F.lit(", "), first).alias("DISPLAY_LAST_COMMA_FIRST"),
        F.concat(F.substring(first, 1, 1), F.lit(". "), last).alias("DISPLAY_FI_LAST"),
        F.concat(F.lit("player-"), s.cast("string")).alias("PLAYER_SLUG"),
        birth.alias("BIRTHDATE"),
        F.when(s % 9 == 0, F.lit("")).otherwise(
            F.concat(F.lit("School "), (s % 17).cast("string"))).alias("SCHOOL"),
        F.when(s % 4 == 0, F.concat(F.lit(" "), country, F.lit(" "))).otherwise(country)
         .alias("COUNTRY"),
        F.concat(F.lit("Affiliation "), (s % 7).cast("string")).alias("LAST_AFFILIATION"),
        F.concat((5 + s % 3).cast("string"), F.lit("-"), (s % 11).cast("string")).alias("HEIGHT"),
        F.when(s % 19 == 0, F.lit("")).otherwise((160 + (s * 7) % 90).cast("string"))
         .alias("WEIGHT"),
        (s % 15).cast("string").alias("SEASON_EXP"),
        F.when(s % 4 == 0, F.concat((s % 30).cast("string"), F.lit("-"),
                                    (s % 30 + 1).cast("string")))
         .otherwise((s % 50).cast("string")).alias("JERSEY"),
        F.element_at(F.array(*[F.lit(p) for p in POSITIONS]), (s % 3 + 1).cast("int"))
         .alias("POSITION"),
        F.when(s % 2 == 0, F.lit("Active")).otherwise(F.lit("Inactive")).alias("ROSTERSTATUS"),
        F.lit("Y").alias("GAMES_PLAYED_CURRENT_SEASON_FLAG"),
        (s % N_TEAMS).cast("string").alias("TEAM_ID"),
        F.lit("").alias("TEAM_NAME"), F.lit("").alias("TEAM_ABBREVIATION"),
        F.lit("").alias("TEAM_CODE"), F.lit("").alias("TEAM_CITY"),
        F.concat(F.lit("code_"), s.cast("string")).alias("PLAYERCODE"),
        (1995 + s % 4).cast("string").alias("FROM_YEAR"),
        (1997 + s % 5).cast("string").alias("TO_YEAR"),
        F.lit("N").alias("DLEAGUE_FLAG"), F.lit("Y").alias("NBA_FLAG"),
        F.lit("Y").alias("GAMES_PLAYED_FLAG"),
        F.when(undrafted, F.lit("Undrafted")).otherwise((1994 + s % 4).cast("string"))
         .alias("DRAFT_YEAR"),
        F.when(undrafted, F.lit("Undrafted")).otherwise((1 + s % 2).cast("string"))
         .alias("DRAFT_ROUND"),
        F.when(undrafted, F.lit("Undrafted")).otherwise((1 + s % 30).cast("string"))
         .alias("DRAFT_NUMBER"),
        F.when(s % 23 == 0, F.lit("Y")).otherwise(F.lit("N")).alias("GREATEST_75_FLAG"),
        s.cast("string").alias("PLAYER_ID"),
    )


def team_logos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Era logos: one row per (team, season year) that has games, less one team-season."""
    y = F.col("y")
    seasons = player_games(spark, sf_dir).select("team", "y").distinct()
    return (seasons
            .filter(~((F.col("team") == MISSING_LOGO[0]) & (y == MISSING_LOGO[1])))
            .join(F.broadcast(_read(spark, sf_dir, "nation").select("n_nationkey", "n_name")),
                  F.col("team") == F.col("n_nationkey"))
            .select(F.concat(F.col("n_name"), F.when(y < ERA_SPLIT_YEAR, F.lit(" A"))
                             .otherwise(F.lit(" B"))).alias("team"),
                    y.cast("int").alias("year"),
                    F.concat(F.lit("logos/"), F.col("team").cast("string"), F.lit("_"),
                             y.cast("string"), F.lit(".svg")).alias("logo")))


def excluded_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Void games of the fixture: every order of which ``VOID_GAMES`` divides the key."""
    o = F.col("o_orderkey")
    return _read(spark, sf_dir, "orders").filter(o % VOID_GAMES == 0).select(F.lpad(o.cast("string"), 10, "0").alias("game_id"))


def name_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Display names of the fixture's own, for players whom the curated list does not name."""
    s = F.col("s_suppkey")
    return _read(spark, sf_dir, "supplier").filter(s % KNOWN_AS[0] == KNOWN_AS[1]) \
        .select(s.alias("player_id"), F.concat(F.lit("Known as "), s.cast("string")).alias("name_override"))


class _LazyRaw(dict):
    """Raw fixture tables, each built on first access."""

    _BUILDERS = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = _memo((id(self.spark), self.sf_dir, "raw", name),
                   lambda: self._BUILDERS[name](self.spark, self.sf_dir))
        self[name] = df
        return df


_LazyRaw._BUILDERS = {
    "bios": raw_bios,
    "player_boxscores": raw_player_boxscores,
    "team_boxscores": raw_team_boxscores,
    "team_logos": team_logos,
    "excluded_games": excluded_games,
    "name_overrides": name_overrides,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _LazyRaw(spark, sf_dir)
