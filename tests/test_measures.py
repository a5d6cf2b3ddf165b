"""Measure scopes: team scope over team keys, league cross product, cutoff and floor."""

from pyspark.sql import functions as F

from courtline.operators import measures


def facts_frames(spark):
    # player 1: 1997 (pre-cutoff) and 1998, traded in 1998 between teams 1 and 2
    pf = spark.createDataFrame(
        [(1, 1997, 1, "1997|1|1", 30, 10, 8, 2, 4, 2, 5, 3, 6, 1, 1, 2, 3, 20),
         (1, 1998, 1, "1998|1|1", 30, 10, 8, 2, 4, 2, 5, 3, 6, 1, 1, 2, 3, 20),
         (1, 1998, 1, "1998|1|2", 20, 4, 9, 1, 3, 1, 2, 2, 4, 2, 0, 1, 2, 9)],
        "player_id long, year int, season_type_key int, year_type_team_key string, "
        "min long, fgm long, fga long, fg3m long, fg3a long, ftm long, fta long, oreb long, "
        "dreb long, ast long, stl long, blk long, tov long, pts long")
    pf = pf.withColumns({"reb": F.col("oreb") + F.col("dreb"), "pf": F.lit(2)})
    rows = []
    for key, team, year in [("1997|1|1", 1, 1997), ("1998|1|1", 1, 1998), ("1998|1|1", 1, 1998),
                            ("1998|1|2", 2, 1998), ("1998|1|3", 3, 1998)]:
        rows.append((key, team, year, 1, 240, 40, 85, 8, 22, 18, 24, 10, 33, 43, 25, 8, 5, 14,
                     20, 106, 38, 84, 7, 20, 15, 21, 11, 32, 43, 22, 7, 4, 15, 19, 98))
    cols = ("year_type_team_key string, team_id long, year int, season_type_key int, min long, "
            "fgm long, fga long, fg3m long, fg3a long, ftm long, fta long, oreb long, dreb long, "
            "reb long, ast long, stl long, blk long, tov long, pf long, pts long, opp_fgm long, "
            "opp_fga long, opp_fg3m long, opp_fg3a long, opp_ftm long, opp_fta long, "
            "opp_oreb long, opp_dreb long, opp_reb long, opp_ast long, opp_stl long, "
            "opp_blk long, opp_tov long, opp_pf long, opp_pts long")
    tf = spark.createDataFrame(rows, cols)
    return pf, tf


def test_team_scope_counts_all_games_of_each_team_key(spark):
    pf, tf = facts_frames(spark)
    t = measures.team_scope(pf, tf, ["player_id", "year"]).collect()
    got = {r.year: r.tm_gp for r in t}
    assert got == {1997: 1, 1998: 3}   # 2 games of team 1 + 1 of team 2 in 1998


def test_cutoff_and_floor(spark):
    pf, tf = facts_frames(spark)
    rows = {r.year: r for r in measures.per_frame(pf, tf, ["player_id", "year"], cutoff=1998,
                                                  mpg_floor=0.0).collect()}
    assert rows[1997].u_per is None and rows[1997].per is None
    assert rows[1998].u_per is not None and rows[1998].per is not None
    # floor counts team games from every season (4), minutes only from 1998 (50)
    high = measures.per_frame(pf, tf, ["player_id"], cutoff=1998, mpg_floor=12.6).collect()[0]
    low = measures.per_frame(pf, tf, ["player_id"], cutoff=1998, mpg_floor=12.4).collect()[0]
    assert high.per is None and low.per is not None


def test_lga_per_is_league_as_one_player(spark):
    pf, tf = facts_frames(spark)
    r = measures.per_frame(pf, tf, ["player_id", "year"], cutoff=1998).filter("year = 1998") \
        .collect()[0]
    assert r.lga_per is not None and r.lga_per > 0


def test_blank_arithmetic(spark):
    df = spark.createDataFrame([(None, None), (None, 2.0), (3.0, 2.0)], "a double, b double")
    got = [tuple(x) for x in df.select(measures.b_add(F.col("a"), F.col("b")),
                                       measures.divide(F.col("b"), F.col("a"))).collect()]
    assert got == [(None, None), (2.0, None), (5.0, 2.0 / 3.0)]


def test_latest_value_ambiguous_is_null(spark):
    ev = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 3, "c"), (2, 1, "z")],
                               "u long, t long, v string")
    got = {r.u: r.v for r in measures.latest_value(ev, "u", "t", "v").collect()}
    assert got == {1: None, 2: "z"}
