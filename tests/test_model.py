"""Hand-made edge rows through staging, facts, derived tables and checks."""

import pytest
from pyspark.sql import functions as F

from courtline.operators import checks, derived, dims, facts
from courtline.operators.staging import stage_all
from courtline.schemas import RAW_BIOS_COLUMNS, RAW_PLAYER_COLUMNS, RAW_TEAM_COLUMNS, STATS16
from courtline.sources import lookups


def raw_df(spark, columns, rows):
    data = [tuple(r.get(c, "") for c in columns) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in columns))


def stat_row(vals=None, **kw):
    base = {c.upper(): "1" for c in STATS16}
    base.update({k.upper(): ("" if v is None else str(v)) for k, v in (vals or {}).items()})
    base.update(kw)
    return base


def game(gid, date, season, team, opp, home=True, stype="Regular Season", **stats):
    m = f"T{team} vs. T{opp}" if home else f"T{team} @ T{opp}"
    return stat_row(stats, GAME_ID=gid, GAME_DATE=date, Season=season, SeasonType=stype,
                    TEAM_ID=str(team), TEAM_ABBREVIATION=f"T{team}", TEAM_NAME=f"Team {team}",
                    MATCHUP=m, WL="W")


def bio(pid, name="P", birth="1980-01-01", country="USA", height="6-6", weight="200",
        to_year="2001"):
    return {"PLAYER_ID": str(pid), "PERSON_ID": str(pid), "DISPLAY_FIRST_LAST": name,
            "FIRST_NAME": name, "LAST_NAME": name, "BIRTHDATE": birth, "COUNTRY": country,
            "HEIGHT": height, "WEIGHT": weight, "FROM_YEAR": "1995", "TO_YEAR": to_year}


def build(spark, bios, players, teams):
    raw = {"bios": raw_df(spark, RAW_BIOS_COLUMNS, bios),
           "player_boxscores": raw_df(spark, RAW_PLAYER_COLUMNS, players),
           "team_boxscores": raw_df(spark, RAW_TEAM_COLUMNS, teams)}
    return stage_all(raw)


def test_three_team_game_fans_out_and_parity_reports_it(spark):
    teams = [game("001", "2000-01-01", "1999-00", t, 0) for t in (1, 2, 3)]
    players = [dict(game("001", "2000-01-01", "1999-00", 1, 2), PLAYER_ID="10")]
    stg = build(spark, [bio(10)], players, teams)
    pf = facts.player_fact(stg["player"], stg["bios"], stg["team"])
    assert sorted(r.opponent_id for r in pf.collect()) == [2, 3]
    parity = {r.source: r.n for r in checks.self_join_parity(stg["team"]).collect()}
    assert parity == {"opponent_join": 6, "v_team_boxscores": 3}


def test_one_sided_game_drops_and_missing_bio_drops(spark):
    teams = [game("001", "2000-01-01", "1999-00", 1, 2), game("001", "2000-01-01", "1999-00", 2, 1),
             game("002", "2000-01-02", "1999-00", 1, 2)]
    players = [dict(game("001", "2000-01-01", "1999-00", 1, 2), PLAYER_ID="10"),
               dict(game("002", "2000-01-02", "1999-00", 1, 2), PLAYER_ID="10"),
               dict(game("001", "2000-01-01", "1999-00", 2, 1), PLAYER_ID="11")]
    stg = build(spark, [bio(10)], players, teams)
    pf = facts.player_fact(stg["player"], stg["bios"], stg["team"])
    assert [(r.player_id, r.game_id) for r in pf.collect()] == [(10, "001")]
    assert [r.player_id for r in checks.orphan_players(stg["player"], stg["bios"]).collect()] == [11]


def test_backfill_never_overwrites_and_null_sums_stay_null(spark):
    # base: oreb missing, reb 40; players: oreb 5 + 7 = 12, reb 20 + 21 = 41; stl never recorded
    t1 = game("001", "2000-01-01", "1999-00", 1, 2, oreb=None, reb=40, stl=None)
    t2 = game("001", "2000-01-01", "1999-00", 2, 1)
    p1 = dict(game("001", "2000-01-01", "1999-00", 1, 2, oreb=5, reb=20, stl=None), PLAYER_ID="10")
    p2 = dict(game("001", "2000-01-01", "1999-00", 1, 2, oreb=7, reb=21, stl=None), PLAYER_ID="11")
    p3 = dict(game("001", "2000-01-01", "1999-00", 2, 1), PLAYER_ID="12")
    stg = build(spark, [bio(10), bio(11), bio(12)], [p1, p2, p3], [t1, t2])
    built = facts.build_facts(stg)
    only = {r.team_id: r for r in built["team_boxscores_agg_team_only"].collect()}
    assert only[1].stl is None and int(only[1].oreb) == 12
    tf = {r.team_id: r for r in built["team_boxscores"].collect()}
    assert int(tf[1].oreb) == 12 and int(tf[1].reb) == 40 and tf[1].stl is None
    # opponent property: opp_x(t) = x(o)
    assert int(tf[2].opp_oreb) == 12 and int(tf[2].opp_reb) == 40


def test_cancelled_game_is_excluded_from_team_base_only(spark):
    teams = [game("0021201214", "2013-04-16", "2012-13", 1, 2),
             game("0021201214", "2013-04-16", "2012-13", 2, 1)]
    players = [dict(game("0021201214", "2013-04-16", "2012-13", 1, 2), PLAYER_ID="10")]
    stg = build(spark, [bio(10)], players, teams)
    assert facts.team_base(stg["team"]).count() == 0
    assert facts.player_fact(stg["player"], stg["bios"], stg["team"]).count() == 1


def test_signature_tie_goes_to_lower_team_id(spark):
    w = spark.createDataFrame(
        [(1, 20, "B", "b.svg", 10), (1, 10, "A", "a.svg", 10), (2, 10, "A", "a1.svg", 3),
         (2, 10, "A", "a2.svg", 5), (2, 20, "B", "b.svg", 7)],
        "player_id long, team_id long, team_name string, logo string, impact long")
    got = {r.player_id: (r.team_id, r.logo)
           for r in derived.signature_category(w, "player_id", "team_id",
                                               ["team_name", "logo"], "impact").collect()}
    # player 2: team 10 totals 8 > 7, and within it the 5-impact logo wins
    assert got == {1: (10, "a.svg"), 2: (10, "a2.svg")}


def test_percentiles_rank_nulls_highest(spark):
    rates = spark.createDataFrame(
        [(1, 2000, 1.0), (2, 2000, 2.0), (3, 2000, None), (4, 2001, None), (5, 2001, None)],
        "player_id long, year int, v double")
    prof = derived.percentile_profile(rates, axes=[("v", "v")])
    got = {r.player_id: r.v_pctl for r in prof.collect()}
    assert got == {1: 0.0, 2: 50.0, 3: 100.0, 4: 0.0, 5: 0.0}


def test_player_dim_units_and_overrides(spark):
    stg = build(spark, [bio(120, name="Steve X", height="6-7", weight="220", country="Atlantis")],
                [], [])
    sig = spark.createDataFrame([], "player_id long, main_team_id long, main_team_name string, "
                                    "main_logo string")
    prof = spark.createDataFrame([], "player_id long, pts_pctl double, fg2m_pctl double, "
                                     "fg3m_pctl double, ts_pctl double, ast_pctl double, "
                                     "reb_pctl double, stl_pctl double, blk_pctl double")
    dp = derived.player_dim(stg["bios"], lookups.country_codes(spark),
                            lookups.name_overrides(spark), sig, prof).collect()[0]
    assert (dp.player_name, dp.height_cm, dp.weight_kg, dp.country_flag) == \
        ("Steve Smith", 201, 100, None)


def test_duplicate_lookup_is_rejected(spark):
    cc = lookups.country_codes(spark)
    with pytest.raises(ValueError):
        lookups.assert_unique(cc.unionByName(cc.limit(1)), ["country"], "country_codes")


def test_dim_teams_and_missing_logo(spark):
    teams = [game("001", "2000-01-01", "1999-00", 1, 2), game("001", "2000-01-01", "1999-00", 2, 1)]
    stg = build(spark, [], [], teams)
    logos = spark.createDataFrame([("Team 1", 1999, "l1.svg")], "team string, year int, logo string")
    dt = dims.dim_teams(stg["team"], logos).collect()
    assert [(r.team_id, r.team_year_key, r.logo_by_year) for r in dt] == [(1, "1|1999", "l1.svg")]
    miss = checks.missing_logos(stg["team"], logos).collect()
    assert [(r.team_name, r.year) for r in miss] == [("Team 2", 1999)]


def test_repeated_lookup_row_fans_out_and_dup_check_reports_it(spark):
    stg = build(spark, [bio(1, country="France"), bio(2, country="USA")], [], [])
    cc = lookups.country_codes(spark)
    doubled = cc.unionByName(cc.filter(F.col("country") == "France"))
    sig = spark.createDataFrame([], "player_id long, main_team_id long, main_team_name string, "
                                    "main_logo string")
    prof = spark.createDataFrame([], "player_id long, pts_pctl double, fg2m_pctl double, "
                                     "fg3m_pctl double, ts_pctl double, ast_pctl double, "
                                     "reb_pctl double, stl_pctl double, blk_pctl double")
    dp = derived.player_dim(stg["bios"], doubled, lookups.name_overrides(spark), sig, prof)
    dups = checks.dup_dim_players(dp).collect()
    assert [(r.player_id, r["count"]) for r in dups] == [(1, 2)]
    parity = {r.source: r.n for r in checks.dim_parity(dp, stg["bios"]).collect()}
    assert parity == {"dim_players": 3, "v_bios": 2}
