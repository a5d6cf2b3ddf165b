"""What keeps the work in proportion to the input: what is shuffled, what is written and what is computed twice."""

import os
import re

import __spark_entry__ as entry
from courtline.operators import facts, measures
from courtline.plans import catalog
from courtline.plans.model import write_model
from courtline.sources.warehouse import Transaction
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_facts_keep_to_the_buckets_of_the_game(spark):
    m = catalog.model(spark, SF_SMALL)
    m["team_boxscores"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as large tables are joined
    try:
        rolled = _plan(facts.rollup_reconstruct(m["player_boxscores"]))
        team = _plan(facts.team_fact(facts.team_base(m["v_team"]), m["team_boxscores_agg"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in rolled
    assert team.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in team  # of the void games alone


def test_box_scores_are_not_written_as_text_to_build_the_model(spark):
    m = catalog.model(spark, SF_SMALL)
    m["team_boxscores"]
    lines = m.store.path("fixture_player_lines")
    assert os.path.isdir(lines) and not os.path.isdir(m.store.path("raw_team_boxscores"))
    team = _plan(m.raw["team_boxscores"])
    assert "Exchange hashpartitioning(o" not in team  # summed where the lines of an order lie


def test_seasons_are_written_without_a_shuffle(spark, tmp_root, monkeypatch):
    raw, plans, write = catalog.raw_layer(spark, SF_SMALL), {}, Transaction.write
    monkeypatch.setattr(Transaction, "write", lambda self, layer, name, df, *a: plans.update({name: _plan(df)}) or write(self, layer, name, df, *a))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write_model(spark, {n: raw[n] for n in raw}, tmp_root)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("team_rows", "player_boxscores", "team_boxscores_base", "team_boxscores_agg_team_only", "team_boxscores_agg", "team_boxscores"):
        assert "Exchange" not in plans[name], name
    # the buckets they were built in are gone
    assert not os.listdir(f"{tmp_root}/_work") and not [t.name for t in spark.catalog.listTables() if "_work_" in t.name]


def test_sets_of_a_player_are_taken_from_the_finest_grain(spark):
    sums = spark.createDataFrame([(1, 1998, 1, f"k{i}", *([1] * 16)) for i in range(3)] + [(1, 1997, 2, "k9", *([5] * 16))],
                                 "player_id long, year int, season_type_key int, year_type_team_key string, "
                                 + ", ".join(f"{c} int" for c in measures.STATS16))
    sums = sums.withColumns({c: measures.F.col(c).cast("decimal(20,0)") for c in measures.STATS16})
    keys = spark.createDataFrame([("k0", 2), ("k1", 3), ("k9", 7)], "year_type_team_key string, tm_gp long")
    keys = keys.select("*", *[measures.F.lit(1).cast("decimal(20,0)").alias(c) for c in measures.TEAM_COLS])
    out = measures.player_scopes(sums, keys, 1998)
    plan = _plan(out)
    assert plan.index("Expand") < plan.rindex("HashAggregate(keys=[player_id")  # expanded rows are those of the finest grain
    career = out.filter("_g = 3").collect()[0]
    assert (sorted(career["_years"]), sorted(career["_types"]), career["p_pts"], career["tm_gp"], career["floor_gp"]) == ([1998], [1], 3, 5, 12)


def test_load_files_are_compressed_and_of_bounded_length(spark, tmp_root, monkeypatch):
    from courtline.schemas import RAW_SCHEMAS
    from courtline.sources import loading
    monkeypatch.setattr(loading, "LINES_PER_FILE", 2)
    names = RAW_SCHEMAS["team_boxscores"].fieldNames()
    line = ",".join({"TEAM_ID": "1", "GAME_ID": "0001", "PTS": "x"}.get(c, "") for c in names)
    rows = spark.createDataFrame([(line,)] * 5, "line string").coalesce(1)
    files = loading.write_lines(rows, "line", f"{tmp_root}/files", "team_boxscores")
    assert len([f for f in os.listdir(files) if f.endswith(".csv.gz")]) == 3
    got = loading.load(spark, files, "team_boxscores", f"{tmp_root}/loaded")
    assert got.counts == {"lines": 5, "rows": 0, "rejected_lines": 5, "rejects": 5}
    assert {(r.column, r.value) for r in got.rejects.collect()} == {("PTS", "x")}


def test_pace_takes_every_game(spark):
    m = catalog.model(spark, SF_SMALL)
    games = lambda name: m[name].agg({"games": "sum"}).first()[0]
    void = m["v_team"].join(m["excluded_games"], "game_id", "left_semi").select("game_id").distinct().count()
    assert void > 0 and games("whole_team_sums") > games("team_sums")
    assert "o_orderkey % 211" not in entry.oracle_sql()["pace"]


def test_tables_by_year_are_written_once_where_they_are_kept(spark, tmp_root):
    raw = catalog.raw_layer(spark, SF_SMALL)
    write_model(spark, {n: raw[n] for n in raw}, tmp_root)
    for name in ("team_rows", "player_boxscores", "team_boxscores_base", "team_boxscores_agg_team_only", "team_boxscores_agg"):
        versions = os.listdir(f"{tmp_root}/model/{name}")
        files = [f for y in os.listdir(f"{tmp_root}/model/{name}/{versions[0]}") if y.startswith("year=")
                 for f in os.listdir(f"{tmp_root}/model/{name}/{versions[0]}/{y}") if f.endswith(".parquet")]
        # the files are those of the buckets in which the next table was built, not copies of them
        assert len(versions) == 1 and files and all(re.search(r"_\d{5}\.c\d+\.", f) for f in files), name


def test_a_task_writes_one_season_after_another(spark, tmp_root, monkeypatch):
    from courtline.plans.store import TableStore
    plans, write = {}, TableStore._bucketed
    monkeypatch.setattr(TableStore, "_bucketed", lambda self, w, name, *a: plans.update({name: _plan(w._df)}) or write(self, w, name, *a))
    raw = catalog.raw_layer(spark, SF_SMALL)
    write_model(spark, {n: raw[n] for n in raw}, tmp_root)
    by_year = [n for n in plans if n.startswith(("team_", "player_"))]
    assert len(by_year) == 5 and all("Sort [year#" in plans[n] for n in by_year)


def test_totals_of_a_game_stay_longs(spark):
    rows = spark.createDataFrame([(1, "0001", 9_999_999_999, None), (1, "0001", 9_999_999_999, None), (2, "0001", None, 3)],
                                 "team_id long, game_id string, pts long, stl long")
    rows = rows.select("team_id", "game_id", *[measures.F.col(c).cast("decimal(10,0)") for c in ("pts", "stl")])
    out = facts.rollup_reconstruct(rows, stats=["pts", "stl"])
    assert dict(out.dtypes)["pts"] == dict(out.dtypes)["stl"] == "decimal(18,0)"
    assert "sum(pts" not in _plan(out) and "bigint" in _plan(out)
    assert {tuple(r) for r in out.collect()} == {(1, "0001", 19_999_999_998, None), (2, "0001", None, 3)}
