"""Plan-shape guards for the scale properties the design relies on."""

import re

import __spark_entry__ as entry
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_query_uses_a_cartesian_or_nested_loop_join(spark):
    bad = {}
    for name, fn in entry.queries().items():
        p = _plan(fn(spark, SF_SMALL))
        hits = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in p]
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_cutoff_prunes_partitions_of_the_facts(spark):
    p = entry.queries()["ts_pct"](spark, SF_SMALL)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PartitionFilters: \[.*year.*>= 1998", p), p[:2000]


def test_percentile_windows_are_split_by_value_bucket(spark):
    from courtline.operators.derived import career_percentiles
    from courtline.plans import catalog
    pf = catalog.model(spark, SF_SMALL)["player_boxscores"]
    p = _plan(career_percentiles(pf))
    windows = re.findall(r"Window \[.*?\], \[([^\]]*)\]", p)
    assert windows and all("_bucket" in w or "_axis" in w for w in windows), windows


def test_signature_picks_are_aggregates_without_windows(spark):
    for name in ("signature_team", "signature_native"):
        from courtline.operators import derived
        from courtline.plans import catalog
        m = catalog.model(spark, SF_SMALL)
        df = derived.signature_team(m["player_boxscores"], m["dim_teams"]) if name == "signature_team" else entry.queries()[name](spark, SF_SMALL)
        assert "Window" not in _plan(df), name


def test_sides_of_a_game_meet_without_an_exchange(spark):
    from courtline.operators import facts
    from courtline.plans import catalog
    m = catalog.model(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as large tables are joined
    try:
        agg = _plan(facts.opponent_join(m["team_boxscores_agg_team_only"], carry=["team_id", "game_id", *facts.STATS16]))
        base = _plan(facts.team_base(m["v_team"]))
        parity = _plan(entry.queries()["opponent_join_native"](spark, SF_SMALL))
        player = _plan(facts.player_fact(m["v_player"], m["v_bios"], m["v_team"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in agg and "SortMergeJoin" in agg
    assert base.count("Exchange hashpartitioning") == 1 and base.count("SortMergeJoin") == 2  # of the void games alone
    assert len(re.findall(r"Exchange hashpartitioning\(game_id", player)) == 1  # the player rows alone
    # one repartition by order serves the sums and both sides (AQE shows it once, and once reused)
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", parity)) == {"l_orderkey"} and "REPARTITION_BY_COL" in parity
    assert "ENSURE_REQUIREMENTS" not in parity


def test_latest_value_reads_its_table_once(spark):
    from courtline.operators.measures import latest_value
    rows = [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("b", 1, "z"), ("c", 3, None), ("c", 2, "x"), (None, 9, "x"), ("d", None, "x"), ("e", 5, "q"), ("e", 5, "q")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    assert {tuple(r) for r in latest_value(df, "k", "t", "v").collect()} == {("a", "y"), ("b", None), ("c", None), ("e", "q")}
    p = _plan(entry.queries()["latest_state_native"](spark, SF_SMALL))
    assert p.count("FileScan") == 1 and "Join" not in p


def test_all_grains_of_per_come_from_one_pass_over_the_sums(spark):
    from courtline.operators import measures
    from courtline.plans import catalog
    m, seen = catalog.model(spark, SF_SMALL), {}

    def keep(name, df):
        seen[name] = _plan(df)
        return m.store.materialize(f"test_{name}", lambda: df)
    out = measures.per_grains(m["player_sums"], m["team_sums"], catalog.FIXTURE_CUTOFF, catalog.FIXTURE_MPG_FLOOR, keep)
    scans = lambda plan: re.findall(r"FileScan parquet [^\n]*", plan)
    sums = lambda plan, mark: [x for x in scans(plan) if mark in x and "_g#" not in x]
    assert len(scans(seen["team_scopes"])) == len(sums(seen["team_scopes"], "games#")) == 1
    assert len(scans(seen["player_scopes"])) == 2 and len(sums(seen["player_scopes"], "player_id#")) == 1  # and the scopes of teams
    assert scans(_plan(out)) and all("_g#" in x for x in scans(_plan(out)))  # stored scopes alone
    assert {r.grain for r in out.select("grain").distinct().collect()} == set(measures.PLAYER_GRAINS.values())
