"""Schemas, tables and views under names of Spark's catalog."""

import pytest

from courtline.operators.staging import stage_bios, stage_team_boxscores
from courtline.plans.layers import Layers
from courtline.sources import testdata
from tests.conftest import SF_SMALL


def test_layers_are_created_once_and_dropped_in_reverse(spark, tmp_root):
    raw, calls = testdata.raw_tables(spark, SF_SMALL), []
    layers = Layers(spark, tmp_root, "courtline_test")
    build = lambda t: lambda: calls.append(t) or raw[t]
    layers.create_schemas()
    layers.create_schemas()
    for _ in range(2):  # the second build is skipped
        made = [layers.create_table("raw", t, build(t)) for t in ("bios", "team_boxscores")]
        made += [layers.create_view(t) for t in ("bios", "team_boxscores")]
        made.append(layers.create_table("model", "games", lambda: spark.sql(
            f"SELECT DISTINCT game_id FROM {layers.name('staging', 'v_team_boxscores')}")))
        assert made == [len(calls) == 2 and _ == 0] * 5
    assert calls == ["bios", "team_boxscores"]
    assert layers.tables() == ["raw.bios", "raw.team_boxscores", "staging.v_bios", "staging.v_team_boxscores", "model.games"]
    for view, stage, table in (("v_bios", stage_bios, "bios"), ("v_team_boxscores", stage_team_boxscores, "team_boxscores")):
        shown, want = layers.table("staging", view), stage(raw[table])
        assert shown.dtypes == want.dtypes
        assert sorted(map(repr, shown.collect())) == sorted(map(repr, want.collect()))
    # a view shows what its raw table holds now
    n = layers.table("staging", "v_bios").count()
    raw["bios"].limit(1).write.insertInto(layers.name("raw", "bios"))
    assert layers.table("staging", "v_bios").count() == n + 1
    layers.drop()
    assert layers.tables() == []
    with pytest.raises(Exception):
        layers.table("staging", "v_bios")
