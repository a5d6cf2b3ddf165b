"""The driver contract: entry runs, every query has an oracle, keys avoid reserved names."""

import __spark_entry__ as entry


def test_entry_runs_on_smoke_data(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[0] == "player_id"
    assert all(0.0 <= (r.pts_pctl or 0.0) <= 100.0 for r in rows)


def test_every_warehouse_query_has_oracle_sql():
    from courtline.plans.catalog import REGISTRY
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(REGISTRY) <= set(sql) <= set(qs)
    assert len(REGISTRY) >= 70
