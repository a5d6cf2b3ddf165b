"""The bucketed percent rank equals SQL PERCENT_RANK (ASC, NULLS LAST) exactly."""

import random

import pytest

from courtline.operators.windows import bucketed_percent_rank, percent_rank_window


def _frame(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(3000):
        # one hot period holding a third of the rows, many small ones, a singleton
        p = 0 if i % 3 == 0 else rnd.randint(1, 12)
        v = rnd.choice([None, float(rnd.randint(0, 40)), rnd.random() * 10])
        rows.append((i, p, v))
    rows.append((9999, 99, 1.0))
    rows.append((10000, 98, None))
    return spark.createDataFrame(rows, "id long, p int, v double")


@pytest.mark.parametrize("buckets", [1, 4, 16])
def test_matches_window(spark, buckets):
    df = _frame(spark, buckets)
    a = {r.id: r.pr for r in bucketed_percent_rank(df, ["p"], "v", "pr", buckets, 100.0).collect()}
    b = {r.id: r.pr for r in percent_rank_window(df, ["p"], "v", "pr", 100.0).collect()}
    assert a.keys() == b.keys()
    assert all(a[k] == b[k] for k in a), [(k, a[k], b[k]) for k in a if a[k] != b[k]][:5]


def test_all_null_partition_ranks_zero(spark):
    df = spark.createDataFrame([(1, 1, None), (2, 1, None), (3, 2, 5.0), (4, 2, None)],
                               "id long, p int, v double")
    got = {r.id: r.pr for r in bucketed_percent_rank(df, ["p"], "v", "pr").collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 0.0, 4: 1.0}
