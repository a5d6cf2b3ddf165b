"""Exact percent rank that does not put a crowded partition into one task.

``percent_rank() OVER (PARTITION BY p ORDER BY v)`` sorts each partition in a single
task: if one period holds a third of all rows, that task holds a third of the data.
Here the rows are first counted per (partition, value), map-side, so ties and NULLs are one
row however many there are.  The distinct values of a partition are cut into ranges by approximate
quantiles (``percentile_approx``); counts are summed up inside their range, the counts of
the lower ranges are added, and the rank of a value is joined back to its rows.  The result is
the exact SQL ``PERCENT_RANK`` with ascending order and NULLs last: (number of smaller values) /
(partition rows - 1), and 0 for a one-row partition.  The quantiles only decide how the work is
split, never the answer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKETS = 16


def _null_safe_join(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """An inner join in which NULL equals NULL; the columns are the left ones."""
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in columns})
    same = [left[c].eqNullSafe(right[f"_r_{c}"]) for c in columns]
    return left.join(right, same).drop(*[f"_r_{c}" for c in columns])


def bucketed_percent_rank(df: DataFrame, partition_cols: list[str], value_col: str,
                          out_col: str, num_buckets: int = DEFAULT_BUCKETS,
                          scale: float = 1.0) -> DataFrame:
    """Append ``out_col`` = PERCENT_RANK of ``value_col`` (ASC, NULLS LAST) * ``scale``."""
    k, parts, v = max(int(num_buckets), 1), list(partition_cols), F.col(value_col)
    values = df.groupBy(*parts, value_col).agg(F.count(F.lit(1)).alias("_rows"))
    bucket = F.when(v.isNull(), F.lit(k)).otherwise(F.lit(0))
    if k > 1:
        bounds = values.groupBy(*parts).agg(F.percentile_approx(v, [i / k for i in range(1, k)]).alias("_bounds"))
        values = _null_safe_join(values, bounds, parts)
        bucket = F.when(v.isNull(), F.lit(k)).otherwise(
            F.coalesce(F.size(F.filter("_bounds", lambda b: b < v)), F.lit(0)))
    values = values.withColumn("_bucket", bucket.cast("int")).drop("_bounds")
    before = lambda by, order: F.coalesce(F.sum("_rows").over(
        Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = values.groupBy(*parts, "_bucket").agg(F.sum("_rows").alias("_rows"))
    ranges = ranges.select(*parts, "_bucket", before(parts, F.col("_bucket")).alias("_lower"),
                           F.sum("_rows").over(Window.partitionBy(*parts)).alias("_n"))
    inside = before([*parts, "_bucket"], v.asc_nulls_last())
    ranked = _null_safe_join(values.withColumn("_inside", inside).drop("_rows"), ranges, [*parts, "_bucket"])
    smaller = (F.col("_lower") + F.col("_inside")).cast("double")
    pr = F.when(F.col("_n") <= 1, F.lit(0.0)).otherwise(smaller / (F.col("_n") - 1))
    ranked = ranked.select(*parts, value_col, (pr * F.lit(scale) if scale != 1.0 else pr).alias(out_col))
    return _null_safe_join(df, ranked, [*parts, value_col])


def percent_rank_window(df: DataFrame, partition_cols: list[str], value_col: str,
                        out_col: str, scale: float = 1.0) -> DataFrame:
    """The plain window form (one sort per partition); for small, even partitions."""
    w = Window.partitionBy(*partition_cols).orderBy(F.col(value_col).asc_nulls_last())
    pr = F.percent_rank().over(w)
    return df.withColumn(out_col, pr * F.lit(scale) if scale != 1.0 else pr)
