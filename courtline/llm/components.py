"""Connected components of a link table: union-find inside each partition, then star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.shared import saved


def _union_find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of one partition as a star per group; the smallest id is the root."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for b in batches:
        for u, v in zip(b["u"].tolist(), b["v"].tolist()):
            a, c = root(u), root(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
    ids = list(parent)
    yield pd.DataFrame({"u": ids, "v": [root(x) for x in ids]}, dtype="int64")


def components(links: DataFrame, tag: str = "components") -> DataFrame:
    """``(u, v)`` links -> ``(id, component)``, component the smallest id reachable; ids with a link only.

    A partition's links first shrink to stars by union-find, so at most one row per id and task is
    left.  Then large-star and small-star rounds move every id to the smallest one it can see; each
    round is written, and rounds end when one changes nothing.  Null ids and loops are left out.
    """
    links = links.select(F.col("u").cast("long"), F.col("v").cast("long")) \
        .filter("u is not null and v is not null and u <> v")
    edges = links.mapInPandas(_union_find, "u long, v long").filter("u <> v").distinct()
    edges = saved(edges, tag)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(small, "u")
        following = saved(star.select("u", F.col("m").alias("v")).union(
            star.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), tag)
        changed = following.join(edges, ["u", "v"], "left_anti").limit(1).count() \
            or edges.join(following, ["u", "v"], "left_anti").limit(1).count()
        edges = following
        if not changed:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
