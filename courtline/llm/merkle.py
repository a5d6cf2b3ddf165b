"""Merkle manifest of a table of documents by slot pivots (operator 12).

Each row is a leaf.  Per language the leaves are numbered by doc_id, and every ``FANOUT`` consecutive nodes have a
parent: a conditional aggregate per slot spreads the children of a parent into ``FANOUT`` columns, whose
concatenation is hashed.  Levels follow until one node of a language is left, its subroot; the subroots, numbered by
language, give the root in the same way.  Going down again, a child's siblings are the slot columns without
its own one, so a proof is gathered from the stored pivots: no level is larger than an eighth of the one below.

Numbers need no single task: rows are dealt by ranges of the order and numbered inside their range, and the sizes
of the ranges are summed to offsets (a row per range and language).  So a language may hold any share of all rows.

``verified`` folds a proof again from the leaf of the row as it is found, tampered with or not.

Order: languages with null first, then by their bytes; in a language doc_id with null first, then the leaf.  Defined
cases: a null column is ``-`` in a leaf, so a null text differs from an empty one; rows with one doc_id, repeated rows
too, are leaves each, next to each other; a row without a doc_id is never tampered with; texts are hashed whole;
an empty table has no leaves and gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtline.llm.shared import saved

FANOUT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SLOTS = [f"s{k}" for k in range(FANOUT)]
PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A field of a leaf: its size in bytes, a colon and the value; a null one is a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(**fields: Column) -> Column:
    return F.sha2(F.concat(*(field(fields[c]) for c in FIELDS)), 256)


def tampered_text() -> Column:
    """The text as a tampering hand leaves it: lower-cased where 3 divides the crc32 of the doc_id."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))


def leaves(docs: DataFrame) -> DataFrame:
    """Per row: the key of its language, doc_id, its leaf, and its leaf after tampering."""
    own = {c: F.col(c) for c in FIELDS}
    return docs.select(*FIELDS).select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_of(**own).alias("hash"), leaf_of(**{**own, "text": tampered_text()}).alias("found"))


def numbered(rows: DataFrame, order: list[str], tag: str) -> DataFrame:
    """``rows`` with ``idx``, the place from 0 within ``tree`` by ``order``, and ``n``, the rows of the tree."""
    ranged = rows.repartitionByRange("tree", *order).withColumn("range", F.spark_partition_id())
    inside = Window.partitionBy("range", "tree").orderBy(*order)
    ranged = saved(ranged.withColumn("place", F.row_number().over(inside) - 1), tag)
    sizes = ranged.groupBy("tree", "range").agg(F.count("*").alias("rows"))
    by_tree = Window.partitionBy("tree")
    offsets = sizes.select("tree", "range", F.sum("rows").over(by_tree).alias("n"),
                           (F.sum("rows").over(by_tree.orderBy("range")) - F.col("rows")).alias("before"))
    return ranged.join(offsets, ["tree", "range"]).withColumn("idx", F.col("before") + F.col("place")).drop("range", "place", "before")


def parents(nodes: DataFrame) -> DataFrame:
    """The pivot: a row per parent of ``nodes`` (tree, idx, n, hash) with its children in the slot columns."""
    slot = F.col("idx") % FANOUT
    spread = [F.max(F.when(slot == k, F.col("hash"))).alias(s) for k, s in enumerate(_SLOTS)]
    up = nodes.filter("n > 1").groupBy("tree", F.expr(f"idx div {FANOUT}").alias("idx")).agg(F.max("n").alias("below"), *spread)
    return up.select("tree", "idx", F.expr(f"(below + {FANOUT - 1}) div {FANOUT}").alias("n"), *_SLOTS,
                     F.sha2(F.concat(*(F.coalesce(s, F.lit("")) for s in _SLOTS)), 256).alias("hash"))


def build(nodes: DataFrame, tag: str) -> list[DataFrame]:
    """``nodes`` and the levels above them, each stored, up to where every tree has one node."""
    levels, most = [nodes], nodes.agg(F.max("n").alias("n")).first()["n"] or 0
    while most > 1:
        levels.append(saved(parents(levels[-1]), f"{tag}-level-{len(levels)}"))
        most = -(-most // FANOUT)
    return levels


def tops(levels: list[DataFrame]) -> DataFrame:
    """The last node of each tree, at whatever level."""
    return reduce(DataFrame.unionByName, [x.filter("n = 1").select("tree", "hash") for x in levels])


def _joined(slots: list[str]) -> Column:
    return F.concat(*(F.coalesce(s, F.lit("")) for s in slots)) if slots else F.lit("")


def paths(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest nodes with the siblings on their way up, level by level, and what ``above`` has for their tree.

    ``above``: tree, path (from the top of the tree on) and columns to be carried down.  A node meets the pivot of its
    parent, which has its siblings and the parent's own path.
    """
    carried = [c for c in above.columns if c != "tree"]
    spread = [f"up_{s}" for s in _SLOTS]
    own_slot = (F.col("idx") % FANOUT).cast("int") + 1
    siblings = F.element_at(F.array(*(F.struct(_joined(spread[:j]).alias("left"), _joined(spread[j + 1:]).alias("right"))
                                      for j in range(FANOUT))), own_slot)
    down = None
    for level in reversed(levels):
        here = level.filter("n = 1").join(above, "tree")
        if down is not None:
            up = down.select("tree", F.col("idx").alias("parent"), *carried, *(F.col(s).alias(u) for s, u in zip(_SLOTS, spread)))
            inner = level.filter("n > 1").withColumn("parent", F.expr(f"idx div {FANOUT}")).join(up, ["tree", "parent"])
            inner = inner.withColumn("path", F.concat(F.array(siblings), F.col("path"))).drop("parent", *spread)
            here = here.unionByName(inner)
        down = here
    return down


def manifest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and the proof's ``path``.

    ``path`` has, from the leaf on, the hashes of the siblings left and right of each node on the way up.
    """
    levels = build(saved(numbered(saved(leaves(docs), "leaves"), ["doc_id", "hash"], "ordered-leaves"), "numbered-leaves"), "leaves")
    subroots = tops(levels).withColumnRenamed("tree", "key").withColumn("tree", F.lit("all"))
    top = build(saved(numbered(saved(subroots, "subroots"), ["key"], "ordered-subroots"), "numbered-subroots"), "subroots")
    root = tops(top).select("tree", F.array().cast(PATH).alias("path"), F.col("hash").alias("root"))
    above = saved(paths(top, root).select(F.col("key").alias("tree"), "path", F.col("hash").alias("subroot"), "root"), "ways-of-subroots")
    rows = paths(levels, above)
    siblings = F.concat_ws("", F.transform("path", lambda x: F.concat(x["left"], x["right"])))
    folded = F.aggregate("path", F.col("found"), lambda acc, x: F.sha2(F.concat(x["left"], acc, x["right"]), 256))
    return rows.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                       folded.alias("folded_root"), "path").withColumn("verified", F.col("folded_root") == F.col("root"))


def proofs(docs: DataFrame) -> DataFrame:
    return manifest(docs).drop("path")
