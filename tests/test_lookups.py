"""Curated lookups merged by key, with a report of what a load does."""

from pyspark.sql import functions as F

from courtline.plans import refresh
from courtline.sources.lookups import merged_by_key, write_team_logos
from courtline.sources.raw import read_table, write_table
from courtline.sources.warehouse import Warehouse

SCHEMA = "team string, year int, logo string"


def test_every_key_has_one_action(spark):
    current = spark.createDataFrame([("A", 1, "a"), ("B", 1, "b"), ("C", 1, "c"), (None, 2, "n"), ("D", 1, None)], SCHEMA)
    load = spark.createDataFrame([("A", 1, "a"), ("A", 1, "a"), ("B", 1, "b2"), ("E", 1, "e"), ("F", 1, "x"), ("F", 1, "y"), ("D", 1, None),
                                  (None, 2, "n2"), ("C", 1, "p"), ("C", 1, None)], SCHEMA)
    got = {(r.team, r.year): (r.action, r.logo, r.times, r.held) for r in merged_by_key(current, load, ["team", "year"]).collect()}
    assert got == {("A", 1): ("unchanged", "a", 2, True), ("B", 1): ("update", "b2", 1, True), ("E", 1): ("insert", "e", 1, True),
                   ("F", 1): ("conflict", None, 2, False), ("D", 1): ("unchanged", None, 1, True), (None, 2): ("update", "n2", 1, True),
                   ("C", 1): ("conflict", "c", 2, True)}


def test_replaying_a_logo_file_changes_nothing(spark, tmp_root):
    write_table(spark.createDataFrame([("A", 1, "a"), ("B", 1, "b")], SCHEMA), tmp_root, "model", "team_logos_by_year")
    files = write_team_logos(spark.createDataFrame([("B", 1, "b, 2"), ("C", 2, "c")], SCHEMA), f"{tmp_root}/files")
    first = refresh.upsert_logos(spark, tmp_root, files)
    assert {r.team: r.action for r in first.collect()} == {"A": "kept", "B": "update", "C": "insert"}
    table = lambda: {tuple(r) for r in read_table(spark, tmp_root, "model", "team_logos_by_year").collect()}
    assert table() == {("A", 1, "a"), ("B", 1, "b, 2"), ("C", 2, "c")}
    before = Warehouse(spark, tmp_root).snapshot().tables["model/team_logos_by_year"]
    again = refresh.upsert_logos(spark, tmp_root, files)
    assert again.filter(F.col("action").isin("insert", "update")).isEmpty()
    assert Warehouse(spark, tmp_root).snapshot().tables["model/team_logos_by_year"] == before
