"""Loads with a reject table: good lines load, every bad cell is listed, the counts add up."""

import os

import pytest

from courtline.operators.staging import typed_staging
from courtline.schemas import BIOS_SPEC, RAW_SCHEMAS
from courtline.sources import loading
from courtline.sources.raw import read_raw_csv

NAMES = RAW_SCHEMAS["bios"].fieldNames()


def line(**cells):
    row = {n: "" for n in NAMES} | {"PLAYER_ID": "7", "FIRST_NAME": "Łuka", "WEIGHT": " 200 ", "BIRTHDATE": "1990-02-28", **cells}
    return ",".join(f'"{v}"' if "," in v else v for v in row.values())


LINES = [
    line(), line(PLAYER_ID="8", SCHOOL="A, B"), line(PLAYER_ID="9", WEIGHT="200.0"), line(PLAYER_ID="10", BIRTHDATE="1990-02-31", WEIGHT="heavy"),
    ",".join(line(PLAYER_ID="11").split(",")[:9]), line(PLAYER_ID="12") + ",more,cells", "", line(PLAYER_ID="", WEIGHT="  "), line(PLAYER_ID="13", WEIGHT="99999999999"),
]


def write(folder, files):
    os.makedirs(folder)
    for name, (header, lines) in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write("\n".join([header, *lines]) + "\n")
    return folder


def test_lines_are_rows_or_rejects(spark, tmp_root):
    header = ",".join(NAMES)
    path = write(f"{tmp_root}/in", {"a.csv": (header, LINES[:5]), "b.csv": (header, LINES[5:]), "c.csv": (header, [])})
    got = loading.load(spark, path, "bios", f"{tmp_root}/out")
    assert got.counts == {"lines": 8, "rows": 3, "rejected_lines": 5, "rejects": 6}
    assert sorted(r.player_id or 0 for r in got.rows.collect()) == [0, 7, 8]
    rejects = got.rejects.collect()
    assert sorted((r.file, r.column or "", r.value or "", r.reason) for r in rejects) == sorted([
        ("a.csv", "WEIGHT", "200.0", "int"), ("a.csv", "WEIGHT", "heavy", "int"), ("a.csv", "BIRTHDATE", "1990-02-31", "date"),
        ("a.csv", "", "", "cells"), ("b.csv", "", "", "cells"), ("b.csv", "WEIGHT", "99999999999", "int")])
    assert {r.line for r in rejects if r.reason == "cells"} == {LINES[4], LINES[5]}
    # what loads is what strict staging makes of the same lines
    good = write(f"{tmp_root}/good", {"a.csv": (header, [LINES[0], LINES[1], LINES[7]])})
    strict = typed_staging(read_raw_csv(spark, good, "bios"), BIOS_SPEC)
    assert got.rows.columns == strict.columns and got.rows.dtypes == strict.dtypes
    assert sorted(map(repr, got.rows.collect())) == sorted(map(repr, strict.collect()))


def test_a_clean_load_and_an_empty_one(spark, tmp_root):
    header = ",".join(NAMES)
    got = loading.load(spark, write(f"{tmp_root}/in", {"a.csv": (header, LINES[:2])}), "bios", f"{tmp_root}/out")
    assert got.counts == {"lines": 2, "rows": 2, "rejected_lines": 0, "rejects": 0}
    assert got.rejects.count() == 0 and got.rows.count() == 2
    none = loading.load(spark, write(f"{tmp_root}/none", {"a.csv": (header, [])}), "bios", f"{tmp_root}/out2")
    assert none.counts["lines"] == 0 and none.rows.count() == 0


def test_another_header_fails_the_load(spark, tmp_root):
    swapped = ",".join([NAMES[1], NAMES[0], *NAMES[2:]])
    with pytest.raises(Exception, match="header"):
        loading.load(spark, write(f"{tmp_root}/in", {"a.csv": (swapped, LINES[:1])}), "bios", f"{tmp_root}/out")
