"""Raw CSV source: all-text schema round trip (quotes, blanks, padding kept as text)."""

import os

from courtline.operators.staging import stage_team_boxscores
from courtline.sources import testdata
from courtline.sources.raw import read_raw_csv
from tests.conftest import SF_SMALL


def test_csv_round_trip_keeps_every_column_text(spark, tmp_root):
    raw = testdata.raw_tables(spark, SF_SMALL)["team_boxscores"]
    path = os.path.join(tmp_root, "team.csv")
    raw.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    back = read_raw_csv(spark, path, "team_boxscores")
    assert all(f.dataType.simpleString() == "string" for f in back.schema.fields)
    assert back.count() == raw.count()
    a = sorted(map(tuple, stage_team_boxscores(raw).collect()), key=repr)
    b = sorted(map(tuple, stage_team_boxscores(back).collect()), key=repr)
    assert a == b


def test_swapped_header_fails(spark, tmp_root):
    import os

    import pytest

    from courtline.schemas import RAW_SCHEMAS
    from courtline.sources.raw import read_raw_csv
    names = RAW_SCHEMAS["team_boxscores"].fieldNames()
    a, b = names.index("TEAM_ID"), names.index("TEAM_NAME")
    names[a], names[b] = names[b], names[a]
    path = os.path.join(tmp_root, "t.csv")
    with open(path, "w") as f:
        f.write(",".join(names) + "\n" + ",".join("1" for _ in names) + "\n")
    with pytest.raises(Exception):
        read_raw_csv(spark, path, "team_boxscores").collect()


def test_logo_file_and_bios_round_trip(spark, tmp_root):
    import os

    from courtline.schemas import RAW_SCHEMAS
    from courtline.sources.lookups import read_team_logos
    from courtline.sources.raw import read_raw_csv, write_raw_csv
    path = os.path.join(tmp_root, "logos.csv")
    with open(path, "w") as f:
        f.write("team,year,logo\nA,2000,a.svg\n")
    assert [tuple(r) for r in read_team_logos(spark, path).collect()] == [("A", 2000, "a.svg")]
    names = RAW_SCHEMAS["bios"].fieldNames()
    row = spark.createDataFrame([tuple("x, \"y\"" if n == "SCHOOL" else " " if n == "WEIGHT" else "1" for n in names)], RAW_SCHEMAS["bios"])
    back = read_raw_csv(spark, write_raw_csv(row, os.path.join(tmp_root, "bios"), "bios"), "bios").collect()
    assert back[0]["SCHOOL"] == 'x, "y"' and (back[0]["WEIGHT"] or "").strip() == ""
