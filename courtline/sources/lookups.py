"""Curated lookups (SRC4-SRC7).

Three lookups are fixed values kept inline (they are curated data, not derived); the
era-logo table is an external CSV read with a declared schema.  The inline lookups
have a fixed, known row count, which is what makes broadcasting them safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.functions.keys import SEASON_TYPES
from courtline.schemas import LOGO_SCHEMA

# ---- fixed values: country name -> two-letter flag code (82 rows) -------------------
COUNTRY_CODES = [
    ("Angola", "ao"), ("Antigua and Barbuda", "ag"), ("Argentina", "ar"),
    ("Australia", "au"), ("Austria", "at"), ("Bahamas", "bs"), ("Belgium", "be"),
    ("Belize", "bz"), ("Bosnia and Herzegovina", "ba"), ("Brazil", "br"),
    ("British Virgin Islands", "vg"), ("Bulgaria", "bg"), ("Cabo Verde", "cv"),
    ("Cameroon", "cm"), ("Canada", "ca"), ("China", "cn"), ("Colombia", "co"),
    ("Congo", "cg"), ("Croatia", "hr"), ("Cuba", "cu"), ("Czech Republic", "cz"),
    ("Democratic Republic of the Congo", "cd"), ("Denmark", "dk"),
    ("Dominican Republic", "do"), ("Egypt", "eg"), ("Estonia", "ee"), ("Finland", "fi"),
    ("France", "fr"), ("Gabon", "ga"), ("Georgia", "ge"), ("Germany", "de"),
    ("Ghana", "gh"), ("Greece", "gr"), ("Guinea", "gn"), ("Haiti", "ht"), ("Iran", "ir"),
    ("Ireland", "ie"), ("Israel", "il"), ("Italy", "it"), ("Lebanon", "lb"),
    ("Jamaica", "jm"), ("Japan", "jp"), ("Latvia", "lv"), ("Lithuania", "lt"),
    ("North Macedonia", "mk"), ("Mali", "ml"), ("Mexico", "mx"), ("Montenegro", "me"),
    ("Netherlands", "nl"), ("New Zealand", "nz"), ("Nicaragua", "ni"), ("Nigeria", "ng"),
    ("Norway", "no"), ("Panama", "pa"), ("Poland", "pl"), ("Portugal", "pt"),
    ("Puerto Rico", "pr"), ("Romania", "ro"), ("Russia", "ru"), ("Saint Lucia", "lc"),
    ("Scotland", "sc"), ("Senegal", "sn"), ("Serbia", "rs"), ("Slovenia", "si"),
    ("South Korea", "kr"), ("South Sudan", "ss"), ("Spain", "es"),
    ("St. Vincent & Grenadines", "vc"), ("Sudan", "sd"), ("Sweden", "se"),
    ("Switzerland", "ch"), ("Tanzania", "tz"), ("Trinidad and Tobago", "tt"),
    ("Tunisia", "tn"), ("Turkey", "tr"), ("US Virgin Islands", "vi"), ("USA", "us"),
    ("Ukraine", "ua"), ("United Kingdom", "gb"), ("Uruguay", "uy"), ("Venezuela", "ve"),
    ("Uganda", "ug"),
]

# ---- fixed values: player_id -> disambiguated display name (45 rows) ----------------
NAME_OVERRIDES = [
    (203318, "Glen Rice Jr."), (77178, "Charles A. Jones"), (76531, "Mike A. Davis"),
    (201607, "Patrick Aloysius Ewing Jr."), (78179, "Charles E. Smith"),
    (1520, "Charles C. Smith"), (77147, "George E. Johnson"), (77149, "George T. Johnson"),
    (203502, "Tony LaShae Mitchell Jr."), (203203, "Chris T. Wright"),
    (203147, "Jamahl Christopher Smith"), (1585, "Brandon D. Williams"),
    (1628455, "Mike P. James"), (78561, "Nate Williams"), (203187, "Christapher Johnson"),
    (77139, "David Johnson (77139)"), (199, "Reggie Silk Williams"),
    (78190, "Greg D. Smith"), (77144, "Eddie L. Johnson"), (201945, "Gerald Henderson Jr."),
    (78568, "Samuel H. Williams"), (77202, "Willie Jones"), (2399, "Mike Dunleavy Jr."),
    (76519, "Charlie Davis"), (76518, "Charles Davis"), (77268, "George Smith King Jr."),
    (78048, "Walker Dwayne Russell Sr."), (90000, "Mark Anthony Jones"),
    (76528, "Mark Giles Davis"), (1631098, "Jonathan Davis"),
    (1538, "Cedric Earl Henderson"), (78197, "Michael John Smith"),
    (200784, "Bobby Ray Jones"), (201173, "Marcus Eliot Williams"), (200793, "Daniel Brown"),
    (77154, "Kenneth H. Johnson"), (77156, "Larry O'Neal Johnson Sr."),
    (77818, "James Edward Paxson"), (120, "Steve Smith"), (76609, "Bob Duffy (76609)"),
    (76909, "Matt Guokas (76909)"), (77203, "Willie Jones (77203)"),
    (78209, "Bill Smith (78209)"), (78382, "Jack Turner (78382)"),
    (1631466, "Jeenathan Williams"),
]

# ---- fixed values: games whose box scores are known to be void ----------------------
# 2013-04-16, cancelled; every statistic was recorded as zero.
EXCLUDED_GAME_IDS = ["0021201214"]

COUNTRY_SCHEMA = T.StructType([T.StructField("country", T.StringType(), True),
                               T.StructField("code", T.StringType(), True)])
OVERRIDE_SCHEMA = T.StructType([T.StructField("player_id", T.LongType(), True),
                                T.StructField("name_override", T.StringType(), True)])
SEASON_TYPE_SCHEMA = T.StructType([T.StructField("season_type_key", T.IntegerType(), True),
                                   T.StructField("season_type", T.StringType(), True)])


def country_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRY_CODES, COUNTRY_SCHEMA)


def name_overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NAME_OVERRIDES, OVERRIDE_SCHEMA)


def dim_season_type(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEASON_TYPES, SEASON_TYPE_SCHEMA)


def excluded_games(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(g,) for g in EXCLUDED_GAME_IDS], "game_id string")


def read_team_logos(spark: SparkSession, path: str) -> DataFrame:
    """Curated era-logo CSV ``team,year,logo`` with a header."""
    return spark.read.csv(path, header=True, schema=LOGO_SCHEMA, quote='"', escape='"')


def write_team_logos(df: DataFrame, path: str) -> str:
    df.select("team", "year", "logo").write.mode("overwrite").csv(path, header=True, quote='"', escape='"')
    return path


def merged_by_key(current: DataFrame, load: DataFrame, keys: list[str]) -> DataFrame:
    """A curated table after a load: a row per key with ``action``, the values that hold now and ``times`` in the load.

    ``insert``, ``update`` and ``unchanged`` are what the load does to a key, ``kept`` a key that it does not name.  A
    key to which the load gives several values is a ``conflict``: it is reported and what was there stays
    (nothing, for a new key), so a load never fans joins out.  Keys compare null-safe; replaying a load changes nothing.
    """
    values = [c for c in current.columns if c not in keys]
    brought = load.groupBy(*keys).agg(F.count("*").alias("times"), F.count_distinct(F.struct(*values)).alias("variants"),
                                      F.min(F.struct(*values)).alias("new"))
    there = current.select(*[F.col(k).alias(f"_{k}") for k in keys], F.struct(*values).alias("old"))
    j = brought.join(there, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "full")
    action = F.when(F.col("times").isNull(), "kept").when(F.col("variants") > 1, "conflict") \
        .when(F.col("old").isNull(), "insert").when(F.col("old").eqNullSafe(F.col("new")), "unchanged").otherwise("update")
    own = F.col("old").isNotNull()  # then the key is known from the current side; both sides agree where both are there
    now = F.when(action.isin("insert", "update"), F.col("new")).otherwise(F.col("old"))
    return j.select(*[F.when(own, F.col(f"_{k}")).otherwise(F.col(k)).alias(k) for k in keys], action.alias("action"), now.alias("_now"),
                    F.coalesce("times", F.lit(0)).cast("long").alias("times")) \
        .select(*keys, "action", *[F.col(f"_now.{c}").alias(c) for c in values], "times", (F.col("_now").isNotNull()).alias("held"))


def assert_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Fail fast when a lookup key repeats (a repeated INSERT would fan joins out)."""
    dup = df.groupBy(*keys).count().filter("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"lookup {name} repeats key {dup[0].asDict()}")
    return df
