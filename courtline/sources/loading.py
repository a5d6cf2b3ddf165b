"""Loads that survive dirty files: one pass routes every line to typed rows or to rejects (SRC1-SRC3, SC3).

The strict way (``raw.read_raw_csv`` and the ANSI casts of staging) stops a load at its first bad cell.  Here each line
is parsed and typed once: ``try_cast`` tells a cell that its type does not take from a blank one, and the parser's
corrupt-record column a line that has too few or too many cells.  A line with any fault goes to the
rejects as a whole, all others become rows.  Both are written in one job, partitioned by whether the line is
good; typed rows and rejects are scans of the two folders, and the counts are observed on that write.

A reject has the file, the line as it stands there, the column, the cell and the reason (``cells`` for a line of
another width, else the type that does not take the cell); a line with two bad cells has two rows.  Blank lines are
no lines, as in any CSV.  A file whose header names other columns, or in another order, fails the load: there, no cell
can be trusted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtline.functions.text import blank_to_null, fold_accents, jersey_list, normalise_country
from courtline.schemas import RAW_SCHEMAS, STAGING_SPECS, STAT_TYPE

LINES_PER_FILE = 500_000
LINE, FILE, FAULTS, GOOD = "_line", "_file", "_faults", "_good"
TYPES = {"long": "bigint", "int": "int", "stat": STAT_TYPE, "date": "date"}
REJECT = "array<struct<column:string,value:string,reason:string>>"


@dataclass
class Loaded:
    """What a load gave: typed rows, rejects and the counts of lines, rows, rejected lines and rejects."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def _name(kind: str) -> str:
    return TYPES[kind] if isinstance(TYPES[kind], str) else TYPES[kind].simpleString()


def lenient(raw_col: str, kind: str) -> Column:
    """As staging types a cell, but null where the cell is not of the type."""
    v = blank_to_null(raw_col)
    if kind in TYPES:
        return v.try_cast(TYPES[kind])
    return {"text": lambda: v, "fold": lambda: fold_accents(v), "country": lambda: normalise_country(raw_col),
            "jersey": lambda: jersey_list(raw_col)}[kind]()


def faults(spec: list[tuple[str, str, str]]) -> Column:
    """The bad cells of a line: those with something in them that their type (column ``_t_<name>``) does not take."""
    cells = [F.when(F.col(f"_t_{out}").isNull() & blank_to_null(src).isNotNull(),
                    F.struct(F.lit(src).alias("column"), F.col(src).alias("value"), F.lit(_name(kind)).alias("reason")))
             for out, src, kind in spec if kind in TYPES]
    return F.array_compact(F.array(*cells)).cast(REJECT)


def routed(lines: DataFrame, spec: list[tuple[str, str, str]]) -> DataFrame:
    """Parsed lines (raw cells, ``_line`` of corrupt ones, ``_file``) typed, with their faults and whether they are good.

    A cell is typed once, in a column that the faults read.
    """
    width = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"),
                             F.lit("cells").alias("reason"))).cast(REJECT)
    typed = lines.withColumns({f"_t_{out}": lenient(src, kind) for out, src, kind in spec})
    found = F.when(F.col(LINE).isNotNull(), width).otherwise(faults(spec))
    raw = F.coalesce(F.col(LINE), F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in lines.columns if c not in (LINE, FILE)]))
    judged = typed.withColumn(FAULTS, found).withColumn(GOOD, F.size(FAULTS) == 0)
    return judged.select(*[F.col(f"_t_{out}").alias(out) for out, _, _ in spec], GOOD, FAULTS, FILE,
                         F.when(~F.col(GOOD), raw).alias(LINE))


def read_lines(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Every line of the CSV files as raw cells; ``_line`` is set where a line has another number of cells."""
    schema = T.StructType([*RAW_SCHEMAS[table].fields, T.StructField(LINE, T.StringType())])
    df = spark.read.csv(path, header=True, schema=schema, enforceSchema=False, quote='"', escape='"', multiLine=False,
                        mode="PERMISSIVE", columnNameOfCorruptRecord=LINE)
    return df.withColumn(FILE, F.col("_metadata.file_name"))


def load(spark: SparkSession, path: str, table: str, into: str) -> Loaded:
    """Load the CSV files of a raw table to ``into``: a folder that the cluster shares."""
    seen = Observation()
    counted = [F.count("*").alias("lines"), F.count_if(F.col(GOOD)).alias("rows"), F.count_if(~F.col(GOOD)).alias("rejected_lines"),
               F.sum(F.size(FAULTS)).alias("rejects")]
    lines = routed(read_lines(spark, path, table), STAGING_SPECS[table])
    lines.observe(seen, *counted).write.partitionBy(GOOD).parquet(into)
    stored = spark.read.schema(lines.schema).parquet(into)
    rows = stored.filter(GOOD).drop(GOOD, FAULTS, FILE, LINE)
    rejects = stored.filter(~F.col(GOOD)).select(F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.inline(FAULTS))
    return Loaded(rows, rejects, {k: v or 0 for k, v in seen.get.items()})


def write_lines(lines: DataFrame, column: str, path: str, table: str) -> str:
    """Write ready-made lines as compressed files of a raw table, each under the table's header.

    A compressed file is read by one task, so a file has at most ``LINES_PER_FILE`` lines.
    """
    header = ",".join(RAW_SCHEMAS[table].fieldNames())
    lines.select(F.col(column).alias(header)).write.mode("overwrite").option("maxRecordsPerFile", LINES_PER_FILE).csv(
        path, header=True, sep="\x01", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="gzip")
    return path
