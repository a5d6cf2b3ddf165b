"""Raw-layer sources and sinks (SRC1-3, SNK1-5).

Raw CSVs are read with an all-text schema.  Tables are stored in a versioned warehouse
(``sources/warehouse.py``), in which a layer is a folder (``<root>/raw``, ``<root>/model``).  Raw box
scores are partitioned by ``Season``, so a season is replaced without touching another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.schemas import RAW_SCHEMAS
from courtline.sources.warehouse import Warehouse

LAYERS = ("raw", "staging", "model")


def read_raw_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Load a raw CSV (header row, quoted fields) with every column as STRING.

    The header is checked against the declared names in their order, and a line of another width fails
    the load, so no value lands in a column that is not its own.
    """
    return spark.read.csv(path, header=True, schema=RAW_SCHEMAS[table], enforceSchema=False, quote='"',
                          escape='"', multiLine=False, mode="FAILFAST")


def write_raw_csv(df: DataFrame, path: str, table: str) -> str:
    """Write a raw table as CSV files with the declared columns; missing ones are blank, as NULLs are."""
    names = RAW_SCHEMAS[table].fieldNames()
    have = set(df.columns)
    rows = df.select(*[(F.coalesce(F.col(n).cast("string"), F.lit("")) if n in have else F.lit("")).alias(n) for n in names])
    rows.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="",
                                     ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return path


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A table of the warehouse at ``root`` as it was last published."""
    return Warehouse(spark, root).read(layer, name)


def gathered(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a partition in few tasks, so that it gets few files; a large one is split over several."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_table(df: DataFrame, root: str, layer: str, name: str, mode: str = "overwrite",
                partition_by: str | None = None) -> DataFrame | None:
    """Store one table as a transaction of its own.  ``mode='ignore'`` is CREATE TABLE IF NOT EXISTS (first
    build); rebuilds use ``overwrite`` so a stale table is never silently kept."""
    warehouse = Warehouse(df.sparkSession, root)
    if mode == "ignore" and warehouse.snapshot().has(layer, name):
        return None
    with warehouse.transaction() as tx:
        return tx.write(layer, name, df, partition_by)
