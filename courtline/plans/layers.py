"""The warehouse under schema names in Spark's catalog (SNK1, SNK5, SRC8).

Three schemas hold three layers: raw tables, views that type them, and model tables.  ``CREATE TABLE IF NOT EXISTS`` keeps
a table that is there and does not compute its rows again, and a view is a stored query: it shows what its raw table
holds now.  Names resolve for any SQL of the session's catalog (of the metastore, where one is configured).  Layers are
dropped in the reverse order of their creation, views before the tables under them.

A prefix keeps several warehouses apart in one catalog.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from courtline.operators.staging import staged_columns
from courtline.schemas import STAGING_SPECS
from courtline.sources.raw import LAYERS


class Layers:
    def __init__(self, spark: SparkSession, root: str, prefix: str):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix

    def name(self, layer: str, table: str) -> str:
        return f"`{self.prefix}_{layer}`.`{table}`"

    def create_schemas(self) -> None:
        for layer in LAYERS:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{self.prefix}_{layer}` LOCATION '{self.root}/{layer}'")

    def create_table(self, layer: str, table: str, build: Callable[[], DataFrame]) -> bool:
        """CREATE TABLE IF NOT EXISTS ... AS: whether it was created; ``build`` is not called where it is there."""
        name = self.name(layer, table)
        if self.spark.catalog.tableExists(name):
            return False
        build().write.format("parquet").mode("ignore").option("path", f"{self.root}/{layer}/{table}").saveAsTable(name)
        return True

    def create_view(self, table: str) -> bool:
        """A typed view ``staging.v_<table>`` over ``raw.<table>``, written out as SQL."""
        view = self.name("staging", f"v_{table}")
        if self.spark.catalog.tableExists(view):
            return False
        columns = ", ".join(f"{c._jc.node().sql()} AS `{out}`" for out, c in staged_columns(STAGING_SPECS[table]))
        self.spark.sql(f"CREATE VIEW IF NOT EXISTS {view} AS SELECT {columns} FROM {self.name('raw', table)}")
        return True

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def tables(self) -> list[str]:
        """layer.table of everything there is."""
        found = []
        for layer in LAYERS:
            if self.spark.catalog.databaseExists(f"{self.prefix}_{layer}"):
                found += [f"{layer}.{t.name}" for t in self.spark.catalog.listTables(f"`{self.prefix}_{layer}`") if not t.isTemporary]
        return found

    def drop(self) -> None:
        """Model tables, then views, then raw tables, then the schemas.  Files of the tables stay where they are."""
        for layer in reversed(LAYERS):
            for found in [t for t in self.tables() if t.startswith(f"{layer}.")]:
                kind = "VIEW" if layer == "staging" else "TABLE"
                self.spark.sql(f"DROP {kind} IF EXISTS {self.name(layer, found.partition('.')[2])}")
            self.spark.sql(f"DROP SCHEMA IF EXISTS `{self.prefix}_{layer}`")
