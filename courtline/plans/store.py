"""Materialised tables under the cluster's shared checkpoint folder.

The warehouse's model layer is materialised (tables, not views) so queries read
compact parquet with pushdown instead of recomputing the chain.  ``TableStore``
writes a table on first use and hands back a parquet scan of it.  Written files
survive executor loss and cut the lineage, unlike an in-memory cache.

The root is ``<spark.checkpoint.dir>/courtline/<run id>``: a fresh run id per
process, so a later run never reads tables materialised from other inputs.
"""

from __future__ import annotations

import os
import re
import sys
import threading
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from courtline.session import checkpoint_dir, keep_to_buckets

_RUN_ID = uuid.uuid4().hex[:12]


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """``buckets``: of a bucketed table, as many as a shuffle has partitions unless given."""
        keep_to_buckets(spark)
        self.spark, self.buckets = spark, buckets
        self.root = root.rstrip("/")
        self._written: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.RLock] = {}
        self._guard = threading.Lock()

    def _lock(self, name: str) -> threading.RLock:
        with self._guard:
            return self._locks.setdefault(name, threading.RLock())

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def materialize(self, name: str, build: Callable[[], DataFrame], partition_by: list[str] | None = None,
                    bucket_by: str | None = None, dealt: bool = False, sort_by: str | None = None,
                    at: str | None = None) -> DataFrame:
        """Write ``build()`` once as parquet; return a scan of the written table.

        One lock per table: independent tables can be written by concurrent jobs,
        while a table is never written twice.  With ``bucket_by`` the table is dealt and sorted by that
        column as it is written, so that joins on it need no exchange of this side; ``dealt`` tells that the
        rows come dealt by it, and are written where they are.  ``sort_by`` sorts a bucket by another column; of a table
        that is partitioned as well, tasks are sorted by its partitions alone.  ``at`` is a folder other than the store's own for the files.
        """
        with self._lock(name):
            if name not in self._written:
                t0 = time.perf_counter()
                df = build()
                schema, seen = df.schema, Observation()
                if bucket_by and not dealt:
                    df = df.repartition(self._buckets(), bucket_by)
                if bucket_by and partition_by:  # a file is finished before the next: faster than writing to all in turn
                    df = df.sortWithinPartitions(*partition_by)
                # counted in the tasks that write: Spark takes each of them once, whatever is tried again
                df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
                w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
                if partition_by:
                    w = w.partitionBy(*partition_by)
                if bucket_by:
                    order = None if partition_by else sort_by or bucket_by
                    read = self._bucketed(w, name, bucket_by, order, schema, at or self.path(name))
                else:
                    w.parquet(self.path(name))
                    # read back with the written schema: no footer sampling, and partition
                    # values (e.g. a '2001-02' season label) keep their declared type
                    read = self.spark.read.schema(schema).parquet(self.path(name))
                self.spark.createDataFrame([(name, seen.get["rows"])], "source string, n long").coalesce(1) \
                    .write.mode("overwrite").parquet(self.path(f"_rows/{name}"))
                if os.environ.get("COURTLINE_TIMING"):
                    print(f"[store] {name}: {time.perf_counter() - t0:.2f}s", file=sys.stderr)
                self._written[name] = read
            return self._written[name]

    def rows(self, name: str, label: str) -> DataFrame:
        """The number of rows of a written table as a row (source, n): counted while it was written, not by a scan."""
        path = self.path(f"_rows/{name}")
        return self.spark.read.schema("source string, n long").parquet(path).select(F.lit(label).alias("source"), "n")

    def _buckets(self) -> int:
        return self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def _bucketed(self, writer: DataFrameWriter, name: str, column: str, order: str | None, schema: StructType,
                  path: str) -> DataFrame:
        """A table of Spark's catalog, whose entry keeps the buckets, over files in ``path``."""
        table = self._table(name)
        writer = writer.format("parquet").option("path", path).bucketBy(self._buckets(), column)
        (writer.sortBy(order) if order else writer).saveAsTable(table)
        return self.spark.table(table).select(*schema.fieldNames())

    def drop(self) -> None:
        """Take the bucketed tables out of the catalog; their files stay where they are."""
        for name in self._written:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table(name)}")

    def _table(self, name: str) -> str:
        return re.sub(r"\W+", "_", f"courtline_{self.path(name)}").lower()

    def materialize_all(self, builders: dict[str, Callable[[], DataFrame]],
                        max_workers: int = 4,
                        partition_by: dict[str, list[str]] | None = None
                        ) -> dict[str, DataFrame]:
        """Materialise independent tables as concurrent Spark jobs."""
        from concurrent.futures import ThreadPoolExecutor
        parts = partition_by or {}
        with ThreadPoolExecutor(max_workers=max_workers) as pool:
            futures = {n: pool.submit(self.materialize, n, b, parts.get(n))
                       for n, b in builders.items()}
            return {n: f.result() for n, f in futures.items()}


_STORES: dict[tuple, TableStore] = {}
_STORES_LOCK = threading.Lock()


def session_store(spark: SparkSession, scope: str) -> TableStore:
    """The per-process store for one input ``scope`` (e.g. a testdata folder)."""
    key = (spark.sparkContext.applicationId, scope)
    with _STORES_LOCK:
        return _store_for(spark, scope, key)


def _store_for(spark: SparkSession, scope: str, key: tuple) -> TableStore:
    if key not in _STORES:
        tag = re.sub(r"[^A-Za-z0-9_.-]+", "_", scope).strip("_")
        _STORES[key] = TableStore(spark, f"{checkpoint_dir(spark)}/courtline/{_RUN_ID}/{tag}")
    return _STORES[key]
