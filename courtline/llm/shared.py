"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors the package, once per application, whatever their Python path holds."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(os.path.realpath(tempfile.mkdtemp()), "courtline.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                file = os.path.join(folder, name)
                z.write(file, os.path.relpath(file, os.path.dirname(package)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which driver and executors share.

    Where the setting is absent (tests on a local master) a temporary folder is taken; on any
    other master its absence is an error, since executors could not read each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="courtline-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm/{tag}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends in a durable table."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def text_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the key and the text of ``df``, a null text as the empty one; other columns go."""
    ship(df.sparkSession)
    return df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))


def opaque(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with its id columns as strings: pandas would turn a null among integers into doubles and round them."""
    return df.withColumns({k: F.col(k).cast("string") for k in keys})


def exact(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with the id columns that went through pandas as strings turned back into integers."""
    return df.withColumns({k: F.col(k).cast("long") for k in keys})


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs started here drop their shuffle files as they end, not when the driver's garbage is collected.

    For jobs that write a table and whose frames are not run again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """Jobs started here hand whole texts to Python ``rows`` at a time: a batch lies in memory several times over,
    in the executor and in its Python worker, and neither gives all of it back.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bounded_sample(df: DataFrame, key: str, rows: int, among: int | None = None, where: str = "true") -> DataFrame:
    """At most ``rows`` rows that meet ``where``, the first by hash of ``key``, whatever the number of tasks.

    A threshold on the hash leaves about ``among`` rows (twice as many as asked for unless given) to
    choose from, so what the tasks send on does not add up with their number.
    """
    total = df.count()
    h = F.xxhash64(key)
    share = min(1.0, (among or 2 * rows) / max(1, total))
    place = (h.cast("double") / F.lit(2.0 ** 64)) + F.lit(0.5)
    return df.filter(place <= F.lit(share)).filter(where).orderBy(h, *df.columns).limit(rows)


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows: the check made before any broadcast hint."""
    return df.limit(max_rows + 1).count() <= max_rows
