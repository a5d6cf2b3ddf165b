"""Incremental season feed: file-source Structured Streaming into the raw layer.

The reference refreshes the current season by hand (delete, reload CSV, rebuild).  Here
new CSV drops in an incoming folder are a file stream.  Each micro-batch first lands, as it is,
in a folder of its own; a season that occurs in it is then replaced by all rows of the feed that
have landed for it, so files of one season may come in several batches.  Rows without a
season are never loaded over the ones there (NULL is not equal to any season): they land only.
The stream's checkpoint, one per feed and under the warehouse root unless given, records which files were
processed; a batch that is replayed lands in the same folder and replaces the same seasons.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtline.schemas import RAW_SCHEMAS
from courtline.sources.warehouse import Warehouse

BOX_SCORE_TABLES = ("player_boxscores", "team_boxscores")


def season_stream(spark: SparkSession, incoming_dir: str, table: str) -> DataFrame:
    """Streaming DataFrame over CSV files dropped into ``incoming_dir`` (all text)."""
    if table not in BOX_SCORE_TABLES:
        raise ValueError(f"season feeds exist for {BOX_SCORE_TABLES}, not {table!r}")
    return (spark.readStream.schema(RAW_SCHEMAS[table])
            .option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
            .option("quote", '"').option("escape", '"')
            .csv(incoming_dir))


def replace_seasons_batch(root: str, table: str, feed: str,
                          after: Callable[[int], None] | None = None):
    """foreachBatch handler: the seasons present in the batch become what the feed has landed for them."""
    landed = f"{root}/landed/{table}/{feed}"

    def handle(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        (batch.withColumn("_epoch", F.lit(epoch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(landed))
        every = spark.read.schema(batch.schema.add("_epoch", "long")).parquet(landed)
        present = F.trim("Season") != ""
        seasons = [r[0] for r in every.filter((F.col("_epoch") == epoch_id) & present).select("Season").distinct().collect()]
        rows = every.filter(F.col("Season").isin(seasons)).drop("_epoch")
        with Warehouse(spark, root).transaction() as tx:
            if tx.has("raw", table):
                tx.replace("raw", table, rows, seasons)
            else:
                tx.write("raw", table, rows, "Season")
        if after is not None:
            after(epoch_id)
    return handle


def start_season_feed(spark: SparkSession, incoming_dir: str, root: str, table: str,
                      checkpoint: str | None = None, available_now: bool = True,
                      after: Callable[[int], None] | None = None):
    """Start the feed; ``available_now`` processes what is there and stops."""
    feed = hashlib.sha256(incoming_dir.rstrip("/").encode()).hexdigest()[:16]
    ckpt = checkpoint or f"{root}/feeds/{table}/{feed}"
    writer = (season_stream(spark, incoming_dir, table).writeStream
              .foreachBatch(replace_seasons_batch(root, table, feed, after))
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()
