"""Incremental refresh: new dumps in a folder update a page table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.tools import merge_pages
from ..sources.dump import PAGE


def refresh(spark: SparkSession, folder: str, table: str, checkpoint: str) -> StreamingQuery:
    """Reads dumps that are new in ``folder`` and merges their pages by id into versions of the Parquet table ``table``.

    Every batch writes a new version beside the old one (table/version=N), so a failed batch leaves the last one whole,
    and a batch that is run again overwrites its own version only.
    """
    rows = spark.readStream.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", "false").schema(PAGE).load(folder)
    rows = rows.select("id", "title", F.coalesce("revision.text", F.lit("")).alias("text"), F.coalesce("revision.timestamp", F.lit("")).alias("timestamp"))

    def merge(batch: DataFrame, epoch: int) -> None:
        # The newest revision of a page; timestamps of dumps compare as text.
        new = batch.groupBy("id").agg(F.max(F.struct("timestamp", "title", "text")).alias("r")).select("id", "r.title", "r.text", "r.timestamp")
        out = new.withColumn("status", F.lit("new")) if epoch == 0 else merge_pages(spark.read.parquet(f"{table}/version={epoch - 1}").drop("status", "version"), new)
        out.write.mode("overwrite").parquet(f"{table}/version={epoch}")

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
