"""Refresh once per completed delivery, not once per landed part."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MARKER = "complete.json"
# Deliveries handled under one batch id.
PER_BATCH = 100
FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"


def deliveries(
    spark: SparkSession, landing: str, marker: str = MARKER, per_batch: int = PER_BATCH
) -> DataFrame:
    """Stream of delivery folders, each named by its marker file."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", marker)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", per_batch)
        .load(landing)
        .selectExpr("regexp_replace(path, '/[^/]+$', '') AS folder")
    )


def delivery_id(folder: str, batch_id: int) -> str:
    """A name for one delivery of one batch, fit for a folder."""
    return f"{batch_id}-{hashlib.md5(folder.encode()).hexdigest()}"


def on_delivery(
    spark: SparkSession,
    landing: str,
    refresh: Callable[[SparkSession, str, int], None],
    checkpoint: str,
    marker: str = MARKER,
) -> None:
    """Call ``refresh(spark, folder, batch_id)`` for every delivery not yet handled.

    A batch interrupted half-way is handed over again whole under the same batch id, so a
    refresh that writes to a place named by ``delivery_id(folder, batch_id)`` is exactly-once.
    """

    def act(batch: DataFrame, batch_id: int) -> None:
        for row in batch.select("folder").distinct().orderBy("folder").collect():
            refresh(batch.sparkSession, row["folder"], batch_id)

    query = (
        deliveries(spark, landing, marker)
        .writeStream.foreachBatch(act)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
