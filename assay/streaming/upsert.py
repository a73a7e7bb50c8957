"""Exactly-once tables from at-least-once streams.

A micro-batch is reduced to one row per key and written to a folder named by its batch
id, replacing whatever an interrupted attempt left. The table records whose checkpoint
those ids come from, and any other writer is refused before it writes. Reading takes the latest row per
key over all batches, so a write costs its batch and never the table. ``compact``
folds the batches into a new table when readers should stop paying for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assay.operators.dedupe import latest_by_sequence
from assay.sources.tables import write_table
from assay.sources.versions import put_once, read_small

BATCH = "batch_id"
OWNER = "_owner"


class ForeignWriter(Exception):
    """The table belongs to a stream with another checkpoint."""


def writer_name(table: str) -> str:
    return f"writer of {table}"


def claim(spark: SparkSession, table: str, checkpoint: str) -> None:
    """Make ``checkpoint`` the owner of ``table``, or fail if another one is.

    The record appears whole and only where there is none, so of two writers one wins and a
    writer that dies on the way leaves the table free.
    """
    path = f"{table}/{OWNER}"
    if not put_once(spark, path, checkpoint):
        held = read_small(spark, path)
        if held != checkpoint:
            raise ForeignWriter(f"{table} is written by the stream of {held}")


def start_upsert(stream: DataFrame, keys: list[str], sequence: str, table: str, checkpoint: str):
    """Start the one writer of ``table``; Spark refuses a second query of the same name."""

    claim(stream.sparkSession, table, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        latest = latest_by_sequence(batch, keys, sequence)
        latest.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .queryName(writer_name(table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert(stream: DataFrame, keys: list[str], sequence: str, table: str, checkpoint: str) -> DataFrame:
    """Apply everything available now and return the table."""
    start_upsert(stream, keys, sequence, table, checkpoint).awaitTermination()
    return read_latest(stream.sparkSession, keys, sequence, table)


def read_latest(spark: SparkSession, keys: list[str], sequence: str, table: str) -> DataFrame:
    """One row per key: the highest sequence over all batches written so far."""
    return latest_by_sequence(spark.read.parquet(table), keys, sequence).drop(BATCH)


def compact(spark: SparkSession, keys: list[str], sequence: str, table: str, into: str) -> str:
    """Fold every batch into one, as the first batch of a new table."""
    write_table(read_latest(spark, keys, sequence, table), f"{into}/{BATCH}=-1")
    return into
