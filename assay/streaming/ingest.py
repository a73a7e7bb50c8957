"""Bounded ingest of the change stream into a Parquet change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from assay.operators import cdc


class IncompleteStream(ValueError):
    """The stream does not hold exactly the events it should."""


class UnusableEvents(ValueError):
    """The stream carried events that cannot enter the change log."""


def require_complete(held: DataFrame, expected: int) -> None:
    """Fail before consuming unless the stream holds exactly ``expected`` events."""
    wrong = cdc.count_gate(held, expected).take(1)
    if wrong:
        raise IncompleteStream(f"the stream holds {wrong[0]['held']} events, expected {expected}")


def land_changes(stream: DataFrame, image: T.StructType, path: str, checkpoint: str) -> DataFrame:
    """Consume what is available now, once, and return the landed change log.

    Usable and faulty events both land; the log is handed out only if no event is
    faulty. The checkpoint and the sink's own log make a re-run a no-op.
    """
    query = (
        cdc.parse_envelopes(stream, image)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    landed = stream.sparkSession.read.parquet(path)
    faulty = cdc.faults(landed).take(1)
    if faulty:
        raise UnusableEvents(f"{faulty[0]['fault']} at offset {faulty[0]['capture_offset']}")
    return cdc.usable(landed)
