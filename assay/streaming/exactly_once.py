"""Exactly once from an at-least-once topic, with state that a watermark bounds.

An event is known by its place in the topic: topic, partition and offset. The state store holds the
places seen, each until the watermark has passed its event time by the delay, so it grows with what
arrives within the delay and not with the topic. An event whose first delivery comes later than that
cannot be told from a repeat; it never enters the table, and ``late_rows`` finds it for quarantine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What names an event in a topic.
PLACE = ["topic", "partition", "offset"]


def land_once(
    stream: DataFrame, event_time: str, delay: str, path: str, checkpoint: str, place: list[str] | None = None
) -> list[dict]:
    """Append what is available now and not seen before to the table at ``path``.

    Returns the progress of the run's batches: rows read, rows that came after the watermark and
    the size of the state. A restart goes on from the checkpoint's offsets, state and watermark;
    the sink's own log keeps an interrupted batch from landing twice.
    """
    query = (
        stream.withWatermark(event_time, delay)
        .dropDuplicatesWithinWatermark(place or PLACE)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [
        {
            "rows": progress["numInputRows"],
            "late": sum(state["numRowsDroppedByWatermark"] for state in progress["stateOperators"]),
            "held": sum(state["numRowsTotal"] for state in progress["stateOperators"]),
        }
        for progress in query.recentProgress
    ]


def late_rows(topic: DataFrame, landed: DataFrame, place: list[str] | None = None) -> DataFrame:
    """Events of the topic that never landed, one row each: their first delivery came too late.

    Deliveries of one event are reduced to one row before they meet what landed.
    """
    keys = place or PLACE
    others = [name for name in topic.columns if name not in keys]
    once = topic.groupBy(*keys).agg(*[F.min(name).alias(name) for name in others])
    return once.join(landed.select(*keys), keys, "left_anti").select(*topic.columns)
