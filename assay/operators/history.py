"""Ordered neighbours within a key, and the slowly changing history built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Events of one key that one task may hold: a chunk is at most this many offsets wide.
CHUNK_OFFSETS = 1 << 22


def offset_block(offset: str, width: int) -> Column:
    """The first offset of the block an offset falls in, exact for any long."""
    return F.col(offset) - F.pmod(F.col(offset), F.lit(width))


def lead_by_chunk(
    df: DataFrame,
    keys: list[str],
    chunk: dict[str, Column],
    within: str,
    value: str,
    into: str,
    highest: tuple[str, str] | None = None,
) -> DataFrame:
    """``lead(value)`` per key, ordered by the chunk expressions and then ``within``.

    ``chunk`` cuts a key of any size into consecutive runs; ``within`` is unique inside
    a run. The window runs over (key, chunk); a sentinel row closes each run with the
    head of the key's next one. Only the heads are ever gathered per key, and nothing
    is joined back. ``highest`` is (column, name): the key's greatest value of a column, which
    the sentinels carry too.
    """
    cut = df
    for name, expression in chunk.items():
        cut = cut.withColumn(name, expression)
    parts = [*keys, *chunk]

    next_head = F.lead("_head").over(Window.partitionBy(*keys).orderBy(*chunk))
    heads, carried = [F.min_by(value, within).alias("_head")], []
    if highest:
        heads.append(F.max(highest[0]).alias("_highest"))
        carried.append(F.max("_highest").over(Window.partitionBy(*keys)).alias(highest[1]))
    sentinels = (
        cut.groupBy(*parts)
        .agg(*heads)
        .select(*parts, next_head.alias(value), F.lit(True).alias("_sentinel"), *carried)
    )
    inside = Window.partitionBy(*parts).orderBy("_sentinel", within)
    led = (
        cut.withColumn("_sentinel", F.lit(False))
        .unionByName(sentinels, allowMissingColumns=True)
        .withColumn(into, F.lead(value).over(inside))
    )
    if highest:
        led = led.withColumn(highest[1], F.max(highest[1]).over(Window.partitionBy(*parts)))
    return led.where(~F.col("_sentinel")).drop("_sentinel", *chunk)


def event_intervals(
    events: DataFrame,
    keys: list[str],
    effective: str,
    capture: str,
    chunk_offsets: int = CHUNK_OFFSETS,
) -> DataFrame:
    """Events with ``valid_from``, ``valid_to`` and ``is_current``, deletes among them.

    Ordered by effective date, then capture offset; an event is valid to the key's next one.
    ``is_current`` marks the event the key was last captured with. As a late event may carry an
    early date, that one can have a next event too: a current row may have a ``valid_to``.
    Capture offsets are unique, so a chunk of one date and one offset block is bounded, and a key
    holding a third of all events is spread over its chunks throughout.
    """
    chunk = {"_date": F.col(effective), "_block": offset_block(capture, chunk_offsets)}
    following = lead_by_chunk(events, keys, chunk, capture, effective, "valid_to", (capture, "_last"))
    return (
        following.withColumn("valid_from", F.col(effective))
        .withColumn("is_current", F.coalesce(F.col(capture) == F.col("_last"), F.lit(False)))
        .drop("_last")
    )


def validity_intervals(
    events: DataFrame,
    keys: list[str],
    effective: str,
    capture: str,
    op: str = "op",
    chunk_offsets: int = CHUNK_OFFSETS,
) -> DataFrame:
    """Versions of each key with ``valid_from``, ``valid_to`` and ``is_current``.

    Every insert or update opens a version that the key's next event closes; a delete closes and
    opens nothing. The current versions are those that replaying the log leaves.
    """
    return event_intervals(events, keys, effective, capture, chunk_offsets).where(F.col(op) != "D")


def order_disagreements(
    events: DataFrame,
    keys: list[str],
    effective: str,
    capture: str,
    chunk_offsets: int = CHUNK_OFFSETS,
) -> DataFrame:
    """Keys whose capture order is not their business order, with the steps back."""
    chunk = {"_block": offset_block(capture, chunk_offsets)}
    narrow = events.select(*keys, effective, capture)
    following = lead_by_chunk(narrow, keys, chunk, capture, effective, "_next")
    return (
        following.where(F.col("_next") < F.col(effective))
        .groupBy(*keys)
        .agg(F.count("*").alias("steps_back"))
    )
