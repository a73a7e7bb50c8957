"""Change events: parse, judge, count and replay."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from assay.functions.columns import evaluated_once
from assay.operators.dedupe import latest_per_key

# Operation codes of the capture tool and of the change log.
OPERATIONS = {"c": "I", "u": "U", "d": "D"}


def parse_envelopes(df: DataFrame, image: T.StructType, value: str = "value") -> DataFrame:
    """Envelope text to operation, row image and fault.

    The image of a delete is its ``before``, of anything else its ``after``. ``fault``
    is NULL for a usable event; a snapshot read, an unknown operation, a tombstone and
    a missing image are faults, never relabelled.
    """
    envelope = T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("before", image),
            T.StructField("after", image),
        ]
    )
    others = [name for name in df.columns if name != value]
    event = evaluated_once(df, "_event", F.from_json(value, envelope))
    parsed = event.withColumn(
        "_image", F.when(F.col("_event.op") == "d", F.col("_event.before")).otherwise(F.col("_event.after"))
    )
    op = F.col("_event.op")
    return parsed.select(
        *others,
        F.coalesce(*[F.when(op == code, name) for code, name in OPERATIONS.items()]).alias("op"),
        F.when(F.col(value).isNull(), "tombstone")
        .when(op.isNull(), "unreadable envelope")
        .when(op == "r", "snapshot read")
        .when(~op.isin(*OPERATIONS), "unknown operation")
        .when(F.col("_image").isNull(), "no row image")
        .alias("fault"),
        *[F.col(f"_image.{name}").alias(name) for name in image.names],
    )


def faults(events: DataFrame) -> DataFrame:
    return events.where(F.col("fault").isNotNull())


def usable(events: DataFrame) -> DataFrame:
    return events.where(F.col("fault").isNull()).drop("fault")


def counts_by_operation(events: DataFrame) -> DataFrame:
    return events.groupBy("op").agg(F.count("*").alias("events"))


def count_gate(events: DataFrame, expected: int) -> DataFrame:
    """One row when the stream does not hold exactly the expected events, else none."""
    return events.agg(F.count("*").alias("held"), F.lit(expected).cast("long").alias("expected")).where(
        F.col("held") != F.col("expected")
    )


def current_state(events: DataFrame, keys: list[str], capture: str, op: str = "op") -> DataFrame:
    """Replay in capture order: the last image of every key that is not deleted."""
    last = latest_per_key(events, keys, [capture])
    return last.where(F.col(op) != "D")


def drop_redelivered(events: DataFrame, offset: list[str]) -> DataFrame:
    """A re-read stream holds every event once: first by its position in the topic."""
    return latest_per_key(events, offset, [])
