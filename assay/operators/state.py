"""Current state and history moved on by batches of changes, without replaying the log.

Both are kept in hash buckets of their keys. A batch is merged into the buckets its keys fall in and
into no others: those are read, merged and written under the next version, and published together.
Events may come late, again or out of order; what results is what replaying all of them would leave.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators import dedupe, history
from assay.operators.reconcile import bucket_of
from assay.sources import versions
from assay.sources.tables import materialise

BUCKET = "_bucket"
# A bucket is rewritten whole, so it should hold what a task can: more buckets for more keys.
BUCKETS = 64
STATE, HISTORY = "state", "history"
_MADE = ("valid_from", "valid_to", "is_current")


def merge_batch(
    batch: DataFrame,
    root: str,
    keys: list[str],
    effective: str,
    capture: str,
    buckets: int = BUCKETS,
) -> dict:
    """Merge a batch of events into the state and history under ``root``; the new manifest.

    An event that came before, by its capture offset, changes nothing. Deleted keys stay in the
    written state as their delete, so that an older event cannot bring them back. The number of
    buckets is that of the first batch.
    """
    spark = batch.sparkSession
    held = versions.current(spark, root)
    buckets = held.get("buckets", buckets)
    folder = f"{root}/data/{held['version'] + 1:08d}-{uuid.uuid4().hex}"
    rows = materialise(batch.withColumn(BUCKET, bucket_of(keys, buckets)), f"{folder}/batch")
    # At most as many as there are buckets.
    touched = sorted(row[0] for row in rows.select(versions.part_name(F.col(BUCKET))).distinct().collect())
    if not touched:
        return held

    def before(table: str) -> DataFrame:
        if table not in held["tables"]:
            return rows.where(F.lit(False))
        kept = versions.read(spark, held, table)
        return kept.where(versions.in_parts(F.col(BUCKET), touched)).select(*rows.columns)

    state = dedupe.latest_per_key(
        before(STATE).unionByName(dedupe.latest_per_key(rows, keys, [capture])), keys, [capture]
    )
    events = dedupe.latest_per_key(before(HISTORY).unionByName(rows), [*keys, capture], [])
    made = {STATE: state, HISTORY: history.event_intervals(events, [BUCKET, *keys], effective, capture)}
    entries = {}
    for table, df in made.items():
        if table in held["tables"]:
            entries[table] = versions.write_parts(df, f"{folder}/{table}", held["tables"][table], touched)
        else:
            entries[table] = versions.write_whole(df, f"{folder}/{table}", BUCKET)
    manifest = {"version": held["version"] + 1, "buckets": buckets, "tables": entries}
    return versions.publish(spark, root, manifest)


def read_state(spark: SparkSession, manifest: dict, op: str = "op") -> DataFrame:
    """The last image of every key that is not deleted."""
    return versions.read(spark, manifest, STATE).where(F.col(op) != "D").drop(BUCKET)


def read_history(spark: SparkSession, manifest: dict, op: str = "op") -> DataFrame:
    """Versions of each key, as ``history.validity_intervals`` gives them."""
    return versions.read(spark, manifest, HISTORY).where(F.col(op) != "D").drop(BUCKET)
