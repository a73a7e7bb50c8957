"""One row per key out of at-least-once deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"
APART = "_apart"


def latest_per_key(df: DataFrame, keys: list[str], descending: list[str]) -> DataFrame:
    """The row of each key that is highest by ``descending``; exact duplicates collapse.

    Every other column breaks ties, lowest first, so the choice never depends on the
    order rows arrive in. Spark keeps one row per key on the map side
    (WindowGroupLimit) before it shuffles, so a key holding a large share of the rows
    sends one row per map task.

    A row without a whole key says nothing of another one's: each is its own group, so
    all of them stay, for whoever judges rows later, and they spread over the tasks.
    """
    ties = [name for name in df.columns if name not in keys and name not in descending]
    missing = F.lit(False)
    for name in keys:
        missing = missing | F.col(name).isNull()
    ranking = Window.partitionBy(*keys, APART).orderBy(
        *[F.col(name).desc_nulls_last() for name in descending],
        *[F.col(name).asc_nulls_last() for name in ties],
        *([] if descending or ties else [F.col(name) for name in keys]),
    )
    apart = df.withColumn(APART, F.when(missing, F.monotonically_increasing_id()))
    ranked = apart.withColumn(RANK, F.row_number().over(ranking))
    return ranked.where(F.col(RANK) == 1).drop(RANK, APART)


def latest_by_sequence(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """Latest event per key, ranked by the vendor's own sequence column."""
    return latest_per_key(df, keys, [sequence])


def redeliveries(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows, distinct keys and the rows delivered more than once, as one row."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("deliveries"))
    return per_key.agg(
        F.sum("deliveries").alias("rows"),
        F.count("*").alias("distinct_keys"),
        F.sum(F.col("deliveries") - 1).alias("redelivered"),
        F.max("deliveries").alias("most_deliveries"),
    )
