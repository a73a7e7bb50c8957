"""Make a sparse daily series dense by carrying the last published value forward."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def densify_daily(df: DataFrame, key: str, day: str, value: str, carried: str = "is_carried") -> DataFrame:
    """One row per key and calendar day, from the key's first published day to the last
    day anybody published.

    Each published row is stretched over the days until the next one, so there is no
    calendar to join with. Days before a key's first value stay absent. Input is one
    row per key and published day, or the job fails: a key's window never exceeds the
    calendar.
    """
    published = df.where(F.col(value).isNotNull() & F.col(day).isNotNull()).select(key, day, value)
    last_day = published.agg(F.max(day)).scalar()
    following = F.lead(day).over(Window.partitionBy(key).orderBy(day))
    twice = F.raise_error(F.lit(f"two values of {value} for one {key} and {day}"))
    return (
        published.withColumn("_next", following)
        .withColumn(
            "_until",
            F.when(F.col("_next") == F.col(day), twice.cast("date"))
            .when(F.col("_next").isNotNull(), F.date_sub("_next", 1))
            .otherwise(last_day),
        )
        .select(
            key,
            F.explode(F.sequence(F.col(day), F.col("_until"))).alias("_day"),
            F.col(value),
            F.col(day).alias("published_on"),
        )
        .select(
            key,
            F.col("_day").alias(day),
            value,
            "published_on",
            (F.col("_day") != F.col("published_on")).alias(carried),
        )
    )


def carry_accounting(dense: DataFrame, key: str, day: str, carried: str = "is_carried") -> DataFrame:
    """One row: carried + published must equal dense, and dense must be keys × days."""
    return dense.agg(
        F.count("*").alias("dense_rows"),
        F.count_if(F.col(carried)).alias("carried_rows"),
        F.count_if(~F.col(carried)).alias("published_rows"),
        F.count_distinct(key).alias("series"),
        (F.datediff(F.max(day), F.min(day)) + 1).cast("long").alias("calendar_days"),
    ).withColumn("is_dense", F.col("dense_rows") == F.col("series") * F.col("calendar_days"))
