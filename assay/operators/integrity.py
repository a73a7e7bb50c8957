"""What bronze must have preserved: one aggregate pass per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T
from pyspark.sql import functions as F


def leaf_columns(schema: T.StructType) -> list[tuple[str, Column]]:
    """Every leaf of a page schema as (name, non-null values per row).

    A leaf inside an array of structs counts the array's non-null entries.
    """
    leaves = []
    for field in schema.fields:
        kind = field.dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            for inner in kind.elementType.names:
                entries = F.filter(F.col(field.name)[inner], lambda entry: entry.isNotNull())
                count = F.when(F.col(field.name).isNull(), 0).otherwise(F.size(entries))
                leaves.append((f"{field.name}.{inner}", count))
        else:
            leaves.append((field.name, F.when(F.col(field.name).isNotNull(), 1).otherwise(0)))
    return leaves


def leaf_counts(df: DataFrame) -> DataFrame:
    """Non-null values of every leaf, one row per leaf, in a single pass."""
    leaves = leaf_columns(df.schema)
    counted = df.agg(*[F.sum(count).cast("long").alias(f"_{i}") for i, (_, count) in enumerate(leaves)])
    pairs = [
        F.struct(F.lit(name).alias("column_name"), F.coalesce(F.col(f"_{i}"), F.lit(0)).alias("present"))
        for i, (name, _) in enumerate(leaves)
    ]
    return counted.select(F.explode(F.array(*pairs)).alias("leaf")).select("leaf.*")


def blank_columns(df: DataFrame) -> DataFrame:
    """Declared leaves that parsed entirely NULL: the vendor renamed them."""
    return leaf_counts(df).where(F.col("present") == 0).select("column_name")


def calendar_gap(df: DataFrame, day: str) -> DataFrame:
    """Published days against the calendar span they cover, as one row."""
    return df.agg(
        (F.datediff(F.max(day), F.min(day)) + 1).cast("long").alias("calendar_span"),
        F.count_distinct(day).alias("published_days"),
    ).withColumn("gap_days", F.col("calendar_span") - F.col("published_days"))


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact distinct values per column as (column_name, distinct_values).

    Each column is first reduced to its distinct values map-side, so a value that fills
    a third of the table costs one row per task.
    """
    counted = [
        df.select(F.col(name)).distinct().agg(F.count(name).alias("distinct_values")).select(
            F.lit(name).alias("column_name"), "distinct_values"
        )
        for name in columns
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def unique_rows(df: DataFrame, key: str, what: str) -> DataFrame:
    """``df`` by ``key``; a key that occurs more than once fails the query that reads it.

    Rows without a key match nothing in a join and are left out.
    """
    others = [name for name in df.columns if name != key]
    rows = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_times"), *[F.any_value(name).alias(name) for name in others])
    )
    repeated = F.raise_error(F.concat(F.lit(f"{what} repeats the key "), F.col(key).cast("string")))
    only = F.when(F.col("_times") > 1, repeated)
    return rows.select(
        key, *[only.otherwise(F.col(name)).cast(df.schema[name].dataType).alias(name) for name in others]
    )
