"""Bring columns of several vendors to one vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.functions.text import conform_name
from assay.operators.dedupe import latest_per_key
from assay.operators.integrity import unique_rows


def conform_lookup(df: DataFrame, typed: str, lookup: DataFrame, name: str, code: str, into: str) -> DataFrame:
    """Replace a name as typed by its code; a name the lookup lacks stays, with a NULL code.

    ``lookup`` must hold one row per conformed name; one that holds more fails the query.
    """
    codes = unique_rows(
        lookup.select(conform_name(F.col(name)).alias("_name"), F.col(code).alias(into)), "_name", "lookup"
    )
    return (
        df.withColumn("_name", conform_name(F.col(typed)))
        .join(codes, "_name", "left")
        .drop("_name")
    )


def conform_hierarchy(df: DataFrame, product: str, segment: str, department: str) -> DataFrame:
    """One row per product with its segment and department."""
    narrow = df.select(
        F.col(product).alias("product_id"),
        F.trim(segment).alias("product_segment"),
        F.trim(department).alias("department"),
    )
    return latest_per_key(narrow, ["product_id"], [])


def domain_differences(df: DataFrame, column: str, expected: list) -> DataFrame:
    """Values present but not expected, or expected but absent. Empty is a pass."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(value,) for value in expected], f"value {dict(df.dtypes)[column]}")
    found = df.select(F.col(column).alias("value")).distinct()
    return (
        found.withColumn("found", F.lit(True))
        .join(wanted.withColumn("expected", F.lit(True)), "value", "full_outer")
        .where(F.col("found").isNull() | F.col("expected").isNull())
        .select("value", F.when(F.col("found").isNull(), "absent").otherwise("unexpected").alias("problem"))
    )


def join_missing_apart(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Left join on ``key`` with the rows that lack one routed past it and kept.

    A missing key can match nothing, and a shuffle would send all of them to one task.
    """
    joined = df.where(F.col(key).isNotNull()).join(other, key, "left")
    apart = df.where(F.col(key).isNull())
    return joined.unionByName(apart, allowMissingColumns=True)
