"""Ask one question of two surfaces and name every difference."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.types import TOTAL

TOLERANCE = Decimal("0.01")
# Buckets that two surfaces are digested by; what differs is looked at bucket by bucket.
BUCKETS = 4096


def content_digest(df: DataFrame, by: list[str], name: str = "digest") -> DataFrame:
    """One ``name`` per group that depends on its rows, repeats included, but not on their order.

    Rows are hashed and summed where they lie, so a group of any size is one row per task.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    first, second = F.xxhash64(row), F.xxhash64(F.lit(1), row)
    return df.groupBy(*by).agg(
        F.struct(
            F.count("*").alias("rows"),
            F.sum(first.cast("decimal(38,0)")).alias("sum"),
            F.bit_xor(second).alias("mix"),
        ).alias(name)
    )


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def differing_buckets(
    left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], buckets: int = BUCKETS
) -> list[int]:
    """Buckets of keys whose rows are not the same on both surfaces; at most ``buckets`` of them."""

    def digests(df: DataFrame, name: str) -> DataFrame:
        rows = df.select(*keys, *[F.col(f).cast(TOTAL).alias(f) for f in fields])
        return content_digest(rows.withColumn("bucket", bucket_of(keys, buckets)), ["bucket"], name)

    both = digests(left, "left_digest").join(digests(right, "right_digest"), "bucket", "full_outer")
    differs = ~F.col("left_digest").eqNullSafe(F.col("right_digest"))
    return sorted(row["bucket"] for row in both.where(differs).select("bucket").collect())


def compare_by_digest(
    left: DataFrame, right: DataFrame, keys: list[str], fields: list[str], buckets: int = BUCKETS
) -> DataFrame:
    """``compare`` of two surfaces of any size: only buckets whose digests differ are shuffled.

    Equal buckets are left where they lie; where all are equal nothing is joined at all. Keys of
    the two surfaces have the same types, so that they hash alike.
    """
    apart = differing_buckets(left, right, keys, fields, buckets)
    chosen = bucket_of(keys, buckets).isin(apart) if apart else F.lit(False)
    return compare(left.where(chosen), right.where(chosen), keys, fields)


def compare(left: DataFrame, right: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Keys on one side only, and fields further apart than a cent.

    One row per problem: the keys, ``field``, ``problem`` and both values. A NULL on
    one side only is a difference. Empty means the surfaces agree.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *[F.col(key).alias(f"{name}_{key}") for key in keys],
            F.struct(*[F.col(f).cast(TOTAL).alias(f) for f in fields]).alias(name),
        )

    matched = F.lit(True)
    for key in keys:
        matched = matched & F.col(f"left_{key}").eqNullSafe(F.col(f"right_{key}"))
    joined = side(left, "left").join(side(right, "right"), matched, "full_outer")

    differs = [
        F.struct(
            F.lit(name).alias("field"),
            F.lit("differs").alias("problem"),
            F.col(f"left.{name}").alias("left_value"),
            F.col(f"right.{name}").alias("right_value"),
        )
        for name in fields
    ]
    apart = F.filter(
        F.array(*differs),
        lambda item: ~item["left_value"].eqNullSafe(item["right_value"])
        & F.coalesce(F.abs(item["left_value"] - item["right_value"]) > F.lit(TOLERANCE), F.lit(True)),
    )

    def one_sided(problem: str) -> F.Column:
        return F.array(
            F.struct(
                F.lit("").alias("field"),
                F.lit(problem).alias("problem"),
                F.lit(None).cast(TOTAL).alias("left_value"),
                F.lit(None).cast(TOTAL).alias("right_value"),
            )
        )

    problems = (
        F.when(F.col("right").isNull(), one_sided("left only"))
        .when(F.col("left").isNull(), one_sided("right only"))
        .otherwise(apart)
    )
    return joined.select(
        *[F.coalesce(f"left_{key}", f"right_{key}").alias(key) for key in keys],
        F.explode(problems).alias("found"),
    ).select(*keys, "found.*")


def headline(sales: DataFrame) -> DataFrame:
    """Net and cancelled revenue and the number of sale lines, as one row."""
    money = F.col("amount_usd")
    return sales.agg(
        F.sum(F.when(~F.col("is_cancelled"), money)).cast(TOTAL).alias("revenue_usd"),
        F.sum(F.when(F.col("is_cancelled"), money)).cast(TOTAL).alias("cancelled_revenue_usd"),
        F.count("*").alias("sale_lines"),
    )


def snapshot_rows(snapshot: DataFrame) -> DataFrame:
    """A one-row snapshot as (metric, value) rows, ready to compare across runtimes."""
    return snapshot.select(*[F.col(name).cast(TOTAL).alias(name) for name in snapshot.columns]).unpivot(
        [], snapshot.columns, "metric", "value"
    )


def snapshot_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    return compare(snapshot_rows(left), snapshot_rows(right), ["metric"], ["value"])


def grade_total(pack: DataFrame, pack_column: str, export: DataFrame, export_column: str) -> DataFrame:
    """One row: total of the pack, total of the export, and whether they are within a cent."""
    return pack.agg(F.sum(pack_column).cast(TOTAL).alias("pack_total")).select(
        "pack_total",
        export.agg(F.sum(export_column).cast(TOTAL).alias("export_total")).scalar().alias("export_total"),
    ).withColumn("agrees", F.abs(F.col("pack_total") - F.col("export_total")) < F.lit(TOLERANCE))
