"""Tables at rest: full-refresh writes, read-back, metrics and snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# What a snapshot holds.
SNAPSHOT_TOTALS = ("revenue_usd", "cancelled_revenue_usd", "sale_lines")


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Replace the table at ``path`` with ``df``."""
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back, for a result several downstream plans share.

    The written table also cuts lineage: a lost executor re-reads files instead of
    recomputing the inputs.
    """
    return read_table(df.sparkSession, write_table(df, path))


def landed_at(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Rows and column names found at each declared path, one row per table.

    A path that holds no table fails the read: a run that wrote elsewhere must not
    pass for an empty table.
    """
    found = []
    for name, path in tables.items():
        table = read_table(spark, path, fmt)
        found.append(
            table.agg(F.count("*").alias("rows")).select(
                F.lit(name).alias("table_name"),
                F.col("rows"),
                F.lit(len(table.columns)).cast("long").alias("columns"),
                F.lit(",".join(table.columns)).alias("column_names"),
            )
        )
    return reduce(DataFrame.unionByName, found)


def count_mismatches(run: DataFrame, at_rest: DataFrame) -> DataFrame:
    """Tables whose run count and count at rest differ, or that one side lacks.

    Both inputs are ``(table_name, rows)``; empty means the run told the truth.
    """
    return (
        run.select("table_name", F.col("rows").alias("run_rows"))
        .join(at_rest.select("table_name", F.col("rows").alias("rest_rows")), "table_name", "full_outer")
        .where(~F.col("run_rows").eqNullSafe(F.col("rest_rows")))
    )


def run_metrics(df: DataFrame, **metrics: Column) -> DataFrame:
    """Exactly one row holding every metric, computed in one pass over ``df``."""
    return df.agg(*[column.alias(name) for name, column in metrics.items()])


def write_observed(df: DataFrame, path: str, fmt: str = "parquet", **metrics: Column) -> dict:
    """Replace the table at ``path`` and return metrics of the rows as they passed into it.

    The metrics are taken in the pass that writes, so the source is read once, and they say what the
    run wrote, not what lies at ``path`` afterwards: the two can be held against each other.
    """
    seen = Observation(f"write {path}")
    write_table(df.observe(seen, *[column.alias(name) for name, column in metrics.items()]), path, fmt)
    return seen.get


def read_metrics(spark: SparkSession, path: str) -> dict:
    """The metrics row of a run; anything but exactly one row is a fault."""
    rows = read_table(spark, path).take(2)
    if len(rows) != 1:
        raise ValueError(f"{path} must hold exactly one metrics row, found {len(rows)} or more")
    return rows[0].asDict()


def write_snapshot(headline: DataFrame, contracts: list[str], path: str) -> str:
    """Publish the one-row headline with the names of the contracts that back it.

    Refused when every total is zero or no contract is named: a snapshot that says
    nothing would still compare equal to another that says nothing.
    """
    if not contracts:
        raise ValueError("no contract names: refusing to publish a snapshot")
    rows = headline.select(*SNAPSHOT_TOTALS).take(2)
    if len(rows) != 1:
        raise ValueError("a snapshot is exactly one row")
    if not any(rows[0]):
        raise ValueError("every total is zero or missing: refusing to publish a snapshot")
    published = [None if value is None else str(value) for value in rows[0]] + [sorted(contracts)]
    schema = ", ".join(f"{name} string" for name in SNAPSHOT_TOTALS) + ", contracts array<string>"
    headline.sparkSession.createDataFrame([published], schema).coalesce(1).write.mode("overwrite").json(path)
    return path
