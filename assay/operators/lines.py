"""Nested orders to line grain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_lines(df: DataFrame, nested: str = "lines", keep_empty: bool = True) -> DataFrame:
    """One row per nested line with its position; the line's own fields become columns.

    With ``keep_empty`` an order without lines keeps one row of NULLs, so the loss of
    an order's items is visible instead of looking like a missing order.
    """
    explode = F.posexplode_outer if keep_empty else F.posexplode
    outer = [name for name in df.columns if name != nested]
    fields = df.schema[nested].dataType.elementType.names
    return df.select(*outer, explode(nested).alias("line_position", "_line")).select(
        *outer, "line_position", *[F.col(f"_line.{name}").alias(name) for name in fields]
    )


def nested_survived(df: DataFrame, nested: str = "lines") -> DataFrame:
    """Orders, orders with at least one line, and lines in total, as one row."""
    return df.agg(
        F.count("*").alias("orders"),
        F.count_if(F.size(nested) > 0).alias("orders_with_lines"),
        F.sum(F.when(F.col(nested).isNotNull(), F.size(nested)).otherwise(0)).alias("lines"),
    )
