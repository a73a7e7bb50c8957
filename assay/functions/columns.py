"""Control over where an expression is evaluated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a costly column that several later expressions and filters read.

    The optimizer copies an expression into every filter it pushes below a projection.
    It pushes nothing below a generator, so the column is computed once per row.
    """
    return df.select(*df.columns, F.explode(F.array(expression)).alias(name))
