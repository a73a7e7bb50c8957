"""Column profile of tables: catalogue type, rows, nulls and distinct values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.types import catalogue_type

# Log2 of the sketch's registers: about two percent standard error.
SKETCH_BITS = 12


def profile_table(df: DataFrame, name: str, distinct: bool = True) -> DataFrame:
    """One row per column, from a single aggregate pass.

    Distinct values are estimated with a sketch of fixed size over the values' hashes;
    leave them out where an exact answer is needed, or use ``distinct_counts``.
    """
    aggregates = [F.count("*").alias("_rows")]
    for i, column in enumerate(df.columns):
        aggregates.append(F.count(F.col(column)).alias(f"_present_{i}"))
        if distinct:
            hashed = F.when(F.col(column).isNotNull(), F.xxhash64(column))
            estimate = F.hll_sketch_estimate(F.hll_sketch_agg(hashed, SKETCH_BITS))
            aggregates.append(F.coalesce(estimate, F.lit(0)).alias(f"_distinct_{i}"))
    entries = []
    for i, (column, native) in enumerate(df.dtypes):
        fields = [
            F.lit(name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(catalogue_type(native)).alias("data_type"),
            F.col("_rows").alias("rows"),
            (F.col("_rows") - F.col(f"_present_{i}")).alias("nulls"),
        ]
        if distinct:
            fields.append(F.col(f"_distinct_{i}").alias("approx_distinct"))
        entries.append(F.struct(*fields))
    return df.agg(*aggregates).select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def profile(tables: dict[str, DataFrame], distinct: bool = True) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile_table(df, name, distinct) for name, df in tables.items()])
