"""Split rows into usable and quarantined; nothing is dropped."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "reasons"


@dataclass(frozen=True)
class Split:
    clean: DataFrame
    quarantined: DataFrame


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Names of the rules each row breaks, in rule order.

    A rule that evaluates to NULL is broken: a row nobody can judge is not clean.
    """
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    return df.withColumn(REASONS, F.array_compact(F.array(*broken)))


def split(df: DataFrame, rules: dict[str, Column]) -> Split:
    """Rows that keep every rule, and the rest with the reasons they do not."""
    judged = with_reasons(df, rules)
    return Split(
        clean=judged.where(F.size(REASONS) == 0).drop(REASONS),
        quarantined=judged.where(F.size(REASONS) > 0),
    )
