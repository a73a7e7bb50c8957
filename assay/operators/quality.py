"""Data contracts: declared rules, evaluated to violation counts.

A run passes when every rule reports zero and no declared rule is missing a result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

# Dimension and metric each kind of rule is published under.
METRICS = {
    "unique": ("uniqueness", "duplicateValues"),
    "not_null": ("completeness", "nullValues"),
    "accepted_values": ("conformity", "invalidValues"),
    "relationships": ("consistency", "unresolvedKeys"),
    "presence": ("completeness", "nullValues"),
    "row": ("validity", "invalidRows"),
}


@dataclass(frozen=True)
class Rule:
    table: str
    column: str
    kind: str
    name: str
    values: tuple = ()
    target: str = ""
    target_column: str = ""
    must_hold: Column | None = field(default=None, compare=False)


def unique(table: str, column: str) -> Rule:
    return Rule(table, column, "unique", f"{column}_unique")


def not_null(table: str, column: str) -> Rule:
    return Rule(table, column, "not_null", f"{column}_not_null")


def accepted_values(table: str, column: str, values: list) -> Rule:
    return Rule(table, column, "accepted_values", f"{column}_accepted", values=tuple(values))


def relationship(table: str, column: str, tables: dict, target: str, target_column: str) -> Rule:
    """Every key resolves to the target. Without a target only presence can be claimed."""
    if target in tables and target_column in tables[target].columns:
        return Rule(
            table, column, "relationships", f"{column}_resolves_in_{target}", target=target, target_column=target_column
        )
    return Rule(table, column, "presence", f"{column}_present")


def row_rule(table: str, column: str, name: str, must_hold: Column) -> Rule:
    """Every row satisfies an expression; a row where it is NULL does not."""
    return Rule(table, column, "row", name, must_hold=must_hold)


def rules_from(declaration: dict[str, dict[str, list]], tables: dict[str, DataFrame]) -> list[Rule]:
    """Rules of ``{table: {column: [test, ...]}}``; a test is a name or ``{name: args}``."""
    rules = []
    for table, columns in declaration.items():
        for column, tests in columns.items():
            for test in tests:
                name, args = (test, {}) if isinstance(test, str) else next(iter(test.items()))
                if name == "unique":
                    rules.append(unique(table, column))
                elif name == "not_null":
                    rules.append(not_null(table, column))
                elif name == "accepted_values":
                    rules.append(accepted_values(table, column, args["values"]))
                elif name == "relationships":
                    rules.append(relationship(table, column, tables, args["to"], args["field"]))
                else:
                    raise ValueError(f"unknown test {name!r} on {table}.{column}")
    return rules


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def null_values(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def invalid_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows outside the accepted set; NULLs are the not-null rule's business."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))


def unresolved_keys(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Non-null keys without a match, with the rows holding each.

    Keys are counted before the anti join, so a hot key meets it as one row.
    """
    keys = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count("*").alias("rows"))
    )
    return keys.join(target.select(F.col(target_column).alias("key")), "key", "left_anti")


def _local_count(rule: Rule) -> Column:
    column = F.col(rule.column)
    if rule.kind in ("not_null", "presence"):
        broken = column.isNull()
    elif rule.kind == "accepted_values":
        broken = column.isNotNull() & ~column.isin(list(rule.values))
    else:
        broken = ~F.coalesce(rule.must_hold, F.lit(False))
    return F.count_if(broken)


def _result(rule: Rule, counted: DataFrame) -> DataFrame:
    return counted.select(F.lit(rule.table).alias("table_name"), F.lit(rule.name).alias("rule"), "violations")


def evaluate(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(table_name, rule, violations) for every rule.

    All row-local rules of a table share one aggregate pass; a rule about keys gets a
    grouped pass of its own.
    """
    results = []
    for table in dict.fromkeys(rule.table for rule in rules):
        df = tables[table]
        mine = [rule for rule in rules if rule.table == table]
        local = [rule for rule in mine if rule.kind not in ("unique", "relationships")]
        if local:
            counted = df.agg(*[_local_count(rule).alias(f"_{i}") for i, rule in enumerate(local)])
            pairs = [
                F.struct(F.lit(rule.name).alias("rule"), F.col(f"_{i}").alias("violations"))
                for i, rule in enumerate(local)
            ]
            results.append(
                counted.select(F.explode(F.array(*pairs)).alias("result")).select(
                    F.lit(table).alias("table_name"), "result.rule", "result.violations"
                )
            )
        for rule in mine:
            if rule.kind == "unique":
                counted = duplicate_values(df, rule.column).agg(F.count("*").alias("violations"))
                results.append(_result(rule, counted))
            elif rule.kind == "relationships":
                target = tables[rule.target]
                missing = unresolved_keys(df, rule.column, target, rule.target_column)
                counted = missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("violations"))
                results.append(_result(rule, counted))
    return reduce(DataFrame.unionByName, results)


def declared(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as declared, one row each; two rules of a table may not share a name."""
    names = [(rule.table, rule.name) for rule in rules]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"rules are declared twice: {repeated}")
    schema = T.StructType(
        [
            T.StructField(name, T.StringType())
            for name in ("table_name", "rule", "column_name", "dimension", "metric")
        ]
    )
    rows = [(rule.table, rule.name, rule.column, *METRICS[rule.kind]) for rule in rules]
    return spark.createDataFrame(rows, schema)


def rule_report(results: DataFrame, rules: list[Rule]) -> DataFrame:
    """Every declared rule beside its result; one that did not run shows as not evaluated."""
    return (
        declared(results.sparkSession, rules)
        .join(results, ["table_name", "rule"], "left")
        .withColumn("evaluated", F.col("violations").isNotNull())
        .withColumn("passed", F.coalesce(F.col("violations") == 0, F.lit(False)))
    )


def float_money(df: DataFrame, columns: list[str]) -> list[str]:
    """Money columns whose type is not an exact decimal."""
    return [name for name in columns if not isinstance(df.schema[name].dataType, T.DecimalType)]


def money_losing_digits(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value does not survive four decimal places."""
    return df.where(F.col(column) != F.round(F.col(column), 4))


def missing_values(df: DataFrame, column: str, required: list) -> DataFrame:
    """Required values that never occur, e.g. a selling system that did not reach the pack."""
    spark = df.sparkSession
    wanted = spark.createDataFrame([(value,) for value in required], f"value {dict(df.dtypes)[column]}")
    return wanted.join(df.select(F.col(column).alias("value")).distinct(), "value", "left_anti")


def control_total(whole: DataFrame, whole_column: Column, parts: DataFrame, parts_column: Column) -> DataFrame:
    """One row: both totals and their difference, which must be exactly zero."""
    return parts.agg(parts_column.alias("parts_total")).select(
        whole.agg(whole_column.alias("whole_total")).scalar().alias("whole_total"), "parts_total"
    ).withColumn("lost", F.col("whole_total") - F.col("parts_total"))
