"""A semantic model over tables: measures, many-to-one relationships, summaries."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from assay.functions.text import pascal_case, snake_case
from assay.operators.integrity import unique_rows
from assay.types import MONEY, TOTAL, share


@dataclass(frozen=True)
class Measure:
    """A named aggregate (``sum`` or ``count``) or a formula over other measures."""

    name: str
    kind: str
    column: str = ""
    operands: tuple[str, ...] = ()


def sum_of(name: str, column: str) -> Measure:
    return Measure(name, "sum", column)


def count_rows(name: str) -> Measure:
    return Measure(name, "count")


def ratio(name: str, part: str, whole: str) -> Measure:
    """``part / whole``, blank where the whole is zero."""
    return Measure(name, "ratio", operands=(part, whole))


def plus(name: str, left: str, right: str) -> Measure:
    """``left + right``, a blank taken as zero; blank only where both are."""
    return Measure(name, "plus", operands=(left, right))


@dataclass(frozen=True)
class Relationship:
    """``many.many_column`` looks up the one row of ``one`` with that key."""

    many: str
    many_column: str
    one: str
    one_column: str


@dataclass(frozen=True)
class Model:
    tables: dict[str, DataFrame]
    measures: dict[str, list[Measure]]
    relationships: list[Relationship] = field(default_factory=list)

    def duplicate_keys(self) -> DataFrame:
        """Keys of a one side that occur more than once; any row breaks the model."""
        result = None
        for one, column in dict.fromkeys((r.one, r.one_column) for r in self.relationships):
            repeated = (
                self.tables[one]
                .groupBy(F.col(column).cast("string").alias("key"))
                .agg(F.count("*").alias("occurrences"))
                .where(F.col("occurrences") > 1)
                .select(F.lit(one).alias("table_name"), "key", "occurrences")
            )
            result = repeated if result is None else result.unionByName(repeated)
        return result

    def summarize(self, fact: str, by: list[str], measures: list[str] | None = None) -> DataFrame:
        """Measures of ``fact`` grouped by its own columns or by ``Table.column`` of a
        table it relates to.

        The fact is aggregated to its own columns and relationship keys before any
        join, so a hot key reaches the dimension as one row per task. A key that its table
        holds more than once fails the query: it would multiply the measures.
        """
        known = {measure.name: measure for measure in self.measures[fact]}
        wanted = [known[name] for name in (measures or known)]
        base = _base_measures(wanted, known)

        own = [name for name in by if "." not in name]
        reached = [(name, *name.split(".", 1)) for name in by if "." in name]
        links = {table: self._link(fact, table) for _, table, _ in reached}

        keys = list(dict.fromkeys([*own, *[link.many_column for link in links.values()]]))
        facts = self.tables[fact]
        rows = facts.groupBy(*keys).agg(*[_aggregate(m, facts) for m in base])
        for table, link in links.items():
            columns = [F.col(c).alias(f"{table}_{c}") for _, t, c in reached if t == table]
            side = unique_rows(
                self.tables[table].select(F.col(link.one_column).alias("_key"), *columns), "_key", table
            )
            rows = rows.join(side, rows[link.many_column] == side["_key"], "left").drop("_key")
        names = [name.replace(".", "_") for name in by]
        if links:
            again = [F.sum(m.name).cast(rows.schema[m.name].dataType).alias(m.name) for m in base]
            rows = rows.groupBy(*names).agg(*again)
        types = {m.name: rows.schema[m.name].dataType for m in base}
        return rows.select(*names, *[_formula(m, known, types).alias(m.name) for m in wanted])

    def summarize_across(
        self, facts: list[str], by: list[str], measures: dict[str, list[str]] | None = None
    ) -> DataFrame:
        """Measures of several facts side by side, by columns that all of them reach.

        Each fact is summed by itself, along its own relationships, and only then do they meet,
        on the conformed columns: one row of a fact never multiplies another's. A group that a fact
        has nothing in shows that fact's measures as NULL; NULL keys are a group like any other.
        """
        wanted = {fact: (measures or {}).get(fact) for fact in facts}
        parts = [self.summarize(fact, by, wanted[fact]) for fact in facts]
        groups = [name.replace(".", "_") for name in by]
        names = [name for part in parts for name in part.columns if name not in groups]
        repeated = sorted({name for name in names if names.count(name) > 1})
        if repeated:
            raise ValueError(f"measures of several facts share a name: {repeated}")
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        # At most one row of each fact has a value, so any aggregate that skips NULL picks it.
        picked = [F.max(name).cast(stacked.schema[name].dataType).alias(name) for name in names]
        return stacked.groupBy(*groups).agg(*picked)

    def _link(self, fact: str, table: str) -> Relationship:
        found = [r for r in self.relationships if r.many == fact and r.one == table]
        if len(found) != 1:
            raise ValueError(f"{fact} needs exactly one relationship to {table}, found {len(found)}")
        return found[0]


def _base_measures(wanted: list[Measure], known: dict[str, Measure]) -> list[Measure]:
    base: dict[str, Measure] = {}
    pending = list(wanted)
    while pending:
        measure = pending.pop(0)
        if measure.operands:
            pending.extend(known[name] for name in measure.operands)
        else:
            base[measure.name] = measure
    return list(base.values())


def _aggregate(measure: Measure, facts: DataFrame) -> Column:
    if measure.kind == "count":
        return F.count("*").alias(measure.name)
    total = F.sum(measure.column)
    if facts.schema[measure.column].dataType in (MONEY, TOTAL):
        total = total.cast(TOTAL)
    return total.alias(measure.name)


def _formula(measure: Measure, known: dict[str, Measure], types: dict[str, DataType]) -> Column:
    if not measure.operands:
        return F.col(measure.name)
    left, right = (_formula(known[name], known, types) for name in measure.operands)
    if measure.kind == "ratio":
        return share(left, right)
    zero = F.lit(0)
    total = F.coalesce(left, zero) + F.coalesce(right, zero)
    if all(types[base.name] == TOTAL for base in _base_measures([measure], known)):
        total = total.cast(TOTAL)
    return F.when(left.isNotNull() | right.isNotNull(), total)


def to_model_names(df: DataFrame) -> DataFrame:
    """Columns renamed for the report writer; names that do not map back are refused."""
    for name in df.columns:
        if snake_case(pascal_case(name)) != name:
            raise ValueError(f"column {name!r} does not survive the round trip")
    return df.select(*[F.col(name).alias(pascal_case(name)) for name in df.columns])


def to_table_names(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(name).alias(snake_case(name)) for name in df.columns])
