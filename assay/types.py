"""Column types of the product and the catalogue's names for them."""

from __future__ import annotations

from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

# Money is never a float. Totals carry ten more digits than the rows they add up.
MONEY = T.DecimalType(19, 4)
TOTAL = T.DecimalType(29, 4)
RATE = T.DecimalType(18, 8)
# What Spark's division of two totals yields, so a ratio is rounded once.
SHARE = T.DecimalType(38, 9)

# First matching prefix wins, so decimal stands before double and
# timestamp before date.
CATALOGUE_TYPES = (
    (("int", "bigint", "smallint", "long"), "INT"),
    (("decimal", "numeric"), "DECIMAL"),
    (("double", "float", "real"), "DOUBLE"),
    (("timestamp", "datetime"), "TIMESTAMP"),
    (("date",), "DATE"),
    (("bool", "bit"), "BOOLEAN"),
)


def catalogue_type(native: str) -> str:
    """Catalogue name of an engine type; anything unknown is a STRING."""
    name = native.lower()
    return next((kind for prefixes, kind in CATALOGUE_TYPES if name.startswith(prefixes)), "STRING")


def money(value: Column | str) -> Column:
    """``value`` as money, or NULL where it does not parse."""
    return _column(value).try_cast(MONEY)


def rate(value: Column | str) -> Column:
    """``value`` as an exchange rate, or NULL where it does not parse."""
    return _column(value).try_cast(RATE)


def total(value: Column | str) -> Column:
    """Exact sum of a money column."""
    return F.sum(_column(value)).cast(TOTAL)


def share(part: Column | str, whole: Column | str) -> Column:
    """``part / whole`` of two aggregates; NULL when the whole is zero or NULL."""
    return F.try_divide(_column(part).cast(TOTAL), _column(whole).cast(TOTAL)).cast(SHARE)


def all_strings(names: list[str]) -> T.StructType:
    """Schema of a verbatim feed: every column a nullable string."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def page_of(leaves: list[str], nested: dict[str, list[str]] | None = None) -> T.StructType:
    """Declared schema of a JSON page: string leaves plus arrays of string structs."""
    fields = all_strings(leaves).fields
    for name, inner in (nested or {}).items():
        fields.append(T.StructField(name, T.ArrayType(all_strings(inner))))
    return T.StructType(fields)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
