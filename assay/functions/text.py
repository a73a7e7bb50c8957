"""Conforming expressions for text columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def conform_email(email: Column) -> Column:
    """Trimmed, lower-case address; a blank one is a missing one."""
    return F.nullif(F.lower(F.trim(email)), F.lit(""))


def conform_name(name: Column) -> Column:
    """A name as typed reduced to its lookup form."""
    return F.upper(F.trim(name))


def snake_case(name: str) -> str:
    """Model column to table column: ``FiscalYearLabel`` → ``fiscal_year_label``."""
    return re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def pascal_case(name: str) -> str:
    """Table column to model column: the inverse of :func:`snake_case`."""
    return "".join(word.capitalize() for word in name.split("_"))
