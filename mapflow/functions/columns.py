"""Column helpers shared by pipelines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def entity_code(value: Column) -> Column:
    """Normal form of an entity code: letters and digits only, lower case."""
    return F.lower(F.regexp_replace(value, "[^a-zA-Z0-9]", ""))


def is_entity_code(value: Column) -> Column:
    """Whether a code already has its normal form; a missing code has."""
    return F.coalesce(value == entity_code(value), F.lit(True))


def joined_name(*parts: Column, sep: str = "_") -> Column:
    """Parts joined by ``sep``, missing parts left out."""
    return F.array_join(F.array(*parts), sep)


def month_end(run_month: Column) -> Column:
    """Last calendar day of a ``yyyyMM`` month."""
    return F.last_day(F.to_date(run_month, "yyyyMM"))


def same_text(left: Column, right: Column) -> Column:
    """Equality that ignores case and surrounding blanks."""
    return F.lower(F.trim(left)) == F.lower(F.trim(right))
